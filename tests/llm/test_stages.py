"""The pipeline's stages against brute force, each on its own input: null and repeated ids, several texts under one id."""

from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(seed: int, n: int = 60) -> str:
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 100_003}" for i in range(n))


def table(spark, rows):
    return spark.createDataFrame([(k, t, lang, source, len(t or "")) for k, t, lang, source in rows], SCHEMA)


def groups(rows):
    """Lists of the rows linked by fingerprints that differ in at most 3 bits."""
    from corpusmill.llm.simhash import fingerprint

    own, part = [fingerprint(r.text) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (own[i] ^ own[j]).bit_count() <= 3:
                part = [part[j] if x == part[i] else x for x in part]
    return [[r for r, x in zip(rows, part) if x == p] for p in sorted(set(part))]


def order(r):
    return r.doc_id is None, r.doc_id or 0, *((x is not None, x) for x in r[1:])


def test_near_duplicates_of_null_and_repeated_ids(spark):
    rows = [(None, text(1), "en", "s"), (None, text(2), "en", "s"), (None, text(2), "de", "s"), (None, text(3), None, None), (3, text(4), "en", "s"), (5, text(5), "en", "s"), (5, text(4), "en", "s"), (5, text(6), "en", "t"),
            (7, text(7), "en", "t"), (7, text(7), "en", "s"), (None, text(7), "en", "s"), (9, None, "en", "s"), (9, "", "en", "s"), (10, text(8), "en", "s")]
    docs = table(spark, rows)
    want = sorted((min(g, key=order) for g in groups(docs.collect())), key=order)
    assert sorted(corpus_pipeline.near_duplicates(spark, docs, "").collect(), key=order) == want and len(want) == 9
    nulls = docs.where("doc_id is null")
    assert corpus_pipeline.near_duplicates(spark, nulls, "").count() == 4


def test_near_duplicates(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = sorted((min(g, key=order) for g in groups(docs.collect())), key=order)
    assert sorted(corpus_pipeline.near_duplicates(spark, docs, sf).collect(), key=order) == want


def targets(sizes):
    """Words of each source: shares by the weights 5, 2, 1 over the sources in order, none above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, left = {}, sum(sizes.values())
    while free := [s for s in order if s not in out]:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        out |= {s: 3 * sizes[s] for s in over} if over else {s: level * weight[s] for s in free}
        left -= sum(3 * sizes[s] for s in over)
    return out


def test_mixture_gives_each_row_its_own_copies(spark):
    rows = [(None, text(i, 5 + i % 90), "en", "abc"[i % 3]) for i in range(600)] + [(i % 7, text(1000 + i, 40), "en", None if i % 2 else "a") for i in range(400)]
    rows += [(8, text(3), "en", "b")] * 5 + [(8, text(3), None, "b"), (8, text(3), "b", None), (9, "", "en", "a"), (9, None, "en", "a"), (None, None, None, None), (None, None, None, None)]
    docs = table(spark, rows)
    given = Counter(docs.collect())
    out = Counter(corpus_pipeline.mixture(spark, docs, "").collect())
    assert all(out[r] <= 3 * n for r, n in given.items()) and set(out) <= set(given)
    assert all(out[r] == n for r, n in given.items() if not (r.text or "").split())
    words = lambda c: {s: sum(n * len((r.text or "").split()) for r, n in c.items() if r.source == s) for s in ("a", "b", "c", None)}
    want, got = targets(words(given)), words(out)
    assert all(abs(got[s] - want[s]) <= max(100, 0.01 * want[s]) for s in want), (got, want)
    again = table(spark, rows[::-1]).repartition(7)
    assert Counter(corpus_pipeline.mixture(spark, again, "").collect()) == out


def test_mixture(spark, sf):
    from corpusmill.llm import mixing

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    copies = {(r.doc_id, r.source): r.copies for r in mixing.mix(docs).collect()}
    given, out = docs.collect(), Counter(corpus_pipeline.mixture(spark, docs, sf).collect())
    words = lambda n: Counter({s: sum(n(r) * len(r.text.encode().split()) for r in given if r.source == s) for s in {r.source for r in given}})
    want, got, op = targets(words(lambda r: 1)), words(lambda r: out[r]), words(lambda r: copies[r.doc_id, r.source])
    assert all(abs(got[s] - want[s]) <= max(60, 0.05 * want[s]) and abs(got[s] - op[s]) <= 0.1 * want[s] + 60 for s in want)


def test_quality(spark, sf):
    from corpusmill.llm import quality

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rejected = {r.doc_id for r in quality.quality(docs, quality.load_labels(spark, sf)).where("score < 0.5").collect()}
    assert Counter(corpus_pipeline.quality(spark, docs, sf).collect()) == Counter(r for r in docs.collect() if r.doc_id not in rejected)


def test_personal_data(spark):
    docs = table(spark, [(None, "write to a@b.com or jane at foo dot co dot uk", "en", "s"), (1, "no data", "en", "s"), (1, None, None, None)])
    out = {r.text: r for r in corpus_pipeline.personal_data(spark, docs, "").collect()}
    assert set(out) == {"write to <EMAIL> or <EMAIL>", "no data", None} and all(r.n_chars == (len(t) if t else r.n_chars) for t, r in out.items())


CLASHING = "__id long, __h long, __n long, h long, g string, row int, copies int, rows int, id long, n int, text_key long, group int, stats int"


def test_stages_keep_columns_whose_names_they_use(spark):
    rows = [(i, t := text(i % 9, 30 + i), "en", "st"[i % 2], len(t), *[i] * 4, f"g{i}", *[i] * 8) for i in range(40)]
    docs = spark.createDataFrame(rows, f"{SCHEMA}, {CLASHING}")
    at = f"{corpus_pipeline.common.scratch_dir(spark)}/clash"
    docs.limit(4).selectExpr("doc_id", "cast(doc_id % 2 as int) as quality", "0 as toxic").write.mode("overwrite").parquet(f"{at}/labels.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, at)
        assert out.columns == docs.columns, name
        assert all(r == given[r.doc_id] for r in out.collect()), name
    assert corpus_pipeline.pack(spark, docs, at).count() > 0


def test_stages_of_an_empty_table(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).collect() == [], name


def test_quality_gives_null_and_empty_texts_one_fate(spark, sf):
    docs = table(spark, [(None, None, "en", "s"), (None, "", "en", "s"), (1, None, None, None), (1, "", None, None), (2, text(3), "en", "s"), (2, text(3), "en", "s")])
    out = Counter((r.doc_id, r.text) for r in corpus_pipeline.quality(spark, docs, sf).collect())
    assert len({out[None, ""] > 0, out[1, ""] > 0}) == len({out[None, None] > 0, out[1, None] > 0}) == 1 and out[2, text(3)] in (0, 2)


def test_packing_by_weights(spark):
    from corpusmill.llm import packing

    docs = table(spark, [(i, text(i, 400), "en", "abc"[i % 3]) for i in range(60)])
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 0.0)], "source string, weight double")
    out = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), weights=weights).collect()
    first = Counter()
    for r in out:
        if r.sequence_id < 6:
            first[r.source] += r.length
    assert first["c"] == 0 and abs(first["a"] - 3 * first["b"]) <= 4 * 256
    assert {r.doc_id for r in out} == set(range(60))


def test_packing_of_null_and_repeated_ids(spark):
    rows = [(None, text(1, 700), "en", "s"), (None, text(2, 50), "en", None), (4, text(3, 50), "en", "s"), (4, text(3, 50), "en", "s"), (4, "", "en", "s"), (5, None, "en", "t")]
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = corpus_pipeline.pack(spark, table(spark, rows), "").collect()
    size = Counter()
    for k, t, *_ in rows:
        size[k] += len(bpe.encode(t or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in out:
        got[r.doc_id] += r.length
    assert got == size
    places = sorted((r.sequence_id, r.offset, r.length) for r in out)
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(places, places[1:]))
