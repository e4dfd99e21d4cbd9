"""The dealt queries on the smallest tables against brute force, exact round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusmill.llm import queries as llm


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def rows(spark, sf, name):
    return llm.queries()[name](spark, sf).collect()


def tokens(x):
    return x.encode().lower().split()


def test_op1_base(spark, sf, docs):
    learnt = {k for k in docs if zlib.crc32(str(k).encode()) % 7 != 2}
    c = Counter(w for k in learnt for w in tokens(docs[k]))
    n, v = sum(c.values()) + len(learnt), len(c) + 1
    for r in rows(spark, sf, "op1_lm_scoring"):
        ws = tokens(docs[r.doc_id])
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((len(learnt) + 1) / (n + v + 1))
        assert r.base_score == pytest.approx(base) and r.train_tokens == n and r.held_out == (r.doc_id not in learnt)
        assert (r.n_tokens, r.n_known) == (len(ws) + 1, sum(c[w] > 0 for w in ws) + 1) and r.score < 0


def test_op1_windows_score_each_id_once():
    from corpusmill.llm import attention

    starts = np.array([0, 1, 1, 70, 95])
    ids = np.arange(95)
    _, targets, scored = attention.windows(ids, starts, 999)
    assert sorted(targets[scored].tolist()) == ids.tolist()


def test_op1_is_causal():
    from corpusmill.llm import attention

    rng = np.random.default_rng(0)
    model = attention.Attention.new(np.ones(100), rng)
    a = rng.integers(0, 100, (1, 10))
    b = a.copy()
    b[0, 6:] = 5
    assert np.allclose(model.forward(a)["logits"][0, :6], model.forward(b)["logits"][0, :6], atol=1e-6)


def test_op2_held_out_accuracy(spark, sf):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in rows(spark, sf, "op2_language") if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_op2_parse_equals_longest_matches():
    """Phrases cross words: the longest match of what is left, again and again, by plain search in the sample."""
    from corpusmill.llm.language_id import SuffixAutomaton

    rng = random.Random(8)
    for _ in range(300):
        sample = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 40)))
        automaton = SuffixAutomaton(sample)
        text = "".join(rng.choice("ab cx") for _ in range(rng.randint(1, 30)))
        count, at = 0, 0
        while at < len(text):
            n = 1
            while at + n < len(text) and text[at : at + n + 1] in sample:
                n += 1
            unknown = text[at] not in sample
            count, at = count + 1 + unknown, at + (1 if unknown else n)
        assert automaton.phrases(text) == count


def test_op2_letters_and_languages_without_text(spark):
    from corpusmill.llm.language_id import identify, reduced

    assert reduced("½ ² Ⅷ ① 12_") == "" and reduced("Élan 3 vital") == " élan vital "
    rows = [(i, "the cat and the dog", "en") for i in range(1, 8)] + [(20 + i, "", "xx") for i in range(6)] + [(40, "½ ² Ⅷ ①", "en"), (41, None, "en"), (42, "le chat", None), (43, "x", "")]
    by = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert by[40].lang_pred == by[41].lang_pred == by[20].lang_pred == "und" and by[42].lang_pred in ("en", "") and by[1].lang_pred == "en"
    assert "xx" not in {r.lang_pred for r in by.values()}


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(t):
    from corpusmill.llm.pii import _luhn

    digits = lambda m: re.sub(r"\D", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(t)] + [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 14 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]


def test_op3_plain_spans_on_random_texts():
    from corpusmill.llm.pii import plain_spans

    rng = random.Random(5)
    for _ in range(20_000):
        t = "".join(rng.choice("aB1234567890  ..@@++--()_x") for _ in range(rng.randint(0, 40)))
        assert plain_spans(t) == plain(t)


@pytest.mark.parametrize(
    "text, found",
    [
        ("write to john.doe (at) example (dot) com now", "john.doe (at) example (dot) com"), ("mail jane at foo dot co dot uk please", "jane at foo dot co dot uk"), ("jоhn@exаmple.com hi", "jоhn@exаmple.com"),
        ("call +1 five five five one two three four five six seven", "+1 five five five one two three four five six seven"), ("card four one one one 1111 1111 one one one one", "four one one one 1111 1111 one one one one"),
        ("jo​hn@exam​ple.com", "jo​hn@exam​ple.com"), ("192[.]168[.]1[.]1", "192[.]168[.]1[.]1"), ("meet me at example.com today", None), ("one two three points at noon", None),
        ("write john dot doe at example dot com", "john dot doe at example dot com"), ("j. dot doe at example dot com", "doe at example dot com"), ("Ann Dot  lee dot x (at) foo (dot) org.", "Ann Dot  lee dot x (at) foo (dot) org"),
        ("john.doe at example.com", None), ("a dot b at example.com", None), (" dot doe at example dot com", "doe at example dot com"), ("dot doe at example dot com", "doe at example dot com"),
    ],
)
def test_op3_disguises(text, found):
    from corpusmill.llm.pii import disguised_spans, plain_spans

    spans = disguised_spans(text, plain_spans(text))
    assert [text[a:b] for _, a, b in spans] == ([found] if found else [])


def test_op4(spark, sf, docs):
    raw = {k: t.encode() for k, t in docs.items()}
    seen = Counter(t[i : i + 200] for t in raw.values() for i in range(len(t) - 199))
    for r in rows(spark, sf, "op4_suffix_dedup"):
        t = raw[r.doc_id]
        cut = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                cut[i : i + 200] = 1
        kept = bytes(np.frombuffer(t, np.uint8)[cut[:-1] == 0])
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(t), cut.sum(), (np.diff(np.r_[0, cut]) == 1).sum()) and r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_op5_held_out_accuracy(spark, sf):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in rows(spark, sf, "op5_quality") if r.held_out and r.doc_id in label]
    assert sum(label[r.doc_id] == r.predicted for r in held) >= 0.9 * len(held)


def test_op5_isotonic_is_monotone():
    from corpusmill.llm.quality import isotonic

    _, values = isotonic([(0.1, 5, 1), (0.2, 5, 4), (0.3, 5, 2), (0.4, 5, 5)], 0.5)
    assert (np.diff(values) >= 0).all()


def test_op7(spark, sf, docs):
    out = rows(spark, sf, "op7_mixing")
    by: dict = {}
    for r in out:
        assert r.size == len(docs[r.doc_id].encode().split()) and 0 <= r.taken <= 3 * r.size
        s = by.setdefault(r.source, [r.source_size, r.target, 0, 0])
        s[2] += r.size
        s[3] += r.taken
    level = sorted(by)
    assert all(a[0] == a[2] and a[1] <= 3 * a[0] + 1e-6 for a in by.values())
    assert sum(a[1] for a in by.values()) == pytest.approx(sum(a[0] for a in by.values()))
    free = [by[s][1] / (5, 2, 1)[i % 3] for i, s in enumerate(level) if by[s][1] < 3 * by[s][0] - 1e-6]
    assert max(free) == pytest.approx(min(free))
    assert all(abs(a[3] - a[1]) <= max(60, 0.05 * a[1]) for a in by.values())


def test_op8(spark, sf, docs):
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in rows(spark, sf, "op8_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, text in docs.items():
        ids, at = np.array([*bpe.encode(text, add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048 and at.bit_count() == 1


def test_op9(spark, sf, docs):
    import xxhash

    def fp(t):
        w = tokens(t)
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    own = {k: fp(t) for k, t in docs.items()}
    part = {k: k for k in docs}

    def root(k):
        while part[k] != k:
            k = part[k]
        return k

    for a in docs:
        for b in docs:
            if a < b and (own[a] ^ own[b]).bit_count() <= 3 and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                part[y] = x
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, sf, "op9_simhash")} == {k: (f"{own[k]:016x}", root(k)) for k in docs}


def test_op10(spark, sf, docs):
    ids = sorted(docs, reverse=True)
    out = {r.doc_id: r for r in rows(spark, sf, "op10_syncmers")}
    for i, k in enumerate(ids):
        t, following = docs[k], docs[ids[(i + 1) % len(ids)]]
        n = len(t) // 3
        assert out[k].edited_sha256 == hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest() and out[k].n_chars == len(t)
    long = [r for r in out.values() if r.n_chars > 200]
    assert sum(r.near_edited > 0.4 > r.near_next for r in long) >= 0.95 * len(long)


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = corpus_pipeline.common.saved(stage(spark, docs, sf))
        assert new.columns == docs.columns and 0 < new.count() <= 3 * before, name
        docs = new
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0
