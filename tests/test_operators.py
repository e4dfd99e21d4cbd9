"""Operators on small inputs: known answers, failures, and equality with plain Python on random inputs."""

import json
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import patterns as P, text as T, udfs
from corpusmill.operators import dedup, distill, evaluation, ingest, lexicon, packing, resume, tokenizer
from corpusmill.plans import queries as own
from corpusmill.sources import corpus, packed
from corpusmill.streaming import resumable


def column(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalized_known_answers(spark):
    assert column(spark, T.normalized, [a for a, _ in own.NORMAL_CASES]) == [b for _, b in own.NORMAL_CASES]


def test_white_space_is_pythons(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \t\n\x1c\x85  　") for _ in range(20)) for _ in range(200)]
    assert column(spark, T.words, texts) == [t.split() for t in texts]
    assert column(spark, T.stripped, texts) == [t.strip() for t in texts]


def test_nfc(spark):
    texts = ["é", "ａ", "آ", "plain", None]
    assert column(spark, udfs.nfc, texts) == [t and unicodedata.normalize("NFC", t) for t in texts]


def test_shingles_of_short_texts(spark):
    assert column(spark, T.shingles, ["a b c d e", "a b c d e f", ""]) == [[], ["a b c d e", "b c d e f"], []]


def test_extract_json(spark):
    assert column(spark, udfs.extract_json, [c for _, c, _ in own.JSON_CASES]) == [f for _, _, f in own.JSON_CASES]


def test_contract(spark):
    meta = corpus.metadata_fixture(spark)
    assert meta.count() == 45 and ingest.tier_a(meta).where("is_multi_speaker").count() == 5
    with pytest.raises(ingest.SchemaError):
        ingest.checked_columns(meta.withColumn("more", F.lit("x")))
    with pytest.raises(ValueError):
        ingest.read_metadata(spark, "/nowhere", chunk_size=0)
    bad = meta.withColumn("text", F.lit(""))
    with pytest.raises(Exception, match="empty_text"):
        ingest.validated(bad).collect()
    assert ingest.quarantined(bad)[0].count() == 0
    dirty = meta.withColumn("cleaned_text", F.lit("وين رايح؟"))
    with pytest.raises(Exception, match="not clean"):
        ingest.tier_b(dirty).collect()
    assert ingest.tier_b(dirty, quarantine=True).count() == 0 < ingest.tier_b_rejects(dirty).count()


def test_greedy_keeps_what_is_near_only_a_dropped_one(spark):
    nodes = spark.createDataFrame([(i,) for i in range(6)], "seq long")
    pairs = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (3, 4)], "a long, b long")
    assert sorted(r.seq for r in dedup.greedy(nodes, pairs).collect()) == [0, 2, 4, 5]


def test_dedupe_equals_a_loop(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(30)) for _ in range(6)]
    texts = []
    for _ in range(60):
        w = rng.choice(base).split()
        w[rng.randrange(30)] = "zz"
        texts.append(" ".join(w))
    kept: list[tuple[int, set]] = []
    for i, t in enumerate(texts):
        w = t.split()
        s = {tuple(w[k : k + 5]) for k in range(26)}
        if not any(len(s & o) / len(s | o) >= 0.75 for _, o in kept):
            kept.append((i, s))
    rows = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    assert sorted(r.seq for r in dedup.dedupe(rows).collect()) == [i for i, _ in kept]


def test_lexicon_counts_speakers_once(spark):
    rows = spark.createDataFrame([("يا مغيث", "a1"), ("يا", "a2"), ("يا", "a1")], "text string, audio string")
    spread = {r.token: r.n_speakers for r in lexicon.dispersion(rows).collect()}
    assert spread == {"يا": 2, "مغيث": 1}
    known = spark.createDataFrame([("يا", 5), ("مغيث", 5), ("بس", 3)], "token string, n_speakers long")
    talk = spark.createDataFrame([(1, "بس يا مغيث بخير")], "seq long, text string")
    assert lexicon.flagged(talk, known).first().tokens == ["بس", "بخير"]


GOOD = json.dumps({"choices": [{"message": {"content": '{"user": "a", "assistant": "b", "dialect": " Najdi "}'}}]})


@pytest.mark.parametrize(
    "answers, expected",
    [
        ([(200, {}, GOOD)], ("a", "b", "najdi")), ([(429, {"Retry-After": "0"}, ""), (200, {}, GOOD)], ("a", "b", "najdi")), ([(500, {}, ""), (200, {}, "{}"), (200, {}, GOOD)], ("a", "b", "najdi")),
        ([(402, {}, "")], distill.PaymentError), ([(404, {}, "")], distill.CompletionError), ([(500, {}, "")] * 9, distill.CompletionError), ([(200, {}, GOOD.replace("najdi", "x").replace("Najdi", "x"))], distill.CompletionError),
    ],
)
def test_outcomes(answers, expected):
    left, slept = list(answers), []
    call = lambda *_: left.pop(0)
    if isinstance(expected, tuple):
        assert distill.complete("{}", distill.Config(), call, slept.append) == expected and all(s > 0 for s in slept)
    else:
        with pytest.raises(expected):
            distill.complete("{}", distill.Config(), call, slept.append)


def test_backoff():
    rng = random.Random(0)
    assert distill.backoff(0, "2.5", rng) == 2.5 and 1 <= distill.backoff(0, "0", rng) < 1.5 and 8 <= distill.backoff(9, "x", rng) < 8.5


ROWS = [
    ("a1", "وين رايح؟", "وين رايح", "Adult", "Male", "Najdi"), ("a2", "طيب", "طيب", "Adult", "Female", " hijazi "), ("a3", "ايش", "ايش", "Child", "Male", "Unknown"),
    ("a4", "نعم", "نعم", *[P.MULTI_SPEAKER] * 3), ("a5", "لا", "لا", "Adult", P.MULTI_SPEAKER, "Najdi"), ("a6", "بس", "بس", "Adult", "Male", "NAJDI"),
]


def test_routes_known_answers(spark):
    meta = ingest.validated(ingest.checked_columns(spark.createDataFrame(ROWS, list(P.METADATA_COLUMNS))))
    assert sorted(r.text for r in ingest.tier_a(meta).collect()) == sorted(r[1] for r in ROWS if r[0] != "a3")
    assert sorted(r.cleaned_text for r in ingest.tier_b(meta).collect()) == sorted(["وين رايح", "طيب", "بس"])


def test_prompts_say_what_is_asked(spark):
    assert all(x in T.SYSTEM_PROMPT for x in ("json", '"user"', '"assistant"', '"dialect"', "najdi", "hijazi"))
    meta = spark.createDataFrame(ROWS, list(P.METADATA_COLUMNS))
    for r in distill.requests(ingest.tier_a(meta.withColumn("seq", F.monotonically_increasing_id()), keep=("seq",)), distill.Config()).collect():
        body = json.loads(r.body)
        assert body["response_format"] == {"type": "json_object"} and body["messages"][0]["content"] == T.SYSTEM_PROMPT
        assert body["messages"][1]["content"].split("said: ")[1] in [x[1] for x in ROWS]


def test_anchor_known_answer(spark):
    import hashlib

    row = spark.createDataFrame([("نص", "Adult", "Male", "Najdi", True)], "text string, speaker_age string, speaker_gender string, speaker_dialect string, is_multi_speaker boolean")
    assert resume.anchored(row).first().anchor == hashlib.blake2b("نص\nAdult\nMale\nNajdi\nTrue".encode(), digest_size=16).hexdigest()


def test_resume(spark, tmp_path):
    rows = ingest.tier_a(corpus.metadata_fixture(spark))
    assert resume.load(spark, str(tmp_path / "none")).count() == 0
    some = rows.limit(7)
    resume.mark(resume.anchored(some), str(tmp_path / "done"))
    (tmp_path / "done" / "more").write_text("\n \n")
    done = resume.load(spark, str(tmp_path / "done"))
    assert done.count() == resume.anchored(some).select("anchor").distinct().count()
    left = resume.todo(rows, done)
    assert left.join(some, rows.columns, "left_semi").count() == 0 and left.count() >= rows.count() - 7 * 3


def test_jsonl(spark, tmp_path):
    talk = spark.createDataFrame([("أ", "ب", "najdi")], "user string, assistant string, dialect string")
    corpus.append_dialogues(talk, str(tmp_path / "d"))
    corpus.append_dialogues(talk, str(tmp_path / "d"))
    assert corpus.dialogues(spark, str(tmp_path / "d")).collect() == talk.union(talk).collect()


@pytest.mark.parametrize(
    "line, reason",
    [
        ('{"user": "a", "assistant": "b", "dialect": "najdi", "more": 1}', "extra key"), ('{"user": 5, "assistant": ["x"], "dialect": "najdi"}', "not a string"), ('{"user": "a", "assistant": "b", "dialect": "najdi"} x', "malformed"),
        ('{"user": "a", "user": "c", "assistant": "b", "dialect": "najdi"}', "repeated key"), ('{"user": "", "assistant": "b", "dialect": "najdi"}', "empty turn"), ('{"user": "a", "assistant": "b"}', "missing key"),
        ('{"user": "a", "assistant": "b", "dialect": "x"}', "unknown dialect"), ("[1]", "not an object"), ('{"user": null, "assistant": "b", "dialect": "najdi"}', "not a string"), ("{", "malformed"),
    ],
)
def test_jsonl_is_strict(spark, tmp_path, line, reason):
    good = '{"dialect": " Najdi ", "user": "a", "assistant": "b"}'
    (tmp_path / "x").write_text(f"{good}\n\n{line}\n")
    with pytest.raises(Exception, match=reason):
        corpus.dialogues(spark, str(tmp_path / "x")).collect()
    assert [tuple(r) for r in corpus.dialogues(spark, str(tmp_path / "x"), quarantine=True).collect()] == [("a", "b", "najdi")]


def test_exact_duplicates_with_nulls_and_ties(spark):
    rows = [(1, "a  b"), (2, "a b"), (2, "a b"), (3, None), (3, None), (0, "c"), (0, "c"), (4, "")]
    out = dedup.exact_duplicates(spark.createDataFrame(rows, "seq long, text string")).collect()
    assert sorted((r.seq, r.text or "-") for r in out if not r.is_duplicate) == [(0, "c"), (1, "a  b"), (3, "-"), (3, "-"), (4, "-")] and len(out) == len(rows)


def test_is_seen(spark):
    rows = spark.createDataFrame([(1, "a  b"), (2, "c")], "seq long, text string")
    assert [r.seq for r in dedup.is_seen(rows, spark.createDataFrame([("a b",)], "canonical string")).collect()] == [1]
    with pytest.raises(TypeError):
        dedup.dedupe(rows.drop("text"))


def test_numbered_lines(spark, tmp_path):
    (tmp_path / "a").write_text("".join(f"{i}\n" if i % 3 else "\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        out = corpus.numbered_lines(spark, str(tmp_path / "a")).orderBy("line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in out] == list(range(5000)) and all(r.text == (str(r.line) if r.line % 3 else "") for r in out)


def test_first_json_object_in_odd_texts():
    f = udfs.first_json_object
    assert f('x {"a": "{\\"}{"} y }') == '{"a": "{\\"}{"}' and f('{"a": "never closed }') is None and f("```JSON\n{}\n```") == "{}" and f('{"a": "\\') is None and f("} {1}") == "{1}"


def test_requests_in_flight_keep_order_and_bound(spark):
    import threading

    lock, now, most = threading.Lock(), [0], [0]

    def slow(body):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        import time

        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return body

    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(distill.Config(concurrency=3).concurrency) as pool:
        assert list(pool.map(slow, range(30))) == list(range(30)) and most[0] <= 3
    meta = corpus.metadata_fixture(spark).coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    rows = ingest.distillation_rows(ingest.tier_a(meta, keep=("seq",)))

    def broken(url, headers, body):
        return (404, {}, "") if "Southern" in body else distill.canned(url, headers, body)

    out = distill.distill(rows, distill.Config(), broken, sleep=lambda s: None).collect()
    assert [r.seq for r in out] == [r.seq for r in rows.collect()] and {r.error for r in out} == {None, "CompletionError: status 404"}
    with pytest.raises(Exception, match="status 404"):
        distill.distill(rows, distill.Config(fail_fast=True), broken, sleep=lambda s: None).collect()
    with pytest.raises(Exception, match="payment"):
        distill.distill(rows, distill.Config(), lambda *_: (402, {}, "")).collect()


def test_real_time_factor(spark):
    row = spark.createDataFrame([(3.0, 12.0), (1.0, 0.0)], "w double, a double").select(evaluation.real_time_factor(F.col("w"), F.col("a")).alias("r")).collect()
    assert [r.r for r in row] == [0.25, 0.0]


def test_packed_round_trip(spark, tmp_path):
    ids = [[1, 2, 3], [], [65535], list(range(1, 40))]
    rows = spark.createDataFrame([(i % 2, i, x) for i, x in enumerate(ids)], "kind byte, row_idx long, ids array<int>")
    meta = packed.write(rows, str(tmp_path / "p"), vocabulary=65_000, tokenizer_hash="x")
    assert meta["total_tokens"] == 43 and (meta["rows_raw"], meta["rows_synthetic"]) == (2, 2)
    back = packed.read(spark, str(tmp_path / "p")).orderBy("row_idx").collect()
    assert [list(r.ids) for r in back] == [ids[0], ids[2], ids[1], ids[3]] and [r.start for r in back] == [0, 3, 4, 4]
    flat = packed.Loader(str(tmp_path / "p"), indexed=False)
    first = next(it := flat.batches(2, 8))
    state = flat.state()
    rest = np.concatenate([b.ravel() for b in it])
    again = packed.Loader(str(tmp_path / "p"), indexed=False)
    again.restore(state)
    assert first.shape == (2, 8) and (np.concatenate([b.ravel() for b in again.batches(2, 8)]) == rest).all()
    assert next(packed.Loader(str(tmp_path / "p"), indexed=True).batches(4, 4, kinds=(1,))).tolist() == [[0] * 4, [1, 2, 3, 4], [0] * 4, [0] * 4]
    with pytest.raises(ValueError):
        again.restore({"offset": 99})


def test_gate(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (1, [0]), (2, [7]), (3, [99])], "row_idx long, ids array<int>")
    assert [r.row_idx for r in packing.gated(rows, [7], 50, quarantine=True).collect()] == [0] and packing.rejected(rows, [7], 50).count() == 3
    with pytest.raises(Exception, match="can't be packed"):
        packing.gated(rows, [7], 50).collect()


def test_tokenizer(spark, tmp_path):
    lines = spark.createDataFrame([(i, f"السلام عليكم يا صاحبي {i % 7}") for i in range(400)], "line long, text string")
    made = tokenizer.train(lines, vocabulary=300)
    assert made.spec == tokenizer.train(lines.repartition(3), vocabulary=300).spec and made.train_lines + made.holdout_lines == 400
    rows = lines.limit(5).withColumn("ids", udfs.encoded(F.col("text"), made.spec)).withColumn("back", udfs.decoded(F.col("ids"), made.spec))
    assert all(r.back.lstrip(" ") == r.text for r in rows.collect())
    report = tokenizer.metrics(lines, made.spec, fraction=0.2)
    assert report.first().fertility > 0 and tokenizer.write_report(report, str(tmp_path / "r.json")) == 0
    with pytest.raises(ValueError):
        tokenizer.train(lines, vocabulary=70_000)


def test_evaluation(spark):
    rows = spark.createDataFrame([("a b c", "a x c")], "reference string, hypothesis string")
    assert evaluation.error_rates(rows).first().wer == pytest.approx(1 / 3)
    masked = spark.createDataFrame([([5, 6, 7], 2)], "ids array<int>, n int").select(evaluation.masked_targets(F.col("ids"), F.col("n")).alias("t"))
    assert masked.first().t == [-100, -100, 7]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six"), (3, "other words")], "seq long, text string")
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        resumable.curated(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        rows.write.mode("append").parquet(str(tmp_path / "in"))
    assert sorted(r.seq for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3]


def test_stream_with_anchors_and_earlier_batches(spark, tmp_path):
    base = [f"w{i}" for i in range(48)]
    near = " ".join([*base[:-1], "other"])
    schema = "seq long, text string, anchor string"
    first = spark.createDataFrame([(1, " ".join(base), "x"), (2, "short one", "y")], schema)
    second = spark.createDataFrame([(3, near, "z"), (4, "new words", "done"), (5, "more new words", "q"), (6, "short  one", "r")], schema)
    done = spark.createDataFrame([("done",)], "anchor string")
    for rows in (first, second):
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        resumable.curated(stream, str(tmp_path / "out"), str(tmp_path / "check"), anchors=done).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 5]


def test_event_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "events"))
    batch, stream = resumable.event_counts(events), resumable.replayed(spark, str(tmp_path / "events"), "event_replay")
    key = lambda df: sorted((str(r.window_start), r.event_type, r.n, round(r.total, 6)) for r in df.collect())
    assert key(batch) == key(stream)


def test_files_are_numbered_in_order(spark, tmp_path):
    (tmp_path / "b.txt").write_text("x\n\n y \n")
    (tmp_path / "a.txt").write_text("first\n")
    assert [(r.row_idx, r.text) for r in corpus.raw_rows(spark, str(tmp_path)).orderBy("row_idx").collect()] == [(0, "first"), (1, "x"), (2, "y")]
    assert P.UNK_ID == 0


def test_texts_are_encoded_in_bounded_portions(monkeypatch):
    """However many texts a batch has, the encodings held at a time are those of about ENCODED_BYTES."""
    import public_tokenizers
    import pyarrow as pa

    from corpusmill.functions import udfs

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    real, portions = udfs._tokenizer(spec), []

    class Recorder:
        def encode_batch_fast(self, texts, **options):
            portions.append(sum(len(x.encode()) for x in texts))
            return real.encode_batch_fast(texts, **options)

    monkeypatch.setattr(udfs, "ENCODED_BYTES", 10_000)
    monkeypatch.setattr(udfs, "_tokenizer", lambda _: Recorder())
    texts = [f"text {i} " * (i % 90) if i % 7 else None for i in range(600)]
    got = [x for part in udfs.ids_of(pa.array(texts), spec) for x in part]
    assert got == [real.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert len(portions) > 10 and max(portions) < 10_000 + max(len(x or "") for x in texts) and list(udfs.ids_of(pa.array([], "string"), spec)) == []


def test_metrics_make_no_row_for_each_token(spark):
    import public_tokenizers

    from corpusmill.operators import tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    report = tokenizer.metrics(spark.createDataFrame([(i, "one two three " * 50) for i in range(300)], "line long, text string"), spec, fraction=0.5)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    r = report.first()
    assert "Generate" not in plan and "mapInArrow" in plan.replace("MapInArrow", "mapInArrow") and r.words == 150 * r.lines and 0 < r.lines < 300
    none = tokenizer.metrics(spark.createDataFrame([], "line long, text string"), spec).first()
    assert (none.lines, none.words, none.content_tokens, none.rare_tokens, none.fertility) == (0, 0, 0, 0, 0.0)
