"""Queries over whole tables, one for each operator, with the SQL that gives the same rows in DuckDB.

Where an operator has no SQL form (BLAKE2, tokenizer ids, streams, a completion service) only the query stands here.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from corpusmill.functions import patterns as P, text as T, udfs
from corpusmill.operators import dedup, distill, evaluation, ingest, lexicon, packing, resume, tokenizer
from corpusmill.plans.scratch import saved, spread
from corpusmill.sources import corpus
from corpusmill.streaming import resumable

#: A rule pack for Latin script, as the tables hold no Arabic.
LATIN_DRIFT = rf"(^|{P.WHITE_SPACE})(with|avec|mit|para)({P.WHITE_SPACE}|[.,!?]|$)"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "seq")


def _values(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    return spark.createDataFrame(rows, names)


def _sql_values(rows: list[tuple], names: list[str]) -> str:
    def cell(x: object) -> str:
        return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int | float) else "'" + x.replace("'", "''") + "'"

    return f"(VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({', '.join(names)})"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn with the assistant's that follows it."""
    w = W.partitionBy("conv_id").orderBy("turn")
    rows = _table(spark, sf_dir, "conversations").withColumn("next_role", F.lead("role").over(w)).withColumn("assistant", F.lead("text").over(w))
    return rows.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("user"), "assistant")


_PAIRS = """(SELECT conv_id, turn, text AS "user", next_text AS assistant FROM (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
) WHERE role = 'user' AND next_role = 'assistant')"""


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{P.WHITE_SPACE}+'), lambda w: w <> '')"


def _sql_canonical(x: str = "text") -> str:
    return f"array_to_string({_sql_words(f"regexp_replace({x}, '{P.DEDUP_MARKS}', '', 'g')")}, ' ')"


def _sql_lexicon(x: str) -> str:
    return _sql_words(f"regexp_replace({x}, '{_q(P.LEXICON_SIGNS)}', '', 'g')")


_NORMAL = (
    f"regexp_replace(regexp_replace(translate(regexp_replace(regexp_replace(nfc_normalize(text), '{P.NORMAL_MARKS}', '', 'g'), '{P.CONTROLS}', '', 'g'), "
    f"'{P.LETTERS_FROM}', '{P.LETTERS_TO}'), '{P.ASCII_BLANKS}', ' ', 'g'), '^{P.WHITE_SPACE}+|{P.WHITE_SPACE}+$', '', 'g')"
)


def curated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of normalised documents without exact duplicates: number, words, mean length.

    Texts are normalised once, into a written table; only hashes and numbers are shuffled.
    """
    docs = saved(spread(_documents(spark, sf_dir)).select("seq", "lang", T.normalized(F.col("text")).alias("text")))
    rows = docs.select("seq", F.sha2(T.canonical(F.col("text")), 256).alias("key"), F.struct("lang", F.size(T.words(F.col("text"))).cast("long").alias("n_words"), F.length("text").alias("length")).alias("r"))
    kept = rows.where("r.n_words >= 1").groupBy("key").agg(F.min_by("r", "seq").alias("r")).select("r.*")
    return kept.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.avg("length").alias("mean_length"))


def normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", T.normalized(F.col("text")).alias("normalized"))


#: Text and its normal form: letters, marks, invisible characters, spelling variants with and without clitics, blanks.
NORMAL_CASES = [
    ("أحمد إبراهيم آدم", "احمد ابراهيم ادم"), ("مؤمن بئر", "مومن بير"), ("مدرسة جميلة", "مدرسه جميله"), ("مُحَمَّدٌ", "محمد"),
    ("سلام​عليكم", "سلامعليكم"), ("كده وكدا", "كذا وكذا"), ("كدة", "كذا"), ("كدها", "كدها"), ("ٱلحين", "لحين"), ("كدّه", "كذا"), ("  a \t b\n", "a b"),
]


def normalize_arabic_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _values(spark, [(i, t) for i, (t, _) in enumerate(NORMAL_CASES)], ["id", "text"])
    return rows.select("id", T.normalized(F.col("text")).alias("normalized"))


_MULTI = P.MULTI_SPEAKER
def _as_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the metadata's form: language as dialect, source as speaker, every 7th said by several; two languages'
    cleaned texts are spoilt."""
    cleaned = F.when(F.col("lang") == "es", "").when(F.col("lang") == "de", "  ").otherwise(F.col("text"))
    gender = F.when(F.col("doc_id") % 7 == 0, _MULTI).otherwise("Male")
    return _table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("audio"), "text", cleaned.alias("cleaned_text"), F.lit("Adult").alias("speaker_age"), gender.alias("speaker_gender"), F.concat(F.lit(" "), F.upper("lang")).alias("speaker_dialect"))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.quarantined(ingest.checked_columns(_as_metadata(spark, sf_dir)))[0]


def route_tier_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.tier_a(_valid(spark, sf_dir), accepts=T.is_target_dialect(F.col("speaker_dialect"), ("fr",)))


def route_tier_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.tier_b(_valid(spark, sf_dir), accepts=T.is_target_dialect(F.col("speaker_dialect"), ("fr",)))


_META_SQL = f"""(SELECT regexp_replace(text, '^{P.WHITE_SPACE}+|{P.WHITE_SPACE}+$', '', 'g') AS text, 'Adult' AS speaker_age, CASE WHEN doc_id % 7 = 0 THEN '{_MULTI}' ELSE 'Male' END AS speaker_gender,
concat(' ', upper(lang)) AS speaker_dialect, doc_id % 7 = 0 AS is_multi_speaker, lang = 'fr' AS target FROM documents WHERE lang NOT IN ('es', 'de'))"""


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = ingest.quarantined(ingest.checked_columns(_as_metadata(spark, sf_dir)))
    return bad.select("audio", F.array_join("reasons", ",").alias("reasons"))


def drift_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", T.has_drift(F.col("text"), LATIN_DRIFT).alias("has_drift"))


def drift_arabic_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, DRIFT_CASES, ["id", "text", "expected"]).select("id", T.has_drift(F.col("text")).alias("has_drift"))


DRIFT_CASES = [(1, "عايز أروح السوق", True), (2, "بصراحة الموضوع سهل", False), (3, "ايش هيك؟", True), (4, "(بدي)", False), (5, "عايزْ", True), (6, "", False)]


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(_documents(spark, sf_dir).select("seq", "text")).select(F.col("seq").alias("doc_id"), "is_duplicate")


def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.size(T.shingles(T.canonical(F.col("text")))).cast("long").alias("n_shingles"))


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.exact_duplicates(_documents(spark, sf_dir).select("seq", "text")).where("not is_duplicate")
    return dedup.near_pairs(saved(dedup.shingled(rows)))


def greedy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedupe(_documents(spark, sf_dir), drift=None).select(F.col("seq").alias("doc_id"))


def purge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.purge_counts(_documents(spark, sf_dir), drift=LATIN_DRIFT)


def min_hash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.min_hashes(_documents(spark, sf_dir)).select(F.col("seq").alias("doc_id"), F.array_join("signature", ",").alias("signature"))


def dialogue_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


def dialogue_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON line of each dialogue."""
    pairs = _pairs(spark, sf_dir).withColumn("dialect", F.lit("najdi"))
    return pairs.select("conv_id", "turn", F.to_json(F.struct("user", "assistant", "dialect")).alias("line"))


def lexicon_dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.dispersion(spread(_table(spark, sf_dir, "documents").select("source", "text")), speaker="source")


def _dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), F.concat_ws(" ", "user", "assistant").alias("text"))


def low_dispersion_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.report(_dialogues(spark, sf_dir), lexicon_dispersion(spark, sf_dir))


def flagged_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexicon.flagged(_dialogues(spark, sf_dir), lexicon_dispersion(spark, sf_dir))
    return found.select("seq", F.array_join("tokens", " ").alias("tokens"))


def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label: the labelled ones' anchors are those of finished rows."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", "text", F.col("doc_id").cast("string").alias("speaker_age"), F.col("source").alias("speaker_gender"), F.col("lang").alias("speaker_dialect"), F.lit(False).alias("is_multi_speaker"))
    done = rows.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return resume.todo(rows, resume.anchored(done)).select("doc_id")


def anchors_blake2b(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.tier_a(_valid(spark, sf_dir), accepts=F.lit(True))
    return resume.anchored(rows).select("anchor", "speaker_dialect")


def holdout_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", T.is_holdout_md5(F.col("doc_id"), fraction=0.1).alias("held"))


def holdout_blake2b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", T.is_holdout(F.col("doc_id")).alias("held"))


JSON_CASES = [
    (1, '{"a": 1}', '{"a": 1}'), (2, 'Sure: {"a": {"b": "}"}} done', '{"a": {"b": "}"}}'), (3, '```json\n{"a": 2}\n```', '{"a": 2}'),
    (4, "no object", None), (5, '{"a": 1', None), (6, '{"q": "\\"{"}', '{"q": "\\"{"}'),
]


def extract_json_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, [c[:2] for c in JSON_CASES], ["id", "content"]).select("id", udfs.extract_json(F.col("content")).alias("found"))


def json_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.json_compliance(_table(spark, sf_dir, "events"), text="props")


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spread(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"), "text"))
    talk = _pairs(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"), "user", "assistant")
    return packing.rows_of(raw, talk).select(F.col("kind").cast("int").alias("kind"), "row_idx", F.size(T.words(F.col("text"))).cast("long").alias("length"))


_LENGTHS = f"""(SELECT 0 AS kind, doc_id AS row_idx, len({_sql_words('text')}) AS length FROM documents
UNION ALL SELECT 1, conv_id * 1000 + turn, len({_sql_words('concat("user", $$ $$, assistant)')}) FROM {_PAIRS} p)"""


def pack_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_offsets(_lengths(spark, sf_dir)).select("kind", "row_idx", "length", "start")


def pack_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.summary(_lengths(spark, sf_dir))


def _id_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogues with their words' lengths for ids."""
    ids = F.transform(T.words(F.col("text")), lambda w: F.length(w))
    return _dialogues(spark, sf_dir).select(F.lit(0).alias("kind"), F.col("seq").alias("row_idx"), ids.alias("ids"))


def pack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.batches(_id_rows(spark, sf_dir), 8, 16).select("batch_id", F.col("slot").cast("int").alias("slot"), F.array_join("ids", ",").alias("ids"))


def pack_flat_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.flat_batches(_id_rows(spark, sf_dir), 8, 16).select("batch_id", F.col("slot").cast("int").alias("slot"), F.array_join("ids", ",").alias("ids"))


_IDS = f"""(SELECT seq, list_transform({_sql_words('text')}, lambda w: length(w)) AS ids FROM (SELECT conv_id * 1000 + turn AS seq, concat("user", ' ', assistant) AS text FROM {_PAIRS} p))"""


def equal_length_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.equal_length_batches(_lengths(spark, sf_dir).where("kind = 1"), 4, order="row_idx").select("row_idx", "bucket", "batch_id")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = spread(_table(spark, sf_dir, "documents").select("text")).select(F.explode(T.words(F.col("text"))).alias("token"))
    return each.groupBy("token").agg(F.count("*").alias("n"))


def char_fallback_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, sf_dir).where(T.is_char_fallback(F.col("token")))


def particle_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.particle_ratio(_table(spark, sf_dir, "conversations"), "the ", "of ")


def turn_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far assistants' turns are from the users' before them."""
    return evaluation.error_rates(_pairs(spark, sf_dir), reference="user", hypothesis="assistant").select("char_errors", "chars", "word_errors", "words", "cer", "wer")


def label_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels by language, as a table of accuracies by task."""
    rows = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id").select(F.col("lang").alias("task"), (F.col("quality") == 1).alias("correct"))
    return evaluation.task_accuracy(rows, drop=("es",))


def distill_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.distillation_rows(route_tier_a(spark, sf_dir))
    return rows.select("text", T.user_prompt(*(F.col(c) for c in ("text", *P.DEMOGRAPHICS, "is_multi_speaker"))).alias("prompt"))


def distill_canned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole distillation over the fixture's rows, by a transport without a network."""
    meta = corpus.metadata_fixture(spark).coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    return distill.run(meta, distill.Config(), distill.canned).dialogues


def tokenizer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A public tokenizer's figures over all documents."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.dumps(json.load(f))
    rows = spread(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("line"), "text"))
    return tokenizer.metrics(rows, spec).withColumn("warnings", F.array_join(tokenizer.warnings(), ","))


def event_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(F.explode(F.json_object_keys("props")).alias("key"))
    return events.groupBy("key").agg(F.count("*").alias("n"))


def events_stream_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resumable.event_counts(_table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


def _sql_pairs(threshold: float = P.JACCARD) -> str:
    w = _sql_words("text")
    return f"""u AS MATERIALIZED (SELECT doc_id, text FROM (SELECT doc_id, {_sql_canonical()} AS text, row_number() OVER (PARTITION BY {_sql_canonical()} ORDER BY doc_id) AS k FROM documents) WHERE k = 1),
s AS MATERIALIZED (SELECT doc_id, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM (SELECT doc_id, {w} AS w FROM u) WHERE len(w) >= 6),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
pairs AS MATERIALIZED (SELECT a, b, c / (na + nb - c) AS jaccard FROM (SELECT l.doc_id AS a, r.doc_id AS b, any_value(l.n) AS na, any_value(r.n) AS nb, count(*) AS c FROM e l JOIN e r ON l.x = r.x AND l.doc_id < r.doc_id GROUP BY ALL) WHERE c / (na + nb - c) >= {threshold})"""


_GREEDY = f"""{_sql_pairs()},
later AS MATERIALIZED (SELECT b AS id, list(a) AS near, row_number() OVER (ORDER BY b) AS r FROM pairs GROUP BY b),
g(r, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
  SELECT l.r, CASE WHEN len(list_filter(l.near, lambda x: NOT list_contains(g.gone, x))) > 0 THEN list_append(g.gone, l.id) ELSE g.gone END FROM g JOIN later l ON l.r = g.r + 1)"""


def _sql_events() -> str:
    return "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL"


SQL = {
    "curated_documents": f"""WITH n AS (SELECT doc_id, lang, {_NORMAL} AS text FROM documents), c AS (SELECT *, row_number() OVER (PARTITION BY {_sql_canonical()} ORDER BY doc_id) AS k FROM n WHERE len({_sql_words('text')}) >= 1)
SELECT lang, count(*) AS n_docs, CAST(sum(len({_sql_words('text')})) AS BIGINT) AS n_words, avg(length(text)) AS mean_length FROM c WHERE k = 1 GROUP BY lang""",
    "normalize_documents": f"SELECT doc_id, {_NORMAL} AS normalized FROM documents",
    "normalize_arabic_inline": f"SELECT CAST(id AS BIGINT) AS id, normalized FROM {_sql_values([(i, n) for i, (_, n) in enumerate(NORMAL_CASES)], ['id', 'normalized'])}",
    "route_tier_a": f"SELECT text, speaker_age, speaker_gender, speaker_dialect, is_multi_speaker FROM {_META_SQL} m WHERE is_multi_speaker OR target",
    "route_tier_b": f"SELECT text AS cleaned_text, is_multi_speaker FROM {_META_SQL} m WHERE NOT is_multi_speaker AND target",
    "quarantine_rows": "SELECT concat(source, '/', doc_id) AS audio, CASE lang WHEN 'es' THEN 'empty_cleaned_text,blank_cleaned_text' ELSE 'blank_cleaned_text' END AS reasons FROM documents WHERE lang IN ('es', 'de')",
    "drift_flags": f"SELECT doc_id, regexp_matches(regexp_replace(text, '{P.DEDUP_MARKS}', '', 'g'), '{LATIN_DRIFT}') AS has_drift FROM documents",
    "drift_arabic_inline": f"SELECT CAST(id AS BIGINT) AS id, has_drift FROM {_sql_values([(i, e) for i, _, e in DRIFT_CASES], ['id', 'has_drift'])}",
    "exact_dedup": f"SELECT doc_id, row_number() OVER (PARTITION BY {_sql_canonical()} ORDER BY doc_id) > 1 AS is_duplicate FROM documents",
    "shingle_counts": f"SELECT doc_id, CASE WHEN len(w) >= 6 THEN len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) ELSE 0 END AS n_shingles FROM (SELECT doc_id, {_sql_words(_sql_canonical())} AS w FROM documents)",
    "near_dup_pairs": f"WITH {_sql_pairs()} SELECT a, b, jaccard FROM pairs",
    "greedy_dedup": f"WITH RECURSIVE {_GREEDY}, last AS (SELECT gone FROM g ORDER BY r DESC LIMIT 1) SELECT doc_id FROM u, last WHERE NOT list_contains(gone, doc_id)",
    "dialogue_pairs": f"SELECT * FROM {_PAIRS} p",
    "dialogue_json": f"SELECT conv_id, turn, CAST(json_object('user', \"user\", 'assistant', assistant, 'dialect', 'najdi') AS VARCHAR) AS line FROM {_PAIRS} p",
    "lexicon_dispersion": f"SELECT token, count(DISTINCT source) AS n_speakers FROM (SELECT source, unnest({_sql_lexicon('text')}) AS token FROM documents) GROUP BY token",
    "low_dispersion_tokens": f"""WITH d AS (SELECT token, count(DISTINCT source) AS n FROM (SELECT source, unnest({_sql_lexicon('text')}) AS token FROM documents) GROUP BY token),
t AS (SELECT conv_id, turn, unnest(list_distinct({_sql_lexicon('concat("user", $$ $$, assistant)')})) AS token FROM {_PAIRS} p)
SELECT token, count(*) AS n FROM t LEFT JOIN d USING (token) WHERE coalesce(d.n, 0) < 5 GROUP BY token""",
    "flagged_dialogues": f"""WITH d AS (SELECT token, count(DISTINCT source) AS n FROM (SELECT source, unnest({_sql_lexicon('text')}) AS token FROM documents) GROUP BY token),
p AS (SELECT conv_id * 1000 + turn AS seq, {_sql_lexicon('concat("user", $$ $$, assistant)')} AS w FROM {_PAIRS} p),
t AS (SELECT seq, token, min(i) AS i FROM (SELECT seq, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM p) GROUP BY ALL)
SELECT seq, string_agg(token, ' ' ORDER BY i) AS tokens FROM t LEFT JOIN d USING (token) WHERE coalesce(d.n, 0) < 5 GROUP BY seq""",
    "resume_todo": "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)",
    "holdout_md5": "SELECT doc_id, CAST(concat('0x', md5(concat('42:', doc_id))[1:8]) AS BIGINT) % 10000 < 1000 AS held FROM documents",
    "extract_json_inline": f"SELECT CAST(id AS BIGINT) AS id, found FROM {_sql_values([(i, f) for i, _, f in JSON_CASES], ['id', 'found'])}",
    "json_compliance": "SELECT count(*) AS n, count(*) FILTER (json_valid(props)) AS n_valid, 100.0::DOUBLE * count(*) FILTER (json_valid(props)) / count(*) AS pct FROM events",
    "pack_offsets": f"SELECT kind, row_idx, length, CAST(coalesce(sum(length) OVER (ORDER BY kind, row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM {_LENGTHS} l",
    "pack_summary": f"SELECT count(*) FILTER (kind = 0) AS rows_raw, count(*) FILTER (kind = 1) AS rows_synthetic, CAST(sum(length) AS BIGINT) AS total_tokens FROM {_LENGTHS} l",
    "pack_batches": f"""WITH k AS (SELECT ids, row_number() OVER (ORDER BY seq) - 1 AS k FROM {_IDS} i), n AS (SELECT count(*) AS n FROM k),
r AS (SELECT unnest(range(0, CAST(ceil(n / 8) * 8 AS BIGINT))) AS k FROM n)
SELECT r.k // 8 AS batch_id, CAST(r.k % 8 AS INTEGER) AS slot, array_to_string(list_resize(coalesce(ids, [])[1:16], 16, 0), ',') AS ids FROM r LEFT JOIN k ON k.k = r.k""",
    "pack_flat_batches": f"""WITH e AS (SELECT unnest(ids) AS id, seq, generate_subscripts(ids, 1) AS i FROM {_IDS} i), k AS (SELECT id, row_number() OVER (ORDER BY seq, i) - 1 AS k FROM e), n AS (SELECT count(*) AS n FROM k),
r AS (SELECT unnest(range(0, CAST(ceil(n / 128) * 128 AS BIGINT))) AS k FROM n)
SELECT r.k // 128 AS batch_id, CAST((r.k // 16) % 8 AS INTEGER) AS slot, string_agg(CAST(coalesce(id, 0) AS VARCHAR), ',' ORDER BY r.k) AS ids FROM r LEFT JOIN k ON k.k = r.k GROUP BY ALL""",
    "equal_length_batches": f"SELECT row_idx, length AS bucket, (row_number() OVER (PARTITION BY length ORDER BY row_idx) - 1) // 4 AS batch_id FROM {_LENGTHS} l WHERE kind = 1",
    "token_counts": f"SELECT token, count(*) AS n FROM (SELECT unnest({_sql_words('text')}) AS token FROM documents) GROUP BY token",
    "char_fallback_tokens": f"SELECT token, count(*) AS n FROM (SELECT unnest({_sql_words('text')}) AS token FROM documents) WHERE length(token) = 1 AND NOT list_contains(string_split('{P.CLITICS}', ''), token) GROUP BY token",
    "particle_ratio": "SELECT *, target_hits / (target_hits + other_hits) AS dmpr FROM (SELECT CAST(sum(len(regexp_extract_all(text, 'the '))) AS BIGINT) AS target_hits, CAST(sum(len(regexp_extract_all(text, 'of '))) AS BIGINT) AS other_hits FROM conversations)",
    "label_accuracy": "SELECT lang AS task, count(*) AS n, avg(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM documents JOIN labels USING (doc_id) WHERE lang <> 'es' GROUP BY lang",
    "distill_prompts": f"SELECT text, concat('gender: ', speaker_gender, chr(10), 'age: ', speaker_age, chr(10), 'dialect: ', speaker_dialect, chr(10), 'speakers: ', CASE WHEN is_multi_speaker THEN 'several' ELSE 'one' END, chr(10), 'said: ', text) AS prompt FROM {_META_SQL} m WHERE is_multi_speaker OR target",
    "event_props_json": "SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key",
    "events_stream_agg": _sql_events(),
}

#: DuckDB's levenshtein counts bytes, so turn_error_rates has none either. Tests hold all of these against plain Python.
NO_SQL = (turn_error_rates, purge_report, min_hash_signatures, anchors_blake2b, holdout_blake2b, distill_canned, tokenizer_metrics)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated_documents(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in SQL} | {f.__name__: f for f in NO_SQL}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


__all__ = ["flagship", "oracle_sql", "queries"]
