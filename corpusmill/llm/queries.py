"""The thin queries over whole tables, one per operator; digest columns are derived here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from corpusmill.llm.lm_scoring import score

    return score(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.language_id import identify

    return identify(_table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.pii import personal_data, sha256

    found = personal_data(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", sha256("base").alias("base_sha256"), "spans", "all_email", "all_ip", "all_card", "all_phone")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.suffix_dedup import repeated_bytes

    found = repeated_bytes(_table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.quality import load_labels, quality

    return quality(_table(spark, sf_dir, "documents"), load_labels(spark, sf_dir))


def op6_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.embedding_join import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from corpusmill.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.simhash import hexadecimal, near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexadecimal("fp").alias("fingerprint"), "component_id")


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.syncmers import fingerprinted

    return fingerprinted(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


#: Only this one has an SQL form that ends in reasonable time on whole tables.
SQL = {
    "op6_embedding_join": """
WITH RECURSIVE u AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM u UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), part AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT u.vec_id, coalesce(n_links, 0) AS n_links, component_id, u.vec_id = component_id AS kept
FROM u JOIN part USING (vec_id) LEFT JOIN n USING (vec_id)
""",
}
