"""The corpus pipeline: five stages of training-data preparation, each over all that its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; ``run`` writes each result as Parquet to the shared
folder and reads it again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.llm import common, mixing, packing, pii, quality as quality_model, simhash

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier scores below 0.5.

    A document's score depends on its text alone, so it is decided by the id and the text's hash.
    """
    keyed = docs.select("doc_id", "text")
    stats = common.saved(quality_model.measured(keyed.withColumn("text_key", F.xxhash64("text"))))
    known = quality_model.load_labels(spark, sf_dir).where("quality is not null").groupBy("doc_id").agg(F.round(F.avg("quality")).alias("label"))
    train = common.saved(stats.where(common.in_training("doc_id", 3, 1)).join(known, "doc_id").select("stats", "label"))
    scored = quality_model.scored(stats.select("text_key", "stats"), quality_model.fit(train))
    rejected = scored.where("score < 0.5").select("text_key").distinct()
    return docs.join(rejected, F.xxhash64(docs["text"]) == rejected["text_key"], "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the least doc_id, of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data, plain and disguised, by its kind; n_chars follows."""
    return pii.without_personal_data(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that each source's words come to its target: a row for each copy."""
    # two hashes over a whole row stand for it; hashes pass over nulls, so it is told which columns have none. The row is one
    # column, so that its names clash with none here
    row = [*docs.columns, *(F.isnull(c) for c in docs.columns)]
    keyed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "source", F.xxhash64(*row).alias("h"), F.xxhash64(F.lit(1), *row).alias("g"))
    copies = mixing.mix(keyed, keys=("h", "g")).groupBy("h", "g").agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    found = keyed.select("row", "h", "g").join(copies, ["h", "g"])
    once = found.where("n = 1")
    # equal rows give their copies to one of them
    again = found.where("n > 1").dropDuplicates(["h", "g"])
    every = once.unionByName(again).where("copies > 0")
    return every.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all copies in sequences of at most 2048 tokens, mixed in proportion in every window."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("packing", pack)]

#: The classifier, XXH64 fingerprints and tokenizer have no SQL form: tests/llm/test_stages.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir))
    return docs
