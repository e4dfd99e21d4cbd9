"""Rates on model outputs, and batching for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusmill.functions import text as T, udfs


def particle_ratio(df: DataFrame, target: str, other: str, *, text: str = "text") -> DataFrame:
    """One row: target_hits, other_hits, dmpr = target / (target + other), for two patterns."""
    hits = df.agg(F.coalesce(F.sum(F.regexp_count(text, F.lit(target))), F.lit(0)).alias("target_hits"), F.coalesce(F.sum(F.regexp_count(text, F.lit(other))), F.lit(0)).alias("other_hits"))
    return hits.withColumn("dmpr", T.ratio(F.col("target_hits"), F.col("target_hits") + F.col("other_hits")))


def json_compliance(df: DataFrame, *, text: str = "text") -> DataFrame:
    """One row: n, n_valid and pct of texts that parse strictly as JSON."""
    counts = df.agg(F.count("*").alias("n"), F.count_if(udfs.is_json(F.col(text))).alias("n_valid"))
    return counts.withColumn("pct", T.ratio(F.col("n_valid"), F.col("n"), 100.0))


def error_rates(df: DataFrame, *, reference: str = "reference", hypothesis: str = "hypothesis") -> DataFrame:
    """One row: character and word error rates over all pairs."""
    r, h = F.col(reference), F.col(hypothesis)
    sums = df.agg(F.sum(F.levenshtein(r, h)).alias("char_errors"), F.sum(F.length(r)).alias("chars"), F.sum(udfs.word_errors(r, h)).alias("word_errors"), F.sum(F.size(T.words(r))).alias("words"))
    return sums.withColumn("cer", T.ratio(F.col("char_errors"), F.col("chars"))).withColumn("wer", T.ratio(F.col("word_errors"), F.col("words")))


def real_time_factor(work_seconds: Column, audio_seconds: Column) -> Column:
    return T.ratio(work_seconds, audio_seconds)


def masked_targets(ids: Column, user_length: Column, ignore: int = -100) -> Column:
    """Targets with ``ignore`` on the user's tokens."""
    return F.transform(ids, lambda x, i: F.when(i < user_length, ignore).otherwise(x))


def equal_length_batches(df: DataFrame, batch_size: int, *, length: str = "length", order: str = "seq") -> DataFrame:
    """``df`` with bucket (the length) and batch_id: rows of one length in batches of ``batch_size``, in order."""
    k = F.row_number().over(W.partitionBy(length).orderBy(order)) - 1
    return df.withColumn("bucket", F.col(length)).withColumn("batch_id", F.floor(k / batch_size))


def task_accuracy(df: DataFrame, *, drop: tuple[str, ...] = (), task: str = "task", correct: str = "correct") -> DataFrame:
    return df.where(~F.col(task).isin(*drop)).groupBy(task).agg(F.count("*").alias("n"), F.avg(F.col(correct).cast("double")).alias("accuracy"))
