"""What was done before: anchors of finished rows, and the rows that are left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.functions import patterns as P, text as T
from corpusmill.plans.scratch import exists


def anchored(rows: DataFrame) -> DataFrame:
    """``rows`` with column anchor."""
    return rows.withColumn("anchor", T.anchor(*(F.col(c) for c in ("text", *P.DEMOGRAPHICS, "is_multi_speaker"))))


def load(spark: SparkSession, path: str) -> DataFrame:
    """Distinct anchors of a folder of text files; a path that doesn't exist has none, blank lines don't count."""
    if not exists(spark, path):
        return spark.createDataFrame([], "anchor string")
    lines = spark.read.text(path)
    return lines.select(F.trim("value").alias("anchor")).where("anchor <> ''").distinct()


def mark(rows: DataFrame, path: str) -> None:
    """Appends the anchors of finished rows."""
    rows.select("anchor").write.mode("append").text(path)


def todo(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Rows whose anchor isn't known. Anchors may be many: Spark broadcasts them only if they are few."""
    return anchored(rows).join(anchors.select("anchor").distinct(), "anchor", "left_anti").drop("anchor")
