"""Reading, checking and routing speech metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.functions import patterns as P, text as T

SCHEMA = StructType([StructField(c, StringType()) for c in P.METADATA_COLUMNS])


class SchemaError(ValueError):
    """The table's columns are not those of the contract."""


def checked_columns(df: DataFrame, expected: tuple[str, ...] = P.METADATA_COLUMNS) -> DataFrame:
    """``df`` in the contract's column order; extra, missing or non-string columns raise."""
    extra, missing = set(df.columns) - set(expected), set(expected) - set(df.columns)
    other = [c for c in expected if c in df.columns and df.schema[c].dataType != StringType()]
    if extra or missing or other:
        raise SchemaError(f"extra columns {sorted(extra)}, missing {sorted(missing)}, not strings {other}")
    return df.select(*expected)


def read_metadata(spark: SparkSession, path: str, *, chunk_size: int = 10_000) -> DataFrame:
    """Metadata from Parquet, columns checked. ``chunk_size`` must be positive and has no other effect: scans are split by Spark."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    return checked_columns(spark.read.parquet(path))


def violations() -> Column:
    """What is wrong with a row: an array of reasons, empty for valid rows. Length is judged before blanks are stripped."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in P.METADATA_COLUMNS]
    empty = [F.when(F.col(c) == "", F.lit(f"empty_{c}")) for c in ("text", "cleaned_text")]
    return F.array_compact(F.array(*missing, *empty))


def validated(df: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid rows with texts stripped, after columns ``keep``; the first invalid row fails the job."""
    bad = violations()
    fail = F.raise_error(F.concat(F.lit("invalid metadata row: "), F.array_join(bad, ",")))
    guard = lambda c: F.when(F.size(bad) > 0, fail).otherwise(F.col(c)).cast("string")
    return df.select(*keep, *(T.stripped(guard(c)).alias(c) if c in ("text", "cleaned_text") else guard(c).alias(c) for c in P.METADATA_COLUMNS))


def quarantined(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows with texts stripped, invalid rows with their ``reasons``); blank texts are a reason of their own."""
    blank = F.array_compact(F.array(*(F.when(T.stripped(F.col(c)) == "", F.lit(f"blank_{c}")) for c in ("text", "cleaned_text"))))
    marked = df.withColumn("reasons", F.array_union(violations(), blank))
    good = marked.where(F.size("reasons") == 0).drop("reasons")
    return good.withColumns({c: T.stripped(F.col(c)) for c in ("text", "cleaned_text")}), marked.where(F.size("reasons") > 0)


def _flags(df: DataFrame, accepts: Column | None) -> DataFrame:
    target = T.is_target_dialect(F.col("speaker_dialect")) if accepts is None else accepts
    return df.withColumn("is_multi_speaker", T.is_multi_speaker(*(F.col(c) for c in P.DEMOGRAPHICS))).withColumn("__target", target)


def tier_a(df: DataFrame, *, accepts: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of several speakers or of a target dialect: columns ``keep``, text, demographics, is_multi_speaker."""
    return _flags(df, accepts).where("is_multi_speaker or __target").select(*keep, "text", *P.DEMOGRAPHICS, "is_multi_speaker")


def tier_b(df: DataFrame, *, accepts: Column | None = None, quarantine: bool = False) -> DataFrame:
    """Rows of one speaker and a target dialect: cleaned_text, is_multi_speaker.

    A text that isn't clean fails the job; with ``quarantine`` it is left out (``tier_b_rejects`` has it).
    """
    kept = _flags(df, accepts).where("not is_multi_speaker and __target")
    clean = T.is_clean(F.col("cleaned_text"))
    if quarantine:
        return kept.where(clean).select("cleaned_text", "is_multi_speaker")
    text = F.when(clean, F.col("cleaned_text")).otherwise(F.raise_error(F.concat(F.lit("text is not clean: "), F.col("cleaned_text"))).cast("string"))
    return kept.select(text.alias("cleaned_text"), "is_multi_speaker")


def tier_b_rejects(df: DataFrame, *, accepts: Column | None = None) -> DataFrame:
    return _flags(df, accepts).where("not is_multi_speaker and __target").where(~T.is_clean(F.col("cleaned_text"))).select("cleaned_text", "is_multi_speaker")


def distillation_rows(routed: DataFrame, *, max_rows: int = 0, order: str = "seq") -> DataFrame:
    """Tier A rows as input for distillation, texts stripped; the first ``max_rows`` by ``order`` if it isn't 0."""
    out = routed.withColumn("text", T.stripped(F.col("text")))
    return out.orderBy(order).limit(max_rows) if max_rows else out
