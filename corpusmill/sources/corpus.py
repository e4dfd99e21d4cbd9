"""Text corpora and dialogue files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.functions import patterns as P, text as T, udfs
from corpusmill.operators.packing import with_offsets

_PLACE = ("file", "block", "at")


def placed(rows: DataFrame) -> DataFrame:
    """Rows of a file scan with their place: file, the split's begin in it, the row's rank in the scan."""
    return rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows of ``placed`` with a running number from 0, without gaps, files in order of name; no row leaves the executors."""
    return with_offsets(rows.withColumn("__one", F.lit(1).cast("long")), length="__one", order=_PLACE).withColumnRenamed("start", name).drop("__one", *_PLACE)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, text): all lines of a file or folder with their running number, blank ones too, files in order of name."""
    return numbered(placed(spark.read.text(path)), "line").select("line", F.col("value").alias("text"))


def normalized_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, text) normalised, empty ones left out; numbers are those of the raw lines."""
    return numbered_lines(spark, path).withColumn("text", T.normalized(F.col("text"))).where("text <> ''")


def raw_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(row_idx, text): stripped non-blank lines of a folder's *.txt files, numbered without gaps in order of file and line."""
    kept = placed(spark.read.option("pathGlobFilter", "*.txt").text(folder)).withColumn("text", T.stripped(F.col("value"))).where("text <> ''").drop("value")
    return numbered(kept, "row_idx").select("row_idx", "text")


def dialogues(spark: SparkSession, path: str, *, quarantine: bool = False) -> DataFrame:
    """(user, assistant, dialect) of JSON lines, blank lines skipped. Any line that isn't strictly a dialogue (malformed, other
    or repeated keys, values that aren't strings, empty turns, another dialect) fails the job, or is left out with ``quarantine``."""
    return _dialogues(spark.read.text(path), quarantine).select("user", "assistant", "dialect")


def numbered_dialogues(spark: SparkSession, path: str) -> DataFrame:
    """(row_idx, user, assistant, dialect) of JSON lines in order of file and line, numbered without gaps."""
    return numbered(_dialogues(placed(spark.read.text(path)), False, *_PLACE), "row_idx").select("row_idx", "user", "assistant", "dialect")


def _dialogues(lines: DataFrame, quarantine: bool, *keep: str) -> DataFrame:
    rows = lines.where(T.stripped(F.col("value")) != "").select(*keep, udfs.dialogue(F.col("value")).alias("d"))
    if quarantine:
        return rows.where("d.problem is null").select(*keep, "d.*")
    fail = F.raise_error(F.concat(F.lit("invalid dialogue line: "), F.col("d.problem"))).cast("string")
    return rows.select(*keep, F.when(F.col("d.problem").isNull(), F.col("d.user")).otherwise(fail).alias("user"), "d.assistant", "d.dialect")


def append_dialogues(df: DataFrame, path: str) -> None:
    """Appends JSON lines with the keys user, assistant, dialect in this order; characters stay as they are."""
    df.select(F.to_json(F.struct("user", "assistant", "dialect")).alias("value")).write.mode("append").text(path)


def metadata_fixture(spark: SparkSession, *, rows: int = 45) -> DataFrame:
    """A small table of speech metadata, all by rule from a row's number: three dialects by turns, each sentence said by as
    many speakers as rows allow, and several speakers in every 9th row, marked in one column after the other."""
    who, does, what = ("ابوي", "خالتي", "جارنا"), ("يدور", "نسى", "شرى", "باع", "جاب"), ("مفتاح الباب", "دلة قديمة", "كيس رز")
    out = []
    for i in range(rows):
        said = f"{who[i % 3]} {does[i % 5]} {what[i // 3 % 3]}"
        person = [("Adult", "Child", "Elderly")[i // 2 % 3], ("Female", "Male")[i % 2], ("Hijazi", "Najdi", "Southern")[i // 5 % 3]]
        if i % 9 == 8:
            person[i // 9 % 3] = P.MULTI_SPEAKER
        out.append((f"clips/{i // 4}-{i % 4}.flac", said, said, *person))
    return spark.createDataFrame(out, ", ".join(f"{c} string" for c in P.METADATA_COLUMNS))
