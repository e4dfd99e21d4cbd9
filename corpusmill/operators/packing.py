"""Flat token streams: checks on ids, contiguous offsets in a global order, and batches of a fixed shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from corpusmill.functions import patterns as P, text as T, udfs
from corpusmill.plans.scratch import saved


class PackingError(RuntimeError):
    """A row's ids can't be packed."""


def rows_of(raw: DataFrame, synthetic: DataFrame) -> DataFrame:
    """(kind, row_idx, text): raw lines (row_idx, text) first, then dialogues (row_idx, user, assistant)."""
    talk = synthetic.select(F.lit(P.KIND_SYNTHETIC).cast("byte").alias("kind"), "row_idx", F.concat_ws(" ", "user", "assistant").alias("text"))
    return raw.select(F.lit(P.KIND_RAW).cast("byte").alias("kind"), "row_idx", "text").unionByName(talk)


def encoded(rows: DataFrame, spec: str) -> DataFrame:
    """``rows`` with ids; a text that normalises to nothing has none and keeps its row."""
    return rows.withColumn("ids", udfs.encoded(T.normalized(F.col("text")), spec))


def gated(rows: DataFrame, bad_ids: list[int], vocabulary: int, *, quarantine: bool = False) -> DataFrame:
    """Rows whose ids lie in the vocabulary and hold neither the unknown id nor one of ``bad_ids``.

    Others fail the job, or with ``quarantine`` are left out (``rejected`` has them). The gate holds for both kinds.
    """
    bad = _bad(bad_ids, vocabulary)
    if quarantine:
        return rows.where(~bad)
    fail = F.raise_error(F.concat(F.lit("row "), F.col("row_idx").cast("string"), F.lit(" holds ids that can't be packed")))
    return rows.withColumn("ids", F.when(bad, fail.cast("array<int>")).otherwise(F.col("ids")))


def rejected(rows: DataFrame, bad_ids: list[int], vocabulary: int) -> DataFrame:
    return rows.where(_bad(bad_ids, vocabulary))


def _bad(bad_ids: list[int], vocabulary: int) -> F.Column:
    odd = F.array(F.lit(P.UNK_ID), *(F.lit(i) for i in bad_ids))
    return F.exists("ids", lambda i: (i < 0) | (i >= min(vocabulary, P.UINT16_MAX + 1)) | F.array_contains(odd, i))


def with_offsets(rows: DataFrame, *, length: str = "length", order: tuple[str, ...] = ("kind", "row_idx")) -> DataFrame:
    """``rows`` with start: the total of ``length`` over all rows before in the global order.

    Rows are range-partitioned by the order; each partition sums its own, and partitions start at the totals of those before.
    Only one number for each partition is broadcast.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = saved(rows.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    sums = ranged.groupBy("__part").agg(F.sum(length).alias("__n"))
    before = sums.select("__part", (F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")).alias("__before"))
    own = F.sum(length).over(W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col(length)
    return ranged.withColumn("__own", own).join(F.broadcast(before), "__part").withColumn("start", F.col("__own") + F.col("__before")).drop("__part", "__own", "__before")


def summary(index: DataFrame) -> DataFrame:
    """One row: rows and tokens of an index, by kind."""
    raw = F.col("kind") == P.KIND_RAW
    return index.agg(F.count_if(raw).alias("rows_raw"), F.count_if(~raw).alias("rows_synthetic"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_tokens"))


def batches(rows: DataFrame, batch_size: int, seq_len: int, *, pad: int = 0, kinds: tuple[int, ...] | None = None, skip_rows: int = 0) -> DataFrame:
    """(batch_id, slot, ids): rows in order, cut or padded to ``seq_len``; the last batch is filled with rows of ``pad``."""
    if batch_size < 1 or seq_len < 1 or skip_rows < 0:
        raise ValueError("batch_size and seq_len must be at least 1, skip_rows at least 0")
    kept = rows if kinds is None else rows.where(F.col("kind").isin(*kinds))
    numbered = with_offsets(kept.withColumn("__one", F.lit(1).cast("long")), length="__one").withColumn("k", F.col("start") - skip_rows).where("k >= 0")
    out = numbered.select(F.floor(F.col("k") / batch_size).alias("batch_id"), (F.col("k") % batch_size).cast("int").alias("slot"), T.padded(F.col("ids"), seq_len, pad).alias("ids"))
    last = out.agg(F.max(F.struct("batch_id", "slot")).alias("m")).where("m is not null").select(F.col("m.batch_id").alias("batch_id"), F.explode(F.sequence(F.col("m.slot") + 1, F.lit(batch_size))).alias("slot")).where(F.col("slot") < batch_size)
    return out.unionByName(last.select("batch_id", "slot", F.array_repeat(F.lit(pad), seq_len).alias("ids")))


def flat_batches(rows: DataFrame, batch_size: int, seq_len: int, *, pad: int = 0, offset: int = 0) -> DataFrame:
    """(batch_id, slot, ids): the ids of all rows as one stream from element ``offset`` on, in lines of ``seq_len``; the end is padded."""
    if batch_size < 1 or seq_len < 1 or offset < 0:
        raise ValueError("batch_size and seq_len must be at least 1, offset at least 0")
    placed = with_offsets(rows.withColumn("length", F.size("ids").cast("long"))).where("length > 0").withColumn("at", F.col("start") - offset).where(F.col("at") + F.col("length") > 0)
    first, last = F.floor(F.greatest("at", F.lit(0)) / seq_len), F.floor((F.col("at") + F.col("length") - 1) / seq_len)
    parts = placed.select("ids", "at", F.explode(F.sequence(first, last)).alias("row"))
    lo = F.greatest(F.col("row") * seq_len - F.col("at"), F.lit(0), -F.col("at"))
    start = F.col("at") + lo
    hi = F.least(F.size("ids"), (F.col("row") + 1) * seq_len - F.col("at"))
    parts = parts.select("row", start.alias("start"), F.slice("ids", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("ids"))
    lines = parts.groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "ids"))), lambda s: s["ids"])).alias("ids"))
    out = lines.select(F.floor(F.col("row") / batch_size).alias("batch_id"), (F.col("row") % batch_size).cast("int").alias("slot"), T.padded(F.col("ids"), seq_len, pad).alias("ids"))
    last = out.agg(F.max(F.struct("batch_id", "slot")).alias("m")).where("m is not null").select(F.col("m.batch_id").alias("batch_id"), F.explode(F.sequence(F.col("m.slot") + 1, F.lit(batch_size))).alias("slot")).where(F.col("slot") < batch_size)
    return out.unionByName(last.select("batch_id", "slot", F.array_repeat(F.lit(pad), seq_len).alias("ids")))
