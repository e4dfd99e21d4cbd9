"""Mixture-controlled packing into sequences of at most 2048 tokens.

Every source is a queue of its documents' ids. Deficit round-robin serves the queues in quanta of 256 tokens so
that every window of 2048 holds the target token proportions to within a quantum per source; what a source is
owed is carried to the next window. The schedule is computed without walking the windows: the u-th quantum of a
source with target weight w falls due at (u + 1/2) / w, and the quanta in order of their due times are the
round-robin's. Due times are global, so deficits carry over partitions as over windows.

Quanta are cut while a partition tokenizes, so no ids are stored: a partition's queue of a source is cut into
whole quanta and a rest of less than one, which is cut into powers of two. Rests follow the quanta, larger ones
first and those of one size in turn by source: powers of two in falling order fill every window to its end. What is left at the very end is cut into
sequences whose lengths are powers of two, so no sequence needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusmill.llm.common import saved, short_batches
from corpusmill.llm.tokens import gathered, tokenizer

WINDOW = 2048
QUANTUM = 256
END_ID = 1

_PIECES = "doc_id long, source string, start long, length int, ids_crc32 long, doc_tokens long, pid int, item long, size int, at int"


def _cutter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of each document; ``item`` numbers the quanta and rests of this partition."""
        from pyspark import TaskContext

        context = TaskContext.get()
        pid = context.partitionId() if context else 0
        bpe = tokenizer(path)
        open_: dict[str | None, list] = {}  # source -> [item, filled, the rows of the open quantum and their ids]
        items = 0
        out: list[tuple] = []

        def record() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 9
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string())] + [pa.array(cols[i], t) for i, t in ((2, pa.int64()), (3, pa.int32()), (4, pa.int64()), (5, pa.int64()))]
            arrays += [pa.array([pid] * len(out), pa.int32())] + [pa.array(cols[i], t) for i, t in ((6, pa.int64()), (7, pa.int32()), (8, pa.int32()))]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "pid", "item", "size", "at"])

        for b in gathered(batches, "text"):
            texts = b.column(2).fill_null("")
            ids, starts = bpe.encode(texts)
            for doc_id, source, lo, hi in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                data, total, done = ids[lo:hi].tobytes() + END_ID.to_bytes(4, "little"), hi - lo + 1, 0
                held = open_.setdefault(source, [items, 0, []])
                if not held[2] and not held[1]:
                    held[0], items = items, items + 1
                while done < total:
                    n = min(QUANTUM - held[1], total - done)
                    part = data[4 * done : 4 * (done + n)]
                    held[2].append((doc_id, source, done, n, part, total))
                    held[1], done = held[1] + n, done + n
                    if held[1] == QUANTUM:
                        at = 0
                        for d, s, start, size, p, t in held[2]:
                            out.append((d, s, start, size, zlib.crc32(p), t, held[0], QUANTUM, at))
                            at += size
                        held[:] = [items, 0, []]
                        if done < total:
                            items += 1
            yield record()
        for held in open_.values():
            if not held[1]:
                continue
            cuts = [1 << i for i in reversed(range(QUANTUM.bit_length())) if held[1] >> i & 1]
            k, at = 0, 0
            item, items = items, items + 1
            for d, s, start, size, p, t in held[2]:
                while size:
                    n = min(cuts[k] - at, size)
                    out.append((d, s, start, n, zlib.crc32(p[: 4 * n]), t, item, cuts[k], at))
                    start, size, p, at = start + n, size - n, p[4 * n :], at + n
                    if at == cuts[k]:
                        k, at = k + 1, 0
                        if k < len(cuts):
                            item, items = items, items + 1
        yield record()

    return run


def _ranked(df: DataFrame, order: list[Column], size: Column | None, name: str) -> DataFrame:
    """``df`` with the running total of ``size`` (rows: None) before each row in the global order of ``order``.

    Range partitions are written first; then each gets the total of those before it. No row goes through one task.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = saved(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    size = F.lit(1).cast("long") if size is None else size
    sums = ranged.groupBy("__part").agg(F.sum(size).alias("__sum"))
    before = sums.select("__part", (F.sum("__sum").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__sum")).alias("__before"))
    inside = F.sum(size).over(W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)) - size
    # `before` has one row for each range partition: its size is bounded by the session's shuffle partitions
    return ranged.withColumn("__in", inside).join(F.broadcast(before), "__part").withColumn(name, F.col("__in") + F.col("__before")).drop("__part", "__in", "__before")


def pack(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    A document is its text's ids and one end id (1); a null or empty text is the end id alone. Every id lies in
    exactly one piece; sequences are full (2048) but for the last ones, whose lengths are powers of two. Sources
    (null is one) get windows in proportion to ``weights`` (source, weight; a source that has none weighs 1, one of weight
    0 or less comes after all others) or, without, to their tokens; a source that runs out leaves its share to the others. Repeated rows and ids are packed as often as they occur; null ids
    are kept. An empty table gives no pieces.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    pieces = saved(rows.mapInArrow(_cutter(tokenizer_path), _PIECES))
    item = pieces.where("at = 0").select("source", "pid", "item", "size")
    quanta = item.where(F.col("size") == QUANTUM)
    # the number of a quantum in its source's queue: those of earlier partitions, then those of its own
    here = quanta.groupBy("source", "pid").agg(F.count("*").alias("n"))
    here = here.withColumn("first", F.sum("n").over(W.partitionBy("source").orderBy("pid").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n"))
    total = here.groupBy("source").agg(F.sum("n").alias("w"))
    if weights is not None:
        total = total.drop("w").join(weights.select(F.col("source").alias("__s"), F.col("weight").cast("double").alias("w")), F.col("source").eqNullSafe(F.col("__s")), "left").select("source", F.coalesce("w", F.lit(1.0)).alias("w"))
    here = here.join(total.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).select("source", "pid", "first", "w")
    own = F.row_number().over(W.partitionBy("source", "pid").orderBy("item")) - 1
    place = F.col("first") + F.col("own") + 0.5
    due = F.when(F.col("w") > 0, place / F.when(F.col("w") > 0, F.col("w"))).otherwise(float("inf"))
    key = F.struct(F.coalesce("source", F.lit("")).alias("s"), "pid", "item")
    quanta = quanta.withColumn("own", own).withColumnRenamed("source", "__s").withColumnRenamed("pid", "__p")
    quanta = quanta.join(here, F.col("__p").eqNullSafe(F.col("pid")) & F.col("__s").eqNullSafe(F.col("source"))).select("source", "pid", "item", "size", due.alias("due"))
    # rests of one size are served in turn as well: a source's k-th of n falls due at (k - 1/2) / n; one a partition at most
    alike = W.partitionBy("source", "size")
    turn = (F.row_number().over(alike.orderBy("pid", "item")) - 0.5) / F.count("*").over(alike)
    rests = item.where(F.col("size") < QUANTUM).select("source", "pid", "item", "size", turn.alias("due"))
    placed = _ranked(quanta.unionByName(rests).select("pid", "item", "size", "due", key.alias("k")), [F.desc("size"), F.col("due"), F.col("k")], F.col("size").cast("long"), "position")
    placed = placed.select(F.col("pid").alias("__p"), F.col("item").alias("__i"), "position")
    whole = item.agg(F.sum("size").cast("long").alias("all_tokens"))
    # one row: the number of all tokens
    out = pieces.join(placed, (F.col("pid") == F.col("__p")) & (F.col("item") == F.col("__i"))).join(F.broadcast(whole))
    out = out.withColumn("p", F.col("position") + F.col("at")).withColumn("full", F.floor(F.col("all_tokens") / WINDOW))
    out = out.withColumn("inner", F.col("p") - F.col("full") * WINDOW).withColumn("rest", F.col("all_tokens") - F.col("full") * WINDOW)
    # the tail has a sequence for each set bit of its length, the highest first; a position lies in that of the
    # highest bit in which it differs from the length
    out = out.withColumn("above", F.expr("cast(floor(log2(greatest(rest ^ inner, 1))) as int) + 1"))
    out = out.withColumn("before", F.expr("shiftleft(shiftright(rest, above), above)"))
    last = F.col("p") >= F.col("full") * WINDOW
    return out.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        F.when(last, F.col("full") + F.bit_count("before")).otherwise(F.floor(F.col("p") / WINDOW)).cast("long").alias("sequence_id"),
        F.when(last, F.col("inner") - F.col("before")).otherwise(F.pmod("p", F.lit(WINDOW))).cast("long").alias("offset"), "source",
    )
