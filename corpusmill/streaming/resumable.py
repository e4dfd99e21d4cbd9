"""Structured Streaming: dialogues curated as they arrive, exactly once, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.functions import text as T
from corpusmill.operators import dedup
from corpusmill.plans.scratch import exists, saved


def curated(stream: DataFrame, out: str, checkpoint: str, *, text: str = "text", order: str = "seq", anchors: DataFrame | None = None, anchor: str = "anchor") -> StreamingQuery:
    """Appends to ``out`` the rows of each micro-batch that repeat, exactly or nearly, neither one another nor what is there.

    Rows whose ``anchor`` is among ``anchors`` were finished before and are left out. A batch that runs again after a
    failure doesn't see its own rows and overwrites its own folder, so results are exactly once.
    """

    def step(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        if anchors is not None:
            df = df.join(anchors.select(F.col(anchor).alias("__done")).distinct(), F.col(anchor) == F.col("__done"), "left_anti")
        new = saved(df.withColumn("canonical", T.canonical(F.col(text))))
        if exists(spark, out):
            seen = spark.read.parquet(out).where(F.col("batch") != batch)
            new = saved(new.join(seen.select(F.col("canonical").alias("__seen")), F.col("canonical") == F.col("__seen"), "left_anti"))
            # what was kept earlier comes first, so a pair's first row is an earlier one if either is
            both = seen.select(F.struct(F.lit(0).alias("new"), F.col(order).alias("k")).alias("at"), "canonical").unionByName(new.select(F.struct(F.lit(1).alias("new"), F.col(order).alias("k")).alias("at"), "canonical"))
            near = dedup.near_pairs(saved(dedup.shingled(both, text="canonical", order="at")), order="at").where("a.new = 0 and b.new = 1")
            new = new.join(near.select(F.col("b.k").alias("__near")).distinct(), F.col(order) == F.col("__near"), "left_anti")
        dedup.dedupe(new, text=text, order=order).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_in_window(stream: DataFrame, *, text: str = "text", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first row of each canonical text, with state that is dropped after ``delay``."""
    return stream.withColumns({"canonical": T.canonical(F.col(text)), time: F.col(time).cast("timestamp")}).withWatermark(time, delay).dropDuplicatesWithinWatermark(["canonical"])


def event_counts(events: DataFrame, *, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(window_start, event_type, n, total) of a table or stream of events (ts, event_type, value)."""
    # watermarks need an instant; tables may hold times without a zone
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay) if events.isStreaming else events
    out = rows.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def replayed(spark: SparkSession, folder: str, name: str, *, window: str = "1 hour") -> DataFrame:
    """``event_counts`` of a folder's Parquet files, run as a stream to its end."""
    schema = spark.read.parquet(folder).schema
    query = event_counts(spark.readStream.schema(schema).parquet(folder), window=window).writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)
