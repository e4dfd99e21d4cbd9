"""What several training-data operators share: scratch tables, blocks, components.

Scratch tables are Parquet folders below ``spark.checkpoint.dir``, which every executor sees; where the
session has no such setting and its master is local (tests, a laptop), a folder of this process is set and removed at exit.
"""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of a stored table that one block of documents should hold.
BLOCK_BYTES = 4 << 20
#: Estimates from here on mean that nothing is known.
UNKNOWN_BYTES = 1 << 55
#: Rows of an Arrow batch: documents may be long, so batches are short.
BATCH_ROWS = 500


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from the session's ``spark.checkpoint.dir``."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir isn't set: intermediate tables need a folder that all executors see")
        at = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def saved(df: DataFrame, *, compression: str = "snappy") -> DataFrame:
    """``df`` as a table written to the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    at = f"{scratch_dir(spark)}/table-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", compression).parquet(at)
    out = spark.read.schema(schema).parquet(at)
    out._written_at = at
    return out


def forget(table: DataFrame) -> None:
    """Deletes a table that ``saved`` wrote and nothing needs any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the table's bytes; where it has none (rows of an RDD), they are measured.

    It sizes partitions only and never decides results.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < UNKNOWN_BYTES:
        return size
    width = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() == "string" else F.lit(8) for f in df.schema), F.lit(0))
    return int(df.agg(F.sum(width)).first()[0] or 0)


def n_blocks(df: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks for a table, in proportion to its size and at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(1 << 20, math.ceil(table_bytes(df) / block_bytes)))


def in_training(doc_id: Column | str, modulus: int, held: int) -> Column:
    """True if crc32(doc_id as text) mod ``modulus`` is not ``held``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))) % modulus != held


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, component = smallest node).

    Alternating large-star and small-star rounds over a written edge table, until nothing changes; each round is two
    aggregations whose hot nodes are pre-aggregated and whose joins Spark may split. A round's tables are deleted
    after the next. Nodes without an edge do not appear. An empty table gives an empty one. Null ends are ignored.
    """
    e = saved(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while True:
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = saved(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        forget(e)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v")
        e = saved(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        forget(large)
    return e.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
