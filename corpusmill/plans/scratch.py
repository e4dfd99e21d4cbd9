"""Intermediate tables in the folder that the session names in spark.checkpoint.dir, and tables dealt out for heavy projections."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Up to so many bytes for each core a table is dealt out anew, as its scan may have fewer partitions than there are cores.
SMALL_BYTES = 16 << 20


def folder(spark: SparkSession) -> str:
    """The shared folder; where the session names none, one of this process, which only a local master can use."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir isn't set: intermediate tables need a folder that all executors see")
        at = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: a short lineage that no lost executor breaks."""
    spark = df.sparkSession
    path = f"{folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out over all cores if it is small: a table of one row group is one partition, whatever its size."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(2 * cores) if size <= cores * SMALL_BYTES else df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))
