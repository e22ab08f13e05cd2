"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's checkpoint folder. Where both are unset, a temporary folder in local mode (as in tests) and an error on a cluster, whose machines share no local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='tagloom-')}")
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/tagloom/{label}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def staged(df: DataFrame, label: str = "t") -> DataFrame:
    """df written as Parquet and read back; the lineage ends there, and lost executors take nothing with them."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged(df: DataFrame) -> DataFrame:
    """df for a join in which it grows with the tables: met by a sort-merge join. Shuffled columns of ids take a small part of their size in memory, so
    a side that looks small enough to be sent to all can be a hundred MB on the driver, which holds it."""
    return df.hint("merge")
