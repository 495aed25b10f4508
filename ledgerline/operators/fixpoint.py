"""Rounds of one plan each until nothing changes; between them rows go to the folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir, which Hadoop removes when the driver ends.

    Where that is unset and driver and executors are one machine, in a temporary folder; elsewhere it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
    path = f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def settled(df: DataFrame, name: str = "round") -> DataFrame:
    """`df` written and read again: its lineage is cut, and neither constraints nor plans grow with the rounds."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of input, as Spark estimates them, for which shares() gives a task.
_SHARE = 1 << 22


def shares(df: DataFrame) -> int:
    """Over how many tasks to deal `df`: all shuffle partitions, and more where it is large, so that no task grows with it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // _SHARE), 10_000)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """`df` dealt by columns over all shuffle partitions, however few tasks read it and however small it is.

    For rows that become far more, or cost far more, than their size in files shows; Spark alone would merge them into few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
