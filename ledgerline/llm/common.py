"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset: a temporary folder if driver and executors are one machine (a local master), else a folder of
    the default file system, which has to be one that all machines see.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
        else:
            files = context._jvm.org.apache.hadoop.fs.FileSystem.get(context._jsc.hadoopConfiguration())
            if files.getScheme() == "file":
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            context.setCheckpointDir(f"{files.getHomeDirectory().toString()}/ledgerline")
    return context.getCheckpointDir()


#: Paths that new_path gave within each open scratch().
_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what operators wrote to the shared folder within it; results that need that must have been written before."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            remove(spark, path)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; Hadoop removes it when the driver ends, or scratch() before."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path that new_path gave, once nothing reads it any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts the lineage and outlives executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores appended where `df` has such columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def all_columns(df: DataFrame) -> list[Column]:
    """The columns of `df` for a select, whatever dots and backticks their names have."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def _is_scan(df: DataFrame) -> bool:
    """Whether `df` is nothing but a scan of files."""
    plan = df._jdf.queryExecution().analyzed()
    return plan.getClass().getSimpleName() == "LogicalRelation" and "HadoopFsRelation" in plan.relation().getClass().getName()


def numbered_rows(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """The name of a column that tells each row from all others, and `df` with it, a struct of two longs.

    It is the hash of the row's file and its place in that file, so each pass over the table gives the same. A table
    that isn't a scan of files is written first.
    """
    row = free_names(df, name)[0]
    scan = df if _is_scan(df) else written(df, "staged")
    of_file = scan.metadataColumn("_metadata")  # also where the table has a column of that name
    place = F.struct(F.xxhash64(of_file["file_path"]).alias("file"), of_file["row_index"].alias("at"))
    return row, scan.withColumn(row, place)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by the first column."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        group = batch.column(0).to_numpy()
        changes = np.flatnonzero(group[1:] != group[:-1])
        if held is not None and group[0] != held.column(0)[-1].as_py():
            yield held
            held = None
        if held is not None and not len(changes):
            held = pa.concat_tables([held, table])
            continue
        last = int(changes[-1]) + 1 if len(changes) else 0
        if last:
            yield (pa.concat_tables([held, table.slice(0, last)]) if held is not None else table.slice(0, last)).combine_chunks()
            held = None
        held = table.slice(last)
    if held is not None:
        yield held.combine_chunks()


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
