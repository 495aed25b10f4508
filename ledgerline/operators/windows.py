"""Order-sensitive operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "pos") -> DataFrame:
    """The first k rows of each key, numbered."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k)


def later_repeats(df: DataFrame, key: list[str], order: list[str]) -> Column:
    """Whether a row with the same key came before."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order)) > 1


def islands(df: DataFrame, key: str, order: list[str], state: str) -> DataFrame:
    """Rows at which the state of a key differs from the one before (nulls being equal): starts of periods."""
    w = Window.partitionBy(key).orderBy(*order)
    before = F.lag(state).over(w)
    return df.withColumn("_first", F.row_number().over(w) == 1).withColumn("_before", before).filter(F.col("_first") | ~F.col("_before").eqNullSafe(F.col(state)))


def continuity(df: DataFrame, by: list[str], order: list[str], start: str, end: str) -> Column:
    """How a range follows the one before: first, next, gap or overlap."""
    before = F.lag(end).over(Window.partitionBy(*by).orderBy(*order))
    return F.when(before.isNull(), "first").when(F.col(start) == before + 1, "next").when(F.col(start) > before + 1, "gap").otherwise("overlap")
