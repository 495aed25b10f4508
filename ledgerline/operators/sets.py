"""Set operators and deduplication with a defined survivor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_best(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row of each key: the first by a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")


def unordered_key(date: Column, a: Column, goals_a: Column, b: Column, goals_b: Column) -> Column:
    """The same text whichever side comes first."""
    ends = F.array_sort(F.array(F.concat_ws(":", a, goals_a.cast("string")), F.concat_ws(":", b, goals_b.cast("string"))))
    return F.concat_ws("|", date, ends[0], ends[1])


def compare_sets(left: DataFrame, right: DataFrame, by: list[str], key: str) -> DataFrame:
    """For each group: distinct keys on either side, shared ones, those on one side only, and whether the sets agree."""
    one = left.select(*by, key).withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0))
    two = right.select(*by, key).withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    flags = one.unionByName(two).groupBy(*by, key).agg(F.max("_l").alias("l"), F.max("_r").alias("r"))
    total = lambda x: F.sum(x.cast("long"))
    l, r = F.col("l") == 1, F.col("r") == 1  # noqa: E741
    return flags.groupBy(*by).agg(total(l).alias("n_left"), total(r).alias("n_right"), total(l & r).alias("n_shared"), total(l & ~r).alias("only_left"), total(~l & r).alias("only_right")).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def conflicts(df: DataFrame, key: list[str], content: Column) -> DataFrame:
    """For each key: rows, and distinct contents; more than one is a conflict, one is a repeat that collapses."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows"), F.count_distinct(content).alias("n_contents"))
