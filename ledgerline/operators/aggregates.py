"""Aggregations of contests and of run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_mean(value: Column, weight: Column) -> Column:
    """Null where the weights add up to nothing."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def ratio(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def sides(matches: DataFrame, a: str, b: str, goals_a: str, goals_b: str, keep: list[str]) -> DataFrame:
    """Two rows for each match: team, other, gf, ga, points and the columns kept; one pass over the matches."""
    one = lambda t, o, f, g: F.struct(F.col(t).alias("team"), F.col(o).alias("other"), F.col(f).alias("gf"), F.col(g).alias("ga"))
    rows = matches.select(*keep, F.explode(F.array(one(a, b, goals_a, goals_b), one(b, a, goals_b, goals_a))).alias("side")).select(*keep, "side.*")
    return rows.withColumn("points", F.when(F.col("gf") > F.col("ga"), 3).when(F.col("gf") == F.col("ga"), 1).otherwise(0))


def standings(rows: DataFrame, group: str) -> DataFrame:
    """Table of each group from rows of sides(), with positions by points, goal difference, goals and team."""
    won, drawn, lost = (F.sum((F.col("points") == p).cast("long")) for p in (3, 1, 0))
    table = rows.groupBy(group, "team").agg(F.count("*").alias("pj"), won.alias("pg"), drawn.alias("pe"), lost.alias("pp"), F.sum("gf").alias("gf"), F.sum("ga").alias("gc"), F.sum("points").alias("pts"))
    table = table.withColumn("dg", F.col("gf") - F.col("gc"))
    place = Window.partitionBy(group).orderBy(F.desc("pts"), F.desc("dg"), F.desc("gf"), "team")
    return table.withColumn("pos", F.row_number().over(place))


def best_row(df: DataFrame, by: str, order: list[Column], keep: list[str]) -> DataFrame:
    """For each key the row that is largest by `order`; one aggregation, no sort."""
    best = F.max_by(F.struct(*keep), F.struct(*order))
    return df.groupBy(by).agg(best.alias("_best")).select(by, "_best.*")


def scaled(df: DataFrame, value: str, out: str, low: float, high: float) -> DataFrame:
    """Adds `out`: `value` scaled to low..high over all rows; a range below 1 counts as 1.

    The least and the most are one row, which every task gets; the rows themselves stay where they are.
    """
    ends = df.agg(F.min(value).alias("_least"), F.max(value).alias("_most"))
    share = (F.col(value) - F.col("_least")) / F.greatest(F.col("_most") - F.col("_least"), F.lit(1.0))
    return df.crossJoin(F.broadcast(ends)).withColumn(out, low + share * (high - low)).drop("_least", "_most")


def reasons(**failed: Column) -> Column:
    """Names of the conditions that hold, in the order given."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in failed.items())))
