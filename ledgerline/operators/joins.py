"""Joins that Spark has no operator for, as compositions of those it has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, tie: str, row: str) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time; nulls where there is none.

    Both sides go in one stream per key, ordered by time, and the last right row is carried forward: one shuffle, and
    no pairs. `row` identifies left rows and `tie` right ones (of equal times the larger counts). Right columns get the
    prefix r_.
    """
    carried = [c for c in right.columns if c != key]
    packed = F.struct(*(F.col(c).alias(f"r_{c}") for c in carried))
    events = right.select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), packed.alias("_r"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_l"))
    asked = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.col(row).alias("_tie"), F.lit(None).cast(events.schema["_r"].dataType).alias("_r"), F.struct("*").alias("_l"))
    order = Window.partitionBy("_k").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    last = events.unionByName(asked).withColumn("_last", F.last("_r", ignorenulls=True).over(order))
    return last.filter("_side = 1").select("_l.*", "_last.*")


def in_interval(points: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str) -> DataFrame:
    """Points with the span of their key that holds them: start <= at < end, an open end holding all later points."""
    p, s = points.alias("p"), spans.alias("s")
    inside = (F.col(f"p.{at}") >= F.col(f"s.{start}")) & (F.col(f"s.{end}").isNull() | (F.col(f"p.{at}") < F.col(f"s.{end}")))
    return p.join(s, (F.col(f"p.{key}") == F.col(f"s.{key}")) & inside)


def overlapping(spans: DataFrame, group: str, name: str, start: str, end: str, width: int) -> DataFrame:
    """Pairs of spans of a group that share positions, and how many; spans meet in cells of `width` positions.

    A pair counts in the cell where its intersection begins, so it comes once.
    """
    cells = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    a, b = cells.alias("a"), cells.alias("b")
    lo, hi = F.greatest(f"a.{start}", f"b.{start}"), F.least(f"a.{end}", f"b.{end}")
    met = (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col("a._cell") == F.col("b._cell")) & (F.col(f"a.{name}") < F.col(f"b.{name}"))
    pairs = a.join(b, met).filter((lo <= hi) & (F.floor(lo / width) == F.col("a._cell")))
    return pairs.select(F.col(f"a.{group}").alias(group), F.col(f"a.{name}").alias("first"), F.col(f"b.{name}").alias("second"), (hi - lo + 1).alias("shared"))


def difference(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Full outer comparison: the keys with what happened (added, removed, changed, same)."""
    a, b = left.select(*keys, F.col(value).alias("before"), F.lit(True).alias("_a")), right.select(*keys, F.col(value).alias("after"), F.lit(True).alias("_b"))
    what = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed").otherwise("same")
    return a.join(b, keys, "full").withColumn("what", what).drop("_a", "_b")


def unmatched(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't known: violations of a reference."""
    return rows.join(known.select(*keys).distinct(), keys, "left_anti")


def looked_up(rows: DataFrame, table: DataFrame, tries: list[tuple[str, str]], value: str, default: Column) -> DataFrame:
    """Adds `value` by the first of several (row column, table column) pairs that finds one, else the default."""
    found = []
    for k, (own, other) in enumerate(tries):
        side = table.groupBy(F.col(other).alias(f"_k{k}")).agg(F.min(value).alias(f"_v{k}"))
        rows = rows.join(side, F.col(own) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
        found.append(f"_v{k}")
    return rows.withColumn(value, F.coalesce(*found, default)).drop(*found)
