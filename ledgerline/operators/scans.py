"""Scans of events in windows that are bounded in time and in rows, planned from a histogram and proved to be all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTES_OF_DAY = 1440


def scan_windows(events: DataFrame, ts: str, most_minutes: int = 15, most_rows: int = 100) -> DataFrame:
    """Windows (day, start, last: minutes of the day; rows; truncated) that hold all rows of `events` with a time.

    From each day's first minute with rows on, a window takes further minutes while it stays within `most_minutes` and `most_rows`;
    the next begins at the next minute with rows. A minute with more rows than that is a window of its own and truncated, as it
    can't be cut. Only counts of minutes are gathered, at most 1,440 for each day.
    """
    minute = (F.hour(ts) * 60 + F.minute(ts)).alias("minute")
    counted = events.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day"), minute).agg(F.count("*").alias("n"))
    days = counted.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("minute", "n"))).alias("minutes"))
    window = lambda s: F.struct(s["start"].alias("start"), s["last"].alias("last"), s["rows"].alias("rows"))
    none = F.lit(None).cast("int")
    start = F.struct(F.array().cast("array<struct<start:int,last:int,rows:bigint>>").alias("out"), none.alias("start"), none.alias("last"), F.lit(0).cast("long").alias("rows"))

    def take(s: Column, x: Column) -> Column:
        open_ = s["start"].isNotNull()
        more = open_ & (x["minute"] - s["start"] < most_minutes) & (s["rows"] + x["n"] <= most_rows)
        return F.struct(
            F.when(open_ & ~more, F.array_append(s["out"], window(s))).otherwise(s["out"]).alias("out"),
            F.when(more, s["start"]).otherwise(x["minute"]).alias("start"),
            x["minute"].alias("last"),
            (F.when(more, s["rows"]).otherwise(0) + x["n"]).alias("rows"),
        )

    cut = F.aggregate("minutes", start, take, lambda s: F.array_append(s["out"], window(s)))
    return days.select("day", F.inline(cut)).withColumn("truncated", F.col("rows") > most_rows)


def scanned(events: DataFrame, ts: str, windows: DataFrame) -> DataFrame:
    """`windows` with found, the rows of `events` that the scan of each gives; rows in no window are in one without a day.

    Windows meet events by the minute, of which each has few, so it is an equality join and no range join.
    """
    spread = windows.withColumn("minute", F.explode(F.sequence("start", "last")))
    minute = (F.hour(ts) * 60 + F.minute(ts)).alias("minute")
    counts = events.groupBy(F.to_date(ts).alias("day"), minute).agg(F.count("*").alias("n"))
    found = counts.join(spread.select("day", "minute", "start"), ["day", "minute"], "left").groupBy(F.when(F.col("start").isNotNull(), F.col("day")).alias("_day"), F.col("start").alias("_start")).agg(F.sum("n").alias("found"))
    joined = windows.join(found, (F.col("day") == F.col("_day")) & (F.col("start") == F.col("_start")), "full")
    return joined.select(*windows.columns, F.coalesce("found", F.lit(0)).alias("found"))
