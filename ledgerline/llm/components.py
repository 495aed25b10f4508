"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, remove


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node to the smallest of them: the larger ones (large) or the smaller ones."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Labels each node that has an edge with the smallest node it can reach.

    `edges` has two long columns, a and b; direction, repeats, loops and nulls don't matter. Returns node, component.
    Each round's edges are a table in the shared folder; the rounds end when a round changes nothing, after a number that
    grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v and a is not null and b is not null").distinct()
    old = None
    seen = None
    while True:
        path = new_path(spark, "edges")
        now.write.parquet(path)
        now = spark.read.schema("u long, v long").parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if old is not None:
            remove(spark, old)
        old = path
        if state == seen:
            break
        seen = state
        now = _star(_star(now, large=True), large=False)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
