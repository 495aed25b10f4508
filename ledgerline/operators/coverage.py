"""Coverage of a paged catalog: plans, traversals and trees of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_plan(counts: DataFrame, part: str, n: str, size: int) -> DataFrame:
    """The pages to ask for: part, page (from 1), from_index and to_index (inclusive)."""
    pages = counts.filter(F.col(n) > 0).withColumn("page", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col(n) / size))))
    start = (F.col("page") - 1) * size
    return pages.select(part, "page", start.alias("from_index"), (F.least(start + size, F.col(n)) - 1).alias("to_index"))


def judged(seen: DataFrame, totals: DataFrame, part: str, total: str) -> DataFrame:
    """For each part: expected, n_seen and n_distinct keys (from `seen`), repeats, and the verdict."""
    both = totals.select(part, F.col(total).alias("expected")).join(seen, part, "left").fillna(0, ["n_seen", "n_distinct"])
    verdict = F.when((F.col("expected") == 0) & (F.col("n_seen") == 0), "EMPTY_COMPLETE").when(F.col("n_distinct") == F.col("expected"), "COMPLETE").otherwise("INCOMPLETE")
    return both.withColumn("repeats", F.col("n_seen") - F.col("n_distinct")).withColumn("verdict", verdict)


def traversal_coverage(seen: DataFrame, part: str, key: str, totals: DataFrame, total: str) -> DataFrame:
    """The same from the single observations (part, key): repeats of a key are counted first."""
    keys = seen.groupBy(part, key).agg(F.count("*").alias("n"))
    return judged(keys.groupBy(part).agg(F.sum("n").alias("n_seen"), F.count(key).alias("n_distinct")), totals, part, total)


def flattened_tree(nodes: DataFrame, path: list[str]) -> DataFrame:
    """Nodes of a category tree given by its levels as columns: path, level, quantity, is_leaf; one pass over the rows."""
    rolled = nodes.rollup(*path).agg(F.count("*").alias("quantity"), F.grouping_id().alias("_gid"))
    depth = len(path)
    level = F.lit(depth) - F.length(F.replace(F.bin("_gid"), F.lit("0"), F.lit("")))
    return rolled.withColumn("level", level.cast("int")).filter("level > 0").select(F.concat_ws("/", *path).alias("path"), "level", "quantity", (F.col("level") == depth).alias("is_leaf"))
