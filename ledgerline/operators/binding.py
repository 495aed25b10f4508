"""Digests that bind a record to all the rows it was made from, in any order, and the comparison of records by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids

#: Hex digits of the prefixes by which nodes are gathered, from the leaves up; the root gathers those of the last.
FAN = (6, 4, 2)


def merkle_roots(rows: DataFrame, group: list[str], fields: list[str], fan: tuple[int, ...] = FAN) -> DataFrame:
    """For each group the root of a tree of SHA-256 over its rows' `fields`, with n_rows.

    A leaf is the digest of a row's canonical JSON; equal rows are one leaf with their number. Leaves meet by the first digits of
    their digests, those nodes by fewer digits, and so on: a node is the digest of its children's in order. So neither the order
    of rows nor their partitioning changes the root, any change of any cell does, and no task gathers more than a node's children.
    Leaves and nodes are digested under different labels. Null cells are cells like any other.
    """
    cells = {c: F.col(c) for c in fields}
    leaves = rows.select(*group, ids.digest(**cells).alias("_digest")).groupBy(*group, "_digest").agg(F.count("*").alias("_n"))
    nodes = leaves.select(*group, F.sha2(F.concat(F.lit("leaf:"), "_digest", F.lit(":"), F.col("_n").cast("string")), 256).alias("_node"), "_n", F.col("_digest").alias("_path"))
    for digits in (*fan, 0):
        keys = [*group, F.substring("_path", 1, digits).alias("_path")]
        children = F.concat_ws("", F.sort_array(F.collect_list("_node")))
        nodes = nodes.groupBy(*keys).agg(F.sha2(F.concat(F.lit("node:"), children), 256).alias("_node"), F.sum("_n").alias("_n"))
    return nodes.select(*group, F.col("_node").alias("root"), F.col("_n").alias("n_rows"))


def evidence_id(prefix: str, root: Column, **header: Column) -> Column:
    """The prefix and the SHA-256 of the header's canonical JSON with the root: the whole digest, as it has to bind."""
    return F.concat(F.lit(prefix), ids.digest(root=root, **header))


def differing(stored: DataFrame, expected: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """For each key of either table the names of the fields in which they differ (null equals null), and `verdict`: `same`, `differs`,
    `not_stored` or `not_expected`.

    Keys are unique in each table; null keys meet.
    """
    side = lambda df, mark: df.select(*(F.col(c).alias(f"_k_{c}") for c in key), F.struct(*fields).alias(mark))
    tagged = side(stored, "old").withColumn("new", F.lit(None)).unionByName(side(expected, "new").withColumn("old", F.lit(None)), allowMissingColumns=True)
    both = tagged.groupBy(*(f"_k_{c}" for c in key)).agg(F.first("old", ignorenulls=True).alias("old"), F.first("new", ignorenulls=True).alias("new"))
    names = F.filter(F.array(*(F.when(~F.col("old")[c].eqNullSafe(F.col("new")[c]), c) for c in fields)), lambda x: x.isNotNull())
    verdict = F.when(F.col("old").isNull(), "not_stored").when(F.col("new").isNull(), "not_expected").when(F.size(names) > 0, "differs").otherwise("same")
    return both.select(*(F.col(f"_k_{c}").alias(c) for c in key), verdict.alias("verdict"), F.when(verdict == "differs", names).otherwise(F.array().cast("array<string>")).alias("fields"))
