"""Trees of categories of any depth, read from JSON, checked node by node and fingerprinted from the leaves up.

A tree is a VARIANT; each level is one explode of the one above, written before the next, so the work is one pass over each node
however deep trees are, and a tree's nodes may be spread over all tasks. Fingerprints go back up, a level at a time. Trees are dealt
over all tasks first: a small file, which one task reads, may hold very many.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fixpoint import settled, spread

#: What a category's key looks like; its number is the level that it belongs to.
KEY = r"^category-([1-9][0-9]*)$"
_LISTED = "array<variant>"


def _text(field: str) -> str:
    return f"CASE WHEN schema_of_variant(variant_get(node, '$.{field}')) = 'STRING' THEN trim(try_variant_get(node, '$.{field}', 'string')) ELSE '' END"


def _judged(frontier: DataFrame, most_level: int) -> DataFrame:
    """The nodes of a level with what is wrong with each; `normal` nodes have an identity and a list of children."""
    fields = F.expr("try_cast(node AS map<string, variant>)")
    rows = (
        frontier.withColumn("_object", fields.isNotNull())
        .withColumn("quantity", F.expr("CASE WHEN schema_of_variant(variant_get(node, '$.quantity')) = 'BIGINT' THEN try_variant_get(node, '$.quantity', 'long') END"))
        .withColumns({"key": F.expr(_text("key")), "value": F.expr(_text("value"))})
        .withColumn("level", F.regexp_extract("key", KEY, 1).try_cast("int"))
        .withColumn("kids", F.expr(f"try_variant_get(node, '$.children', '{_LISTED}')"))
        .withColumn("_has", F.coalesce(F.map_contains_key(fields, "children"), F.lit(False)))
    )
    known = F.col("level").isNotNull() & (F.col("value") != "")
    fatal = (
        F.when(~F.col("_object"), "node_not_object")
        .when(F.col("quantity").isNull(), "quantity_not_integer")
        .when(F.col("quantity") < 0, "negative_quantity")
        .when(~known, F.when(F.col("quantity") > 0, "invalid_positive_leaf").otherwise("invalid_node_identity"))
    )
    open_ends = F.when(~F.col("_has"), "children_missing").when(F.col("kids").isNull(), "children_not_sequence")
    others = F.array(
        F.when(F.col("level") > most_level, "category_level_above_limit"),
        F.when(F.col("level") != F.col("expected"), "contradictory_topology"),
        F.when(F.col("quantity") > F.col("parent_quantity"), "child_quantity_exceeds_parent"),
        open_ends,
    )
    faults = F.when(fatal.isNotNull(), F.array(fatal)).otherwise(F.filter(others, lambda x: x.isNotNull()))
    path = F.array_append("parents", F.concat("key", F.lit("="), "value"))
    judged = rows.withColumn("faults", faults).withColumn("normal", fatal.isNull() & open_ends.isNull()).withColumn("path", path)
    return judged.select("tree", "place", "path", "key", "value", "quantity", "level", "kids", F.coalesce(F.size("kids"), F.lit(0)).alias("n_kids"), "faults", "normal")


def _children(parents: DataFrame) -> DataFrame:
    inner = parents.filter("normal").select("tree", "place", F.col("path").alias("parents"), F.col("quantity").alias("parent_quantity"), (F.col("level") + 1).alias("expected"), F.posexplode("kids").alias("at", "node"))
    return inner.select("tree", F.array_append("place", F.col("at")).alias("place"), "parents", "parent_quantity", "expected", "node")


def tree_nodes(trees: DataFrame, most_level: int = 8) -> DataFrame:
    """The nodes of `trees` (tree, body: JSON of a list of nodes with key, value, quantity and children).

    Returns tree, place (positions from the root, so in the order of a walk), path (`key=value` from the root), key, value, quantity,
    n_kids, n_normal (children that are normal), faults, normal and fingerprint (null unless normal): the SHA-256 of the node's own
    fields and of its normal children's fingerprints in order of their values, so siblings may change places.

    What stands below a node that isn't normal is not visited. A body that is no list, or no JSON, has no nodes.
    """
    start = spread(trees.select("tree", "body"), "tree").select("tree", F.expr(f"try_cast(try_parse_json(body) AS {_LISTED})").alias("kids"))
    roots = start.select("tree", F.posexplode("kids").alias("at", "node")).select("tree", F.array("at").alias("place"), F.array().cast("array<string>").alias("parents"), F.lit(None).cast("long").alias("parent_quantity"), F.lit(1).alias("expected"), "node")
    levels = [settled(_judged(roots, most_level), "nodes")]
    while not levels[-1].filter("normal and n_kids > 0").isEmpty():
        levels.append(settled(_judged(_children(levels[-1]), most_level), "nodes"))
    done: list[DataFrame] = []
    for level in reversed(levels):
        level = level.drop("kids")
        if done:
            own = done[-1].filter("normal").select(F.col("tree").alias("_tree"), F.slice("place", 1, F.size("place") - 1).alias("_place"), "fingerprint")
            below = own.groupBy("_tree", "_place").agg(F.sort_array(F.collect_list("fingerprint")).alias("_below"))
            level = level.join(below, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("place") == F.col("_place")), "left").drop("_tree", "_place")
        else:
            level = level.withColumn("_below", F.lit(None).cast("array<string>"))
        below = F.coalesce("_below", F.array().cast("array<string>"))
        said = F.to_json(F.struct(below.alias("children"), "key", "quantity", "value"))
        level = level.withColumns({"n_normal": F.size(below), "fingerprint": F.when(F.col("normal"), F.sha2(said, 256))}).drop("_below")
        done.append(settled(level, "prints"))
    return reduce(DataFrame.unionByName, done)


def tree_report(trees: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row for each tree: nodes_seen, positive_nodes, duplicates (nodes whose path an earlier node has), leaves, leaf_quantity, faults
    (sorted, each once) and complete, which is whether there is none.

    Beside the nodes' own faults: `duplicate_structural_node_conflict` where nodes of one path differ in anything below them,
    `positive_branch_without_valid_children`, and `facets_not_sequence` where the body is no list. Only the first node of a path
    counts as a leaf.
    """
    leaf = F.col("first.n_kids") == 0
    paths = nodes.filter("normal").groupBy("tree", "path").agg(
        F.count("*").alias("n"), (F.min("fingerprint") < F.max("fingerprint")).alias("clash"), F.min(F.struct("place", "n_kids", "n_normal", "quantity")).alias("first")
    )
    barren = F.when((F.col("first.n_kids") > 0) & (F.col("first.n_normal") == 0), "positive_branch_without_valid_children")
    of_paths = paths.groupBy("tree").agg(
        F.sum(F.col("n") - 1).alias("duplicates"), F.count_if(leaf).alias("leaves"), F.sum(F.when(leaf, F.col("first.quantity"))).alias("leaf_quantity"),
        F.collect_set(F.when(F.col("clash"), "duplicate_structural_node_conflict")).alias("conflicts"), F.collect_set(barren).alias("barren"),
    )
    of_nodes = nodes.groupBy("tree").agg(F.count("*").alias("nodes_seen"), F.count_if(F.col("quantity") > 0).alias("positive_nodes"), F.flatten(F.collect_set("faults")).alias("own"))
    out = trees.select("tree", F.expr(f"try_cast(try_parse_json(body) AS {_LISTED})").isNull().alias("_odd"))
    for part in (of_nodes, of_paths):
        part = part.withColumnRenamed("tree", "_tree")
        out = out.join(part, out["tree"].eqNullSafe(part["_tree"]), "left").drop("_tree")
    none = F.array().cast("array<string>")
    odd = F.when(F.col("_odd"), F.array(F.lit("facets_not_sequence"))).otherwise(none)
    faults = F.array_sort(F.array_distinct(F.concat(*(F.coalesce(c, none) for c in ("own", "conflicts", "barren")), odd)))
    counts = ("nodes_seen", "positive_nodes", "duplicates", "leaves", "leaf_quantity")
    return out.select("tree", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), faults.alias("faults")).withColumn("complete", F.size("faults") == 0)
