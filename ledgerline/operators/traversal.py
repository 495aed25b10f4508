"""Whether the pages of a catalog prove that each leaf was seen whole, and what speaks against it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .fixpoint import settled, shares

_ORDER = ("first", "last", "page")
_BUCKET_PAGES = 1024


def _checked(pages: DataFrame, leaves: DataFrame, limit: int) -> DataFrame:
    """Each page with its leaf's size, what is wrong with it alone, and `kept`: the products at positions that it may hold."""
    known = leaves.select("leaf", "expected", "path")
    rows = pages.join(known, "leaf", "left").withColumn("valid", F.coalesce((F.col("first") >= 0) & (F.col("last") >= F.col("first")), F.lit(False)))
    products = F.coalesce("products", F.array().cast(pages.schema["products"].dataType))
    given = F.transform(
        products,
        lambda p, i: F.struct(
            (F.col("first") + i).alias("position"),
            i.alias("offset"),
            p["key"].alias("key"),
            F.coalesce(F.array_contains(p["paths"], F.col("path")), F.lit(False)).alias("member"),
            F.array_compact(F.coalesce(p["skus"], F.array().cast("array<string>"))).alias("skus"),
        ),
    )
    rows = rows.withColumn("given", F.when(F.col("valid"), given).otherwise(F.array().cast("array<struct<position:bigint,offset:int,key:string,member:boolean,skus:array<string>>>")))
    inside = lambda p: (p["position"] <= F.col("last")) & (p["position"] < F.col("expected"))
    rows = rows.withColumn("kept", F.filter("given", lambda p: p["key"].isNotNull() & inside(p)))
    here = F.least(F.col("last") - F.col("first") + 1, F.greatest(F.col("expected") - F.col("first"), F.lit(0)))
    keys = F.array_sort(F.array_distinct(F.transform("kept", lambda p: p["key"])))
    return rows.select(
        "leaf", "expected", *_ORDER, "total", "purpose", "valid", "kept", F.size(products).alias("n_products"),
        (F.col("valid") & (F.size(products) == here)).alias("completed"),
        F.when(F.col("valid"), F.col("last") - F.col("first") + 1).alias("width"),
        F.when(F.size("kept") > 0, F.sha2(F.to_json(keys), 256)).alias("page_set"),
        (F.col("valid") & (F.size(products) != here) & (F.col("purpose") == "RECOVERY")).alias("recovery_response_truncated"),
        (~F.col("total").eqNullSafe(F.col("expected"))).alias("partition_total_differs_from_discovery"),
        (~F.col("valid")).alias("invalid_page_range"),
        (F.col("valid") & (F.col("last") - F.col("first") + 1 > limit)).alias("page_range_above_limit"),
        F.exists("given", lambda p: p["key"].isNull()).alias("uninterpretable_product_identity"),
        F.exists("given", lambda p: p["key"].isNotNull() & ~p["member"]).alias("partition_membership_invalid"),
        F.exists("given", lambda p: p["key"].isNotNull() & ~inside(p)).alias("product_outside_requested_range"),
        F.exists("kept", lambda p: F.size(p["skus"]) == 0).alias("uninterpretable_sku_identity"),
        F.exists("kept", lambda p: F.size(F.array_distinct(p["skus"])) != F.size(p["skus"])).alias("duplicate_sku_identity"),
    )


_OF_PAGES = (
    "recovery_response_truncated", "partition_total_differs_from_discovery", "invalid_page_range", "page_range_above_limit", "uninterpretable_product_identity",
    "partition_membership_invalid", "product_outside_requested_range", "uninterpretable_sku_identity", "duplicate_sku_identity",
)


def _in_order(pages: DataFrame, limit: int, tasks: int) -> DataFrame:
    """For each page whether its total differs from the page before, and whether primary pages leave a gap before it.

    A leaf's pages are taken in buckets of positions, so that no task sorts a large leaf: what a bucket needs of those before
    is one row each.
    """
    reach = F.when((F.col("purpose") == "PRIMARY") & F.col("valid") & (F.col("first") < F.col("expected")), F.least("last", F.col("expected") - 1))
    rows = pages.select("leaf", *_ORDER, "expected", "total", reach.alias("reach"), F.floor(F.coalesce("first", F.lit(-1)) / (limit * _BUCKET_PAGES)).alias("bucket")).repartition(tasks, "leaf", "bucket")
    whole = rows.groupBy("leaf", "bucket").agg(F.max_by(F.struct("total"), F.struct(*_ORDER)).alias("ends"), F.max("reach").alias("reaches"))
    across = Window.partitionBy("leaf").orderBy("bucket")
    whole = whole.select("leaf", "bucket", F.lag("ends").over(across).alias("ends"), F.max("reaches").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("reaches"))
    within = Window.partitionBy("leaf", "bucket").orderBy(*_ORDER)
    rows = rows.select(
        "leaf", "bucket", "first", "expected", "total", "reach", F.lag(F.struct("total")).over(within).alias("_before"), F.max("reach").over(within.rowsBetween(Window.unboundedPreceding, -1)).alias("_reached")
    ).join(whole, ["leaf", "bucket"])
    before = F.coalesce("_before", "ends")
    reached = F.coalesce(F.greatest("_reached", "reaches"), F.lit(-1))
    return rows.select(
        "leaf", "reach",
        (before.isNotNull() & ~before["total"].eqNullSafe(F.col("total"))).cast("long").alias("change"),
        (F.col("reach").isNotNull() & (F.col("first") > reached + 1)).alias("gap"),
    )


def evaluated(leaves: DataFrame, pages: DataFrame, limit: int = 50) -> DataFrame:
    """A row for each leaf: counts, `reasons` (by name, comma-joined) that its pages don't prove it whole, and `proved`.

    Args:
        leaves: leaf (unique), expected (number of products by discovery), path (the category that its products must name).
        pages: leaf, page (unique within the leaf), first and last position asked for, total (that the page reported), purpose
            (PRIMARY or RECOVERY), products: array<struct<key string, paths array<string>, skus array<string>>>.
        limit: the most positions that a page may ask for.

    Of a position seen more than once the page first in order (first, last, page) decides. A leaf of no products is proved by no
    pages. Pages of an unknown leaf give a row with expected null and the one reason `leaf_not_planned`. A page without a valid
    range counts as attempted and for its total alone. Products with a null key, or outside their page's range, take no place.
    A null total differs from any other. Other columns are ignored. Checked
    pages are written once to spark.checkpoint.dir, as six counts read them; all counts are aggregated before they meet in one last
    shuffle. Positions, and buckets of pages, are dealt over more tasks where there are more; nothing of a leaf is collected in one task but slim rows of its buckets of pages.
    """
    rows = settled(_checked(pages, leaves, limit), "traversal")
    asked = rows.filter("expected > 0")
    items = asked.select("leaf", *_ORDER, F.explode("kept").alias("p"))
    n = shares(rows)
    dealt = items.select("leaf", F.col("p.position").alias("position"), F.col("p.key").alias("key"), F.struct(*_ORDER, "p.offset").alias("at")).repartition(n, "leaf", "position")
    placed = dealt.groupBy("leaf", "position", "key").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    positions = placed.groupBy("leaf", "position").agg((F.sum("n") - F.min_by("n", "at")).alias("conflict"), F.min_by("key", "at").alias("holder"))
    pairs = items.select("leaf", F.col("p.key").alias("key"), F.explode("p.skus").alias("sku")).groupBy("leaf", "sku", "key").count()
    parts = [
        leaves.select("leaf", "expected", F.lit(True).alias("planned")),
        rows.filter("expected is null or expected <= 0").select("leaf", F.lit(1).cast("long").alias("attempt"), F.col("n_products").cast("long").alias("n_products")),
        asked.select("leaf", F.lit(1).cast("long").alias("attempt"), F.col("completed").cast("long").alias("completed"), "width", *_OF_PAGES),
        asked.filter("page_set is not null").groupBy("leaf", "page_set").agg((F.count("*") - 1).alias("again")).select("leaf", "again"),
        positions.select("leaf", F.lit(1).cast("long").alias("covered"), "conflict"),
        positions.groupBy("leaf", "holder").agg((F.count("*") > 1).alias("duplicate_compensates_omission")).select("leaf", "duplicate_compensates_omission"),
        placed.groupBy("leaf", "key").agg(F.sum("n").alias("occurrences")).select("leaf", "occurrences", F.lit(1).cast("long").alias("distinct")),
        pairs.groupBy("leaf", "sku").agg(F.count("*").alias("owners")).select("leaf", "owners"),
        _in_order(asked, limit, n),
    ]
    tall = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    sums = [total(c) for c in ("attempt", "n_products", "completed", "again", "covered", "conflict", "occurrences", "distinct", "owners", "change")]
    flags = [F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in (*_OF_PAGES, "duplicate_compensates_omission", "gap", "planned")]
    each = tall.groupBy("leaf").agg(F.max("expected").alias("expected"), F.max("reach").alias("reach"), F.max("width").alias("width"), F.max("owners").alias("most_owners"), *sums, *flags)
    size = F.col("expected")
    seen: dict[str, Column] = {
        **{c: F.col(c) for c in (*_OF_PAGES, "duplicate_compensates_omission")},
        "partition_not_attempted": F.col("attempt") == 0,
        "overlap_position_conflict": F.col("conflict") > 0,
        "repeated_page_set": F.col("again") > 0,
        "partition_total_changed": F.col("change") > 0,
        "logical_positions_not_fully_covered": F.col("covered") != size,
        "primary_plan_does_not_cover_leaf": F.col("gap") | ~F.col("reach").eqNullSafe(size - 1),
        "unique_products_differ_from_partition_total": F.col("distinct") != size,
    }
    seen["duplicate_sku_identity"] = seen["duplicate_sku_identity"] | (F.coalesce("most_owners", F.lit(0)) > 1)
    found = F.array_compact(F.array(*(F.when(seen[c], c) for c in sorted(seen))))
    none = F.array().cast("array<string>")
    reasons = (
        F.when(~F.col("planned"), F.array(F.lit("leaf_not_planned")))
        .when(size.isNull() | (size < 0), F.array(F.lit("leaf_size_invalid")))
        .when(size == 0, F.when(F.col("attempt") > 0, F.array(F.lit("empty_leaf_was_requested"))).otherwise(none))
        .otherwise(found)
    )
    open_ = F.coalesce(size > 0, F.lit(False))
    return each.select(
        "leaf", "expected",
        F.when(open_, F.ceil(size / F.coalesce("width", F.lit(limit)))).otherwise(0).alias("pages_expected"),
        F.col("attempt").alias("pages_attempted"), F.col("completed").alias("pages_completed"),
        F.when(open_, F.col("occurrences")).otherwise(F.col("n_products")).alias("received"),
        F.col("distinct").alias("n_distinct"), (F.col("occurrences") - F.col("distinct")).alias("repeats"), F.col("again").alias("repeated_sets"),
        F.col("conflict").alias("conflicts"), F.col("change").alias("total_changes"), F.col("owners").alias("sku_pairs"),
        F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("proved"),
    )
