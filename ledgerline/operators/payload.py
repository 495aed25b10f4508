"""Nested payloads of a paged catalog: reading, flattening and judging them, and proving that all of it was seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SELLER = "sellerId: string, sellerDefault: boolean, price: double, listPrice: double, quantity: int"
ITEM = f"itemId: string, images: array<string>, sellers: array<struct<{SELLER}>>"
PRODUCT = f"productId: string, reference: string, name: string, categories: array<string>, items: array<struct<{ITEM}>>"
#: What a page of the catalog holds; what a page has beside it is ignored, and what it lacks is null.
PAGE = f"struct<total: int, products: array<struct<{PRODUCT}>>>"


def parsed(pages: DataFrame, body: str) -> DataFrame:
    """Adds `payload`, the page in the JSON text `body` (null where it isn't JSON), and `valid`."""
    return pages.withColumn("payload", F.from_json(F.col(body), PAGE)).withColumn("valid", F.col("payload.products").isNotNull())


def first_secure(images: Column) -> Column:
    """The first https address."""
    return F.get(F.filter(images, lambda x: x.startswith("https://")), F.lit(0))


def default_seller(sellers: Column) -> Column:
    """The seller that is marked as default, else the first."""
    return F.coalesce(F.get(F.filter(sellers, lambda s: s["sellerDefault"]), F.lit(0)), F.get(sellers, F.lit(0)))


def availability(sellers: Column) -> Column:
    """AVAILABLE if a seller has a price and a quantity, OUT_OF_STOCK if all tell that they have none, else UNKNOWN."""
    some = F.exists(sellers, lambda s: (F.coalesce(s["price"], F.lit(0.0)) > 0) & (F.coalesce(s["quantity"], F.lit(0)) > 0))
    none = (F.size(sellers) > 0) & F.forall(sellers, lambda s: F.coalesce(s["quantity"] == 0, F.lit(False)))
    return F.when(some, "AVAILABLE").when(none, "OUT_OF_STOCK").otherwise("UNKNOWN")


def offers(pages: DataFrame, *keys: str) -> DataFrame:
    """One row for each item of each product of pages with `payload` (see parsed): its place, ids, seller, prices, stock."""
    products = pages.filter("valid").select(*keys, F.posexplode("payload.products").alias("offset", "product"))
    items = products.select(*keys, "offset", "product", F.explode_outer("product.items").alias("item"))
    seller = items.withColumn("seller", default_seller(F.coalesce(F.col("item.sellers"), F.array().cast(f"array<struct<{SELLER}>>"))))
    price, regular = F.col("seller.price"), F.col("seller.listPrice")
    return seller.select(
        *keys, F.col("offset").cast("long").alias("offset"),
        F.col("product.productId").alias("product_id"), F.col("item.itemId").alias("sku"), F.col("product.name").alias("name"), F.get("product.categories", F.lit(0)).alias("category"),
        first_secure(F.col("item.images")).alias("image"), F.col("seller.sellerId").alias("seller_id"), price.alias("price"),
        F.when(regular > price, regular).alias("regular_price"), F.coalesce(regular > price, F.lit(False)).alias("on_promotion"),
        availability(F.coalesce(F.col("item.sellers"), F.array().cast(f"array<struct<{SELLER}>>"))).alias("availability"),
    )


def identity(product_id: Column, reference: Column, sku: Column, name: Column, place: Column) -> Column:
    """The first of id, reference, sku and name that isn't blank, with what it is; else the place on the page."""
    filled = lambda kind, x: F.when(F.trim(x) != "", F.concat(F.lit(f"{kind}:"), F.trim(x)))
    return F.coalesce(filled("product", product_id), filled("reference", reference), filled("sku", sku), filled("name", F.lower(name)), F.concat(F.lit("missing:"), place.cast("string")))


def page_signatures(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Of each page: digests of its values in order and as a set, and how many; a page has few rows."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    found = rows.groupBy(*keys).agg(pairs.alias("p"))
    inorder = F.transform("p", lambda x: x["v"])
    digest = lambda values: F.sha2(F.array_join(values, ","), 256)
    return found.select(*keys, F.size("p").cast("long").alias("n"), digest(inorder).alias("in_order"), digest(F.array_sort(F.array_distinct(inorder))).alias("as_set"))


def positions(totals: DataFrame, seen: DataFrame, part: str, total: str) -> DataFrame:
    """For each part: how many of the positions 0 .. total - 1 were seen, twice seen, missing, or lie outside.

    `seen` has (part, position); repeats are counted before the join, and positions aren't generated.
    """
    once = seen.groupBy(part, "position").agg(F.count("*").alias("n"))
    joined = totals.select(part, total).join(once, part, "left")
    inside = F.col("position").between(0, F.col(total) - 1)
    out = joined.groupBy(part, total).agg(F.count_if(inside).alias("covered"), F.count_if(inside & (F.col("n") > 1)).alias("repeated"), F.count_if(~inside).alias("outside"))
    missing = F.col(total) - F.col("covered")
    return out.withColumn("missing", missing).withColumn("proven", (missing == 0) & (F.col("outside") == 0))


def recovery(expected: DataFrame, primary: DataFrame, second: DataFrame, part: str, key: str) -> DataFrame:
    """For each part: the expected keys that a first traversal saw, those that only a second recovered, those in both, and
    those still missing. One aggregation over the union of the three."""
    mark = lambda df, bit: df.select(part, key, F.lit(bit).alias("bit"))
    rows = mark(expected, 1).unionByName(mark(primary, 2)).unionByName(mark(second, 4)).groupBy(part, key).agg(F.bit_or("bit").alias("bits"))
    n = lambda *bits: F.count_if(F.col("bits").isin(*bits))
    out = rows.groupBy(part).agg(n(1, 3, 5, 7).alias("expected"), n(3, 7).alias("primary"), n(5).alias("recovered"), n(7).alias("in_both"), n(1).alias("missing"), n(2, 4, 6).alias("unexpected"))
    return out.withColumn("complete", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def flat_tree(trees: DataFrame, tree: str, depth: int, *keys: str) -> DataFrame:
    """The nodes of category trees in JSON (name, quantity, children), level by level to `depth`: path, level, quantity,
    n_children, children_quantity and is_leaf. A level is an explode, so the plan is as long as the tree is deep."""
    kind = "struct<name: string, quantity: bigint>"
    for _ in range(depth - 1):
        kind = f"struct<name: string, quantity: bigint, children: array<{kind}>>"
    level = trees.select(*keys, F.explode(F.from_json(F.col(tree), f"array<{kind}>")).alias("node")).withColumn("path", F.concat(F.lit("/"), F.col("node.name"), F.lit("/")))
    found = None
    for k in range(1, depth + 1):
        last = k == depth
        children = F.lit(None).cast("array<struct<name: string, quantity: bigint>>") if last else F.col("node.children")
        n = F.coalesce(F.array_size(children), F.lit(0)).cast("long")
        total = F.lit(None).cast("long") if last else F.aggregate("node.children", F.lit(0).cast("long"), lambda s, x: s + x["quantity"])
        rows = level.select(*keys, "path", F.lit(k).alias("level"), F.col("node.quantity").alias("quantity"), n.alias("n_children"), total.alias("children_quantity"), (n == 0).alias("is_leaf"))
        found = rows if found is None else found.unionByName(rows)
        if not last:
            level = level.select(*keys, "path", F.explode("node.children").alias("node")).withColumn("path", F.concat("path", "node.name", F.lit("/")))
    return found


def exactly_one(left: DataFrame, right: DataFrame, on: list[str], row: str, other: str) -> DataFrame:
    """Each left row with the right row of equal attributes, if there is exactly one and no other left row has it.

    Attributes that are equal make a group; a group with one row on either side is a match, so groups are counted and
    never paired. Returns row, other (null without a match) and verdict.
    """
    both = left.select(*on, F.col(row).alias("l"), F.lit(None).cast(right.schema[other].dataType).alias("r")).unionByName(right.select(*on, F.lit(None).cast(left.schema[row].dataType).alias("l"), F.col(other).alias("r")))
    groups = both.groupBy(*on).agg(F.count("l").alias("n_left"), F.count("r").alias("n_right"), F.min("r").alias("r"))
    verdict = F.when(F.coalesce("n_right", F.lit(0)) == 0, "NONE").when((F.col("n_right") == 1) & (F.col("n_left") == 1), "MATCHED").otherwise("AMBIGUOUS")
    groups = groups.withColumnsRenamed({c: f"_g_{c}" for c in on})
    same = [left[c].eqNullSafe(groups[f"_g_{c}"]) for c in on]  # a null attribute equals a null one, as it does in groups
    named = left.join(groups, same, "left").withColumn("verdict", verdict)
    return named.select(left[row], F.when(F.col("verdict") == "MATCHED", F.col("r")).alias(other), "verdict")


def total_changes(pages: DataFrame, part: str, order: str, total: str) -> DataFrame:
    """For each part: the first and last total that pages report, and how often it changes from page to page."""
    before = F.lag(total).over(Window.partitionBy(part).orderBy(order))
    moved = pages.withColumn("_moved", before.isNotNull() & (before != F.col(total)))
    ends = [F.min_by(total, order).alias("first_total"), F.max_by(total, order).alias("last_total")]
    return moved.groupBy(part).agg(*ends, F.count_if("_moved").alias("changes")).withColumn("stable", (F.col("changes") == 0) & (F.col("first_total") == F.col("last_total")))
