"""Queries on nested payloads of a paged catalog and on the proof that all of it was seen.

The pages are made of `part`: a brand is a partition, ten of its parts a page of products, each with one or two items
that have the part's suppliers (of `lineitem`) as sellers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids, strict_json
from ..operators import payload
from ..sources.tables import read


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts with their place in their brand."""
    return read(spark, sf_dir, "part").withColumn("position", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")).cast("long") - 1)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_brand, page, from_index and body: pages of JSON; each seventeenth product repeats the item of the one before."""
    key = F.col("p_partkey")
    seller = lambda k: F.struct(
        F.concat(F.lit("s"), (key % 10 + k).cast("string")).alias("sellerId"), (F.lit(k) == key % 2).alias("sellerDefault"),
        F.when(key % 9 != k, F.col("p_retailprice") + k).alias("price"), (F.col("p_retailprice") + key % 3 * 5).alias("listPrice"), (key % 4 * (1 - k)).cast("int").alias("quantity"),
    )
    item = lambda k: F.struct(F.concat(F.lit("i"), (key - F.when(key % 17 == 0, 1).otherwise(0)).cast("string"), F.lit(f"-{k}")).alias("itemId"), F.array(F.lit("http://img/0"), F.concat(F.lit("https://img/"), key.cast("string"))).alias("images"), F.array(seller(0), seller(1)).alias("sellers"))
    product = F.struct(
        F.when(key % 13 != 0, key.cast("string")).otherwise("").alias("productId"), F.when(key % 26 != 0, F.concat(F.lit("r"), key.cast("string"))).alias("reference"), F.col("p_name").alias("name"),
        F.array(F.concat(F.lit("/"), "p_brand", F.lit("/"), "p_type", F.lit("/"))).alias("categories"), F.when(key % 2 == 0, F.array(item(0))).otherwise(F.array(item(0), item(1))).alias("items"),
    )
    rows = _places(spark, sf_dir).select("p_brand", F.floor(F.col("position") / 10).alias("page"), "position", product.alias("product"))
    pages = rows.groupBy("p_brand", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "product"))), lambda x: x["product"]).alias("products"))
    body = F.to_json(F.struct(F.lit(100).alias("total"), "products"))
    return pages.select("p_brand", "page", (F.col("page") * 10).alias("from_index"), F.when(F.col("page") % 8 == 7, F.lit('{"products": [{]')).otherwise(body).alias("body"))


def payload_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offers in pages of JSON: products, items and sellers taken apart."""
    return payload.offers(payload.parsed(_pages(spark, sf_dir), "body"), "p_brand", "page")


def payload_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each page: whether it can be read, its products and items, items that repeat, and whether it is accepted."""
    pages = payload.parsed(_pages(spark, sf_dir), "body")
    offers = payload.offers(pages, "p_brand", "page").groupBy("p_brand", "page").agg(F.count_distinct("offset").alias("n_products"), F.count("sku").alias("n_items"), F.count_distinct("sku").alias("n_skus"), F.count_if(F.col("price").isNull()).alias("n_unpriced"))
    joined = pages.select("p_brand", "page", "valid").join(offers, ["p_brand", "page"], "left").fillna(0, ["n_products", "n_items", "n_skus", "n_unpriced"])
    repeats = F.col("n_items") - F.col("n_skus")
    return joined.withColumn("n_repeats", repeats).withColumn("accepted", F.col("valid") & (F.col("n_products") > 0) & (repeats == 0) & (F.col("n_unpriced") * 2 <= F.col("n_items")))


def product_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the catalog once each, by the first page that has them, and how many pages and products do."""
    offers = payload.offers(payload.parsed(_pages(spark, sf_dir), "body"), "p_brand", "page")
    first = F.min(F.struct("page", "offset", "product_id")).alias("first")
    return offers.groupBy("p_brand", "sku").agg(first, F.count("*").alias("n_rows"), F.count_distinct("page").alias("n_pages")).select("p_brand", "sku", F.col("first.page").alias("page"), F.col("first.offset").alias("offset"), F.col("first.product_id").alias("product_id"), "n_rows", "n_pages")


def product_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What identifies each product of the pages, by a chain of fallbacks."""
    products = payload.parsed(_pages(spark, sf_dir), "body").filter("valid").select("p_brand", "page", F.posexplode("payload.products").alias("offset", "p"))
    sku = F.when(F.col("offset") % 3 != 0, F.col("p.items")[0]["itemId"])
    return products.select("p_brand", "page", F.col("offset").cast("long").alias("offset"), payload.identity(F.col("p.productId"), F.col("p.reference"), sku, F.col("p.name"), F.col("offset")).alias("identity"))


def page_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each order's suppliers, in order and as a set, and how many orders have the same set."""
    found = payload.page_signatures(read(spark, sf_dir, "lineitem").withColumn("place", F.struct("l_linenumber", "l_partkey", "l_suppkey")), ["l_orderkey"], "place", "l_suppkey")
    same = found.groupBy("as_set").agg(F.count("*").alias("n_same"))
    return found.join(same, "as_set").select("l_orderkey", "n", "in_order", "as_set", "n_same")


def _seen(spark: SparkSession, sf_dir: str, side: int) -> DataFrame:
    """The positions that a traversal saw: even orders forwards, odd ones backwards."""
    lines = read(spark, sf_dir, "lineitem").filter(F.col("l_orderkey") % 2 == side).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return lines.join(_places(spark, sf_dir).select("p_partkey", "p_brand", "position"), "p_partkey").select("p_brand", "p_partkey", "n", "position")


def position_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which positions of each brand a traversal covers: each seen page gives its first index and its products' offsets."""
    totals = read(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("total"))
    seen = _seen(spark, sf_dir, 0).select("p_brand", F.explode(F.when(F.col("n") > 3, F.array("position", "position")).when(F.col("n") == 3, F.array(F.col("position") + 100_000)).otherwise(F.array("position"))).alias("position"))
    return payload.positions(totals, seen, "p_brand", "total")


def coverage_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second traversal recovers of what a first missed, brand by brand."""
    expected = read(spark, sf_dir, "part").filter("p_partkey % 19 <> 0").select("p_brand", "p_partkey")
    return payload.recovery(expected, _seen(spark, sf_dir, 0), _seen(spark, sf_dir, 1).filter("p_partkey % 3 = 0"), "p_brand", "p_partkey")


def coverage_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof for each brand: both orders agree, all positions seen, totals stable, and the verdict with its reasons."""
    totals = read(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("total"))
    both = _seen(spark, sf_dir, 0).select("p_brand", "p_partkey", F.lit(1).alias("bit")).unionByName(_seen(spark, sf_dir, 1).select("p_brand", "p_partkey", F.lit(2).alias("bit")))
    sides = both.groupBy("p_brand", "p_partkey").agg(F.bit_or("bit").alias("bits")).groupBy("p_brand").agg(F.count_if(F.col("bits") == 3).alias("shared"), F.count_if(F.col("bits") == 1).alias("only_first"), F.count_if(F.col("bits") == 2).alias("only_second"))
    pages = _places(spark, sf_dir).select("p_brand", F.floor(F.col("position") / 10).alias("page"), "p_partkey").groupBy("p_brand", "page").agg(F.max(F.when(F.col("p_partkey") % 211 == 0, 1).otherwise(0)).cast("long").alias("total"))
    stable = payload.total_changes(pages, "p_brand", "page", "total")
    joined = totals.join(sides, "p_brand", "left").join(stable, "p_brand", "left").fillna(0, ["shared", "only_first", "only_second"])
    reasons = F.array_compact(F.array(
        F.when(F.col("only_first") + F.col("only_second") > 0, F.lit("orders_differ")), F.when(F.col("shared") + F.col("only_first") + F.col("only_second") < F.col("total"), F.lit("positions_missing")), F.when(~F.col("stable"), F.lit("total_changed")),
    ))
    return joined.select("p_brand", F.col("total").alias("expected"), "shared", "only_first", "only_second", "changes", F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("proven"))


def _trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_brand and tree: categories in JSON, types with sizes below; some quantities aren't the sum of those below."""
    sizes = read(spark, sf_dir, "part").groupBy("p_brand", "p_type", F.floor(F.col("p_size") / 10).alias("tens")).agg(F.count("*").alias("n"))
    leaf = F.struct(F.concat(F.lit("size"), F.col("tens").cast("string")).alias("name"), F.when(F.col("tens") == 4, 0).otherwise(F.col("n")).alias("quantity"))
    types = sizes.groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list(leaf)).alias("children"), F.sum("n").alias("n"))
    kinds = types.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct(F.col("p_type").alias("name"), F.col("n").alias("quantity"), "children"))).alias("children"), F.sum("n").alias("n"))
    return kinds.select("p_brand", F.to_json(F.array(F.struct(F.col("p_brand").alias("name"), F.col("n").alias("quantity"), "children"))).alias("tree"))


def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of trees of categories, and whether each agrees with those below it."""
    nodes = payload.flat_tree(_trees(spark, sf_dir), "tree", 3, "p_brand")
    return nodes.withColumn("agrees", F.col("is_leaf") | (F.col("quantity") == F.col("children_quantity"))).drop("children_quantity")


def positive_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves that have products, with the names of their partitions in order of the paths."""
    leaves = payload.flat_tree(_trees(spark, sf_dir), "tree", 3, "p_brand").filter("is_leaf and quantity > 0")
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy("path"))
    return leaves.select("p_brand", "path", "quantity", F.concat(F.lit("partition-"), F.lpad(place.cast("string"), 4, "0")).alias("partition"))


def leaf_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products against leaves by their category paths: how many leaves claim each, counted for each brand."""
    leaves = positive_leaves(spark, sf_dir).select("path", F.lit(1).alias("leaf"))
    key = F.col("p_partkey")
    paths = F.array(F.concat(F.lit("/"), "p_brand", F.lit("/"), "p_type", F.lit("/size"), F.floor(F.col("p_size") / 10).cast("string"), F.lit("/")), F.when(key % 5 == 0, F.concat(F.lit("/"), "p_brand", F.lit("/"), "p_type", F.lit("/size0/"))), F.when(key % 7 == 0, F.lit("/other/")))
    claimed = read(spark, sf_dir, "part").select("p_brand", "p_partkey", F.explode(F.array_distinct(F.array_compact(paths))).alias("path")).join(leaves, "path", "left")
    n = claimed.groupBy("p_brand", "p_partkey").agg(F.count("leaf").alias("n"))
    return n.groupBy("p_brand").agg(F.count_if(F.col("n") == 0).alias("unassigned"), F.count_if(F.col("n") == 1).alias("assigned"), F.count_if(F.col("n") > 1).alias("ambiguous"))


def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of a crawl: each page of each leaf in two orders, with its address, number and digest."""
    pages = positive_leaves(spark, sf_dir).withColumn("page", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("quantity") / 5))))
    both = pages.select("*", F.explode(F.array(F.lit("name_asc"), F.lit("name_desc"))).alias("sort"))
    start = (F.col("page") - 1) * 5
    url = F.concat(F.lit("https://shop.example/search?category="), F.url_encode("path"), F.lit("&from="), start, F.lit("&to="), F.least(start + 5, F.col("quantity")) - 1, F.lit("&sort="), F.col("sort"))
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy("partition", "sort", "page")).cast("long")
    return both.select("p_brand", "partition", "sort", "page", place.alias("place"), url.alias("url"), ids.digest(page=F.col("page"), path=F.col("path"), sort=F.col("sort")).alias("digest"))


def search_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the addresses of a plan ask for, read back from them."""
    plan = request_plan(spark, sf_dir)
    part = lambda name: F.url_decode(F.regexp_extract("url", rf"[?&]{name}=([^&]*)", 1))
    return plan.groupBy(part("category").alias("category"), part("sort").alias("sort")).agg(F.min(part("from").cast("long")).alias("first"), F.max(part("to").cast("long")).alias("last"), F.count("*").alias("n"))


def trace_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts (events of even number) against traces (of odd number) by all of their attributes: exactly one or none."""
    events = read(spark, sf_dir, "events").withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    on = ["user_id", "event_type", "hour"]
    return payload.exactly_one(events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1").withColumnRenamed("event_id", "trace_id"), on, "event_id", "trace_id")


def manifest_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan (orders) against its evidence (lines): planned and seen once, missing, repeated or not planned."""
    plan = read(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("k"), F.lit(1).alias("planned"))
    seen = read(spark, sf_dir, "lineitem").filter("l_orderkey % 10 <> 5").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"), F.count_distinct("l_linenumber").alias("n_lines"), F.count_distinct("l_partkey", "l_suppkey").alias("n_parts"))
    joined = plan.join(seen, "k", "full")
    verdict = F.when(F.col("planned").isNull(), "unplanned").when(F.col("n").isNull(), "missing").when(F.col("n_lines") < F.col("n"), "repeated").otherwise("closed")
    return joined.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n_orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of events as channel, key and value: the first placement that has a key gives its value."""
    k = F.get_json_object("props", "$.k")
    stage = F.create_map(F.lit("header"), F.create_map(F.lit("k"), F.when(F.col("event_id") % 3 == 0, k), F.lit("kind"), F.col("event_type")), F.lit("body"), F.create_map(F.lit("k"), k, F.lit("store"), F.when(F.col("user_id") % 4 == 0, F.lit("s1"))))
    flat = read(spark, sf_dir, "events").select("event_id", F.explode(stage).alias("channel", "settings")).select("event_id", "channel", F.explode("settings").alias("key", "value")).filter("value is not null")
    best = flat.groupBy("event_id", "key").agg(F.max_by("channel", "channel").alias("channel"), F.max_by("value", "channel").alias("value"))
    return best.groupBy("channel", "key").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_values"))


def granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the contexts of each user can bind: a store before a city, strong keys before weak ones."""
    k = F.get_json_object("props", "$.k").cast("long")
    strength = F.when(k.isNull(), "none").when(k % 5 == 0, "strong").otherwise("weak")
    rows = read(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "purchase", "store").when(F.col("event_type") == "view", "city").otherwise("none").alias("level"), strength.alias("strength"))
    has = lambda level, strength: F.bool_or((F.col("level") == level) & (F.col("strength") == strength)).alias(f"{level}_{strength}")
    flags = rows.groupBy("user_id").agg(has("store", "strong"), has("store", "weak"), has("city", "strong"), has("city", "weak"), F.count("*").alias("n"))
    decision = F.when(F.col("store_strong"), "STORE").when(F.col("store_weak"), "STORE_WEAK").when(F.col("city_strong"), "CITY").when(F.col("city_weak"), "CITY_WEAK").otherwise("NONE")
    return flags.select("user_id", "n", decision.alias("granularity"))


def update_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why suppliers (as locations) may not be read or updated, and which of their lines a run keeps out."""
    s = F.col("s_suppkey")
    locations = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.when(s % 5 == 0, "disabled").when(s % 7 == 0, "unverified").otherwise("verified").alias("status"), (s % 3 != 0).alias("commercial"), "s_nationkey")
    reason = F.when(F.col("s_nationkey").isNull(), "unknown_location").when(F.col("status") == "disabled", "disabled").when(F.col("status") == "unverified", "not_verified").when(~F.col("commercial"), "not_commercial").otherwise("")
    lines = read(spark, sf_dir, "lineitem").withColumn("l_suppkey", F.when(F.col("l_orderkey") % 40 == 0, F.lit(-1)).otherwise(F.col("l_suppkey"))).groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return lines.join(locations, "l_suppkey", "left").select(reason.alias("reason"), "n").groupBy("reason").agg(F.count("*").alias("n_locations"), F.sum("n").alias("n_lines")).withColumn("allowed", F.col("reason") == "")


def stop_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the answers to requests mean for a run: go on, wait, or stop."""
    status = F.get(F.array(*map(F.lit, (200, 204, 301, 401, 403, 404, 408, 429, 500, 503))), (F.col("event_id") % 10).cast("int"))
    kind = F.when(status.between(200, 299), "OK").when(status.isin(401, 403), "STOP_FORBIDDEN").when(status == 429, "STOP_RATE_LIMITED").when(status >= 500, "STOP_SERVER").when(status.between(300, 399), "STOP_REDIRECT").otherwise("STOP_CLIENT")
    return read(spark, sf_dir, "events").select(status.alias("status"), kind.alias("kind")).groupBy("status", "kind").agg(F.count("*").alias("n"))


def strict_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of JSON that a strict reader refuses: repeated keys, NaN, infinities and whole numbers beyond 2 ** 53."""
    k = F.get_json_object("props", "$.k")
    e = F.col("event_id")
    body = F.when(e % 11 == 0, F.concat(F.lit('{"k": 1, "k": '), k, F.lit("}"))).when(e % 13 == 0, F.lit('{"k": NaN}')).when(e % 17 == 0, F.lit('{"k": 90071992547409921}')).when(e % 19 == 0, F.lit('{"k": -Infinity}')).otherwise(F.col("props"))
    rows = read(spark, sf_dir, "events").select(body.alias("body"))
    fault = strict_json.verdict(F.col("body"))
    return rows.select(F.when(fault == "not_finite", "not_a_number").otherwise(fault).alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        payload_offers, payload_metrics, product_skus, product_identity, page_signatures, position_coverage, coverage_recovery, coverage_proof, category_tree, positive_leaves, leaf_membership,
        request_plan, search_variables, trace_exact, manifest_closure, placements, granularity, update_allowed, stop_kinds, strict_numbers,
    )
}

_PLACES_SQL = "places AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS position FROM part)"
_ITEMS_SQL = f"""{_PLACES_SQL},
items AS (
  SELECT p_brand, position // 10 AS page, position % 10 AS "offset", p_partkey AS k, p_name, p_type, p_retailprice AS price, unnest(range(1 + p_partkey % 2)) AS i
  FROM places WHERE (position // 10) % 8 <> 7),
offers AS (
  SELECT p_brand, page, "offset", CASE WHEN k % 13 <> 0 THEN CAST(k AS VARCHAR) ELSE '' END AS product_id,
         'i' || (k - CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END) || '-' || i AS sku, p_name AS name, '/' || p_brand || '/' || p_type || '/' AS category, 'https://img/' || k AS image,
         's' || (k % 10 + k % 2) AS seller_id, CASE WHEN k % 9 <> k % 2 THEN price + k % 2 END AS price,
         CASE WHEN k % 9 <> k % 2 AND price + k % 3 * 5 > price + k % 2 THEN price + k % 3 * 5 END AS regular_price,
         k % 9 <> k % 2 AND price + k % 3 * 5 > price + k % 2 AS on_promotion,
         CASE WHEN k % 4 > 0 AND k % 9 <> 0 THEN 'AVAILABLE' WHEN k % 4 = 0 THEN 'OUT_OF_STOCK' ELSE 'UNKNOWN' END AS availability
  FROM items)"""
_SEEN_SQL = f"""{_PLACES_SQL},
first AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1),
second AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_orderkey % 2 = 1 GROUP BY 1)"""
_LEAVES_SQL = """
leaves AS (
  SELECT p_brand, '/' || p_brand || '/' || p_type || '/size' || p_size // 10 || '/' AS path, CASE WHEN p_size // 10 = 4 THEN 0 ELSE count(*) END AS quantity, count(*) AS n, p_type
  FROM part GROUP BY p_brand, p_type, p_size // 10),
positive AS (
  SELECT p_brand, path, quantity, 'partition-' || lpad(CAST(row_number() OVER (PARTITION BY p_brand ORDER BY encode(path)) AS VARCHAR), 4, '0') AS partition FROM leaves WHERE quantity > 0)"""
_REQUESTS_SQL = f"""{_LEAVES_SQL},
requests AS (
  SELECT p.*, page, sort, (page - 1) * 5 AS lo, least(page * 5, quantity) - 1 AS hi
  FROM (SELECT *, unnest(range(1, CAST(ceil(quantity / 5) AS BIGINT) + 1)) AS page FROM positive) p, (VALUES ('name_asc'), ('name_desc')) s(sort))"""

ORACLE_SQL = {
    "payload_offers": f"WITH {_ITEMS_SQL} SELECT * FROM offers",
    "payload_metrics": f"""
WITH {_ITEMS_SQL},
m AS (SELECT p_brand, page, count(DISTINCT "offset") AS n_products, count(*) AS n_items, count(DISTINCT sku) AS n_skus, count(*) FILTER (price IS NULL) AS n_unpriced FROM offers GROUP BY ALL)
SELECT p.p_brand, p.page, n_products IS NOT NULL AS valid, coalesce(n_products, 0) AS n_products, coalesce(n_items, 0) AS n_items, coalesce(n_skus, 0) AS n_skus, coalesce(n_unpriced, 0) AS n_unpriced,
       coalesce(n_items - n_skus, 0) AS n_repeats, coalesce(n_items = n_skus AND n_unpriced * 2 <= n_items, FALSE) AS accepted
FROM (SELECT DISTINCT p_brand, position // 10 AS page FROM places) p LEFT JOIN m USING (p_brand, page)""",
    "product_skus": f"""
WITH {_ITEMS_SQL}
SELECT p_brand, sku, min(page) AS page, arg_min("offset", (page, "offset", product_id)) AS "offset", arg_min(product_id, (page, "offset", product_id)) AS product_id, count(*) AS n_rows, count(DISTINCT page) AS n_pages
FROM offers GROUP BY p_brand, sku""",
    "product_identity": f"""
WITH {_PLACES_SQL}
SELECT p_brand, position // 10 AS page, position % 10 AS "offset",
       CASE WHEN p_partkey % 13 <> 0 THEN 'product:' || p_partkey WHEN p_partkey % 26 <> 0 THEN 'reference:r' || p_partkey
            WHEN position % 10 % 3 <> 0 THEN 'sku:i' || (p_partkey - CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END) || '-0' ELSE 'name:' || lower(trim(p_name)) END AS identity
FROM places WHERE (position // 10) % 8 <> 7""",
    "page_signatures": """
WITH s AS (
  SELECT l_orderkey, count(*) AS n, sha256(string_agg(l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey)) AS in_order,
         sha256(array_to_string(list_sort(list_distinct(list(l_suppkey))), ',')) AS as_set FROM lineitem GROUP BY l_orderkey)
SELECT *, count(*) OVER (PARTITION BY as_set) AS n_same FROM s""",
    "position_coverage": f"""
WITH {_SEEN_SQL},
t AS (SELECT p_brand, count(*) AS total FROM part GROUP BY 1),
s AS (SELECT p_brand, CASE WHEN n = 3 THEN position + 100000 ELSE position END AS position, n > 3 AS twice FROM first JOIN places ON l_partkey = p_partkey)
SELECT p_brand, total, count(*) FILTER (position < total) AS covered, count(*) FILTER (twice AND position < total) AS repeated, count(*) FILTER (position >= total) AS outside,
       total - covered AS missing, missing = 0 AND outside = 0 AS proven FROM t LEFT JOIN s USING (p_brand) GROUP BY p_brand, total""",
    "coverage_recovery": f"""
WITH {_SEEN_SQL},
k AS (SELECT p_brand, p_partkey % 19 <> 0 AS e, f.n IS NOT NULL AS a, s.n IS NOT NULL AND p_partkey % 3 = 0 AS b
      FROM part LEFT JOIN first f ON f.l_partkey = p_partkey LEFT JOIN second s ON s.l_partkey = p_partkey)
SELECT p_brand, count(*) FILTER (e) AS expected, count(*) FILTER (e AND a) AS primary, count(*) FILTER (e AND b AND NOT a) AS recovered, count(*) FILTER (e AND a AND b) AS in_both,
       count(*) FILTER (e AND NOT a AND NOT b) AS missing, count(*) FILTER (NOT e AND (a OR b)) AS unexpected, missing = 0 AND unexpected = 0 AS complete
FROM k WHERE e OR a OR b GROUP BY p_brand""".replace("AS primary", 'AS "primary"'),
    "coverage_proof": f"""
WITH {_SEEN_SQL},
k AS (SELECT p_brand, count(*) AS expected, count(*) FILTER (f.n IS NOT NULL AND s.n IS NOT NULL) AS shared, count(*) FILTER (f.n IS NOT NULL AND s.n IS NULL) AS only_first,
             count(*) FILTER (f.n IS NULL AND s.n IS NOT NULL) AS only_second
      FROM part LEFT JOIN first f ON f.l_partkey = p_partkey LEFT JOIN second s ON s.l_partkey = p_partkey GROUP BY 1),
g AS (SELECT p_brand, position // 10 AS page, max(CASE WHEN p_partkey % 211 = 0 THEN 1 ELSE 0 END) AS total FROM places GROUP BY ALL),
m AS (SELECT *, lag(total) OVER (PARTITION BY p_brand ORDER BY page) AS before FROM g),
c AS (SELECT p_brand, count(*) FILTER (before <> total) AS changes, arg_min(total, page) AS a, arg_max(total, page) AS b FROM m GROUP BY 1)
SELECT p_brand, expected, shared, only_first, only_second, changes,
       concat_ws(',', CASE WHEN only_first + only_second > 0 THEN 'orders_differ' END, CASE WHEN shared + only_first + only_second < expected THEN 'positions_missing' END,
                 CASE WHEN changes > 0 OR a <> b THEN 'total_changed' END) AS reasons, reasons = '' AS proven FROM k JOIN c USING (p_brand)""",
    "category_tree": f"""
WITH {_LEAVES_SQL}
SELECT p_brand, path, 3 AS level, quantity, 0 AS n_children, TRUE AS is_leaf, TRUE AS agrees FROM leaves
UNION ALL SELECT p_brand, '/' || p_brand || '/' || p_type || '/', 2, CAST(sum(n) AS BIGINT), count(*), FALSE, sum(n) = sum(quantity) FROM leaves GROUP BY p_brand, p_type
UNION ALL SELECT p_brand, '/' || p_brand || '/', 1, CAST(sum(n) AS BIGINT), count(DISTINCT p_type), FALSE, TRUE FROM leaves GROUP BY p_brand""",
    "positive_leaves": f"WITH {_LEAVES_SQL} SELECT * FROM positive",
    "leaf_membership": f"""
WITH {_LEAVES_SQL},
c AS (SELECT p_brand, p_partkey, unnest(list_distinct([concat('/', p_brand, '/', p_type, '/size', p_size // 10, '/'), CASE WHEN p_partkey % 5 = 0 THEN concat('/', p_brand, '/', p_type, '/size0/') END,
             CASE WHEN p_partkey % 7 = 0 THEN '/other/' END])) AS path FROM part),
n AS (SELECT c.p_brand, p_partkey, count(positive.path) AS n FROM c LEFT JOIN positive ON c.path = positive.path GROUP BY ALL)
SELECT p_brand, count(*) FILTER (n = 0) AS unassigned, count(*) FILTER (n = 1) AS assigned, count(*) FILTER (n > 1) AS ambiguous FROM n GROUP BY p_brand""",
    "request_plan": f"""
WITH {_REQUESTS_SQL}
SELECT p_brand, partition, sort, page, row_number() OVER (PARTITION BY p_brand ORDER BY partition, sort, page) AS place,
       'https://shop.example/search?category=' || url_encode(path) || '&from=' || lo || '&to=' || hi || '&sort=' || sort AS url,
       sha256(CAST(to_json({{'page': page, 'path': path, 'sort': sort}}) AS VARCHAR)) AS digest FROM requests""",
    "search_variables": f"WITH {_REQUESTS_SQL} SELECT path AS category, sort, min(lo) AS first, max(hi) AS last, count(*) AS n FROM requests GROUP BY path, sort",
    "trace_exact": """
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d %H') AS hour FROM events),
g AS (SELECT user_id, event_type, hour, count(*) FILTER (event_id % 2 = 0) AS a, count(*) FILTER (event_id % 2 = 1) AS b, min(event_id) FILTER (event_id % 2 = 1) AS trace FROM e GROUP BY ALL)
SELECT event_id, CASE WHEN a = 1 AND b = 1 THEN trace END AS trace_id, CASE WHEN b = 0 THEN 'NONE' WHEN a = 1 AND b = 1 THEN 'MATCHED' ELSE 'AMBIGUOUS' END AS verdict
FROM e JOIN g USING (user_id, event_type, hour) WHERE event_id % 2 = 0""",
    "manifest_closure": """
WITH p AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 <> 3),
s AS (SELECT l_orderkey AS k, count(*) AS n, count(DISTINCT l_linenumber) AS n_lines FROM lineitem WHERE l_orderkey % 10 <> 5 GROUP BY 1)
SELECT CASE WHEN p.k IS NULL THEN 'unplanned' WHEN n IS NULL THEN 'missing' WHEN n_lines < n THEN 'repeated' ELSE 'closed' END AS verdict, count(*) AS n_orders, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows
FROM p FULL JOIN s ON p.k = s.k GROUP BY 1""",
    "placements": """
WITH e AS (SELECT event_id, event_type, user_id, json_extract_string(props, '$.k') AS k FROM events),
f AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'header' ELSE 'body' END AS channel, 'k' AS key, k AS value FROM e WHERE k IS NOT NULL
      UNION ALL SELECT 'header', 'kind', event_type FROM e WHERE event_type IS NOT NULL UNION ALL SELECT 'body', 'store', 's1' FROM e WHERE user_id % 4 = 0)
SELECT channel, key, count(*) AS n, count(DISTINCT value) AS n_values FROM f GROUP BY ALL""",
    "granularity": """
WITH r AS (SELECT user_id, event_type AS t, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT user_id, count(*) AS n, CASE WHEN bool_or(t = 'purchase' AND k % 5 = 0) THEN 'STORE' WHEN bool_or(t = 'purchase' AND k % 5 <> 0) THEN 'STORE_WEAK'
       WHEN bool_or(t = 'view' AND k % 5 = 0) THEN 'CITY' WHEN bool_or(t = 'view' AND k % 5 <> 0) THEN 'CITY_WEAK' ELSE 'NONE' END AS granularity FROM r GROUP BY user_id""",
    "update_allowed": """
WITH l AS (SELECT CASE WHEN l_orderkey % 40 = 0 THEN -1 ELSE l_suppkey END AS k, count(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT CASE WHEN s_suppkey IS NULL THEN 'unknown_location' WHEN k % 5 = 0 THEN 'disabled' WHEN k % 7 = 0 THEN 'not_verified' WHEN k % 3 = 0 THEN 'not_commercial' ELSE '' END AS reason, n
      FROM l LEFT JOIN supplier ON k = s_suppkey)
SELECT reason, count(*) AS n_locations, CAST(sum(n) AS BIGINT) AS n_lines, reason = '' AS allowed FROM r GROUP BY reason""",
    "stop_kinds": """
WITH s AS (SELECT ([200, 204, 301, 401, 403, 404, 408, 429, 500, 503])[event_id % 10 + 1] AS status FROM events)
SELECT status, CASE WHEN status < 300 THEN 'OK' WHEN status IN (401, 403) THEN 'STOP_FORBIDDEN' WHEN status = 429 THEN 'STOP_RATE_LIMITED' WHEN status >= 500 THEN 'STOP_SERVER'
       WHEN status < 400 THEN 'STOP_REDIRECT' ELSE 'STOP_CLIENT' END AS kind, count(*) AS n FROM s GROUP BY ALL""",
    "strict_numbers": """
SELECT CASE WHEN event_id % 11 = 0 AND json_extract_string(props, '$.k') IS NOT NULL THEN 'repeated_key' WHEN event_id % 11 = 0 THEN 'missing' WHEN event_id % 13 = 0 THEN 'not_a_number' WHEN event_id % 17 = 0 THEN 'unsafe_integer'
            WHEN event_id % 19 = 0 THEN 'not_a_number' WHEN props IS NULL THEN 'missing' ELSE 'fine' END AS fault, count(*) AS n FROM events GROUP BY 1""",
}
