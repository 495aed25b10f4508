"""Queries on proofs: pages that show a leaf of a catalog whole, and locations as evidence changes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import locations, traversal
from ..operators.fixpoint import shares
from ..sources.tables import read

_PAGE = 4


def _leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A leaf for each customer, as large as its orders are many; every sixteenth is said to be empty."""
    orders = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("leaf")).agg(F.count("*").alias("n"))
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("leaf"), F.concat(F.lit("/"), "c_mktsegment", F.lit("/")).alias("path"))
    n = F.when(F.col("leaf") % 16 == 15, 0).otherwise(F.coalesce("n", F.lit(0)))
    return customers.join(orders, "leaf", "left").select("leaf", n.cast("long").alias("expected"), "path")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that showed each customer's orders, four a page, with one fault for most rests of the customer's number by 16."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    key = F.col("o_orderkey").cast("string")
    orders = orders.select("o_custkey", "o_orderkey").repartition(shares(orders), "o_custkey")
    rows = orders.select(F.col("o_custkey").alias("leaf"), (F.row_number().over(w) - 1).cast("long").alias("place"), key.alias("key"), F.lag(key).over(w).alias("last_key"), F.count("*").over(Window.partitionBy("o_custkey")).alias("n"))
    rows = rows.join(customers.select(F.col("c_custkey").alias("leaf"), "c_mktsegment"), "leaf").withColumn("kind", F.col("leaf") % 16)
    kind, place = F.col("kind"), F.col("place")
    odd = place == 1
    product = F.struct(
        place.alias("place"),
        F.when((kind == 5) & (place == 2), None).when((kind == 9) & odd, F.col("last_key")).otherwise(F.col("key")).alias("key"),
        F.array(F.when((kind == 6) & odd, "/elsewhere/").otherwise(F.concat(F.lit("/"), "c_mktsegment", F.lit("/"))), F.lit("/all/")).alias("paths"),
        F.when((kind == 8) & odd, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.when((kind == 7) & odd, F.col("last_key")).otherwise(F.col("key")), F.lit("-a")), F.concat("key", F.lit("-b")))).alias("skus"),
    )
    asked = rows.withColumn("number", F.floor(place / _PAGE)).groupBy("leaf", "kind", "n", "number").agg(F.array_sort(F.collect_list(product)).alias("products"))
    asked = asked.filter(~((kind == 2) & (F.col("number") == 1)))
    twice = kind.isin(3, 12, 13) & (F.col("number") == 0)
    asked = asked.select("*", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    again, number = F.col("copy") == 1, F.col("number")
    first = number * _PAGE + F.when(again & (kind == 13), 1).otherwise(0)
    size = F.when((kind == 14) & (number == 0), 0).when((kind == 10) & (number == 0), _PAGE - 1).otherwise(_PAGE)
    shown = F.transform("products", lambda p: p.dropFields("place"))
    return asked.select(
        "leaf", (number + 1000000 * F.col("copy")).alias("page"), first.alias("first"), (first + size - 1).alias("last"),
        (F.col("n") + F.when((kind == 4) & (number == 1), 1).otherwise(0)).alias("total"),
        F.when(again | ((kind == 11) & (number == 0)), "RECOVERY").otherwise("PRIMARY").alias("purpose"),
        F.when(again & (kind == 12), F.slice(shown, 1, 2)).otherwise(shown).alias("products"),
    )


def raw_traversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pages of each customer's orders prove, and every reason against it."""
    return traversal.evaluated(_leaves(spark, sf_dir), _pages(spark, sf_dir), _PAGE)


# What an artifact says: a JSON token for each field, from the customer's number n and what is odd about it (its rest by 29); no token, no field.
_REPORT = {
    "technical_binding_observed": "CASE k WHEN 15 THEN '1' WHEN 16 THEN CASE WHEN n % 3 < 2 THEN 'false' ELSE 'true' END ELSE CASE WHEN n % 3 < 2 THEN 'true' ELSE 'false' END END",
    "raw_values_exposed": "CASE k WHEN 9 THEN 'true' ELSE 'false' END",
    "granularity_candidate": "CASE k WHEN 10 THEN '\"online\"' WHEN 11 THEN '\"planet\"' WHEN 12 THEN '7' ELSE CASE n % 3 WHEN 0 THEN '\"city\"' WHEN 1 THEN '\"store\"' ELSE '\"unknown\"' END END",
    "confidence": "CASE k WHEN 13 THEN '\"sure\"' WHEN 14 THEN '\"weak\"' ELSE CASE WHEN n % 3 < 2 THEN '\"strong\"' ELSE '\"none\"' END END",
    "source_location_key_candidate": "CASE WHEN k = 17 THEN '\"bad key\"' WHEN k = 18 THEN NULL WHEN n % 3 = 2 THEN 'null' ELSE concat('\"vtex:region:sha256:', digest, '\"') END",
}
_ARTIFACT = {
    "target_host": "CASE k WHEN 3 THEN '\"other.example\"' ELSE '\"www.example\"' END",
    "mode": "CASE k WHEN 1 THEN '\"replay\"' ELSE '\"live\"' END",
    "stop_reason": "CASE k WHEN 2 THEN '\"rate limited\"' WHEN 0 THEN NULL ELSE 'null' END",
    "target_city": "CASE k WHEN 4 THEN 'null' ELSE '\"Harbour City\"' END",
    "production_authority": "CASE k WHEN 5 THEN 'true' ELSE 'false' END",
    "catalog_accepted": "CASE k WHEN 6 THEN NULL ELSE 'false' END",
    "extraction_enabled": "CASE k WHEN 7 THEN '\"false\"' ELSE 'false' END",
    "selected_store": "CASE k WHEN 19 THEN '\" x \"' WHEN 20 THEN 'null' ELSE '\"store 7\"' END",
    "store_selection_observed": "CASE k WHEN 21 THEN 'null' WHEN 22 THEN 'false' ELSE 'true' END",
    "binding_report": "CASE k WHEN 8 THEN '[]' ELSE inner_body END",
}


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An artifact for each customer; the last two rests give no object."""
    n = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(n.alias("n"), (n % 29).alias("k"), F.sha2(n.cast("string"), 256).alias("digest"))
    body = lambda fields: F.concat(F.lit("{"), F.concat_ws(" , ", *(F.concat(F.lit(f'"{c}": '), F.expr(token)) for c, token in fields.items())), F.lit("}"))
    whole = rows.withColumn("inner_body", body(_REPORT)).withColumn("body", body(_ARTIFACT))
    odd = F.when(F.col("k") == 23, "{").when(F.col("k") == 24, "[1]").otherwise(F.col("body"))
    return whole.select(F.col("n").alias("location_id"), odd.alias("body"))


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey")
    unsure = F.when(n % 4 == 0, "unknown").otherwise("city")
    return read(spark, sf_dir, "customer").select(
        n.alias("location_id"), F.col("c_nationkey").alias("market_id"), (n % 17 != 0).alias("is_available"), (n % 19 != 0).alias("in_scope"), unsure.alias("granularity"),
        (n % 5 == 0).alias("technical_binding_confirmed"), F.lit(None).cast("string").alias("source_location_key"), F.lit(None).cast("string").alias("evidence"), (n % 7 == 0).alias("extraction_enabled"),
    )


def _markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return read(spark, sf_dir, "nation").filter(n != 13).select(n.alias("market_id"), (n % 8 != 3).alias("is_active"), F.when(n % 2 == 0, "source_selection_required").otherwise("fixed_single_city").alias("selection_mode"))


def location_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the artifact of each customer (as location) says, or the first rule that it breaks."""
    return locations.transitions(_artifacts(spark, sf_dir), "www.example", "Harbour City")


def location_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The locations as ready artifacts propose them, and why each still may not be read."""
    after = locations.proposed(_locations(spark, sf_dir), location_transitions(spark, sf_dir))
    return locations.blocked(after, _markets(spark, sf_dir)).select("location_id", "market_id", "granularity", "technical_binding_confirmed", "source_location_key", "evidence", "extraction_enabled", "proposal", "block")


def run_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs at their customer's location, some at another market's or at none: how many of each market are at fault."""
    o = F.col("o_orderkey")
    homes = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    runs = read(spark, sf_dir, "orders").join(homes, "o_custkey").select(
        F.when(o % 31 == 0, -o).when(o % 37 != 0, F.col("o_custkey")).alias("location_id"), F.when(o % 11 == 0, (F.col("c_nationkey") + 1) % 27).otherwise(F.col("c_nationkey")).alias("market_id")
    )
    checked = locations.placed(runs, _locations(spark, sf_dir), _markets(spark, sf_dir))
    return checked.groupBy("market_id", "fault").agg(F.count("*").alias("n"), F.count("location_id").alias("n_located"))


QUERIES = {f.__name__: f for f in (raw_traversal, location_transitions, location_proposals, run_locations)}


def _object_sql(fields: dict[str, str]) -> str:
    return "'{' || concat_ws(',', " + ", ".join(f"""'"{c}":' || {fields[c]}""" for c in sorted(fields)) + ") || '}'"


_KEY = "body ->> '$.binding_report.source_location_key_candidate'"
_TRANSITIONS_SQL = f"""
rows AS (SELECT c_custkey AS n, c_custkey % 29 AS k, sha256(CAST(c_custkey AS VARCHAR)) AS digest FROM customer),
inners AS (SELECT *, {_object_sql(_REPORT)} AS inner_body FROM rows),
bodies AS (SELECT n, CASE k WHEN 23 THEN NULL WHEN 24 THEN '[1]' ELSE {_object_sql(_ARTIFACT)} END AS body FROM inners),
cells AS (
  SELECT n, body, json_type(body) AS whole, body ->> '$.mode' AS mode, coalesce(json_type(body, '$.stop_reason'), 'NULL') AS stop, body ->> '$.target_host' AS host, body ->> '$.target_city' AS city,
         body -> '$.production_authority' AS f1, body -> '$.catalog_accepted' AS f2, body -> '$.extraction_enabled' AS f3, json_type(body, '$.binding_report') AS report,
         body -> '$.binding_report.raw_values_exposed' AS raw, json_type(body, '$.binding_report.granularity_candidate') AS level_type, body ->> '$.binding_report.granularity_candidate' AS level,
         body ->> '$.binding_report.confidence' AS confidence, json_type(body, '$.binding_report.technical_binding_observed') AS technical_type,
         body ->> '$.binding_report.technical_binding_observed' = 'true' AS technical, {_KEY} AS key, body ->> '$.selected_store' AS store,
         json_type(body, '$.store_selection_observed') AS selected_type, body ->> '$.store_selection_observed' = 'true' AS selected FROM bodies),
judged AS (
  SELECT *, confidence = 'strong' AND technical AND key IS NOT NULL AS strong FROM cells),
found AS (
  SELECT *, CASE
      WHEN whole IS DISTINCT FROM 'OBJECT' THEN 'artifact_mapping_required' WHEN mode <> 'live' THEN 'live_evidence_required' WHEN stop <> 'NULL' THEN 'successful_capture_required'
      WHEN host <> 'www.example' THEN 'unexpected_target_host' WHEN city IS DISTINCT FROM 'Harbour City' THEN 'unexpected_target_city'
      WHEN CAST(f1 AS VARCHAR) IS DISTINCT FROM 'false' THEN 'production_authority_must_be_false' WHEN CAST(f2 AS VARCHAR) IS DISTINCT FROM 'false' THEN 'catalog_accepted_must_be_false'
      WHEN CAST(f3 AS VARCHAR) IS DISTINCT FROM 'false' THEN 'extraction_enabled_must_be_false' WHEN report <> 'OBJECT' THEN 'binding_report_required'
      WHEN CAST(raw AS VARCHAR) IS DISTINCT FROM 'false' THEN 'sanitized_binding_report_required' WHEN level_type <> 'VARCHAR' OR level NOT IN ('city', 'store', 'online', 'unknown') THEN 'granularity_candidate_invalid'
      WHEN level = 'online' THEN 'granularity_candidate_unsupported' WHEN confidence NOT IN ('none', 'weak', 'strong') THEN 'binding_confidence_invalid'
      WHEN technical_type <> 'BOOLEAN' THEN 'technical_binding_observed_invalid'
      WHEN key IS NOT NULL AND NOT regexp_full_match(key, '[A-Za-z][A-Za-z0-9_]*:[a-z0-9]+:sha256:[0-9a-f]{{64}}') THEN 'source_location_key_candidate_invalid'
      WHEN store IS NOT NULL AND (trim(store) = '' OR trim(store) <> store) THEN 'text_field_invalid' WHEN selected_type <> 'BOOLEAN' THEN 'store_selection_observed_invalid'
      WHEN level = 'store' AND NOT strong THEN 'strong_store_binding_required' WHEN level = 'store' AND NOT (selected AND store IS NOT NULL) THEN 'selected_store_evidence_required'
      WHEN level = 'city' AND NOT strong THEN 'strong_city_binding_required'
      WHEN level = 'unknown' AND (technical OR key IS NOT NULL OR confidence = 'strong') THEN 'unknown_binding_must_remain_non_authoritative' ELSE '' END AS reason
  FROM judged),
transitions AS (
  SELECT n AS location_id, CASE WHEN reason <> '' THEN 'rejected' WHEN level = 'city' THEN 'city_binding_ready' WHEN level = 'store' THEN 'store_binding_discovery_required' ELSE 'inconclusive' END AS status,
         reason, CASE WHEN reason = '' THEN level END AS granularity, CASE WHEN reason = '' THEN confidence END AS confidence, CASE WHEN reason = '' THEN key END AS source_location_key,
         CASE WHEN reason = '' THEN store END AS selected_store, CASE WHEN whole = 'OBJECT' THEN sha256(body) END AS artifact_sha256,
         CASE WHEN whole = 'OBJECT' THEN 'location_binding_radiography:sha256:' || sha256(body) END AS evidence_ref FROM found)"""

ORACLE_SQL = {
    # Rows of products instead of pages of them, and covered positions by generated series.
    "raw_traversal": """
WITH numbered AS (
  SELECT o_custkey AS leaf, o_custkey % 16 AS kind, row_number() OVER w - 1 AS place, CAST(o_orderkey AS VARCHAR) AS key, CAST(lag(o_orderkey) OVER w AS VARCHAR) AS last_key,
         count(*) OVER (PARTITION BY o_custkey) AS n, '/' || c_mktsegment || '/' AS path
  FROM orders JOIN customer ON c_custkey = o_custkey WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
leaves AS (
  SELECT c_custkey AS leaf, CASE WHEN c_custkey % 16 = 15 THEN 0 ELSE (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) END AS expected FROM customer),
copies AS (
  SELECT *, place // 4 AS number, 0 AS copy FROM numbered WHERE NOT (kind = 2 AND place // 4 = 1)
  UNION ALL SELECT *, 0, 1 FROM numbered WHERE place < 4 AND (kind IN (3, 13) OR kind = 12 AND place < 2)),
items AS (
  SELECT leaf, n AS real_size, kind, number + 1000000 * copy AS page, number * 4 + CASE WHEN copy = 1 AND kind = 13 THEN 1 ELSE 0 END AS first,
         CASE WHEN number > 0 THEN 4 WHEN kind = 14 THEN 0 WHEN kind = 10 THEN 3 ELSE 4 END AS width, n + CASE WHEN kind = 4 AND number = 1 THEN 1 ELSE 0 END AS total,
         CASE WHEN copy = 1 OR kind = 11 AND number = 0 THEN 'RECOVERY' ELSE 'PRIMARY' END AS purpose, place - number * 4 AS off,
         CASE WHEN kind = 5 AND place = 2 THEN NULL WHEN kind = 9 AND place = 1 THEN last_key ELSE key END AS key, kind = 6 AND place = 1 AS elsewhere,
         CASE WHEN kind = 8 AND place = 1 THEN [] WHEN kind = 7 AND place = 1 THEN [last_key || '-a', key || '-b'] ELSE [key || '-a', key || '-b'] END AS skus
  FROM copies),
pages AS (
  SELECT i.leaf, page, any_value(first) AS first, any_value(width) AS width, any_value(total) AS total, any_value(purpose) AS purpose, any_value(expected) AS expected, count(*) AS held
  FROM items i JOIN leaves USING (leaf) GROUP BY i.leaf, page),
asked AS (SELECT *, lag(total) OVER (PARTITION BY leaf ORDER BY first, first + width, page) AS earlier FROM pages WHERE expected > 0),
tried AS (SELECT i.*, i.first + off AS position, off < i.width AND i.first + off < a.expected AS inside FROM items i JOIN asked a ON a.leaf = i.leaf AND a.page = i.page WHERE i.width > 0),
kept AS (SELECT *, row_number() OVER (PARTITION BY leaf, position ORDER BY first, first + width, page) AS turn, first_value(key) OVER (PARTITION BY leaf, position ORDER BY first, first + width, page) AS holder
         FROM tried WHERE inside AND key IS NOT NULL),
sets AS (SELECT leaf, keys, count(*) - 1 AS again FROM (SELECT leaf, page, list_sort(list_distinct(list(key))) AS keys FROM kept GROUP BY ALL) GROUP BY ALL),
pairs AS (SELECT DISTINCT leaf, key, unnest(skus) AS sku FROM kept),
planned AS (SELECT leaf, count(DISTINCT p) AS n FROM (SELECT leaf, unnest(range(first, least(first + width, expected))) AS p FROM asked WHERE purpose = 'PRIMARY') GROUP BY leaf),
a AS (SELECT leaf, count(*) AS attempted, count(*) FILTER (width > 0 AND held = least(width, expected - first)) AS completed, max(width) FILTER (width > 0) AS width,
             count(*) FILTER (earlier <> total) AS changes FROM asked GROUP BY leaf),
k AS (SELECT leaf, count(*) AS received, count(DISTINCT key) AS n_distinct, count(*) FILTER (key <> holder) AS conflicts, count(DISTINCT position) AS covered,
             count(DISTINCT holder) AS holders FROM kept GROUP BY leaf),
s AS (SELECT leaf, sum(again) AS again FROM sets GROUP BY leaf),
q AS (SELECT leaf, count(*) AS sku_pairs FROM pairs GROUP BY leaf),
e AS (SELECT leaf, count(DISTINCT page) AS attempted, count(*) AS received FROM items GROUP BY leaf),
r AS (
  SELECT leaf, 'invalid_page_range' AS reason FROM asked WHERE width = 0
  UNION SELECT leaf, 'partition_total_differs_from_discovery' FROM asked WHERE total <> expected
  UNION SELECT leaf, 'recovery_response_truncated' FROM asked WHERE width > 0 AND purpose = 'RECOVERY' AND held <> least(width, expected - first)
  UNION SELECT leaf, 'uninterpretable_product_identity' FROM tried WHERE key IS NULL
  UNION SELECT leaf, 'partition_membership_invalid' FROM tried WHERE key IS NOT NULL AND elsewhere
  UNION SELECT leaf, 'product_outside_requested_range' FROM tried WHERE key IS NOT NULL AND NOT inside
  UNION SELECT leaf, 'uninterpretable_sku_identity' FROM kept WHERE len(skus) = 0
  UNION SELECT leaf, 'duplicate_sku_identity' FROM pairs GROUP BY leaf, sku HAVING count(*) > 1
  UNION SELECT l.leaf, unnest(list_filter([
      CASE WHEN attempted IS NULL THEN 'partition_not_attempted' END, CASE WHEN conflicts > 0 THEN 'overlap_position_conflict' END, CASE WHEN again > 0 THEN 'repeated_page_set' END,
      CASE WHEN changes > 0 THEN 'partition_total_changed' END, CASE WHEN coalesce(covered, 0) <> expected THEN 'logical_positions_not_fully_covered' END,
      CASE WHEN coalesce(planned.n, 0) <> expected THEN 'primary_plan_does_not_cover_leaf' END,
      CASE WHEN coalesce(n_distinct, 0) <> expected THEN 'unique_products_differ_from_partition_total' END,
      CASE WHEN holders <> covered THEN 'duplicate_compensates_omission' END], lambda x: x IS NOT NULL))
  FROM leaves l LEFT JOIN a USING (leaf) LEFT JOIN k USING (leaf) LEFT JOIN s USING (leaf) LEFT JOIN planned USING (leaf) WHERE expected > 0
  UNION SELECT leaf, 'empty_leaf_was_requested' FROM leaves JOIN e USING (leaf) WHERE expected = 0),
c AS (SELECT leaf, string_agg(reason, ',' ORDER BY reason) AS reasons FROM r GROUP BY leaf)
SELECT l.leaf, expected, CASE WHEN expected > 0 THEN CAST(ceil(expected / coalesce(a.width, 4)) AS BIGINT) ELSE 0 END AS pages_expected,
       coalesce(CASE WHEN expected > 0 THEN a.attempted ELSE e.attempted END, 0) AS pages_attempted, coalesce(completed, 0) AS pages_completed,
       coalesce(CASE WHEN expected > 0 THEN k.received ELSE e.received END, 0) AS received, coalesce(n_distinct, 0) AS n_distinct, coalesce(k.received - n_distinct, 0) AS repeats,
       CAST(coalesce(again, 0) AS BIGINT) AS repeated_sets, coalesce(conflicts, 0) AS conflicts, coalesce(changes, 0) AS total_changes, coalesce(sku_pairs, 0) AS sku_pairs,
       coalesce(reasons, '') AS reasons, reasons IS NULL AS proved
FROM leaves l LEFT JOIN a USING (leaf) LEFT JOIN k USING (leaf) LEFT JOIN s USING (leaf) LEFT JOIN q USING (leaf) LEFT JOIN e USING (leaf) LEFT JOIN c USING (leaf)""",
    "location_transitions": f"WITH {_TRANSITIONS_SQL.strip()}\nSELECT * FROM transitions",
    "location_proposals": f"""
WITH {_TRANSITIONS_SQL.strip()},
merged AS (
  SELECT c_custkey AS n, c_nationkey AS market_id, t.source_location_key AS key, t.evidence_ref AS ref, c_custkey % 7 = 0 AS extraction_enabled,
         CASE WHEN t.location_id IS NULL THEN 'none' WHEN c_custkey % 7 = 0 THEN 'enabled' ELSE 'proposed' END AS proposal
  FROM customer LEFT JOIN transitions t ON t.location_id = c_custkey AND t.status = 'city_binding_ready'),
after AS (
  SELECT *, CASE WHEN proposal = 'proposed' OR n % 4 <> 0 THEN 'city' ELSE 'unknown' END AS granularity, proposal = 'proposed' OR n % 5 = 0 AS confirmed FROM merged)
SELECT n AS location_id, market_id, granularity, confirmed AS technical_binding_confirmed, CASE WHEN proposal = 'proposed' THEN key END AS source_location_key,
       CASE WHEN proposal = 'proposed' THEN ref END AS evidence, extraction_enabled, proposal,
       CASE WHEN market_id IS NULL OR market_id = 13 OR market_id % 8 = 3 THEN 'supermarket_inactive' WHEN n % 17 = 0 THEN 'location_unavailable' WHEN n % 19 = 0 THEN 'location_out_of_scope'
            WHEN granularity = 'unknown' THEN 'location_granularity_unconfirmed' WHEN market_id % 2 = 0 AND NOT confirmed THEN 'technical_location_binding_unconfirmed'
            WHEN NOT extraction_enabled THEN 'extraction_disabled' ELSE '' END AS block FROM after""",
    "run_locations": """
WITH runs AS (
  SELECT CASE WHEN o_orderkey % 31 = 0 THEN -o_orderkey WHEN o_orderkey % 37 <> 0 THEN o_custkey END AS location_id,
         CASE WHEN o_orderkey % 11 = 0 THEN (c_nationkey + 1) % 27 ELSE c_nationkey END AS market_id FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT market_id, CASE WHEN NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = location_id) THEN 'unknown_location'
                       WHEN NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = market_id AND n_nationkey <> 13) THEN 'unknown_market'
                       WHEN (SELECT c_nationkey FROM customer WHERE c_custkey = location_id) <> market_id THEN 'other_market' ELSE '' END AS fault,
       count(*) AS n, count(location_id) AS n_located FROM runs GROUP BY ALL""",
}
