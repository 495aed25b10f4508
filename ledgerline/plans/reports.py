"""Queries on offers for reports: all columns, and what keeps an offer out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import report
from ..operators.fixpoint import shares
from ..sources.tables import read

# What a source says of a part (p_...) in a market (m from 0 to 4), and of its state (price, stock); any SQL engine reads it.
_SAID = {
    "supermarket_id": "concat('market-', m)",
    "location_id": "concat('market-', m, '-city')",
    "location_status": "CASE WHEN m = 4 THEN 'unconfirmed' ELSE 'confirmed' END",
    "location_confidence": "CASE WHEN m <> 4 THEN CAST(0.9 AS DECIMAL(5,4)) END",
    "source_key_type": "CASE WHEN p_partkey % 3 = 0 THEN 'sku' ELSE 'url' END",
    "source_key": "concat('key-', p_partkey)",
    "source_sku": "CASE WHEN p_partkey % 3 = 0 THEN concat('sku-', p_partkey) END",
    "source_name": "concat(upper(substring(p_name, 1, 1)), substring(p_name, 2))",
    "normalized_name": "lower(p_name)",
    "source_brand": "p_brand",
    "normalized_brand": "lower(replace(p_brand, '#', ' '))",
    "source_presentation": "concat(p_size, ' x 100 g')",
    "source_category": "p_type",
    "barcode": "CASE WHEN p_partkey % 2 = 0 THEN concat('750', p_partkey) END",
    "category": "lower(p_type)",
    "subcategory": "CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END",
    "variant": "CAST(NULL AS VARCHAR(9))",
    "unit_count": "p_size",
    "content_per_unit": "CAST(100 AS DECIMAL(10,2))",
    "measurement_unit": "'g'",
    "total_content": "CAST(p_size * 100 AS DECIMAL(10,2))",
    "reported_regular_price": "CAST(p_retailprice * 2 AS DECIMAL(18,4))",
    "source_reports_promotion": "p_partkey % 4 = 0",
    "review_status": "CASE WHEN p_partkey % 5 = 0 THEN 'needs_review' ELSE 'accepted' END",
    "unit_price": "CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_size AS DECIMAL(18,4)) END",
    "unit_price_basis": "CASE WHEN p_partkey % 6 <> 0 THEN 'g' END",
    "product_url": "concat('https://market-', m, '.example/p/', p_partkey)",
    "image_url": "CASE WHEN p_partkey % 10 <> 0 THEN concat('https://img.example/', p_partkey) END",
}


def _offer(part: str, market: str) -> Column:
    return ids.stable_id("of_", market=F.col(market), part=F.col(part))


def _periods(lines: DataFrame, n: int) -> DataFrame:
    """Periods of each part's price and stock in five markets, as lines by day of shipment show them.

    Lines are dealt by offer over n tasks, without its id, and everything up to the report stays where its offer is: one shuffle and one sort.
    """
    lines = lines.select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_suppkey") % 5).alias("m"), F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,4)").alias("price")
    )
    dealt = lines.repartition(n, _offer("p_partkey", "m")).select(_offer("p_partkey", "m").alias("offer_id"), "*")
    dealt = dealt.filter("offer_id is not null")  # all are; as joins add this, both tables share the shuffle only with it
    last = F.max(F.struct("l_orderkey", "l_linenumber", "price")).alias("last")
    days = dealt.groupBy("offer_id", "day", "p_partkey", "m").agg(last)
    order = F.col("last.l_orderkey")
    price = F.when(order % 29 != 0, F.col("last.price"))
    seen = days.select("offer_id", "p_partkey", "m", "day", price.alias("price"), F.when(price.isNull(), "unknown").when(order % 7 == 0, "out_of_stock").otherwise("available").alias("availability"))
    w = Window.partitionBy("offer_id").orderBy("day")
    same = F.col("price").eqNullSafe(F.lag("price").over(w)) & F.col("availability").eqNullSafe(F.lag("availability").over(w))
    runs = seen.withColumn("starts", ~same)
    runs = runs.withColumn("ends", F.coalesce(F.lead("starts").over(w), F.lit(True)))
    # Of a period the first and the last day are left; the first has all of it.
    edges = runs.filter("starts or ends").select(
        "*", F.when(F.col("ends"), F.col("day")).otherwise(F.lead("day").over(w)).alias("last_observed_at"), F.when(F.col("ends"), F.lead("day").over(w)).otherwise(F.lead("day", 2).over(w)).alias("valid_to")
    )
    run = F.concat(F.lit("run-"), F.date_format("last_observed_at", "yyyyMMdd"))
    hashed = ids.digest(price=F.coalesce(F.col("price").cast("string"), F.lit("")), availability=F.col("availability"))
    return edges.filter("starts").withColumnRenamed("day", "valid_from").withColumns({"last_scrape_run_id": run, "state_hash": hashed, "currency": F.lit("HNL")})


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Current rows and history; for most rests of a part's number by 37 from 1 to 10 one of them is wrong in one way."""
    lines = read(spark, sf_dir, "lineitem")
    n = shares(lines)
    spans = _periods(lines, n)
    markets = read(spark, sf_dir, "part").select("*", F.explode(F.sequence(F.lit(0), F.lit(4)).cast("array<long>")).alias("m"))
    parts = markets.repartition(n, _offer("p_partkey", "m")).select(_offer("p_partkey", "m").alias("offer_id"), *(c for c in markets.columns if c != "m"))
    fault = F.col("p_partkey") % 37
    if_ = lambda k, wrong, right: F.when(fault == k, wrong).otherwise(F.col(right)).alias(right)
    said = [F.expr(text).alias(c) for c, text in _SAID.items()]
    made = [ids.stable_id("sp_", market=F.col("m"), key=F.col("p_partkey")).alias("source_product_id"), ids.stable_id("pr_", part=F.col("p_partkey")).alias("product_id")]
    current = spans.filter("valid_to is null").drop("p_partkey").join(parts, "offer_id").filter(fault != 1).select(
        "offer_id", *said, *made, "currency", F.col("price").alias("current_price"), "availability", if_(7, F.date_sub("valid_from", 1), "valid_from").alias("first_observed_at"),
        if_(8, F.date_add("last_observed_at", 1), "last_observed_at"), if_(9, F.lit("run-0"), "last_scrape_run_id"), if_(6, F.lit("0"), "state_hash"),
    )
    history = spans.filter(fault != 2).select(
        "offer_id", "valid_from", F.when((fault == 4) & F.col("valid_to").isNull(), F.date_add("last_observed_at", 9)).when(fault == 5, F.date_add("valid_to", 1)).otherwise(F.col("valid_to")).alias("valid_to"),
        if_(10, F.lit(1).cast("decimal(18,4)"), "price"), if_(3, F.lit("USD"), "currency"), "state_hash", "last_observed_at", "last_scrape_run_id",
    )
    return current, history


def offer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of all offers on which current rows and history agree: 43 columns."""
    return report.offers(*_tables(spark, sf_dir))


def offer_report_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every offer that the report leaves out, and why."""
    return report.reconciled(*_tables(spark, sf_dir)).filter("faults <> ''").select("offer_id", "faults")


QUERIES = {"offer_report": offer_report, "offer_report_faults": offer_report_faults}

_TABLES_SQL = f"""
days AS (
  SELECT l_partkey AS p_partkey, l_suppkey % 5 AS m, CAST(l_shipdate AS DATE) AS day,
         arg_max(struct_pack(o := l_orderkey, p := CAST(l_extendedprice AS DECIMAL(18,4))), (l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,4)))) AS top FROM lineitem GROUP BY ALL),
seen AS (
  SELECT p_partkey, m, day, CASE WHEN top.o % 29 <> 0 THEN top.p END AS price,
         CASE WHEN top.o % 29 = 0 THEN 'unknown' WHEN top.o % 7 = 0 THEN 'out_of_stock' ELSE 'available' END AS availability FROM days),
marks AS (SELECT *, coalesce(CAST(price AS VARCHAR), '') || availability AS state FROM seen),
turns AS (SELECT *, CASE WHEN lag(state) OVER w = state THEN 0 ELSE 1 END AS turn FROM marks WINDOW w AS (PARTITION BY p_partkey, m ORDER BY day)),
runs AS (SELECT *, sum(turn) OVER (PARTITION BY p_partkey, m ORDER BY day) AS period FROM turns),
spans AS (
  SELECT p_partkey, m, period, min(day) AS valid_from, max(day) AS last_observed_at, any_value(price) AS price, any_value(availability) AS availability,
         lead(min(day)) OVER (PARTITION BY p_partkey, m ORDER BY period) AS valid_to,
         lag(any_value(price)) OVER (PARTITION BY p_partkey, m ORDER BY period) AS old_price, lag(max(day)) OVER (PARTITION BY p_partkey, m ORDER BY period) AS old_day,
         count(*) OVER (PARTITION BY p_partkey, m) AS n_periods,
         'of_' || left(sha256('{{"market":' || m || ',"part":' || p_partkey || '}}'), 32) AS offer_id FROM runs GROUP BY p_partkey, m, period)"""

ORACLE_SQL = {
    "offer_report": f"""
WITH {_TABLES_SQL.strip()}
SELECT offer_id, {", ".join(f"{text} AS {c}" for c, text in _SAID.items())},
       'sp_' || left(sha256('{{"key":' || p_partkey || ',"market":' || m || '}}'), 32) AS source_product_id, 'pr_' || left(sha256('{{"part":' || p_partkey || '}}'), 32) AS product_id,
       'HNL' AS currency, price AS current_price, old_price AS previous_accepted_price,
       CASE WHEN price IS NOT NULL AND old_price IS NOT NULL THEN CAST(CASE WHEN old_price > price THEN old_price - price ELSE 0 END AS DECIMAL(19,4)) END AS real_reduction_amount,
       CASE WHEN price IS NOT NULL AND old_price > 0 THEN round(CASE WHEN old_price > price THEN CAST(old_price - price AS DOUBLE) / CAST(old_price AS DOUBLE) ELSE 0 END, 6) END AS real_reduction_ratio,
       coalesce(old_price > price, FALSE) AS is_real_reduction,
       CASE WHEN price IS NULL THEN 'unknown' WHEN old_price IS NULL THEN 'no_baseline' WHEN price = old_price THEN 'same' WHEN price < old_price THEN 'down' ELSE 'up' END AS price_direction,
       availability, last_observed_at AS current_observed_at_utc, old_day AS previous_observed_at_utc, 'run-' || strftime(last_observed_at, '%Y%m%d') AS current_scrape_run_id,
       'run-' || strftime(old_day, '%Y%m%d') AS previous_scrape_run_id
FROM spans JOIN part USING (p_partkey)
WHERE valid_to IS NULL AND (p_partkey % 37 NOT BETWEEN 1 AND 10 OR p_partkey % 37 = 5 AND n_periods = 1 OR p_partkey % 37 = 10 AND price = 1)""",
    # A fault each by the rest of the part's number; shifted ends break a chain of two periods or more only.
    "offer_report_faults": f"""
WITH {_TABLES_SQL.strip()}
SELECT offer_id, (['not_current', 'no_history', 'currency_differs', 'not_one_open_period_at_the_end', 'chain_broken', 'state_differs', 'first_observation_differs', 'last_observation_differs',
                   'last_run_differs', 'price_differs'])[p_partkey % 37] AS faults
FROM spans JOIN part USING (p_partkey) WHERE valid_to IS NULL AND p_partkey % 37 BETWEEN 1 AND 10 AND NOT (p_partkey % 37 = 5 AND n_periods = 1) AND NOT (p_partkey % 37 = 10 AND price IS NOT DISTINCT FROM 1)""",
}
