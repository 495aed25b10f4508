"""Offers for reports: the current row of each with its last accepted period before, if the two tables agree on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pricing

# The columns of a report, in their order; those of PRICED follow from the history.
COLUMNS = (
    "offer_id", "supermarket_id", "location_id", "location_status", "location_confidence", "source_product_id", "product_id", "source_key_type", "source_key", "source_sku", "source_name",
    "normalized_name", "source_brand", "normalized_brand", "source_presentation", "source_category", "barcode", "category", "subcategory", "variant", "unit_count", "content_per_unit",
    "measurement_unit", "total_content", "currency", "current_price", "previous_accepted_price", "real_reduction_amount", "real_reduction_ratio", "is_real_reduction", "price_direction",
    "reported_regular_price", "source_reports_promotion", "availability", "review_status", "unit_price", "unit_price_basis", "current_observed_at_utc", "previous_observed_at_utc",
    "current_scrape_run_id", "previous_scrape_run_id", "product_url", "image_url",
)
PRICED = (
    "previous_accepted_price", "real_reduction_amount", "real_reduction_ratio", "is_real_reduction", "price_direction", "current_observed_at_utc", "previous_observed_at_utc",
    "current_scrape_run_id", "previous_scrape_run_id",
)


def _last_periods(history: DataFrame) -> DataFrame:
    """A row for each offer: its last period, the one before, and whether the periods form a chain with one open end."""
    w = Window.partitionBy("offer_id").orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    one = F.struct("valid_from", "valid_to", "price", "state_hash", "last_observed_at", "last_scrape_run_id")
    rows = history.select("offer_id", "valid_from", "valid_to", "currency", one.alias("own"), F.lag(one).over(w).alias("before"), F.lead("valid_from").over(w).alias("next"), F.row_number().over(w).alias("n"))
    broken = (F.col("next").isNotNull() & ~F.col("valid_to").eqNullSafe(F.col("next"))) | F.col("valid_from").isNull() | (F.col("valid_to") <= F.col("valid_from"))
    return rows.groupBy("offer_id").agg(
        F.max_by("own", "n").alias("own"), F.max_by("before", "n").alias("before"), F.count_if(F.col("valid_to").isNull()).alias("n_open"), F.bool_or(F.coalesce(broken, F.lit(False))).alias("broken"),
        F.min("currency").alias("least_currency"), F.max("currency").alias("most_currency"), F.count_if(F.col("currency").isNull()).alias("no_currency"),
    )


def reconciled(current: DataFrame, history: DataFrame) -> DataFrame:
    """All columns of a report for each offer of either table, and `faults`: by name, comma-joined, empty where the tables agree.

    Args:
        current: offer_id (unique), every column of COLUMNS but PRICED, and first_observed_at, last_observed_at,
            last_scrape_run_id, state_hash.
        history: offer_id, valid_from, valid_to (null: open), price, currency, state_hash, last_observed_at, last_scrape_run_id.

    The price before is that of the period before the open one, whatever a source says it charged regularly. Without either price
    there is no reduction (null); with a price before of 0 there is no ratio. An offer with a null id meets no other. Other columns are
    ignored. Both tables are shuffled by offer, the history once for its order and its sums.
    """
    own, before = "h.own.", "h.before."
    a = current.select(*(c for c in COLUMNS if c not in PRICED), "first_observed_at", "last_observed_at", "last_scrape_run_id", "state_hash", F.lit(True).alias("stored")).alias("c")
    h = _last_periods(history).withColumn("stored", F.lit(True)).alias("h")
    both = a.join(h, "offer_id", "full")
    differs = lambda c, period: ~F.col(c).eqNullSafe(F.col(own + period))
    one_currency = (F.col("no_currency") == 0) & (F.col("least_currency") == F.col("c.currency")) & (F.col("most_currency") == F.col("c.currency"))
    checks: dict[str, Column] = {
        "chain_broken": F.col("broken"),
        "currency_differs": ~F.coalesce(one_currency, F.lit(False)),
        "first_observation_differs": differs("c.first_observed_at", "valid_from"),
        "last_observation_differs": differs("c.last_observed_at", "last_observed_at"),
        "last_run_differs": differs("c.last_scrape_run_id", "last_scrape_run_id"),
        "not_one_open_period_at_the_end": (F.col("n_open") != 1) | F.col(own + "valid_to").isNotNull(),
        "price_differs": differs("c.current_price", "price"),
        "state_differs": differs("c.state_hash", "state_hash"),
    }
    alone = F.when(F.col("c.stored").isNull(), F.array(F.lit("not_current"))).when(F.col("h.stored").isNull(), F.array(F.lit("no_history")))
    faults = F.coalesce(alone, F.array_compact(F.array(*(F.when(checks[c], c) for c in sorted(checks)))))
    now, was = F.col("c.current_price"), F.col(before + "price")
    amount = F.when(now.isNotNull() & was.isNotNull(), pricing.reduction(was, now))
    priced = {
        "previous_accepted_price": was,
        "real_reduction_amount": amount,
        "real_reduction_ratio": F.when(was > 0, F.round((amount / was).cast("double"), 6)),
        "is_real_reduction": F.coalesce(amount > 0, F.lit(False)),
        "price_direction": F.when(now == was, "same").otherwise(pricing.direction(was, now)),
        "current_observed_at_utc": F.col("c.last_observed_at"),
        "previous_observed_at_utc": F.col(before + "last_observed_at"),
        "current_scrape_run_id": F.col("c.last_scrape_run_id"),
        "previous_scrape_run_id": F.col(before + "last_scrape_run_id"),
    }
    carried = lambda c: F.col("offer_id") if c == "offer_id" else F.col(f"c.{c}")
    return both.select(*((priced[c] if c in PRICED else carried(c)).alias(c) for c in COLUMNS), F.array_join(faults, ",").alias("faults"))


def offers(current: DataFrame, history: DataFrame) -> DataFrame:
    """The report: its columns alone, for the offers on which both tables agree. `reconciled` tells why others are missing."""
    return reconciled(current, history).filter("faults = ''").select(*COLUMNS)
