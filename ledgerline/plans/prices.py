"""Queries on states that change over time: identities, histories, price changes, runs and upserts.

The driver's tables have no catalog offers. A user of `events` stands for one: its event type is the state and its
value the price. Runs are the parts of the month before and from a day on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, pricing
from ..operators import aggregates, joins, scd2, sets
from ..sources.tables import read

#: What the stored state knows ends before the first day; the run that is applied begins on the second, so they overlap.
STORED_UNTIL, RUN_FROM = "2024-01-20", "2024-01-15"

PERIODS_SQL = """
marked AS (
  SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
periods AS (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to, before
  FROM marked WHERE n = 1 OR before IS DISTINCT FROM event_type)"""


def _shown(at: str) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.periods(read(spark, sf_dir, "events"), "user_id", "ts", "event_type", "event_id")


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of equal state of each user, and what changed."""
    fields = pricing.changed_fields({"event_type": (F.col("before"), F.col("event_type"))})
    change = pricing.change_kind(fields, F.col("before").isNull())
    return _periods(spark, sf_dir).select("user_id", "event_type", _shown("valid_from").alias("valid_from"), _shown("valid_to").alias("valid_to"), change.alias("change"))


def price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's value against the one before of its user: baseline, reduction and direction."""
    prices = read(spark, sf_dir, "events").withColumn("price", F.col("value").cast("decimal(18,4)"))
    spans = scd2.periods(prices, "user_id", "ts", "price", "event_id")
    return spans.select("user_id", _shown("valid_from").alias("valid_from"), "price", F.col("before").alias("baseline"), pricing.reduction(F.col("before"), F.col("price")).alias("reduction"), pricing.direction(F.col("before"), F.col("price")).alias("direction"))


def contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each user: periods, open ones, and ends that don't meet the next start once each fifth user's first period end is moved."""
    moved = F.when((F.col("user_id") % 5 == 0) & F.col("before").isNull() & F.col("valid_to").isNotNull(), F.col("valid_to") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("valid_to"))
    return scd2.contiguity(_periods(spark, sf_dir).withColumn("valid_to", moved), "user_id")


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the period of its user that holds it: periods don't overlap, so it is the latest that began."""
    events = read(spark, sf_dir, "events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    spans = _periods(spark, sf_dir).select("user_id", "event_type", "valid_from", "valid_to", F.lit(0).cast("long").alias("tie"))
    held = joins.asof(events, spans, "user_id", "ts", "valid_from", "tie", "event_id")
    return held.filter("r_valid_to is null or ts < r_valid_to").select("event_id", F.col("r_event_type").alias("state"), _shown("r_valid_from").alias("since"))


def _latest(rows: DataFrame) -> DataFrame:
    return aggregates.best_row(rows, "user_id", [F.col("ts"), F.col("event_id")], ["event_type", "ts"])


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(read(spark, sf_dir, "events").filter((F.col("ts") < F.lit(STORED_UNTIL).cast("timestamp_ntz")) & (F.col("user_id") % 7 != 0)))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").filter((F.col("ts") >= F.lit(RUN_FROM).cast("timestamp_ntz")) & (F.col("user_id") % 5 != 0))
    # Each third user was last seen on the run's first day, so some observations are out of order.
    return _latest(rows.filter((F.col("user_id") % 3 != 0) | (F.col("ts") < F.lit(RUN_FROM).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))))


def apply_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run does to each user's state: created, changed, confirmed, stale or untouched."""
    applied = scd2.apply_run(_stored(spark, sf_dir), _observed(spark, sf_dir), "user_id", "event_type", "ts")
    return applied.select("user_id", "old_state", "new_state", "action")


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many users a run creates, changes, confirms, finds stale and leaves."""
    return apply_run(spark, sf_dir).groupBy("action").agg(F.count("*").alias("n"))


def _customers(spark: SparkSession, sf_dir: str, remainder: int) -> DataFrame:
    rows = read(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 != remainder)
    return rows.select("c_custkey", F.when(F.col("c_custkey") % 11 == remainder, F.concat(F.lit("x"), F.col("c_mktsegment"))).otherwise(F.col("c_mktsegment")).alias("segment"), "c_nationkey")


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after a batch, and what happened to each row."""
    return scd2.upsert(_customers(spark, sf_dir, 0), _customers(spark, sf_dir, 1), ["c_custkey"])


def upsert_immutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where rows may not change: those that differ are conflicts and stay."""
    return scd2.upsert(_customers(spark, sf_dir, 0), _customers(spark, sf_dir, 1), ["c_custkey"], immutable=True)


def merge_preserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with stored balances, which stay where the segment asks for it and they aren't null."""
    rows = read(spark, sf_dir, "customer")
    kept = rows.filter(F.col("c_custkey") % 3 == 0).select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal") + 1).alias("stored"))
    joined = rows.join(kept, "c_custkey", "left")
    balance = scd2.preserved(F.col("c_acctbal"), F.col("stored"), F.col("c_mktsegment") != "BUILDING")
    return joined.select("c_custkey", F.round(balance, 2).alias("balance"))


def state_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity and hash of the state of each customer."""
    key = ids.stable_id("of_", custkey=F.col("c_custkey"), nationkey=F.col("c_nationkey"))
    state = ids.digest(name=F.col("c_name"), nationkey=F.col("c_nationkey"), segment=F.col("c_mktsegment"))
    return read(spark, sf_dir, "customer").select("c_custkey", key.alias("offer_id"), state.alias("state_hash"))


def order_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each order's lines that doesn't depend on their order; an order has few lines."""
    line = ids.canonical_json(line=F.col("l_linenumber"), part=F.col("l_partkey"), supp=F.col("l_suppkey"))
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return lines.select("l_orderkey", F.sha2(F.array_join("lines", ","), 256).alias("digest"))


def replay_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each line's key: rows and distinct contents; one content is a replay, more are a conflict."""
    content = F.concat_ws(":", "l_partkey", "l_suppkey")
    counted = sets.conflicts(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], content)
    verdict = F.when(F.col("n_contents") > 1, "conflict").when(F.col("n_rows") > 1, "replay").otherwise("single")
    return counted.withColumn("verdict", verdict)


def priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of each key: shipped first, then the dearest, then by the other keys."""
    order = [F.col("l_shipdate"), F.desc("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey")]
    return sets.keep_best(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def unknown_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part and supplier don't stand together in another line of an even order: violations of a reference."""
    rows = read(spark, sf_dir, "lineitem")
    known = rows.filter(F.col("l_orderkey") % 2 == 0)
    return joins.unmatched(rows, known, ["l_partkey", "l_suppkey"]).groupBy("l_partkey").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (scd2_history, price_change, contiguity, interval_join, apply_run, run_counters, upsert, upsert_immutable, merge_preserve, state_hash, order_digest, replay_check, priority_dedup, unknown_references)
}

_APPLY_SQL = f"""
stored AS (SELECT user_id, event_type, ts FROM events WHERE ts < TIMESTAMP '{STORED_UNTIL}' AND user_id % 7 <> 0
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
observed AS (SELECT user_id, event_type, ts FROM events
             WHERE ts >= TIMESTAMP '{RUN_FROM}' AND user_id % 5 <> 0 AND (user_id % 3 <> 0 OR ts < TIMESTAMP '{RUN_FROM}' + INTERVAL 1 DAY)
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
applied AS (
  SELECT coalesce(s.user_id, o.user_id) AS user_id, s.event_type AS old_state, o.event_type AS new_state,
         CASE WHEN o.user_id IS NULL THEN 'untouched' WHEN s.user_id IS NULL THEN 'created'
              WHEN s.event_type IS NOT DISTINCT FROM o.event_type THEN CASE WHEN o.ts < s.ts THEN 'stale' ELSE 'confirmed' END
              WHEN o.ts <= s.ts THEN 'stale' ELSE 'changed' END AS action
  FROM stored s FULL JOIN observed o ON s.user_id = o.user_id)"""

_UPSERT_SQL = """
WITH stored AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'x' || c_mktsegment ELSE c_mktsegment END AS segment, c_nationkey FROM customer WHERE c_custkey % 3 <> 0),
batch AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 1 THEN 'x' || c_mktsegment ELSE c_mktsegment END AS segment, c_nationkey FROM customer WHERE c_custkey % 3 <> 1)
SELECT coalesce(s.c_custkey, b.c_custkey) AS c_custkey,
       CASE WHEN b.c_custkey IS NULL OR (s.c_custkey IS NOT NULL AND {stays}) THEN s.segment ELSE b.segment END AS segment,
       coalesce(s.c_nationkey, b.c_nationkey) AS c_nationkey,
       CASE WHEN b.c_custkey IS NULL THEN 'kept' WHEN s.c_custkey IS NULL THEN 'created' WHEN s.segment = b.segment THEN 'replayed' ELSE '{differs}' END AS action
FROM stored s FULL JOIN batch b ON s.c_custkey = b.c_custkey"""

ORACLE_SQL = {
    "scd2_history": f"""
WITH {PERIODS_SQL}
SELECT user_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to,
       CASE WHEN before IS NULL THEN 'INITIAL' ELSE 'EVENT_TYPE' END AS change FROM periods""",
    "price_change": """
WITH p AS (SELECT user_id, ts, event_id, CAST(value AS DECIMAL(18,4)) AS price FROM events),
m AS (SELECT *, lag(price) OVER w AS before, row_number() OVER w AS n FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from, price, before AS baseline,
       CAST(CASE WHEN before > price THEN before - price ELSE 0 END AS DECIMAL(19,4)) AS reduction,
       CASE WHEN price IS NULL THEN 'unknown' WHEN before IS NULL THEN 'no_baseline' WHEN price > before THEN 'up' WHEN price < before THEN 'down' ELSE 'unchanged' END AS direction
FROM m WHERE n = 1 OR before IS DISTINCT FROM price""",
    "contiguity": f"""
WITH {PERIODS_SQL},
moved AS (SELECT user_id, valid_from, CASE WHEN user_id % 5 = 0 AND before IS NULL THEN valid_to - INTERVAL 1 SECOND ELSE valid_to END AS valid_to FROM periods),
followed AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS next FROM moved)
SELECT user_id, count(*) AS n_periods, count(*) FILTER (valid_to IS NULL) AS n_open, count(*) FILTER (next IS NOT NULL AND valid_to IS DISTINCT FROM next) AS n_broken
FROM followed GROUP BY user_id""",
    "interval_join": f"""
WITH {PERIODS_SQL}
SELECT e.event_id, p.event_type AS state, strftime(p.valid_from, '%Y-%m-%d %H:%M:%S.%f') AS since
FROM events e JOIN periods p ON e.user_id = p.user_id AND e.ts >= p.valid_from AND (p.valid_to IS NULL OR e.ts < p.valid_to)
WHERE e.event_type = 'purchase'""",
    "apply_run": f"WITH {_APPLY_SQL} SELECT user_id, old_state, new_state, action FROM applied",
    "run_counters": f"WITH {_APPLY_SQL} SELECT action, count(*) AS n FROM applied GROUP BY action",
    "upsert": _UPSERT_SQL.format(stays="FALSE", differs="updated"),
    "upsert_immutable": _UPSERT_SQL.format(stays="TRUE", differs="conflict"),
    "merge_preserve": """
SELECT c_custkey, round(CASE WHEN c_mktsegment <> 'BUILDING' AND c_custkey % 6 = 0 THEN c_acctbal + 1 ELSE c_acctbal END, 2) AS balance FROM customer""",
    "state_hash": """
SELECT c_custkey, 'of_' || substr(sha256(CAST(to_json({'custkey': c_custkey, 'nationkey': c_nationkey}) AS VARCHAR)), 1, 32) AS offer_id,
       sha256(CAST(to_json({'name': c_name, 'nationkey': c_nationkey, 'segment': c_mktsegment}) AS VARCHAR)) AS state_hash FROM customer""",
    "order_digest": """
WITH l AS (SELECT l_orderkey, CAST(to_json({'line': l_linenumber, 'part': l_partkey, 'supp': l_suppkey}) AS VARCHAR) AS x FROM lineitem)
SELECT l_orderkey, sha256(string_agg(x, ',' ORDER BY encode(x))) AS digest FROM l GROUP BY l_orderkey""",
    "replay_check": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT l_partkey || ':' || l_suppkey) AS n_contents,
       CASE WHEN n_contents > 1 THEN 'conflict' WHEN n_rows > 1 THEN 'replay' ELSE 'single' END AS verdict FROM lineitem GROUP BY ALL""",
    "priority_dedup": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_extendedprice DESC, l_partkey, l_suppkey) = 1""",
    "unknown_references": """
SELECT l_partkey, count(*) AS n FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem k WHERE k.l_orderkey % 2 = 0 AND k.l_partkey = l.l_partkey AND k.l_suppkey = l.l_suppkey) GROUP BY l_partkey""",
}
