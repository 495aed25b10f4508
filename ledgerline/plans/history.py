"""Queries on the store of catalog states: runs merged into a history, what speaks against a run, restoring, projecting.

A user of `events` stands for an offer, its event type for the state and its value for the price. What is stored ends
before one day, and the run begins on an earlier one, so some of its observations are out of order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids, pricing
from ..operators import binding, scd2
from ..sources.tables import read
from . import evidence
from .prices import RUN_FROM, STORED_UNTIL, _latest, _observed, _shown

_SHOWN = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"


def _stored_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, event_type, valid_from, valid_to and last_observed (of the open period) of the stored history."""
    log = read(spark, sf_dir, "events").filter((F.col("ts") < F.lit(STORED_UNTIL).cast("timestamp_ntz")) & (F.col("user_id") % 7 != 0))
    last = _latest(log).select("user_id", F.col("ts").alias("last_observed"))
    return scd2.periods(log, "user_id", "ts", "event_type", "event_id").join(last, "user_id").select("user_id", "event_type", "valid_from", "valid_to", "last_observed")


def _visible(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "event_type", *(_shown(c).alias(c) for c in ("valid_from", "valid_to", "last_observed")), "action")


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after a run: periods closed, opened and confirmed."""
    return _visible(scd2.merge_run(_stored_periods(spark, sf_dir), _observed(spark, sf_dir), "user_id", "event_type", "ts"))


def _run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run as it came: an observation an event, some with a wrong hash, a wrong identity or from after the decision."""
    rows = read(spark, sf_dir, "events").filter(F.col("ts") >= F.lit(RUN_FROM).cast("timestamp_ntz"))
    state = ids.digest(event_type=F.col("event_type"), value=F.col("value"))
    offer = ids.stable_id("of_", user=F.col("user_id"))
    return rows.select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.when(F.col("event_id") % 97 == 0, F.reverse(state)).otherwise(state).alias("state_hash"),
        F.when(F.col("event_id") % 89 == 0, F.lit("of_0")).otherwise(offer).alias("offer_id"),
        (F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")).alias("decided_at"),
    )


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _run_rows(spark, sf_dir).join(_latest(read(spark, sf_dir, "events").filter(F.col("ts") < F.lit(STORED_UNTIL).cast("timestamp_ntz"))).select("user_id", F.col("ts").alias("last_at"), F.col("event_type").alias("last_state")), "user_id", "left")
    again = F.count("*").over(Window.partitionBy("user_id", "ts")) > 1
    same = F.col("event_type") == F.col("last_state")
    rows = rows.withColumn("again", again)
    return scd2.rule_counts(
        rows,
        repeated_observation=F.col("again"),
        wrong_identity=F.col("offer_id") != ids.stable_id("of_", user=F.col("user_id")),
        wrong_hash=F.col("state_hash") != ids.digest(event_type=F.col("event_type"), value=F.col("value")),
        after_decision=F.col("ts") > F.col("decided_at"),
        out_of_order=(same & (F.col("ts") < F.col("last_at"))) | (~same & (F.col("ts") <= F.col("last_at"))),
        negative_value=F.col("value") < 0,
        missing_state=F.trim("event_type") == "",
    )


def run_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of a run break each rule that must hold before it may change anything."""
    return _violations(spark, sf_dir)


def scd2_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after a run that may not change anything, as rows of it break a rule: all or nothing."""
    gate = _violations(spark, sf_dir).agg((F.sum("n") > 0).alias("rejected"))
    merged = scd2.merge_run(_stored_periods(spark, sf_dir), _observed(spark, sf_dir), "user_id", "event_type", "ts", gate)
    return merged.groupBy("action").agg(F.count("*").alias("n"), F.count_if(F.col("valid_to").isNull()).alias("n_open"))


def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's record: its status and its counts, which are zero where it may not change anything; with its digest."""
    rows = _run_rows(spark, sf_dir)
    actions = scd2.merge_run(_stored_periods(spark, sf_dir), _observed(spark, sf_dir), "user_id", "event_type", "ts").filter("valid_to is null").groupBy().pivot("action", ["created", "changed", "confirmed", "stale", "untouched"]).count()
    broken = _violations(spark, sf_dir).agg(F.sum("n").alias("violations"))
    # The root of a tree of digests binds the record to its rows in any order.
    root = binding.merkle_roots(rows, [], ["event_id", "state_hash"]).select(F.col("root").alias("evidence"))
    bound = rows.agg(F.count("*").alias("observed"), _shown(F.min("ts")).alias("first_seen"), _shown(F.max("ts")).alias("last_seen"))
    joined = bound.crossJoin(F.broadcast(root)).crossJoin(F.broadcast(broken)).crossJoin(F.broadcast(actions))  # four tables of one row
    free = F.col("violations") == 0
    counts = [F.when(free, F.coalesce(c, F.lit(0))).otherwise(0).alias(c) for c in ("created", "changed", "confirmed")]
    return joined.select(F.when(free, "APPLIED").otherwise("REJECTED").alias("status"), "observed", "violations", "evidence", "first_seen", "last_seen", *counts)


def _closed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as a table of text keeps it: ids, hashes and times in text, empty for none; some cells damaged."""
    spans = _stored_periods(spark, sf_dir)
    offer, state = ids.stable_id("of_", user=F.col("user_id")), ids.digest(event_type=F.col("event_type"))
    n = F.col("user_id") % 50
    return spans.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(n == 1, F.lit("")).when(n == 2, F.concat(F.lit(" "), "event_type")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(n == 3, F.lit("of_x")).otherwise(offer).alias("offer_id"),
        F.when(n == 4, F.upper(state)).otherwise(state).alias("state_hash"),
        F.when(n == 5, F.lit("yesterday")).otherwise(_shown("valid_from")).alias("valid_from"),
        F.coalesce(_shown("valid_to"), F.lit("")).alias("valid_to"),
    )


def _typed(rows: DataFrame) -> DataFrame:
    at = lambda c: F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz")
    return rows.select(
        F.col("user_id").try_cast("long").alias("user_id"), "event_type", "offer_id", "state_hash", at("valid_from").alias("valid_from"), at("valid_to").alias("valid_to"),
        ((F.col("event_type") != F.trim("event_type")) | (F.col("event_type") == "")).alias("bad_cell"), (F.col("valid_to") == "").alias("is_open"),
    )


def rehydrate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows read back to typed ones: how many break each rule of a closed table."""
    rows = _typed(_closed_rows(spark, sf_dir)).withColumn("next", F.lead("valid_from").over(Window.partitionBy("user_id").orderBy("valid_from")))
    return scd2.rule_counts(
        rows,
        bad_cell=F.col("bad_cell"),
        bad_time=F.col("valid_from").isNull(),
        wrong_identity=F.col("offer_id") != ids.stable_id("of_", user=F.col("user_id")),
        wrong_hash=F.col("state_hash") != ids.digest(event_type=F.col("event_type")),
        backwards=F.col("valid_to") <= F.col("valid_from"),
        not_contiguous=F.col("next").isNotNull() & ~F.col("next").eqNullSafe(F.col("valid_to")),
    )


def restored_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state that rows of text restore: keys whose rows all hold, with their one open period."""
    rows = _typed(_closed_rows(spark, sf_dir))
    good = ~F.col("bad_cell") & F.col("valid_from").isNotNull() & (F.col("offer_id") == ids.stable_id("of_", user=F.col("user_id"))) & (F.col("state_hash") == ids.digest(event_type=F.col("event_type")))
    open_ = F.max(F.when(F.col("is_open"), F.struct("valid_from", "event_type"))).alias("open")
    keys = rows.groupBy("user_id").agg(F.count_if(~F.coalesce(good, F.lit(False))).alias("bad"), F.count_if(F.col("is_open")).alias("n_open"), F.count("*").alias("n_periods"), open_)
    return keys.filter("bad = 0 and n_open = 1").select("user_id", "n_periods", F.col("open.event_type").alias("event_type"), _shown("open.valid_from").alias("valid_from"))


def run_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs (days) that the history refers to by the start and end of its periods, against the log of runs: unknown ones
    and those without authority."""
    spans = _stored_periods(spark, sf_dir)
    used = spans.select("user_id", F.explode(F.array_compact(F.array("valid_from", "valid_to"))).alias("at")).select("user_id", F.to_date("at").alias("run"))
    log = read(spark, sf_dir, "events").select(F.to_date("ts").alias("run")).distinct().filter(F.dayofmonth("run") % 6 != 0).select("run", (F.dayofmonth("run") % 4 != 0).alias("authority"))
    verdict = F.when(F.col("authority").isNull(), "unknown").when(~F.col("authority"), "no_authority").otherwise("known")
    return used.join(log, "run", "left").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))


def bi_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each offer's current price with the period before: what a report reads, in the order of its columns."""
    prices = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("value").cast("decimal(18,4)").alias("price"))
    spans = scd2.periods(prices, "user_id", "ts", "price", "event_id")
    w = Window.partitionBy("user_id").orderBy("valid_from")
    rows = spans.select("user_id", "price", "valid_from", "valid_to", F.col("before").alias("previous"), F.lag("valid_from").over(w).alias("previous_from"), F.row_number().over(w).alias("period"))
    now, before = F.col("price"), F.col("previous")
    amount = pricing.reduction(before, now)
    ratio = F.when(before > 0, F.round((amount / before).cast("double"), 6))
    return rows.filter("valid_to is null").select(
        ids.stable_id("of_", user=F.col("user_id")).alias("offer_id"), "user_id", F.col("period").cast("long").alias("period"), "price", F.col("previous").alias("previous_price"),
        _shown("valid_from").alias("valid_from"), _shown("previous_from").alias("previous_from"), amount.alias("reduction"), ratio.alias("reduction_ratio"), (amount > 0).alias("is_reduced"),
        pricing.direction(before, now).alias("direction"), F.date_format("valid_from", "yyyyMMdd").cast("long").alias("date_key"),
    )


def store_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a run's batch writes to each table of the store, and whether a table that must not be is empty."""
    merged = scd2.merge_run(_stored_periods(spark, sf_dir), _observed(spark, sf_dir), "user_id", "event_type", "ts")
    tables = merged.select(F.explode(F.array_compact(F.array(
        F.when(F.col("valid_to").isNull(), F.struct(F.lit("current").alias("name"), F.col("action"))),
        F.struct(F.lit("history").alias("name"), F.col("action")),
        F.when(F.col("action").isin("created", "changed"), F.struct(F.lit("changes").alias("name"), F.col("action"))),
        F.when(F.col("action") == "stale", F.struct(F.lit("quality").alias("name"), F.col("action"))),
    ))).alias("t")).select("t.*")
    wrote = F.col("action").isin("created", "changed", "confirmed")
    return tables.groupBy("name").agg(F.count("*").alias("n_rows"), F.count_if(wrote).alias("n_written"), F.count_if(~wrote).alias("n_kept")).withColumn("required_and_empty", F.col("name").isin("current", "history") & (F.col("n_rows") == 0))


QUERIES = {f.__name__: f for f in (scd2_merge, run_violations, scd2_guarded, run_record, rehydrate_checks, restored_state, run_references, bi_projection, store_batch)}

_LOG_SQL = f"""
stored AS (SELECT user_id, event_type, ts, event_id FROM events WHERE ts < TIMESTAMP '{STORED_UNTIL}' AND user_id % 7 <> 0),
marked AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS n, max(ts) OVER (PARTITION BY user_id) AS last_observed
           FROM stored WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
spans AS (SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to, last_observed
          FROM marked WHERE n = 1 OR before IS DISTINCT FROM event_type)"""
_MERGE_SQL = f"""{_LOG_SQL},
observed AS (SELECT user_id, event_type, ts FROM events
             WHERE ts >= TIMESTAMP '{RUN_FROM}' AND user_id % 5 <> 0 AND (user_id % 3 <> 0 OR ts < TIMESTAMP '{RUN_FROM}' + INTERVAL 1 DAY)
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
met AS (
  SELECT coalesce(s.user_id, o.user_id) AS user_id, s.event_type AS old, o.event_type AS new, s.valid_from, s.last_observed, o.ts,
         CASE WHEN o.user_id IS NULL THEN 'untouched' WHEN s.user_id IS NULL THEN 'created'
              WHEN s.event_type = o.event_type THEN CASE WHEN o.ts < s.last_observed THEN 'stale' ELSE 'confirmed' END
              WHEN o.ts <= s.last_observed THEN 'stale' ELSE 'changed' END AS action
  FROM (SELECT * FROM spans WHERE valid_to IS NULL) s FULL JOIN observed o ON s.user_id = o.user_id),
merged AS (
  SELECT user_id, old AS event_type, valid_from, CASE WHEN action = 'changed' THEN ts END AS valid_to,
         CASE WHEN action = 'confirmed' THEN ts ELSE last_observed END AS last_observed, action FROM met WHERE action <> 'created'
  UNION ALL SELECT user_id, new, ts, NULL, ts, action FROM met WHERE action IN ('created', 'changed')
  UNION ALL SELECT user_id, event_type, valid_from, valid_to, last_observed, 'closed' FROM spans WHERE valid_to IS NOT NULL)"""
_STATE = "sha256(CAST(to_json({'event_type': event_type, 'value': value}) AS VARCHAR))"
_OFFER = "'of_' || substr(sha256(CAST(to_json({'user': user_id}) AS VARCHAR)), 1, 32)"
_RUN_SQL = f"""
run AS (
  SELECT event_id, user_id, event_type, value, ts, CASE WHEN event_id % 97 = 0 THEN reverse({_STATE}) ELSE {_STATE} END AS state_hash,
         CASE WHEN event_id % 89 = 0 THEN 'of_0' ELSE {_OFFER} END AS offer_id
  FROM events WHERE ts >= TIMESTAMP '{RUN_FROM}'),
latest AS (SELECT user_id, ts AS last_at, event_type AS last_state FROM events WHERE ts < TIMESTAMP '{STORED_UNTIL}'
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
judged AS (SELECT run.*, last_at, last_state, count(*) OVER (PARTITION BY run.user_id, ts) > 1 AS again FROM run LEFT JOIN latest ON run.user_id = latest.user_id),
violations AS (
  SELECT 'repeated_observation' AS rule, count(*) FILTER (again) AS n FROM judged
  UNION ALL SELECT 'wrong_identity', count(*) FILTER (offer_id <> {_OFFER}) FROM judged
  UNION ALL SELECT 'wrong_hash', count(*) FILTER (state_hash <> {_STATE}) FROM judged
  UNION ALL SELECT 'after_decision', count(*) FILTER (ts > TIMESTAMP '2024-01-30 12:00:00') FROM judged
  UNION ALL SELECT 'out_of_order', count(*) FILTER (CASE WHEN event_type = last_state THEN ts < last_at ELSE ts <= last_at END) FROM judged
  UNION ALL SELECT 'negative_value', count(*) FILTER (value < 0) FROM judged
  UNION ALL SELECT 'missing_state', count(*) FILTER (trim(event_type) = '') FROM judged)"""
_HASH = "sha256(CAST(to_json({'event_type': event_type}) AS VARCHAR))"
_TEXT_SQL = f"""{_LOG_SQL},
cells AS (
  SELECT user_id, CASE WHEN user_id % 50 = 1 THEN '' WHEN user_id % 50 = 2 THEN ' ' || event_type ELSE event_type END AS event_type,
         user_id % 50 NOT IN (3) AS good_id, user_id % 50 NOT IN (1, 2, 4) AS good_hash, CASE WHEN user_id % 50 <> 5 THEN valid_from END AS valid_from, valid_to, valid_to IS NULL AS is_open
  FROM spans),
followed AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from NULLS FIRST) AS next FROM cells)"""

ORACLE_SQL = {
    "scd2_merge": f"WITH {_MERGE_SQL} SELECT user_id, event_type, {_SHOWN.format('valid_from')}, {_SHOWN.format('valid_to')}, {_SHOWN.format('last_observed')}, action FROM merged",
    "run_violations": f"WITH {_RUN_SQL} SELECT * FROM violations",
    "scd2_guarded": f"""
WITH {_MERGE_SQL}, {_RUN_SQL.lstrip()},
gate AS (SELECT sum(n) > 0 AS rejected FROM violations)
SELECT CASE WHEN valid_to IS NULL THEN 'untouched' ELSE 'closed' END AS action, count(*) AS n, count(*) FILTER (valid_to IS NULL) AS n_open
FROM spans, gate WHERE rejected GROUP BY 1
UNION ALL SELECT action, count(*), count(*) FILTER (valid_to IS NULL) FROM merged, gate WHERE NOT rejected GROUP BY 1""",
    "run_record": f"""
WITH {_MERGE_SQL}, {_RUN_SQL.lstrip()},
v AS (SELECT CAST(sum(n) AS BIGINT) AS violations FROM violations),
said AS (SELECT 0 AS run, sha256('{{"event_id":' || event_id || ',"state_hash":"' || state_hash || '"}}') AS digest FROM run),{evidence.tree_sql("t", "said")},
c AS (SELECT count(*) FILTER (action = 'created') AS created, count(*) FILTER (action = 'changed') AS changed, count(*) FILTER (action = 'confirmed') AS confirmed FROM merged WHERE valid_to IS NULL)
SELECT CASE WHEN violations = 0 THEN 'APPLIED' ELSE 'REJECTED' END AS status, count(*) AS observed, violations,
       (SELECT node FROM t_n3) AS evidence,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen,
       CASE WHEN violations = 0 THEN created ELSE 0 END AS created, CASE WHEN violations = 0 THEN changed ELSE 0 END AS changed, CASE WHEN violations = 0 THEN confirmed ELSE 0 END AS confirmed
FROM run, v, c GROUP BY ALL""",
    "rehydrate_checks": f"""
WITH {_TEXT_SQL}
SELECT 'bad_cell' AS rule, count(*) FILTER (event_type <> trim(event_type) OR event_type = '') AS n FROM followed
UNION ALL SELECT 'bad_time', count(*) FILTER (valid_from IS NULL) FROM followed
UNION ALL SELECT 'wrong_identity', count(*) FILTER (NOT good_id) FROM followed
UNION ALL SELECT 'wrong_hash', count(*) FILTER (NOT good_hash) FROM followed
UNION ALL SELECT 'backwards', count(*) FILTER (valid_to <= valid_from) FROM followed
UNION ALL SELECT 'not_contiguous', count(*) FILTER (next IS NOT NULL AND next IS DISTINCT FROM valid_to) FROM followed""",
    "restored_state": f"""
WITH {_TEXT_SQL}
SELECT user_id, count(*) AS n_periods, max(event_type) FILTER (is_open) AS event_type, strftime(max(valid_from) FILTER (is_open), '%Y-%m-%d %H:%M:%S.%f') AS valid_from
FROM followed GROUP BY user_id
HAVING count(*) FILTER (NOT (event_type = trim(event_type) AND event_type <> '' AND valid_from IS NOT NULL AND good_id AND good_hash)) = 0 AND count(*) FILTER (is_open) = 1""",
    "run_references": f"""
WITH {_LOG_SQL},
used AS (SELECT user_id, CAST(valid_from AS DATE) AS run FROM spans UNION ALL SELECT user_id, CAST(valid_to AS DATE) FROM spans WHERE valid_to IS NOT NULL),
log AS (SELECT DISTINCT CAST(ts AS DATE) AS run FROM events)
SELECT CASE WHEN day(used.run) % 6 = 0 OR log.run IS NULL THEN 'unknown' WHEN day(used.run) % 4 = 0 THEN 'no_authority' ELSE 'known' END AS verdict, count(*) AS n, count(DISTINCT user_id) AS n_users
FROM used LEFT JOIN log ON used.run = log.run GROUP BY 1""",
    "bi_projection": f"""
WITH p AS (SELECT user_id, ts, event_id, CAST(value AS DECIMAL(18,4)) AS price FROM events),
m AS (SELECT *, lag(price) OVER w AS before, row_number() OVER w AS n FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, price, ts AS valid_from, before, lag(ts) OVER w AS previous_from, row_number() OVER w AS period, lead(ts) OVER w AS valid_to
      FROM m WHERE n = 1 OR before IS DISTINCT FROM price WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT {_OFFER} AS offer_id, user_id, period, price, before AS previous_price, {_SHOWN.format('valid_from')}, {_SHOWN.format('previous_from')},
       CAST(CASE WHEN before > price THEN before - price ELSE 0 END AS DECIMAL(19,4)) AS reduction,
       CASE WHEN before > 0 THEN round(CASE WHEN before > price THEN (before - price) / before ELSE 0 END, 6) END AS reduction_ratio,
       coalesce(before > price, FALSE) AS is_reduced,
       CASE WHEN price IS NULL THEN 'unknown' WHEN before IS NULL THEN 'no_baseline' WHEN price > before THEN 'up' WHEN price < before THEN 'down' ELSE 'unchanged' END AS direction,
       CAST(strftime(valid_from, '%Y%m%d') AS BIGINT) AS date_key
FROM s WHERE valid_to IS NULL""".replace("round(CASE", "round(CASE"),
    "store_batch": f"""
WITH {_MERGE_SQL},
t AS (SELECT 'current' AS name, action FROM merged WHERE valid_to IS NULL UNION ALL SELECT 'history', action FROM merged
      UNION ALL SELECT 'changes', action FROM merged WHERE action IN ('created', 'changed') UNION ALL SELECT 'quality', action FROM merged WHERE action = 'stale')
SELECT name, count(*) AS n_rows, count(*) FILTER (action IN ('created', 'changed', 'confirmed')) AS n_written, count(*) FILTER (action NOT IN ('created', 'changed', 'confirmed')) AS n_kept,
       name IN ('current', 'history') AND count(*) = 0 AS required_and_empty FROM t GROUP BY name""",
}
