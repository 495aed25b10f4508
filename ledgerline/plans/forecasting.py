"""Queries on forecasts: runs from month to month over the calendar, and what results say of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import forecasts
from ..sources.tables import read
from .contests import MATCHES_SQL, matches

_HORIZON = 62


def _played(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("match_id"), F.to_date("o_orderdate").alias("day"))
    return matches(spark, sf_dir).join(days, "match_id").select("match_id", "day", "team_a", "team_b", "goals_a", "goals_b")


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run at the first of each month that has orders, and in every third month a second one later that day."""
    months = read(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("MM", "o_orderdate")).alias("run_day")).distinct()
    hour = F.explode(F.when(F.month("run_day") % 3 == 0, F.array(F.lit(12), F.lit(18))).otherwise(F.array(F.lit(12)))).alias("hour")
    runs = months.select("run_day", hour).select(F.concat_ws("-", F.date_format("run_day", "yyyyMMdd"), "hour").alias("run_id"), F.concat_ws(" ", F.date_format("run_day", "yyyy-MM-dd"), "hour").alias("run_at"), "run_day")
    n = F.col("n_nationkey").cast("long")
    ratings = read(spark, sf_dir, "nation").filter(n != 7).select(n.alias("team"), (1000 + n * 17 % 25 * 20).cast("double").alias("points"), F.when(n % 5 != 0, 1500 + n * 11 % 25 * 15).cast("double").alias("elo"))
    played = _played(spark, sf_dir)
    return forecasts.forecasts(played, played.filter("team_a <> 9 and team_b <> 9"), ratings, runs, _HORIZON)


def forecast_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All forecasts of all runs: each from the results up to its day."""
    return _forecasts(spark, sf_dir)


def forecast_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match with the forecast that counts for it, and whether it was right."""
    return forecasts.validated(_played(spark, sf_dir), _forecasts(spark, sf_dir))


QUERIES = {"forecast_runs": forecast_runs, "forecast_validation": forecast_validation}

# The weights as of each run anew, over all results up to its day.
_RUNS_SQL = f"""{MATCHES_SQL.strip()},
played AS (SELECT match_id, CAST(o_orderdate AS DATE) AS day, team_a, team_b, goals_a, goals_b FROM matches JOIN orders ON o_orderkey = match_id),
months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS run_day FROM orders),
runs AS (SELECT run_day, strftime(run_day, '%Y%m%d') || '-' || hour AS run_id, strftime(run_day, '%Y-%m-%d') || ' ' || hour AS run_at FROM months, (VALUES (12), (18)) t(hour) WHERE hour = 12 OR month(run_day) % 3 = 0),
ratings AS (SELECT n_nationkey AS team, 1000.0 + n_nationkey * 17 % 25 * 20 AS points, CASE WHEN n_nationkey % 5 <> 0 THEN 1500.0 + n_nationkey * 11 % 25 * 15 END AS elo FROM nation WHERE n_nationkey <> 7),
both_sides AS (SELECT day, team_a AS team, goals_a AS gf, goals_b AS ga FROM played WHERE team_a <> 9 AND team_b <> 9 UNION ALL SELECT day, team_b, goals_b, goals_a FROM played WHERE team_a <> 9 AND team_b <> 9),
perday AS (SELECT team, day, count(*) AS n, sum(gf) AS gf, sum(ga) AS ga FROM both_sides GROUP BY ALL),
stats AS (
  SELECT run_day, team, sum(n) AS n, sum(gf * pow(0.5, (run_day - day) / 365.0)) / sum(n * pow(0.5, (run_day - day) / 365.0)) AS gf,
         sum(ga * pow(0.5, (run_day - day) / 365.0)) / sum(n * pow(0.5, (run_day - day) / 365.0)) AS ga FROM months JOIN perday ON day <= run_day GROUP BY ALL),
whole AS (SELECT run_day, sum(gf) / sum(n) AS gf, sum(ga) / sum(n) AS ga FROM months LEFT JOIN perday ON day <= run_day GROUP BY ALL),
given AS (
  SELECT r.*, p.match_id, p.day, p.team_a, p.team_b, coalesce(a.gf / w.gf, 1) AS attack_a, coalesce(a.ga / w.ga, 1) AS weak_a, coalesce(b.gf / w.gf, 1) AS attack_b, coalesce(b.ga / w.ga, 1) AS weak_b,
         concat_ws(' ', CASE WHEN a.n IS NULL THEN 'no results of ' || p.team_a || '.' END, CASE WHEN b.n IS NULL THEN 'no results of ' || p.team_b || '.' END) AS note,
         least(greatest(0.55 * coalesce((x.points - y.points) / 200, 0) + 0.45 * coalesce((x.elo - y.elo) / 400, 0), -1), 1) AS gap
  FROM runs r JOIN played p ON p.day > r.run_day AND p.day <= r.run_day + {_HORIZON} JOIN whole w ON w.run_day = r.run_day
  LEFT JOIN stats a ON a.run_day = r.run_day AND a.team = p.team_a LEFT JOIN stats b ON b.run_day = r.run_day AND b.team = p.team_b
  LEFT JOIN ratings x ON x.team = p.team_a LEFT JOIN ratings y ON y.team = p.team_b),
means AS (
  SELECT *, least(greatest(1.35 * least(greatest(attack_a, 0.6), 1.6) * least(greatest(weak_b, 0.6), 1.6) * exp(0.35 * gap), 0.2), 4.5) AS mean_a,
         least(greatest(1.35 * least(greatest(attack_b, 0.6), 1.6) * least(greatest(weak_a, 0.6), 1.6) * exp(-0.35 * gap), 0.2), 4.5) AS mean_b FROM given),
grid AS (
  SELECT run_id, match_id, i, j, (exp(-mean_a) * pow(mean_a, i) / factorial(CAST(i AS INTEGER))) * (exp(-mean_b) * pow(mean_b, j) / factorial(CAST(j AS INTEGER))) AS p FROM means, range(0, 9) t(i), range(0, 9) u(j)),
shares AS (
  SELECT run_id, match_id, sum(p) FILTER (i > j) / sum(p) AS p_a, sum(p) FILTER (i = j) / sum(p) AS p_draw, sum(p) FILTER (i < j) / sum(p) AS p_b, arg_max(i || '-' || j, (p, -i, -j)) AS score FROM grid GROUP BY ALL),
ranked AS (SELECT *, list_reverse_sort([p_a, p_draw, p_b]) AS top FROM means JOIN shares USING (run_id, match_id)),
forecasts AS (
  SELECT run_id, run_at, run_day, match_id, day, team_a, team_b, round(mean_a, 3) AS mean_a, round(mean_b, 3) AS mean_b, round(p_a, 4) AS p_a, round(p_draw, 4) AS p_draw, round(p_b, 4) AS p_b,
         CASE WHEN round(p_a, 9) = round(top[1], 9) THEN CAST(team_a AS VARCHAR) WHEN round(p_draw, 9) = round(top[1], 9) THEN 'draw' ELSE CAST(team_b AS VARCHAR) END AS favourite, round(top[1], 4) AS p_favourite,
         CASE WHEN top[1] >= 0.65 AND top[1] - top[2] >= 0.15 THEN 'Alta' WHEN top[1] >= 0.5 AND top[1] - top[2] >= 0.08 THEN 'Media' ELSE 'Baja' END AS confidence, score, note FROM ranked)"""

ORACLE_SQL = {
    "forecast_runs": f"WITH {_RUNS_SQL}\nSELECT * FROM forecasts",
    "forecast_validation": f"""
WITH {_RUNS_SQL},
last AS (SELECT * FROM forecasts QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY run_at DESC, run_id DESC) = 1),
joined AS (
  SELECT p.*, f.run_id, f.run_at, f.run_day, favourite, score, p_a, p_draw, p_b, p_favourite, confidence, CASE WHEN goals_a > goals_b THEN 'A' WHEN goals_a < goals_b THEN 'B' ELSE 'draw' END AS result,
         CASE WHEN favourite = 'draw' THEN 'draw' WHEN favourite = CAST(p.team_a AS VARCHAR) THEN 'A' WHEN favourite IS NOT NULL THEN 'B' END AS predicted,
         CAST(split_part(score, '-', 1) AS BIGINT) AS score_a, CAST(split_part(score, '-', 2) AS BIGINT) AS score_b
  FROM played p LEFT JOIN last f ON f.match_id = p.match_id)
SELECT match_id, day, team_a, team_b, goals_a, goals_b, result, run_id, run_at, run_day, favourite, predicted, score, score_a, score_b, p_a, p_draw, p_b, p_favourite, confidence,
       coalesce(predicted = result, FALSE) AS hit_result, coalesce(score_a = goals_a AND score_b = goals_b, FALSE) AS hit_score, score_a - goals_a AS error_a, score_b - goals_b AS error_b,
       run_id IS NOT NULL AS has_forecast, CASE WHEN run_id IS NULL THEN 'no forecast before the match' ELSE '' END AS note FROM joined""",
}
