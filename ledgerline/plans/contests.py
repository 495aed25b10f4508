"""Queries on contests: form, tables, brackets, expectations and the validation of predictions.

The driver's tables have no matches. An order stands for one: its priority is the group, the nation of its customer
meets the nation whose number its key gives, and the goals come from its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import model, text
from ..operators import aggregates, joins, tournament, windows
from ..sources.tables import read

AS_OF = "2001-12-31"

MATCHES_SQL = """
matches AS (
  SELECT o_orderkey AS match_id, o_orderpriority AS grp, CAST(c_nationkey AS BIGINT) AS team_a, o_orderkey % 25 AS team_b,
         o_custkey % 5 AS goals_a, o_orderkey % 4 AS goals_b
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> o_orderkey % 25),
sides AS (
  SELECT match_id, grp, team_a AS team, goals_a AS gf, goals_b AS ga FROM matches
  UNION ALL SELECT match_id, grp, team_b, goals_b, goals_a FROM matches),
scored AS (SELECT *, CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END AS points FROM sides)"""

STANDINGS_SQL = (
    MATCHES_SQL
    + """,
totals AS (
  SELECT grp, team, count(*) AS pj, count(*) FILTER (points = 3) AS pg, count(*) FILTER (points = 1) AS pe,
         count(*) FILTER (points = 0) AS pp, CAST(sum(gf) AS BIGINT) AS gf, CAST(sum(ga) AS BIGINT) AS gc,
         CAST(sum(points) AS BIGINT) AS pts, CAST(sum(gf) - sum(ga) AS BIGINT) AS dg
  FROM scored GROUP BY grp, team),
standings AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY grp ORDER BY pts DESC, dg DESC, gf DESC, team) AS INTEGER) AS pos FROM totals)"""
)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderpriority").alias("grp"),
        F.col("c_nationkey").cast("long").alias("team_a"),
        (F.col("o_orderkey") % 25).alias("team_b"),
        (F.col("o_custkey") % 5).alias("goals_a"),
        (F.col("o_orderkey") % 4).alias("goals_b"),
    ).filter("team_a <> team_b")


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.sides(matches(spark, sf_dir), "team_a", "team_b", "goals_a", "goals_b", ["match_id", "grp"])


def ranking_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and spending by nation."""
    spent = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"))
    joined = spent.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.sum("n").alias("n_orders"), F.sum("s").cast("decimal(18,2)").alias("spent"))


def kpi_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, customers, units and returned units of each year, and units for each order."""
    units = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("units"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("long")).otherwise(0)).alias("returned")
    )
    joined = read(spark, sf_dir, "orders").join(units, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    by_year = joined.groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(
        F.count("*").alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"), F.coalesce(F.sum("units"), F.lit(0)).alias("units"), F.coalesce(F.sum("returned"), F.lit(0)).alias("returned")
    )
    return by_year.withColumn("units_per_order", F.round(aggregates.ratio(F.col("units").cast("double"), F.col("n_orders")), 6))


def weighted_mean_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending of each customer, with weights that halve each year before a fixed day."""
    weight = model.recency_weight(F.to_date("o_orderdate"), F.lit(AS_OF).cast("date"))
    mean = aggregates.weighted_mean(F.col("o_totalprice"), weight)
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(mean, 3).alias("mean"), F.round(F.sum(weight), 6).alias("weights"))


def global_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean goals for and against over all sides; 1.35 where there are none."""
    mean = lambda c: F.coalesce(F.sum(c) / F.nullif(F.count(c), F.lit(0)), F.lit(model.BASE_GOALS))
    return _sides(spark, sf_dir).agg(F.round(mean("gf"), 9).alias("gf_mean"), F.round(mean("ga"), 9).alias("ga_mean"))


def minmax_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance of each supplier scaled to 50..100."""
    return aggregates.scaled(read(spark, sf_dir, "supplier"), "s_acctbal", "strength", 50.0, 100.0).select("s_suppkey", F.round("strength", 6).alias("strength"))


def argmax_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest order of each customer; of equals the one with the smaller key."""
    return aggregates.best_row(read(spark, sf_dir, "orders"), "o_custkey", [F.col("o_totalprice"), -F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table of each group."""
    return aggregates.standings(_sides(spark, sf_dir), "grp")


def recent_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form of each team: points and goal difference for each match, weighed."""
    totals = _sides(spark, sf_dir).groupBy("team").agg(F.count("*").alias("pj"), F.sum("points").alias("pts"), F.sum(F.col("gf") - F.col("ga")).alias("gd"))
    return totals.withColumn("form", F.round((F.col("pts") / F.col("pj") - 1.2) * 4 + F.col("gd") / F.col("pj") * 2, 6))


def result_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of wins, draws and losses of each team."""
    share = lambda p: F.round(aggregates.ratio(F.sum((F.col("points") == p).cast("double")), F.count("*")), 9)
    return _sides(spark, sf_dir).groupBy("team").agg(share(3).alias("won"), share(1).alias("drawn"), share(0).alias("lost"))


def best_thirds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and second of each group and the two best thirds, with seeds."""
    return tournament.qualified(standings(spark, sf_dir), "grp", 2).select("grp", "team", "pos", "how", "seed")


def bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds from the 32 best teams of all groups on: who meets whom, and who goes on."""
    table = standings(spark, sf_dir).withColumn("strength", F.col("pts") * 1000 + F.col("dg"))
    best = tournament.seeded(table, ["pts", "dg", "gf"], 32).select(F.concat_ws(":", "grp", "team").alias("team"), "seed", "strength")
    # 32 rows: the rounds are planned from them, not from the standings each.
    teams = spark.createDataFrame(best.collect(), best.schema)
    rounds = None
    for k in range(5):
        played = tournament.play_round(teams).withColumn("round", F.lit(k + 1))
        rounds = played if rounds is None else rounds.unionByName(played)
        teams = played.filter("won").select("team", "seed", "strength")
    return rounds.select("round", "match", "team", "seed", "won")


def best_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three dearest parts of each brand."""
    return windows.top_rows(read(spark, sf_dir, "part"), ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 3).select("p_brand", "p_partkey", "p_retailprice", "pos")


def global_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten customers with the highest balance."""
    return read(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(10).select("c_custkey", "c_name", "c_acctbal")


def poisson_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier against the next one: expected goals, chances, likeliest score and confidence."""
    a = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("bal_a"), F.col("s_nationkey").alias("nat_a"))
    b = read(spark, sf_dir, "supplier").select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("s_acctbal").alias("bal_b"), F.col("s_nationkey").alias("nat_b"))
    gap = model.strength_gap(F.col("bal_a") / 50, F.col("bal_b") / 50, F.col("nat_a") * 20.0, F.col("nat_b") * 20.0)
    pairs = a.join(b, "s_suppkey").withColumn("gap", gap)
    mean_a = model.expected_goals(1 + F.col("bal_a") / 20000, 1 - F.col("bal_b") / 20000, F.col("gap"))
    mean_b = model.expected_goals(1 + F.col("bal_b") / 20000, 1 - F.col("bal_a") / 20000, -F.col("gap"))
    grids = pairs.withColumn("mean_a", mean_a).withColumn("mean_b", mean_b).withColumn("grid", model.score_grid(F.col("mean_a"), F.col("mean_b")))
    grid = F.col("grid")
    shares = grids.withColumn("p_a", model.grid_share(grid, lambda i, j: i > j)).withColumn("p_draw", model.grid_share(grid, lambda i, j: i == j)).withColumn("p_b", model.grid_share(grid, lambda i, j: i < j))
    best = F.sort_array(F.array("p_a", "p_draw", "p_b"), asc=False)
    return shares.select(
        "s_suppkey",
        *(F.round(c, 6).alias(c) for c in ("mean_a", "mean_b", "p_a", "p_draw", "p_b")),
        model.likeliest(grid).alias("score"),
        model.confidence(best[0], best[1]).alias("confidence"),
    )


def validation_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted scores against results: hits of the outcome and of the score in each group."""
    predicted = F.concat_ws("-", F.col("match_id") % 3, (F.col("match_id") / 5).cast("long") % 3)
    rows = matches(spark, sf_dir).withColumn("predicted", predicted)
    a, b = text.score_part(F.col("predicted"), 0), text.score_part(F.col("predicted"), 1)
    result = F.coalesce((text.outcome(a, b) == text.outcome(F.col("goals_a"), F.col("goals_b"))).cast("long"), F.lit(0))
    exact = ((a == F.col("goals_a")) & (b == F.col("goals_b"))).cast("long")
    return rows.groupBy("grp").agg(F.count("*").alias("n"), F.sum(result).alias("outcome_hits"), F.sum(exact).alias("score_hits"))


def asof_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each error event with the latest view of its user at or before it."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    errors = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    views = events.filter("event_type = 'view'").select("event_id", "user_id", "ts")
    return joins.asof(errors, views, "user_id", "ts", "ts", "event_id", "event_id").select("event_id", "user_id", F.col("r_event_id").alias("view_id"))


def future_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the user of an event comes again, and whether with the same type."""
    events = read(spark, sf_dir, "events")
    ends = events.groupBy("user_id", "event_type").agg(F.max("ts").alias("last_of_type"))
    last = ends.groupBy("user_id").agg(F.max("last_of_type").alias("last"))
    joined = events.join(ends, ["user_id", "event_type"]).join(last, "user_id")
    return joined.select("event_id", (F.col("last") > F.col("ts")).alias("comes_again"), (F.col("last_of_type") > F.col("ts")).alias("same_type_again"))


def strength_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strength of each customer's supplier namesake: by its key, else by its nation's least, else 55."""
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.col("s_acctbal").alias("strength"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.looked_up(rows, suppliers, [("c_custkey", "s_suppkey"), ("c_nationkey", "s_nationkey")], "strength", F.lit(55.0)).select("c_custkey", "strength")


QUERIES = {
    f.__name__: f
    for f in (ranking_by_nation, kpi_by_year, weighted_mean_recency, global_means, minmax_strength, argmax_order, standings, recent_form, result_balance, best_thirds, bracket, best_k_per_group, global_top, poisson_match, validation_hits, asof_prediction, future_inference, strength_lookup)
}

#: bracket has none: rounds follow from one another.
_ROUNDS_SQL = ",".join(
    f"""
played{k} AS (
  SELECT *, row_number() OVER (PARTITION BY match ORDER BY strength DESC, seed) = 1 AS won
  FROM (SELECT *, least(place, many + 1 - place) AS match FROM (SELECT *, row_number() OVER (ORDER BY seed) AS place, count(*) OVER () AS many FROM teams{k}))),
teams{k + 1} AS (SELECT team, seed, strength FROM played{k} WHERE won)"""
    for k in range(1, 6)
)

ORACLE_SQL = {
    "bracket": f"""
WITH {STANDINGS_SQL},
teams1 AS (
  SELECT grp || ':' || team AS team, row_number() OVER (ORDER BY pts DESC, dg DESC, gf DESC, standings.team, grp) AS seed, pts * 1000 + dg AS strength
  FROM standings ORDER BY seed LIMIT 32),{_ROUNDS_SQL}
"""
    + " UNION ALL ".join(f"SELECT {k} AS round, match, team, seed, won FROM played{k}" for k in range(1, 6)),
    "ranking_by_nation": """
SELECT n_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS spent
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "kpi_by_year": """
WITH units AS (
  SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS units, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS returned
  FROM lineitem GROUP BY l_orderkey)
SELECT year(o_orderdate) AS year, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers, CAST(coalesce(sum(units), 0) AS BIGINT) AS units,
       CAST(coalesce(sum(returned), 0) AS BIGINT) AS returned, round(CAST(coalesce(sum(units), 0) AS DOUBLE) / count(*), 6) AS units_per_order
FROM orders LEFT JOIN units ON o_orderkey = l_orderkey GROUP BY 1""",
    "weighted_mean_recency": f"""
WITH w AS (SELECT o_custkey, o_totalprice, pow(0.5, greatest(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}'), 0) / 365.0) AS w FROM orders)
SELECT o_custkey, count(*) AS n, round(sum(o_totalprice * w) / sum(w), 3) AS mean, round(sum(w), 6) AS weights FROM w GROUP BY o_custkey""",
    "global_means": f"""
WITH {MATCHES_SQL}
SELECT round(coalesce(avg(gf), 1.35), 9) AS gf_mean, round(coalesce(avg(ga), 1.35), 9) AS ga_mean FROM scored""",
    "minmax_strength": """
SELECT s_suppkey, round(50 + (s_acctbal - (SELECT min(s_acctbal) FROM supplier))
       / greatest((SELECT max(s_acctbal) - min(s_acctbal) FROM supplier), 1.0) * 50, 6) AS strength FROM supplier""",
    "argmax_order": """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""",
    "standings": f"WITH {STANDINGS_SQL} SELECT * FROM standings",
    "recent_form": f"""
WITH {MATCHES_SQL},
t AS (SELECT team, count(*) AS pj, CAST(sum(points) AS BIGINT) AS pts, CAST(sum(gf - ga) AS BIGINT) AS gd FROM scored GROUP BY team)
SELECT *, round((pts / pj - 1.2) * 4 + gd / pj * 2, 6) AS form FROM t""",
    "result_balance": f"""
WITH {MATCHES_SQL}
SELECT team, round(count(*) FILTER (points = 3) / count(*), 9) AS won, round(count(*) FILTER (points = 1) / count(*), 9) AS drawn,
       round(count(*) FILTER (points = 0) / count(*), 9) AS lost FROM scored GROUP BY team""",
    "best_thirds": f"""
WITH {STANDINGS_SQL},
thirds AS (SELECT * FROM standings WHERE pos = 3 ORDER BY pts DESC, dg DESC, gf DESC, team LIMIT 2),
picked AS (SELECT * FROM standings WHERE pos <= 2 UNION ALL SELECT * FROM thirds)
SELECT grp, team, pos, CASE pos WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE 'best third' END AS how,
       CAST(row_number() OVER (ORDER BY pos, pts DESC, dg DESC, gf DESC, team, grp) AS INTEGER) AS seed FROM picked""",
    "best_k_per_group": """
SELECT p_brand, p_partkey, p_retailprice, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS pos
FROM part QUALIFY pos <= 3""",
    "global_top": "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
    "poisson_match": """
WITH pairs AS (
  SELECT a.s_suppkey, a.s_acctbal AS x, b.s_acctbal AS y,
         least(greatest(0.55 * ((a.s_acctbal / 50 - b.s_acctbal / 50) / 200) + 0.45 * ((a.s_nationkey * 20.0 - b.s_nationkey * 20.0) / 400), -1), 1) AS gap
  FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1),
means AS (
  SELECT s_suppkey,
         least(greatest(1.35 * least(greatest(1 + x / 20000, 0.6), 1.6) * least(greatest(1 - y / 20000, 0.6), 1.6) * exp(0.35 * gap), 0.2), 4.5) AS mean_a,
         least(greatest(1.35 * least(greatest(1 + y / 20000, 0.6), 1.6) * least(greatest(1 - x / 20000, 0.6), 1.6) * exp(-0.35 * gap), 0.2), 4.5) AS mean_b
  FROM pairs),
grid AS (
  SELECT s_suppkey, mean_a, mean_b, i, j,
         exp(-mean_a) * pow(mean_a, i) / factorial(CAST(i AS INTEGER)) * exp(-mean_b) * pow(mean_b, j) / factorial(CAST(j AS INTEGER)) AS p
  FROM means, range(0, 9) t(i), range(0, 9) u(j)),
shares AS (
  SELECT s_suppkey, any_value(mean_a) AS mean_a, any_value(mean_b) AS mean_b, sum(p) FILTER (i > j) / sum(p) AS p_a, sum(p) FILTER (i = j) / sum(p) AS p_draw,
         sum(p) FILTER (i < j) / sum(p) AS p_b FROM grid GROUP BY s_suppkey),
best AS (SELECT s_suppkey, i || '-' || j AS score FROM grid QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY p DESC, i, j) = 1),
ranked AS (SELECT *, list_reverse_sort([p_a, p_draw, p_b]) AS top FROM shares JOIN best USING (s_suppkey))
SELECT s_suppkey, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(p_a, 6) AS p_a, round(p_draw, 6) AS p_draw, round(p_b, 6) AS p_b, score,
       CASE WHEN top[1] >= 0.65 AND top[1] - top[2] >= 0.15 THEN 'Alta' WHEN top[1] >= 0.5 AND top[1] - top[2] >= 0.08 THEN 'Media' ELSE 'Baja' END AS confidence
FROM ranked""",
    "validation_hits": f"""
WITH {MATCHES_SQL},
p AS (SELECT *, match_id % 3 AS a, match_id // 5 % 3 AS b FROM matches)
SELECT grp, count(*) AS n, count(*) FILTER (sign(a - b) = sign(goals_a - goals_b)) AS outcome_hits, count(*) FILTER (a = goals_a AND b = goals_b) AS score_hits
FROM p GROUP BY grp""",
    "asof_prediction": """
SELECT e.event_id, e.user_id, v.event_id AS view_id
FROM events e LEFT JOIN events v ON v.user_id = e.user_id AND v.event_type = 'view' AND v.ts <= e.ts
WHERE e.event_type = 'error'
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY v.ts DESC NULLS LAST, v.event_id DESC) = 1""",
    "future_inference": """
SELECT event_id, max(ts) OVER (PARTITION BY user_id) > ts AS comes_again, max(ts) OVER (PARTITION BY user_id, event_type) > ts AS same_type_again FROM events""",
    "strength_lookup": """
SELECT c_custkey, coalesce(a.s_acctbal, n.best, 55.0) AS strength
FROM customer LEFT JOIN supplier a ON s_suppkey = c_custkey
LEFT JOIN (SELECT s_nationkey, min(s_acctbal) AS best FROM supplier GROUP BY s_nationkey) n ON n.s_nationkey = c_nationkey""",
}
