"""Queries of a tournament's calendar and of its dashboard: normalised rows, references resolved, live merges, totals.

An order stands for a match (see contests): its status for the state, its lines for what happened in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import results, text
from ..operators import aggregates, joins, windows
from ..sources.tables import read
from .contests import MATCHES_SQL, _sides, matches

# The rounds of the bracket, in order; how a reader's language calls them.
ROUNDS = ("R32", "R16", "QF", "SF", "TP", "F")
SHOWN = {"R32": "Ronda de 32", "R16": "Octavos", "QF": "Cuartos", "SF": "Semifinal", "TP": "Tercer lugar", "F": "Final"}


def calendar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar as a sheet has it: ids with .0, states in several words, missing goals."""
    k = F.col("match_id")
    state = F.get(F.array(*map(F.lit, ("Finalizado", "FT", "en vivo", "scheduled", "por jugar", "", "TBD", " final "))), (k % 8).cast("int"))
    team = lambda c, m: F.when(k % m == 0, F.lit("Ganador 73")).when(k % (m + 2) == 0, F.lit("1A")).otherwise(F.concat(F.lit("T"), F.col(c).cast("string")))
    goals = lambda c: F.when(k % 5 != 0, F.col(c).cast("string"))
    return matches(spark, sf_dir).select(
        F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit(".0"))).when(k % 3 == 1, F.concat(F.lit("M-"), k.cast("string"))).otherwise(k.cast("string")).alias("id"),
        F.get(F.array(*map(F.lit, ROUNDS)), (k % 6).cast("int")).alias("phase"), state.alias("state"), team("team_a", 29).alias("team_a"), team("team_b", 31).alias("team_b"), goals("goals_a").alias("goals_a"), goals("goals_b").alias("goals_b"),
    )


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("goals_a").try_cast("long"), F.col("goals_b").try_cast("long")
    rows = calendar_rows(spark, sf_dir).select(results.whole_id(F.col("id")).alias("match_id"), "phase", text.state(F.trim("state")).alias("state"), "team_a", "team_b", a.alias("goals_a"), b.alias("goals_b"))
    known = results.known_team(F.col("team_a")) & results.known_team(F.col("team_b"))
    return rows.withColumn("known", known).withColumn("over", results.finished(F.col("state"), F.col("goals_a"), F.col("goals_b")))


def calendar_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with whole ids, one word for each state, and whether teams are known and the match is over."""
    return _normalised(spark, sf_dir)


def played_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches that count for form: known teams, both goals, over, and two different teams; one row a team and phase."""
    rows = _normalised(spark, sf_dir).filter("known and over and goals_a is not null and goals_b is not null and team_a <> team_b")
    return aggregates.sides(rows, "team_a", "team_b", "goals_a", "goals_b", ["phase"]).groupBy("team", "phase").agg(F.count("*").alias("n"), F.sum("gf").alias("gf"), F.sum("ga").alias("ga"), F.sum("points").cast("long").alias("points"))


def _knockout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with penalties and a prediction."""
    k = F.col("match_id")
    return matches(spark, sf_dir).withColumn("pen_a", F.when(k % 2 == 0, k % 5)).withColumn("pen_b", F.when(k % 2 == 0, k % 7)).withColumn("predicted", F.when(k % 11 != 0, F.when(k % 3 == 0, F.col("team_b")).otherwise(F.col("team_a")))).withColumn("over", k % 4 != 1)


def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who won each match, on penalties if need be, and which result counts for it."""
    won = results.winner(*map(F.col, ("team_a", "team_b", "goals_a", "goals_b", "pen_a", "pen_b")))
    used, source = results.used_result(F.col("over"), won, F.col("predicted"))
    return _knockout(spark, sf_dir).select("match_id", won.alias("winner"), used.alias("used"), source.alias("source"))


def knockout_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who goes on from each match by goals, chance and rating, with the chance and the goals that it stands for."""
    rating = lambda c: F.col(c) * 17 % 29 * 10.0
    a, b = rating("team_a"), rating("team_b")
    chance = results.win_chance(a, b)
    pick = results.knockout_pick(F.col("team_a"), F.col("team_b"), (F.col("goals_a"), F.col("goals_b")), (chance, 1 - chance), (a, b))
    return matches(spark, sf_dir).select("match_id", pick.alias("pick"), F.round(chance, 9).alias("chance"), F.round(results.linear_goals(chance), 9).alias("goals"))


def resolved_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that refer to the winner (W) or loser (L) of an earlier match, resolved by a join on the match."""
    k = F.col("match_id")
    decided = _knockout(spark, sf_dir).withColumn("w", results.winner(*map(F.col, ("team_a", "team_b", "goals_a", "goals_b", "pen_a", "pen_b"))))
    decided = decided.select(k.alias("ref"), "w", F.when(F.col("w") == F.col("team_a"), F.col("team_b")).when(F.col("w") == F.col("team_b"), F.col("team_a")).alias("l"))
    slots = matches(spark, sf_dir).select("match_id", F.concat(F.when(k % 2 == 0, F.lit("W")).otherwise(F.lit(" l-")), (k - k % 7 - 1).cast("string")).alias("slot"))
    kind, ref = text.slot_kind(F.col("slot")), F.regexp_extract("slot", r"([0-9]+)", 1).try_cast("long")
    joined = slots.select("match_id", kind.alias("kind"), ref.alias("ref")).join(decided, "ref", "left")
    team = F.when(F.col("kind") == "winner", F.col("w")).when(F.col("kind") == "loser", F.col("l"))
    why = F.when(team.isNotNull(), "resolved").when(F.col("w").isNull() & F.col("ref").isNotNull(), "undecided").otherwise("unknown")
    return joined.select("match_id", "kind", "ref", team.alias("team"), why.alias("why"))


def inferred_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even matches without penalties whose winner is told by exactly one of the two teams playing again in that group.

    Teams' last matches are counted before they meet the matches.
    """
    rows = matches(spark, sf_dir)
    last = _sides(spark, sf_dir).groupBy("grp", "team").agg(F.max("match_id").alias("last"))
    side = lambda x: last.select("grp", F.col("team").alias(f"team_{x}"), F.col("last").alias(f"last_{x}"))
    joined = rows.filter("goals_a = goals_b").join(side("a"), ["grp", "team_a"]).join(side("b"), ["grp", "team_b"])
    a, b = F.col("last_a") > F.col("match_id"), F.col("last_b") > F.col("match_id")
    return joined.select("match_id", F.when(a & ~b, F.col("team_a")).when(b & ~a, F.col("team_b")).alias("winner"), F.when(a & b, "both").when(a | b, "one").otherwise("none").alias("again"))


def live_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New predictions merged into stored rows by groups of columns: initial ones stay, real ones stay where they are
    there, live ones stay where the match is over."""
    k = F.col("match_id")
    base = matches(spark, sf_dir).select("match_id", (k % 3).alias("initial"), F.lit(None).cast("long").alias("real"), (k % 4).alias("live"), (k % 5 == 0).alias("over"))
    stored = matches(spark, sf_dir).filter(k % 6 != 0).select("match_id", (k % 7).alias("s_initial"), F.when(k % 2 == 0, k % 9).alias("s_real"), F.when(k % 10 != 5, k % 8).alias("s_live"))
    joined = base.join(stored, "match_id", "left")
    live = F.when(F.col("over"), F.coalesce("s_live", "live")).otherwise(F.col("live"))
    return joined.select("match_id", F.coalesce("s_initial", "initial").alias("initial"), F.coalesce("s_real", "real").alias("real"), live.alias("live"))


def team_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight sums for each team, places among all teams, and the share of matches won as a reader sees it."""
    s = lambda c: F.sum(c).cast("long")
    won, drawn, lost = (F.count_if(F.col("points") == p) for p in (3, 1, 0))
    table = _sides(spark, sf_dir).groupBy("team").agg(F.count("*").alias("played"), won.alias("won"), drawn.alias("drawn"), lost.alias("lost"), s("gf").alias("gf"), s("ga").alias("ga"), s("points").alias("points"), F.count_distinct("grp").alias("groups"))
    # There are as many rows as teams, so one window over all of them is small.
    place = F.row_number().over(Window.orderBy(F.desc("points"), F.desc(F.col("gf") - F.col("ga")), "team")).cast("long")
    return table.withColumn("place", place).withColumn("shown", results.percent(F.round(aggregates.ratio(F.col("won").cast("double"), F.col("played")), 6)))


def phase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches, goals and even matches of each phase, with its place and its name for readers."""
    k = F.col("match_id")
    rows = matches(spark, sf_dir).withColumn("phase", F.get(F.array(*map(F.lit, ROUNDS)), (k % 6).cast("int")))
    names = F.create_map(*(F.lit(x) for pair in SHOWN.items() for x in pair))
    counted = rows.groupBy("phase").agg(F.count("*").alias("n"), F.sum(F.col("goals_a") + F.col("goals_b")).alias("goals"), F.count_if(F.col("goals_a") == F.col("goals_b")).alias("even"))
    return counted.select("phase", F.array_position(F.array(*map(F.lit, ROUNDS)), F.col("phase")).alias("place"), F.try_element_at(names, F.col("phase")).alias("shown"), "n", "goals", "even")


def top_scorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten suppliers (as players) with the most units, their orders, and the best of each nation."""
    units = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("units"), F.count_distinct("l_orderkey").alias("orders"))
    rows = units.join(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"), "l_suppkey")
    best = windows.top_rows(rows, ["s_nationkey"], [F.desc("units"), F.col("l_suppkey")], 1).select(F.col("l_suppkey").alias("best_of_nation"))
    top = rows.orderBy(F.desc("units"), "l_suppkey").limit(10)
    return top.join(best, F.col("l_suppkey") == F.col("best_of_nation"), "left").select("l_suppkey", "s_name", "units", "orders", F.col("best_of_nation").isNotNull().alias("best_of_nation"))


def champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who was first in how many groups (as editions), in which, and in how many it was second."""
    table = aggregates.standings(_sides(spark, sf_dir), "grp").filter("pos <= 2")
    n = table.groupBy("team").agg(F.count_if(F.col("pos") == 1).alias("titles"), F.count_if(F.col("pos") == 2).alias("seconds"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("pos") == 1, F.col("grp")))), ",").alias("won"))
    return n.filter("titles > 0 or seconds > 0")


def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader's choice of years and segments leaves: matches, spending, and shares of all."""
    chosen = F.year("o_orderdate").isin(1996, 1997, 2000) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    rows = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey"), "o_custkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    both = rows.groupBy("c_nationkey").agg(F.count("*").alias("all"), F.count_if(chosen).alias("n"), F.coalesce(F.sum(F.when(chosen, cents)), F.lit(0)).alias("cents"), F.count_distinct(F.when(chosen, F.col("o_custkey"))).alias("customers"))
    return both.select("c_nationkey", "n", "cents", "customers", F.round(aggregates.ratio(F.col("n").cast("double"), F.col("all")), 9).alias("share"))


def latest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each type the last value that isn't blank, by time, and the last event of each third of the users."""
    k = F.when(F.col("event_id") % 4 != 0, F.get_json_object("props", "$.k"))
    at = F.struct("ts", "event_id")
    return read(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 3).alias("third")).agg(F.max_by(k, F.when(k.isNotNull(), at)).alias("last_value"), F.max_by("event_id", at).alias("last_event"), F.count(k).alias("n_values"))


def stats_with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with the statistics of both teams, defaults for teams that have none, and a note on who lacks them."""
    stats = _sides(spark, sf_dir).filter("team % 6 <> 0").groupBy("team").agg((F.sum("gf") / F.count("*")).alias("gf"), F.count("*").alias("n"))
    side = lambda x: F.broadcast(stats.select(F.col("team").alias(f"team_{x}"), F.col("gf").alias(f"gf_{x}"), F.col("n").alias(f"n_{x}")))  # noqa: E731 - a row for each of 25 nations
    joined = matches(spark, sf_dir).join(side("a"), "team_a", "left").join(side("b"), "team_b", "left")
    note = F.concat_ws(",", F.when(F.col("n_a").isNull(), "a"), F.when(F.col("n_b").isNull(), "b"))
    return joined.groupBy(note.alias("missing"), "grp").agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce("gf_a", F.lit(1.35))), 6).alias("mean_a"), F.round(F.avg(F.coalesce("gf_b", F.lit(1.35))), 6).alias("mean_b"))


def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as readers write them, joined with the table of names by a key without case, marks and extra spaces."""
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", text.match_key(F.col("n_name")).alias("key"))
    k = F.col("c_custkey")
    written = F.when(k % 4 == 0, F.concat(F.lit("  nation_"), F.col("c_nationkey"))).when(k % 4 == 1, F.concat(F.lit("Nátion_"), F.col("c_nationkey"), F.lit(" "))).when(k % 4 == 2, F.concat(F.lit("NATION_"), F.col("c_nationkey"))).otherwise("Nowhere")
    rows = read(spark, sf_dir, "customer").select("c_custkey", text.match_key(written).alias("key"))
    found = rows.join(nations, "key", "left").select(F.coalesce("n_name", "key").alias("name"), F.col("n_name").isNotNull().alias("found"))
    return found.groupBy("name", "found").agg(F.count("*").alias("n"))


def probability_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chances of each match and whether they are within bounds and add up; checks on how many rows there must be."""
    k = F.col("match_id")
    p = [((k % m + 1) / ((k % 3 + 1) + (k % 5 + 1) + (k % 7 + 1)) + F.when(k % 101 == 0, 0.01).otherwise(0.0)).alias(n) for m, n in ((3, "a"), (5, "d"), (7, "b"))]
    rows = matches(spark, sf_dir).select("match_id", "grp", *p)
    total = F.col("a") + F.col("d") + F.col("b")
    return rows.groupBy("grp").agg(F.count("*").alias("n"), F.count_if(F.abs(total - 1) > 1e-6).alias("off"), F.count_if((F.least("a", "d", "b") < 0) | (F.greatest("a", "d", "b") > 1)).alias("outside"), (F.count("*") == F.count_distinct("match_id")).alias("unique"), (F.count("*") >= 10).alias("enough"))


def phase_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches of each round with the match that each winner came from: its last one in the round before."""
    k = F.col("match_id")
    rows = _sides(spark, sf_dir).withColumn("round", k % 4).filter("points = 3").select("match_id", "grp", "team", "round")
    before = rows.select("grp", "team", (F.col("round") + 1).alias("round"), "match_id")
    last = before.groupBy("grp", "team", "round").agg(F.max("match_id").alias("from_match"))
    return rows.join(last, ["grp", "team", "round"], "left").groupBy("grp", "round").agg(F.count("*").alias("n"), F.count("from_match").alias("linked"), F.sum(F.coalesce("from_match", F.lit(0))).alias("check"))


def dashboard_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of the dashboard as rows of one: name, key and value as JSON; tables that aren't there are left out."""
    parts = []
    for name, table in (("teams", team_totals(spark, sf_dir)), ("phases", phase_counts(spark, sf_dir)), ("champions", champions(spark, sf_dir))):
        key = table.columns[0]
        parts.append(table.select(F.lit(name).alias("name"), F.col(key).cast("string").alias("key"), F.size(F.array(*(F.col(c).cast("string") for c in table.columns))).alias("n_fields"), F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in sorted(table.columns) if c != "shown")).cast("binary")).alias("value")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dedup_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that come from two sheets, sides swapped in one of them: one row each, by a key that doesn't mind sides."""
    from ..operators import sets

    a = matches(spark, sf_dir).select("match_id", F.col("grp").alias("day"), *(F.col(c).cast("string").alias(c) for c in ("team_a", "goals_a", "team_b", "goals_b")), F.lit(1).alias("source"))
    b = a.filter("match_id % 3 = 0").select("match_id", "day", F.col("team_b").alias("team_a"), F.col("goals_b").alias("goals_a"), F.col("team_a").alias("team_b"), F.col("goals_a").alias("goals_b"), F.lit(2).alias("source"))
    rows = a.unionByName(b).withColumn("key", sets.unordered_key(F.concat_ws("#", "day", "match_id"), *map(F.col, ("team_a", "goals_a", "team_b", "goals_b"))))
    return sets.keep_best(rows, ["key"], [F.desc("source")]).groupBy("day", "source").agg(F.count("*").alias("n"), F.sum(F.col("team_a").cast("long")).alias("teams"))


QUERIES = {
    f.__name__: f
    for f in (
        calendar_normalised, played_matches, winners, knockout_picks, resolved_slots, inferred_winners, live_merge, team_totals, phase_counts, top_scorers, champions, selection, latest_values,
        stats_with_defaults, canonical_names, probability_checks, phase_boards, dashboard_data, dedup_results,
    )
}

_CALENDAR_SQL = f"""{MATCHES_SQL},
calendar AS (
  SELECT match_id, (['R32', 'R16', 'QF', 'SF', 'TP', 'F'])[match_id % 6 + 1] AS phase, (['Jugado', 'Jugado', 'En vivo', 'Programado', 'Programado', '', 'Pendiente', 'Jugado'])[match_id % 8 + 1] AS state,
         CASE WHEN match_id % 29 = 0 THEN 'Ganador 73' WHEN match_id % 31 = 0 THEN '1A' ELSE 'T' || team_a END AS team_a,
         CASE WHEN match_id % 31 = 0 THEN 'Ganador 73' WHEN match_id % 33 = 0 THEN '1A' ELSE 'T' || team_b END AS team_b,
         CASE WHEN match_id % 5 <> 0 THEN goals_a END AS goals_a, CASE WHEN match_id % 5 <> 0 THEN goals_b END AS goals_b FROM matches),
normalised AS (SELECT *, team_a LIKE 'T%' AND team_b LIKE 'T%' AS known, state = 'Jugado' OR goals_a IS NOT NULL AS over FROM calendar)"""
_KNOCKOUT_SQL = f"""{MATCHES_SQL},
knockout AS (SELECT *, CASE WHEN match_id % 2 = 0 THEN match_id % 5 END AS pen_a, CASE WHEN match_id % 2 = 0 THEN match_id % 7 END AS pen_b,
             CASE WHEN match_id % 11 <> 0 THEN CASE WHEN match_id % 3 = 0 THEN team_b ELSE team_a END END AS predicted FROM matches),
decided AS (SELECT *, CASE WHEN goals_a > goals_b THEN team_a WHEN goals_b > goals_a THEN team_b WHEN pen_a > pen_b THEN team_a WHEN pen_b > pen_a THEN team_b END AS winner FROM knockout)"""
_TABLE_SQL = f"""{MATCHES_SQL},
teams AS (SELECT team, count(*) AS played, count(*) FILTER (points = 3) AS won, count(*) FILTER (points = 1) AS drawn, count(*) FILTER (points = 0) AS lost, CAST(sum(gf) AS BIGINT) AS gf, CAST(sum(ga) AS BIGINT) AS ga,
                 CAST(sum(points) AS BIGINT) AS points, count(DISTINCT grp) AS groups FROM scored GROUP BY team),
placed AS (SELECT *, row_number() OVER (ORDER BY points DESC, gf - ga DESC, team) AS place FROM teams),
phases AS (SELECT (['R32', 'R16', 'QF', 'SF', 'TP', 'F'])[match_id % 6 + 1] AS phase, match_id % 6 + 1 AS place, (['Ronda de 32', 'Octavos', 'Cuartos', 'Semifinal', 'Tercer lugar', 'Final'])[match_id % 6 + 1] AS shown,
                  count(*) AS n, CAST(sum(goals_a + goals_b) AS BIGINT) AS goals, count(*) FILTER (goals_a = goals_b) AS even FROM matches GROUP BY ALL),
groups AS (SELECT grp, team, row_number() OVER (PARTITION BY grp ORDER BY sum(points) DESC, sum(gf) - sum(ga) DESC, sum(gf) DESC, team) AS pos FROM scored GROUP BY grp, team),
champions AS (SELECT team, count(*) FILTER (pos = 1) AS titles, count(*) FILTER (pos = 2) AS seconds, coalesce(string_agg(grp, ',' ORDER BY grp) FILTER (pos = 1), '') AS won FROM groups WHERE pos <= 2 GROUP BY team)"""

ORACLE_SQL = {
    "calendar_normalised": f"WITH {_CALENDAR_SQL} SELECT * FROM normalised",
    "played_matches": f"""
WITH {_CALENDAR_SQL},
p AS (SELECT * FROM normalised WHERE known AND over AND goals_a IS NOT NULL AND team_a <> team_b),
s AS (SELECT phase, team_a AS team, goals_a AS gf, goals_b AS ga FROM p UNION ALL SELECT phase, team_b, goals_b, goals_a FROM p)
SELECT team, phase, count(*) AS n, CAST(sum(gf) AS BIGINT) AS gf, CAST(sum(ga) AS BIGINT) AS ga, CAST(sum(CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END) AS BIGINT) AS points FROM s GROUP BY team, phase""",
    "winners": f"""
WITH {_KNOCKOUT_SQL}
SELECT match_id, winner, CASE WHEN match_id % 4 <> 1 AND winner IS NOT NULL THEN winner ELSE predicted END AS used,
       CASE WHEN match_id % 4 <> 1 AND winner IS NOT NULL THEN 'final' WHEN predicted IS NOT NULL THEN 'predicted' ELSE 'none' END AS source FROM decided""",
    "knockout_picks": f"""
WITH {MATCHES_SQL}, r AS (SELECT *, team_a * 17 % 29 * 10.0::DOUBLE AS ra, team_b * 17 % 29 * 10.0::DOUBLE AS rb FROM matches),
c AS (SELECT *, 1 / (1 + exp(-(ra - rb) / 400)) AS chance FROM r)
SELECT match_id, CASE WHEN goals_a > goals_b THEN team_a WHEN goals_b > goals_a THEN team_b WHEN rb > ra THEN team_b ELSE team_a END AS pick, round(chance, 9) AS chance,
       round(least(greatest(0.2 + 3.3 * chance, 0.2), 3.5), 9) AS goals FROM c""",
    "resolved_slots": f"""
WITH {_KNOCKOUT_SQL},
s AS (SELECT match_id, CASE WHEN match_id % 2 = 0 THEN 'winner' ELSE 'loser' END AS kind, match_id - match_id % 7 - 1 AS ref FROM matches),
t AS (SELECT s.match_id, CASE WHEN ref < 0 AND s.kind = 'loser' THEN 'team' ELSE s.kind END AS kind, abs(ref) AS ref FROM s),
j AS (SELECT t.*, winner, CASE WHEN kind = 'winner' THEN winner WHEN kind = 'team' THEN NULL WHEN winner = team_a THEN team_b WHEN winner = team_b THEN team_a END AS team FROM t LEFT JOIN decided d ON d.match_id = t.ref)
SELECT match_id, kind, ref, team, CASE WHEN team IS NOT NULL THEN 'resolved' WHEN winner IS NULL THEN 'undecided' ELSE 'unknown' END AS why FROM j""",
    "inferred_winners": f"""
WITH {MATCHES_SQL}, l AS (SELECT grp, team, max(match_id) AS last FROM sides GROUP BY ALL),
j AS (SELECT m.*, a.last > match_id AS x, b.last > match_id AS y FROM matches m JOIN l a ON a.grp = m.grp AND a.team = team_a JOIN l b ON b.grp = m.grp AND b.team = team_b WHERE goals_a = goals_b)
SELECT match_id, CASE WHEN x AND NOT y THEN team_a WHEN y AND NOT x THEN team_b END AS winner, CASE WHEN x AND y THEN 'both' WHEN x OR y THEN 'one' ELSE 'none' END AS again FROM j""",
    "live_merge": f"""
WITH {MATCHES_SQL}
SELECT match_id, CASE WHEN match_id % 6 <> 0 THEN match_id % 7 ELSE match_id % 3 END AS initial, CASE WHEN match_id % 6 <> 0 AND match_id % 2 = 0 THEN match_id % 9 END AS "real",
       CASE WHEN match_id % 5 = 0 AND match_id % 6 <> 0 AND match_id % 10 <> 5 THEN match_id % 8 ELSE match_id % 4 END AS live FROM matches""",
    "team_totals": f"WITH {_TABLE_SQL} SELECT *, format('{{:.1f}}%', round(won / played, 6) * 100) AS shown FROM placed",
    "phase_counts": f"WITH {_TABLE_SQL} SELECT * FROM phases",
    "top_scorers": """
WITH u AS (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1),
r AS (SELECT l_suppkey, s_name, units, orders, row_number() OVER (PARTITION BY s_nationkey ORDER BY units DESC, l_suppkey) = 1 AS best_of_nation FROM u JOIN supplier ON s_suppkey = l_suppkey)
SELECT * FROM r ORDER BY units DESC, l_suppkey LIMIT 10""",
    "champions": f"WITH {_TABLE_SQL} SELECT * FROM champions",
    "selection": """
WITH r AS (SELECT *, year(o_orderdate) IN (1996, 1997, 2000) AND c_mktsegment IN ('BUILDING', 'MACHINERY') AS chosen FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_nationkey, count(*) FILTER (chosen) AS n, CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (chosen), 0) AS BIGINT) AS cents, count(DISTINCT o_custkey) FILTER (chosen) AS customers,
       round(count(*) FILTER (chosen) / count(*), 9) AS share FROM r GROUP BY c_nationkey""",
    "latest_values": """
WITH e AS (SELECT *, CASE WHEN event_id % 4 <> 0 THEN json_extract_string(props, '$.k') END AS k FROM events)
SELECT event_type, user_id % 3 AS third, arg_max(k, (ts, event_id)) FILTER (k IS NOT NULL) AS last_value, arg_max(event_id, (ts, event_id)) AS last_event, count(k) AS n_values FROM e GROUP BY ALL""",
    "stats_with_defaults": f"""
WITH {MATCHES_SQL}, s AS (SELECT team, sum(gf) / count(*) AS gf FROM sides WHERE team % 6 <> 0 GROUP BY team)
SELECT concat_ws(',', CASE WHEN a.team IS NULL THEN 'a' END, CASE WHEN b.team IS NULL THEN 'b' END) AS missing, grp, count(*) AS n, round(avg(coalesce(a.gf, 1.35)), 6) AS mean_a, round(avg(coalesce(b.gf, 1.35)), 6) AS mean_b
FROM matches LEFT JOIN s a ON a.team = team_a LEFT JOIN s b ON b.team = team_b GROUP BY 1, 2""",
    "canonical_names": "SELECT CASE WHEN c_custkey % 4 = 3 THEN 'NOWHERE' ELSE 'NATION_' || c_nationkey END AS name, c_custkey % 4 <> 3 AS found, count(*) AS n FROM customer GROUP BY ALL",
    "probability_checks": f"WITH {MATCHES_SQL} SELECT grp, count(*) AS n, count(*) FILTER (match_id % 101 = 0) AS off, 0 AS outside, count(*) = count(DISTINCT match_id) AS \"unique\", count(*) >= 10 AS enough FROM matches GROUP BY grp",
    "phase_boards": f"""
WITH {MATCHES_SQL}, w AS (SELECT match_id, grp, team, match_id % 4 AS round FROM scored WHERE points = 3),
l AS (SELECT grp, team, round + 1 AS round, max(match_id) AS from_match FROM w GROUP BY ALL)
SELECT grp, round, count(*) AS n, count(from_match) AS linked, CAST(sum(coalesce(from_match, 0)) AS BIGINT) AS "check" FROM w LEFT JOIN l USING (grp, team, round) GROUP BY grp, round""",
    "dashboard_data": f"""
WITH {_TABLE_SQL}
SELECT 'teams' AS name, CAST(team AS VARCHAR) AS key, 11 AS n_fields, md5(concat_ws('|', drawn, ga, gf, groups, lost, place, played, points, team, won)) AS value FROM placed
UNION ALL SELECT 'phases', phase, 6, md5(concat_ws('|', even, goals, n, phase, place)) FROM phases
UNION ALL SELECT 'champions', CAST(team AS VARCHAR), 4, md5(concat_ws('|', seconds, team, titles, won)) FROM champions""",
    "dedup_results": f"""
WITH {MATCHES_SQL}
SELECT grp AS day, CASE WHEN match_id % 3 = 0 THEN 2 ELSE 1 END AS source, count(*) AS n, CAST(sum(CASE WHEN match_id % 3 = 0 THEN team_b ELSE team_a END) AS BIGINT) AS teams FROM matches GROUP BY ALL""",
}
