"""Queries on many tournaments at once: 48 customers each, in twelve groups, with a calendar of 32 matches.

Points come from orders, strength from the balance. A third of the calendars have a team by name, a slot that names nobody, a match
that waits for itself or one that waits for a match that isn't there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import results, text
from ..operators import knockout
from ..sources.tables import read

SIZE, N_GROUPS, MATCHES, THIRDS = 48, 12, 32, 8


def _teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    points = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(F.col("o_orderkey") % 4).alias("pts"), F.count("*").alias("played"))
    rows = read(spark, sf_dir, "customer").join(points, "c_custkey", "left")
    return rows.select(
        F.floor(k / SIZE).alias("cup"),
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("team"),
        F.char(65 + k % SIZE % N_GROUPS).alias("grp"),
        F.coalesce("pts", F.lit(0)).alias("pts"),
        F.coalesce("played", F.lit(0)).alias("played"),
        F.col("c_acctbal").cast("double").alias("rating"),
    )


def _entrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knockout.ranked_entrants(_teams(spark, sf_dir), [F.desc("pts"), F.col("played"), F.col("team")], THIRDS)


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cup, match, phase, slot_a, slot_b."""
    m, cup = F.col("match"), F.col("cup")
    letter = lambda n: F.char(65 + n.cast("long") % N_GROUPS)
    said = lambda kind, n: F.concat(F.lit(kind), n.cast("long").cast("string"))
    thirds = F.concat(F.lit("3"), *(letter(m + 2 * j) for j in range(5)))
    a = (
        F.when((cup % 4 == 2) & (m == 15), "TBD")
        .when((cup % 5 == 3) & (m == 20), "W26")
        .when(m <= 12, F.concat(F.lit("1"), letter(m - 1)))
        .when(m <= 16, F.concat(F.lit("2"), letter((m - 13) * 2)))
        .when(m <= 24, said("W", 2 * m - 33))
        .when(m <= 28, said("W", 2 * m - 33))
        .when(m <= 30, said("W", 2 * m - 33))
        .when(m == 31, F.lit("L29"))
        .otherwise("W29")
    )
    b = (
        F.when((cup % 4 == 1) & (m == 14), said("T", cup * SIZE + 7))
        .when((cup % 5 == 4) & (m == 27), "W77")
        .when(m <= 8, thirds)
        .when(m <= 12, F.concat(F.lit("2"), letter(8 + m % 4)))
        .when(m <= 16, F.concat(F.lit("2"), letter((m - 13) * 2 + 1)))
        .when(m <= 30, said("W", 2 * m - 32))
        .when(m == 31, F.lit("L30"))
        .otherwise("W30")
    )
    ends = {16: "Ronda de 32", 24: "Octavos", 28: "Cuartos", 30: "Semifinal", 31: "Tercer lugar"}
    phase = F.lit("Final")
    for end, name in reversed(ends.items()):
        phase = F.when(m <= end, name).otherwise(phase)
    cups = _teams(spark, sf_dir).select("cup").distinct()
    return cups.withColumn("match", F.explode(F.sequence(F.lit(1), F.lit(MATCHES)))).select("cup", m.cast("long").alias("match"), phase.alias("phase"), a.alias("slot_a"), b.alias("slot_b"))


def slots_allocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who gets each slot of the first round of each cup, in the order of the calendar."""
    calendar = _calendar(spark, sf_dir).filter("match <= 16")
    sides = F.array(F.struct((F.col("match") * 2 - 1).alias("place"), F.col("slot_a").alias("slot")), F.struct((F.col("match") * 2).alias("place"), F.col("slot_b").alias("slot")))
    return knockout.allocated(calendar.select("cup", F.inline(sides)), _entrants(spark, sf_dir))


def _first_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = slots_allocated(spark, sf_dir).select("cup", F.ceil(F.col("place") / 2).alias("match"), (F.col("place") % 2 == 1).alias("first"), "team")
    return given.groupBy("cup", "match").agg(F.max(F.when(F.col("first"), F.col("team"))).alias("given_a"), F.max(F.when(~F.col("first"), F.col("team"))).alias("given_b"))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with first-round teams, references of later rounds, and which side won where that is known already."""
    rows = _calendar(spark, sf_dir).join(_first_round(spark, sf_dir), ["cup", "match"], "left")
    real = F.when((F.col("cup") * MATCHES + F.col("match")) % 7 == 0, "a").when((F.col("cup") * MATCHES + F.col("match")) % 7 == 3, "b")
    out = rows.withColumn("real", real)
    for x in ("a", "b"):
        kind = text.slot_kind(F.col(f"slot_{x}"))
        later = kind.isin("winner", "loser")
        ref = F.when(later, F.regexp_extract(f"slot_{x}", "([0-9]+)", 1).try_cast("long"))
        out = out.withColumns({f"team_{x}": F.col(f"given_{x}"), f"want_{x}": F.when(later, kind), f"ref_{x}": ref})
    return out.drop("given_a", "given_b")


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches of all cups; a pick takes the real winner where there is one, else goals, chance and rating decide."""
    # A team carries its rating through the rounds, so that no round has to look it up.
    ratings = _teams(spark, sf_dir).select(F.col("cup").alias("_cup"), F.col("team").alias("_team"), "rating")
    rows = _matches(spark, sf_dir)
    for x in ("a", "b"):
        rows = rows.join(ratings.withColumnRenamed("rating", "_rating"), (F.col("cup") == F.col("_cup")) & (F.col(f"team_{x}") == F.col("_team")), "left").drop("_cup", "_team")
        rows = rows.withColumn(f"team_{x}", F.when(F.col(f"team_{x}").isNotNull(), F.struct(F.col(f"team_{x}").alias("team"), F.col("_rating").alias("rating")))).drop("_rating")
    a, b = F.col("team_a"), F.col("team_b")
    chance = results.win_chance(a["rating"], b["rating"])
    goals = (F.round(results.linear_goals(chance)), F.round(results.linear_goals(1 - chance)))
    pick = F.when(F.col("real") == "a", a).when(F.col("real") == "b", b).otherwise(results.knockout_pick(a, b, goals, (chance, 1 - chance), (a["rating"], b["rating"])))
    out = knockout.decided_matches(rows, pick)
    return out.withColumns({c: F.col(c)["team"] for c in ("team_a", "team_b", "winner", "loser")})


def tournament_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each match of each cup with its teams, who wins and loses it, or why nobody does."""
    return _decided(spark, sf_dir).select("cup", "match", "phase", "slot_a", "slot_b", "team_a", "team_b", "winner", "loser", "verdict")


def tournament_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each team of each cup comes, and who puts it out."""
    return knockout.team_paths(_entrants(spark, sf_dir), _decided(spark, sf_dir))


QUERIES = {f.__name__: f for f in (slots_allocated, tournament_matches, tournament_paths)}

_CUP_SQL = """
points AS (SELECT o_custkey, sum(o_orderkey % 4) AS pts, count(*) AS played FROM orders GROUP BY o_custkey),
teams AS (
  SELECT c_custkey // 48 AS cup, 'T' || c_custkey AS team, chr(CAST(65 + c_custkey % 48 % 12 AS INTEGER)) AS grp,
         CAST(coalesce(pts, 0) AS BIGINT) AS pts, coalesce(played, 0) AS played, CAST(c_acctbal AS DOUBLE) AS rating
  FROM customer LEFT JOIN points ON o_custkey = c_custkey),
placed AS (SELECT *, row_number() OVER (PARTITION BY cup, grp ORDER BY pts DESC, played, team) AS pos FROM teams),
thirds AS (SELECT *, row_number() OVER (PARTITION BY cup, pos ORDER BY pts DESC, played, team) AS third FROM placed),
told AS (SELECT *, CASE WHEN pos = 1 THEN 'first' WHEN pos = 2 THEN 'second' WHEN pos = 3 AND third <= 8 THEN 'third' END AS how FROM thirds),
entrants AS (SELECT *, CASE WHEN how IS NOT NULL THEN row_number() OVER (PARTITION BY cup ORDER BY how IS NULL, pos, pts DESC, played, team) END AS seed FROM told),
calendar AS (
  SELECT cup, m AS match,
         CASE WHEN m <= 16 THEN 'Ronda de 32' WHEN m <= 24 THEN 'Octavos' WHEN m <= 28 THEN 'Cuartos' WHEN m <= 30 THEN 'Semifinal' WHEN m = 31 THEN 'Tercer lugar' ELSE 'Final' END AS phase,
         CASE WHEN cup % 4 = 2 AND m = 15 THEN 'TBD' WHEN cup % 5 = 3 AND m = 20 THEN 'W26' WHEN m <= 12 THEN '1' || substr('ABCDEFGHIJKL', m, 1)
              WHEN m <= 16 THEN '2' || substr('ACEG', m - 12, 1) WHEN m <= 30 THEN 'W' || (2 * m - 33) WHEN m = 31 THEN 'L29' ELSE 'W29' END AS slot_a,
         CASE WHEN cup % 4 = 1 AND m = 14 THEN 'T' || (cup * 48 + 7) WHEN cup % 5 = 4 AND m = 27 THEN 'W77'
              WHEN m <= 8 THEN '3' || array_to_string(list_transform([0, 2, 4, 6, 8], lambda j: substr('ABCDEFGHIJKL', CAST((m + j) % 12 + 1 AS INTEGER), 1)), '')
              WHEN m <= 12 THEN '2' || substr('JKLI', m - 8, 1) WHEN m <= 16 THEN '2' || substr('BDFH', m - 12, 1) WHEN m <= 30 THEN 'W' || (2 * m - 32)
              WHEN m = 31 THEN 'L30' ELSE 'W30' END AS slot_b
  FROM (SELECT DISTINCT cup FROM teams), (SELECT unnest(range(1, 33)) AS m)),
asked AS (
  SELECT cup, match * 2 - 1 AS place, slot_a AS slot FROM calendar WHERE match <= 16
  UNION ALL SELECT cup, match * 2, slot_b FROM calendar WHERE match <= 16),
kinds AS (SELECT *, CASE left(slot, 1) WHEN '1' THEN 'first' WHEN '2' THEN 'second' WHEN '3' THEN 'third' ELSE CASE WHEN slot = 'TBD' THEN 'unknown' ELSE 'team' END END AS kind FROM asked),
lists AS (SELECT cup, list({'team': team, 'grp': grp, 'how': how} ORDER BY seed) AS ents FROM entrants WHERE seed IS NOT NULL GROUP BY cup),
kept AS (SELECT k.cup, list(k.slot) AS reserved FROM kinds k JOIN entrants e ON e.cup = k.cup AND e.team = k.slot AND e.seed IS NOT NULL WHERE kind = 'team' GROUP BY k.cup),
-- one slot after the other, with the teams that have one
turns AS (
  SELECT cup, 0::BIGINT AS place, ''::VARCHAR AS slot, ''::VARCHAR AS kind, NULL::VARCHAR AS team, NULL::VARCHAR AS fit, []::VARCHAR[] AS taken FROM lists
  UNION ALL
  SELECT cup, place, slot, kind, team, fit, CASE WHEN team IS NULL THEN taken ELSE list_append(taken, team) END FROM (
    SELECT cup, place, slot, kind, fit, taken, coalesce(fit, CASE WHEN kind IN ('team', 'unknown') THEN free[1].team END) AS team FROM (
      SELECT cup, place, slot, kind, taken, free, (list_filter(free, lambda e: CASE kind WHEN 'team' THEN e.team = slot WHEN 'third' THEN e.how = 'third' AND contains(slot, e.grp)
                                                  WHEN 'unknown' THEN FALSE ELSE e.how = kind AND e.grp = substr(slot, 2) END))[1].team AS fit FROM (
        SELECT t.cup, k.place, k.slot, k.kind, t.taken,
               list_filter(ents, lambda e: NOT list_contains(t.taken, e.team) AND (NOT list_contains(coalesce(reserved, []), e.team) OR (k.kind = 'team' AND e.team = k.slot))) AS free
        FROM turns t JOIN kinds k ON k.cup = t.cup AND k.place = t.place + 1 JOIN lists l ON l.cup = t.cup LEFT JOIN kept r ON r.cup = t.cup)))),
given AS (SELECT cup, place, slot, kind, team, CASE WHEN fit IS NOT NULL THEN 'fits' WHEN team IS NOT NULL THEN 'replaced' ELSE 'none' END AS how FROM turns WHERE place > 0)"""

#: Levels of references that the SQL follows; the calendar has five.
_LEVELS = 7
_SIDES = """
open_sides AS (
  SELECT cup, match, 'a' AS side, slot_a AS slot FROM calendar WHERE match > 16 UNION ALL SELECT cup, match, 'b', slot_b FROM calendar WHERE match > 16),
waits AS (SELECT cup, match, side, left(slot, 1) = 'W' AS win, CAST(substr(slot, 2) AS BIGINT) AS ref FROM open_sides),
lost0 AS (
  SELECT cup, CAST(ceil(place / 2) AS BIGINT) AS match FROM given WHERE team IS NULL
  UNION SELECT cup, match FROM waits WHERE ref NOT BETWEEN 1 AND 32)"""


def _level(k: int) -> str:
    """Sides known after k rounds, and what they decide; matches that can never be, and all that wait for them."""
    known = (
        "SELECT cup, CAST(ceil(place / 2) AS BIGINT) AS match, CASE WHEN place % 2 = 1 THEN 'a' ELSE 'b' END AS side, team FROM given WHERE team IS NOT NULL"
        if k == 0
        else f"SELECT * FROM side{k - 1} UNION SELECT w.cup, w.match, w.side, CASE WHEN win THEN winner ELSE loser END FROM waits w JOIN won{k - 1} d ON d.cup = w.cup AND d.match = w.ref"
    )
    lost = "" if k == 0 else f"\nlost{k} AS (SELECT * FROM lost{k - 1} UNION SELECT w.cup, w.match FROM waits w JOIN lost{k - 1} l ON l.cup = w.cup AND l.match = w.ref),"
    return f"""{lost}
side{k} AS ({known}),
won{k} AS (
  SELECT a.cup, a.match, a.team AS team_a, b.team AS team_b,
         CASE WHEN (a.cup * 32 + a.match) % 7 = 0 THEN a.team WHEN (a.cup * 32 + a.match) % 7 = 3 THEN b.team WHEN y.rating > x.rating THEN b.team ELSE a.team END AS winner,
         CASE WHEN winner = a.team THEN b.team ELSE a.team END AS loser
  FROM side{k} a JOIN side{k} b ON a.cup = b.cup AND a.match = b.match AND a.side = 'a' AND b.side = 'b'
  JOIN teams x ON x.team = a.team JOIN teams y ON y.team = b.team)"""


_DECIDED_SQL = f"""WITH RECURSIVE {_CUP_SQL.strip()},{_SIDES},{",".join(map(_level, range(_LEVELS)))},
decided AS (
  SELECT c.cup, c.match, phase, slot_a, slot_b, a.team AS team_a, b.team AS team_b, winner, loser,
         CASE WHEN winner IS NOT NULL THEN 'decided' WHEN l.match IS NOT NULL THEN 'missing' ELSE 'circular' END AS verdict
  FROM calendar c LEFT JOIN won{_LEVELS - 1} w ON w.cup = c.cup AND w.match = c.match LEFT JOIN lost{_LEVELS - 1} l ON l.cup = c.cup AND l.match = c.match
  LEFT JOIN side{_LEVELS - 1} a ON a.cup = c.cup AND a.match = c.match AND a.side = 'a' LEFT JOIN side{_LEVELS - 1} b ON b.cup = c.cup AND b.match = c.match AND b.side = 'b')"""

ORACLE_SQL: dict[str, str] = {
    "slots_allocated": f"WITH RECURSIVE {_CUP_SQL.strip()}\nSELECT * FROM given",
    "tournament_matches": f"{_DECIDED_SQL}\nSELECT * FROM decided",
    "tournament_paths": f"""{_DECIDED_SQL},
events AS (
  SELECT cup, phase, match, winner AS team, TRUE AS won, loser AS other FROM decided WHERE winner IS NOT NULL
  UNION ALL SELECT cup, phase, match, loser, FALSE, winner FROM decided WHERE winner IS NOT NULL),
last AS (SELECT cup, team, max_by(phase, match) AS phase, max_by(won, match) AS won, max_by(other, match) FILTER (NOT won) AS out_by, count(*) AS played FROM events GROUP BY cup, team),
named AS (
  SELECT e.cup, e.team, grp, CAST(pos AS INTEGER) AS pos, how,
         CASE WHEN phase IS NULL THEN CASE WHEN how IS NULL THEN 'Fase de grupos' ELSE 'Clasificado a Ronda de 32' END
              WHEN phase = 'Final' THEN CASE WHEN won THEN 'Campeón' ELSE 'Subcampeón' END
              WHEN phase = 'Tercer lugar' THEN CASE WHEN won THEN 'Tercer lugar' ELSE 'Cuarto lugar' END
              WHEN won THEN 'Avanza desde ' || phase ELSE 'Eliminado en ' || phase END AS reached, out_by, coalesce(l.played, 0) AS played
  FROM entrants e LEFT JOIN last l ON l.cup = e.cup AND l.team = e.team)
SELECT cup, team, grp, pos, how, reached, CASE WHEN reached <> 'Campeón' THEN out_by END AS out_by, played FROM named""",
}
