"""Many tournaments in one plan: group places to slots, slots to teams, matches decided round by round, and each team's path.

A tournament is a group of rows with one key; its teams, slots and matches are few, so each fits a row's array, and no plan has
a window over all tournaments. References between matches may go any number of levels, in any order of match numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import results, text
from .fixpoint import settled

#: How a match counts in the end: both sides known; a side needs what doesn't exist or is nobody; it needs itself.
DECIDED, MISSING, CIRCULAR = "decided", "missing", "circular"


def ranked_entrants(table: DataFrame, order: list[Column], thirds: int) -> DataFrame:
    """The teams of `table` (cup, team, grp and what `order` uses) with pos in their group, how they qualify, and seed.

    First and second qualify, and of the others with pos 3 the best `thirds` of the cup. seed orders the qualified of a cup
    by pos, then as `order`; others have none.
    """
    placed = table.withColumn("pos", F.row_number().over(Window.partitionBy("cup", "grp").orderBy(*order)))
    third = F.row_number().over(Window.partitionBy("cup", "pos").orderBy(*order))
    how = F.when(F.col("pos") == 1, "first").when(F.col("pos") == 2, "second").when((F.col("pos") == 3) & (F.col("third") <= thirds), "third")
    told = placed.withColumn("third", third).withColumn("how", how)
    seed = F.row_number().over(Window.partitionBy("cup").orderBy(F.col("how").isNull(), "pos", *order))
    return told.withColumn("seed", F.when(F.col("how").isNotNull(), seed)).drop("third")


def _fits(entrant: Column, slot: Column) -> Column:
    """Whether a slot asks for just this entrant: a place of a group, a third of some groups (any, if it names none), a team."""
    inside = F.contains(slot["groups"], entrant["grp"]) | (slot["groups"] == "")
    return (
        ((slot["kind"] == "third") & (entrant["how"] == "third") & inside)
        | (slot["kind"].isin("first", "second") & (entrant["how"] == slot["kind"]) & (entrant["grp"] == slot["groups"]))
        | ((slot["kind"] == "team") & (entrant["team"] == slot["slot"]))
    )


def allocated(slots: DataFrame, entrants: DataFrame, thirds_fall_back: bool = False) -> DataFrame:
    """Who gets each slot of each cup: slots (cup, place, slot) in order of place, entrants as ranked_entrants() gives them.

    A team gets one slot. A slot takes the best entrant by seed that it fits and that has none yet; a team that a slot names is
    kept for that slot. Where a slot names a team that isn't qualified or has a slot, or names nobody, the best that is left
    takes it; first, second and third of a group have no such replacement, but thirds if `thirds_fall_back`.

    Returns cup, place, slot, kind, team (null if nobody is left) and how: `fits`, `replaced` or `none`. It is one pass over each
    cup's slots with the teams taken so far as state: `aggregate` over an array, no rounds, no Python.
    """
    kind = F.when(text.slot_kind(F.col("slot")) != "team", text.slot_kind(F.col("slot"))).when(results.known_team(F.col("slot")), "team").otherwise("unknown")
    groups = F.regexp_replace(F.upper(F.trim("slot")), "[^A-Z]", "")
    asked = slots.withColumn("kind", kind).withColumn("groups", F.when(F.col("kind").isin("first", "second", "third"), groups).otherwise(""))
    lists = asked.groupBy("cup").agg(F.sort_array(F.collect_list(F.struct("place", "slot", "kind", "groups"))).alias("slots"))
    teams = entrants.filter("seed is not null").groupBy("cup").agg(F.sort_array(F.collect_list(F.struct("seed", "team", "grp", "how"))).alias("teams"))
    joined = lists.alias("l").join(teams.alias("t"), F.col("l.cup").eqNullSafe(F.col("t.cup")), "left")
    joined = joined.select("l.cup", "slots", F.coalesce("teams", F.array().cast(teams.schema["teams"].dataType)).alias("teams"))
    named = F.transform(F.filter("slots", lambda s: s["kind"] == "team"), lambda s: s["slot"])
    joined = joined.withColumn("reserved", F.array_intersect(named, F.transform("teams", lambda e: e["team"])))
    team_type = entrants.schema["team"].dataType.simpleString()
    start = F.struct(F.array().cast(f"array<{team_type}>").alias("taken"), F.array().cast(f"array<struct<team:{team_type},how:string>>").alias("out"))

    def give(state: Column, slot: Column) -> Column:
        free = F.filter("teams", lambda e: ~F.array_contains(state["taken"], e["team"]) & (~F.array_contains("reserved", e["team"]) | ((slot["kind"] == "team") & (e["team"] == slot["slot"]))))
        own = F.get(F.filter(free, lambda e: _fits(e, slot)), F.lit(0))
        replaced = slot["kind"].isin("team", "unknown", *(["third"] if thirds_fall_back else []))
        team = F.coalesce(own["team"], F.when(replaced, F.get(free, F.lit(0))["team"]))
        how = F.when(own.isNotNull(), "fits").when(team.isNotNull(), "replaced").otherwise("none")
        return F.struct(
            F.when(team.isNotNull(), F.array_append(state["taken"], team)).otherwise(state["taken"]).alias("taken"),
            F.array_append(state["out"], F.struct(team.alias("team"), how.alias("how"))).alias("out"),
        )

    out = joined.withColumn("given", F.aggregate("slots", start, give)["out"])
    pairs = F.zip_with("slots", "given", lambda s, g: F.struct(s["place"].alias("place"), s["slot"].alias("slot"), s["kind"].alias("kind"), g["team"].alias("team"), g["how"].alias("how")))
    return out.select("cup", F.inline(pairs))


def decided_matches(matches: DataFrame, pick: Column, most_rounds: int = 64) -> DataFrame:
    """Fills references between matches until nothing changes, and tells who wins each.

    matches: cup, match, and for each side x of a and b `team_x` (null if open), `want_x` (`winner` or `loser`) and `ref_x` (the
    match of the cup that it waits for; null: nobody can come). `pick` gives the winner of a row whose team_a and team_b are
    known, from these and other columns that its row has.

    Returns the rows of `matches` with team_a, team_b filled, winner, loser and verdict: `decided`; `missing` where a side needs,
    directly or through others, a match that isn't there or a side that nobody fills; else `circular`, where it needs itself or a
    match that does. A round settles all matches whose sides are settled, so there are as many as levels of references.
    """
    sides = ("a", "b")
    here = matches.select("cup", "match").distinct().select(F.col("cup").alias("_cup"), F.col("match").alias("_match"))
    pending = matches
    for x in sides:
        there = here.withColumnRenamed("_match", f"_{x}").withColumnRenamed("_cup", f"_cup_{x}").withColumn(f"_there_{x}", F.lit(True))
        pending = pending.join(there, F.col("cup").eqNullSafe(F.col(f"_cup_{x}")) & (F.col(f"ref_{x}") == F.col(f"_{x}")), "left").drop(f"_{x}", f"_cup_{x}")
        pending = pending.withColumn(f"_lost_{x}", F.col(f"team_{x}").isNull() & F.col(f"_there_{x}").isNull()).drop(f"_there_{x}")
    pending, done = settled(pending), []
    names = [*matches.columns, "winner", "loser", "verdict"]
    for _ in range(most_rounds):
        known = F.col("team_a").isNotNull() & F.col("team_b").isNotNull()
        lost = F.col("_lost_a") | F.col("_lost_b")
        won = F.when(known, pick)
        now = pending.filter(known | lost).withColumn("winner", won).withColumn("loser", F.when(F.col("winner") == F.col("team_a"), F.col("team_b")).when(F.col("winner") == F.col("team_b"), F.col("team_a")))
        now = settled(now.withColumn("verdict", F.when(known, DECIDED).otherwise(MISSING)).select(*names))
        if now.isEmpty():
            break
        done.append(now)
        pending = pending.filter(~(known | lost))
        for x in sides:
            ended = now.select(F.col("cup").alias("_cup"), F.col("match").alias("_match"), F.col("winner").alias("_w"), F.col("loser").alias("_l"), F.col("verdict").alias("_v"))
            pending = pending.join(ended, F.col("cup").eqNullSafe(F.col("_cup")) & (F.col(f"ref_{x}") == F.col("_match")), "left")
            got = F.when(F.col(f"want_{x}") == "winner", F.col("_w")).when(F.col(f"want_{x}") == "loser", F.col("_l"))
            pending = pending.withColumns({f"team_{x}": F.coalesce(f"team_{x}", got), f"_lost_{x}": F.col(f"_lost_{x}") | (F.col(f"team_{x}").isNull() & F.col("_v").isNotNull() & got.isNull())})
            pending = pending.drop("_cup", "_match", "_w", "_l", "_v")
        pending = settled(pending)
    kind = matches.schema["team_a"].dataType.simpleString()
    nobody = F.lit(None).cast(kind)
    ended = pending.limit(0).select("cup", "match").withColumns({"winner": nobody, "loser": nobody})
    for rows in done:
        ended = ended.unionByName(rows.filter(F.col("verdict") == DECIDED).select("cup", "match", "winner", "loser"))
    out = pending.withColumns({"winner": nobody, "loser": nobody, "verdict": F.lit(CIRCULAR)}).select(*names)
    for rows in done:
        out = out.unionByName(rows)
    # A match that is missing one side was settled at once; its other side may have been decided later.
    for x in sides:
        other = ended.select(F.col("cup").alias("_cup"), F.col("match").alias("_match"), F.col("winner").alias("_w"), F.col("loser").alias("_l"))
        late = (F.col("verdict") == MISSING) & F.col(f"team_{x}").isNull() & F.col("cup").eqNullSafe(F.col("_cup")) & (F.col(f"ref_{x}") == F.col("_match"))
        got = F.when(F.col(f"want_{x}") == "winner", F.col("_w")).when(F.col(f"want_{x}") == "loser", F.col("_l"))
        out = out.join(other, late, "left").withColumn(f"team_{x}", F.coalesce(f"team_{x}", got)).drop("_cup", "_match", "_w", "_l")
    return out


# What a team's path says.
GROUPS, QUALIFIED, CHAMPION, SECOND, THIRD, FOURTH = "Fase de grupos", "Clasificado a Ronda de 32", "Campeón", "Subcampeón", "Tercer lugar", "Cuarto lugar"


def team_paths(entrants: DataFrame, decided: DataFrame) -> DataFrame:
    """One row for each team of each cup: how far it came and who put it out.

    entrants: cup, team, how. decided: cup, phase (as text.PHASES names them), winner, loser. A champion is put out by nobody; who
    wins the match for the third place was put out in the semifinal, who loses it by the winner; all others by who beat them last.
    A team that won its last match and has no other is on its way from there.
    """
    place = text.phase_order(F.col("phase"))
    both = F.array(F.struct(F.col("winner").alias("team"), F.lit(True).alias("won"), F.col("loser").alias("other")), F.struct(F.col("loser").alias("team"), F.lit(False).alias("won"), F.col("winner").alias("other")))
    played = decided.filter("winner is not null and loser is not null").select("cup", "phase", place.alias("place"), F.inline(both))
    last = played.groupBy("cup", "team").agg(
        F.max_by(F.struct("phase", "won"), "place").alias("last"),
        F.max_by("other", F.when(~F.col("won"), F.col("place"))).alias("out_by"),
        F.count("*").alias("played"),
    )
    phase, won = F.col("last.phase"), F.col("last.won")
    reached = (
        F.when(phase.isNull(), F.when(F.col("how").isNotNull(), QUALIFIED).otherwise(GROUPS))
        .when(phase == "Final", F.when(won, CHAMPION).otherwise(SECOND))
        .when(phase == "Tercer lugar", F.when(won, THIRD).otherwise(FOURTH))
        .when(won, F.concat(F.lit("Avanza desde "), phase))
        .otherwise(F.concat(F.lit("Eliminado en "), phase))
    )
    out_by = F.when(reached != CHAMPION, F.col("out_by"))
    last = last.withColumnsRenamed({"cup": "_cup", "team": "_team"})
    joined = entrants.select("cup", "team", "grp", "pos", "how").join(last, F.col("cup").eqNullSafe(F.col("_cup")) & (F.col("team") == F.col("_team")), "left")
    return joined.select("cup", "team", "grp", "pos", "how", reached.alias("reached"), out_by.alias("out_by"), F.coalesce("played", F.lit(0)).alias("played"))
