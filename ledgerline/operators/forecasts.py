"""Forecasts of paired contests as of many runs at once, and what results say of them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import model, text
from . import joins

_SUMS = ("w", "gf", "ga", "n", "all_gf", "all_ga")


def _running(results: DataFrame, key: list[str]) -> DataFrame:
    """Sums up to each day that has results. A result's weight at any later day is its weight 2 ^ (day / half-life) here by a
    factor that is the same for all, so weighted means as of a day are ratios of two running sums: runs don't multiply results."""
    day = F.datediff("day", F.lit("2000-01-01").cast("date")) / model.HALF_LIFE
    side = lambda a, b: F.struct(F.col(f"team_{a}").alias("team"), F.col(f"goals_{a}").alias("gf"), F.col(f"goals_{b}").alias("ga"))
    rows = results.select("day", F.pow(F.lit(2.0), day).alias("w"), F.explode(F.array(side("a", "b"), side("b", "a"))).alias("s")).select("day", "w", "s.*")
    usable = rows.filter("day is not null and team is not null and gf is not null and ga is not null")
    days = usable.groupBy(*key, "day").agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("gf")).alias("gf"), F.sum(F.col("w") * F.col("ga")).alias("ga"), F.count("*").alias("n"), F.sum("gf").alias("all_gf"), F.sum("ga").alias("all_ga")
    )
    upto = Window.partitionBy(*(key or [F.lit(0)])).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return days.select(*key, "day", *(F.sum(c).over(upto).alias(c) for c in _SUMS))


def _asked(calendar: DataFrame, runs: DataFrame, horizon: int) -> DataFrame:
    """Each run with the matches of the days after it, up to `horizon`; they meet in buckets of days, not all with all."""
    bucket = lambda c: F.floor(F.datediff(c, F.lit("2000-01-01").cast("date")) / horizon)
    cells = runs.select("run_id", "run_at", "run_day", F.explode(F.array(bucket("run_day"), bucket("run_day") + 1)).alias("_cell"))
    met = calendar.select("match_id", "day", "team_a", "team_b", bucket("day").alias("_cell")).join(cells, "_cell")
    return met.filter((F.col("day") > F.col("run_day")) & (F.col("day") <= F.date_add("run_day", horizon))).drop("_cell")


def forecasts(calendar: DataFrame, results: DataFrame, ratings: DataFrame, runs: DataFrame, horizon: int) -> DataFrame:
    """A row for each run and each match of the `horizon` days after it: means, probabilities, favourite, confidence, score and note.

    Args:
        calendar: match_id, day, team_a, team_b.
        results: day, team_a, team_b, goals_a, goals_b; those of a run's day and before count for it.
        ratings: team (unique), points, elo.
        runs: run_id, run_at, run_day.

    Means of goals are weighted by recency (model.HALF_LIFE) and taken relative to those of all teams as of the run; a team without
    results plays like the mean, which `note` says, and one without a rating has none. favourite is the team, or `draw`; of chances
    equal to nine digits that of a comes first, then the draw. Results with a null in any column don't count, matches without a day have no run
    before them, and repeated matches repeat. What a run needs is one row for each team and day of running sums. Matches of the same
    sides as of the same day have the same chances, so those are worked out once for each (run_day, team_a, team_b).
    """
    matches = _asked(calendar, runs, horizon)
    asked = matches.select("run_day", "team_a", "team_b").distinct()
    known = joins.asof(_team_days(asked), _running(results, ["team"]), "team", "run_day", "day", "n", "_row")
    stats = known.select("team", "run_day", F.col("r_n").alias("n"), (F.col("r_gf") / F.col("r_w")).alias("gf"), (F.col("r_ga") / F.col("r_w")).alias("ga"))
    whole = joins.asof(runs.select(F.lit(0).alias("_all"), "run_day").distinct().withColumn("_row", F.lit(0).cast("long")), _running(results, []).withColumn("_all", F.lit(0)), "_all", "run_day", "day", "n", "_row")
    mean = lambda c: F.coalesce(F.when(F.col(f"r_all_{c}") > 0, F.col(f"r_all_{c}") / F.col("r_n")), F.lit(model.BASE_GOALS))
    rows = asked.join(whole.select("run_day", mean("gf").alias("all_gf"), mean("ga").alias("all_ga")), "run_day")
    for side in ("a", "b"):
        named = lambda df, *columns: df.select(F.col("team").alias(f"team_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in columns))  # noqa: E731, B023
        rows = rows.join(stats.select(F.col("team").alias(f"team_{side}"), "run_day", *(F.col(c).alias(f"{c}_{side}") for c in ("n", "gf", "ga"))), [f"team_{side}", "run_day"], "left")
        rows = rows.join(named(ratings, "points", "elo"), f"team_{side}", "left")
    chances = _played_out(rows)
    sides = ("run_day", "team_a", "team_b")
    out = matches.join(chances.withColumnsRenamed({c: f"_{c}" for c in sides}), reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in sides)))
    return out.select("run_id", "run_at", "run_day", "match_id", "day", "team_a", "team_b", *(c for c in chances.columns if c not in sides))


def _team_days(asked: DataFrame) -> DataFrame:
    sides = asked.select("run_day", F.explode(F.array("team_a", "team_b")).alias("team")).distinct()
    return sides.withColumn("_row", F.lit(0).cast("long"))


def _played_out(rows: DataFrame) -> DataFrame:
    """Means, the grid of scores and what follows from it, a step each, so that none is computed twice."""
    attack = lambda side: F.coalesce(F.col(f"gf_{side}") / F.col("all_gf"), F.lit(1.0))
    weakness = lambda side: F.coalesce(F.col(f"ga_{side}") / F.col("all_ga"), F.lit(1.0))
    gap = F.coalesce(model.strength_gap(F.col("points_a"), F.col("points_b"), F.col("elo_a"), F.col("elo_b")), F.lit(0.0))
    rows = rows.withColumn("gap", gap)
    rows = rows.withColumns({"mean_a": model.expected_goals(attack("a"), weakness("b"), F.col("gap")), "mean_b": model.expected_goals(attack("b"), weakness("a"), -F.col("gap"))})
    rows = rows.withColumn("grid", model.score_grid(F.col("mean_a"), F.col("mean_b")))
    grid = F.col("grid")
    rows = rows.withColumns({"p_a": model.grid_share(grid, lambda i, j: i > j), "p_draw": model.grid_share(grid, lambda i, j: i == j), "p_b": model.grid_share(grid, lambda i, j: i < j), "score": model.likeliest(grid)})
    best = F.sort_array(F.array("p_a", "p_draw", "p_b"), asc=False)
    near = lambda c: F.round(c, 9) == F.round(best[0], 9)  # noqa: E731 - so that even sides are equal whatever the order of sums
    favourite = F.when(near("p_a"), F.col("team_a").cast("string")).when(near("p_draw"), "draw").otherwise(F.col("team_b").cast("string"))
    lacking = F.concat_ws(" ", *(F.when(F.coalesce(f"n_{s}", F.lit(0)) == 0, F.concat(F.lit("no results of "), F.col(f"team_{s}").cast("string"), F.lit("."))) for s in ("a", "b")))
    return rows.select(
        "run_day", "team_a", "team_b", F.round("mean_a", 3).alias("mean_a"), F.round("mean_b", 3).alias("mean_b"), *(F.round(c, 4).alias(c) for c in ("p_a", "p_draw", "p_b")),
        favourite.alias("favourite"), F.round(best[0], 4).alias("p_favourite"), model.confidence(best[0], best[1]).alias("confidence"), "score", lacking.alias("note"),
    )


def validated(played: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Each played match with the forecast that counts for it, and what it got right.

    Args:
        played: match_id (unique), day, team_a, team_b, goals_a, goals_b.
        snapshot: match_id, run_id, run_at, run_day, favourite, score, p_a, p_draw, p_b, p_favourite, confidence; rows of runs are only added.

    Of the forecasts of the match's day or before that of the latest run counts (then of the largest run_id); where the match has no day,
    of all. A forecast without a day never counts for a match that has one. A favourite that is neither team nor `draw` predicts nothing,
    a score that isn't two numbers has no goals, and neither hits. Candidates are reduced to one before they shuffle on.
    """
    own = F.struct("run_id", "run_day", "favourite", "score", "p_a", "p_draw", "p_b", "p_favourite", "confidence", "run_at")
    said = snapshot.select("match_id", "run_day", F.struct("run_at", "run_id").alias("turn"), own.alias("f"))
    asked = played.select("match_id", F.col("day").alias("_day")).join(said, "match_id").filter(F.col("_day").isNull() | (F.col("run_day") <= F.col("_day")))
    last = asked.groupBy("match_id").agg(F.max_by("f", "turn").alias("f"))
    rows = played.select("match_id", "day", "team_a", "team_b", "goals_a", "goals_b").join(last, "match_id", "left")
    favourite = F.lower(text.clean(F.col("f.favourite")))
    team = lambda c: F.lower(text.clean(F.col(c)))
    predicted = F.when(favourite == "", None).when(favourite == "draw", "draw").when(favourite == team("team_a"), "A").when(favourite == team("team_b"), "B")
    a, b = F.col("goals_a"), F.col("goals_b")
    result = F.when(a > b, "A").when(a < b, "B").when(a == b, "draw")
    goals = [text.score_part(F.col("f.score"), k).cast("long") for k in (0, 1)]
    has = F.col("f").isNotNull()
    hit = lambda x: F.coalesce(x, F.lit(False))
    note = F.when(~has, "no forecast before the match").when(predicted.isNull(), "the favourite is neither side").otherwise("")
    return rows.select(
        "match_id", "day", "team_a", "team_b", "goals_a", "goals_b", result.alias("result"), "f.run_id", "f.run_at", "f.run_day", "f.favourite", predicted.alias("predicted"), "f.score", goals[0].alias("score_a"),
        goals[1].alias("score_b"), "f.p_a", "f.p_draw", "f.p_b", "f.p_favourite", "f.confidence", hit(predicted == result).alias("hit_result"), hit((goals[0] == a) & (goals[1] == b)).alias("hit_score"),
        (goals[0] - a).alias("error_a"), (goals[1] - b).alias("error_b"), has.alias("has_forecast"), note.alias("note"),
    )
