"""Forecasts as of runs against plain sums over results, and which forecast counts for a match."""

from __future__ import annotations

import datetime as dt
import math
import random

from ledgerline.operators import forecasts

DAY = dt.date(2024, 1, 1)
_SAID = "match_id long, run_id string, run_at string, run_day date, favourite string, score string, p_a double, p_draw double, p_b double, p_favourite double, confidence string, extra int"


def test_forecasts_against_sums(spark):
    rng = random.Random(3)
    at = lambda: DAY + dt.timedelta(rng.randrange(120))
    results = [(at(), rng.choice("abcd"), rng.choice("efgh"), rng.randrange(5), rng.randrange(4)) for _ in range(200)]
    calendar = [(i, at(), rng.choice("abcdz"), rng.choice("efgh")) for i in range(60)] + [(99, None, "a", "e")]
    runs = [(f"r{k}", f"{k}", DAY + dt.timedelta(k)) for k in (-1, 0, 30, 61, 119, 400)]
    points = {"a": (1000.0, 1500.0), "e": (1300.0, 1400.0), "b": (900.0, None)}
    frame = spark.createDataFrame
    out = forecasts.forecasts(
        frame(calendar, "match_id long, day date, team_a string, team_b string"), frame([*results, (None, "a", "e", 9, 9), (DAY, "a", "e", None, 9)], "day date, team_a string, team_b string, goals_a int, goals_b int"),
        frame([(t, *p) for t, p in points.items()], "team string, points double, elo double"), frame(runs, "run_id string, run_at string, run_day date"), 20,
    ).collect()
    expected = {}
    clip = lambda x, low, high: min(max(x, low), high)
    for run, _, day in runs:
        seen = [r for r in results if r[0] <= day]
        sides = [(d, a, g, h) for d, a, _, g, h in seen] + [(d, b, h, g) for d, _, b, g, h in seen]
        whole = sum(s[2] for s in sides) / len(sides) if sides else 1.35
        for match, when, a, b in calendar:
            if when and day < when <= day + dt.timedelta(20):
                form = {}
                for team in (a, b):
                    own = [(0.5 ** ((day - d).days / 365), g, h) for d, t, g, h in sides if t == team]
                    total = sum(w for w, _, _ in own)
                    form[team] = (sum(w * g for w, g, _ in own) / total / whole, sum(w * h for w, _, h in own) / total / whole) if own else (1, 1)
                (pa, ea), (pb, eb) = points.get(a, (None, None)), points.get(b, (None, None))
                gap = clip(0.55 * ((pa - pb) / 200 if pa and pb else 0) + 0.45 * ((ea - eb) / 400 if ea and eb else 0), -1, 1)
                mean = [clip(1.35 * clip(form[x][0], 0.6, 1.6) * clip(form[y][1], 0.6, 1.6) * math.exp(0.35 * g), 0.2, 4.5) for x, y, g in ((a, b, gap), (b, a, -gap))]
                term = [[math.exp(-m) * m**k / math.factorial(k) for k in range(9)] for m in mean]
                cells = {(i, j): term[0][i] * term[1][j] for i in range(9) for j in range(9)}
                share = [sum(p for (i, j), p in cells.items() if (i > j) - (i < j) == side) / sum(cells.values()) for side in (1, 0, -1)]
                expected[run, match] = (*mean, *share, not any(s[1] == a for s in sides))
    assert {(r.run_id, r.match_id) for r in out} == set(expected) and len(out) == len(expected) > 20
    for r in out:
        *numbers, unseen = expected[r.run_id, r.match_id]
        assert all(abs(x - y) < 1e-3 for x, y in zip((r.mean_a, r.mean_b, r.p_a, r.p_draw, r.p_b), numbers))
        assert (f"no results of {r.team_a}." in r.note) == unseen
        assert r.favourite == (r.team_a, "draw", r.team_b)[max(range(3), key=lambda k: (round(numbers[2 + k], 9), -k))]


def test_the_last_forecast_before_a_match_counts(spark):
    d = lambda k: DAY + dt.timedelta(k)
    played = [(1, d(5), "North", "South", 2, 1), (2, d(5), "North", "South", 1, 1), (3, None, "North", "South", 0, 1), (4, d(5), "North", "South", None, 1), (5, d(5), "North", "South", 0, 0), (6, d(5), "North", "South", 3, 1), (None, d(5), "North", "South", 3, 1)]
    said = [
        (1, "x", "09", d(1), "South", "0-1"), (1, "y", "10", d(5), " north ", " 2 - 1"), (1, "z", "11", d(6), "South", "0-3"), (1, "u", "99", None, "South", "0-3"), (1, "w", "10", d(0), "South", "0-1"),
        (2, "x", "09", d(1), "Draw", "one-all"), (3, "x", "09", d(900), "South", "0-1"), (4, "x", "09", d(1), "South", "0-1"), (5, "x", "09", d(1), "Elsewhere", None), (None, "x", "09", d(1), "North", "3-1"),
    ]
    rows = forecasts.validated(
        spark.createDataFrame(played, "match_id long, day date, team_a string, team_b string, goals_a int, goals_b int"), spark.createDataFrame([(*s, 0.5, 0.3, 0.2, 0.5, "Media", 1) for s in said], _SAID)
    ).collect()
    got = {r.match_id: (r.run_id, r.result, r.predicted, r.score_a, r.hit_result, r.hit_score, r.error_a, r.has_forecast, r.note) for r in rows}
    assert len(rows) == 7 and got == {
        1: ("y", "A", "A", 2, True, True, 0, True, ""), 2: ("x", "draw", "draw", None, True, False, None, True, ""), 3: ("x", "B", "B", 0, True, True, 0, True, ""), 4: ("x", None, "B", 0, False, False, None, True, ""),
        5: ("x", "draw", None, None, False, False, None, True, "the favourite is neither side"), 6: (None, "A", None, None, False, False, None, False, "no forecast before the match"),
        None: (None, "A", None, None, False, False, None, False, "no forecast before the match"),
    }


def test_chances_are_worked_out_once_for_the_same_sides_and_day(spark, monkeypatch):
    taken, own = [], forecasts._played_out
    monkeypatch.setattr(forecasts, "_played_out", lambda rows: taken.append(rows) or own(rows))
    sides = [("a", "b"), ("b", "a"), ("a", None)]
    calendar = spark.createDataFrame([(k, DAY + dt.timedelta(1 + k % 9), *sides[k % 3]) for k in range(90)], "match_id long, day date, team_a string, team_b string")
    results = spark.createDataFrame([(DAY, "a", "b", 2, 1)], "day date, team_a string, team_b string, goals_a int, goals_b int")
    ratings = spark.createDataFrame([("a", 1000.0, 1500.0)], "team string, points double, elo double")
    runs = spark.createDataFrame([("r", "1", DAY), ("s", "2", DAY)], "run_id string, run_at string, run_day date")
    out = forecasts.forecasts(calendar, results, ratings, runs, 20).collect()
    assert len(out) == len({(r.run_id, r.match_id) for r in out}) == 180 and taken[0].count() == 3
    assert {r.favourite for r in out if r.team_b is None} != {None} and len({r.p_a for r in out}) == 3
