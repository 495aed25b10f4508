"""Slots, matches and paths of many tournaments against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import knockout

ENTRANTS, SLOTS = "cup string, team string, grp string, how string, seed int", "cup string, place int, slot string"


def plain_allocation(slots, entrants, fall_back):
    out = {}
    for cup in {s[0] for s in slots}:
        teams = sorted((e for e in entrants if e[0] == cup and e[4] is not None), key=lambda e: e[4])
        own = sorted((s for s in slots if s[0] == cup), key=lambda s: s[1])
        reserved, taken = {s[2] for s in own if s[2].startswith("T") and s[2] != "TBD"} & {e[1] for e in teams}, set()
        for _, place, slot in own:
            free = [e for e in teams if e[1] not in taken and (e[1] not in reserved or e[1] == slot)]
            kind = {"1": "first", "2": "second", "3": "third"}.get(slot[:1])
            fits = [e for e in free if (e[3] == kind and (not slot[1:] or e[2] in slot[1:]) if kind else e[1] == slot)]
            pick = fits[:1] or (free[:1] if kind is None or (kind == "third" and fall_back) else [])
            out[cup, place] = (pick[0][1] if pick else None, "fits" if fits else "replaced" if pick else "none")
            taken |= {e[1] for e in pick}
    return out


@pytest.mark.parametrize("fall_back", [False, True])
def test_allocation_against_a_loop(spark, fall_back):
    rng = random.Random(7)
    entrants, slots = [], []
    for cup in [*(f"c{i}" for i in range(60)), None]:
        n = rng.randint(0, 12)
        for k, (g, how) in enumerate(rng.sample([(g, how) for g in "ABCD" for how in ("first", "second", "third")], n)):
            entrants.append((cup, f"T{k}", g, how, k + 1))
        entrants.append((cup, "T99", "A", None, None))
        asked = [rng.choice(["1A", "1B", "2A", "2C", "2D", "3AB", "3BCD", "3D", "T3", "T5", "T99", "TBD", "Ganador"]) for _ in range(rng.randint(1, 14))]
        slots += [(cup, i, s) for i, s in enumerate(asked)]
    found = knockout.allocated(spark.createDataFrame(slots, SLOTS), spark.createDataFrame(entrants, ENTRANTS), fall_back).collect()
    assert {(r.cup, r.place): (r.team, r.how) for r in found} == plain_allocation(slots, entrants, fall_back)


MATCHES = "cup string, match long, team_a string, want_a string, ref_a long, team_b string, want_b string, ref_b long"


def plain_rounds(rows):
    """(cup, match) -> teams, winner, loser, verdict; the winner is the greater name."""
    own = {(r[0], r[1]): r for r in rows}
    out, lost = {}, set()
    for _ in range(len(rows) + 1):
        for key, (cup, _, ta, wa, ra, tb, wb, rb) in own.items():
            sides = []
            for team, want, ref in ((ta, wa, ra), (tb, wb, rb)):
                if team is None and ((cup, ref) not in own or (cup, ref) in lost):
                    lost.add(key)
                sides.append(team or (out.get((cup, ref)) or {}).get(want))
            if all(sides):
                out[key] = {"winner": max(sides), "loser": min(sides), "sides": sides}
    told = {}
    for key, (cup, _, ta, wa, ra, tb, wb, rb) in own.items():
        d = out.get(key, {})
        sides = [t or (out.get((cup, ref)) or {}).get(want) for t, want, ref in ((ta, wa, ra), (tb, wb, rb))]
        told[key] = (*sides, d.get("winner"), d.get("loser"), "decided" if d else "missing" if key in lost else "circular")
    return told


def test_matches_against_a_loop(spark):
    """References to earlier and later matches, chains of 20, matches that need themselves or what isn't there, null keys."""
    rng = random.Random(3)
    rows = [("chain", i, f"t{i:02}", None, None, None if i else "u", rng.choice(["winner", "loser"]), i - 1) for i in range(20)]
    for cup in [*(f"c{i}" for i in range(12)), None]:
        for m in range(1, 16):
            side = lambda m=m: (f"t{rng.randrange(90):02}", None, None) if m < 6 or rng.random() < 0.2 else (None, rng.choice(["winner", "loser"]), rng.choice([None, 99, m, *range(max(1, m - 6), 17)]) if rng.random() < 0.2 else rng.randrange(max(1, m - 6), m))
            rows.append((cup, m, *side(), *side()))
    frame = spark.createDataFrame(rows, MATCHES)
    found = {(r.cup, r.match): (r.team_a, r.team_b, r.winner, r.loser, r.verdict) for r in knockout.decided_matches(frame, F.greatest("team_a", "team_b")).collect()}
    assert found == plain_rounds(rows)
    assert {v[4] for v in found.values()} == {"decided", "missing", "circular"}
    assert found["chain", 19][4] == "decided"


def test_paths_of_a_small_cup(spark):
    entrants = [("x", t, "A", i, "first" if i < 5 else None) for i, t in enumerate("abcdef", 1)]
    decided = [("x", "Semifinal", "a", "b"), ("x", "Semifinal", "c", "d"), ("x", "Tercer lugar", "b", "d"), ("x", "Final", "a", "c")]
    frame = spark.createDataFrame(entrants, "cup string, team string, grp string, pos int, how string")
    rows = knockout.team_paths(frame, spark.createDataFrame(decided, "cup string, phase string, winner string, loser string")).collect()
    assert {r.team: (r.reached, r.out_by, r.played) for r in rows} == {
        "a": ("Campeón", None, 2), "c": ("Subcampeón", "a", 2), "b": ("Tercer lugar", "a", 2), "d": ("Cuarto lugar", "b", 2), "e": ("Fase de grupos", None, 0), "f": ("Fase de grupos", None, 0),
    }
    none = knockout.decided_matches(spark.createDataFrame([], MATCHES), F.col("team_a"))
    assert none.count() == 0
