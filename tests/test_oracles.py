"""Every query with SQL against DuckDB on the same tables, and those without against a plain loop."""

from __future__ import annotations

import pytest

from ledgerline.plans.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(agrees, name):
    agrees(QUERIES[name], ORACLE_SQL[name])


def test_all_queries_have_sql_but_two():
    assert set(QUERIES) - set(ORACLE_SQL) == {"unicode_keys", "thirds_allocated"}


def test_thirds_are_allocated_in_order(spark, sf_dir):
    """Four slots get the four best thirds once each; a slot gets one that it allows where one is left when its turn comes."""
    best = QUERIES["standings"](spark, sf_dir).filter("pos = 3").collect()
    left = [(str(r.team), r.grp[0]) for r in sorted(best, key=lambda r: (-r.pts, -r.dg, -r.gf, r.team, r.grp))[:4]]
    expected = {}
    for slot, groups in (("S1", "13"), ("S2", "245"), ("S3", "1"), ("S4", "5")):
        fits = [t for t in left if t[1] in groups] or left
        if fits:
            expected[slot] = fits[0][0]
            left.remove(fits[0])
    assert {r.slot: r.team for r in QUERIES["thirds_allocated"](spark, sf_dir).collect()} == expected


def test_unicode_keys_against_the_standard_library(spark, sf_dir):
    import hashlib
    import unicodedata

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["unicode_keys"](spark, sf_dir).collect():
        text = texts[r.doc_id]
        if text is not None:
            folded = " ".join(unicodedata.normalize("NFKC", text).split()).casefold()
            plain = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
            assert (r.canonical, r.unmarked) == (folded and hashlib.md5(folded.encode()).hexdigest() or None, hashlib.md5(plain.encode()).hexdigest())


def test_bracket_against_a_loop(spark, sf_dir):
    teams = {r.team: (-(r.pts * 1000 + r.dg), i + 1) for i, r in enumerate(sorted(QUERIES["standings"](spark, sf_dir).selectExpr("concat(grp, ':', team) team", "grp", "team t", "pts", "dg", "gf").collect(), key=lambda r: (-r.pts, -r.dg, -r.gf, r.t, r.grp))[:32])}
    expected = set()
    for k in range(1, 6):
        left = sorted(teams, key=lambda t: teams[t][1])
        n, stay = len(left), {}
        for i in range(n // 2):
            a, b = left[i], left[n - 1 - i]
            winner = min((a, b), key=lambda t: teams[t])
            stay[winner] = teams[winner]
            expected |= {(k, i + 1, t, teams[t][1], t == winner) for t in (a, b)}
        teams = stay
    found = {tuple(r) for r in QUERIES["bracket"](spark, sf_dir).select("round", "match", "team", "seed", "won").collect()}
    assert found == expected


def test_request_ledger_against_a_loop(spark, sf_dir):
    import json

    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("user_id", "unix_micros(cast(ts as timestamp)) at", "event_id", "props").collect()
    expected, last, granted = {}, {}, {}
    for user, at, event, props in sorted(tuple(r) for r in rows):
        request, own = json.loads(props).get("k") if props else None, granted.setdefault(user, set())
        if request in own:
            expected[event] = "REPLAY"
        elif len(own) >= 20:
            expected[event] = "DENY"
        elif user in last and at - last[user] < 600_000_000:
            expected[event] = "WAIT"
        else:
            expected[event] = "RESERVED"
            last[user] = at
            own.add(request)
    assert {r.event_id: r.decision for r in QUERIES["request_ledger"](spark, sf_dir).collect()} == expected
    assert {"DENY", "RESERVED", "REPLAY"} <= set(expected.values())
