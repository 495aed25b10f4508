"""Evidence on locations rule by rule, proposals that don't enable anything, and rows of other markets."""

from __future__ import annotations

import hashlib
import json

import pytest

from ledgerline.operators import locations
from ledgerline.plans.registry import QUERIES

KEY = "vtex:region:sha256:" + "a" * 64
GOOD = {
    "mode": "live", "stop_reason": None, "target_host": "h", "target_city": "c", "production_authority": False, "catalog_accepted": False, "extraction_enabled": False, "selected_store": "s 1", "store_selection_observed": True,
    "binding_report": {"raw_values_exposed": False, "granularity_candidate": "city", "confidence": "strong", "technical_binding_observed": True, "source_location_key_candidate": KEY},
}
STORE = {"granularity_candidate": "store"}
UNKNOWN = {"granularity_candidate": "unknown", "confidence": "weak", "technical_binding_observed": False, "source_location_key_candidate": None}
CASES = [
    ({}, {}, "city_binding_ready"), ({}, STORE, "store_binding_discovery_required"), ({}, UNKNOWN, "inconclusive"), ({"mode": 1}, {}, "live_evidence_required"), ({"stop_reason": ""}, {}, "successful_capture_required"),
    ({"target_host": None}, {}, "unexpected_target_host"), ({"target_city": "C"}, {}, "unexpected_target_city"), ({"production_authority": None}, {}, "production_authority_must_be_false"),
    ({"catalog_accepted": 0}, {}, "catalog_accepted_must_be_false"), ({"extraction_enabled": "false"}, {}, "extraction_enabled_must_be_false"), ({"binding_report": None}, None, "binding_report_required"),
    ({}, {"raw_values_exposed": True}, "sanitized_binding_report_required"), ({}, {"granularity_candidate": ["city"]}, "granularity_candidate_invalid"), ({}, {"granularity_candidate": "online"}, "granularity_candidate_unsupported"),
    ({}, {"confidence": "Strong"}, "binding_confidence_invalid"), ({}, {"technical_binding_observed": "true"}, "technical_binding_observed_invalid"), ({}, {"source_location_key_candidate": KEY + "\n"}, "source_location_key_candidate_invalid"),
    ({}, {"source_location_key_candidate": 5}, "source_location_key_candidate_invalid"), ({"selected_store": ""}, {}, "text_field_invalid"), ({"selected_store": "a "}, {}, "text_field_invalid"), ({"selected_store": "a\n"}, {}, "text_field_invalid"),
    ({"selected_store": 3}, {}, "text_field_invalid"), ({"store_selection_observed": None}, {}, "store_selection_observed_invalid"), ({}, {**STORE, "confidence": "weak"}, "strong_store_binding_required"),
    ({"selected_store": None}, STORE, "selected_store_evidence_required"), ({"store_selection_observed": False}, STORE, "selected_store_evidence_required"), ({"selected_store": None}, {}, "city_binding_ready"),
    ({}, {"source_location_key_candidate": None}, "strong_city_binding_required"), ({}, {**UNKNOWN, "confidence": "strong"}, "unknown_binding_must_remain_non_authoritative"), ({"selected_store": "x"}, UNKNOWN, "inconclusive"),
]


def test_each_rule(spark):
    bodies = [{**GOOD, **outer, **({} if inner is None else {"binding_report": {**GOOD["binding_report"], **inner}})} for outer, inner, _ in CASES]
    rows = [(i, json.dumps(b, indent=1), 0) for i, b in enumerate(bodies)] + [(100, None, 0), (101, "[]", 0), (102, '"x"', 0), (103, "{", 0), (None, json.dumps(bodies[0]), 0), (None, json.dumps(bodies[0]), 0)]
    out = locations.transitions(spark.createDataFrame(rows, "location_id long, body string, v int"), "h", "c").collect()
    by_id = {r.location_id: r for r in out}
    for i, (_, _, expected) in enumerate(CASES):
        r = by_id[i]
        assert (r.reason or r.status) == expected, (i, r)
        assert (r.status == "rejected") == (r.granularity is None) and r.artifact_sha256 == hashlib.sha256(json.dumps(bodies[i], sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert all(by_id[i].reason == "artifact_mapping_required" and by_id[i].evidence_ref is None for i in range(100, 104))
    assert len(out) == len(rows)
    assert locations.transitions(spark.createDataFrame([], "location_id long, body string"), "h", "c").count() == 0


def test_proposals_and_blocks(spark):
    found = spark.createDataFrame([(1, "city_binding_ready", "k", "b"), (1, "city_binding_ready", "k", "a"), (2, "city_binding_ready", "k", "c"), (2, "city_binding_ready", "l", "d"), (3, "city_binding_ready", "k", "e"), (4, "rejected", None, "f")], "location_id long, status string, source_location_key string, evidence_ref string")
    rows = [(n, n, "unknown", False, "old", "was", n == 3, 9) for n in (1, 2, 3, 4)] + [(5, 1, "city", True, None, None, None, 9), (None, None, None, None, None, None, None, 9)]
    places = spark.createDataFrame(rows, "location_id long, market_id long, granularity string, technical_binding_confirmed boolean, source_location_key string, evidence string, extraction_enabled boolean, `a.b` int")
    out = locations.proposed(places, found)
    assert out.columns == [*places.columns, "proposal"]
    got = {r.location_id: (r.granularity, r.technical_binding_confirmed, r.source_location_key, r.evidence, r.extraction_enabled, r.proposal) for r in out.collect()}
    kept = ("unknown", False, "old", "was")
    assert got == {1: ("city", True, "k", "a", False, "proposed"), 2: (*kept, False, "conflict"), 3: (*kept, True, "enabled"), 4: (*kept, False, "none"), 5: ("city", True, None, None, None, "none"), None: (None,) * 5 + ("none",)}
    markets = spark.createDataFrame([(1, True, "source_selection_required"), (2, False, "x"), (3, True, "fixed_single_city")], "market_id long, is_active boolean, selection_mode string")
    flags = [(1, 1, True, True, "city", True, True, ""), (2, 1, True, True, "city", False, True, "technical_location_binding_unconfirmed"), (3, 3, True, True, "city", None, True, ""), (4, 3, True, True, None, True, True, "location_granularity_unconfirmed"),
             (5, 3, None, True, "city", True, True, "location_unavailable"), (6, 3, True, False, "city", True, True, "location_out_of_scope"), (7, 2, True, True, "city", True, True, "supermarket_inactive"), (8, None, True, True, "city", True, True, "supermarket_inactive"), (9, 3, True, True, "store", True, None, "extraction_disabled")]
    sites = spark.createDataFrame(flags, "location_id long, market_id long, is_available boolean, in_scope boolean, granularity string, technical_binding_confirmed boolean, extraction_enabled boolean, wanted string")
    assert all(r.block == r.wanted for r in locations.blocked(sites, markets).collect())
    runs = spark.createDataFrame([(1, 1, ""), (1, 3, "other_market"), (99, 1, "unknown_location"), (None, 1, "unknown_location"), (1, None, "unknown_market"), (8, 3, "other_market"), (8, None, "unknown_market")], "location_id long, market_id long, wanted string")
    assert all(r.fault == r.wanted for r in locations.placed(runs, sites, markets).collect())


@pytest.mark.parametrize(("query", "column", "n"), [("location_transitions", "reason", 22), ("location_proposals", "block", 7), ("location_proposals", "proposal", 3), ("run_locations", "fault", 4)])
def test_queries_meet_every_case(spark, query, column, n):
    assert QUERIES[query](spark, "/root/testdata/sf0.01").select(column).distinct().count() == n
