"""How a traversal's positions and buckets of pages are dealt over tasks."""

from __future__ import annotations

from ledgerline.operators import traversal
from ledgerline.plans import proofs


def test_positions_and_buckets_are_dealt_by_size(spark, sf_dir, monkeypatch):
    expected = sorted(map(str, proofs.raw_traversal(spark, sf_dir).collect()))
    monkeypatch.setattr(traversal, "shares", lambda rows: 7)
    found = proofs.raw_traversal(spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 7), REPARTITION_BY_NUM") >= 2
    assert sorted(map(str, found.collect())) == expected
