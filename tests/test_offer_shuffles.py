"""Reports of offers: how often their rows are dealt over tasks."""

from __future__ import annotations

from ledgerline.operators.fixpoint import shares
from ledgerline.plans import reports


def test_lines_and_parts_are_dealt_by_offer_once(spark, sf_dir):
    for query in reports.QUERIES.values():
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3  # lines for both tables, by the same exchange, and parts
    done = reports.offer_report(spark, sf_dir)
    done.collect()
    assert "ReusedExchange" in done._jdf.queryExecution().executedPlan().toString()


def test_large_tables_get_more_tasks(spark):
    assert shares(spark.range(10)) == 4 and shares(spark.range(1 << 22)) == 8
