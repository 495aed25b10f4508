"""Reports of offers: what each way to disagree is called, prices without a before, nulls and clashing names."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ledgerline.operators import report

D = [dt.date(2024, 1, k) for k in range(1, 10)]
_HISTORY = "offer_id string, valid_from date, valid_to date, price decimal(18,4), currency string, state_hash string, last_observed_at date, last_scrape_run_id string, own int"
_KEYS = "current_price decimal(18,4), currency string, first_observed_at date, last_observed_at date, last_scrape_run_id string, state_hash string"


def _tables(spark, current, history):
    carried = [c for c in report.COLUMNS if c not in report.PRICED and c not in ("offer_id", "current_price", "currency")]
    rows = spark.createDataFrame(current, f"offer_id string, {_KEYS}, before int")
    return rows.selectExpr("*", *(f"'{c}' as {c}" for c in carried)), spark.createDataFrame(history, _HISTORY)


def _period(offer, start, end, price, currency="L", state="s", seen=None, run="r", own=1):
    return (offer, start, end, price and Decimal(price), currency, state, seen or start, run, own)


def test_each_fault_has_its_name(spark):
    good = lambda o, price="8", **k: (o, Decimal(price) if price else None, k.get("currency", "L"), k.get("first", D[4]), k.get("last", D[4]), k.get("run", "r"), k.get("state", "s"), 1)
    chain = lambda o, was="10", now="8", **k: [_period(o, D[0], D[4], was), _period(o, D[4], None, now, **k)]
    current = [good(o) for o in ("fine", "alone", "open", "gap", "mixed", "closed", "backwards")] + [
        good("hash", state="t"), good("first", first=D[3]), good("last", last=D[5]), good("run", run="q"), good("price", "9"), good("coin", currency="M"), good("none", None),
        good("free"), good("new"), good("up", "12"), good("same", "10"), good(None),
    ]
    history = [p for o in ("fine", "hash", "first", "last", "run", "price", "coin", "gone") for p in chain(o)] + [
        *chain("none", now=None), *chain("free", was="0"), _period("new", D[4], None, "8"), *chain("up", now="12"), *chain("same", now="10"), _period("open", D[0], None, "10"), _period("open", D[4], None, "8"),
        _period("gap", D[0], D[3], "10"), _period("gap", D[4], None, "8"), _period("mixed", D[0], D[4], "10", currency=None), _period("mixed", D[4], None, "8"), _period("closed", D[4], D[5], "8"),
        _period("backwards", D[4], D[2], "9"), _period("backwards", D[4], None, "8"), _period(None, D[4], None, "8"),
    ]
    a, b = _tables(spark, current, history)
    faults = {(r.offer_id, r.faults) for r in report.reconciled(a, b).select("offer_id", "faults").collect()}
    assert faults == {
        *((o, "") for o in ("fine", "none", "free", "new", "up", "same")), ("alone", "no_history"), ("gone", "not_current"), ("open", "chain_broken,not_one_open_period_at_the_end"), ("gap", "chain_broken"),
        ("mixed", "currency_differs"), ("closed", "not_one_open_period_at_the_end"), ("backwards", "chain_broken"), ("hash", "state_differs"), ("first", "first_observation_differs"),
        ("last", "last_observation_differs"), ("run", "last_run_differs"), ("price", "price_differs"), ("coin", "currency_differs"), (None, "no_history"), (None, "not_current"),
    }
    out = report.offers(a, b)
    assert tuple(out.columns) == report.COLUMNS and len(out.columns) == 43
    rows = {r.offer_id: (r.price_direction, r.real_reduction_amount and float(r.real_reduction_amount), r.real_reduction_ratio, r.is_real_reduction) for r in out.collect()}
    assert rows == {"fine": ("down", 2.0, 0.2, True), "none": ("unknown", None, None, False), "free": ("up", 0, None, False), "new": ("no_baseline", None, None, False), "up": ("up", 0, 0.0, False), "same": ("same", 0, 0.0, False)}
    assert report.reconciled(a.limit(0), b.limit(0)).count() == 0
