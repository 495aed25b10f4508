"""Windows of scans against a loop; a plan that misses events says so."""

from __future__ import annotations

import datetime as dt
import random

from ledgerline.operators import scans


def test_windows_against_a_loop(spark):
    rng = random.Random(5)
    times = [dt.datetime(2024, 1, 1 + rng.randrange(3), rng.randrange(3), rng.randrange(60), rng.randrange(60)) for _ in range(300)] + [dt.datetime(2024, 1, 2, 5, 5)] * 30
    counts = {}
    for t in times:
        key = (t.date(), t.hour * 60 + t.minute)
        counts[key] = counts.get(key, 0) + 1
    expected = []
    for (day, minute), n in sorted(counts.items()):
        last = expected[-1] if expected else None
        if last and last[0] == day and minute - last[1] < 15 and last[3] + n <= 10:
            last[2], last[3] = minute, last[3] + n
        else:
            expected.append([day, minute, minute, n])
    events = spark.createDataFrame([(t,) for t in times] + [(None,)], "ts timestamp")
    windows = scans.scan_windows(events, "ts", 15, 10)
    assert sorted(tuple(r) for r in windows.collect()) == [(*w, w[3] > 10) for w in expected]
    rows = scans.scanned(events, "ts", windows).collect()
    assert [(r.day, r.found) for r in rows if r.rows != r.found] == [(None, 1)]  # the event without a time
    lost = scans.scanned(events, "ts", windows.filter("start != 305")).filter("day is null").collect()
    assert sum(r.found for r in lost) == 31 + sum(w[3] for w in expected if w[1] == 305 and w[3] != 30)
    assert scans.scan_windows(events.limit(0), "ts").count() == 0
