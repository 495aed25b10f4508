"""Proofs of traversals against a loop over pages, and their edges."""

from __future__ import annotations

import math
import random

from ledgerline.operators import traversal

_PAGES = "leaf string, page long, first long, last long, total long, purpose string, products array<struct<key string, paths array<string>, skus array<string>>>, _metadata int, `a.b` int"


def _by_loop(leaves, pages, limit):
    found = {}
    for leaf, expected, path in leaves:
        own = sorted((p for p in pages if p[0] == leaf), key=lambda p: (p[2] is not None, p[2] or 0, p[3] is not None, p[3] or 0, p[1]))
        if expected == 0:
            reasons = {"empty_leaf_was_requested"} if own else set()
            found[leaf] = (0, 0, len(own), 0, sum(len(p[6]) for p in own), 0, 0, 0, 0, 0, 0, ",".join(reasons), not reasons)
            continue
        reasons, places, seen, planned, owners, sets = set(), {}, [], set(), {}, []
        done = conflicts = 0
        widths = []
        for _, _, first, last, total, purpose, products, *_ in own:
            if total != expected:
                reasons.add("partition_total_differs_from_discovery")
            if first is None or last is None or first < 0 or last < first:
                reasons.add("invalid_page_range")
                continue
            widths.append(last - first + 1)
            if last - first + 1 > limit:
                reasons.add("page_range_above_limit")
            if purpose == "PRIMARY":
                planned |= set(range(first, min(last, expected - 1) + 1))
            if len(products) == min(last - first + 1, max(expected - first, 0)):
                done += 1
            elif purpose == "RECOVERY":
                reasons.add("recovery_response_truncated")
            keys = set()
            for offset, (key, paths, skus) in enumerate(products):
                if key is None:
                    reasons.add("uninterpretable_product_identity")
                    continue
                if path not in (paths or []):
                    reasons.add("partition_membership_invalid")
                if first + offset > last or first + offset >= expected:
                    reasons.add("product_outside_requested_range")
                    continue
                if places.setdefault(first + offset, key) != key:
                    conflicts += 1
                    reasons.add("overlap_position_conflict")
                seen.append(key)
                keys.add(key)
                skus = skus or []
                if not skus:
                    reasons.add("uninterpretable_sku_identity")
                if len(set(skus)) < len(skus):
                    reasons.add("duplicate_sku_identity")
                for sku in skus:
                    owners.setdefault(sku, set()).add(key)
            if keys:
                sets.append(frozenset(keys))
        totals = [p[4] for p in own]
        changes = sum(a != b for a, b in zip(totals, totals[1:]))
        again = len(sets) - len(set(sets))
        checks = {
            "partition_not_attempted": not own, "repeated_page_set": again, "partition_total_changed": changes, "logical_positions_not_fully_covered": len(places) != expected,
            "primary_plan_does_not_cover_leaf": planned != set(range(expected)), "unique_products_differ_from_partition_total": len(set(seen)) != expected,
            "duplicate_compensates_omission": len(set(places.values())) != len(places), "duplicate_sku_identity": any(len(o) > 1 for o in owners.values()),
        }
        reasons |= {c for c, wrong in checks.items() if wrong}
        pairs = sum(map(len, owners.values()))
        expected_pages = math.ceil(expected / max(widths, default=limit))
        found[leaf] = (expected, expected_pages, len(own), done, len(seen), len(set(seen)), len(seen) - len(set(seen)), again, conflicts, changes, pairs, ",".join(sorted(reasons)), not reasons)
    return found


def test_proofs_against_a_loop(spark, monkeypatch):
    monkeypatch.setattr(traversal, "_BUCKET_PAGES", 1)  # so that a leaf's pages fall into several buckets
    rng = random.Random(11)
    leaves, pages = [("empty", 0, "/e/"), ("asked", 0, "/a/"), ("unseen", 3, "/u/")], [("asked", 0, 0, 3, 0, "PRIMARY", [("k", ["/a/"], ["s"])], 1, 1)]
    for k in range(60):
        leaf, n, path = f"l{k}", rng.randrange(1, 40), f"/p{k % 5}/"
        leaves.append((leaf, n, path))
        products = [(f"{leaf}-{i}", [path, "/all/"], [f"{leaf}-{i}-{j}" for j in range(1 + i % 2)]) for i in range(n)]
        own = [[leaf, i, i * 4, i * 4 + 3, n, "PRIMARY", products[i * 4 : i * 4 + 4], 1, 1] for i in range(math.ceil(n / 4))]
        for _ in range(k % 4):
            page, fault = rng.choice(own), rng.randrange(11)
            at = rng.randrange(len(page[6])) if page[6] else None
            if fault == 0:
                own = [p for p in own if p is not page] or own
            elif fault == 1:
                own.append([*page[:1], len(own) + 50, *page[2:5], "RECOVERY", page[6][: rng.choice([1, 4])], 1, 1])
            elif fault == 2:
                page[4] = rng.choice([n + 1, None])
            elif fault == 3:
                page[5] = "RECOVERY"
            elif fault == 4:
                page[2], page[3] = rng.choice([(-4, -1), (8, 7), (None, 3)])
            elif fault == 5:
                page[6] = [*page[6], (f"{leaf}-more", [path], ["m"])]
            elif fault == 6:
                own.append([leaf, len(own) + 50, max((page[2] or 0) - 1, 0), (page[2] or 0) + 9, n, "RECOVERY", page[6], 1, 1])
            elif at is not None:
                key, paths, skus = page[6][at]
                changed = {7: (None, paths, skus), 8: (key, rng.choice([None, ["/x/"]]), skus), 9: (key, paths, rng.choice([None, [], ["t", "t"], [f"{leaf}-0-0"]])), 10: (f"{leaf}-0", paths, skus)}
                page[6] = [changed[fault] if i == at else p for i, p in enumerate(page[6])]
        pages += [tuple(p) for p in own]
    planned = spark.createDataFrame([(*x, 7) for x in leaves], "leaf string, expected long, path string, extra int")
    rows = traversal.evaluated(planned, spark.createDataFrame(pages, _PAGES).repartition(3), 4).collect()
    assert {r.leaf: tuple(r)[1:] for r in rows} == _by_loop(leaves, pages, 4)
    reasons = {c for r in rows for c in r.reasons.split(",")}
    assert len(reasons) == 18 + 1 and sum(r.proved for r in rows) > 10  # each of them, and none


def test_edges_of_traversals(spark):
    leaves = spark.createDataFrame([("a", 2, "/a/"), ("b", None, "/b/")], "leaf string, expected long, path string")
    none = spark.createDataFrame([], _PAGES)
    rows = {r.leaf: r for r in traversal.evaluated(leaves, none).collect()}
    assert rows["a"].pages_attempted == 0 and "partition_not_attempted" in rows["a"].reasons and rows["b"].reasons == "leaf_size_invalid"
    stray = spark.createDataFrame([("z", 0, 0, 1, 2, "PRIMARY", None, 1, 1), (None, 0, 0, 1, 2, None, [], 1, 1)], _PAGES)
    assert {r.leaf: r.reasons for r in traversal.evaluated(leaves.limit(0), stray).collect()} == {"z": "leaf_not_planned", None: "leaf_not_planned"}
    huge = spark.createDataFrame([("a", 0, 0, 2**62, 2, "PRIMARY", [("k", ["/a/"], ["s"]), ("l", ["/a/"], ["t"])], 1, 1)], _PAGES)
    assert [r.reasons for r in traversal.evaluated(leaves.filter("leaf = 'a'"), huge).collect()] == ["page_range_above_limit"]
