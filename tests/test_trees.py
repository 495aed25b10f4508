"""Trees of categories on odd rows, and what fingerprints depend on."""

from __future__ import annotations

import json

from ledgerline.operators import trees


def node(level, value, quantity, *children):
    return {"key": f"category-{level}", "value": value, "quantity": quantity, "children": list(children)}


def told(spark, bodies):
    frame = spark.createDataFrame([(k, b if b is None or isinstance(b, str) else json.dumps(b)) for k, b in bodies], "tree string, body string")
    nodes = trees.tree_nodes(frame)
    return {r.tree: r for r in trees.tree_report(frame, nodes).collect()}, {(r.tree, tuple(r.place)): r for r in nodes.collect()}


def test_faults_are_named_and_order_of_siblings_does_not_matter(spark):
    a, b = node(2, "a", 3), node(2, "b", 4, node(3, "c", 1))
    deep = node(12, "x", 1)
    for level in range(11, 0, -1):
        deep = node(level, "x", 1, deep)
    bodies = [
        ("one", [node(1, "r", 9, a, b)]), ("two", [node(1, "r", 9, b, a)]), ("same", [node(1, "r", 9, a), node(1, "r", 9, a)]), ("clash", [node(1, "r", 9, a), node(1, "r", 9, b)]),
        ("large", [node(1, "r", 2, a)]), ("level", [node(2, "r", 9)]), ("barren", [node(1, "r", 9, 5)]), ("deep", [deep]), ("empty", []), ("text", "no json"), ("object", {"a": 1}),
        ("bool", [dict(node(1, "r", 1), quantity=True)]), ("lost", [{"key": "category-1", "value": "r", "quantity": 1}]), (None, [a]), ("none", None), ("named", [node(1, " ", 0)]),
    ]
    report, nodes = told(spark, bodies)
    assert {k: list(r.faults) for k, r in report.items() if not r.complete} == {
        "clash": ["duplicate_structural_node_conflict"], "large": ["child_quantity_exceeds_parent"], "level": ["contradictory_topology"],
        "barren": ["node_not_object", "positive_branch_without_valid_children"], "deep": ["category_level_above_limit"], "text": ["facets_not_sequence"], "object": ["facets_not_sequence"],
        "bool": ["quantity_not_integer"], "lost": ["children_missing"], None: ["contradictory_topology"], "none": ["facets_not_sequence"], "named": ["invalid_node_identity"],
    }
    assert nodes["one", (0,)].fingerprint == nodes["two", (0,)].fingerprint != nodes["same", (0,)].fingerprint == nodes["same", (1,)].fingerprint
    assert (report["same"].duplicates, report["same"].leaves, report["one"].leaves, report["one"].leaf_quantity, report["deep"].nodes_seen) == (2, 1, 2, 4, 12)
    assert told(spark, [])[0] == {}


def test_trees_of_one_partition_are_dealt_over_all(spark):
    rows = [(k, json.dumps([node(1, "r", 9, node(2, "a", 3))])) for k in range(64)]
    nodes = trees.tree_nodes(spark.createDataFrame(rows, "tree long, body string").coalesce(1))
    assert nodes.count() == 128 and len(nodes.inputFiles()) >= 2 * 3
