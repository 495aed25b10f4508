"""Strict JSON against the standard library, and digests of rows against what must change them."""

from __future__ import annotations

import json
import math
import random
import re

from pyspark.sql import functions as F

from ledgerline.functions import strict_json
from ledgerline.operators import binding


def plain_verdict(body):
    """By the standard library's parser, with all pairs and constants seen."""
    if body is None:
        return "missing"
    if len(body.encode()) > strict_json.MOST_BYTES:
        return "too_long"
    seen = {"repeated": False, "endless": False, "large": False}

    def pairs(items):
        seen["repeated"] |= len({k for k, _ in items}) < len(items)
        return dict(items)

    def number(text):
        seen["endless"] |= math.isinf(float(text))
        seen["large"] |= re.fullmatch("-?[0-9]+", text) is not None and abs(int(text)) > strict_json.SAFE
        return 0

    def constant(_):
        seen["endless"] = True

    try:
        json.loads(body, object_pairs_hook=pairs, parse_constant=constant, parse_int=number, parse_float=number)
    except ValueError:
        return "malformed"
    return "repeated_key" if seen["repeated"] else "not_finite" if seen["endless"] else "unsafe_integer" if seen["large"] else "fine"


def random_json(rng, depth=0):
    kind = rng.random()
    if depth > 3 or kind < 0.35:
        return rng.choice(["1", "-0", "1.5e3", "1e999", "-1e400", "9007199254740991", "9007199254740992", "-9007199254740993", "12345678901234567890123", "NaN", "Infinity", "-Infinity", "true", "null", '""', '"\\"k\\":1"', '"a\\\\"', '"\\u0041"', '"{\\"x\\":NaN}"', '"é😀"', '"1e999"'])
    space = lambda: rng.choice(["", "", " ", "\n"])
    if kind < 0.7:
        keys = [rng.choice(['"a"', '"b"', '"k"', '"\\u0061"', '"c"', '"d"', '"e\\n"']) for _ in range(rng.randint(0, 4))]
        return "{" + ",".join(f"{space()}{k}{space()}:{space()}{random_json(rng, depth + 1)}" for k in keys) + space() + "}"
    return "[" + ",".join(space() + random_json(rng, depth + 1) for _ in range(rng.randint(0, 3))) + "]"


def test_verdicts_against_the_standard_library(spark):
    rng = random.Random(11)
    bodies = [random_json(rng) for _ in range(700)]
    for body in bodies[:250]:  # broken ones
        at = rng.randrange(len(body) + 1)
        bodies.append(body[:at] + rng.choice([",", "}", "]", '"', "\\", "'", "x", "1", "", "\x01", "-", ":", "tru"]) + body[at + rng.randint(0, 2) :])
    bodies += [None, "", " ", "1 2", "1,2", "{} {}", "[1]]", "[[1]", '{"a":1,}', "[01]", "[1.]", "[.5]", "[+1]", "[-]", "['a']", '{"a" 1}', '["\t"]', '["\\x"]', "[-NaN]", "nul", '{"NaN":NaN}', "[1][2]", "],["]
    bodies += ['{"a":{"k":1},"b":{"k":2}}', '{"a":{"k":1,"k":2}}', '{"s":"\\"k\\":1,\\"k\\":2"}', "[" + "1," * 20_000 + "1]", '["' + "\\n" * 20_000 + '"]', '"' + "x" * strict_json.MOST_BYTES + '"']
    frame = spark.createDataFrame(list(enumerate(bodies)), "i long, body string")
    found = {r.i: r.v for r in frame.select("i", strict_json.verdict(F.col("body")).alias("v")).collect()}
    wrong = [(b if b is None else b[:90], found[i], plain_verdict(b)) for i, b in enumerate(bodies) if found[i] != plain_verdict(b)]
    assert not wrong, wrong[:8]
    assert set(found.values()) == {"missing", "too_long", "malformed", "repeated_key", "not_finite", "unsafe_integer", "fine"}


def roots(df, fan=binding.FAN):
    return {r.run: (r.root, r.n_rows) for r in binding.merkle_roots(df, ["run"], ["a", "b"], fan).collect()}


def test_roots_bind_all_rows_in_any_order(spark):
    rng = random.Random(4)
    rows = [("x", i % 50, rng.choice([None, "", "p", "q"])) for i in range(300)] + [("y", 1, "p")] * 5 + [(None, 2, None)]
    schema = "run string, a long, b string"
    base = roots(spark.createDataFrame(rows, schema))
    shuffled = rng.sample(rows, len(rows))
    assert base == roots(spark.createDataFrame(shuffled, schema).repartition(9, "a")) and {k: n for k, (_, n) in base.items()} == {"x": 300, "y": 5, None: 1}
    for change in (lambda r: r[:-1], lambda r: [*r, r[0]], lambda r: [("x", r[0][1] + 1, r[0][2]), *r[1:]], lambda r: [("x", r[0][1], "null"), *r[1:]]):
        other = roots(spark.createDataFrame(change(rows), schema))
        assert {k for k in base if other.get(k) != base[k]} <= {"x", None} and other != base
    assert roots(spark.createDataFrame([("y", 1, "p")] * 4, schema))["y"] != base["y"]
    assert roots(spark.createDataFrame([], schema)) == {}


def test_records_are_compared_by_field(spark):
    schema = "k string, a long, b string"
    old = spark.createDataFrame([("same", 1, None), ("one", 1, "x"), ("both", 1, "x"), ("gone", 1, "x"), (None, 1, None)], schema)
    new = spark.createDataFrame([("same", 1, None), ("one", 1, None), ("both", 2, "y"), ("new", 1, "x"), (None, 1, "z")], schema)
    found = {r.k: (r.verdict, list(r.fields)) for r in binding.differing(old, new, ["k"], ["a", "b"]).collect()}
    assert found == {"same": ("same", []), "one": ("differs", ["b"]), "both": ("differs", ["a", "b"]), "gone": ("not_expected", []), "new": ("not_stored", []), None: ("differs", ["b"])}


def test_null_attributes_meet_their_like(spark):
    from ledgerline.operators import payload

    left = spark.createDataFrame([("x", None, 1), ("x", "p", 2), (None, None, 3), ("y", "q", 4), ("y", "q", 5)], "a string, b string, l long")
    right = spark.createDataFrame([("x", None, 10), (None, None, 30), (None, None, 31), ("y", "q", 40)], "a string, b string, r long")
    found = {r.l: (r.r, r.verdict) for r in payload.exactly_one(left, right, ["a", "b"], "l", "r").collect()}
    assert found == {1: (10, "MATCHED"), 2: (None, "NONE"), 3: (None, "AMBIGUOUS"), 4: (None, "AMBIGUOUS"), 5: (None, "AMBIGUOUS")}
