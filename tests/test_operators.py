"""Small cases of the operators, with nulls, ties and empty tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline.functions import ids, model, pricing, text
from ledgerline.operators import aggregates, coverage, joins, scd2, sets, tournament, windows
from ledgerline.sources import tables


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text_functions(spark):
    assert one(spark, text.slug(F.lit("  Árbol & Ñandú 3 "))) == "arbol-nandu-3"
    assert one(spark, text.match_key(F.lit("costa  rica"))) == "COSTA RICA"
    assert one(spark, text.number(F.lit("1,234.5"))) == 1234.5
    assert one(spark, text.number(F.lit("n/a"))) is None
    assert one(spark, text.number_or_zero(F.lit(None))) == 0.0
    assert one(spark, text.decimal_comma(F.lit("3,5"))) == 3.5
    assert one(spark, text.state(F.lit("FT"))) == "Jugado"
    assert one(spark, text.first_filled(F.lit(" "), F.lit(None), F.lit("a"))) == "a"
    assert one(spark, text.score_part(F.lit("2-1"), 1)) == 1
    assert one(spark, text.score_part(F.lit("x"), 0)) is None


def test_identities(spark):
    url = ids.canonical_url(F.lit("HTTP://Shop.example/a/b/?utm_source=x&id=3&gclid=9#top"))
    assert one(spark, url) == "http://shop.example/a/b?id=3"
    assert one(spark, ids.canonical_json(b=F.lit(1), a=F.lit(None).cast("string"))) == '{"a":null,"b":1}'
    assert len(one(spark, ids.stable_id("of_", k=F.lit(1)))) == 35
    assert one(spark, ids.decimal_text(F.lit("1.500").cast("decimal(9,3)"))) == "1.5"


def test_expectations(spark):
    grid = model.score_grid(F.lit(1.2), F.lit(0.8))
    assert one(spark, model.likeliest(grid)) == "1-0"
    total = sum(one(spark, model.grid_share(grid, f)) for f in (lambda a, b: a > b, lambda a, b: a == b, lambda a, b: a < b))
    assert total == pytest.approx(1)
    assert one(spark, model.recency_weight(F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date"))) == pytest.approx(0.5)
    assert one(spark, model.recency_weight(F.lit("2030-01-01").cast("date"), F.lit("2024-12-31").cast("date"))) == 1


def test_pricing(spark):
    price = lambda x: F.lit(x).cast("decimal(18,4)")
    assert [one(spark, pricing.direction(price(a), price(b))) for a, b in ((None, 2), (1, None), (1, 2), (2, 1), (1, 1))] == ["no_baseline", "unknown", "up", "down", "unchanged"]
    assert one(spark, pricing.reduction(price(1), price(2))) == 0
    fields = pricing.changed_fields({"price": (F.lit(1), F.lit(2)), "brand": (F.lit(None).cast("string"), F.lit("x"))})
    assert one(spark, fields) == ["price", "brand"]
    assert one(spark, pricing.change_kind(fields, F.lit(False))) == "MULTIPLE"


def test_asof_takes_the_latest_at_or_before(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9), (4, None, 3)], "id long, k string, t long")
    right = spark.createDataFrame([(10, "a", 2), (11, "a", 5), (12, "a", 5), (13, "a", 6), (14, None, 1)], "id long, k string, t long")
    found = joins.asof(left, right, "k", "t", "t", "id", "id")
    assert values(found, "id", "r_id") == [(1, 12), (2, None), (3, None), (4, 14)]
    assert joins.asof(left, right.limit(0), "k", "t", "t", "id", "id").filter("r_id is not null").count() == 0


def test_overlaps_come_once(spark):
    spans = spark.createDataFrame([("g", 1, 0, 99), ("g", 2, 90, 205), ("g", 3, 206, 210), ("h", 4, 0, 10)], "grp string, n long, lo long, hi long")
    assert values(joins.overlapping(spans, "grp", "n", "lo", "hi", 50), "first", "second", "shared") == [(1, 2, 10)]


def test_interval_and_difference(spark):
    points = spark.createDataFrame([("a", 5), ("a", 10)], "k string, t long")
    spans = spark.createDataFrame([("a", 0, 10, "x"), ("a", 10, None, "y")], "k string, s long, e long, v string")
    assert values(joins.in_interval(points, spans, "k", "t", "s", "e"), "t", "v") == [(10, "y"), (5, "x")]
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string")
    after = spark.createDataFrame([(2, None), (3, "d"), (4, "e")], "k long, v string")
    assert values(joins.difference(before, after, ["k"], "v"), "k", "what") == [(1, "removed"), (2, "same"), (3, "changed"), (4, "added")]


def test_periods_drop_equal_states(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    log = spark.createDataFrame([("k", day(1), "a", 1), ("k", day(2), "a", 2), ("k", day(3), "b", 3), ("k", day(4), None, 4), ("k", day(5), None, 5)], "k string, t timestamp, s string, i long")
    spans = scd2.periods(log, "k", "t", "s", "i")
    assert [(r.s, r.valid_from.day, r.valid_to and r.valid_to.day) for r in spans.orderBy("valid_from").collect()] == [("a", 1, 3), ("b", 3, 4), (None, 4, None)]
    assert values(scd2.contiguity(spans, "k"), "n_periods", "n_open", "n_broken") == [(3, 1, 0)]


def test_apply_run_cases(spark):
    current = spark.createDataFrame([("same", "a", 5), ("late", "a", 5), ("tie", "a", 5), ("new", "a", 5), ("gone", "a", 5)], "k string, s string, t long")
    seen = spark.createDataFrame([("same", "a", 5), ("late", "a", 4), ("tie", "b", 5), ("new", "b", 6), ("first", "b", 1)], "k string, s string, t long")
    actions = dict(values(scd2.apply_run(current, seen, "k", "s", "t"), "k", "action"))
    assert actions == {"same": "confirmed", "late": "stale", "tie": "stale", "new": "changed", "gone": "untouched", "first": "created"}


def test_upsert_actions(spark):
    stored = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string")
    batch = spark.createDataFrame([(2, None), (3, "d"), (4, "e")], "k long, v string")
    assert values(scd2.upsert(stored, batch, ["k"]), "k", "v", "action") == [(1, "a", "kept"), (2, None, "replayed"), (3, "d", "updated"), (4, "e", "created")]
    assert (3, "c", "conflict") in values(scd2.upsert(stored, batch, ["k"], immutable=True), "k", "v", "action")


def test_sets(spark):
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", None, "c")], "k string, n long, v string")
    assert values(sets.keep_best(rows, ["k"], [F.col("n")]), "k", "v") == [("j", "c"), ("k", "a")]
    left, right = (spark.createDataFrame(x, "g string, k long") for x in ([("g", 1), ("g", 1), ("g", 2)], [("g", 2), ("h", 3)]))
    assert values(sets.compare_sets(left, right, ["g"], "k"), "g", "n_shared", "only_left", "only_right", "equal") == [("g", 1, 1, 0, False), ("h", 0, 0, 1, False)]
    key = lambda a, ga, b, gb: one(spark, sets.unordered_key(F.lit("d"), F.lit(a), F.lit(ga), F.lit(b), F.lit(gb)))
    assert key("A", 1, "B", 2) == key("B", 2, "A", 1)


def test_standings_and_rounds(spark):
    matches = spark.createDataFrame([("g", "a", "b", 2, 0), ("g", "b", "c", 1, 1), ("g", "c", "a", 0, 3)], "grp string, a string, b string, x long, y long")
    table = aggregates.standings(aggregates.sides(matches, "a", "b", "x", "y", ["grp"]), "grp")
    assert values(table, "team", "pts", "dg", "pos") == [("a", 6, 5, 1), ("b", 1, -2, 2), ("c", 1, -3, 3)]
    teams = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 5.0), ("c", 3, 5.0), ("d", 4, 2.0)], "team string, seed long, strength double")
    assert values(tournament.play_round(teams).filter("won"), "team") == [("b",), ("d",)]


def test_scaled_and_means(spark):
    rows = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None)], "k long, v double")
    assert values(aggregates.scaled(rows, "v", "s", 50.0, 100.0), "k", "s") == [(1, 50.0), (2, 100.0), (3, None)]
    assert rows.agg(aggregates.weighted_mean(F.col("v"), F.lit(0.0)).alias("m")).first().m is None


def test_coverage(spark):
    counts = spark.createDataFrame([("a", 25), ("b", 0)], "p string, n long")
    assert values(coverage.page_plan(counts, "p", "n", 10), "page", "from_index", "to_index") == [(1, 0, 9), (2, 10, 19), (3, 20, 24)]
    seen = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "p string, k long")
    totals = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "p string, total long")
    assert values(coverage.traversal_coverage(seen, "p", "k", totals, "total"), "p", "repeats", "verdict") == [("a", 1, "COMPLETE"), ("b", 0, "EMPTY_COMPLETE"), ("c", 0, "INCOMPLETE")]
    tree = spark.createDataFrame([("x", "y"), ("x", "z"), ("w", "y")], "a string, b string")
    assert values(coverage.flattened_tree(tree, ["a", "b"]), "path", "level", "quantity", "is_leaf") == [("w", 1, 1, False), ("w/y", 2, 1, True), ("x", 1, 2, False), ("x/y", 2, 1, True), ("x/z", 2, 1, True)]


def test_windows(spark):
    pages = spark.createDataFrame([("p", 1, 0, 9), ("p", 2, 10, 19), ("p", 3, 19, 28), ("p", 4, 40, 49)], "p string, n long, lo long, hi long")
    found = pages.withColumn("f", windows.continuity(pages, ["p"], ["n"], "lo", "hi"))
    assert values(found, "n", "f") == [(1, "first"), (2, "next"), (3, "overlap"), (4, "gap")]
    assert values(pages.withColumn("r", windows.later_repeats(pages, ["p"], ["n"])), "n", "r") == [(1, False), (2, True), (3, True), (4, True)]


def test_tables(spark, tmp_path):
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    path = str(tmp_path / "t")
    assert tables.read_optional(spark, path, schema).count() == 0
    tables.append(spark.createDataFrame([], schema), path)
    assert tables.read_optional(spark, path, schema).count() == 0
    tables.append(spark.createDataFrame([(1, "a")], schema), path)
    tables.append(spark.createDataFrame([(1, "b"), (None, "c")], schema), path)
    spec = tables.TableSpec("t", schema, ("k",))
    assert values(tables.violations(tables.read_optional(spark, path, schema), spec), "k", "reason") == [(1, "repeated key"), (None, "null key")]
    wide = tables.appended(spark.createDataFrame([(1, "a")], schema), spark.createDataFrame([(2, 5)], "k long, w long"))
    assert wide.columns == ["k", "v", "w"] and values(wide, "k", "w") == [(1, None), (2, 5)]
    assert tables.clean_names(wide.toDF(" Aa b", "c-d", "e.f")).columns == ["aa_b", "c_d", "ef"]
    with pytest.raises(ValueError, match="id"):
        tables.resolved(wide, {"id": ["x", "y"]}, ["id"])
    assert values(tables.as_text(wide), "k", "v", "w") == [("1", "a", ""), ("2", "", "5")]
