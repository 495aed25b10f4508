"""Queries on tables as sheets have them: aliases of columns, closed rows of text, appends, cells and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import ids, model, results, text
from ..operators import joins, knockout, windows
from ..sources import tables
from ..sources.tables import read


def aliased_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet with other names for its columns, read by aliases, and the first of several cells that isn't blank."""
    raw = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust Key."), F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_name")).alias("Full-Name"), F.col("c_mktsegment").alias("Segment"), F.format_number("c_acctbal", 2).alias("BALANCE"),
    )
    rows = tables.resolved(tables.clean_names(raw), {"id": ["id", "cust_key"], "name": ["name", "full_name"], "segment": ["segment"], "balance": ["amount", "balance"]}, ["id", "name"])
    return rows.select("id", text.first_filled(F.col("name"), F.col("segment")).alias("shown"), text.number_or_zero(F.col("balance")).alias("balance"))


_SPEC = tables.TableSpec("orders", StructType([StructField("o_orderkey", LongType()), StructField("line", LongType()), StructField("status", StringType())]), ("o_orderkey", "line"))


def closed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of text split at commas, short ones padded, blank and too wide ones refused, and the keys that break the rules."""
    o = F.col("o_orderkey")
    cell = F.concat_ws(",", (o - o % 2 * (o % 5 == 0).cast("int")).cast("string"), F.when(o % 7 != 0, (o % 3).cast("string")), F.when(o % 11 != 0, "o_orderstatus"), F.when(o % 13 == 0, F.lit("too,wide")))
    parts = read(spark, sf_dir, "orders").select(F.split(F.when(o % 17 == 0, F.lit("")).otherwise(cell), ",").alias("p"))
    typed = parts.select(F.get("p", F.lit(0)).try_cast("long").alias("o_orderkey"), F.get("p", F.lit(1)).try_cast("long").alias("line"), F.get("p", F.lit(2)).alias("status"), F.size("p").alias("n_cells"), (F.array_join("p", "") == "").alias("blank"))
    kept = typed.filter("not blank and n_cells <= 3").select(*_SPEC.schema.names)
    return tables.violations(kept, _SPEC).groupBy("reason").agg(F.count("*").alias("n_keys"), F.sum("n").alias("n_rows"))


def appended_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' rows one after the other, the later with a column more, and the missing cells of the earlier one."""
    nations = read(spark, sf_dir, "nation")
    first, second = nations.select("n_nationkey", "n_name", F.lit(1).alias("run")), nations.filter("n_nationkey % 2 = 0").select("n_nationkey", "n_regionkey", F.lit(2).alias("run"))
    return tables.appended(first, second)


def optional_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with a table of other names that may not be there: then they keep their own."""
    schema = StructType([StructField("n_name", StringType()), StructField("other", StringType())])
    other = tables.read_optional(spark, f"{sf_dir}/equivalences_that_are_not_there.parquet", schema)
    return read(spark, sf_dir, "nation").join(F.broadcast(other), "n_name", "left").select("n_nationkey", F.coalesce("other", "n_name").alias("name"))  # nations are few


def text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as text in one form: decimals without zeros at the end, times with six digits and a Z, flags in capitals."""
    e = read(spark, sf_dir, "events")
    return e.select(
        "event_id", ids.decimal_text(F.col("value").cast("decimal(18,4)")).alias("value"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
        F.upper((F.col("user_id") % 2 == 0).cast("string")).alias("even"), F.to_json(F.array("user_id", F.col("event_id") % 7)).alias("pair"),
    )


def sheet_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block as a sheet takes it: fixed columns in order, constants among them, text without nulls, rows by number."""
    rows = read(spark, sf_dir, "supplier").select(F.lit("v1").alias("version"), "s_suppkey", "s_name", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal").cast("decimal(18,2)")).alias("balance"), F.lit("").alias("note"))
    numbered = rows.withColumn("part", F.floor(F.col("s_suppkey") / 50)).withColumn("row", F.row_number().over(Window.partitionBy("part").orderBy("s_suppkey")))
    return tables.as_text(numbered)


def rated_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating of each supplier from three measures of which some are missing."""
    s = F.col("s_suppkey")
    score = model.rating_score(F.when(s % 3 != 0, F.col("s_acctbal")), F.when(s % 4 != 0, s * 2.0), F.when(s % 5 != 0, s.cast("double")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.round(score, 6).alias("rating"))


def thirds_allocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best thirds given to the slots that allow their groups, in order; a slot that none fits gets the best left."""
    from .contests import standings

    table = standings(spark, sf_dir).filter("pos = 3").orderBy(F.desc("pts"), F.desc("dg"), F.desc("gf"), "team", "grp").limit(4)
    seed = F.row_number().over(Window.orderBy(F.desc("pts"), F.desc("dg"), F.desc("gf"), "team", "grp"))  # four rows
    entrants = table.select(F.lit(1).alias("cup"), F.col("team").cast("string").alias("team"), F.substring("grp", 1, 1).alias("digit"), seed.alias("seed"))
    # Groups are letters in slots; here they are digits.
    entrants = entrants.select("cup", "team", F.translate("digit", "12345", "ABCDE").alias("grp"), F.lit("third").alias("how"), "seed")
    slots = spark.createDataFrame([(1, 1, "3AC"), (1, 2, "3BDE"), (1, 3, "3A"), (1, 4, "3E")], "cup int, place int, slot string")
    given = knockout.allocated(slots, entrants, thirds_fall_back=True).filter("team is not null")
    return given.select(F.concat(F.lit("S"), F.col("place").cast("string")).alias("slot"), "team")


def order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the half-year of their customer's segment that holds them: start <= day < end, the last one open."""
    k = read(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    spans = k.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("since", F.add_months(F.lit("1996-01-01").cast("date"), F.col("n") * 6))
    spans = spans.select("c_mktsegment", "n", "since", F.when(F.col("n") < 9, F.add_months("since", 6)).alias("until"))
    orders = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey").withColumn("day", F.to_date("o_orderdate"))
    return joins.in_interval(orders, spans, "c_mktsegment", "day", "since", "until").groupBy(F.col("p.c_mktsegment").alias("segment"), "n").agg(F.count("*").alias("n_orders"))


def repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that come again in their order's lines, and the list of each order's parts once each in their order."""
    lines = read(spark, sf_dir, "lineitem").withColumn("p", F.col("l_partkey") % 3)
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    marked = lines.withColumn("again", windows.later_repeats(lines, ["l_orderkey", "p"], order))
    place = F.array_sort(F.collect_list(F.when(~F.col("again"), F.struct(*order, "p"))))
    return marked.groupBy("l_orderkey").agg(F.count_if("again").alias("repeats"), F.array_join(F.transform(place, lambda x: x["p"]), ",").alias("once"))


def team_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cells of a column of teams are: names, slots, words that stand for a team, or blank; and short states."""
    k = F.col("o_orderkey")
    cell = F.get(F.array(*map(F.lit, ("Ghana", "1A", "Ganador 73", " ", "W-12", "por definir", "3CDF", "Togo"))), (k % 8).cast("int"))
    state = F.get(F.array(*map(F.lit, ("FINAL", "completado", "Live", "playing", "", "p", "Finalizado"))), (k % 7).cast("int"))
    kind = F.when(F.trim(cell) == "", "blank").when(results.known_team(cell), "team").when(text.slot_kind(cell) != "team", text.slot_kind(cell)).otherwise("placeholder")
    return read(spark, sf_dir, "orders").select(kind.alias("kind"), text.short_state(state).alias("state")).groupBy("kind", "state").agg(F.count("*").alias("n"))


def sanitized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings as JSON without the keys that may not be kept, at both levels, whatever their case."""
    e = F.col("event_id")
    inner = F.create_map(F.lit("Cookie"), F.lit("c"), F.lit("kind"), F.col("event_type"))
    outer = F.create_map(F.lit("Authorization"), F.lit("x"), F.lit("k"), (e % 9).cast("string"), F.when(e % 2 == 0, F.lit("token")).otherwise("tag"), F.lit("t"))
    fine = lambda k, v: ~F.lower(k).isin("authorization", "cookie", "token", "password", "set-cookie")
    rows = read(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.map_filter(outer, fine).alias("outer"), F.map_filter(inner, fine).alias("inner"))).alias("body"))
    return rows.groupBy(F.md5("body").alias("body")).agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's lines in the order of its rows: a table of cells between bars, escaped, with a mark for what is off."""
    n = read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"), F.sum(F.round(F.col("s_acctbal") * 100).cast("long")).alias("cents"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", F.col("s_nationkey").cast("string"), F.col("n").cast("string"), F.when(F.col("cents") < 0, F.lit("!")).otherwise("")), F.lit(" |"))
    return n.select("s_nationkey", line.alias("line"))


QUERIES = {
    f.__name__: f
    for f in (aliased_rows, closed_rows, appended_runs, optional_table, text_cells, sheet_block, rated_suppliers, thirds_allocated, order_periods, repeated_rows, team_kinds, sanitized, report_lines)
}

ORACLE_SQL = {
    "aliased_rows": "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_name END AS shown, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM customer",
    "closed_rows": """
WITH c AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE concat_ws(',', o_orderkey - o_orderkey % 2 * CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3 END,
             CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 13 = 0 THEN 'too,wide' END) END AS c FROM orders),
p AS (SELECT string_split(c, ',') AS p FROM c),
k AS (SELECT TRY_CAST(p[1] AS BIGINT) AS a, TRY_CAST(p[2] AS BIGINT) AS b FROM p WHERE array_to_string(p, '') <> '' AND len(p) <= 3),
g AS (SELECT a, b, count(*) AS n, CASE WHEN a IS NULL OR b IS NULL THEN 'null key' WHEN count(*) > 1 THEN 'repeated key' END AS reason FROM k GROUP BY a, b)
SELECT reason, count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows FROM g WHERE reason IS NOT NULL GROUP BY reason""",
    "appended_runs": "SELECT n_nationkey, n_name, 1 AS run, NULL::INTEGER AS n_regionkey FROM nation UNION ALL SELECT n_nationkey, NULL, 2, n_regionkey FROM nation WHERE n_nationkey % 2 = 0",
    "optional_table": "SELECT n_nationkey, n_name AS name FROM nation",
    "text_cells": """
SELECT event_id, regexp_replace(CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR), '\\.?0+$', '') AS value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at,
       CASE WHEN user_id % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS even, '[' || user_id || ',' || event_id % 7 || ']' AS pair FROM events""",
    "sheet_block": """
SELECT 'v1' AS version, CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, coalesce(CASE WHEN s_acctbal >= 0 THEN CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END, '') AS balance, '' AS note,
       CAST(s_suppkey // 50 AS VARCHAR) AS part, CAST(row_number() OVER (PARTITION BY s_suppkey // 50 ORDER BY s_suppkey) AS VARCHAR) AS row FROM supplier""",
    "rated_suppliers": """
SELECT s_suppkey, round(CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal ELSE 0 END + CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey * 2.0::DOUBLE ELSE 0 END
       + CASE WHEN s_suppkey % 5 <> 0 THEN greatest(0, 300 - s_suppkey) ELSE 0 END, 6) AS rating FROM supplier""",
    "order_periods": """
WITH d AS (SELECT c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON o_custkey = c_custkey),
n AS (SELECT segment, least(9, (year(day) - 1996) * 2 + (month(day) - 1) // 6) AS n FROM d WHERE day >= DATE '1996-01-01')
SELECT segment, n, count(*) AS n_orders FROM n GROUP BY ALL""",
    "repeated_rows": """
WITH m AS (SELECT *, l_partkey % 3 AS p, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 3 ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem)
SELECT l_orderkey, count(*) FILTER (n > 1) AS repeats, string_agg(p, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) FILTER (n = 1) AS once FROM m GROUP BY l_orderkey""",
    "team_kinds": """
SELECT (['team', 'first', 'placeholder', 'blank', 'winner', 'placeholder', 'third', 'team'])[o_orderkey % 8 + 1] AS kind,
       (['FINAL', 'FINAL', 'EN VIVO', 'EN VIVO', 'PENDIENTE', 'PENDIENTE', 'FINAL'])[o_orderkey % 7 + 1] AS state, count(*) AS n FROM orders GROUP BY ALL""",
    "sanitized": """
WITH b AS (SELECT event_id, '{"outer":{"k":"' || event_id % 9 || '"' || CASE WHEN event_id % 2 = 1 THEN ',"tag":"t"' ELSE '' END || '},"inner":{"kind":"' || event_type || '"}}' AS body FROM events)
SELECT md5(body) AS body, count(*) AS n, min(event_id) AS first FROM b GROUP BY 1""",
    "report_lines": """
WITH n AS (SELECT s_nationkey, count(*) AS n, sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS cents FROM supplier GROUP BY 1)
SELECT s_nationkey, '| ' || s_nationkey || ' | ' || n || ' | ' || CASE WHEN cents < 0 THEN '!' ELSE '' END || ' |' AS line FROM n""",
}
