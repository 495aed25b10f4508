"""Queries on a paged catalog: plans, traversals, set checks, nested values and cleaning.

`part` stands for the catalog: brands are its partitions, parts its products, suppliers in `lineitem` the owners.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, text, unicode
from ..operators import aggregates, coverage, joins, ledger, sets, windows
from ..sources.tables import as_text, read


def semi_anti_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with and without orders in each nation."""
    buyers = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.lit(1).alias("buys"))
    joined = read(spark, sf_dir, "customer").join(buyers, "c_custkey", "left")
    return joined.groupBy("c_nationkey").agg(F.count("buys").alias("with_orders"), F.count_if(F.col("buys").isNull()).alias("without_orders"))


def diff_two_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stages of a table, key by key: added, removed, changed, same."""
    part = read(spark, sf_dir, "part")
    before = part.filter("p_partkey % 5 <> 0").select("p_partkey", "p_type")
    after = part.filter("p_partkey % 7 <> 0").select("p_partkey", F.when(F.col("p_size") > 40, F.lower("p_type")).otherwise(F.col("p_type")).alias("p_type"))
    return joins.difference(before, after, ["p_partkey"], "p_type")


def compare_traversals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parts of each supplier in two traversals (even and odd orders), and whether the sets agree."""
    rows = read(spark, sf_dir, "lineitem")
    return sets.compare_sets(rows.filter("l_orderkey % 2 = 0"), rows.filter("l_orderkey % 2 = 1"), ["l_suppkey"], "l_partkey")


def owner_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with more than one supplier."""
    counted = sets.conflicts(read(spark, sf_dir, "lineitem"), ["l_partkey"], F.col("l_suppkey"))
    return counted.filter("n_contents > 1")


def overlap_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of windows of positions of a brand that overlap, and by how many positions."""
    start = F.col("p_partkey") * 3 % 1000
    spans = read(spark, sf_dir, "part").select(F.concat_ws(":", "p_brand", (F.col("p_partkey") / 400).cast("long")).alias("grp"), "p_partkey", start.alias("lo"), (start + F.col("p_size")).alias("hi"))
    return joins.overlapping(spans, "grp", "p_partkey", "lo", "hi", 50)


def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of ten parts to ask for in each brand."""
    counts = read(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return coverage.page_plan(counts, "p_brand", "n", 10)


def page_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, boundary probes and all requests of the plan, and whether they are within the limit of 500."""
    pages = page_plan(spark, sf_dir).groupBy("p_brand").agg(F.count("*").alias("pages"))
    total = pages.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(F.sum(F.greatest(F.col("pages") - 1, F.lit(0))), F.lit(0)).alias("probes"))
    return total.withColumn("requests", F.col("pages") + F.col("probes")).withColumn("within", F.col("requests") <= 500)


def page_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each page follows the one before, where each seventh page is missing and each eleventh comes early."""
    pages = page_plan(spark, sf_dir).filter("from_index % 70 <> 60")
    moved = pages.withColumn("from_index", F.when(F.col("from_index") % 110 == 100, F.col("from_index") - 2).otherwise(F.col("from_index")))
    return moved.withColumn("follows", windows.continuity(moved, ["p_brand"], ["page"], "from_index", "to_index")).select("p_brand", "page", "follows")


def traversal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a traversal (the lines of orders) has seen of each brand's parts."""
    part = read(spark, sf_dir, "part")
    totals = part.groupBy("p_brand").agg(F.count("*").alias("total"))
    # A part is seen often: its lines are counted before they meet the brands.
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    seen = lines.join(part.select("p_partkey", "p_brand"), "p_partkey").groupBy("p_brand").agg(F.sum("n").alias("n_seen"), F.count("*").alias("n_distinct"))
    return coverage.judged(seen, totals, "p_brand", "total")


def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of brands, types and sizes with quantities."""
    return coverage.flattened_tree(read(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


def filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of each dimension that a reader may filter by, over several tables."""
    found = None
    for table, column in (("part", "p_brand"), ("customer", "c_mktsegment"), ("orders", "o_orderpriority"), ("lineitem", "l_returnflag")):
        values = read(spark, sf_dir, table).select(F.lit(column).alias("dimension"), F.col(column).alias("value")).filter("trim(value) <> ''").distinct()
        found = values if found is None else found.unionByName(values)
    return found


def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and ratios of each supplier's lines, and the rules that they break."""
    rows = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.count_if(F.col("l_discount") > 0.09).alias("n_discounted"), F.count_distinct("l_partkey").alias("n_parts")
    )
    returned, discounted = aggregates.ratio(F.col("n_returned").cast("double"), F.col("n")), aggregates.ratio(F.col("n_discounted").cast("double"), F.col("n"))
    broken = aggregates.reasons(few_lines=F.col("n") < 5, many_returned=returned > 0.3, many_discounted=discounted > 0.12, few_parts=F.col("n_parts") * 10 < F.col("n") * 9)
    limit = F.least(F.lit(1.0), F.greatest(1.25 * returned, returned + 0.02))
    return rows.select("l_suppkey", "n", F.round(returned, 6).alias("returned"), F.round(limit, 6).alias("limit"), F.array_join(broken, ",").alias("reasons"))


def trace_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as children of orders: whether a line's ship date lies in the 60 days after the order."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ordered"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("shipped"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    verdict = F.when(F.col("ordered").isNull(), "orphan").when(F.col("shipped") < F.col("ordered"), "early").when(F.col("shipped") > F.date_add("ordered", 60), "late").otherwise("contained")
    return joined.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def request_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the request ledger about the events of each user, in order of time: 20 grants at most, 10 minutes
    apart; a request (the number in the properties) that was granted is replayed."""
    request = F.coalesce(F.get_json_object("props", "$.k").try_cast("long"), F.lit(-1))
    events = read(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), request.alias("request"))
    return ledger.decisions(events, "user_id", "at", "event_id", "request", 600_000_000, 20)


def unicode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the comparison forms of whole texts: composed and folded, and without marks."""
    x = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(unicode.canonical_text(x).cast("binary")).alias("canonical"), F.md5(unicode.without_all_marks(x).cast("binary")).alias("unmarked"))


def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", ids.canonical_url(F.col("url")).alias("canonical"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and one parameter of each address."""
    url = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", F.try_parse_url(url, F.lit("HOST")).alias("host"), F.try_parse_url(url, F.lit("PATH")).alias("path"), F.try_parse_url(url, F.lit("QUERY"), F.lit("page")).alias("page"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number in the JSON properties, summed for each type of event."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("n_k"), F.sum(k).alias("sum_k"))


def explode_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all turns by role and place in the turn (cut to tens), with how often they come."""
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), " "), lambda w: w != "")
    rows = read(spark, sf_dir, "conversations").select("role", F.posexplode(words).alias("place", "word"))
    return rows.groupBy("role", F.floor(F.col("place") / 10).alias("tens")).agg(F.count("*").alias("n_words"), F.sum(F.length("word").cast("long")).alias("n_chars"))


def turn_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each turn of a conversation follows the one before."""
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.count("*").alias("n"))
    return turns.withColumn("follows", windows.continuity(turns, ["conv_id"], ["turn"], "turn", "turn"))


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned forms of whole texts, as digests: slug, comparison key, without marks, escaped for HTML."""
    x = F.col("text")
    shown = lambda c: F.md5(c.cast("binary"))
    return read(spark, sf_dir, "documents").select("doc_id", shown(text.slug(x)).alias("slug"), shown(text.match_key(x)).alias("match_key"), shown(text.without_marks(text.clean(x))).alias("plain"), shown(text.escaped(text.clean(x))).alias("escaped"))


def numbers_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers out of texts with separators, and the texts that aren't numbers."""
    rows = read(spark, sf_dir, "customer").withColumn("shown", F.when(F.col("c_custkey") % 10 == 0, "n/a").otherwise(F.format_number(F.col("c_acctbal"), 2)))
    return rows.select("c_custkey", text.number(F.col("shown")).alias("number"), text.number_or_zero(F.col("shown")).alias("or_zero"))


def slot_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What texts of bracket slots ask for, and the phase that a text names."""
    slots = F.array(*map(F.lit, ("1A", "2 b", "3CEF", "W73", "l-101", "MEX", "", "Grupo C", "Ronda de 32", "Octavos", "Semifinal", "Third place", "Final")))
    rows = read(spark, sf_dir, "nation").select("n_nationkey", F.element_at(slots, F.col("n_nationkey") % 13 + 1).alias("slot"))
    return rows.select("n_nationkey", text.slot_kind(F.col("slot")).alias("kind"), text.phase(F.col("slot")).alias("phase"), text.phase_order(text.phase(F.col("slot"))).alias("phase_order"), text.valid_code(F.col("slot")).alias("valid"))


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as text without nulls, as a sink of text cells takes it."""
    return as_text(read(spark, sf_dir, "nation"))


QUERIES = {
    f.__name__: f
    for f in (
        semi_anti_checks, diff_two_sets, compare_traversals, owner_conflicts, overlap_windows, page_plan, page_budget, page_continuity, traversal_coverage, facet_counts, filter_values, quality_reasons,
        trace_reconcile, request_ledger, url_canonical, url_parts, json_props, explode_turns, turn_continuity, text_clean, numbers_clean, slot_kinds, text_rows, unicode_keys,
    )
}

_PLAN_SQL = """
counts AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
plan AS (SELECT p_brand, page, (page - 1) * 10 AS from_index, least(page * 10, n) - 1 AS to_index
         FROM (SELECT *, unnest(range(1, CAST(ceil(n / 10) AS BIGINT) + 1)) AS page FROM counts))"""
_MARKED, _PLAIN = "'" + text.MARKED + "'", "'" + text.PLAIN + "'"
_FOLLOWS_SQL = "CASE WHEN before IS NULL THEN 'first' WHEN {0} = before + 1 THEN 'next' WHEN {0} > before + 1 THEN 'gap' ELSE 'overlap' END AS follows"

#: unicode_keys has none, as SQL has no compatibility forms; a test holds it against the standard library.
ORACLE_SQL = {
    "request_ledger": """
WITH RECURSIVE r AS (
  SELECT user_id, event_id, epoch_us(ts) AS moment, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS request,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (
  SELECT user_id, 0::BIGINT AS n, NULL::BIGINT AS event_id, NULL::VARCHAR AS decision, NULL::BIGINT AS last, []::BIGINT[] AS granted FROM r WHERE n = 1
  UNION ALL
  SELECT user_id, n, event_id, decision, CASE WHEN decision = 'RESERVED' THEN moment ELSE last END, CASE WHEN decision = 'RESERVED' THEN list_append(granted, request) ELSE granted END
  FROM (SELECT r.user_id, r.n, r.event_id, r.moment, r.request, f.last, f.granted,
               CASE WHEN list_contains(f.granted, r.request) THEN 'REPLAY' WHEN len(f.granted) >= 20 THEN 'DENY' WHEN r.moment - f.last < 600000000 THEN 'WAIT' ELSE 'RESERVED' END AS decision
        FROM f JOIN r ON r.user_id = f.user_id AND r.n = f.n + 1))
SELECT user_id, event_id, decision FROM f WHERE n > 0""",
    "semi_anti_checks": """
SELECT c_nationkey, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) AS with_orders,
       count(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders)) AS without_orders FROM customer GROUP BY c_nationkey""",
    "diff_two_sets": """
WITH b AS (SELECT p_partkey, p_type FROM part WHERE p_partkey % 5 <> 0),
a AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN lower(p_type) ELSE p_type END AS p_type FROM part WHERE p_partkey % 7 <> 0)
SELECT coalesce(b.p_partkey, a.p_partkey) AS p_partkey, b.p_type AS before, a.p_type AS after,
       CASE WHEN b.p_partkey IS NULL THEN 'added' WHEN a.p_partkey IS NULL THEN 'removed' WHEN b.p_type IS DISTINCT FROM a.p_type THEN 'changed' ELSE 'same' END AS what
FROM b FULL JOIN a ON b.p_partkey = a.p_partkey""",
    "compare_traversals": """
WITH f AS (SELECT l_suppkey, l_partkey, bool_or(l_orderkey % 2 = 0) AS l, bool_or(l_orderkey % 2 = 1) AS r FROM lineitem GROUP BY ALL)
SELECT l_suppkey, count(*) FILTER (l) AS n_left, count(*) FILTER (r) AS n_right, count(*) FILTER (l AND r) AS n_shared,
       count(*) FILTER (l AND NOT r) AS only_left, count(*) FILTER (NOT l AND r) AS only_right, only_left = 0 AND only_right = 0 AS equal
FROM f GROUP BY l_suppkey""",
    "owner_conflicts": "SELECT l_partkey, count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_contents FROM lineitem GROUP BY l_partkey HAVING n_contents > 1",
    "overlap_windows": """
WITH s AS (SELECT p_brand || ':' || p_partkey // 400 AS grp, p_partkey, p_partkey * 3 % 1000 AS lo, p_partkey * 3 % 1000 + p_size AS hi FROM part)
SELECT a.grp, a.p_partkey AS first, b.p_partkey AS second, least(a.hi, b.hi) - greatest(a.lo, b.lo) + 1 AS shared
FROM s a JOIN s b ON a.grp = b.grp AND a.p_partkey < b.p_partkey AND a.lo <= b.hi AND b.lo <= a.hi""",
    "page_plan": f"WITH {_PLAN_SQL} SELECT * FROM plan",
    "page_budget": f"""
WITH {_PLAN_SQL}, p AS (SELECT p_brand, count(*) AS pages FROM plan GROUP BY p_brand)
SELECT CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(pages - 1) AS BIGINT) AS probes, CAST(sum(2 * pages - 1) AS BIGINT) AS requests, sum(2 * pages - 1) <= 500 AS within FROM p""",
    "page_continuity": f"""
WITH {_PLAN_SQL},
m AS (SELECT p_brand, page, CASE WHEN from_index % 110 = 100 THEN from_index - 2 ELSE from_index END AS from_index, to_index FROM plan WHERE from_index % 70 <> 60),
b AS (SELECT *, lag(to_index) OVER (PARTITION BY p_brand ORDER BY page) AS before FROM m)
SELECT p_brand, page, {_FOLLOWS_SQL.format("from_index")} FROM b""",
    "traversal_coverage": """
WITH t AS (SELECT p_brand, count(*) AS expected FROM part GROUP BY p_brand),
s AS (SELECT p_brand, count(*) AS n_seen, count(DISTINCT l_partkey) AS n_distinct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
SELECT p_brand, expected, coalesce(n_seen, 0) AS n_seen, coalesce(n_distinct, 0) AS n_distinct, coalesce(n_seen - n_distinct, 0) AS repeats,
       CASE WHEN coalesce(n_distinct, 0) = expected THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS verdict
FROM t LEFT JOIN s USING (p_brand)""",
    "facet_counts": """
SELECT p_brand AS path, 1 AS level, count(*) AS quantity, FALSE AS is_leaf FROM part GROUP BY p_brand
UNION ALL SELECT p_brand || '/' || p_type, 2, count(*), FALSE FROM part GROUP BY p_brand, p_type
UNION ALL SELECT p_brand || '/' || p_type || '/' || p_size, 3, count(*), TRUE FROM part GROUP BY p_brand, p_type, p_size""",
    "filter_values": """
SELECT DISTINCT 'p_brand' AS dimension, p_brand AS value FROM part UNION ALL SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM customer
UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders UNION ALL SELECT DISTINCT 'l_returnflag', l_returnflag FROM lineitem""",
    "quality_reasons": """
WITH m AS (
  SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') / count(*) AS returned, count(*) FILTER (l_discount > 0.09) / count(*) AS discounted,
         count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, n, round(returned, 6) AS returned, round(least(1.0, greatest(1.25 * returned, returned + 0.02)), 6) AS limit,
       concat_ws(',', CASE WHEN n < 5 THEN 'few_lines' END, CASE WHEN returned > 0.3 THEN 'many_returned' END,
                 CASE WHEN discounted > 0.12 THEN 'many_discounted' END, CASE WHEN n_parts * 10 < n * 9 THEN 'few_parts' END) AS reasons FROM m""",
    "trace_reconcile": """
SELECT CASE WHEN o_orderkey IS NULL THEN 'orphan' WHEN CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) THEN 'early'
            WHEN CAST(l_shipdate AS DATE) > CAST(o_orderdate AS DATE) + 60 THEN 'late' ELSE 'contained' END AS verdict, count(*) AS n
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "url_canonical": r"""
WITH b AS (SELECT page_id, regexp_replace(trim(url), '#.*$', '') AS bare FROM pages),
p AS (
  SELECT page_id, lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]+)', 1)) AS site,
         regexp_replace(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)', 1), '/+$', '') AS path,
         list_transform(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda x: x <> ''),
                        lambda x: {'k': url_decode(replace(split_part(x, '=', 1), '+', ' ')), 'v': url_decode(replace(regexp_extract(x, '^[^=]*=?(.*)$', 1), '+', ' '))}) AS pairs FROM b),
q AS (SELECT *, array_to_string(list_transform(list_filter(pairs, lambda x: NOT regexp_matches(lower(x.k), '^(utm_.*|gclid|fbclid|msclkid|mc_cid|mc_eid)$')),
             lambda x: replace(url_encode(x.k), '%20', '+') || '=' || replace(url_encode(x.v), '%20', '+')), '&') AS asked FROM p)
SELECT page_id, CASE WHEN regexp_matches(site, '^https?://') THEN site || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN asked = '' THEN '' ELSE '?' || asked END END AS canonical FROM q""",
    "url_parts": r"""
SELECT page_id, nullif(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '') AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
       nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages""",
    "json_props": """
WITH k AS (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type, count(*) AS n, count(k) AS n_k, CAST(sum(k) AS BIGINT) AS sum_k FROM k GROUP BY event_type""",
    "explode_turns": """
WITH w AS (SELECT role, list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> '') AS w FROM conversations),
p AS (SELECT role, unnest(w) AS word, unnest(range(len(w))) AS place FROM w)
SELECT role, place // 10 AS tens, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS n_chars FROM p GROUP BY ALL""",
    "turn_continuity": f"""
WITH t AS (SELECT conv_id, turn, count(*) AS n FROM conversations GROUP BY conv_id, turn),
b AS (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM t)
SELECT conv_id, turn, n, {_FOLLOWS_SQL.format("turn")} FROM b""",
    "text_clean": f"""
WITH d AS (SELECT doc_id, trim(coalesce(text, ''), ' ') AS t FROM documents),
p AS (SELECT doc_id, t, translate(t, {_MARKED}, {_PLAIN}) AS plain FROM d)
SELECT doc_id, md5(regexp_replace(regexp_replace(lower(plain), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')) AS slug,
       md5(regexp_replace(upper(replace(plain, 'ß', 'ss')), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS match_key, md5(plain) AS plain,
       md5(replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#039;')) AS escaped FROM p""",
    "numbers_clean": """
SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS number,
       CASE WHEN c_custkey % 10 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) ELSE 0.0 END AS or_zero FROM customer""",
    "slot_kinds": """
WITH s AS (SELECT * FROM (VALUES (0, 'first', '1A', 99, TRUE), (1, 'second', '2 b', 99, TRUE), (2, 'third', '3CEF', 99, TRUE), (3, 'winner', 'W73', 99, TRUE),
  (4, 'loser', 'l-101', 99, TRUE), (5, 'team', 'MEX', 99, TRUE), (6, 'team', '', 99, FALSE), (7, 'team', 'Fase de grupos', 1, TRUE), (8, 'team', 'Ronda de 32', 2, TRUE),
  (9, 'team', 'Octavos', 3, TRUE), (10, 'team', 'Semifinal', 5, TRUE), (11, 'team', 'Tercer lugar', 6, TRUE), (12, 'team', 'Final', 7, TRUE)) t(k, kind, phase, phase_order, valid))
SELECT n_nationkey, kind, phase, phase_order, valid FROM nation JOIN s ON n_nationkey % 13 = k""",
    "text_rows": "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation",
}
