"""Queries on evidence: strict bodies of JSON, and records of runs bound to their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import strict_json
from ..operators import binding, scans, trees
from ..operators.fixpoint import shared_path, spread
from ..sources import store
from ..sources.tables import TableSpec, read


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's properties within a larger body; what is wrong with it follows from the event's number and type."""
    e = F.col("event_id")
    own = F.coalesce("props", F.lit("{}"))
    said = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    number = e.cast("string")
    shapes: list[Column] = [
        said('{"a":', own, ',"b":', own, ',"type":"', F.col("event_type"), '"}'),  # equal keys of siblings
        said('{"k":"\\"k\\":1,\\"k\\":2", "n":', number, "}"),  # keys within a string
        said('{"outer":{"k":', number, ',"x":[{"k":1},{"k":2}],"\\u006b":3}}'),  # a repeated key, once escaped
        said('{"price":', number, "e", (e % 400).cast("string"), "}"),  # beyond a double from 1e309 on
        said('{"total":90071992547409', (e % 100).cast("string"), "}"),  # beyond 2^53 - 1 at times
        said('{"rows":[', number, ",", number, "]", F.when(e % 2 == 0, "}").otherwise("")),  # not closed
        said('{"v":', F.when(e % 2 == 0, "NaN").otherwise("-Infinity"), ',"w":"NaN, Infinity"}'),
        said('{"w":"NaN, -Infinity","v":', number, "}"),
    ]
    body = own
    for k, shape in enumerate(shapes):
        body = F.when(e % 9 == k, shape).otherwise(body)
    return read(spark, sf_dir, "events").select("event_id", "event_type", body.alias("body"))


def strict_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a strict reader says to each body, and how many numbers it has."""
    body = F.col("body")
    return _bodies(spark, sf_dir).select("event_id", strict_json.verdict(body).alias("verdict"), F.size(strict_json.numbers(body)).alias("n_numbers"))


_FIELDS = ["event_id", "user_id", "event_type", "ts", "props"]


def _records(rows: DataFrame) -> DataFrame:
    """The record of each day's run: eleven fields, of which evidence binds the others to all rows."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("run")
    dated = rows.select(day, "event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "props")
    of = lambda kind: F.count_if(F.col("event_type") == kind)
    counts = dated.groupBy("run").agg(
        F.count("*").alias("observed"), F.count_distinct("user_id").alias("users"), of("click").alias("clicks"), of("view").alias("views"), of("purchase").alias("purchases"),
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
    )
    joined = counts.join(binding.merkle_roots(dated, ["run"], _FIELDS), "run")
    header = {c: F.col(c) for c in ("run", "observed", "users", "started_at", "finished_at")}
    return joined.select(*counts.columns, "root", binding.evidence_id("ev_", F.col("root"), **header).alias("evidence"))


_RECORD = ["observed", "users", "clicks", "views", "purchases", "started_at", "finished_at", "first_id", "last_id", "root", "evidence"]


def run_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of each day: counts, the root of all its rows and the evidence that binds both."""
    return _records(read(spark, sf_dir, "events")).select("run", *_RECORD)


def reconciled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored records against those of rows that changed since: on some days a cell, on some the order only, on some rows are gone."""
    rows = read(spark, sf_dir, "events")
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01"))
    lowest = F.min("event_id").over(Window.partitionBy(F.to_date("ts"), "event_type"))
    changed = rows.withColumn("_first", (F.col("event_id") == lowest) & (F.col("event_type") == "view")).withColumn("user_id", F.when(F.col("_first") & (day % 3 == 0), F.col("user_id") + 1000000).otherwise(F.col("user_id")))
    changed = changed.filter(~((day % 5 == 1) & (F.col("event_type") == "purchase"))).drop("_first").repartition(7, "user_id")
    return binding.differing(_records(rows), _records(changed), ["run"], _RECORD).select("run", "verdict", F.array_join("fields", ",").alias("fields"))


def _deep_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree for each part, up to eleven levels deep, of which most have a fault somewhere: tree, body."""
    k, n = F.col("p_partkey"), F.col("p_partkey") % 11 + 1
    kind, spot = k % 14, k % 5 + 1
    quantity = lambda i: F.lit(1000) - i * 7

    def node(level, value, amount, children):  # noqa: ANN001, ANN202
        return F.concat(F.lit('{"key":"category-'), level.cast("string"), F.lit('","value":"'), value, F.lit('","quantity":'), amount, F.lit(',"children":'), children, F.lit("}"))

    def around(inner, i):  # noqa: ANN001, ANN202
        """Level i: the branch that holds all deeper levels, with a leaf beside it, and what is wrong with either."""
        here, said = i == spot, F.concat(F.lit("v"), i.cast("string"))
        amount = quantity(i).cast("string")
        branch = node(i, said, amount, inner)
        leaf = node(i, F.lit("leaf"), F.lit("3"), F.lit("[]"))
        odd = (
            F.when(kind == 1, node(i, F.lit("odd"), F.lit('"5"'), F.lit("[]")))
            .when(kind == 2, node(i, F.lit("odd"), F.lit("-2"), F.lit("[]")))
            .when(kind == 3, node(i + 2, F.lit("odd"), F.lit("4"), F.lit("[]")))
            .when(kind == 4, F.concat(F.lit('{"key":"category-'), i.cast("string"), F.lit('","value":"odd","quantity":4}')))
            .when(kind == 5, node(i, F.lit("odd"), F.lit("5000"), F.lit("[]")))
            .when(kind == 6, branch)  # the same again
            .when(kind == 7, node(i, said, amount, F.lit("[]")))  # the same path, but nothing below
            .when(kind == 8, F.lit("17"))
            .when(kind == 9, node(i, F.lit("odd"), F.lit("4"), F.lit('{"a":1}')))
            .when(kind == 10, node(i, F.lit(" "), F.lit("4"), F.lit("[]")))
            .when(kind == 11, node(i, F.lit("odd"), F.lit("4"), F.lit('[{"quantity":null}]')))
        )
        return F.concat(F.lit("["), branch, F.lit(","), leaf, F.when(here & odd.isNotNull(), F.concat(F.lit(","), odd)).otherwise(""), F.lit("]"))

    body = F.aggregate(F.reverse(F.sequence(F.lit(1), n.cast("int"))), F.lit("[]"), around)
    return spread(read(spark, sf_dir, "part").select("p_partkey"), "p_partkey").select(k.alias("tree"), F.when(k % 97 == 0, '{"rows":1}').otherwise(body).alias("body"))


def deep_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on each tree of categories: what it holds, and all that is wrong with it."""
    given = _deep_trees(spark, sf_dir)
    report = trees.tree_report(given, trees.tree_nodes(given))
    return report.withColumn("faults", F.array_join("faults", ","))


_STORED = {  # table: source, key, columns
    "markets": ("region", ["r_regionkey"], ["r_name"]),
    "locations": ("nation", ["n_nationkey"], ["n_name", "n_regionkey"]),
    "products": ("part", ["p_partkey"], ["p_name", "p_brand", "p_retailprice"]),
    "current": ("supplier", ["s_suppkey"], ["s_name", "s_nationkey", "s_acctbal"]),
    "history": ("orders", ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_orderdate"]),
    "runs": ("customer", ["c_custkey"], ["c_name", "c_nationkey", "c_mktsegment"]),
}


def _batches(spark: SparkSession, sf_dir: str) -> tuple[list[TableSpec], dict[str, DataFrame], dict[str, DataFrame]]:
    """The tables' specs, the first batch (keys that 3 doesn't divide) and the second (those that 2 divides, with changed text)."""
    specs, first, second = [], {}, {}
    for name, (source, key, columns) in _STORED.items():
        rows = read(spark, sf_dir, source).select(*key, *columns)
        specs.append(TableSpec(name, rows.schema, tuple(key)))
        text = next(c for c in columns if rows.schema[c].dataType.simpleString() == "string")
        even = rows.filter(F.col(key[0]) % 2 == 0)
        first[name] = rows.filter(F.col(key[0]) % 3 != 0)
        second[name] = even if name == "history" else even.withColumn(text, F.concat(F.col(text), F.lit(" (2)")))
    return specs, first, second


def committed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables after two batches, a third that read the first version and is refused, and what version 1 still says."""
    specs, first, second = _batches(spark, sf_dir)
    kept = store.TableStore(spark, shared_path(spark, "store"), specs)
    kept.commit(0, {name: store.Upsert(rows) for name, rows in first.items()})
    kept.commit(1, {name: store.Upsert(rows, immutable=name == "history") for name, rows in second.items()})
    try:
        kept.commit(1, {"markets": store.Upsert(first["markets"])})
        refused = False
    except store.Conflict:
        refused = True
    out = None
    for version in (1, 2):
        for name, (_, key, columns) in _STORED.items():
            text = next(c for c in columns if kept.specs[name].schema[c].dataType.simpleString() == "string")
            rows = kept.read(name, version).agg(F.count("*").alias("n_rows"), F.sum(key[0]).alias("keys"), F.count_if(F.col(text).endswith(" (2)")).alias("changed"))
            rows = rows.select(F.lit(version).alias("version"), F.lit(name).alias("name"), "n_rows", F.col("keys").cast("long").alias("keys"), "changed", F.lit(refused).alias("late_refused"))
            out = rows if out is None else out.unionByName(rows)
    return out


def scan_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of at most 15 minutes and three events, and what their scans find."""
    events = read(spark, sf_dir, "events")
    return scans.scanned(events, "ts", scans.scan_windows(events, "ts", 15, 3))


QUERIES = {f.__name__: f for f in (strict_bodies, run_evidence, reconciled_runs, deep_trees, committed_batches, scan_plan)}


def tree_sql(name: str, said: str) -> str:
    """Tables of a tree over `said` (run, digest), level by level; `<name>_n3` has the roots."""
    levels, below = "", f"{name}_leaf"
    for k, digits in enumerate((6, 4, 2, 0)):
        levels += f""",
{name}_n{k} AS (SELECT run, substr(path, 1, {digits}) AS path, sha256('node:' || string_agg(node, '' ORDER BY node)) AS node, sum(n) AS n FROM {below} GROUP BY ALL)"""
        below = f"{name}_n{k}"
    return f"""
{name}_leaf AS (SELECT run, sha256('leaf:' || digest || ':' || count(*)) AS node, digest AS path, count(*) AS n FROM {said} GROUP BY run, digest){levels}"""


def _records_sql(name: str, rows: str) -> str:
    """The records of a table of rows."""
    return f"""
{name}_rows AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run, event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props FROM {rows}),
{name}_said AS (
  SELECT run, sha256('{{"event_id":' || coalesce(CAST(event_id AS VARCHAR), 'null') || ',"event_type":' || coalesce(to_json(event_type), 'null')
         || ',"props":' || coalesce(to_json(props), 'null') || ',"ts":' || coalesce(to_json(ts), 'null')
         || ',"user_id":' || coalesce(CAST(user_id AS VARCHAR), 'null') || '}}') AS digest FROM {name}_rows),{tree_sql(name, f"{name}_said")},
{name}_counts AS (
  SELECT run, count(*) AS observed, count(DISTINCT user_id) AS users, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views,
         count(*) FILTER (event_type = 'purchase') AS purchases, min(ts) AS started_at, max(ts) AS finished_at, min(event_id) AS first_id, max(event_id) AS last_id
  FROM {name}_rows GROUP BY run),
{name} AS (
  SELECT c.*, r.node AS root,
         'ev_' || sha256('{{"finished_at":"' || finished_at || '","observed":' || observed || ',"root":"' || r.node || '","run":"' || c.run
                         || '","started_at":"' || started_at || '","users":' || users || '}}') AS evidence
  FROM {name}_counts c JOIN {name}_n3 r ON r.run = c.run)"""


_NUMBERS = r"""'-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?'"""
_BODIES_SQL = """
bodies AS (
  SELECT event_id, event_id % 9 AS k, CASE event_id % 9
    WHEN 0 THEN '{"a":' || coalesce(props, '{}') || ',"b":' || coalesce(props, '{}') || ',"type":"' || event_type || '"}'
    WHEN 1 THEN '{"k":"\\"k\\":1,\\"k\\":2", "n":' || event_id || '}'
    WHEN 2 THEN '{"outer":{"k":' || event_id || ',"x":[{"k":1},{"k":2}],"\\u006b":3}}'
    WHEN 3 THEN '{"price":' || event_id || 'e' || (event_id % 400) || '}'
    WHEN 4 THEN '{"total":90071992547409' || (event_id % 100) || '}'
    WHEN 5 THEN '{"rows":[' || event_id || ',' || event_id || ']' || CASE WHEN event_id % 2 = 0 THEN '}' ELSE '' END
    WHEN 6 THEN '{"v":' || CASE WHEN event_id % 2 = 0 THEN 'NaN' ELSE '-Infinity' END || ',"w":"NaN, Infinity"}'
    WHEN 7 THEN '{"w":"NaN, -Infinity","v":' || event_id || '}'
    ELSE coalesce(props, '{}') END AS body
  FROM events)"""

_AROUND = """'[' || branch || ',' || leaf || CASE WHEN i = spot AND kind BETWEEN 1 AND 11 THEN ',' || CASE kind
    WHEN 1 THEN '{"key":"category-' || i || '","value":"odd","quantity":"5","children":[]}' WHEN 2 THEN '{"key":"category-' || i || '","value":"odd","quantity":-2,"children":[]}'
    WHEN 3 THEN '{"key":"category-' || (i + 2) || '","value":"odd","quantity":4,"children":[]}' WHEN 4 THEN '{"key":"category-' || i || '","value":"odd","quantity":4}'
    WHEN 5 THEN '{"key":"category-' || i || '","value":"odd","quantity":5000,"children":[]}' WHEN 6 THEN branch
    WHEN 7 THEN '{"key":"category-' || i || '","value":"v' || i || '","quantity":' || (1000 - i * 7) || ',"children":[]}' WHEN 8 THEN '17'
    WHEN 9 THEN '{"key":"category-' || i || '","value":"odd","quantity":4,"children":{"a":1}}' WHEN 10 THEN '{"key":"category-' || i || '","value":" ","quantity":4,"children":[]}'
    ELSE '{"key":"category-' || i || '","value":"odd","quantity":4,"children":[{"quantity":null}]}' END ELSE '' END || ']'"""

_COMMITTED_SQL = " UNION ALL ".join(
    f"""SELECT {v} AS version, '{name}' AS name, count(*) AS n_rows, CAST(coalesce(sum({key[0]}), 0) AS BIGINT) AS keys,
       count(*) FILTER ({"FALSE" if v == 1 or name == "history" else f"{key[0]} % 2 = 0"}) AS changed, TRUE AS late_refused
FROM {source} WHERE {key[0]} % 3 <> 0{f" OR {key[0]} % 2 = 0" if v == 2 else ""}"""
    for v in (1, 2)
    for name, (source, key, _) in _STORED.items()
)

ORACLE_SQL: dict[str, str] = {
    "committed_batches": _COMMITTED_SQL,
    "scan_plan": """
WITH RECURSIVE c AS (
  SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2),
m AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY minute) AS i FROM c),
w AS (
  SELECT day, i, minute, n, minute AS start, n AS taken FROM m WHERE i = 1
  UNION ALL
  SELECT m.day, m.i, m.minute, m.n, CASE WHEN m.minute - w.start < 15 AND w.taken + m.n <= 3 THEN w.start ELSE m.minute END,
         CASE WHEN m.minute - w.start < 15 AND w.taken + m.n <= 3 THEN w.taken + m.n ELSE m.n END
  FROM w JOIN m ON m.day = w.day AND m.i = w.i + 1)
SELECT day, start, max(minute) AS last, CAST(sum(n) AS BIGINT) AS rows, sum(n) > 3 AS truncated, CAST(sum(n) AS BIGINT) AS found FROM w GROUP BY day, start""",
    # The trees are built and walked by recursion; two nodes of a path are alike if all that is below them is.
    "deep_trees": f"""
WITH RECURSIVE built AS (
  SELECT p_partkey AS tree, p_partkey % 11 + 1 AS i, p_partkey % 14 AS kind, p_partkey % 5 + 1 AS spot, '[]' AS body FROM part
  UNION ALL
  SELECT tree, i - 1, kind, spot, {_AROUND} FROM (
    SELECT *, '{{"key":"category-' || i || '","value":"v' || i || '","quantity":' || (1000 - i * 7) || ',"children":' || body || '}}' AS branch,
           '{{"key":"category-' || i || '","value":"leaf","quantity":3,"children":[]}}' AS leaf FROM built WHERE i >= 1)),
given AS (SELECT tree, CASE WHEN tree % 97 = 0 THEN '{{"rows":1}}' ELSE body END AS body FROM built WHERE i = 0),
walk AS (
  SELECT tree, []::BIGINT[] AS place, []::VARCHAR[] AS path, NULL::BIGINT AS above, 0::BIGINT AS level, 0::BIGINT AS expected, NULL::BIGINT AS quantity, CAST(body AS JSON) AS kids,
         json_type(body) = 'ARRAY' AS normal, NULL::VARCHAR AS fatal, NULL::VARCHAR AS ends FROM given
  UNION ALL
  SELECT tree, place, list_append(path, key || '=' || value), above, level, expected, quantity, kids, fatal IS NULL AND ends IS NULL, fatal, CASE WHEN fatal IS NULL THEN ends END FROM (
    SELECT *, CASE WHEN json_type(node) <> 'OBJECT' THEN 'node_not_object' WHEN quantity IS NULL THEN 'quantity_not_integer' WHEN quantity < 0 THEN 'negative_quantity'
                   WHEN level IS NULL OR value = '' THEN CASE WHEN quantity > 0 THEN 'invalid_positive_leaf' ELSE 'invalid_node_identity' END END AS fatal,
           CASE WHEN kids IS NULL THEN 'children_missing' WHEN json_type(kids) <> 'ARRAY' THEN 'children_not_sequence' END AS ends FROM (
      SELECT tree, list_append(place, pos) AS place, path, quantity AS above, level + 1 AS expected, node,
             CASE WHEN json_type(node, '$.quantity') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(node, '$.quantity') AS BIGINT) END AS quantity,
             trim(coalesce(json_extract_string(node, '$.key'), '')) AS key, trim(coalesce(json_extract_string(node, '$.value'), '')) AS value,
             TRY_CAST(regexp_extract(coalesce(json_extract_string(node, '$.key'), ''), '^category-([1-9][0-9]*)$', 1) AS BIGINT) AS level, json_extract(node, '$.children') AS kids
      FROM (SELECT *, json_extract(kids, '$[' || pos || ']') AS node FROM (SELECT *, unnest(range(CAST(json_array_length(kids) AS BIGINT))) AS pos FROM walk WHERE normal))))),
nodes AS (SELECT * FROM walk WHERE len(place) > 0),
below AS (
  SELECT a.tree, a.place, a.path, string_agg(array_to_string(b.path[len(a.path):], '/') || '#' || b.quantity, '|' ORDER BY array_to_string(b.path[len(a.path):], '/') || '#' || b.quantity) AS look,
         count(*) FILTER (len(b.place) = len(a.place) + 1) AS n_normal
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.normal AND b.normal AND b.place[1:len(a.place)] = a.place GROUP BY ALL),
paths AS (
  SELECT n.tree, n.path, count(*) AS n, count(DISTINCT look) AS kinds, min_by(json_array_length(kids), n.place) AS n_kids, min_by(n_normal, n.place) AS n_normal, min_by(quantity, n.place) AS quantity
  FROM nodes n JOIN below b ON b.tree = n.tree AND b.place = n.place GROUP BY ALL),
faults AS (
  SELECT tree, fatal AS fault FROM nodes WHERE fatal IS NOT NULL UNION SELECT tree, ends FROM nodes WHERE ends IS NOT NULL
  UNION SELECT tree, 'category_level_above_limit' FROM nodes WHERE fatal IS NULL AND level > 8
  UNION SELECT tree, 'contradictory_topology' FROM nodes WHERE fatal IS NULL AND level <> expected
  UNION SELECT tree, 'child_quantity_exceeds_parent' FROM nodes WHERE fatal IS NULL AND quantity > above
  UNION SELECT tree, 'duplicate_structural_node_conflict' FROM paths WHERE kinds > 1
  UNION SELECT tree, 'positive_branch_without_valid_children' FROM paths WHERE n_kids > 0 AND n_normal = 0
  UNION SELECT tree, 'facets_not_sequence' FROM given WHERE json_type(body) <> 'ARRAY'),
a AS (SELECT tree, count(*) AS nodes_seen, count(*) FILTER (quantity > 0) AS positive_nodes FROM nodes GROUP BY tree),
b AS (SELECT tree, sum(n - 1) AS duplicates, count(*) FILTER (n_kids = 0) AS leaves, sum(quantity) FILTER (n_kids = 0) AS leaf_quantity FROM paths GROUP BY tree),
c AS (SELECT tree, string_agg(fault, ',' ORDER BY fault) AS faults FROM faults GROUP BY tree)
SELECT g.tree, coalesce(nodes_seen, 0) AS nodes_seen, coalesce(positive_nodes, 0) AS positive_nodes, CAST(coalesce(duplicates, 0) AS BIGINT) AS duplicates, coalesce(leaves, 0) AS leaves,
       CAST(coalesce(leaf_quantity, 0) AS BIGINT) AS leaf_quantity, coalesce(faults, '') AS faults, faults IS NULL AS complete
FROM given g LEFT JOIN a ON a.tree = g.tree LEFT JOIN b ON b.tree = g.tree LEFT JOIN c ON c.tree = g.tree""",
    # What repeats, and which numbers there are, by the other engine's own tree of each well-formed body.
    "strict_bodies": f"""
WITH {_BODIES_SQL.strip()},
formed AS (SELECT event_id, body, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS good, json_valid(body) AS ok FROM bodies),
cells AS (SELECT f.event_id, t.fullkey, t.key, t.parent, t.type, t.atom FROM formed f, json_tree(f.good) t),
again AS (SELECT event_id FROM (SELECT event_id, parent, key, count(*) AS n FROM cells WHERE key IS NOT NULL GROUP BY ALL) GROUP BY event_id HAVING max(n) > 1),
numbers AS (
  SELECT event_id, bool_or(atom IN ('NaN', '-NaN', 'Infinity', '-Infinity') OR isinf(TRY_CAST(atom AS DOUBLE)) OR (regexp_matches(atom, '[eE]') AND TRY_CAST(atom AS DOUBLE) IS NULL)) AS endless,
         bool_or(regexp_full_match(atom, '-?[0-9]+') AND abs(TRY_CAST(atom AS HUGEINT)) > 9007199254740991) AS large FROM cells WHERE type IN ('DOUBLE', 'BIGINT', 'UBIGINT') GROUP BY event_id)
SELECT f.event_id, CASE WHEN NOT ok THEN 'malformed' WHEN a.event_id IS NOT NULL THEN 'repeated_key' WHEN endless THEN 'not_finite' WHEN large THEN 'unsafe_integer' ELSE 'fine' END AS verdict,
       CAST(len(regexp_extract_all(regexp_replace(regexp_replace(body, '\\\\(["\\\\/bfnrt]|u[0-9a-fA-F]{{4}})', '_', 'g'), '"[^"]*"', '~', 'g'), {_NUMBERS})) AS INTEGER) AS n_numbers
FROM formed f LEFT JOIN again a ON a.event_id = f.event_id LEFT JOIN numbers n ON n.event_id = f.event_id""",
    "run_evidence": f"WITH {_records_sql('r', 'events').strip()}\nSELECT * FROM r",
    "reconciled_runs": f"""
WITH changed AS (
  SELECT event_id, event_type, ts, props,
         CASE WHEN event_type = 'view' AND event_id = min(event_id) OVER (PARTITION BY CAST(ts AS DATE), event_type) AND date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) % 3 = 0
              THEN user_id + 1000000 ELSE user_id END AS user_id
  FROM events),
later AS (SELECT * FROM changed WHERE NOT (date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) % 5 = 1 AND event_type = 'purchase')),{_records_sql("o", "events")},{_records_sql("n", "later")},
d AS (
  SELECT coalesce(o.run, n.run) AS run, o.run IS NULL AS not_stored, n.run IS NULL AS not_expected, array_to_string(list_filter([
    {", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in _RECORD)}], lambda x: x IS NOT NULL), ',') AS fields
  FROM o FULL JOIN n ON o.run = n.run)
SELECT run, CASE WHEN not_stored THEN 'not_stored' WHEN not_expected THEN 'not_expected' WHEN fields <> '' THEN 'differs' ELSE 'same' END AS verdict,
       CASE WHEN not_stored OR not_expected THEN '' ELSE coalesce(fields, '') END AS fields FROM d""",
}
