"""Approximate nearest neighbours by cosine: NN-descent builds a neighbour graph, greedy search walks it.

Equal vectors are one node. A first graph comes from runs of vectors in the order of the signs of their products with
random planes. A round of NN-descent then meets, for each node, its neighbours and those whose neighbour it is, pairwise
where one of the two is a new edge: a neighbour of a neighbour is likely one. Rounds go on while more than SETTLED of all
edges are new. A query starts at its own node and expands the best nodes found so far, until none of these is new.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_groups, written

#: Neighbours of a node in the graph; orders by planes, and nodes that meet in a run of such an order.
DEGREE, ORDERS, MEETING = 28, 4, 48
#: Of those that a node meets in a group, the best are passed on; share of new edges at which the graph has settled.
PASSED, SETTLED = 10, 0.02
#: Best nodes of a query that are expanded.
BEAM = 72


def usable(vector: Column) -> Column:
    """True unless the vector is null or zero or holds null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _stacked(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors stored as bytes, one in a row; shorter ones end in zeros."""
    raws = column.to_pylist()
    width = max(map(len, raws), default=0)
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raws), kind).reshape(len(raws), -1)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """The distinct vectors (node, exact: doubles, unit: floats), and the members (node, vec_id) that have each."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull()).distinct()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.array(x, "<f8").tobytes() for x in batch.column(1).to_pylist()], pa.binary())], names=["vec_id", "exact"])

    rows = written(rows.mapInArrow(packed, "vec_id long, exact binary"), "vectors")
    classes = rows.groupBy("exact").agg(F.min("vec_id").alias("node"))

    def floats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = _units(_stacked(batch.column(1), "<f8")).astype("<f4")
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in units], pa.binary())], names=["node", "exact", "unit"])

    nodes = written(classes.select("node", "exact").mapInArrow(floats, "node long, exact binary, unit binary"), "nodes")
    return nodes, written(rows.join(nodes.select("node", "exact"), "exact").select("node", "vec_id"), "members")


def _bounds(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    return begins, np.append(begins[1:], len(group))


def _column(table: pa.Table, i: int) -> np.ndarray:
    return table.column(i).to_numpy()


def _best_pairs(ids: np.ndarray, units: np.ndarray, worst: np.ndarray | None, new: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of nodes that meet: the best pairs (u, w, sim) of each that do better than its worst, one of the two being new."""
    # By distances from the middle of those that meet: cosines of near-equal vectors would all round to one.
    from_mean = units - units.mean(axis=0)
    square = (from_mean * from_mean).sum(axis=1)
    sim = 1 - (square[:, None] + square[None, :] - 2 * (from_mean @ from_mean.T)).astype(np.float64) / 2
    np.fill_diagonal(sim, -9)
    if new is not None:
        sim[~(new[:, None] | new[None, :])] = -9
    keep = min(PASSED, len(ids) - 1)
    best = np.argpartition(-sim, keep - 1, axis=1)[:, :keep]
    value = np.take_along_axis(sim, best, axis=1)
    i, j = np.nonzero(value > (-8 if worst is None else np.maximum(worst[:, None], -8)))
    return ids[i], ids[best[i, j]], value[i, j]


def _pairs(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    none = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64))]
    u, w, sim = (np.concatenate(x) for x in zip(*(found or none), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(w), pa.array(sim)], names=["u", "w", "sim"])


def run_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (node, unit) in an order: the best pairs of each node in its run of MEETING rows."""
    for batch in batches:
        if batch.num_rows > 1:
            ids, units = batch.column(0).to_numpy(), _stacked(batch.column(1), "<f4").astype(np.float32)
            cuts = [*range(0, max(1, len(ids) - MEETING // 2), MEETING), len(ids)]  # a short last run joins the one before
            yield _pairs([_best_pairs(ids[a:b], units[a:b], None, None) for a, b in zip(cuts, cuts[1:]) if b - a > 1])


def met_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (group, node, new, worst, unit): the best pairs of each node in its group that do better than its worst."""
    for table in whole_groups(batches):
        group, node, new, worst = (_column(table, i) for i in range(4))
        units = _stacked(table.column(4).combine_chunks(), "<f4").astype(np.float32)
        yield _pairs([_best_pairs(node[a:b], units[a:b], worst[a:b], new[a:b] > 0) for a, b in zip(*_bounds(group)) if b - a > 1])


def best_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (u, w, sim, new): the DEGREE best w of each u; an edge that is there already isn't new."""
    for table in whole_groups(batches):
        u, w, sim, new = (_column(table, i) for i in range(4))
        order = np.lexsort((new, w, u))
        u, w, sim, new = u[order], w[order], sim[order], new[order]
        first = np.concatenate(([True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])))
        u, w, sim, new = u[first], w[first], sim[first], new[first]
        order = np.lexsort((w, -sim, u))
        u, w, sim, new = u[order], w[order], sim[order], new[order]
        begins, ends = _bounds(u)
        kept = np.arange(len(u)) - np.repeat(begins, ends - begins) < DEGREE
        yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (u, w, sim, new)], names=["u", "w", "sim", "new"])


def _graph(pairs: DataFrame) -> DataFrame:
    rows = pairs.select("u", "w", "sim", F.col("new").cast("int").alias("new")).repartition("u").sortWithinPartitions("u")
    return written(rows.mapInArrow(best_edges, "u long, w long, sim double, new int"), "graph")


def _best(pairs: DataFrame, by: str, of: str, score: str, most: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc(score), of)
    return pairs.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= most).drop("_rank")


def neighbour_graph(nodes: DataFrame, seed: int = 11) -> DataFrame:
    """Edges (u, w, sim): for each node the DEGREE nearest that were found."""
    n = nodes.count()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _stacked(batch.column(1), "<f4").astype(np.float32)
            for turn in range(ORDERS):
                # One row of numbers for each component, so that vectors of any length meet the same planes.
                products = units @ np.random.default_rng(seed + turn).normal(size=(units.shape[1], 61)).astype(np.float32)
                code = (products[:, 1:] > 0) @ (1 << np.arange(59, -1, -1, dtype=np.int64))
                # Vectors on the same side of all planes are in the order of one product more.
                columns = [batch.column(0), pa.array(np.full(len(units), turn)), pa.array(code), pa.array(products[:, 0].astype(np.float64)), batch.column(1)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "turn", "code", "along", "unit"])

    rows = nodes.select("node", "unit").mapInArrow(coded, "node long, turn long, code long, along double, unit binary")
    # One more order is by chance alone: it joins what the planes keep apart.
    rows = rows.unionByName(nodes.select("node", F.lit(ORDERS).cast("long").alias("turn"), F.xxhash64("node").alias("code"), F.lit(0.0).alias("along"), "unit"))
    ordered = rows.repartitionByRange("turn", "code", "along", "node").sortWithinPartitions("turn", "code", "along", "node").select("node", "unit")
    edges = _graph(ordered.mapInArrow(run_pairs, "u long, w long, sim double").withColumn("new", F.lit(1)))
    fresh, before = edges.filter("new = 1").count(), None
    while fresh > SETTLED * n * DEGREE and (before is None or fresh < before):
        # Those whose neighbour a node is come in parts, each of which meets all neighbours of the node.
        counts = edges.groupBy("w").agg(F.count("*").alias("n"), F.max("new").alias("any"))
        parts = counts.select(F.col("w").alias("at"), F.ceil(F.col("n") / (2 * DEGREE)).alias("parts"), F.col("any").alias("back_new"))
        own = edges.groupBy("u").agg(F.max("new").alias("own_new"), F.min("sim").alias("worst"), F.count("*").alias("n"))
        own = own.select(F.col("u").alias("at"), "own_new", F.when(F.col("n") >= DEGREE, F.col("worst")).otherwise(-8.0).alias("worst"))
        state = written(own.join(parts, "at", "full").filter("at is not null"), "state")
        live = state.filter("own_new = 1 or back_new = 1").select("at", F.coalesce("parts", F.lit(1)).cast("long").alias("parts"))
        back = edges.select(F.col("w").alias("at"), F.col("u").alias("node"), "new").join(live, "at").withColumn("part", F.pmod(F.xxhash64("node"), "parts")).select("at", "part", "node", "new")
        forth = edges.select(F.col("u").alias("at"), F.col("w").alias("node"), "new").join(live, "at")
        forth = forth.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select("at", "part", "node", "new")
        members = back.unionByName(forth).groupBy("at", "part", "node").agg(F.max("new").alias("new")).withColumn("group", F.xxhash64("at", "part"))
        known = nodes.join(state.select(F.col("at").alias("node"), "worst"), "node", "left").select("node", F.coalesce("worst", F.lit(-8.0)).alias("worst"), "unit")
        met = members.select("group", "node", "new").join(known, "node").select("group", "node", "new", "worst", "unit").repartition("group").sortWithinPartitions("group")
        found = met.mapInArrow(met_pairs, "u long, w long, sim double").withColumn("new", F.lit(1))
        edges = _graph(found.unionByName(edges.withColumn("new", F.lit(0))))
        fresh, before = edges.filter("new = 1").count(), fresh
    return edges.select("u", "w", "sim")


def scored(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds score, the cosine in double precision of the original vectors, to pairs (query, node)."""
    exact = nodes.select("node", "exact")
    rows = pairs.join(exact, "node").join(exact.select(F.col("node").alias("query"), F.col("exact").alias("asked")), "query").select("query", "node", "exact", "asked")

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(a, "<f8"), np.frombuffer(b, "<f8")
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                m = min(len(x), len(y))
                scores.append(float(x[:m] @ y[:m] / np.sqrt((x @ x) * (y @ y))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["query", "node", "score"])

    return rows.mapInArrow(cosine, "query long, node long, score double")


def near_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (query, node, unit), for each query its own vector first, with a null node: the cosines, about."""
    for table in whole_groups(batches):
        query, units = _column(table, 0), _stacked(table.column(2).combine_chunks(), "<f4").astype(np.float32)
        begins, ends = _bounds(query)
        apart = units - np.repeat(units[begins], ends - begins, axis=0)
        sims = 1 - np.einsum("ij,ij->i", apart, apart).astype(np.float64) / 2
        asked = np.zeros(len(query), bool)
        asked[begins] = True
        rows = table.select([0, 1]).append_column("score", pa.array(sims)).filter(pa.array(~asked))
        yield from rows.combine_chunks().to_batches()


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """query, node, score: the BEAM best nodes that greedy search finds for each query (a node of the graph).

    Each round expands the nodes of the beam that weren't yet; it ends when no round finds a node it hasn't seen.
    """
    asked = queries.join(nodes.select(F.col("node").alias("query"), "unit"), "query").select("query", F.lit(None).cast("long").alias("node"), "unit")
    asked = written(asked, "asked")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    found = queries.select("query", F.col("query").alias("node"), F.lit(9.0).alias("score"), F.lit(False).alias("expanded"))
    while True:
        ranked = written(found.withColumn("top", F.row_number().over(order) <= BEAM), "beam")
        ways = ranked.filter("top and not expanded").join(graph, F.col("node") == F.col("u")).select("query", F.col("w").alias("node")).distinct()
        fresh = ways.join(ranked.select("query", "node"), ["query", "node"], "left_anti").join(nodes.select("node", "unit"), "node").select("query", "node", "unit")
        rows = asked.unionByName(fresh).repartition("query").sortWithinPartitions("query", F.asc_nulls_first("node"))
        scores = written(rows.mapInArrow(near_scores, "query long, node long, score double"), "scores")
        found = ranked.select("query", "node", "score", (F.col("expanded") | F.col("top")).alias("expanded")).unionByName(scores.withColumn("expanded", F.lit(False)))
        if scores.isEmpty():
            break
    return scored(_best(found, "query", "node", "score", BEAM).select("query", "node"), nodes)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows of each query row (where `is_query`, on vec_id, holds), the query's own row apart.

    Returns query_id, rank (from 1), vec_id, score (the cosine in double precision), nearest first and ties to the
    smaller vec_id. All rows are indexed. Vectors that are null, zero or hold null or non-finite components take no
    part, nor do null ids; rows that repeat an id and vector are one row; a shorter vector ends in zeros. Other columns
    are ignored. With k or fewer candidates all are returned.
    """
    nodes, members = nodes_of(vectors, id_col, vector_col)
    graph = neighbour_graph(nodes)
    asked = members.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    found = search(asked.select("query").distinct(), graph, nodes)
    # Of equal vectors, only the k + 1 of the smallest ids can be among a query's k nearest.
    first = _best(members.withColumn("one", F.lit(1)), "node", "vec_id", "one", k + 1).select("node", "vec_id")
    pairs = asked.join(found, "query").join(first, "node").filter("vec_id <> query_id").select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
