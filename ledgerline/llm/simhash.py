"""Near-duplicates by SimHash, with pigeonring filtering of the candidates.

A fingerprint's 64 bits form a ring of 8 segments of 8 bits. If two fingerprints differ in at most t bits, then some
segment starts a chain in which, for every length l from 1 to 8, the first l segments differ in at most l * t / 8 bits
together. With t = 3 the first two segments of the chain are equal, and of the next three at least two. These four
equal segments are the join key (8 starts, 3 choices); within a bucket of one key, pairs must pass the budgets of all
chain lengths before their Hamming distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

SEGMENTS, WIDTH, LIMIT = 8, 8, 3
#: Which two of the segments at places 2, 3 and 4 of a chain are part of the key.
CHOICES = ((2, 3), (2, 4), (3, 4))
#: Rows of a bucket that one task compares with one another; larger buckets are dealt into blocks, each met by each.
BLOCK = 4096


def fingerprint(raw: bytes | None, width: int = 3) -> int:
    """SimHash of the ASCII-lower-cased words' shingles, as an unsigned number."""
    words = (raw or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(x), 42) for x in zip(*(words[i:] for i in range(width)))), np.uint64, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[i : i + 65536].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: the id and `fp`, the fingerprint's 64 bits as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(x) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=[id_col, "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(hashed, f"`{id_col}` {kind}, fp long")


def chain_masks(start: int) -> list[tuple[np.uint64, int]]:
    """For each chain length from `start`: the bits of the chain, and how many of them may differ."""
    out, mask = [], 0
    for length in range(1, SEGMENTS + 1):
        mask |= 0xFF << (WIDTH * ((start + length - 1) % SEGMENTS))
        out.append((np.uint64(mask), length * LIMIT // SEGMENTS))
    return out


def spanning_links(fps: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a forest that joins all of `fps` that pairs passing the chain from `start` connect."""
    masks = chain_masks(start)
    left, a, b = fps, [], []
    todo: list[np.uint64] = []
    while len(left):
        if not todo:
            todo, left = [left[0]], left[1:]
        x = todo.pop()
        differ = left ^ x
        near = np.arange(len(left))
        for mask, budget in masks:  # the last length is the whole ring: the Hamming distance
            near = near[np.bitwise_count(differ[near] & mask) <= budget]
        if len(near):
            found = left[near]
            a.append(np.full(len(found), x))
            b.append(found)
            todo.extend(found)
            left = np.delete(left, near)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _segment(fp, place):  # noqa: ANN001, ANN202 - columns
    return F.shiftrightunsigned(fp, place * WIDTH).bitwiseAND(F.lit(0xFF))


def near_links(classes: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that connect all pairs at LIMIT or fewer differing bits."""
    fp = F.col("fp")
    keys = []
    for start in range(SEGMENTS):
        for k, choice in enumerate(CHOICES):
            places = [(start + i) % SEGMENTS for i in (0, 1, *choice)]
            key = F.lit(start * len(CHOICES) + k).cast("long")
            for place in places:
                key = F.shiftleft(key, WIDTH) + _segment(fp, place)
            keys.append(key)
    keyed = classes.select("fp", F.explode(F.array(*keys)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # A bucket of n rows has ceil(n / BLOCK) blocks. A row goes to the meeting of its block with each block.
    dealt = (
        keyed.join(shared, "key")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("fp", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    )

    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        start = (key[0].as_py() >> (4 * WIDTH)) // len(CHOICES)
        fps = np.sort(table.column("fp").to_numpy()).view(np.uint64)
        a, b = spanning_links(fps, start)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("key", "p", "q").applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups documents whose fingerprints link, at 3 or fewer differing bits, directly or through others.

    Returns one row for each row of `docs`: the id, fingerprint (16 lower-case hex digits), component_id (the smallest
    id of the group) and fp (the fingerprint as a long). Texts without words (null and empty ones too) have fingerprint
    zero. Null ids take part but never name a group; a group of null ids only has a null component_id. Repeated rows
    fall into one group. Other columns are ignored. All rows and links count, however large a group is: equal
    fingerprints are one node, and links within a bucket are a forest rather than all its pairs.
    """
    fps = written(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    labels = components(near_links(classes.select("fp")))
    groups = classes.join(labels, classes.fp == labels.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    groups = written(groups, "groups")
    least = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = groups.join(least, "component").select("fp", "component_id")
    return fps.join(named, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "fp")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the smallest id of their group, with all their columns.

    Rows that repeat an id stay or go together; a row with a null id stays only where its group has no other.
    """
    groups = near_duplicates(docs, id_col, text_col)
    kept = groups.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_kept")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept"]), "left_semi")
