"""Byte-level BPE by monoid tree reduction.

An encoding is valid exactly if every two neighbours in it are: encoding the bytes of the two together gives the two
back. (Merges happen in the order of their ranks, and each token of the vocabulary encodes as itself.) So encodings
form a monoid: two halves join by re-encoding a window around the seam, which grows until its first and last tokens
are valid neighbours of the tokens outside; those outside then can't change.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that a leaf of the tree encodes by plain merging.
LEAF = 6
#: Entries after which a worker's memory of pieces, leaves or neighbours starts anew, and bytes of the longest piece that
#: is remembered; so each of the four memories stays below about 20 MB. Results don't depend on them.
MEMORY, LONGEST = 100_000, 48
#: Bytes of text of which the results leave a task at once.
CHUNK = 1 << 21
#: The rank of what can't merge.
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class TreeBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # those of before the memory of pieces was last full

    def merged(self, raw: bytes) -> list[int]:
        """A leaf or window: merges the neighbours of the lowest rank, leftmost first, until none can merge."""
        ranks = self.ranks
        if raw in ranks:
            return [ranks[raw]]
        get, parts = ranks.get, [raw[i : i + 1] for i in range(len(raw))]
        near = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while near:
            best = min(near)
            if best == NEVER:
                break
            i = near.index(best)
            pair = parts[i] = parts[i] + parts.pop(i + 1)
            del near[i]
            if i:
                near[i - 1] = get(parts[i - 1] + pair, NEVER)
            if i < len(near):
                near[i] = get(pair + parts[i + 1], NEVER)
        return [ranks[p] for p in parts]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether a and b can stand side by side in a valid encoding."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMORY:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.neighbours(left[-1], right[0]):
            return left + right
        i, j = len(left) - 1, 1  # the window: left[i:] and right[:j]
        while True:
            middle = self.leaf(b"".join([self.bytes_of[t] for t in left[i:] + right[:j]]))
            grow_left = i > 0 and not self.neighbours(left[i - 1], middle[0])
            grow_right = j < len(right) and not self.neighbours(middle[-1], right[j])
            if not grow_left and not grow_right:
                return left[:i] + middle + right[j:]
            i -= grow_left
            j += grow_right

    def leaf(self, raw: bytes) -> list[int]:
        if len(raw) > LONGEST:
            return self.merged(raw)
        known = self.leaves.get(raw)
        if known is None:
            if len(self.leaves) >= MEMORY:
                self.leaves.clear()
            known = self.leaves[raw] = self.merged(raw)
        return known

    def tree(self, raw: bytes) -> list[int]:
        """One piece: halves are encoded and joined, level by level from the leaves up."""
        if raw in self.ranks:
            return [self.ranks[raw]]
        level = [self.leaf(raw[i : i + LEAF]) for i in range(0, len(raw), LEAF)]
        while len(level) > 1:
            pairs = [self.joined(a, b) for a, b in zip(level[::2], level[1::2])]
            level = pairs + level[len(pairs) * 2 :]
        return level[0] if level else []

    def encode(self, text: str) -> list[tuple[int, ...]]:
        """The ids of each piece of the text; pieces are apart in the encoding, so their join is plain concatenation."""
        pieces, out = self.pieces, []
        for piece in self.pattern.findall(text):
            ids = pieces.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    ids = tuple(self.tree(piece.encode()))
                if len(piece) <= LONGEST:
                    if len(pieces) >= MEMORY:
                        self.older, pieces = pieces, {}
                        self.pieces = pieces
                    pieces[piece] = ids
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> bytes:
        """Concatenates up the tree."""
        level = [self.bytes_of[t] for t in ids]
        while len(level) > 64:
            level = [b"".join(level[i : i + 64]) for i in range(0, len(level), 64)]
        return b"".join(level)


_ENCODERS: dict[tuple[str, str], TreeBPE] = {}


def encoder(path: str, pattern: str) -> TreeBPE:
    """One encoder for each process."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = TreeBPE(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes whole texts: one row for each row of `docs` with the id and `ids`, an array of int.

    A null or empty text has no ids. A null id stays null, repeated rows are encoded each, other columns are ignored.
    `ranks_path` is a file of base64 tokens and ranks that every executor can open.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks_path, pattern)
        for batch in batches:
            found, begun, size = [], 0, 0
            for i, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                found.append(np.array([t for piece in bpe.encode(text) for t in piece], np.int32))
                size += len(text)
                if size >= CHUNK or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begun, len(found)), pa.array(found, pa.list_(pa.int32()))], names=[id_col, "ids"])
                    found, begun, size = [], i + 1, 0

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Decodes `ids` to `raw`, the bytes of the text; null ids give no bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks_path, pattern)
        for batch in batches:
            raw = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=[id_col, "raw"])

    kind = encoded.select(id_col).schema[0].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(decode, f"`{id_col}` {kind}, raw binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes each text in one pass: the id, n_tokens, and SHA-256 of the ids and of the decoded bytes.

    The ids are hashed as decimal numbers with single spaces between. Nulls, empty texts, repeated rows and other
    columns are treated as in encode_documents.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks_path, pattern)
        for batch in batches:
            rows = []
            for value in batch.column(1):  # one text at a time: a batch may hold many long ones
                ids = [t for piece in bpe.encode(value.as_py() or "") for t in piece]
                shown = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
                rows.append((len(ids), shown, hashlib.sha256(bpe.decode(ids)).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, F.col(text_col)).mapInArrow(digest, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
