"""Token ids in files, coded by a static range asymmetric numeral system (rANS).

A set of files has one table of token frequencies, counted over all documents, and blocks of whole documents in
ascending order of their ids. Each block stands for itself: its tokens are dealt over lanes with a coder each, whose
32-bit words interleave in one stream, and checkpoints in the block hold the lanes' states and the place in the stream,
so that a reader can start at any of them. A checksum covers each stretch between checkpoints.

A set is a folder of Parquet files: `table` (token, freq) and `blocks` (part, seq, doc_ids, lengths, body, n_tokens). A
body is little-endian: b"RNS1", lanes u32, steps between checkpoints u32, tokens u64, checkpoints u32, words u64; for
each checkpoint the place in the stream u64, the checksum u32 of the ids up to the next one (as u32), and the lanes'
states u64; then the words u32.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from concurrent.futures import Executor
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

SCALE = 20  #: Frequencies add up to 2 ** SCALE.
LOW = 1 << 31  #: States are from LOW up to 2 ** 63.
LANES, STEPS = 512, 128
#: Tokens from which a block is closed; it ends with the document that reaches them.
BLOCK = 1 << 18
#: Words whose ids a worker remembers before it starts anew.
MEMORY = 600_000
#: Bytes of text that are split into words at once: the more, the fewer distinct words to look up.
CHUNK = 1 << 23
_HEAD = struct.Struct("<4sIIQIQ")


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies that add up to 2 ** SCALE, at least 1 for each token of the vocabulary."""
    total, spare = int(counts.sum()), (1 << SCALE) - len(counts)
    if spare < 0:
        raise ValueError("the vocabulary is too large for the scale")
    freq = 1 + (counts.astype(object) * spare // max(total, 1)).astype(np.int64)
    freq[int(np.argmax(counts))] += (1 << SCALE) - int(freq.sum())
    return freq.astype(np.uint64)


class Coder:
    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self.token = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray, lanes: int = LANES, steps: int = STEPS) -> bytes:
        n = len(ids)
        freq, start = self.freq[ids], self.start[ids]
        limit = freq << np.uint64(63 - SCALE)
        state = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []  # words so far, states; the last step first
        so_far, scale, shift = 0, np.uint64(SCALE), np.uint64(32)
        for step in range(-(-n // lanes) - 1, -1, -1):
            at, to = step * lanes, min(n, (step + 1) * lanes)
            x, f = state[: to - at], freq[at:to]
            over = x >= limit[at:to]
            if over.any():
                words.append(x[over].astype(np.uint32))
                so_far += len(words[-1])
                x = np.where(over, x >> shift, x)
            high = x // f
            state[: to - at] = (high << scale) + (x - high * f) + start[at:to]
            if step % steps == 0:
                marks.append((so_far, state.copy()))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        out = [_HEAD.pack(b"RNS1", lanes, steps, n, len(marks), len(stream))]
        for k, (count, states) in enumerate(reversed(marks)):
            part = ids[k * steps * lanes : (k + 1) * steps * lanes].astype("<u4")
            out.append(struct.pack("<QI", len(stream) - count, zlib.crc32(part.tobytes())) + states.astype("<u8").tobytes())
        return b"".join((*out, stream.astype("<u4").tobytes()))

    def stretch(self, body: bytes, k: int) -> np.ndarray:
        """Decodes the tokens from checkpoint k to the next, and holds them against their checksum."""
        magic, lanes, steps, n, marks, count = _HEAD.unpack_from(body)
        if magic != b"RNS1":
            raise ValueError("not a block of tokens")
        width = 12 + 8 * lanes
        place, checksum = struct.unpack_from("<QI", body, _HEAD.size + k * width)
        state = np.frombuffer(body, "<u8", lanes, _HEAD.size + k * width + 12).astype(np.uint64)
        stream = np.frombuffer(body, "<u4", count, _HEAD.size + marks * width).astype(np.uint64)
        first, last = k * steps * lanes, min(n, (k + 1) * steps * lanes)
        out = np.empty(last - first, np.uint32)
        scale, shift, low, mask = np.uint64(SCALE), np.uint64(32), np.uint64(LOW), np.uint64((1 << SCALE) - 1)
        for at in range(0, last - first, lanes):
            to = min(last - first, at + lanes)
            x = state[: to - at]
            slot = x & mask
            token = self.token[slot]
            out[at:to] = token
            x = self.freq[token] * (x >> scale) + slot - self.start[token]
            under = np.flatnonzero(x < low)
            if len(under):
                x[under] = x[under] << shift | stream[place : place + len(under)]
                place += len(under)
            state[: to - at] = x
        if zlib.crc32(out.astype("<u4").tobytes()) != checksum:
            raise ValueError(f"checksum of stretch {k} differs")
        return out

    def decode(self, body: bytes, pool: Executor | None = None) -> np.ndarray:
        """Decodes a block; a pool decodes its stretches in parallel."""
        marks = _HEAD.unpack_from(body)[4]
        parts = list((pool.map if pool else map)(lambda k: self.stretch(body, k), range(marks)))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


#: Bytes that are white space, that are ASCII letters or digits, and ASCII punctuation but for what words may hold. No token
#: holds a letter or digit and one of the last kind after it, so a word may end between them.
_SPACE, _ALNUM, _STOP = (np.isin(np.arange(256), list(x)) for x in (b" \t\n\x0b\x0c\r", bytes(x for x in range(128) if chr(x).isalnum()), b"!\"#$%&()*+,-./:;<=>?@[\\]^`{|}~"))


#: Lower-case letters of ASCII and Latin-1.
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"


def split_words(raws: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in lower case, one after the other, and where each text's words begin and the last one's end."""
    text = np.frombuffer(b"\n".join([*raws, b""]).lower(), np.uint8)
    space = _SPACE[text]
    inside = ~space
    begins = inside.copy()
    begins[1:] &= space[:-1]
    known = _ALNUM[text[:-1]]
    known[1:] |= (text[:-2] == 0xC3) & (text[1:-1] != 0x97) & (text[1:-1] != 0xB7)  # letters of Latin-1, two bytes each
    begins[1:] |= _STOP[text[1:]] & known
    place = np.flatnonzero(begins)
    upto = np.cumsum(inside, dtype=np.int32 if len(inside) < 1 << 31 else np.int64)
    offsets = np.append(upto[place].astype(np.int64) - 1, inside.sum())
    words = pa.Array.from_buffers(pa.large_binary(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(text[inside])])
    return words, np.searchsorted(place, np.cumsum([0] + [len(x) + 1 for x in raws]))


class WordTokens:
    """Ids of texts for a tokenizer that lower-cases, splits at white space and drops it: those of the words in a row."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.nothing = self.tokenizer.normalizer, normalizers.Sequence([])
        # Of each character twice in a row: where they stay as they are, lower-case ASCII words need no normalizer.
        plain = "".join(chr(x) * 2 for x in range(128) if not chr(x).isupper() and not _SPACE[x])
        self.bare = self.normalizer is not None and self.normalizer.normalize_str(plain) == plain
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {k: v.content for k, v in added.items() if v.special}
        self.is_letters = re.compile(f"[{_LETTERS}]+").fullmatch
        self.pieces = None if any(self.is_letters(v.content) for v in added.values()) else self._pieces()
        self.reset()

    def _pieces(self) -> dict[int, str] | None:
        """What the pre-tokenizer makes of each letter, if a word of letters stays as it is in the normalizer and is one piece: the
        tokenizer's model takes such words as they are."""
        normal = self.normalizer.normalize_str if self.normalizer is not None else str
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str if self.tokenizer.pre_tokenizer is not None else lambda text: [(text, None)]
        each = {ord(x): "".join(piece for piece, _ in pieces(x)) for x in _LETTERS}
        for twice in ("".join(x * 2 for x in _LETTERS), "".join(x * 2 for x in reversed(_LETTERS))):
            if normal(twice) != twice or [piece for piece, _ in pieces(twice)] != [twice.translate(each)]:
                return None
        return each

    def reset(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.size = np.zeros(1 << 20, np.uint32), 0
        self.begin, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _encoded(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Ids of all words, one after the other, and how many each has. Words of letters go to the tokenizer's model, which is what the
        tokenizer does once it has taken them for one piece each."""
        pieces, tokenize = self.pieces, self.tokenizer.model.tokenize
        texts = [word.decode() for word in words]
        direct = [pieces is not None and self.is_letters(text) is not None for text in texts]
        others = iter(self._by_tokenizer([word for word, yes in zip(words, direct) if not yes]))
        ids: list[int] = []
        counts: list[int] = []
        for text, yes in zip(texts, direct):
            own = [x.id for x in tokenize(text.translate(pieces))] if yes else next(others).tolist()
            ids += own
            counts.append(len(own))
        return ids, counts

    def _by_tokenizer(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word. Many words go to the tokenizer as one text, with a special token between any two."""
        if not self.special:
            return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        plain = [w for w in words if b"<|" not in w]
        ascii_ = [w for w in plain if w.isascii() and w == w.lower()] if self.bare else []
        known: dict[bytes, np.ndarray] = {}
        if ascii_:
            self.tokenizer.normalizer = self.nothing
            try:
                known.update(zip(ascii_, self._together(ascii_), strict=True))
            finally:
                self.tokenizer.normalizer = self.normalizer
        others = [w for w in plain if w not in known]
        known.update(zip(others, self._together(others), strict=True))
        return [known[w] if w in known else np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32) for w in words]

    def _together(self, words: list[bytes]) -> list[np.ndarray]:
        between, text = next(iter(self.special.items()))
        texts = [text.join([w.decode() for w in words[i : i + 500]]) for i in range(0, len(words), 500)]
        found: list[np.ndarray] = []
        for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(one.ids, np.uint32)
            cuts = np.flatnonzero(ids == between)
            found += [ids[x:y] for x, y in zip(np.concatenate(([0], cuts + 1)).tolist(), np.append(cuts, len(ids)).tolist())]
        return found

    def add(self, words: list[bytes]) -> None:
        found, counts = self._encoded(words)
        k, counts = len(self.place), np.array(counts, np.int64)
        total = int(counts.sum())
        while self.size + total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), np.uint32)))
        while k + len(words) > len(self.begin):
            self.begin, self.count = (np.concatenate((x, np.zeros(len(x), np.int64))) for x in (self.begin, self.count))
        self.place.update(zip(words, range(k, k + len(words))))
        self.count[k : k + len(words)] = counts
        self.begin[k : k + len(words)] = self.size + np.cumsum(counts) - counts
        if total:
            self.ids[self.size : self.size + total] = found
        self.size += total

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The place of each word in the memory, where each distinct one is looked up once."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(self.place) + len(new) > MEMORY and self.place:
            self.reset()
            new = np.arange(len(distinct))
        if len(new):
            at[new] = len(self.place) + np.arange(len(new))
            self.add([distinct[i] for i in new.tolist()])
        return at[coded.indices.to_numpy()]

    def encode(self, raws: list[bytes], end_id: int) -> list[np.ndarray]:
        marked = {i: raw.split() for i, raw in enumerate(raws) if b"<|" in raw}  # may hold special tokens, which have a case
        words, bounds = split_words([b"" if i in marked else raw for i, raw in enumerate(raws)])
        found = self._ids(words, bounds)
        for i, own in marked.items():
            found[i] = self._ids(pa.array(own, pa.large_binary()), np.array([0, len(own)]))[0]
        last = np.array([end_id], np.uint32)
        return [np.concatenate((ids, last)) for ids in found]

    def _ids(self, words: pa.Array, bounds: np.ndarray) -> list[np.ndarray]:
        at = self.numbers(words)
        count = self.count[at]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(self.begin[at] - (ends - count), count) + np.arange(count.sum())]
        cuts = np.append(0, ends)[bounds]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


_TOKENS: dict[str, WordTokens] = {}


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int, width: str = "<u4", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (numbers of numpy's type `width`) of each whole text, the end id last."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _TOKENS.get(tokenizer_path) or _TOKENS.setdefault(tokenizer_path, WordTokens(tokenizer_path))
        for batch in batches:
            raws = [x or b"" for x in batch.column(1).to_pylist()]
            ends = np.cumsum([len(x) for x in raws])
            start = 0
            while start < len(raws):
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + CHUNK)))
                ids = tokens.encode(raws[start:stop], end_id)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array([x.astype(width).tobytes() for x in ids], pa.binary())], names=["doc_id", "ids"])
                start = stop

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(encode, f"doc_id {kind}, ids binary")


def token_counts(tokens: DataFrame, vocabulary: int, width: str) -> np.ndarray:
    """How often each token occurs in all documents; as many numbers as the vocabulary has, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), width), minlength=vocabulary)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["token", "n"])

    out = np.zeros(vocabulary, np.int64)
    for row in tokens.select("ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect():
        out[row.token] = row.n
    return out


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes whole texts (null: empty) and writes them as a set of files, in ascending order of the ids, nulls first.

    Rows that repeat an id are in order of their tokens. Other columns are ignored; an empty table gives an empty set.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    tokens = written(token_ids(docs, tokenizer_path, end_id, width, id_col, text_col), "tokens")
    freq = frequencies(token_counts(tokens, vocabulary, width))
    rows = pa.table({"token": np.arange(vocabulary, dtype=np.int64), "freq": freq.astype(np.int64)})
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{path}/table")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seq = Coder(freq), TaskContext.get().partitionId(), 0
        ids, held, size = [], [], 0

        def block() -> pa.RecordBatch:
            lengths = [len(x) for x in held]
            body = coder.encode(np.concatenate(held))
            columns = [pa.array([part]), pa.array([seq]), pa.array([ids], pa.list_(key)), pa.array([lengths], pa.list_(pa.int64())), pa.array([body], pa.binary()), pa.array([sum(lengths)])]
            return pa.RecordBatch.from_arrays(columns, names=["part", "seq", "doc_ids", "lengths", "body", "n_tokens"])

        key = pa.int64()
        for batch in batches:
            key = batch.column(0).type
            for one, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append(np.frombuffer(raw.as_buffer(), width).astype(np.uint32))
                ids.append(one)
                size += len(held[-1])
                if size >= BLOCK:
                    yield block()
                    ids, held, size, seq = [], [], 0, seq + 1
        if held:
            yield block()

    kind = tokens.schema["doc_id"].dataType.simpleString()
    order = tokens.select("doc_id", "ids", F.xxhash64("ids").alias("tie"))
    ranged = order.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    packed = ranged.mapInArrow(pack, f"part long, seq long, doc_ids array<{kind}>, lengths array<long>, body binary, n_tokens long")
    packed.write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), ids (unsigned 32-bit little-endian) from a set of files."""
    vocabulary = spark.read.parquet(f"{path}/table").orderBy("token")
    freq = np.array([row.freq for row in vocabulary.collect()], np.uint64)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "seq", "n_tokens").withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
    starts = starts.select("part", "seq", (F.col("before") + F.col("inside")).alias("start"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                start, doc_ids, body = batch.column(0)[i].as_py(), batch.column(1)[i].values, batch.column(3)[i].as_py()
                lengths = np.array(batch.column(2)[i].as_py(), np.int64)
                ends = np.cumsum(lengths)
                raw = coder.decode(body).astype("<u4").tobytes()
                ids = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start + ends - lengths), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"])

    joined = blocks.select("part", "seq", "doc_ids", "lengths", "body").join(starts, ["part", "seq"]).select("start", "doc_ids", "lengths", "body")
    return joined.mapInArrow(unpack, f"doc_id {kind}, start long, ids binary")
