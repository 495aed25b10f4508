"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, one occurrence per group kept.

A line's features (words, or pairs of bytes where it is short or has hardly any spaces) are dealt over blocks by their
hashes, and each block of the fingerprint is the SimHash of its features. An edit touches the blocks of the features that
come and go and no others: a replaced word at most two. Lines of few words have six blocks, of which any two equal ones
are a join key: two stay equal while one or two words are replaced (or up to four added or left out). Lines of many words
have ten more, each a key by itself: two stay equal while four words are replaced, and some most often with far more.
The shortest lines, in which one edit can touch all, meet by what is left of them without one or two bytes: that finds
all pairs. Lines that meet in a bucket are linked by edit similarity of their whole texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import all_columns, free_names, numbered_rows, whole_groups, written
from .components import components

#: Lines are linked from this edit similarity on.
SIMILARITY, BLOCKS = 0.8, 6
#: Pairs of blocks that make a key, if they have at least KEY_FEATURES features together.
CHOICES, KEY_FEATURES = tuple(combinations(range(BLOCKS), 2)), 3
#: Lines of so many distinct words have SINGLES blocks that are keys alone, if they have at least SINGLE_FEATURES
#: features; below PAIRED distinct words, pairs of blocks are keys.
SINGLES, SINGLE_FEATURES, SINGLE_FROM, PAIRED = 10, 4, 16, 40
#: Lines (normalised, in bytes) below the first have pairs of bytes as features, from the second on words; between the
#: two both, as a line may be 0.8 times as long as its like. Longer ones have both too if their words are long on average.
WORDS_FROM, PAIRS_BELOW, LONG_WORDS = 40, 54, 16
#: Lines up to so many bytes meet by what is left of them: similar ones are at most two edits apart.
SHORT = 14
#: Bytes of text that are hashed at once, and rows of one bucket that one task compares with one another.
CHUNK, MEETING = 1 << 18, 2048
#: Bits of the filter of line hashes whose texts are wanted: 4 MB whatever the input.
FILTER_BITS = 1 << 25
#: Bytes of a line after which a comparison looks whether it can still succeed.
COLUMNS = 64
#: Bytes up to which pairs of lines are compared TOGETHER, and lines of a bucket up to which its pairs wait for those of others.
TABLE, TOGETHER, WAITING = 4096, 256, 64
#: Diagonals after which a comparison of pairs TOGETHER looks which of them can still succeed.
DIAGONALS = 16
#: Tasks over which the copies of a line are dealt if it has more than COMMON; lines that a task remembers as seen, or as linked.
SALT, COMMON, SEEN = 8, 1024, 500_000
#: Keys go through the shuffle in chunks of at most CHUNKED that share a slot, of which there are SLOTS at least and four for each
#: partition; a task sorts its keys by slots once it has PACKED.
SLOTS, CHUNKED, PACKED = 4096, 256, 1 << 20
_KEYED = np.dtype([("key", "<i8"), ("h", "<i8"), ("size", "<i4")])

#: Normalised bytes: letters in lower case, digits as 0, bytes beyond ASCII as they are, and all else 32 (line feed: 10).
_TABLE = np.full(256, 32, np.uint8)
_TABLE[128:] = np.arange(128, 256)
for _x in b"abcdefghijklmnopqrstuvwxyz":
    _TABLE[_x] = _TABLE[_x - 32] = _x
for _x in b"0123456789":
    _TABLE[_x] = 48
_TABLE[10] = 10

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def normalised(raw: bytes) -> bytes:
    """A text's normalised form: words of letters, digit runs as one 0, and bytes beyond ASCII; line feeds stay."""
    text = raw.translate(_TABLE.tobytes())
    if b"00" not in text:
        return text
    flat = np.frombuffer(text, np.uint8)
    digit = flat == 48
    kept = np.ones(len(flat), bool)
    np.logical_and(digit[1:], digit[:-1], out=kept[1:])
    np.logical_not(kept[1:], out=kept[1:])
    return flat[kept].tobytes()


def _blocks(lines: int, line: np.ndarray, hashes: np.ndarray, n: int, shift: int, summed: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of features (line, hash): the lines' n blocks, how many distinct features are in each, and a sum over those if wanted.

    A block is the SimHash, of 32 bits, of the line's distinct features in it (0 if there are none). Blocks come as rows.
    """
    part = (hashes >> np.uint64(shift)).astype(np.uint32)
    part -= part // np.uint32(n) * np.uint32(n)
    rows = (line * n + part).view(np.uint64)
    rows <<= np.uint64(32)
    rows |= hashes & np.uint64(0xFFFFFFFF)
    rows.sort()
    rows = rows[np.concatenate(([True], rows[1:] != rows[:-1]))] if len(rows) else rows
    groups, held = (rows >> np.uint64(32)).astype(np.int64), np.zeros(lines * n, np.int64)
    blocks, sums = np.zeros(lines * n, np.uint64), np.zeros(lines * n, np.uint64)
    if len(rows):
        first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        count = np.diff(np.append(first, len(groups)))
        # Four numbers with eight counters of 8 bits each; groups are cut so that no counter runs over.
        bits = np.unpackbits(rows.astype(np.uint32).astype(">u4").view(np.uint8)).reshape(-1, 32).view(np.uint64)
        longest = int(count.max())
        cuts = np.sort(np.concatenate([first, *(first[count > k] + k for k in range(255, longest, 255))])) if longest > 255 else first
        ones = np.add.reduceat(bits, cuts, axis=0).view(np.uint8).reshape(-1, 32)
        if longest > 255:
            ones = np.add.reduceat(ones, np.searchsorted(cuts, first), axis=0, dtype=np.int32)
        at = groups[first]
        blocks[at] = np.packbits(ones > (count >> 1).astype(ones.dtype)[:, None]).view(">u4")  # in over half of them
        held[at] = count
        if summed:
            sums[at] = np.add.reduceat(_mixed((rows & np.uint64(0xFFFFFFFF)) + np.uint64(_BASE)), first)
    blocks, held, sums = (np.ascontiguousarray(x.reshape(lines, n).T) for x in (blocks, held, sums))
    return blocks, held, sums


def hashed_lines(raw: bytes, powers: np.ndarray, backs: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of the lines that have a word: number, hash and text of the normalised line."""
    text = np.frombuffer(normalised(raw), np.uint8)
    inside = np.zeros(len(text) + 2, bool)
    np.greater(text, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), pa.array([], pa.binary())
    upto = np.concatenate(([0], np.searchsorted(starts, np.flatnonzero(text == 10)), [len(starts)]))
    count = np.diff(upto)
    line = np.flatnonzero(count)
    first, count = upto[line], count[line]
    words = _word_hashes(text, starts, ends, powers, backs)
    place = (np.arange(1, len(starts) + 1) - np.repeat(first, count)).view(np.uint64)
    place *= np.uint64(_BASE)
    place += words
    whole = np.add.reduceat(_mixed(place), first)
    # The texts: words and the one byte after each, but for the last of a line.
    last = first + count - 1
    kept, inner = inside[1:], np.ones(len(ends), bool)
    inner[last] = False
    kept[ends[inner]] = True
    offsets = np.concatenate(([0], np.cumsum(np.add.reduceat(ends - starts, first) + count - 1))).astype(np.int32)
    texts = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(text[kept[:-1]])])
    return line, whole, texts


def _word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: np.ndarray, backs: np.ndarray) -> np.ndarray:
    """A hash of each word of `text`, whatever its place."""
    sums = np.empty(len(text) + 1, np.uint64)
    sums[0] = 0
    np.multiply(text, powers[: len(text)], out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    words = sums[ends]
    words -= sums[starts]
    words *= backs[starts]
    words += (ends - starts).view(np.uint64)
    return _mixed(words)


def _family(k: int) -> np.uint64:
    """What sets the keys of one kind apart from those of all others."""
    return np.uint64((k + 1) * _BASE & (1 << 64) - 1)


def _remainders(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """key, line: of each line of up to SHORT bytes, what is left without as many bytes as similar ones may have edits, and
    without fewer. Lines that are k edits apart have a rest in common, each without k bytes at most."""
    for size in range(4, SHORT + 1):
        at = np.flatnonzero(sizes == size)
        if not len(at):
            continue
        text = flat[begins[at][:, None] + np.arange(size)].astype(np.uint64) + np.uint64(1)
        for gone in range(size * round(100 - 100 * SIMILARITY) // 100 + 1):
            powers = _powers(_BASE, size - gone)
            for out in combinations(range(size), gone):
                left = np.delete(text, out, axis=1)
                yield _mixed((left * powers).sum(axis=1, dtype=np.uint64) + _family(101)), at


def line_keys(flat: np.ndarray, offsets: np.ndarray, powers: np.ndarray, backs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """key, line: the join keys of normalised lines, whose bytes are in `flat` from each offset to the next."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    inside = flat != 32
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    begin[offsets[:-1]] = end[offsets[1:] - 1] = True  # a line starts and ends with a word
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    count = np.diff(np.searchsorted(starts, offsets))
    line = np.repeat(np.arange(n), count)
    words = _word_hashes(flat, starts, ends, powers, backs)
    found = list(_remainders(flat, offsets[:-1], sizes))

    def by_pairs(kind: int, blocks: np.ndarray, held: np.ndarray, able: np.ndarray) -> None:
        for c, (i, j) in enumerate(CHOICES):
            at = np.flatnonzero(able & (held[i] + held[j] >= KEY_FEATURES))
            found.append(((blocks[j][at] << np.uint64(32) | blocks[i][at]) ^ _family(kind * len(CHOICES) + c), at))

    worded = (sizes >= WORDS_FROM)[line]
    blocks, held, _ = _blocks(n, line[worded], words[worded], BLOCKS, 40)
    distinct = held.sum(axis=0)
    by_pairs(0, blocks, held, distinct < PAIRED)
    # Pairs of bytes that are next to one another.
    few = np.repeat((sizes < PAIRS_BELOW) | (sizes > LONG_WORDS * count), sizes)
    few[offsets[1:] - 1] = False
    at = np.flatnonzero(few)
    pairs = _mixed((flat[at].astype(np.uint64) << np.uint64(8) | flat[np.minimum(at + 1, len(flat) - 1)]) + np.uint64(_BASE))
    blocks, held, _ = _blocks(n, np.repeat(np.arange(n), np.diff(np.searchsorted(at, offsets))), pairs, BLOCKS, 40)
    by_pairs(1, blocks, held, np.True_)
    # Blocks that are keys alone: the sum tells apart more of them than 32 bits can.
    many = (distinct >= SINGLE_FROM)[line]
    blocks, held, sums = _blocks(n, line[many], words[many], SINGLES, 33, summed=True)
    for b in range(SINGLES):
        at = np.flatnonzero(held[b] >= SINGLE_FEATURES)
        found.append(((blocks[b][at] << np.uint64(32) | sums[b][at] >> np.uint64(32)) ^ _family(2 * len(CHOICES) + b), at))
    key, at = (np.concatenate(x) for x in zip(*found, strict=True))
    return key.view(np.int64), at


def line_hashes(docs: DataFrame, id_col: str, text_col: str, row_col: str) -> DataFrame:
    """doc_id, file, at, line, h, text and fresh of each line that has a word in whole texts.

    A line is fresh unless its task has seen it: so a common line has few fresh copies. Those have their normalised text.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, backs, known = _powers(_BASE, CHUNK), _powers(_BACK, CHUNK), set()
        for batch in batches:
            raws = [x or b"" for x in batch.column(3).to_pylist()]
            done = 0
            while done < len(raws):
                upto, size = done + 1, len(raws[done]) + 1
                while upto < len(raws) and size + len(raws[upto]) < CHUNK:
                    size += len(raws[upto]) + 1
                    upto += 1
                if size > len(powers):
                    powers, backs = _powers(_BASE, size), _powers(_BACK, size)
                part = raws[done:upto]
                line, h, texts = hashed_lines(b"\n".join(part), powers, backs)
                begins = np.cumsum([0] + [x.count(b"\n") + 1 for x in part])
                owner = np.searchsorted(begins, line, side="right") - 1
                rows = pa.array(owner + done)
                ids = (batch.column(i).take(rows) for i in (0, 1, 2))
                if len(known) > SEEN:
                    known = set()
                fresh = np.array([x not in known and not known.add(x) for x in h.tolist()], bool)
                texts = texts.take(pa.array(np.where(fresh, np.arange(len(h)), 0), mask=~fresh))
                columns = [*ids, pa.array(line - begins[owner]), pa.array(h.view(np.int64)), texts, pa.array(fresh)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "at", "line", "h", "text", "fresh"])
                done = upto
            if len(powers) > 64 * CHUNK:  # after a very long text
                powers, backs = powers[:CHUNK].copy(), backs[:CHUNK].copy()

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    columns = f"doc_id {kind}, file long, at long, line long, h long, text binary, fresh boolean"
    row = F.col(row_col)
    wanted = docs.select(F.col(id_col).alias("doc_id"), row["file"].alias("file"), row["at"].alias("at"), F.col(text_col).cast("binary"))
    return wanted.mapInArrow(hashes, columns)


def keys_of_lines(lines: DataFrame) -> DataFrame:
    """slot and rows of fresh lines: chunks of keys of that slot, each with its line's h and size (_KEYED). All rows of a key are in one slot."""
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = np.uint64(max(SLOTS, 4 * partitions))

    def chunks(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        slot = (_mixed(rows["key"].view(np.uint64)) % slots).astype(np.int32)
        order = np.argsort(slot.astype(np.uint16) if slots <= 1 << 16 else slot, kind="stable")  # of 16 bits, by radix
        rows, slot = rows.take(order), slot[order]
        begins = np.union1d(np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1]))), np.arange(0, len(rows), CHUNKED))
        offsets = (np.append(begins, len(rows)) * _KEYED.itemsize).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(rows.view(np.uint8))])
        return pa.RecordBatch.from_arrays([pa.array(slot[begins]), packed], names=["slot", "rows"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, backs = _powers(_BASE, CHUNK), _powers(_BACK, CHUNK)
        found: list[np.ndarray] = []
        n = 0
        for batch in batches:
            h, texts = batch.column(0).to_numpy(), batch.column(1)
            _, offsets, flat = texts.buffers()
            offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            done = 0
            while done < len(texts):
                upto = max(done + 1, int(np.searchsorted(offsets, offsets[done] + CHUNK, side="right")) - 1)
                part = offsets[done : upto + 1]
                size = int(part[-1] - part[0])
                if size > len(powers):
                    powers, backs = _powers(_BASE, size), _powers(_BACK, size)
                key, at = line_keys(np.frombuffer(flat, np.uint8, size, int(part[0])), part - part[0], powers, backs)
                rows = np.empty(len(key), _KEYED)
                rows["key"], rows["h"], rows["size"] = key, h[at + done], np.diff(part)[at]
                found.append(rows)
                n += len(rows)
                if n >= PACKED:
                    yield chunks(found)
                    found, n = [], 0
                done = upto
            if len(powers) > 64 * CHUNK:  # after a very long line
                powers, backs = powers[:CHUNK].copy(), backs[:CHUNK].copy()
        if n:
            yield chunks(found)

    return lines.filter("fresh").select("h", "text").mapInArrow(keys, "slot int, rows binary")


def _within(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Whether lines of such sizes can have the edit similarity at all."""
    return 100 * small >= round(100 * SIMILARITY) * large


def line_buckets(keyed: DataFrame) -> DataFrame:
    """bucket, home, h: the lines that share a key, where some two of them are about as long; buckets of the same lines have
    the same number, and their least line as home. Lines of buckets above MEETING all come, with the key as number and home."""

    def out(bucket: np.ndarray, home: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(home), pa.array(h)], names=["bucket", "home", "h"])

    def close(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(rows["key"])
        key = rows["key"][order]
        same = key[1:] == key[:-1]
        shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
        if not shared.any():
            return
        rows, key = rows[order[shared]], key[shared]
        h, size = rows["h"], rows["size"]
        place = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1
        order = np.lexsort((h, size, place))
        place, h, size, key = place[order], h[order], size[order], key[order]
        once = np.concatenate(([True], (place[1:] != place[:-1]) | (h[1:] != h[:-1])))  # several tasks may have had a line
        place, h, size, key = place[once], h[once], size[once], key[once]
        begins = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        sizes = np.diff(np.append(begins, len(place)))
        near = (place[1:] == place[:-1]) & _within(size[:-1], size[1:])
        several = np.zeros(len(begins), bool)
        several[place[1:][near]] = True
        # A bucket's number is a sum over its lines.
        number = np.add.reduceat(_mixed(h.view(np.uint64) + np.uint64(_BASE)), begins).view(np.int64)
        home = np.minimum.reduceat(h, begins)
        kept = several[place] & (sizes[place] <= MEETING)
        if kept.any():
            yield out(number[place[kept]], home[place[kept]], h[kept])
        for k in np.flatnonzero(sizes > MEETING):
            own = slice(begins[k], begins[k] + sizes[k])
            yield out(key[own], key[own], h[own])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        large = np.zeros(0, np.int64)  # keys of this slot above MEETING, whose lines aren't held
        now, n, most = None, 0, PACKED
        for batch in batches:
            slots = batch.column(0).to_numpy()
            for slot, raw in zip(slots.tolist(), batch.column(1), strict=True):
                if slot != now:
                    if n >= PACKED // 8:  # of small slots several are taken together
                        yield from close(np.concatenate(held))
                        held, n = [], 0
                    now, large, most = slot, large[:0], PACKED
                rows = np.frombuffer(raw.as_buffer(), _KEYED)
                if len(large):
                    hit = np.isin(rows["key"], large)
                    if hit.any():
                        yield out(*(rows[x][hit] for x in ("key", "key", "h")))
                        rows = rows[~hit]
                held.append(rows)
                n += len(rows)
                if n > most:
                    rows = np.concatenate(held)
                    keys, counts = np.unique(rows["key"], return_counts=True)
                    large = np.concatenate((large, keys[counts > MEETING]))
                    hit = np.isin(rows["key"], large)
                    yield out(*(rows[x][hit] for x in ("key", "key", "h")))
                    held, n = [rows[~hit]], int((~hit).sum())
                    most = max(PACKED, 2 * n)
        if n:
            yield from close(np.concatenate(held))

    rows = keyed.repartition("slot").sortWithinPartitions("slot")
    return rows.mapInArrow(members, "bucket long, home long, h long").distinct()


def meetings(rows: DataFrame, by: str) -> DataFrame:
    """Deals the rows of each bucket over blocks of about MEETING, by column `by`: each block meets each in a (bucket, p, q)."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > MEETING)
    dealt = rows.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("n") / MEETING).cast("int")).withColumn("own", F.pmod(F.xxhash64(by), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    small = rows.join(sizes, "bucket", "left_anti").select("*", F.lit(0).alias("p"), F.lit(0).alias("q"))
    return small.unionByName(met.withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other")).drop("n", "blocks", "own", "other"))


def _replaced(a: list[bytes], b: list[bytes]) -> int:
    """Bytes to replace where a longest common subsequence of the words holds: not less than the edit distance.

    Bit i of a row is 0 where word i of `a` makes the subsequence longer, given the words of `b` so far.
    """
    at: dict[bytes, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    rows = [row]
    for x in b:
        common = row & at.get(x, 0)
        row = (row + common | row - common) & full
        rows.append(row)
    i, j, total, gone, come = len(a) - 1, len(b), 0, 0, 0
    while i >= 0 and j:
        if rows[j] >> i & 1:
            gone += len(a[i]) + 1
            i -= 1
        elif not rows[j - 1] >> i & 1:
            j -= 1
            come += len(b[j]) + 1
        else:  # words i and j - 1 are a pair
            total += max(gone, come)
            gone = come = 0
            i, j = i - 1, j - 1
    gone += sum(map(len, a[: i + 1])) + i + 1
    come += sum(map(len, b[:j])) + j
    return total + max(gone, come)


def _alone(a: list[bytes], b: list[bytes]) -> int:
    """Bytes of the words that only one side has, of that with more of them: _replaced is not less."""
    in_a, in_b = set(a), set(b)
    return max(sum([len(x) + 1 for x in a if x not in in_b]), sum([len(x) + 1 for x in b if x not in in_a]))


def _in_common(a: bytes, b: bytes) -> int:
    """How many bytes both start with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _told(a: bytes, b: bytes) -> bool | tuple[bytes, bytes, int]:
    """Whether the edit distance is at most 1 - SIMILARITY of the longer, or what is to be compared for that, and the most edits."""
    if len(a) < len(b):
        a, b = b, a
    most = len(a) - -(-len(a) * round(SIMILARITY * 100) // 100)
    if len(a) - len(b) > most:
        return False
    begin = _in_common(a, b)
    a, b = a[begin:], b[begin:]
    end = _in_common(a[::-1], b[::-1])
    a, b = a[: len(a) - end], b[: len(b) - end]
    if len(a) <= most:  # replacing what differs is enough
        return True
    if not b:
        return False
    words_a, words_b = a.split(b" "), b.split(b" ")
    if len(words_a) == len(words_b) and sum(max(len(x), len(y)) for x, y in zip(words_a, words_b) if x != y) <= most:
        return True
    if len(words_a) > 2 and _alone(words_a, words_b) <= most and _replaced(words_a, words_b) <= most:
        return True
    return a, b, most


def similar(a: bytes, b: bytes) -> bool:
    """Whether the edit distance is at most 1 - SIMILARITY of the longer."""
    told = _told(a, b)
    return told if isinstance(told, bool) else _within_edits(*told)


def _within_edits(a: bytes, b: bytes, most: int) -> bool:
    """Whether the edit distance of `a` and the shorter `b` is at most `most`; bit-parallel dynamic programming."""
    at: dict[int, int] = {}
    for i, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << i
    full, up, down, get = (1 << len(b)) - 1, (1 << len(b)) - 1, 0, at.get
    for begin in range(0, len(a), COLUMNS):
        for x in a[begin : begin + COLUMNS]:
            eq = get(x, 0)
            diagonal = (((eq & up) + up) ^ up) | eq | down
            more, less = (down | ~(diagonal | up) & full) << 1 | 1, (up & diagonal) << 1
            up, down = (less | ~(diagonal | more)) & full, more & diagonal & full
        done = min(begin + COLUMNS, len(a))
        if _beyond(up, down, done, len(b), len(a) - done, most):
            return False
    return len(a) + up.bit_count() - down.bit_count() <= most


def _beyond(up: int, down: int, done: int, size: int, rest: int, most: int) -> bool:
    """Whether no way through this column of distances, whose steps are `up` and `down`, ends within `most`.

    From row i at least as many edits follow as what is left of both texts differs in length. That sum changes by two from row to
    row at most, so every 16th row tells of those up to 8 rows away; rows further than `most` from the diagonal are beyond.
    """
    first, last = max(0, done - most), min(size, done + most)
    for i in (*range(first, last, 16), last):
        below = (1 << i) - 1
        if done + (up & below).bit_count() - (down & below).bit_count() + abs(size - i - rest) <= most + 16:
            return False
    return True


def _all_within_edits(pairs: list[tuple[bytes, bytes, int]]) -> list[bool]:
    """_within_edits of each of `pairs`, many at once: tables of distances by diagonals, only as far from the middle as edits allow."""
    out = [False] * len(pairs)
    long = [k for k, (a, _, _) in enumerate(pairs) if len(a) > TABLE]
    rest = sorted((k for k, (a, _, _) in enumerate(pairs) if len(a) <= TABLE), key=lambda k: len(pairs[k][0]))
    few = rest if len(rest) < TOGETHER // 8 else []
    for k in long + few:
        out[k] = _within_edits(*pairs[k])
    for begin in range(0, len(rest) if not few else 0, TOGETHER):
        part = rest[begin : begin + TOGETHER]
        for k, distance in zip(part, _distances([pairs[k] for k in part]).tolist()):
            out[k] = distance <= pairs[k][2]
    return out


def _distances(pairs: list[tuple[bytes, bytes, int]]) -> np.ndarray:
    """Edit distances of pairs up to TABLE bytes; those above what is allowed may come out larger."""
    first, second, most = np.array([len(a) for a, _, _ in pairs]), np.array([len(b) for _, b, _ in pairs]), np.array([x for _, _, x in pairs])
    n, m, width = int(first.max()), int(second.max()), int(most.max())
    down, back = np.zeros((n + 1, len(pairs)), np.uint8), np.ones((m + 1, len(pairs)), np.uint8)
    for k, (a, b, _) in enumerate(pairs):
        down[1 : len(a) + 1, k] = np.frombuffer(a, np.uint8)
        back[m - len(b) : m, k] = np.frombuffer(b, np.uint8)[::-1]
    far, ends, left = np.int16(4 * TABLE), first + second, np.arange(len(pairs))
    found = np.full(len(pairs), far, np.int64)
    # Of diagonal d, cell i (at i + 1) is the distance of the first i bytes of `a` and the first d - i of `b`.
    before, last, now = (np.full((n + 3, len(pairs)), far, np.int16) for _ in range(3))
    last[1] = 0
    stops, final = set(ends.tolist()), int(ends.max())
    for d in range(1, final + 1):
        lo, hi = max(0, d - m, (d - width + 1) // 2), min(n, d, (d + width) // 2)
        here, same = now[lo + 1 : hi + 2], before[lo : hi + 1]
        np.minimum(last[lo : hi + 1], last[lo + 1 : hi + 2], out=here)
        here += np.int16(1)
        same += down[lo : hi + 1] != back[m - d + lo : m - d + hi + 1]  # these cells aren't read again
        np.minimum(here, same, out=here)
        now[lo] = now[hi + 2] = far
        if d in stops:
            at = np.flatnonzero(ends == d)
            found[left[at]] = now[first[at] + 1, at]
        before, last, now = last, now, before
        if d % DIAGONALS == 0:
            # Each way to the end goes through a cell of one of two diagonals in turn, and no way gets shorter.
            least = np.minimum(last[lo + 1 : hi + 2].min(axis=0), before[max(0, lo - 1) + 1 : hi + 2].min(axis=0))
            open_ = np.flatnonzero((least <= most) & (ends > d))
            if not len(open_):
                break
            if 4 * len(open_) <= 3 * len(left):
                left, first, most, ends = left[open_], first[open_], most[open_], ends[open_]
                down, back, before, last, now = (x[:, open_] for x in (down, back, before, last, now))
    return found


def _filter_of(hashes: DataFrame) -> np.ndarray:
    """A bit for each hash `h`, by its last bits."""
    place = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = hashes.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    total = np.zeros(FILTER_BITS // 64, np.int64)
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    total[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return total


def among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose `h` is in `wanted` (h), once the filter of those has left what it can before the shuffle."""
    bits = rows.sparkSession.sparkContext.broadcast(_filter_of(wanted))
    place = rows.columns.index("h")

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(place).to_numpy()
            yield batch.filter(pa.array((bits.value[(h & (FILTER_BITS - 1)) >> 6] >> (h & 63) & 1).astype(bool)))

    return rows.mapInArrow(hits, rows.schema)


def _threes(texts: list[bytes]) -> np.ndarray:
    """How often each of 512 classes of runs of three bytes occurs in each text."""
    flat = np.frombuffer(b"".join(texts) + b"  ", np.uint8).astype(np.int64)
    sizes = np.array([len(x) for x in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    runs = (flat[:-2] * 31 + flat[1:-1]) * 31 + flat[2:] & 511
    inside = np.ones(len(owner), bool)
    for back in (1, 2):
        inside[np.maximum(np.cumsum(sizes) - back, 0)] = False
    return np.bincount(owner[inside] * 512 + runs[inside], minlength=512 * len(texts)).reshape(-1, 512).astype(np.int32)


def similar_links(texts: list[bytes], later: list[tuple[int, int, tuple[bytes, bytes, int]]] | None = None, linked: list[int] | None = None) -> list[tuple[int, int]]:
    """Links of a forest over the places of `texts` that connects all similar ones.

    An edit changes the size by at most one, and takes or adds at most three of the runs of three bytes; texts beyond
    that are not compared. With `later`, pairs of which that and their words don't tell go there instead, as places and what is to be
    compared; the links connect all similar ones together with those of them that are found similar. Texts with the same number in
    `linked` are connected already.
    """
    if len(texts) == 2:
        told = _told(*texts)
        if later is not None and not isinstance(told, bool):
            later.append((0, 1, told))
            return []
        return [(0, 1)] if told is True or told and _within_edits(*told) else []
    sizes, threes = np.array([len(x) for x in texts]), _threes(texts)
    before = None if linked is None else np.array(linked)
    left, todo, links, unsure, taken = np.arange(len(texts)), [], [], [], np.zeros(len(texts), bool)
    group = Linked()

    def settled() -> list[tuple[int, int]]:
        """Links of the pairs that are unsure and not connected yet, which then are."""
        open_ = [u for u in unsure if group.root(u[0]) != group.root(u[1])]
        unsure.clear()
        found = [(a, b) for (a, b, _), yes in zip(open_, _all_within_edits([t for _, _, t in open_])) if yes]
        for a, b in found:
            group.link(a, b)
        return found

    while len(left):
        if not todo:
            todo, left = [int(left[0])], left[1:]
            continue
        x = todo.pop()
        if before is not None:
            mates = before[left] == before[x]
            if mates.any():
                for i in left[mates].tolist():
                    group.link(x, i)
                    todo.append(i)
                left = left[~mates]
        most = np.maximum(sizes[left], sizes[x]) * round(100 - 100 * SIMILARITY) // 100
        close = np.abs(sizes[left] - sizes[x]) <= most
        able, most = left[close], most[close]
        common = np.minimum(threes[able], threes[x]).sum(axis=1)
        able = able[common >= np.maximum(sizes[able], sizes[x]) - 2 - 3 * most]
        near = []
        for i in able.tolist():
            if later is None and group.root(i) == group.root(x):
                continue
            told = _told(texts[i], texts[x])
            if told is True:
                near.append(i)
            elif told:
                unsure.append((x, i, told))
        links += [(x, i) for i in near]
        for i in near:
            group.link(x, i)
        if later is None and len(unsure) >= TOGETHER:
            found = settled()
            links += found
            near += [b for _, b in found if group.root(b) == group.root(x)]  # others are compared with what is left at their turn
        if near:
            taken[near] = True
            todo += left[taken[left]].tolist()
            left = left[~taken[left]]
    if later is None:
        links += settled()
    else:
        later += [u for u in unsure if group.root(u[0]) != group.root(u[1])]
    return links


class Linked:
    """What is connected by the links so far: a forest over names, of which each is a tree by itself at first."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def links_of_groups(groups: list[list[bytes]], names: list[list[int]] | None = None, linked: Linked | None = None) -> list[tuple[int, int, int]]:
    """group, place, place: links within each of `groups` that connect all similar texts. Small groups wait for what words don't tell,
    which is compared for all of them at once. With `names` of the texts, those that `linked` connects aren't compared again."""
    links, later = [], []
    linked = linked or Linked()
    for k, texts in enumerate(groups):
        roots = None if names is None else [linked.root(x) for x in names[k]]
        if roots and roots.count(roots[0]) == len(roots):
            continue
        unsure = [] if len(texts) <= WAITING else None
        found = similar_links(texts, unsure, roots)
        links += [(k, x, y) for x, y in found]
        if roots:
            for x, y in found:
                linked.link(roots[x], roots[y])
        later += [(k, *u) for u in unsure or ()]
    if names is not None:
        once = {}
        for k, x, y, told in later:
            a, b = names[k][x], names[k][y]
            if linked.root(a) != linked.root(b):
                once.setdefault((a, b) if a < b else (b, a), (k, x, y, told))
        later = list(once.values())
    more = [(k, x, y) for (k, x, y, _), yes in zip(later, _all_within_edits([u[3] for u in later])) if yes]
    if names is not None:
        for k, x, y in more:
            linked.link(names[k][x], names[k][y])
    return links + more


def similar_lines(lines: DataFrame) -> DataFrame:
    """Links (a, b) between hashes h of different normalised lines that connect all similar ones that share a key."""
    buckets = written(line_buckets(keys_of_lines(lines)), "buckets")
    wanted = buckets.select("h").distinct()
    fresh = among(lines.filter("fresh").select("h", "text"), wanted)
    texts = written(fresh.join(wanted, "h", "left_semi").groupBy("h").agg(F.min("text").alias("text")), "texts")
    # Buckets with the same least line go to one task, which then need not compare again what is linked already.
    met = meetings(buckets, "h").withColumn("meeting", F.xxhash64("bucket", "p", "q")).withColumn("deal", F.xxhash64("home", "p", "q")).join(texts, "h")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked = Linked()
        for table in whole_groups(batches):
            meeting, h, text = table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2).to_pylist()
            begins = np.flatnonzero(np.concatenate(([True], meeting[1:] != meeting[:-1])))
            spans = list(zip(begins.tolist(), np.append(begins[1:], len(h)).tolist()))
            names = h.tolist()
            if len(linked.up) > SEEN:
                linked = Linked()
            links = links_of_groups([text[i:j] for i, j in spans], [names[i:j] for i, j in spans], linked)
            found = [(h[begins[k] + x], h[begins[k] + y]) for k, x, y in links]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    dealt = met.select("meeting", "h", "text", "deal").repartition("deal").sortWithinPartitions("deal", "meeting")
    return dealt.mapInArrow(compared, "a long, b long")


def _removed(docs: DataFrame, id_col: str, text_col: str, row_col: str) -> DataFrame:
    """doc_id, file, at, removed: of each row of `docs`, which `row_col` tells, the numbers of its repeated lines."""
    lines = written(line_hashes(docs, id_col, text_col, row_col), "lines")
    place = F.struct("doc_id", "file", "at", "line")
    labels = written(components(similar_lines(lines)), "labels")
    # Only lines that others are like or that repeat matter further on (and a few that the filter lets pass, alone in their groups).
    wanted = lines.groupBy("h").count().filter("count > 1").select("h").union(labels.select("node"))
    light = written(among(lines.select("doc_id", "file", "at", "line", "h"), wanted), "light")
    firsts = light.groupBy("h").agg(F.min(place).alias("place"), F.count("*").alias("n"))
    grouped = written(firsts.join(labels, F.col("h") == F.col("node"), "left").select("h", "n", "place", F.coalesce("component", "h").alias("group")), "grouped")
    heads = grouped.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("lines"))
    named = grouped.join(heads, "group").filter("n > 1 or lines > 1").select("h", "n", "first")
    salts = F.when(F.col("n") > COMMON, F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))
    dealt = named.withColumn("salt", F.explode(salts)).drop("n")
    common = F.broadcast(grouped.filter(F.col("n") > COMMON).select("h", F.lit(True).alias("many")))  # at most one for COMMON lines
    own = F.when(F.col("many"), F.pmod(F.xxhash64("file", "at", "line"), F.lit(SALT)).cast("int")).otherwise(0)
    gone = light.join(common, "h", "left").withColumn("salt", own).join(dealt, ["h", "salt"]).filter(~place.eqNullSafe(F.col("first")))
    return gone.groupBy("file", "at").agg(F.min("doc_id").alias("doc_id"), F.array_sort(F.collect_list("line")).alias("removed"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, removed: the numbers (from 0) of the lines of each document that repeat an earlier line of the corpus.

    Lines are the parts between line feeds. Lines group by equal normalised form (ASCII case, punctuation and the
    digits of a number don't count; 64-bit hashes stand for it), whatever their length, or by edit similarity of 0.8 or
    more, directly or through others, if they share a key (see above; README: how many do). Of lines up to 14 bytes all
    similar ones do. The first of each group by doc_id, row and line number stays. Lines without a word stay. Documents without such lines
    have no row. Rows with a null id come first in that order; each row is a document of its own, also where rows share
    an id or are equal. Null and empty texts have no lines; other columns are ignored.
    """
    row, staged = numbered_rows(docs, "row_of_lines")
    return _removed(staged, id_col, text_col, row).select("doc_id", "removed")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with the repeated lines gone, and n_removed; see repeated_lines. A null text stays null.

    Where `docs` has a column n_removed, that stays and the new one is n_removed_.
    """
    key, removed, n_removed = free_names(docs, "key_of_lines", "removed_lines", "n_removed")
    row, staged = numbered_rows(docs, "row_of_lines")
    gone = written(_removed(staged, id_col, text_col, row).select(F.struct("file", "at").alias(key), F.col("removed").alias(removed)), "removed")
    # A broadcast of what is removed would grow with the input.
    joined = staged.hint("merge").join(gone, staged[row] == gone[key], "left")
    parts = F.split(F.col(text_col), "\n", -1)
    kept = F.array_join(F.filter(F.transform(parts, lambda x, i: F.when(~F.array_contains(removed, i.cast("long")), x)), lambda x: x.isNotNull()), "\n")
    text = F.when(F.col(removed).isNull(), F.col(text_col)).otherwise(kept)
    n = F.when(F.col(removed).isNull(), 0).otherwise(F.size(removed)).cast("long")
    return joined.withColumn(text_col, text).withColumn(n_removed, n).select(*all_columns(docs), n_removed)
