"""Scores texts by a class-based bigram model: words in classes by exchange, transitions between classes, words from classes.

    P(w | v) = P(class of w | class of v) * P(w | class of w)

Words of training documents are counted, all of them. The most frequent (`leaders`) are clustered by the exchange algorithm on
their bigram counts over the whole corpus: each word in turn moves to the class that raises the corpus's likelihood most, until
no word moves. Every other word that is seen at least `least` times then joins the class that makes the most of its own
neighbours, over all of the corpus again. Rarer words share one class with words never seen, and the end of a text, which is
also what comes before its first word, is a class of its own. Of the rare class Good and Turing's estimate goes to what was
never seen, so the probabilities of all known words, of the end and of anything unknown sum to one in every context.

Texts are read twice (counts, then numbers of words, which are written); all later passes read the numbers. What tasks hold is
bounded by parameters: `residents` words at most are known to every task (24 bytes each), others are counted and met by a
shuffle join, with the words of each text that are not resident.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered_rows, written

#: The end of a text, which no word can be.
END = b"\n"
SLICE, TOKENS, WORDS = 1 << 20, 1 << 20, 1 << 19
_SPACE = regex.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Settings:
    """residents: words that every task knows, the most frequent. leaders: those that exchange moves one by one. classes:
    of exchange. rounds: of exchange, at most. least: words seen less often are the rare class. backing: how many
    transitions of any class count as drawn from the classes' own frequencies."""

    residents: int = 1 << 21
    leaders: int = 1 << 11
    classes: int = 64
    rounds: int = 20
    least: int = 2
    backing: float = 2.0


def pieces(raw: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text in lower case, a slice of it at a time; at least one list, which may be empty."""
    raw = raw or b""
    if len(raw) <= SLICE:
        yield raw.lower().split()
        return
    start = 0
    while start < len(raw):
        cut = _SPACE.search(raw, min(start + SLICE, len(raw)))
        stop = cut.start() if cut else len(raw)
        yield raw[start:stop].lower().split()
        start = stop


def learnt_from(doc_id: Column) -> Column:
    """True for the nine tenths of the documents that the model learns from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 != 0, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """word (binary), n over the texts of `docs` (text), the end of each among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            columns = [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        seen: Counter[bytes] = Counter()
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()):
                for words in pieces(raw.as_py()):
                    seen.update(words)
                    if len(seen) > WORDS:
                        yield out()
                seen[END] += 1
        yield out()

    counts = docs.select("text").mapInArrow(count, "word binary, n long")
    return written(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")


@dataclass
class Lexicon:
    """What every task knows: the residents' hashes in order and their counts, and sums over all words.

    A word's number is its place among the hashes; `rare` stands for all others, `end` for the end of a text.
    """

    hashes: np.ndarray
    counts: np.ndarray
    threshold: int
    total: int
    distinct: int
    ends: int
    rare_total: int
    unseen: float

    @property
    def rare(self) -> int:
        return len(self.hashes)

    @property
    def end(self) -> int:
        return len(self.hashes) + 1

    def numbers(self, words: list[bytes]) -> np.ndarray:
        own = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words)).view(np.int64)
        if not len(self.hashes):
            return np.zeros(len(words), np.int32)
        at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        return np.where(self.hashes[at] == own, at, self.rare).astype(np.int32)

    @staticmethod
    def of(counts: DataFrame, settings: Settings) -> Lexicon:
        """The residents are the words with at least `threshold` counts, a power of two that leaves few enough of them."""
        steps = [1 << k for k in range(48)]
        words = counts.filter(F.col("word") != END)
        row = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), *(F.count(F.when(F.col("n") >= t, 1)).alias(f"_{t}") for t in steps)).first()
        threshold = next(t for t in steps if t >= settings.least and row[f"_{t}"] <= settings.residents)
        ends = counts.filter(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        mass = words.agg(*(F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) for c in (F.col("n") < threshold, F.col("n") == threshold, F.col("n") == 1))).first()
        found = words.filter(F.col("n") >= threshold).select(F.xxhash64("word").alias("hash"), "n").toArrow()  # `residents` rows at most
        hashes, own = (found.column(c).to_numpy() for c in ("hash", "n"))
        order = np.argsort(hashes, kind="stable")
        # A token that is left out has been seen once less: those of words seen once are what a new text has of unseen words,
        # and words seen `threshold` times would be rare. So the rare class is as large as its words and those of the threshold.
        rare = mass[0] + mass[1]
        return Lexicon(hashes[order], own[order], threshold, row.n + ends, row.v + (ends > 0), ends, int(mass[0]), (mass[2] + 0.5) / (rare + 1))

    @property
    def rare_growth(self) -> float:
        """How much of the rare class there is in new texts for each rare token of those learnt from."""
        at = int(self.counts[self.counts == self.threshold].sum())
        return (self.rare_total + at + 1) / (self.rare_total + 1)


def numbered_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The texts of `docs` as numbers of words, written to the shared folder: file, at (the row), doc_id, learn, ids (what comes
    before the piece, then its words, 4 bytes each), missed and times (words that are no residents, and how often).

    A long text is several rows, of which the last has the end of the text.
    """
    row, rows = numbered_rows(docs, "row")
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        kinds: pa.Schema | None = None

        def flush() -> pa.RecordBatch:
            nonlocal before
            words = list(local)
            ids = known.numbers(words)
            columns: list[list] = [[] for _ in range(7)]
            for meta, first, last, idx in held:
                own = ids[idx]
                gone, times = np.unique(idx[own == known.rare], return_counts=True)
                before = known.end if first else before
                line = np.concatenate(([before], own, [known.end] if last else [])).astype(np.int32)
                before = int(line[-1])
                for column, x in zip(columns, (*meta, line.tobytes(), [words[g] for g in gone], times.tolist()), strict=True):
                    column.append(x)
            held.clear()
            local.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k.type) for x, k in zip(columns, kinds, strict=True)], names=kinds.names)

        held: list[tuple] = []
        local = _Places()
        before, size = known.end, 0
        for batch in batches:
            kinds = pa.schema([*list(batch.schema)[:4], ("ids", pa.binary()), ("missed", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))])
            metas = zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)
            for meta, raw in zip(metas, batch.column(4).cast(pa.binary()), strict=True):
                first, waiting = True, None
                for words in pieces(raw.as_py()):
                    if waiting is not None:
                        held.append((meta, first, False, waiting))
                        first = False
                        if size >= TOKENS:
                            yield flush()
                            size = 0
                    waiting = np.fromiter(map(local.__getitem__, words), np.int64, len(words)) if words else np.zeros(0, np.int64)
                    size += len(words)
                held.append((meta, first, True, waiting))
                if size >= TOKENS:
                    yield flush()
                    size = 0
            if held:
                yield flush()
                size = 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = rows.select(F.col(f"{row}.file").alias("file"), F.col(f"{row}.at").alias("at"), "doc_id", learnt_from(F.col("doc_id")).alias("learn"), "text")
    return written(narrow.mapInArrow(number, f"file long, at long, doc_id {kind}, learn boolean, ids binary, missed array<binary>, times array<int>"), "numbers")


class _Places(dict):
    """Words by the order in which they were met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All neighbours within the pieces of a batch."""
    lines = [np.frombuffer(x.as_buffer(), np.int32) for x in column]
    if not lines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.concatenate(lines).astype(np.int64)
    inside = np.ones(len(flat), bool)
    inside[np.cumsum([len(x) for x in lines]) - 1] = False
    return flat[:-1][inside[:-1]], flat[1:][inside[:-1]]


def _packed(part: int, keys: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted keys by their differences, and counts, both compressed."""
    gaps = np.diff(keys, prepend=0)
    return part, zlib.compress(gaps.astype(np.int64).tobytes(), 1), zlib.compress(counts.astype(np.int64).tobytes(), 1)


def counted_keys(numbers: DataFrame, keys: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int, parts: int) -> DataFrame:
    """part, keys, counts: how often `keys` of neighbours occurs in texts to learn from, by parts of `width` keys.

    Tasks count what they read, then each part is added up from one blob a task after the other, in an array of `width`.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            found, n = _merged(held)
            held.clear()
            cuts = np.searchsorted(found, np.arange(parts + 1) * width)
            rows = [_packed(p, found[lo:hi], n[lo:hi]) for p, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if lo < hi]
            return pa.RecordBatch.from_pylist([dict(zip(("part", "keys", "counts"), r, strict=True)) for r in rows], schema=blobs)

        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            left, right = _pairs(batch.column(0))
            if len(left):
                held.append(np.unique(keys(left, right), return_counts=True))
                size += len(held[-1][0])
            if size > 8 * TOKENS:
                yield out()
                size = 0
        yield out()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                total = sums.setdefault(r["part"], np.zeros(width, np.int64))
                total[np.cumsum(np.frombuffer(zlib.decompress(r["keys"]), np.int64)) - r["part"] * width] += np.frombuffer(zlib.decompress(r["counts"]), np.int64)
        for part, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "keys", "counts"), _packed(part, at + part * width, total[at]), strict=True))], schema=blobs)

    blobs, kinds = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]), "part int, keys binary, counts binary"
    each = numbers.filter("learn").select("ids").mapInArrow(count, kinds)
    return each.repartition(max(1, min(parts, 64)), "part").mapInArrow(add, kinds)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return found, np.bincount(where, weights=np.concatenate([n for _, n in held]), minlength=len(found)).astype(np.int64)


def _gathered(counts: DataFrame, size: int) -> np.ndarray:
    """An array of `size` counts from the parts; `size` is bounded by the settings."""
    out = np.zeros(size, np.int64)
    for r in counts.toLocalIterator():
        out[np.cumsum(np.frombuffer(zlib.decompress(r["keys"]), np.int64))] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(between: np.ndarray) -> float:
    """Of the bigrams under their classes, up to what no assignment changes; `between` counts classes by classes."""
    return float(_xlogx(between).sum() - _xlogx(between.sum(axis=1)).sum() - _xlogx(between.sum(axis=0)).sum())


def between_classes(bigrams: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    rows = np.zeros((size, bigrams.shape[1]))
    np.add.at(rows, of, bigrams)
    out = np.zeros((size, size))
    np.add.at(out.T, of, rows.T)
    return out


def exchange(bigrams: np.ndarray, movable: int, classes: int, rounds: int) -> np.ndarray:
    """The class of each row of `bigrams` (counts of neighbours), of which the first `movable` may move; the others are classes
    of their own, after the first `classes`. Rows are in descending order of frequency.

    Each word is taken out of its class and put where the likelihood is highest, its own class on a tie; a round visits all
    words, and the rounds end when no word moves. The likelihood never falls.
    """
    fixed = len(bigrams) - movable
    size = classes + fixed
    of = np.concatenate([np.arange(movable) % classes, classes + np.arange(fixed)])
    after = bigrams.astype(np.float64)
    onto, between, both = np.ascontiguousarray(after.T), between_classes(after, of, size), np.arange(classes)
    terms, firsts, seconds = _xlogx(between), between.sum(axis=1), between.sum(axis=0)

    def change(k: int, sign: int, right: np.ndarray, left: np.ndarray, itself: float) -> None:
        """Puts a word with these neighbours into class k, or takes it out."""
        between[k] += sign * right
        between[:, k] += sign * left
        between[k, k] += sign * itself
        firsts[:] += sign * left
        firsts[k] += sign * (right.sum() + itself)
        seconds[:] += sign * right
        seconds[k] += sign * (left.sum() + itself)
        terms[k], terms[:, k] = _xlogx(between[k]), _xlogx(between[:, k])

    for _ in range(rounds):
        moved = 0
        for w in range(movable):
            own, itself = of[w], after[w, w]
            right = np.bincount(of, weights=after[w], minlength=size)
            left = np.bincount(of, weights=onto[w], minlength=size)
            right[own] -= itself
            left[own] -= itself
            change(own, -1, right, left, itself)
            r, l = np.flatnonzero(right), np.flatnonzero(left)
            gain = (_xlogx(between[:classes, r] + right[r]) - terms[:classes, r]).sum(axis=1)
            gain += (_xlogx(between[l, :classes] + left[l, None]) - terms[l, :classes]).sum(axis=0)
            middle, x, y = between[both, both], right[:classes], left[:classes]
            gain += _xlogx(middle + x + y + itself) - _xlogx(middle + x) - _xlogx(middle + y) + _xlogx(middle)
            # Wherever the word goes, its neighbours' sums get it back; its own class gets its own occurrences.
            for sums, n in ((firsts + left, right.sum() + itself), (seconds + right, left.sum() + itself)):
                gain -= _xlogx(sums[:classes] + n) - _xlogx(sums[:classes])
            best = int(np.argmax(gain))
            best = own if gain[best] <= gain[own] + 1e-9 * abs(gain[own]) else best
            change(best, 1, right, left, itself)
            of[w] = best
            moved += best != own
        if not moved:
            break
    return of


@dataclass
class ClassModel:
    """log10 of transitions (classes by classes) and of a resident's share of its class; `of` is the class of each number."""

    of: np.ndarray
    transitions: np.ndarray
    emissions: np.ndarray

    @staticmethod
    def fit(lexicon: Lexicon, of: np.ndarray, between: np.ndarray, backing: float) -> ClassModel:
        """`between` counts transitions; the last two classes are the rare words and the end.

        Transitions back off to the classes' own frequencies, those of a class without words being none of any.
        """
        counts = between.astype(np.float64)
        counts[:, -2] *= lexicon.rare_growth
        used = np.bincount(of, minlength=len(counts)) > 0
        own = np.where(used, counts.sum(axis=0) + 0.5, 0.0)
        own /= own.sum()
        smooth = (counts + backing * own) / (counts.sum(axis=1, keepdims=True) + backing)
        emissions = np.zeros(len(of))
        words = np.bincount(of[:-2], weights=lexicon.counts, minlength=len(counts))
        emissions[:-2] = np.log10(lexicon.counts / words[of[:-2]])
        with np.errstate(divide="ignore"):
            return ClassModel(of, np.log10(smooth), emissions)


def classes_of(numbers: DataFrame, lexicon: Lexicon, settings: Settings) -> np.ndarray:
    """The class of each number: leaders by exchange, the other residents where their neighbours fit best."""
    n, classes = len(lexicon.hashes), settings.classes
    leaders = np.lexsort((lexicon.hashes, -lexicon.counts))[: settings.leaders]
    m = len(leaders)
    lead = np.full(n + 2, m, np.int64)  # a leader's rank, then: another resident, rare, end
    lead[leaders] = np.arange(m)
    lead[lexicon.rare], lead[lexicon.end] = m + 1, m + 2
    side = m + 3
    spark = numbers.sparkSession
    shared = spark.sparkContext.broadcast(lead)
    rows = 128
    counted = counted_keys(numbers, lambda a, b: shared.value[a] * side + shared.value[b], rows * side, -(-side // rows))
    of_lead = exchange(_gathered(counted, side * side).reshape(side, side), m, classes, settings.rounds)
    of = of_lead[lead]
    others = np.flatnonzero(lead[:n] == m)
    of[lexicon.rare], of[lexicon.end] = classes, classes + 1
    of[others] = -1
    if not len(others):
        return of
    # What is known of a class from leaders: how it goes with classes on either side.
    bigrams = _gathered(counted_keys(numbers, _by_class(spark, of, classes), (classes + 2) ** 2, 1), (classes + 2) ** 2).reshape(classes + 2, classes + 2) + 0.1
    near = np.log(bigrams / bigrams.sum(axis=1, keepdims=True))
    before = np.log(bigrams / bigrams.sum(axis=0, keepdims=True))
    size = 2 * (classes + 2)
    given = spark.sparkContext.broadcast((of, near, before, classes))
    width = size << 12

    def neighbours(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        own, *_ = given.value
        left, right = own[a], own[b]
        following = (left < 0) & (right >= 0)
        preceding = (right < 0) & (left >= 0)
        return np.concatenate((a[following] * size + right[following], b[preceding] * size + classes + 2 + left[preceding]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, near, before, k = given.value
        for batch in batches:
            for r in batch.to_pylist():
                at = np.cumsum(np.frombuffer(zlib.decompress(r["keys"]), np.int64))
                words, row = np.unique(at // size, return_inverse=True)
                seen = np.zeros((len(words), size))
                seen[row, at % size] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
                fit = seen[:, : k + 2] @ near[:k].T + seen[:, k + 2 :] @ before[:, :k]
                best = fit.argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([words.astype(np.int32).tobytes()], pa.binary()), pa.array([best.astype(np.int16).tobytes()], pa.binary())], names=["words", "classes"])

    placed = counted_keys(numbers, neighbours, width, -(-n * size // width)).mapInArrow(place, "words binary, classes binary")
    of[others] = 0  # a word without any neighbour that has a class
    for r in placed.toLocalIterator():  # six bytes for each resident
        of[np.frombuffer(r.words, np.int32)] = np.frombuffer(r.classes, np.int16)
    return of


def _by_class(spark, of: np.ndarray, classes: int):  # noqa: ANN001, ANN202
    shared, side = spark.sparkContext.broadcast(of), classes + 2

    def keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, right = shared.value[a], shared.value[b]
        known = (left >= 0) & (right >= 0)
        return left[known] * side + right[known]

    return keys


def fitted(numbers: DataFrame, lexicon: Lexicon, settings: Settings) -> ClassModel:
    of, side = classes_of(numbers, lexicon, settings), settings.classes + 2
    between = _gathered(counted_keys(numbers, _by_class(numbers.sparkSession, of, settings.classes), side * side, 1), side * side)
    return ClassModel.fit(lexicon, of, between.reshape(side, side), settings.backing)


def rare_emission(n: Column, lexicon: Lexicon) -> Column:
    """log10 of a rare word's share of the rare class, by how often it was seen; an unseen word has what is left."""
    shares = (1 - lexicon.unseen) / max(1, lexicon.rare_total)
    return F.when(n > 0, F.log10(n * F.lit(shares))).otherwise(float(np.log10(lexicon.unseen if lexicon.rare_total else 1.0)))


def scored(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The model's log10 probability of every whole text of `docs` (doc_id, text), beside that of smoothed word frequencies.

    Learns from texts whose crc32 of doc_id as text, mod 10, is not 0. Tokens are the words in lower case (A-Z) and the end
    of the text. Returns for each row: doc_id, held_out, n_tokens, n_known (tokens that texts learnt from hold), train_tokens,
    base_score (each token's log10((c + 0.1) / (N + 0.1 (V + 1)))), score, and perplexity, 10^(-score / n_tokens).

    A null or empty text has one token, its end. A row without an id is scored, not held out and not learnt from; repeated
    rows are texts each; other columns are ignored. Where there is nothing to learn from, all tokens are unknown.
    """
    counts = word_counts(docs.filter(learnt_from(F.col("doc_id"))))
    lexicon = Lexicon.of(counts, settings)
    numbers = numbered_texts(docs, lexicon)
    model = fitted(numbers, lexicon, settings)
    floor = lexicon.total + 0.1 * (lexicon.distinct + 1)
    base = np.log10((np.concatenate((lexicon.counts, [0, lexicon.ends])) + 0.1) / floor)
    base[lexicon.rare] = 0.0  # what a rare word has of either score comes from the join
    known = np.ones(len(base))
    known[lexicon.rare], known[lexicon.end] = 0, lexicon.ends > 0
    shared = docs.sparkSession.sparkContext.broadcast((model, base, known))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, base, known = shared.value
        for batch in batches:
            out = []
            for x in batch.column(3):
                ids = np.frombuffer(x.as_buffer(), np.int32)
                of, own = fit.of[ids], ids[1:]
                out.append((len(own), int(known[own].sum()), float(base[own].sum()), float(fit.transitions[of[:-1], of[1:]].sum() + fit.emissions[own].sum())))
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [()] * 4, (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), *columns], names=["file", "at", "doc_id", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    near = numbers.select("file", "at", "doc_id", "ids").mapInArrow(score, f"file long, at long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    missed = numbers.select("file", "at", F.inline(F.arrays_zip("missed", "times"))).select("file", "at", F.col("missed").alias("word"), "times")
    met = missed.join(counts.filter(F.col("n") < lexicon.threshold), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    tail = met.select(
        "file", "at", F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).cast("long").alias("n_known"),
        (F.col("times") * F.log10((F.col("n") + 0.1) / F.lit(floor))).alias("base_score"),
        (F.col("times") * rare_emission(F.col("n"), lexicon)).alias("score"),
    )
    sums = ("n_tokens", "n_known", "base_score", "score")
    rows = near.unionByName(tail).groupBy("file", "at").agg(F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in sums))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return rows.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(lexicon.total).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
