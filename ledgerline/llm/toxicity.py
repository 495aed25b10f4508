"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words hash to embeddings. Filters of several widths slide over the words of a text, each takes its largest response
(max pooling), and a logistic layer scores those. Afterwards the logit's zero point is moved for each language: a text's
language is that of its most frequent function words, so that nothing but the text goes into a score, and the threshold
is the one at which the language's training texts are split best. 0.5 is then the threshold for every language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out

BUCKETS, DIM, FILTERS = 1 << 15, 8, 8
WIDTHS = (1, 2, 3)
#: A word's embedding is the sum of those of the hashes of the word and of its first bytes, so many of them.
PREFIXES = (3, 4, 5)
PARTS = 1 + len(PREFIXES)
#: Buckets that fewer texts to learn from hold stay at zero: what is seen so rarely would only be learned by heart.
LEAST_TEXTS = 4
#: Passes over the sample, and parts of it of which one is left out in turn for the calibration; at every size.
EPOCHS, FOLDS = 3, 3
#: What a marked text that is missed costs, where one that isn't marked and is taken for one costs 1.
MISS = 2
#: Distinct words that a worker remembers before it starts anew.
MEMORY = 150_000
#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in that is was for with on as at by this are be from",
    "de": "der die das und ist nicht von zu den mit sich auf ein eine im für dem des",
    "fr": "le la les de des et un une est que qui dans pour pas sur au par du",
    "es": "el los las del y que en un una por con para se su es al lo como",
}
_LANGUAGE_OF = {w.encode(): k for k, words in enumerate(FUNCTION_WORDS.values()) for w in words.split()}
_EDGES = bytes(x for x in range(33, 127) if not chr(x).isalnum())


class Words:
    """Numbers for the words of texts; ids has the PARTS buckets of each, lang the number of its language."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros((1024, PARTS), np.int64)
        self.lang = np.zeros(1024, np.int64)

    def number(self, raw: bytes | None) -> np.ndarray:
        """The numbers of a text's words (in ASCII lower case)."""
        words = (raw or b"").lower().split()
        place = self.place
        for w in words:
            if w not in place:
                k = place[w] = len(place)
                if k == len(self.lang):
                    self.ids, self.lang = np.concatenate((self.ids, self.ids)), np.concatenate((self.lang, self.lang))
                bare = w.strip(_EDGES)
                self.lang[k] = _LANGUAGE_OF.get(bare, len(FUNCTION_WORDS))
                self.ids[k] = [xxhash.xxh32_intdigest(x, seed) % BUCKETS for seed, x in enumerate((bare, *(bare[:n] for n in PREFIXES)))]
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))

    def language(self, numbers: np.ndarray) -> int:
        """The language with the most function words, or len(FUNCTION_WORDS)."""
        seen = np.bincount(self.lang[numbers], minlength=len(FUNCTION_WORDS) + 1)[:-1]
        return int(seen.argmax()) if seen.any() else len(FUNCTION_WORDS)


@dataclass
class TextCNN:
    embed: np.ndarray  #: BUCKETS + 1 rows; the last pads texts to the widest filter.
    kernels: list[np.ndarray]  #: by width: (width, DIM, FILTERS)
    bias: np.ndarray
    weight: np.ndarray
    base: float
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS) + 1))

    @staticmethod
    def fresh(seed: int = 1) -> TextCNN:
        rng = np.random.default_rng(seed)
        embed = rng.normal(0, 0.3, (BUCKETS + 1, DIM)).astype(np.float32)
        embed[-1] = 0
        kernels = [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return TextCNN(embed, kernels, np.zeros(n, np.float32), rng.normal(0, 0.5, n).astype(np.float32), 0.0)

    def responses(self, ids: np.ndarray) -> np.ndarray:
        """What each word (a row of buckets) adds to each filter at each place: (words, sum of widths, FILTERS)."""
        embedded = self.embed[ids].sum(axis=1)
        return np.stack([embedded @ kernel[j] for kernel in self.kernels for j in range(len(kernel))], axis=1)

    def pooled(self, responses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter over a text, and where it begins; words beyond the end add nothing."""
        n, top, places, column = max(1, len(responses)), [], [], 0
        for width in WIDTHS:
            total = np.zeros((n, FILTERS), np.float32)
            for j in range(width):
                total[: len(responses) - j if len(responses) > j else 0] += responses[j:, column]
                column += 1
            at = total.argmax(axis=0)
            top.append(total[at, np.arange(FILTERS)])
            places.append(at)
        return np.concatenate(top), np.concatenate(places)

    def logit(self, responses: np.ndarray) -> float:
        return float(np.maximum(self.pooled(responses)[0] + self.bias, 0) @ self.weight + self.base)

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = 12, rate: float = 0.05, seed: int = 2) -> None:
        """Stochastic gradient descent with AdaGrad steps; both classes weigh alike."""
        rng = np.random.default_rng(seed)
        holds = np.zeros((2, BUCKETS + 1), np.int64)
        for ids, label in zip(texts, labels, strict=True):
            holds[label, np.unique(ids)] += 1
        rare = holds.sum(axis=0) < LEAST_TEXTS
        # Embeddings start from how much more of the marked texts hold the bucket, in standard errors beyond four.
        n0, n1 = max(1, int((labels == 0).sum())), max(1, int((labels == 1).sum()))
        mean = holds.sum(axis=0) / (n0 + n1)
        excess = (holds[1] / n1 - holds[0] / n0) / np.sqrt(np.maximum(mean * (1 - mean), 1e-9) * (1 / n0 + 1 / n1))
        self.embed *= 0.1
        self.embed[:, 0] = np.clip(np.abs(excess) - 4, 0, 8) * np.sign(excess) / 4
        self.embed[rare] = 0
        share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
        weigh = {1: 0.5 / share, 0: 0.5 / (1 - share)}
        squares = [np.full_like(x, 1e-2) for x in (self.embed, *self.kernels, self.bias, self.weight)]
        base_square = 1e-2
        for _ in range(epochs):
            for i in rng.permutation(len(texts)):
                ids, label = texts[i], int(labels[i])
                top, places = self.pooled(self.responses(ids))
                hidden = np.maximum(top + self.bias, 0)
                score = 1 / (1 + np.exp(-np.clip(hidden @ self.weight + self.base, -30, 30)))
                slope = (score - label) * weigh[label]
                if abs(slope) < 1e-3:
                    continue
                back = slope * self.weight * (hidden > 0)
                self._step(self.weight, squares[-1], slope * hidden, rate)
                self._step(self.bias, squares[-2], back, rate)
                base_square += slope * slope
                self.base -= rate * slope / np.sqrt(base_square)
                padded = np.concatenate((ids, np.full((max(WIDTHS), PARTS), BUCKETS)))
                for k, width in enumerate(WIDTHS):
                    part = slice(k * FILTERS, (k + 1) * FILTERS)
                    g, at = back[part], places[part]
                    for j in range(width):
                        rows = padded[at + j]
                        grad_rows = np.repeat((self.kernels[k][j] * g).T, PARTS, axis=0)
                        self._step(self.kernels[k][j], squares[1 + k][j], self.embed[rows].sum(axis=1).T * g, rate)
                        flat = rows.ravel()
                        real = ~rare[flat]
                        np.add.at(squares[0], flat[real], grad_rows[real] ** 2)
                        np.add.at(self.embed, flat[real], -rate * grad_rows[real] / np.sqrt(squares[0][flat[real]]))

    @staticmethod
    def _step(value: np.ndarray, square: np.ndarray, grad: np.ndarray, rate: float) -> None:
        square += grad * grad
        value -= rate * grad / np.sqrt(square)

    def calibrate(self, logits: np.ndarray, languages: np.ndarray, labels: np.ndarray, least: int = 20) -> None:
        """Moves each language's zero point to where errors cost least; one with few texts of a class has the common point."""
        whole = best_split(logits, labels)
        for k in range(len(self.offsets)):
            here = languages == k
            enough = min((labels[here] == 0).sum(), (labels[here] == 1).sum()) >= least
            self.offsets[k] = best_split(logits[here], labels[here]) if enough else whole


def best_split(logits: np.ndarray, labels: np.ndarray) -> float:
    """The threshold with the least cost of errors; of several, the middle of the widest gap."""
    if not len(logits) or labels.min() == labels.max():
        return 0.0
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    errors = MISS * np.concatenate(([0], np.cumsum(y == 1))) + (y == 0).sum() - np.concatenate(([0], np.cumsum(y == 0)))
    low, high = np.concatenate(([x[0] - 1], x)), np.concatenate((x, [x[-1] + 1]))
    apart = high > low
    good = np.flatnonzero(apart & (errors == errors[apart].min()))
    widest = good[np.argmax(high[good] - low[good])]
    return float((low[widest] + high[widest]) / 2)


def learned(raws: list[bytes | None], y: np.ndarray, epochs: int = EPOCHS) -> TextCNN:
    """A classifier of texts with labels `y` (both classes occur), its thresholds calibrated by language.

    The logits that the thresholds are set by come from classifiers of FOLDS - 1 of FOLDS parts, each of the texts that it
    hasn't seen, scaled to the spread that the classifier of all texts has on average: that of the folds' own texts.
    """
    words = Words()
    numbers = [words.number(raw) for raw in raws]
    languages = np.array([words.language(x) for x in numbers])
    texts = [words.ids[x] for x in numbers]

    def fitted(rows: np.ndarray) -> TextCNN:
        model = TextCNN.fresh()
        model.fit([texts[i] for i in rows], y[rows], epochs=epochs)
        return model

    def logits_of(model: TextCNN, rows: np.ndarray) -> np.ndarray:
        responses = model.responses(words.ids[: len(words.place)])
        return np.array([model.logit(responses[numbers[i]]) for i in rows])

    logits, seen, fold, spread = np.zeros(len(y)), np.zeros(len(y), bool), np.zeros(len(y), np.int64), []
    for label in (0, 1):
        fold[y == label] = np.arange((y == label).sum()) % FOLDS
    for k in range(FOLDS):
        rows, unseen = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(unseen) and len(set(y[rows].tolist())) == 2:
            other = fitted(rows)
            logits[unseen], seen[unseen] = logits_of(other, unseen), True
            spread.append(np.abs(logits_of(other, rows)).mean())
    everything = np.arange(len(y))
    model = fitted(everything)
    scale = np.abs(logits_of(model, everything)).mean() / max(float(np.mean(spread)), 1e-9) if spread else 1.0
    if seen.any():  # else there are too few texts to leave any out, and the zero point stays
        model.calibrate(logits[seen] * scale, languages[seen], y[seen])
    return model


def trained(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000) -> TextCNN | None:
    """A classifier learned from at most `sample_rows` labelled documents that aren't held out; None without both classes.

    The sample holds the labelled ids of the smallest hashes of doc_id, half of it (if there are as many) toxic ones. Of
    rows that repeat an id one is learned from, so the driver gets sample_rows texts at most.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = known.filter("toxic = 1").orderBy(order, "doc_id").limit(sample_rows // 2).unionByName(known.filter("toxic = 0").orderBy(order, "doc_id").limit(sample_rows // 2))
    # The broadcast side has at most sample_rows rows.
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("raw")).join(F.broadcast(picked), "doc_id")
    got = rows.groupBy("doc_id").agg(F.min("raw").alias("raw"), F.max("toxic").alias("toxic")).collect()
    got.sort(key=lambda r: r.doc_id)
    y = np.array([r.toxic for r in got], np.int64)
    if not len(got) or y.min() == y.max():
        return None
    return learned([r.raw and bytes(r.raw) for r in got], y)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000) -> DataFrame:
    """Scores every whole text of `docs` (doc_id, text) for what `labels` (doc_id, toxic) marks.

    Returns one row for each row of `docs`: doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on). Null and
    empty texts are scored as texts of padding. Null ids are not held out and not learned from; repeated rows score
    alike; of labels that repeat an id the largest counts; other columns are ignored. Where the labels to learn from
    don't have both classes, all scores are 0.
    """
    model = trained(docs, labels, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words, known, filled = shared.value, Words(), np.zeros((0, sum(WIDTHS), FILTERS), np.float32), 0
        for batch in batches:
            scores = []
            for raw in batch.column(2).to_pylist():
                if model is None:
                    scores.append(0.0)
                    continue
                if len(words.place) >= MEMORY:
                    words, filled = Words(), 0
                numbers = words.number(raw)
                if len(words.place) > len(known):
                    grown = np.empty((max(len(words.place), 2 * len(known)), *known.shape[1:]), np.float32)
                    grown[: len(known)] = known
                    known = grown
                if len(words.place) > filled:
                    known[filled : len(words.place)] = model.responses(words.ids[filled : len(words.place)])
                    filled = len(words.place)
                logit = model.logit(known[numbers]) - model.offsets[words.language(numbers)]
                scores.append(float(1 / (1 + np.exp(-np.clip(logit, -500, 500)))))
            score = pd.Series(scores, dtype="float64")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype("int32"))], names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary"))
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
