"""Language identification by hierarchical discrimination: the family first, then one-versus-one linear SVMs within it.

A text is lower-cased; the letters of its words, with a space on either side, give byte n-grams that hash to features,
and the share of each feature goes through a square root (a Hellinger kernel). A linear support vector machine for each
family against the rest picks the family; within it a machine for each pair of languages votes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out

FEATURES, GRAMS = 1 << 13, (1, 2, 3, 4)
#: Parts of a language's documents from which those to learn from are picked first.
PARTS = 16
#: Languages of each family; a language of none is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "indic": "hi bn mr gu pa ne ur",
    "semitic": "ar he mt am",
    "turkic": "tr az kk uz ky tk",
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def features(text: str | None) -> np.ndarray | None:
    """Square roots of the shares of hashed n-grams; None if the text has no letter."""
    bare = _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
    if not any(map(str.isalpha, bare)):
        return None
    raw = np.frombuffer(f" {bare} ".encode(), np.uint8).astype(np.uint64)
    total = np.zeros(FEATURES, np.int64)
    for n in GRAMS:
        h = np.full(max(0, len(raw) - n + 1), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + raw[j : len(raw) - n + 1 + j]
        h ^= h >> np.uint64(29)
        total += np.bincount((h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 13)).astype(np.int64), minlength=FEATURES)
    return np.sqrt(total / total.sum()).astype(np.float32)


@dataclass
class LinearSVM:
    """Dual coordinate descent for the squared hinge loss; both classes weigh alike."""

    weight: np.ndarray
    bias: float

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30, seed: int = 5) -> LinearSVM:
        rng = np.random.default_rng(seed)
        w, alpha = np.zeros(x.shape[1] + 1, np.float64), np.zeros(len(y))
        per_class = {s: cost * len(y) / (2 * max(1, (y == s).sum())) for s in (1, -1)}
        diagonal = np.array([0.5 / per_class[int(s)] for s in y])
        norms = np.einsum("ij,ij->i", x, x) + 1.0 + diagonal
        for _ in range(rounds):
            moved = 0.0
            for i in rng.permutation(len(y)):
                slope = y[i] * (w[:-1] @ x[i] + w[-1]) - 1 + alpha[i] * diagonal[i]
                new = max(0.0, alpha[i] - slope / norms[i])
                if new != alpha[i]:
                    step = (new - alpha[i]) * y[i]
                    w[:-1] += step * x[i]
                    w[-1] += step
                    moved = max(moved, abs(new - alpha[i]))
                    alpha[i] = new
            if moved < 1e-3:
                break
        return LinearSVM(w[:-1].astype(np.float32), float(w[-1]))

    def margin(self, x: np.ndarray) -> float:
        return float(self.weight @ x) + self.bias


def _squash(x: float) -> float:
    return 1 / (1 + float(np.exp(-2 * np.clip(x, -100, 100))))


@dataclass
class Hierarchy:
    families: dict[str, list[str]]
    of_family: dict[str, LinearSVM]
    of_pair: dict[tuple[str, str], LinearSVM]

    @staticmethod
    def fit(x: np.ndarray, langs: list[str]) -> Hierarchy:
        names = np.array(langs)
        families: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            families.setdefault(_FAMILY_OF.get(lang, f"only {lang}"), []).append(lang)
        of_family, of_pair = {}, {}
        for family, members in families.items():
            inside = np.isin(names, members)
            if len(families) > 1:
                of_family[family] = LinearSVM.fit(x, np.where(inside, 1, -1))
            for a, b in combinations(members, 2):
                both = np.isin(names, (a, b))
                of_pair[a, b] = LinearSVM.fit(x[both], np.where(names[both] == a, 1, -1))
        return Hierarchy(families, of_family, of_pair)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The language, and the sureness of the family times that of the closest vote in it."""
        margins = {family: svm.margin(x) for family, svm in self.of_family.items()} or {family: np.inf for family in self.families}
        family = max(margins, key=lambda k: margins[k])
        members, sure = self.families[family], _squash(margins[family])
        if len(members) == 1:
            return members[0], sure
        wins, least = dict.fromkeys(members, 0.0), dict.fromkeys(members, np.inf)
        for (a, b), svm in self.of_pair.items():
            if a in wins:
                m = svm.margin(x)
                for lang, own in ((a, m), (b, -m)):
                    wins[lang] += own > 0
                    least[lang] = min(least[lang], own)
        best = max(members, key=lambda k: (wins[k], least[k]))
        return best, sure * _squash(least[best])


def trained(docs: DataFrame, sample_rows: int = 400) -> Hierarchy | None:
    """Learns from at most `sample_rows` documents of each language that aren't held out, of the smallest hashes of doc_id."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = known.select("doc_id", "lang").withColumn("part", F.pmod(F.hash("doc_id"), F.lit(PARTS)))
    for by in (("lang", "part"), ("lang",)):  # the first of each part, then the first of those: no task gets all of a language
        order = Window.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id")
        picked = picked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample_rows)
    picked = picked.select("doc_id").distinct()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x) for x in batch.column(2).to_pylist()]
            raw = pa.array([x if x is None else x.astype(np.float16).tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), raw], names=["doc_id", "lang", "raw"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # The broadcast side has at most sample_rows ids for each language.
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(picked), "doc_id")
    features_of = rows.mapInArrow(measured, f"doc_id {kind}, lang string, raw binary").filter("raw is not null")
    # Of rows that repeat an id and a language one is learned from, so that many rows are no more than the sample has ids.
    found = features_of.groupBy("doc_id", "lang").agg(F.min("raw").alias("raw")).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.doc_id, r.lang, r.raw))
    return Hierarchy.fit(np.stack([np.frombuffer(r.raw, np.float16) for r in found]).astype(np.float32), [r.lang for r in found])


def identify(docs: DataFrame, sample_rows: int = 400) -> DataFrame:
    """Predicts the language of every whole text of `docs` (doc_id, text, lang), learning from lang where it isn't null.

    Returns one row for each row of `docs`: doc_id, held_out, lang_pred, score (0 to 1). A null text, or one without a
    letter, is `und` with score 0; so is every text where there is nothing to learn from. Null ids are not held out and
    not learned from; repeated rows are predicted alike; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, sample_rows))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                x = features(text) if model else None
                out.append(("und", 0.0) if x is None else model.predict(x))
            langs, scores = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
