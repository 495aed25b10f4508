"""Quality rules as a short-circuit cascade."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
NOT_LETTERS = bytes(x for x in range(128) if not chr(x).isalpha())


class Text(NamedTuple):
    """A text with the counts that every document gets, whatever the verdict."""

    raw: bytes
    words: list[bytes]
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int
    n_repeat_words: int


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of `width` words that occur at least twice in the text; exact, by ranking windows."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) <= 4096:
        key = np.zeros(n, np.int64)
        for j in range(width):
            key = key << 12 | ids[j : j + n]
    else:
        key = ids
        for j in range(1, width):
            key = np.unique(key[:-1] << 32 | ids[j:], return_inverse=True)[1]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(key, twice)
    covered = np.zeros(len(words), bool)
    for j in range(width):
        covered[j : j + n] |= hit
    return int(covered.sum())


def measured(raw: bytes | None) -> Text:
    raw = raw or b""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return Text(
        raw,
        words,
        len(raw.translate(None, SPACES + CONTINUATION)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


@dataclass(frozen=True)
class Rule:
    """Rejects a text; must be exact and depend on nothing but the text, so that the order changes only the cost."""

    name: str
    rejects: Callable[[Text], bool]


def _lines_that(t: Text, fits: Callable[[bytes], bool]) -> int:
    return sum(map(fits, filter(None, (x.strip(SPACES) for x in t.raw.split(b"\n")))))


def _most_frequent(words: list[bytes]) -> int:
    return max(Counter(words).values(), default=0)


# How a line begins or ends that is an item of a list or goes on elsewhere.
BULLETS, ELLIPSES = ("-", "*", "\u2022"), ("...", "\u2026")
_BULLETS, _ELLIPSES = (tuple(x.encode() for x in xs) for xs in (BULLETS, ELLIPSES))

#: Many symbols, odd word lengths and repeated lines are told by the counts that every text gets; the other rules look at
#: the text again, if they are reached: exclamation marks, lists alone, lines cut off, one word over and over, and words
#: without letters.
RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > len(t.words)),
    Rule("word_length", lambda t: not 2 * len(t.words) <= t.word_chars <= 20 * len(t.words)),
    Rule("dup_lines", lambda t: 2 * t.n_dup_lines > t.n_lines),
    Rule("exclamations", lambda t: 10 * t.raw.count(b"!") > 3 * len(t.words)),
    Rule("bullets", lambda t: t.n_lines > 2 and 10 * _lines_that(t, lambda x: x.startswith(_BULLETS)) > 9 * t.n_lines),
    Rule("ellipses", lambda t: t.n_lines > 2 and 10 * _lines_that(t, lambda x: x.endswith(_ELLIPSES)) > 3 * t.n_lines),
    Rule("one_word", lambda t: 10 * _most_frequent(t.words) > 3 * len(t.words)),
    Rule("letters", lambda t: 10 * sum(bool(w.translate(None, NOT_LETTERS)) for w in t.words) < 5 * len(t.words)),
)


def base_failed(t: Text) -> bool:
    return len(t.words) < 10 or 100 * t.n_repeat_words > 20 * len(t.words)


def cascade(t: Text, order: tuple[Rule, ...]) -> tuple[bool, int]:
    """Whether the text passes all rules, and how many looked at it: none if the base conditions fail."""
    if base_failed(t):
        return False, 0
    for run, rule in enumerate(order, 1):
        if rule.rejects(t):
            return False, run
    return True, len(order)


def raws(column: pa.Array) -> Iterator[bytes | None]:
    """The bytes of texts, one after the other, so that a batch of long ones isn't copied whole."""
    return (x.as_py() for x in column.cast(pa.binary()))


def rule_costs(docs: DataFrame, text_col: str, rules: tuple[Rule, ...], sample_rows: int) -> dict[str, tuple[float, float]]:
    """Of each rule: the seconds for a text and the share of texts that it rejects, measured where the tasks run.

    About `sample_rows` rows are drawn over the whole table. Each rule sees those that the base conditions leave.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(text_col) if share == 1 else docs.select(text_col).sample(share, seed=7)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in map(measured, raws(batch.column(0))) if not base_failed(t)]
            took, bad = [], []
            for rule in rules:
                began = time.perf_counter()
                bad.append(sum(map(rule.rejects, texts)))
                took.append(time.perf_counter() - began)
            columns = [pa.array([r.name for r in rules]), pa.array([len(texts)] * len(rules)), pa.array(bad, pa.int64()), pa.array(took, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "n", "bad", "took"])

    total = sample.mapInArrow(measure, "name string, n long, bad long, took double").groupBy("name").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("took").alias("took"))
    return {r.name: (r.took / max(1, r.n), r.bad / max(1, r.n)) for r in total.collect()}


def rule_order(costs: dict[str, tuple[float, float]], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules by rejections for a second, most first; ties, and rules without a sample, keep the given order."""
    worth = lambda rule: costs[rule.name][1] / max(costs[rule.name][0], 1e-9) if rule.name in costs else 0.0
    return tuple(sorted(rules, key=worth, reverse=True))


def kept_rows(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows of `docs` that quality_cascade keeps, with all columns, each judged by its own text, whatever its id."""
    order, place = rule_order(rule_costs(docs, text_col, rules, sample_rows), rules), docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([cascade(measured(x), order)[0] for x in raws(batch.column(place))], pa.bool_()))

    # By position, as names may have dots or backticks.
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)


def quality_cascade(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = 2000,
) -> DataFrame:
    """Judges each text by the base conditions, then by a cascade of rules that stops at the first rejection.

    A sample of about `sample_rows` rows over the whole table tells what each rule costs and how many texts it rejects;
    the rules then run in the order of rejections per cost. The verdict is the same in any order; only the work differs.

    Returns one row for each row of `docs`: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, and rules_run (how many rules looked at it). A null or empty text has zero counts and fails.
    A null id stays null; repeated rows are judged each; other columns are ignored.
    """
    order = rule_order(rule_costs(docs, text_col, rules, sample_rows), rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in raws(batch.column(1)):
                t = measured(raw)
                rows.append((len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, base_failed(t), *cascade(t, order)))
            counts = zip(*rows, strict=True) if rows else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, kind) for x, kind in zip(counts, kinds, strict=True))],
                names=[id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rules_run"],
            )

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        judge,
        f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, rules_run long",
    )
