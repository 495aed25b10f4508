"""How filters interact: for every order of them, what each step removes, and each filter's Shapley share of the removals.

What a set S of filters removes from a part of the corpus is the multilinear polynomial

    V(x) = sum over masks m of n(m) * (1 - product of (1 - x_i) over i in m)

at the corner x = 1 on S, where n(m) counts the rows that fail exactly the filters of m. Its coefficients come from the mask
counts; its values at corners tell what is left after each step of each order; the integral over t from 0 to 1 of its partial
derivative by x_i at (t, ..., t) is the Shapley share of filter i, a rational number that is exact here.

The table is read once: each row becomes its mask, and of the masks only counts go on, at most 2^k for each part. All is done
by DataFrame functions.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from fractions import Fraction
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"

def text_filters(text: Column) -> dict[str, Column]:
    """For each letter the condition under which a text fails: A few words, B repeated words, C capitals, D symbols."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    n = F.size(words)
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of rows by what they fail: part, mask, n, good, toxic; bit k of mask is the k-th letter of ABCDE.

    Of rows with equal texts all but those of the smallest id fail E; a row without an id is no copy and no original.
    Copies are counted, never joined with one another: equal texts of one id are one row after the first aggregation, and
    each text then has at most a row for each part and label.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    bits = [F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(text_filters(text).values())]
    rows = docs.select(
        F.coalesce(docs["lang"], F.lit("")).alias("part"),
        docs["doc_id"].alias("doc_id"),
        sum(bits[1:], bits[0]).cast("int").alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = rows.groupBy("doc_id", "digest", "mask", "part").agg(F.count("*").alias("n"))
    flag = lambda c: F.max(F.coalesce(labels[c] == 1, F.lit(False)))  # noqa: E731  by any of the id's labels
    marks = labels.filter(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].alias("doc_id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    marked = rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # Of a text's rows: all of them, those without an id, the smallest id and how many rows have it.
    texts = marked.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("bare"),
        F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"),
    )
    # A text has at most parts x 4 rows here, so no window is hot; all ids null: no first, and no copies.
    first = F.min("least").over(Window.partitionBy("digest"))
    told = texts.withColumn("fresh", F.col("bare") + F.when(F.col("least") == first, F.col("at_least")).otherwise(0))
    split = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")),
        F.struct(F.col("mask").bitwiseOR(1 << 4).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")),
    )
    each = told.select("part", "good", "toxic", F.inline(split)).filter("n > 0")
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return each.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def _subsets(size: int) -> Column:
    """The masks 0 to 2^size - 1."""
    return F.sequence(F.lit(0), F.lit((1 << size) - 1))


def _sum(masks: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(masks, F.lit(0).cast("long"), lambda total, m: total + value(m).cast("long"))


def _within(inner: Column, outer: Column) -> Column:
    return inner.bitwiseAND(outer) == inner


def polynomial(counts: Column, size: int) -> Column:
    """The coefficients of V by monomial, from the array of counts by mask.

    A mask adds (-1)^(|T|+1) times its count to the coefficient of each of its non-empty subsets T.
    """
    sign = lambda t: F.when(t == 0, 0).when(F.bit_count(t) % 2 == 1, 1).otherwise(-1)
    above = lambda t: _sum(_subsets(size), lambda m: F.when(_within(t, m), counts[m]).otherwise(0))
    return F.transform(_subsets(size), lambda t: sign(t) * above(t))


def corners(coefficients: Column, size: int) -> Column:
    """V where the variables of a mask are 1 and the others 0, what those filters remove, by mask."""
    value = lambda s: _sum(_subsets(size), lambda t: F.when(_within(t, s), coefficients[t]).otherwise(0))
    return F.transform(_subsets(size), value)


def derivative_integral(coefficients: Column, size: int, k: int, scale: int) -> Column:
    """`scale` times the integral over t in [0, 1] of the derivative by x_k at (t, ..., t), exactly.

    A monomial of degree d that holds x_k has the derivative t^(d-1) there, so the integral 1/d; coefficients of a degree
    are added up first, and scale / d is a whole number for each degree if scale is a multiple of size!.
    """
    total = F.lit(0).cast("long")
    for d in range(1, size + 1):
        weight = Fraction(scale, d)
        if weight.denominator != 1:
            raise ValueError(f"{scale} is no multiple of {d}")
        held = lambda t, d=d: F.when((t.bitwiseAND(1 << k) != 0) & (F.bit_count(t) == d), coefficients[t]).otherwise(0)
        total = total + _sum(_subsets(size), held) * weight.numerator
    return total


def steps_of_orders(letters: str) -> list[dict[str, str | int]]:
    """For each step of each order: its filter k, and the masks of the filters before it and up to it."""
    out = []
    for order in permutations(range(len(letters))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append({"filter_order": "".join(letters[i] for i in order), "step": step, "k": k, "before": before, "after": before | 1 << k})
            before |= 1 << k
    return out


def interaction_audit(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """The audit of all orders of `letters` from counts by part and mask (part, mask, n, good, toxic).

    Returns for each part, each order and each step: kept (rows that no filter so far removes), removed, redundant (rows
    that fail the filter and went before), unique_fails (rows that fail this filter alone), good_lost, toxic_lost, and
    shapley, the rows that the filter removes in all orders together.
    """
    size, values = len(letters), ("n", "good", "toxic")
    at = lambda v, m: F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(v))), F.lit(0))
    parts = counts.groupBy("part").agg(*(F.array(*(at(v, m) for m in range(1 << size))).alias(v) for v in values))
    parts = parts.withColumns({f"{v}_terms": polynomial(F.col(v), size) for v in values})
    parts = parts.withColumns({f"{v}_gone": corners(F.col(f"{v}_terms"), size) for v in values})
    shares = F.array(*(derivative_integral(F.col("n_terms"), size, k, factorial(size)) for k in range(size)))
    parts = parts.withColumn("shares", shares).withColumn("rows", F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))
    # The list of steps is the same for each part, which turns into as many rows: nothing is joined.
    listed = F.from_json(F.lit(json.dumps(steps_of_orders(letters))), "array<struct<filter_order string, step int, k int, before int, after int>>")
    each = parts.select("*", F.inline(listed))
    gone = lambda v: F.col(f"{v}_gone")[F.col("after")] - F.col(f"{v}_gone")[F.col("before")]
    only = F.col("after") - F.col("before")  # the mask of the step's filter
    return each.select(
        "part", "filter_order", "step",
        (F.col("rows") - F.col("n_gone")[F.col("after")]).alias("kept"),
        gone("n").alias("removed"),
        (F.col("n_gone")[only] - gone("n")).alias("redundant"),
        F.col("n")[only].alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.col("shares")[F.col("k")].alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Five filters on whole texts of `docs` (doc_id, text, lang) in all 120 orders, by language.

    A: under 100 words; B: fewer than 80% of the words distinct; C: over 10% ASCII capitals; D: a symbol of `#$%&*|`;
    E: the text of a smaller doc_id, in any part, removed or not. A null text is empty, a null language the part ''; other
    columns are ignored. Rows that share an id and a text are counted each and are no copies of one another; rows without
    an id never fail E. An id with several rows of `labels` is good or toxic if one of them says so. No documents: no rows.
    """
    return interaction_audit(failures(docs, labels))
