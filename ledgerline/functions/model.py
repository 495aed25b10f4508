"""Expectations of paired contests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Most goals of a side that the grid has; goals of two even sides; half-life of a result in days.
MOST_GOALS, BASE_GOALS, HALF_LIFE = 8, 1.35, 365.0


def clipped(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def recency_weight(played: Column, as_of: Column) -> Column:
    """Halves with every half-life; a future date weighs 1."""
    return F.pow(F.lit(0.5), F.greatest(F.datediff(as_of, played), F.lit(0)) / HALF_LIFE)


def strength_gap(points_a: Column, points_b: Column, elo_a: Column, elo_b: Column) -> Column:
    """Weighted difference of two ratings; a missing one counts as even."""
    points = F.coalesce((points_a - points_b) / 200, F.lit(0.0))
    elo = F.coalesce((elo_a - elo_b) / 400, F.lit(0.0))
    return clipped(0.55 * points + 0.45 * elo, -1.0, 1.0)


def expected_goals(attack: Column, weakness: Column, gap: Column) -> Column:
    """Poisson mean from a side's attack, the other's weakness (both relative to the mean) and the strength gap."""
    return clipped(BASE_GOALS * clipped(attack, 0.6, 1.6) * clipped(weakness, 0.6, 1.6) * F.exp(0.35 * gap), 0.2, 4.5)


def poisson_terms(mean: Column) -> Column:
    """Probabilities of 0 to MOST_GOALS goals."""
    return F.transform(F.sequence(F.lit(0), F.lit(MOST_GOALS)), lambda k: F.exp(-mean) * F.pow(mean, k) / F.factorial(k))


def score_grid(mean_a: Column, mean_b: Column) -> Column:
    """All scores (p, a, b) up to MOST_GOALS each; the probabilities are not yet scaled to 1."""
    a, b = poisson_terms(mean_a), poisson_terms(mean_b)
    row = lambda p, i: F.transform(b, lambda q, j: F.struct((p * q).alias("p"), i.alias("a"), j.alias("b")))
    return F.flatten(F.transform(a, row))


def grid_share(grid: Column, holds) -> Column:  # noqa: ANN001 - a function of two columns
    """Probability of the scores for which holds(a, b)."""
    total = lambda cells: F.aggregate(cells, F.lit(0.0), lambda s, x: s + x.p)
    return total(F.filter(grid, lambda x: holds(x.a, x.b))) / total(grid)


def likeliest(grid: Column) -> Column:
    """The likeliest score; of equals the one with fewer goals of a, then of b."""
    best = F.array_max(F.transform(grid, lambda x: F.struct(x.p.alias("p"), (-x.a).alias("a"), (-x.b).alias("b"))))
    return F.concat_ws("-", -best.a, -best.b)


def confidence(first: Column, second: Column) -> Column:
    margin = first - second
    return F.when((first >= 0.65) & (margin >= 0.15), "Alta").when((first >= 0.5) & (margin >= 0.08), "Media").otherwise("Baja")


def rating_score(elo: Column, points: Column, rank: Column) -> Column:
    return F.coalesce(elo, F.lit(0.0)) + F.coalesce(points, F.lit(0.0)) + F.coalesce(F.greatest(F.lit(0.0), 300 - rank), F.lit(0.0))
