"""Column functions on matches: their state, winner, the result that counts, and how they are shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, clean, match_key

# Words that a text of a team holds only where the team isn't known yet, and such texts as patterns.
PLACEHOLDER_WORDS = ("TBD", "PENDIENTE", "POR DEFINIR", "GANADOR", "PERDEDOR", "WINNER", "LOSER", "RUNNER", "SEGUNDO", "TERCERO", "MEJOR")
PLACEHOLDER_PATTERN = r"^([123]\s*[A-L]+|[WL]\s*-?\s*[0-9]+|[A-L][1-4])$"


def whole_id(x: Column) -> Column:
    """A number's text without the .0 that a sheet adds; the first number of other texts; null if there is none."""
    text = clean(x)
    return F.coalesce(F.nullif(F.regexp_extract(text, r"^([0-9]+)(?:\.0+)?$", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"([0-9]+)", 1), F.lit(""))).try_cast("long")


def known_team(x: Column) -> Column:
    """Whether a text names a team: it isn't blank, holds no word of those that stand for one, and isn't a slot.

    One pattern on one key, so that the key is made once.
    """
    return ~match_key(x).rlike("|".join((*PLACEHOLDER_WORDS, PLACEHOLDER_PATTERN, "^$")))


def finished(state: Column, goals_a: Column, goals_b: Column) -> Column:
    """Whether a match is over: its state says so, or both sides have goals."""
    return (F.coalesce(state, F.lit("")) == "Jugado") | (goals_a.isNotNull() & goals_b.isNotNull())


def winner(a: Column, b: Column, goals_a: Column, goals_b: Column, penalties_a: Column, penalties_b: Column) -> Column:
    """The side with more goals, of even ones that with more penalties; null without a decision."""
    even = goals_a == goals_b
    return F.when(goals_a > goals_b, a).when(goals_b > goals_a, b).when(even & (penalties_a > penalties_b), a).when(even & (penalties_b > penalties_a), b)


def used_result(over: Column, real: Column, predicted: Column) -> tuple[Column, Column]:
    """The value that counts, the real one of a match that is over and else the predicted one, and which of them it is."""
    final = over & real.isNotNull()
    return F.when(final, real).otherwise(predicted), F.when(final, "final").when(predicted.isNotNull(), "predicted").otherwise("none")


def knockout_pick(a: Column, b: Column, score: tuple[Column, Column], chance: tuple[Column, Column], rating: tuple[Column, Column]) -> Column:
    """Who goes on: by goals, then by the chance to win, then by rating, then the first."""
    out = a
    for x, y in (rating, chance, score):
        out = F.when(x > y, a).when(y > x, b).otherwise(out)
    return out


def win_chance(rating_a: Column, rating_b: Column, scale: float = 400.0) -> Column:
    """Logistic chance of the first side."""
    return 1 / (1 + F.exp(-(rating_a - rating_b) / scale))


def linear_goals(chance: Column, least: float = 0.2, most: float = 3.5) -> Column:
    return F.least(F.greatest(least + (most - least) * chance, F.lit(least)), F.lit(most))


def percent(x: Column, digits: int = 1) -> Column:
    """A share as text in per cent; a dash for none."""
    return F.coalesce(F.concat(F.format_number(x * 100, digits), F.lit("%")), F.lit("-"))


def first_of(*names: Column) -> Column:
    """The first name that isn't blank, for rows whose columns differ by where they come from."""
    return F.coalesce(*map(blank_to_null, names))
