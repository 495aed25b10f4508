"""Price changes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reduction(before: Column, now: Column) -> Column:
    """How much lower the price is than before; 0 where it isn't lower, null without both."""
    return F.greatest(before - now, F.lit(0).cast("decimal(18,4)"))


def direction(before: Column, now: Column) -> Column:
    return F.when(now.isNull(), "unknown").when(before.isNull(), "no_baseline").when(now > before, "up").when(now < before, "down").otherwise("unchanged")


def changed_fields(pairs: dict[str, tuple[Column, Column]]) -> Column:
    """Names of the fields that differ, nulls being equal."""
    return F.array_compact(F.array(*(F.when(~a.eqNullSafe(b), F.lit(name)) for name, (a, b) in pairs.items())))


def change_kind(fields: Column, first: Column) -> Column:
    """INITIAL for a first state, NONE, the only field in upper case, or MULTIPLE."""
    return F.when(first, "INITIAL").when(F.size(fields) == 0, "NONE").when(F.size(fields) == 1, F.upper(fields[0])).otherwise("MULTIPLE")
