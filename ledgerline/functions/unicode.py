"""Comparison forms of text that need Unicode's tables, which Spark's functions don't have: vectorised, a batch at a time."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

_SPACES = re.compile(r"\s+")


def canonical(x: str | None) -> str | None:
    """Compatibility composition, single spaces, case folded; nothing left is None."""
    return None if x is None else _SPACES.sub(" ", unicodedata.normalize("NFKC", x)).strip().casefold() or None


def unmarked(x: str | None) -> str | None:
    """Decomposed and without the marks that don't take space of their own."""
    return None if x is None else "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn")


@pandas_udf(StringType())
def canonical_text(x: pd.Series) -> pd.Series:
    return x.map(canonical, na_action="ignore")


@pandas_udf(StringType())
def without_all_marks(x: pd.Series) -> pd.Series:
    return x.map(unmarked, na_action="ignore")
