"""What a strict reader of JSON refuses, as column expressions that take time in proportion to the text.

Grammar and repeated keys are told by the parser of VARIANT, which refuses both; a lenient pass over the same text tells them
apart. Numbers are judged on what is left of the text once its strings are gone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The longest body in bytes, and the largest whole number that a double holds with all below it.
MOST_BYTES, SAFE = 1_500_000, 2**53 - 1
_ESCAPE, _STRING = r'\\(["\\/bfnrt]|u[0-9a-fA-F]{4})', r'"[^"\x00-\x1f]*"'
_CONSTANT = r"(?<=[:\[,\s]|^)(NaN|-?Infinity)(?=[\s,\]}]|$)"
_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
#: Stands for a constant while the grammar is looked at; no key holds it.
_STAND_IN = "0.13790000000000000731"


def bare(body: Column) -> Column:
    """The text with `~` for each string."""
    return F.regexp_replace(F.regexp_replace(body, _ESCAPE, "_"), _STRING, "~")


def numbers(body: Column) -> Column:
    """The numbers of the text as they are written, in order."""
    return F.regexp_extract_all(bare(body), F.lit(_NUMBER), F.lit(0))


def verdict(body: Column) -> Column:
    """`missing` (null), `too_long`, `malformed`, `repeated_key` (in one object, after escapes), `not_finite` (NaN, infinities, and
    numbers beyond a double), `unsafe_integer` (beyond 2^53 - 1), or `fine`: the first that holds.

    Equal keys of different objects are fine, whatever is in strings doesn't count, and more than one value is malformed.
    """
    left = bare(body)
    stood_in = F.when(left.rlike(_CONSTANT), F.regexp_replace(body, _CONSTANT, _STAND_IN)).otherwise(body)
    # Parsers stop after the first value; one that also fills a list and an object is the only one, as none can close both.
    wrapped = (F.concat(F.lit("["), stood_in, F.lit("]")), F.concat(F.lit('{"":'), stood_in, F.lit("}")))
    strict = F.try_parse_json(wrapped[0]).isNotNull() & F.try_parse_json(wrapped[1]).isNotNull()
    lenient = F.get_json_object(wrapped[0], "$").isNotNull() & F.get_json_object(wrapped[1], "$").isNotNull()
    # Single quotes and raw control characters pass the lenient reader, but leave a quote or a backslash in the bare text.
    lenient = lenient & ~F.regexp_replace(left, _CONSTANT, "0").rlike(r"[^ \t\r\n{}\[\],:~0-9eE+.\-truefalsn]")
    written = numbers(body)
    beyond = F.exists(written, lambda x: F.abs(x.try_cast("double")) == F.lit(float("inf")))
    large = F.exists(written, lambda x: x.rlike("^-?[0-9]+$") & F.coalesce(F.abs(x.try_cast("decimal(38,0)")) > F.lit(SAFE).cast("decimal(38,0)"), F.lit(True)))
    return (
        F.when(body.isNull(), "missing")
        .when(F.octet_length(body) > MOST_BYTES, "too_long")
        .when(~(strict | lenient), "malformed")
        .when(~strict, "repeated_key")
        .when(left.rlike(_CONSTANT) | beyond, "not_finite")
        .when(large, "unsafe_integer")
        .otherwise("fine")
    )
