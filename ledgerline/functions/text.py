"""Column functions for cleaning text, numbers, states and codes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and their base letters.
MARKED = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"


def clean(x: Column) -> Column:
    """Trimmed text; null becomes empty."""
    return F.trim(F.coalesce(x.cast("string"), F.lit("")))


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first column that isn't blank."""
    return F.coalesce(*map(blank_to_null, columns))


def without_marks(x: Column) -> Column:
    return F.translate(x, MARKED, PLAIN)


def slug(x: Column) -> Column:
    """Lower case without marks; all else than letters and digits becomes single hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(without_marks(clean(x))), "[^a-z0-9]+", "-"), "^-|-$", "")


def match_key(x: Column) -> Column:
    """Key for comparing names: upper case, without marks, single spaces."""
    return F.regexp_replace(F.upper(without_marks(clean(x))), r"\s+", " ")


def number(x: Column) -> Column:
    """A number whose commas separate thousands; null if it isn't one."""
    return F.replace(clean(x), F.lit(","), F.lit("")).try_cast("double")


def decimal_comma(x: Column) -> Column:
    """A number whose comma is the decimal point; null if it isn't one."""
    return F.replace(clean(x), F.lit(","), F.lit(".")).try_cast("double")


def number_or_zero(x: Column) -> Column:
    return F.coalesce(number(x), F.lit(0.0))


def mapped(x: Column, values: Mapping[str, Iterable[str]]) -> Column:
    """The key of `values` that lists the lower-case text, or the text itself."""
    text = F.lower(clean(x))
    out = clean(x)
    for key, alike in reversed(list(values.items())):
        out = F.when(text.isin(list(alike)), F.lit(key)).otherwise(out)
    return out


# States of a match.
STATES = {
    "Jugado": ("jugado", "finalizado", "finalizado ✅", "terminado", "complete", "completed", "finished", "final", "completo", "ft", "full time", "finalizado.", "terminado."),
    "En vivo": ("en vivo", "live", "in progress", "jugando", "en juego", "1t", "2t", "primer tiempo", "segundo tiempo", "halftime", "medio tiempo"),
    "Programado": ("programado", "scheduled", "fixture", "por jugar"),
    "Pendiente": ("pendiente", "pending", "tbd", "por definir"),
}
# The same for a calendar with three states, of which the last is that of all other texts.
SHORT_STATES = {
    "FINAL": ("jugado", "final", "finalizado", "completado", "complete", "completed"),
    "EN VIVO": ("en vivo", "live", "playing", "in progress"),
}
# Phases, in order of the tests; a text with any of the words is of the phase.
PHASES = (
    ("Fase de grupos", ("GRUPO", "GROUP")),
    ("Ronda de 32", ("32", "DIECISEISAVOS")),
    ("Octavos", ("OCTAVOS", "16")),
    ("Cuartos", ("CUARTOS", "QUARTER")),
    ("Semifinal", ("SEMIFINAL",)),
    ("Tercer lugar", ("TERCER", "3RD", "THIRD")),
    ("Final", ("FINAL",)),
)
# What stands for a team that isn't known.
UNKNOWN = ("", "TBD", "PENDIENTE", "GANADOR", "SEGUNDO", "TERCERO", "WINNER", "RUNNER", "3RD", "1ST", "2ND")


def state(x: Column) -> Column:
    return mapped(x, STATES)


def short_state(x: Column) -> Column:
    known = mapped(x, SHORT_STATES)
    return F.when(known.isin(*SHORT_STATES) & F.lower(clean(x)).isin(*(w for words in SHORT_STATES.values() for w in words)), known).otherwise("PENDIENTE")


def phase(x: Column) -> Column:
    text, out = match_key(x), clean(x)
    for name, words in reversed(PHASES):
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(text, F.lit(word))
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def phase_order(name: Column) -> Column:
    place = F.lit(99)
    for k, (known, _) in reversed(list(enumerate(PHASES, 1))):
        place = F.when(name == known, F.lit(k)).otherwise(place)
    return place


def valid_code(x: Column) -> Column:
    code = F.upper(clean(x))
    return ~code.isin(*UNKNOWN) & ~F.contains(code, F.lit("TBD"))


def slot_kind(x: Column) -> Column:
    """What a bracket slot asks for: first, second or third of groups, winner or loser of a match, or a team."""
    text = match_key(x)
    return (
        F.when(text.rlike(r"^1\s*[A-L]$"), "first")
        .when(text.rlike(r"^2\s*[A-L]$"), "second")
        .when(text.rlike(r"^3\s*[A-L]+$"), "third")
        .when(text.rlike(r"^W\s*-?\s*[0-9]+$"), "winner")
        .when(text.rlike(r"^L\s*-?\s*[0-9]+$"), "loser")
        .otherwise("team")
    )


def score_part(x: Column, side: int) -> Column:
    """Goals of side 0 or 1 of a score like 2-1; null if it isn't one."""
    parts = F.split(clean(x), "-")
    return F.when(F.size(parts) == 2, F.trim(parts[side]).try_cast("int"))


def outcome(a: Column, b: Column) -> Column:
    return F.when(a > b, "A").when(a < b, "B").when(a == b, "Empate")


def escaped(x: Column) -> Column:
    """Text for HTML."""
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        x = F.replace(x, F.lit(plain), F.lit(safe))
    return x
