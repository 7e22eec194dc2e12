"""Text expressions that follow Python's idea of whitespace on top of Spark's built-ins."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes.
SPACE_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
SPACE_CHARS = "".join(map(chr, SPACE_CODES))
# The same set for Java's regex engine, whose Unicode \s lacks only the four separators.
SPACE_CLASS = r"(?U:[\s\x1C\x1D\x1E\x1F])"


def strip(c: Column) -> Column:
    """Trim all whitespace, not only spaces; a native trim, so long blank runs stay linear."""
    return F.trim(c, F.lit(SPACE_CHARS))


def blank_to_null(c: Column) -> Column:
    """Stripped text, or null where nothing is left."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def strip_or_empty(c: Column) -> Column:
    """Stripped text with null as empty text: one evaluation, cheap to push into filters."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def is_missing(c: Column) -> Column:
    """Null, empty, or the literal text ``nan``."""
    return c.isNull() | c.isin("", "nan")


def words(c: Column) -> Column:
    """Whitespace-separated words; an empty array for blank text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def bind(value: Column, expression: Callable[[Column], Column]) -> Column:
    """``expression`` of ``value``, with ``value`` computed once per row however often it is used."""
    return F.element_at(F.transform(F.array(value), expression), 1)


def first_present(cols: Iterable[Column]) -> Column:
    """The first value that is not blank after trimming."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def slug(c: Column, length: int = 40) -> Column:
    """Lower case, runs outside ``[a-z0-9]`` as one dash, cut to ``length``."""
    return F.substring(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), 1, length)


def contains_text(query: str, cols: Iterable[Column]) -> Column:
    """Case-insensitive substring in any of ``cols``; a blank query matches everything."""
    needle = query.strip().lower()
    if not needle:
        return F.lit(True)
    hits = F.lit(False)
    for c in cols:
        hits = hits | F.contains(F.lower(F.coalesce(c.cast("string"), F.lit(""))), F.lit(needle))
    return hits
