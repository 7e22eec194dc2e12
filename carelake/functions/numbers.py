"""Strict text-to-number conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions.text import SPACE_CLASS

# Fixed value: plain decimal notation only, so type suffixes, nan and inf are not numbers.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER = r"^[+-]?\d+$"

_PADDED = rf"^{SPACE_CLASS}*({NUMBER[1:-1]}){SPACE_CLASS}*$"


def nullable_number(c: Column) -> Column:
    """Double value of the text; null when blank or not a plain number.

    One ``regexp_extract`` trims, checks and feeds the cast, so a filter on the result that
    Catalyst pushes below the projection repeats the work once, not once per branch.
    """
    return F.regexp_extract(c.cast("string"), _PADDED, 1).try_cast("double")
