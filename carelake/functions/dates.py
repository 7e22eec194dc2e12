"""Date and timestamp text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions.text import SPACE_CLASS, bind, strip

# Fixed value: ISO date with an optional time of day and an optional UTC offset.
ISO_DATE = r"^(\d{4}-\d{2}-\d{2})([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?$"
ISO_PARTS = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})(:\d{2})?(?:\.(\d{1,6}))?(Z|[+-]\d{2}:\d{2})?$"

_PADDED = rf"^{SPACE_CLASS}*{ISO_DATE[1:-1]}{SPACE_CLASS}*$"


def parse_date(c: Column) -> Column:
    """Date of an ISO date or timestamp text; null when it does not parse."""
    return F.regexp_extract(c.cast("string"), _PADDED, 1).try_cast("date")


def iso8601(c: Column) -> Column:
    """Canonical ISO timestamp text, a zero offset written as ``Z``; null when blank or invalid."""
    return bind(strip(c.cast("string")), lambda text: F.when(F.length(text) == 10, _midnight(text)).when(F.length(text) > 10, _timestamp(text)))


def _midnight(day: Column) -> Column:
    valid = day.rlike(ISO_DATE) & day.try_cast("date").isNotNull()
    return F.when(valid, F.concat(day, F.lit("T00:00:00")))


def _timestamp(text: Column) -> Column:
    second, fraction, offset = (F.regexp_extract(text, ISO_PARTS, i) for i in (3, 4, 5))
    second = F.coalesce(F.nullif(second, F.lit("")), F.lit(":00"))
    micros = F.rpad(fraction, 6, "0")
    micros = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
    offset = F.when(offset == "+00:00", "Z").otherwise(offset)
    clock = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 5), second)
    return F.when(text.rlike(ISO_PARTS) & clock.try_cast("timestamp_ntz").isNotNull(), F.concat(clock, micros, offset))


def month_text(c: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(c, "yyyy-MM")
