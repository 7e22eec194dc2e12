"""Tables from JSON rows whose keys differ: one column per key, first seen first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys become columns of one table; data with more of them (ids used as keys, say) is an error, not cut.
MAX_KEYS = 10_000


def key_places(rows: DataFrame, text: str, order_by: Sequence[str]) -> DataFrame:
    """key and place, one row per key of the JSON objects in ``text``: where it is seen first.

    The place is the row (``order_by``, then a hash of its text) and the position in it. It is a minimum, so a key that
    every row holds is reduced to one row per task before the shuffle. Text that is no JSON object has no keys.
    """
    place = F.struct(*[F.col(f"`{c}`").alias(f"by_{i}") for i, c in enumerate(order_by)], F.xxhash64(f"`{text}`").alias("hash"))
    keys = rows.select(place.alias("row"), F.posexplode(F.json_object_keys(f"`{text}`")).alias("at", "key"))
    return keys.groupBy("key").agg(F.min(F.struct("row", "at")).alias("place"))


def _distinct(names: Sequence[str]) -> list[str]:
    """Column names for keys: those that repeat an earlier one apart from case get the next free number."""
    out, taken = [], set()
    for name in names:
        free, n = name, 2
        while free.lower() in taken:
            free, n = f"{name}_{n}", n + 1
        taken.add(free.lower())
        out.append(free)
    return out


def union_of_keys(rows: DataFrame, text: str, order_by: Sequence[str], keep: Sequence[str] = (), max_keys: int = MAX_KEYS) -> DataFrame:
    """Columns ``keep``, then one text column per key found in any row of ``text``, in the order of first sight.

    Text values stay as they are, numbers and nested values are JSON text, missing keys and nulls are null; of a key that
    a row repeats the last value counts. Text that is null or no JSON object gives a row of nulls. A key that equals an
    earlier column apart from case is numbered (``a``, ``A_2``). Keys are found in one pass and all values read in a
    second one; only the header, at most ``max_keys`` names, reaches the driver.
    """
    names = [r["key"] for r in key_places(rows, text, order_by).orderBy("place").select("key").limit(max_keys + 1).collect()]
    if len(names) > max_keys:
        raise ValueError(f"more than {max_keys} keys: they are data, not columns")
    kept = [F.col(f"`{c}`") for c in keep]
    if not names:
        return rows.select(*kept)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    columns = _distinct([*keep, *names])
    return rows.select(*kept, F.from_json(F.col(f"`{text}`"), schema).alias("__row")).select(*kept, "__row.*").toDF(*columns)
