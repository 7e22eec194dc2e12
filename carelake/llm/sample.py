"""Bounded samples of tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 30


def bounded(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most ``rows`` rows, chosen by the hash of ``key``; the same ones on every run.

    The table is counted, then filtered by hash to about twice the number, so what is sorted for the exact bound does not
    grow with the table or its partitions.
    """
    hashed = F.xxhash64(*key)
    share = min(1.0, 2 * rows / max(df.count(), 1))
    return df.where(F.pmod(hashed, F.lit(_STEPS)) < F.lit(int(share * _STEPS))).orderBy(hashed, *key).limit(rows)
