"""Nested reports in parts of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.rows import null_safe_equal
from carelake.operators.ordinals import row_ordinal

PART_ROWS = 1_000


def nested_parts(rows: DataFrame, group: Sequence[str], order_by: Sequence[str], entry: Column, name: str, size: int = PART_ROWS) -> DataFrame:
    """The rows of each group as numbered parts: columns ``group``, part (from 0) and an array of at most ``size`` entries.

    ``order_by`` orders the rows inside a group, ties follow all columns. Rows get their place in the order of all groups,
    which spreads a group of any size over ranges, and a part ends where the place passes a multiple of ``size``: no
    task holds a group, no row more than ``size`` entries, and the parts of a group in order hold its rows in order.
    Null is a group of its own; groups without rows have no parts.
    """
    placed = row_ordinal(rows, [*group, *order_by], "__place").withColumn("__block", F.floor(F.col("__place") / size))
    entries = F.array_sort(F.collect_list(F.struct(F.col("__place").alias("place"), entry.alias("entry"))))
    blocks = placed.groupBy(*group, "__block").agg(F.transform(entries, lambda e: e["entry"]).alias(name))
    starts = placed.groupBy(*group).agg(F.min("__block").alias("__first"))
    joined = blocks.alias("b").join(starts.alias("s"), null_safe_equal("b", "s", group))
    part = (F.col("__block") - F.col("__first")).cast("int").alias("part")
    return joined.select(*[F.col(f"b.`{c}`") for c in group], part, F.col(f"b.`{name}`"))
