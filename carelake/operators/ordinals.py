"""Consecutive row numbers over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.operators.items import holds_map
from carelake.session import materialise

_POSITION_BITS = 33


def row_ordinal(df: DataFrame, order_by: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order_by``.

    Rows are range-partitioned and sorted on ``order_by`` and then on all other columns, so equal
    keys are spread over ranges and only wholly equal rows stay together, whose order does not
    matter. They are stored once, each with its partition and its place there; what is read later
    is that table, so a task that is run again after a loss changes nothing. Partition offsets come
    from a table with one row per partition, which bounds its broadcast.
    """
    rest = [c for c in df.columns if c not in order_by]
    orderable = {f.name for f in df.schema.fields if not holds_map(f.dataType)}
    keys = [F.col(f"`{c}`").asc_nulls_first() if c in orderable else F.to_json(f"`{c}`") for c in [*order_by, *rest]]
    row_id = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(
        {"__part": F.shiftright(row_id, _POSITION_BITS).cast("int"), "__pos": row_id.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))}
    )
    placed = materialise(ordered, "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__pos"))
        .drop("__part", "__pos", "__offset")
    )
