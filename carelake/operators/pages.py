"""Deep pages of a table that is stored in order: a page is found by arithmetic and read from one or two ranges."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.ordinals import row_ordinal

# Rows of a range; tables with more than so many ranges of them get longer ranges.
RANGE_ROWS = 1 << 16
_RANGES = 1 << 14
_PLACE = ["page_range", "page_row"]


def paginate(df: DataFrame, order_by: Sequence[str], path: str, range_rows: int | None = None) -> None:
    """Store ``df`` in the order of ``order_by`` (nulls first), then of its other columns, in folders of ``range_rows`` rows each.

    Rows are numbered and stored without passing through one task; equal rows get numbers of their own. A row number finds its
    folder by division, and its place within long ranges by the minima and maxima of Parquet row groups.
    """
    clash = {c.lower() for c in df.columns} & set(_PLACE)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are used for the place of a row")
    numbered = row_ordinal(df, order_by, "page_row")
    if range_rows is None:
        range_rows = max(RANGE_ROWS, -(-numbered.count() // _RANGES))
    rows = numbered.withColumn("page_range", F.floor(F.col("page_row") / range_rows).cast("bigint"))
    rows.sortWithinPartitions("page_range", "page_row").write.partitionBy("page_range").parquet(f"{path}/rows")
    layout = [(range_rows, rows.schema.json())]
    df.sparkSession.createDataFrame(layout, "range_rows bigint, schema string").write.parquet(f"{path}/layout")


def read_rows(spark: SparkSession, path: str, skip: int = 0, limit: int = 50) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` in order; folders without any of them are pruned at planning."""
    layout = spark.read.schema("range_rows bigint, schema string").parquet(f"{path}/layout").first()
    first, last = skip // layout["range_rows"], (skip + max(limit, 1) - 1) // layout["range_rows"]
    stored = spark.read.schema(T.StructType.fromJson(json.loads(layout["schema"]))).parquet(f"{path}/rows")
    inside = (F.col("page_row") >= skip) & (F.col("page_row") < skip + limit)
    return stored.filter(F.col("page_range").between(first, last)).filter(inside).orderBy("page_row").drop(*_PLACE)


def read_page(spark: SparkSession, path: str, page_number: int = 1, limit: int = 100) -> DataFrame:
    """Page ``page_number`` (1-based) of ``limit`` rows; beyond the last one it is empty."""
    return read_rows(spark, path, (page_number - 1) * limit, limit)
