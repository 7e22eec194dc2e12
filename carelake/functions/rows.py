"""Whole-row expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_hash(cols: Iterable[str]) -> Column:
    """SHA-256 over all named fields in name order; JSON keeps nulls and separators apart."""
    return F.sha2(F.to_json(F.struct(*sorted(cols))), 256)


def row_hash_of(values: Mapping[str, Column]) -> Column:
    """``row_hash`` of computed fields."""
    return F.sha2(F.to_json(F.struct(*[values[n].alias(n) for n in sorted(values)])), 256)


def null_safe_equal(left: str, right: str, cols: Iterable[str]) -> Column:
    """Conjunction of null-safe equalities between two aliased sides."""
    condition = F.lit(True)
    for name in cols:
        condition = condition & F.col(f"{left}.`{name}`").eqNullSafe(F.col(f"{right}.`{name}`"))
    return condition


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def integral_decimal(field: T.StructField) -> Column:
    """Decimals written as integers when integral, else as doubles; other columns unchanged."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        as_int = c.cast("decimal(38,0)").cast("string")
        return F.when(c == F.floor(c), as_int).otherwise(c.cast("double").cast("string")).alias(field.name)
    return c.alias(field.name)


def flat_text(df: DataFrame) -> DataFrame:
    """Every column as text: nested values as JSON, nulls as empty text."""
    out = []
    for field in df.schema.fields:
        c = F.to_json(f"`{field.name}`") if _is_nested(field.dataType) else integral_decimal(field).cast("string")
        out.append(F.coalesce(c, F.lit("")).alias(field.name))
    return df.select(*out)


def drop_blank_values(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every string column, so JSON writers omit the key."""
    out = [
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*out)


def row_contains(df: DataFrame, query: str) -> DataFrame:
    """Rows whose JSON text contains ``query`` without regard to case; blank keeps all rows."""
    needle = query.strip().lower()
    if not needle:
        return df
    return df.filter(F.contains(F.lower(F.to_json(F.struct("*"))), F.lit(needle)))
