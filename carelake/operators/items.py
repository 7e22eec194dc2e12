"""Item catalog: attribute and category lookups, nested catalogs, pages and table maintenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def find_by_attributes(df: DataFrame, attributes: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value."""
    for name, value in attributes.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def find_by_category(df: DataFrame, category: str) -> DataFrame:
    return df.filter(F.array_contains("categories", category))


def page(df: DataFrame, order_by: Sequence[str], page_number: int = 1, limit: int = 100) -> DataFrame:
    """Page ``page_number`` (1-based) of ``limit`` rows."""
    return page_offset(df, order_by, (page_number - 1) * limit, limit)


def page_offset(df: DataFrame, order_by: Sequence[str], skip: int = 0, limit: int = 50) -> DataFrame:
    """Rows ``skip`` to ``skip + limit``; for deep pages use the keyset form instead."""
    return df.orderBy(*order_by).offset(skip).limit(limit)


def exploded_catalog(df: DataFrame) -> DataFrame:
    """Nested catalog documents as one row per item, category columns alongside."""
    categories = df.select(F.explode("catalog").alias("category"))
    return categories.select("category.categoryId", "category.categoryName", F.explode("category.items").alias("item")).select(
        "categoryId", "categoryName", "item.*"
    )


def catalog_items(df: DataFrame, category_id: str, item_id: str | None = None) -> DataFrame:
    """Items of a category, or one of them."""
    items = exploded_catalog(df).filter(F.col("categoryId") == category_id)
    return items.filter(F.col("itemId") == item_id) if item_id is not None else items


def catalog_categories(df: DataFrame) -> DataFrame:
    """Categories without their items."""
    return df.select(F.explode("catalog").alias("c")).select("c.categoryId", "c.categoryName")


def last_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str] | None = None) -> DataFrame:
    """The last version of each key.

    A ``max_by`` over a struct, so every task hands on one row per key however often the key occurs.
    Without a version the largest row wins, which is at least repeatable; maps take no part in that.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [f.name for f in df.schema.fields if f.name in rest and not holds_map(f.dataType)]
    place = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate([*(version or []), *ordered])])
    best = F.max_by(F.struct(*rest), place).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.*").select(*df.columns)


def holds_map(dtype: T.DataType) -> bool:
    """Maps have no order."""
    if isinstance(dtype, T.ArrayType):
        return holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``target`` replaced by ``source`` rows of the same key, plus new ones."""
    extra = [c for c in version or [] if c not in target.columns]
    fresh = last_per_key(source, keys, version).drop(*extra)
    kept = target.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh)


def merge_update(target: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Overwrite every other column of rows whose key occurs in ``changes``; unknown keys do nothing."""
    rest = [c for c in target.columns if c != key]
    side = last_per_key(changes, [key]).select(key, F.struct(*[c if c in changes.columns else F.lit(None).alias(c) for c in rest]).alias("change"))
    joined = target.join(side, key, "left")
    value = lambda c: F.when(F.col("change").isNotNull(), F.col(f"change.{c}")).otherwise(F.col(c)).alias(c)
    return joined.select(*[F.col(key) if c == key else value(c) for c in target.columns])


def delete_rows(target: DataFrame, keys: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """Target without the rows named by ``keys`` or matching ``where``."""
    if keys is not None:
        return target.join(keys.distinct(), keys.columns, "left_anti")
    return target.filter(~F.coalesce(where, F.lit(False)))


def deleted_keys(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Each requested key once, with whether the target held it."""
    wanted = keys.distinct()
    found = target.select(*keys.columns).distinct().withColumn("existed", F.lit(True))
    return wanted.join(found, keys.columns, "left").withColumn("existed", F.coalesce("existed", F.lit(False)))
