"""A stored vector index kept up by id: files in buckets, vectors used again where the text is the same.

Below the index's folder, ``rows`` holds the documents by bucket and shard, ``layout`` one row that says how buckets are found,
and ``pending`` the new files of an update until they are in place.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

import numpy as np
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.rows import null_safe_equal
from carelake.operators.retrieval import embed
from carelake.session import materialise, shuffles_freed
from carelake.sources.blocks import resolve

# Rows a bucket is laid out for; the number of buckets stays between the two bounds, beyond which buckets hold more rows.
BUCKET_ROWS = 1 << 16
_BUCKETS = (16, 1 << 14)
_PLACE = ["bucket", "shard"]
# Keys that are broadcast at most.
_FEW_KEYS = 100_000

Encoder = Callable[[list[str]], np.ndarray]


def create(docs: DataFrame | Sequence[DataFrame], encoder: Encoder, path: str, indexed_at: str, route: str = "id", buckets: int | None = None) -> None:
    """Write a new index of ``id, text, shard`` and any other columns, encoding each document once.

    ``route`` is the SQL expression whose hash names a document's bucket. By id, an update reads and writes the buckets of its
    ids alone; by what updates come in (a patient, say), their documents share a bucket, and an update looks its ids up in the
    id column of the whole index first. Rows may share an id; null is an id like others; an empty shard is null. Documents given
    in several parts are written part by part, so that disk holds the shuffles of one part beside the index.
    """
    parts = [docs] if isinstance(docs, DataFrame) else list(docs)
    spark = parts[0].sparkSession
    with shuffles_freed(spark):
        if buckets is None:
            buckets = min(_BUCKETS[1], max(_BUCKETS[0], math.ceil(sum(part.count() for part in parts) / BUCKET_ROWS)))
        # rows of a place meet, so folders hold few files; places beyond the advised partition size are split again. Texts move
        # without their vectors, and the hash of a text, which takes as much room as a short one, follows from it
        places = [_keyed(part, route, buckets).drop("text_hash").hint("rebalance", *_PLACE) for part in parts]
        rows = [_encoded(part, encoder, indexed_at) for part in places]
        spark.createDataFrame([(buckets, route, rows[0].schema.json())], "buckets int, route string, schema string").write.parquet(f"{path}/layout")
        for i, part in enumerate(rows):
            _write(part, path, "append" if i else "errorifexists")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents with ``vector``, ``text_hash``, ``indexed_at`` and ``encoded_at``; a filter on ``shard`` prunes files."""
    return _rows(spark, path, _layout(spark, path)).filter(F.col("indexed_at").isNotNull()).drop("bucket")


def update(spark: SparkSession, path: str, docs: DataFrame, encoder: Encoder, indexed_at: str) -> None:
    """Put documents over the stored ones of the same id; files of other buckets and shards stay as they are.

    All stored rows of an id give way to all rows the run has of it. A document whose id and text (by SHA-256) are stored keeps
    its vector and ``encoded_at``; only others reach the encoder. One that changes its shard or bucket leaves the old place. The
    new files are stored under ``pending`` before Spark swaps them in; a run that dies in between is completed by the next one or
    by ``recover``. Readers should not read during the swap. ``docs`` is read twice, for keys and for texts, and must give the
    same rows.
    """
    with shuffles_freed(spark):
        _update(spark, path, docs, encoder, indexed_at)


def _update(spark: SparkSession, path: str, docs: DataFrame, encoder: Encoder, indexed_at: str) -> None:
    recover(spark, path)
    layout = _layout(spark, path)
    columns = _schema(layout).names
    names = [n for n in columns if n not in ("vector", "text_hash", "indexed_at", "encoded_at")] + ["text_hash"]
    asked = _keyed(docs, layout["route"], layout["buckets"]).select(*names)
    keys = materialise(asked.select("id", "text_hash", *_PLACE), "index-keys")
    stored = _rows(spark, path, layout)
    looked = stored.filter(F.col("bucket").isin(_numbers(keys))) if layout["route"] == "id" else stored
    few = keys.count() <= _FEW_KEYS
    held = _semi(looked.select("id", *_PLACE), keys, ["id"], few=few).select(*_PLACE)
    # no more rows than the index has folders
    places = materialise(held.unionByName(keys.select(*_PLACE)).distinct(), "index-places")
    old = _semi(stored.filter(F.col("bucket").isin(_numbers(places))), places, _PLACE).filter(F.col("indexed_at").isNotNull())

    first = F.min("encoded_at").alias("encoded_at")
    vectors = _semi(old.select("id", "text_hash", "vector", "encoded_at"), keys, ["id"], few=few).groupBy("id", "text_hash").agg(F.min_by("vector", "encoded_at").alias("known"), first)
    same = null_safe_equal("new", "old", ["id", "text_hash"])
    joined = asked.alias("new").join(vectors.alias("old"), same, "left").select("new.*", "old.known", "old.encoded_at")
    time = _time(indexed_at)
    fresh = embed(joined, encoder, wanted=F.col("known").isNull()).select(
        *names, F.coalesce("known", "vector").alias("vector"), time.alias("indexed_at"), F.coalesce("encoded_at", time).alias("encoded_at")
    )
    kept = _semi(old, keys, ["id"], "left_anti", few)
    # Spark's swap replaces folders that get rows: one that loses its last document gets a row without a time, which read() leaves out
    filled = kept.select(*_PLACE).unionByName(keys.select(*_PLACE))
    merged = kept.unionByName(fresh).unionByName(_semi(places, filled, _PLACE, "left_anti"), allowMissingColumns=True)
    pending = merged.select(*columns).hint("rebalance", *_PLACE).write.mode("overwrite").option("partitionOverwriteMode", "static")
    pending.partitionBy(*_PLACE).parquet(f"{path}/pending", compression="zstd")
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> None:
    """Complete an update whose new files are all stored, if there is one; may be repeated."""
    system, root = resolve(f"{path}/pending")
    if system.get_file_info(f"{root}/_SUCCESS").type != fs.FileType.File:
        return  # none was begun, or it died before it touched the index
    layout = _layout(spark, path)
    pending = spark.read.schema(_schema(layout)).parquet(f"{path}/pending")
    if not pending.isEmpty():
        _write(pending, path, "overwrite")
        spark.createDataFrame([], _schema(layout)).write.mode("overwrite").parquet(f"{path}/pending")


def _layout(spark: SparkSession, path: str) -> dict:
    return spark.read.schema("buckets int, route string, schema string").parquet(f"{path}/layout").first().asDict()


def _schema(layout: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(layout["schema"]))


def _rows(spark: SparkSession, path: str, layout: dict) -> DataFrame:
    """The stored rows with the hash of their text."""
    return spark.read.schema(_schema(layout)).parquet(f"{path}/rows").withColumn("text_hash", _hash())


def _write(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*_PLACE).parquet(f"{path}/rows", compression="zstd")


def _keyed(docs: DataFrame, route: str, buckets: int) -> DataFrame:
    """Documents with the hash of their text and their place."""
    shard = F.nullif(F.col("shard").cast("string"), F.lit(""))
    bucket = F.pmod(F.xxhash64(F.expr(route)), F.lit(buckets)).cast("int")
    return docs.withColumns({"shard": shard, "text_hash": _hash(), "bucket": bucket})


def _hash() -> Column:
    return F.sha2("text", 256)


def _encoded(rows: DataFrame, encoder: Encoder, at: str) -> DataFrame:
    return embed(rows, encoder).withColumns({"indexed_at": _time(at), "encoded_at": _time(at)})


def _time(at: str) -> Column:
    return F.to_timestamp(F.lit(at))


def _numbers(places: DataFrame) -> list[int]:
    """Bucket numbers, no more than the layout has."""
    return [r["bucket"] for r in places.select("bucket").distinct().collect()]


def _semi(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left_semi", few: bool = False) -> DataFrame:
    """Rows with (or without) a partner; null equals null. ``few`` partners are broadcast."""
    partners = right.select(*columns)
    partners = F.broadcast(partners) if few else partners
    return left.alias("l").join(partners.alias("r"), null_safe_equal("l", "r", columns), how)
