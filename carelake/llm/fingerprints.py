"""Bottom-k sketches of word shingles: mergeable, with estimates of resemblance, containment and distinct shingles.

A fingerprint is a string: the sketch size, a colon, and the base64 text of the smallest ``k`` distinct shingle hashes in
ascending order (big-endian, 64 bits). With fewer than ``k`` hashes the sketch holds the whole set and all estimates are
exact. The sketch of a union of parts is the bottom-k of the union of their sketches.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import scan
from carelake.session import materialise

K = 128
EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles double, kept_share double"


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The smallest ``k`` of sorted distinct hashes."""
    return hashes[:k]


def to_text(sketch: np.ndarray, k: int = K) -> str:
    return f"{k}:{base64.b64encode(sketch.astype('>u8').tobytes()).decode()}"


def from_text(fingerprint: str) -> tuple[np.ndarray, int]:
    k, _, body = fingerprint.partition(":")
    return np.frombuffer(base64.b64decode(body), ">u8").astype(np.uint64), int(k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated |A and B| / |A or B|; two empty sets are alike."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return int(np.searchsorted(common, union[-1], "right")) / len(union)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated |A and B| / |A|; an empty set is contained in any."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def sketches(column: pa.Array, k: int = K) -> list[np.ndarray]:
    return [bottom(s, k) for s in scan.shingle_sets(column)]


def fingerprint(documents: DataFrame, k: int = K) -> DataFrame:
    """doc_id, fingerprint, n_shingles (estimate) per row; null texts count as empty, other columns are ignored."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sketches(batch.column(1), k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([to_text(s, k) for s in found], pa.string()), pa.array([distinct(s, k) for s in found], pa.float64())], ["doc_id", "fingerprint", "n_shingles"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(task, "doc_id long, fingerprint string, n_shingles double")


def merged(fingerprints: DataFrame, *by: str, k: int = K) -> DataFrame:
    """One fingerprint per group of ``fingerprints`` (columns ``by`` and ``fingerprint``): the sketch of all its parts.

    Hashes are counted distinct per group and cut to the smallest ``k`` by a group limit before any shuffle of rows, so a
    group of any size reaches a task as ``k`` hashes from each earlier task.
    """
    raw = F.unbase64(F.substring_index("fingerprint", ":", -1))
    n = F.floor(F.octet_length("raw") / 8).cast("int")
    hashes = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(F.col("raw"), i * 8 - 7, F.lit(8)))
    rows = fingerprints.select(*by, raw.alias("raw")).where(n > 0).select(*by, F.explode(hashes).alias("hash")).distinct()
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("hash"))).where(F.col("rank") <= k)
    joined = F.concat(F.lit(f"{k}:"), F.base64(F.unhex(F.concat_ws("", F.transform(F.array_sort(F.collect_list("hash")), F.hex)))))
    return first.groupBy(*by).agg(F.regexp_replace(joined, r"\s", "").alias("fingerprint"))


def edited_text(text: str, following: str) -> str:
    """``text`` whose last half is replaced by as many first code points of ``following`` (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_fingerprints(documents: DataFrame, k: int = K, partitions: int | None = None) -> DataFrame:
    """Fingerprints of every text and of the text mixed with its successor, and how alike sketches find them.

    ``n_shingles`` estimates the text's distinct shingles, ``kept_share`` the share of them that the edited text contains.

    The successor of a document is the next one in descending doc_id, of the last the first; null texts are empty. Equal
    ids follow the order of their texts' hash, a null id comes last; repeated rows succeed one another; a single row
    succeeds itself; other columns are ignored; an empty table gives no rows.
    The texts are shuffled once. Cut points split the ids into ranges; the first document of each range also goes to the
    range before it, where it only serves as successor.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = materialise(docs.select("doc_id", F.xxhash64("text").alias("key")), "fingerprint-ids")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({int(x) for x in ids.where("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)}, reverse=True) if n > 1 else []
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    # range r holds the ids below its cut and not below the next one; null ids go last
    place = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(F.size(F.filter(bounds, lambda b: b > F.col("doc_id")))).cast("int")
    order = [F.col("doc_id").desc_nulls_last(), F.col("key").asc()]
    first = F.struct(F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit(str(2**64)).cast("decimal(20,0)")).alias("down"), F.col("key"), F.col("doc_id"))
    heads = ids.withColumn("range", place).groupBy("range").agg(F.min(first).alias("head")).orderBy("range").collect()  # one row a range
    keyed = docs.withColumn("key", F.xxhash64("text")).withColumn("range", place).withColumn("is_head", F.lit(0))
    copies = [(r["head"]["doc_id"], r["head"]["key"], heads[i - 1]["range"]) for i, r in enumerate(heads)]
    extra = F.broadcast(spark.createDataFrame(copies, "head_id long, head_key long, copy_to int"))  # one row a range
    is_it = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key"))
    places = F.array(F.struct("range", "is_head"), F.struct(F.col("copy_to").alias("range"), F.lit(1).alias("is_head")))
    keyed = keyed.join(extra, is_it, "left").withColumn("copy", F.explode(F.filter(places, lambda c: c["range"].isNotNull())))
    keyed = keyed.select("doc_id", "text", "key", "copy.range", "copy.is_head")
    placed = keyed.repartitionById(n, "range").sortWithinPartitions("range", "is_head", *order)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_shingles", pa.float64()), ("kept_share", pa.float64())])

    def rows(pairs: list[tuple]) -> pa.RecordBatch:
        texts = [p[1] for p in pairs] + [pairs[-1][2]]
        changed = [edited_text(t, f) for _, t, f in pairs]
        own, other = sketches(pa.array(texts, pa.large_string()), k), sketches(pa.array(changed, pa.large_string()), k)
        out = []
        for i, (doc_id, text, following) in enumerate(pairs):
            after = own[i + 1] if texts[i + 1] is following or texts[i + 1] == following else sketches(pa.array([following], pa.large_string()), k)[0]
            sha = hashlib.sha256(changed[i].encode()).hexdigest()
            out.append((doc_id, len(text), sha, to_text(own[i], k), to_text(other[i], k), resemblance(own[i], other[i], k), resemblance(own[i], after, k), distinct(own[i], k), containment(own[i], other[i], k)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pairs, held = None, [], 0
        for batch in batches:
            for doc_id, text, at, is_head in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if last is not None and last[2] == at:
                    pairs.append((last[0], last[1], text))
                    held += len(text)
                last = None if is_head else (doc_id, text, at)
                if held > scan.CHUNK:
                    yield rows(pairs)
                    pairs, held = [], 0
        if pairs:
            yield rows(pairs)

    return placed.mapInArrow(task, EDITED)
