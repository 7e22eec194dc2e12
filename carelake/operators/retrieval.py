"""Exact vector and keyword retrieval over tables of questions, rank fusion, grounding, index upkeep."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from carelake.operators import keywords
from carelake.operators.corpus import augment_query
from carelake.operators.items import upsert
from carelake.operators.keywords import corpus_bm25_stats  # noqa: F401
from carelake.session import materialise, scratch_path
from carelake.sources.blocks import blocks, stored

# Questions that meet a task's documents at a time, and numbers of its documents that are held to meet them.
BLOCK_QUESTIONS = 4_096
_TASK_CELLS = 1 << 21

# Fusion constants.
FUSION_K = 60
DENSE_WEIGHT = 0.6

_DIGITS = keywords.DIGITS
_DENSE_CELLS = 1_000_000


def shard_filter(docs: DataFrame, shard: str | None) -> DataFrame:
    """One shard, pruned at planning where the table is partitioned by it; all without a shard."""
    return docs.filter(F.col("shard") == shard) if shard else docs


class _Best:
    """Running top ``k`` per question, ordered by score descending, then id; scores below ``floor`` never enter."""

    def __init__(self, n_queries: int, k: int, floor: float = -math.inf):
        self.k = k
        self.bar = np.full(n_queries, floor)
        self.scores = [np.empty(0) for _ in range(n_queries)]
        self.ids = [np.empty(0, dtype=object) for _ in range(n_queries)]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` is questions x documents; only questions with a contender are looked at."""
        contends = scores >= self.bar[:, None]
        for q in np.flatnonzero(contends.any(axis=1)):
            hit = np.flatnonzero(contends[q])
            s = np.concatenate([self.scores[q], scores[q, hit]])
            d = np.concatenate([self.ids[q], ids[hit]])
            if len(s) > self.k:
                keep = s >= np.partition(s, -self.k)[-self.k]
                s, d = s[keep], d[keep]
            order = sorted(range(len(s)), key=lambda i: (-s[i], d[i]))[: self.k]
            self.scores[q], self.ids[q] = s[order], d[order]
            if len(order) == self.k:
                self.bar[q] = max(self.bar[q], s[order[-1]])

    def table(self, query_ids: Sequence, schema: pa.Schema) -> pa.Table:
        qs = [query_ids[q] for q, found in enumerate(self.ids) for _ in found]
        ids = [i for found in self.ids for i in found]
        scores = [float(s) for found in self.scores for s in found]
        return pa.table([pa.array(qs, schema.field(0).type), pa.array(ids, schema.field(1).type), pa.array(scores, pa.float64())], schema=schema)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of an Arrow list column as one float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    sizes = np.asarray(pc.list_value_length(column))
    if rows and (sizes != sizes[0]).any():
        raise ValueError("vectors differ in length")
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(rows, -1)


def _cosine(queries: np.ndarray, docs: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(docs, axis=1)[None, :]
    return np.round(queries @ docs.T / (norms + 1e-9), _DIGITS)


def _hit_schema(queries: DataFrame, docs: DataFrame) -> T.StructType:
    fields = [("query_id", queries.schema["query_id"].dataType), ("doc_id", docs.schema["id"].dataType), ("score", T.DoubleType())]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def rank_hits(hits: DataFrame, k: int | None = None) -> DataFrame:
    """1-based rank within each question by score, ties by document id; ``k`` cuts the list."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    ranked = hits.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k) if k else ranked


def cosine_top_k(queries: DataFrame, docs: DataFrame, k: int, shard: str | None = None, block_rows: int = BLOCK_QUESTIONS) -> DataFrame:
    """Exact ``k`` nearest documents per question by cosine: ``query_id, doc_id, score, rank``.

    ``queries`` holds ``query_id, vector``; ``docs`` holds ``id, vector`` (and ``shard``). Questions are stored once in the
    shared folder. A task gathers its documents up to a bounded number of cells, streams the questions past them in blocks,
    and hands on ``k`` rows per question for each such part; so there is one scan of the documents whatever the number of
    questions, none of which passes the driver. The partial lists are cut to ``k`` per question in each task again before they
    are shuffled. Rows without a vector are skipped inside the kernel: as a filter, Spark would evaluate an encoder behind
    ``vector`` a second time. Every document row is a hit of its own, also where ids repeat; rows of a repeated question id
    compete for its ``k`` places; a zero vector scores 0; equal scores go by id.
    """
    docs = shard_filter(docs, shard).select("id", "vector")
    schema = _hit_schema(queries, docs)
    arrow = to_arrow_schema(schema)
    # an encoder behind the questions runs once, while they are stored
    path = stored(queries.select("query_id", F.col("vector").cast("array<double>").alias("vector")), "questions")

    def meet(ids: list, vectors: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, matrix = np.array(ids, dtype=object), np.concatenate(vectors)
        for block in blocks(path, block_rows):
            block = block.filter(block.column(1).is_valid())
            if not block.num_rows:
                continue
            asked = _matrix(block.column(1))
            best = _Best(len(asked), k)
            step = max(1, _DENSE_CELLS // len(asked))
            for at in range(0, len(found), step):
                best.add(_cosine(asked, matrix[at : at + step]), found[at : at + step])
            yield from best.table(block.column(0).to_pylist(), arrow).to_batches()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, cells = [], [], 0
        for batch in batches:
            filled = batch.filter(batch.column(1).is_valid())
            if not filled.num_rows:
                continue
            matrix = _matrix(filled.column(1))
            ids += filled.column(0).to_pylist()
            vectors.append(matrix)
            cells += matrix.size
            if cells > _TASK_CELLS:
                yield from meet(ids, vectors)
                ids, vectors, cells = [], [], 0
        if ids:
            yield from meet(ids, vectors)

    return rank_hits(docs.mapInArrow(score, schema), k)


def bm25_top_k(queries: DataFrame, docs: DataFrame, k: int, shard: str | None = None, block: int = keywords.BLOCK) -> DataFrame:
    """``k`` best documents per question by BM25, positive scores only: ``query_id, doc_id, score, rank``.

    ``queries`` holds ``query_id, text``. Statistics cover the filtered shard. The documents are indexed in the shared folder
    and searched there (see ``keywords``); an index that serves more than one table of questions is built once with
    ``keywords.build`` and asked with ``keyword_top_k``.
    """
    path = scratch_path(docs.sparkSession, "keywords")
    keywords.build(shard_filter(docs, shard).select("id", "text"), path, block=block)
    return keyword_top_k(queries, path, k)


def keyword_top_k(queries: DataFrame, path: str, k: int) -> DataFrame:
    """``bm25_top_k`` over a stored keyword index."""
    return rank_hits(keywords.search(queries, path, k), k)


def rrf(dense: DataFrame, keyword: DataFrame, alpha: float = DENSE_WEIGHT, k: int = FUSION_K) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists: one union, one aggregation, scores to 6 digits."""
    share = lambda weight: (F.lit(weight) / (F.lit(k) + F.col("rank"))).alias("share")
    both = dense.select("query_id", "doc_id", share(alpha)).unionByName(keyword.select("query_id", "doc_id", share(1.0 - alpha)))
    return both.groupBy("query_id", "doc_id").agg(F.round(F.sum("share"), 6).alias("score"))


def hybrid_retrieve(
    queries: DataFrame,
    docs: DataFrame,
    encoder: Callable[[list[str]], np.ndarray],
    top_k: int = 5,
    alpha: float = DENSE_WEIGHT,
    shard: str | None = None,
) -> DataFrame:
    """Dense and keyword lists of ``max(3 * top_k, 15)`` hits, fused and cut to ``top_k``.

    ``queries`` holds ``query_id, text`` and optionally ``features``, the patient sentence to
    append. A list whose weight is zero is not computed.
    """
    alpha = min(1.0, max(0.0, alpha))
    if "features" in queries.columns:
        queries = queries.withColumn("text", augment_query(F.col("text"), F.coalesce("features", F.lit(""))))
    queries = queries.select("query_id", "text")
    fetch = max(3 * top_k, 15)
    empty = queries.sparkSession.createDataFrame([], _hit_schema(queries, docs).add("rank", T.IntegerType()))
    dense = cosine_top_k(embed(queries, encoder), docs, fetch, shard) if alpha > 0 else empty
    keyword = bm25_top_k(queries, docs, fetch, shard) if alpha < 1 else empty
    return rank_hits(rrf(dense, keyword, alpha), top_k)


def embed(
    df: DataFrame, encoder: Callable[[list[str]], np.ndarray], text: str = "text", batch_size: int = 64, wanted: Column | None = None
) -> DataFrame:
    """Add ``vector``: the caller's encoder on batches of texts, each vector scaled to length 1.

    Only rows that are ``wanted`` (all, if not given) reach the encoder; others get null.
    """

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, asked in batches:
            asked = pc.fill_null(asked, False)
            some = pc.fill_null(texts.filter(asked), "").to_pylist()
            vectors, sizes = [np.empty(0, dtype=np.float32)], np.zeros(len(texts), dtype=np.int32)
            for at in range(0, len(some), batch_size):
                raw = np.asarray(encoder(some[at : at + batch_size]), dtype=np.float64)
                norms = np.linalg.norm(raw, axis=1, keepdims=True)
                vectors.append((raw / np.where(norms == 0, 1, norms)).astype(np.float32).ravel())
            if some:
                sizes[np.asarray(asked)] = raw.shape[1]
            ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            yield pa.ListArray.from_arrays(ends, pa.array(np.concatenate(vectors)), mask=pc.invert(asked))

    wanted = F.lit(True) if wanted is None else wanted
    return df.withColumn("vector", encode(F.when(wanted, F.col(text)), wanted))


def build_index(
    docs: DataFrame,
    encoder: Callable[[list[str]], np.ndarray],
    path: str,
    indexed_at: str,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Embed documents, put them over the stored ones and write the index partitioned by shard.

    ``path`` must be new: readers of the old index keep it until they switch.
    """
    fresh = embed(docs, encoder).withColumn("indexed_at", F.to_timestamp(F.lit(indexed_at)))
    fresh = materialise(fresh, "embedded") if stored is not None else fresh  # the merge reads it twice
    merged = upsert(stored, fresh, ["id"], ["indexed_at"]) if stored is not None else fresh
    merged.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(merged.schema).parquet(path)


def shard_stats(docs: DataFrame) -> DataFrame:
    """Documents and last index time per shard, with a total row (shard null)."""
    return docs.rollup("shard").agg(F.count(F.lit(1)).alias("doc_count"), F.max("indexed_at").alias("last_indexed"))


def index_metadata(stored: DataFrame, docs: DataFrame) -> DataFrame:
    """Last indexed count and time per shard, merged into the stored table."""
    fresh = shard_stats(docs).filter(F.col("shard").isNotNull()).select(
        "shard", "doc_count", F.date_format("last_indexed", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("indexed_at")
    )
    return upsert(stored, fresh, ["shard"], ["indexed_at"])


def snippet(text: Column, length: int = 300) -> Column:
    return F.substring(text, 1, length)


def passages(hits: DataFrame, docs: DataFrame, length: int | None = None) -> DataFrame:
    """Hits with the text and source of their document and the score to 4 digits; ``length`` makes it a snippet."""
    text = F.col("text") if length is None else snippet(F.col("text"), length)
    side = docs.select(F.col("id").alias("doc_id"), text.alias("text"), "source")
    return hits.join(side, "doc_id").withColumn("score", F.round("score", 4))


def context_block(ranked: DataFrame) -> DataFrame:
    """Numbered passages of each question as one text; a question holds its top ``k`` passages only."""
    entry = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] [source: "), F.col("doc_id").cast("string"), F.lit("] ("),
        F.coalesce("source", F.lit("")), F.lit(")\n"), F.trim(F.coalesce("text", F.lit(""))),
    )
    grouped = ranked.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("entries"))
    return grouped.select("query_id", F.array_join(F.transform("entries", lambda e: e["entry"]), "\n\n").alias("context"))


def cited_sources(answers: DataFrame, ranked: DataFrame) -> DataFrame:
    """Passages whose id occurs in the question's answer; the best passage where none does."""
    joined = ranked.join(answers, "query_id").withColumn("cited", F.contains("answer", F.col("doc_id").cast("string")))
    any_cited = F.max("cited").over(Window.partitionBy("query_id"))
    chosen = joined.withColumn("any_cited", any_cited).filter(F.col("cited") | (~F.col("any_cited") & (F.col("rank") == 1)))
    return chosen.drop("any_cited", "answer")


def ungrounded_terms(answer: Column, passage_texts: Column) -> Column:
    """Capitalised words of six letters or more (with a strength, if any) that no passage contains.

    Without passages nothing is flagged.
    """
    # Fixed value: the term pattern, word boundaries by Unicode.
    pattern = r"(?U)\b([A-Z][a-z]{5,}(?:\s+\d+\s*MG)?)\b"
    corpus = F.lower(F.array_join(passage_texts, " "))
    found = F.array_distinct(F.regexp_extract_all(answer, F.lit(pattern), 1))
    missing = F.filter(found, lambda t: ~F.contains(corpus, F.lower(t)))
    return F.when(F.coalesce(F.size(passage_texts), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(missing)


def answer_checks(results: DataFrame, shortest: int = 10) -> DataFrame:
    """Per model: whether all answers reach the shortest length, how many do, sources and latency."""
    answered = F.length(F.trim(F.coalesce("answer", F.lit("")))) >= shortest
    return results.groupBy("model").agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if(answered).alias("answered"),
        F.sum("sources").alias("sources"),
        F.round(F.avg("latency_ms"), 3).alias("avg_latency_ms"),
        F.bool_and(answered).alias("passed"),
    )
