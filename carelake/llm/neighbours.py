"""Nearest vectors with one small-world graph per shard; the results of all shards are merged.

Equal vectors are one node, so a group of copies cannot fill the graph around them; a node keeps the smallest of its ids, as
many as a result can ever show. Nodes are dealt to shards by a hash of the vector. A task builds a shard's graph and stores it
as flat arrays, one row a shard. To search, the queries are stored once; each shard's task streams them in blocks, walks its
graph for a block at a time, measures what it found in double precision and passes on the nearest few of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import hnsw, scan
from carelake.session import materialise
from carelake.sources.blocks import blocks, stored

#: Results per query, nodes kept while searching a shard, and queries in a block.
NEAREST, EF, BLOCK = 10, 128, 512
#: A shard's vectors take at most so many bytes; a table has at least SHARDS shards if they hold LEAST vectors each.
SHARD_BYTES, SHARDS, LEAST = 16 << 20, 16, 256

#: Numbers that are held to measure what a block found.
_GAP_CELLS = 1 << 21

INDEX = "dim int, shard int, width int, vectors binary, ids binary, first_id binary, levels array<binary>"
FOUND = "query_id long, vec_id long, score double"


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows with an id whose vector is finite throughout and not zero; single precision stays single."""
    kind = dict(embeddings.dtypes)["embedding"]
    vector = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    infinite = F.lit(float("inf"))
    finite = F.forall("embedding", lambda x: F.coalesce((F.abs(x) < infinite) & ~F.isnan(x), F.lit(False)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding")).where("vec_id is not null and embedding is not null")
    return rows.where(finite & F.exists("embedding", lambda x: x != 0))


def _nodes(rows: DataFrame, k: int, shard_bytes: int) -> DataFrame:
    """(embedding, ids, dim, shard): distinct vectors with their ``k + 1`` smallest ids, the most a query can need of them.

    Repeated rows are removed and the ids of equal vectors cut to the smallest ones in each task before they are shuffled.
    """
    ranked = rows.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).where(F.col("rank") <= k + 1)
    nodes = ranked.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("embedding"))
    nodes = materialise(nodes, "ann-nodes")
    width = 4 if dict(nodes.dtypes)["embedding"] == "array<float>" else 8
    fewest = F.least(F.lit(SHARDS), F.ceil(F.count(F.lit(1)) / LEAST))
    shards = F.greatest(fewest, F.ceil(F.count(F.lit(1)) * F.col("dim") * width / shard_bytes)).cast("int").alias("shards")
    sizes = nodes.groupBy("dim").agg(shards)  # one row for each length of vectors
    total = sizes.agg(F.sum("shards")).first()[0] or 1
    dealt = nodes.join(F.broadcast(sizes), "dim").withColumn("shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int"))
    return dealt.repartition(2 * total, "dim", "shard")  # few shards meet in a task; without a number they would be put together


def _build(part: pa.Table) -> pa.Table:
    dim, shard = part.column("dim")[0].as_py(), part.column("shard")[0].as_py()
    vectors = part.column("embedding").combine_chunks()
    kind = vectors.type.value_type.to_pandas_dtype()
    vectors = vectors.flatten().to_numpy().astype(kind, copy=False).reshape(-1, dim)
    order = np.argsort(part.column("turn").to_numpy(), kind="stable")
    vectors = vectors[order]
    ids = part.column("ids").combine_chunks().take(pa.array(order))
    first = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy())))
    levels = hnsw.build(vectors)
    row = {
        "dim": dim, "shard": shard, "width": np.dtype(kind).itemsize, "vectors": vectors.tobytes(), "ids": ids.flatten().to_numpy().tobytes(),
        "first_id": first.astype(np.int64).tobytes(), "levels": [x.astype(np.int32).tobytes() for x in levels],
    }
    scan.release()
    return pa.Table.from_pylist([row], pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("width", pa.int32()), *[(c, pa.binary()) for c in ("vectors", "ids", "first_id")], ("levels", pa.list_(pa.binary()))]))


def build_index(embeddings: DataFrame, k: int = NEAREST, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A stored index of all usable vectors, one row a shard: vectors, the ids of each, and the neighbour arrays of all levels.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an id. Equal
    vectors are one node; other columns are ignored; an empty table gives an empty index. Vectors of different length are
    kept in different shards. ``k`` is the largest number of results that searches will ask for.
    """
    nodes = _nodes(usable(embeddings), k, shard_bytes).withColumn("turn", F.xxhash64("embedding", F.lit(1)))
    return materialise(nodes.select("dim", "shard", "embedding", "ids", "turn").groupBy("dim", "shard").applyInArrow(_build, INDEX), "ann-index")


def _nearest(query: np.ndarray, owner: np.ndarray, vectors: np.ndarray, ids: np.ndarray, first: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, vec_id, distance) of the ``k`` nearest ids among each query's ``nodes``, its own id left out."""
    row, column = np.nonzero(nodes >= 0)
    node = nodes[row, column]
    gap = vectors[node].astype(np.float64) - query[row].astype(np.float64)
    distance = np.sqrt((gap * gap).sum(axis=1))
    count = first[node + 1] - first[node]
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[node], count)
    row, distance, vec_id = np.repeat(row, count), np.repeat(distance, count), ids[at]
    other = vec_id != owner[row]
    row, distance, vec_id = row[other], distance[other], vec_id[other]
    order = np.lexsort((distance, vec_id, row))  # an id with several vectors counts once, with the nearest
    row, distance, vec_id = row[order], distance[order], vec_id[order]
    once = np.ones(len(row), bool)
    once[1:] = (row[1:] != row[:-1]) | (vec_id[1:] != vec_id[:-1])
    row, distance, vec_id = row[once], distance[once], vec_id[once]
    order = np.lexsort((vec_id, distance, row))
    row, distance, vec_id = row[order], distance[order], vec_id[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], vec_id[rank < k], distance[rank < k]


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST, ef: int = EF) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors found for each query (vec_id, embedding) but those of its id.

    Scores are Euclidean distances of the original vectors in double precision; ties go to the smaller vec_id. Of several
    vectors with one id the nearest counts. Queries that are not usable have no results. A shard gives at most ``k`` rows a
    query, which are cut to ``k`` in each task again before they are shuffled.
    """
    path = stored(usable(queries).distinct(), "ann-queries")
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {c: batch.column(j)[i] for j, c in enumerate(batch.schema.names)}
                dim = shard["dim"].as_py()
                vectors = np.frombuffer(shard["vectors"].as_buffer(), f"f{shard['width'].as_py()}").reshape(-1, dim)
                ids, first = (np.frombuffer(shard[c].as_buffer(), np.int64) for c in ("ids", "first_id"))
                width = [2 * hnsw.LINKS] + [hnsw.LINKS] * len(shard["levels"])
                graph = [np.frombuffer(x.as_buffer(), np.int32).reshape(-1, w) for x, w in zip(shard["levels"].values, width, strict=False)]
                for block in blocks(path, BLOCK, ["vec_id", "embedding"]):
                    fits = np.flatnonzero(block.column(1).value_lengths().to_numpy() == dim)
                    if not len(fits):
                        continue
                    block = block.take(pa.array(fits))
                    owner, query = block.column(0).to_numpy(), block.column(1).flatten().to_numpy().reshape(-1, dim)
                    step = max(1, _GAP_CELLS // (min(ef, len(vectors)) * dim))
                    for at in range(0, len(query), step):
                        part, own = query[at : at + step], owner[at : at + step]
                        row, vec_id, score = _nearest(part, own, vectors, ids, first, hnsw.search(vectors, graph, part, ef), k)
                        yield pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(vec_id), pa.array(score)], schema=out)
        scan.release()

    found = index.mapInArrow(walk, FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def table_neighbours(embeddings: DataFrame, every: int = 100, k: int = NEAREST) -> DataFrame:
    """The nearest vectors of each row whose vec_id is divisible by ``every``, among all other rows."""
    return search(build_index(embeddings, k), embeddings.where(F.col("vec_id") % every == 0), k)
