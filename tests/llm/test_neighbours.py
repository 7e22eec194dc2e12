"""Small-world graphs against brute force."""

import math
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import hnsw, neighbours, queries  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int"


def clusters(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, dim))
    return (middles[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, dim))).astype(np.float32)


def exact(rows, every, k=10):
    """{query_id: [(distance, vec_id)]}, by ids: of several vectors with one id the nearest counts."""
    good = {}
    for vec_id, v, *_ in rows:
        if vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(vec_id, set()).add(tuple(np.float32(v).tolist()))
    out = {}
    for q, own in good.items():
        if q % every:
            continue
        near = []
        for other, vectors in good.items():
            gaps = [np.sqrt(((np.array(a) - np.array(b)) ** 2).sum()) for a in own for b in vectors if len(a) == len(b)]
            if other != q and gaps:
                near.append((min(gaps), other))
        out[q] = sorted(near)[:k]
    return out


def recall(got, want):
    """Share of the true neighbours found; checks ranks, order and scores of all that was returned."""
    hits = 0
    for q, near in want.items():
        mine = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, len(near) + 1))
        assert [(m[1], m[2]) for m in mine] == sorted((m[1], m[2]) for m in mine)
        hits += len({m[2] for m in mine} & {v for _, v in near})
    return hits / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("n", [1, 2, 13, 25, 300, 3000])
def test_graph(n):
    vectors = clusters(n)
    graph = hnsw.build(vectors)
    assert [len(x) for x in graph] == list(hnsw.levels(n))
    for level in graph:
        assert level.max(initial=-1) < len(level) and level.min(initial=0) >= -1
        assert not (level == np.arange(len(level))[:, None]).any()
        for row in level:
            assert len(set(row[row >= 0])) == (row >= 0).sum()
    assert hnsw._reached(graph[0]).all()
    found = hnsw.search(vectors, graph, vectors[:50], 48)
    if n > 48:
        found = found[:, :10]
    true = np.argsort(((vectors[None] - vectors[:50, None]) ** 2).sum(axis=2), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / len(b) for a, b in zip(found.tolist(), true.tolist(), strict=True)]) > 0.95


@pytest.mark.parametrize("shard_bytes", [neighbours.SHARD_BYTES, 16 * 4 * 100])
def test_search_against_brute_force(spark, shard_bytes):
    rows = [(k, v.tolist(), 0) for k, v in enumerate(clusters(1500))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = neighbours.search(neighbours.build_index(df, shard_bytes=shard_bytes), df.where("vec_id % 20 = 0")).collect()
    want = exact(rows, 20)
    assert recall(got, want) >= 0.95
    scores = {(r.query_id, r.vec_id): r.score for r in got}
    assert all(abs(scores[q, v] - d) < 1e-12 for q, near in want.items() for d, v in near if (q, v) in scores)


def test_copies_and_edge_rows(spark):
    v = clusters(40, dim=4)
    rows = [(k, x.tolist(), 1) for k, x in enumerate(v)]
    rows += [(k, v[0].tolist(), 1) for k in range(100, 400)]  # a group of copies far larger than a result
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 4, 1), (503, [1.0, None, 0.0, 0.0], 1), (504, [1.0, float("nan"), 0.0, 0.0], 1), (600, [float("inf"), 0.0, 0.0, 0.0], 1)]
    rows += [(None, v[1].tolist(), 1), (700, [1.0, 2.0], None), (701, [1.0, 2.5], None), (20, v[21].tolist(), 1), (20, v[20].tolist(), 1), (-100, v[3].tolist(), 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("rank", "ids", "dim", "shard", "score", "query_id", "turn", "shards"):
        df = df.withColumn(c, cases.F.lit("clash"))
    got = neighbours.table_neighbours(df, every=10).collect()
    want = exact(rows, 10)
    assert {(r.query_id, r.rank): r.vec_id for r in got} == {(q, i + 1): x[1] for q, near in want.items() for i, x in enumerate(near)}


def test_double_precision_vectors(spark):
    rows = [(k, [1.0 + k * 1e-12, 2.0]) for k in range(30)]
    got = neighbours.table_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=29, k=2).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got)] == [(0, 1, 1), (0, 2, 2), (29, 1, 28), (29, 2, 27)]


def test_empty_table(spark):
    assert neighbours.table_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whole_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert recall(queries.op13_vector_neighbours(spark, f"/root/testdata/{sf}").collect(), exact(rows, 100)) >= 0.9
