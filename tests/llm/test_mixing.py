"""Weighted fair queueing against a sequential version."""

import hashlib
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import mixing  # noqa: E402


def water_fill(sizes, share=1.5, cap=2.0):
    """Targets by dealing the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = budget - sum(capped.values())
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > cap * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in order}
        capped |= {s: cap * sizes[s] for s in over}


def queue(rows):
    """Times each row is taken: one copy after the other by virtual finish time until the budget is reached."""
    sized = [(r[0], r[3], len(cases.words(r[1]))) for r in rows]
    queue_of = {s: "n" if s is None else "s" + s for _, s, _ in sized}
    place = [hashlib.md5("/".join(str(x) for x in (d, n, queue_of[s]) if x is not None).encode()).hexdigest() for d, s, n in sized]
    sizes = {}
    for _, s, n in sized:
        sizes[s] = sizes.get(s, 0) + n
    target = water_fill(sizes)
    copies = []
    for s in sizes:
        upto = 0
        own = sorted((i for i in range(len(rows)) if sized[i][1] == s), key=lambda i: place[i])
        for turn in range(2):
            for i in own:
                upto += sized[i][2]
                if sized[i][2] and target[s] and upto - sized[i][2] < target[s]:
                    copies.append((upto / target[s], queue_of[s], place[i], turn, i))
    times, total = dict.fromkeys(range(len(rows)), 0), 0
    for *_, i in sorted(copies):
        if total + sized[i][2] > sum(target.values()):
            break
        total += sized[i][2]
        times[i] += 1
    return sorted(((d, n, sizes[s], round(target[s], 6), times[i] * n, times[i]) for i, (d, s, n) in enumerate(sized)), key=repr)


def got(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken, r.times) for r in df.collect()), key=repr)


def corpus(seed, n=300):
    rng = random.Random(seed)
    return [(i, cases.prose(rng, rng.choice([1, 5, 30, 120])), "en", rng.choice(["hot", "hot", "hot", "b", "c", "ä", "Z", None]), 1) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_sequential_queue(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    rows = corpus(seed)
    result = got(mixing.mix(cases.documents(spark, rows, clashing=seed == 2)))
    assert result == queue(rows)
    assert result == got(mixing.mix(cases.documents(spark, rows).repartition(7)))


def test_every_source_comes_near_its_target(spark):
    rows = corpus(4, 600)
    source = {r[0]: r[3] for r in rows}
    taken, target, largest = {}, {}, {}
    for doc_id, size, source_size, goal, words, times in got(mixing.mix(cases.documents(spark, rows))):
        s = source[doc_id]
        taken[s], target[s], largest[s] = taken.get(s, 0) + words, goal, max(largest.get(s, 0), size)
        assert times <= 2 and words == times * size and goal <= 2 * source_size
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]


def test_edge_rows(spark):
    rows = [r for r in cases.edge_rows()]
    result = got(mixing.mix(cases.documents(spark, rows, clashing=True)))
    want = queue(rows)
    assert [r[:4] for r in result] == [r[:4] for r in want]
    assert sum(r[4] for r in result) == sum(r[4] for r in want)
    assert mixing.mix(cases.documents(spark, [])).count() == 0
    blank = mixing.mix(cases.documents(spark, [(1, " ", "en", "a", 1), (2, None, "en", None, 1)])).collect()
    assert [(r["size"], r.taken) for r in blank] == [(0, 0), (0, 0)]


def test_target_levels(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 3, "d": 50, None: 7}, {"a": 5}, {"a": 0, "b": 9}, {"x": 1, "y": 1, "z": 1}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        assert {r.source: pytest.approx(r.target) for r in mixing.targets(rows).collect()} == water_fill(sizes)
