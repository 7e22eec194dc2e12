"""The Jaccard join, its signatures and connected components against brute force."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import jaccard, links, scan  # noqa: E402


def brute(rows):
    sets = [cases.shingles(r[1], True) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(i)
    out = []
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in group]
    return sorted(out, key=repr)


def test_signatures_take_at_most_four_bits_a_shingle_and_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for n in (40, 200, 1_000, 3_000):
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        kept = np.sort(rng.permutation(base)[: n - n // 9])
        a, b = (np.frombuffer(jaccard.signature(s), np.uint64) for s in (base, kept))
        assert 64 * len(a) <= max(64, 4 * len(base))
        words = min(len(a), len(b))
        assert jaccard.overlap_bound(jaccard.fold(a, words), jaccard.fold(b, words), len(base), len(kept)) >= len(kept)


@pytest.mark.parametrize("clashing", [False, True])
def test_edge_rows(spark, clashing):
    rows = cases.edge_rows()
    assert cases.collected(jaccard.near_duplicates(cases.documents(spark, rows, clashing))) == brute(rows)
    assert jaccard.near_duplicates(cases.documents(spark, [])).count() == 0


def corpus(seed, n=260):
    """Copies at and around the limit, chains, shared passages, short texts."""
    rng = random.Random(seed)
    passage = cases.prose(rng, 60)
    rows = []
    while len(rows) < n:
        kind = rng.random()
        if kind < 0.4 and rows:
            _, base, *_ = rng.choice(rows)
            text = cases.edited(rng, base, rng.randint(0, max(1, len(base.split()) // 20)))
        elif kind < 0.6:
            text = passage + " " + cases.prose(rng, rng.choice([2, 8, 14, 40]))
        elif kind < 0.7:
            text = cases.prose(rng, rng.randint(1, 6), 5)
        else:
            text = cases.prose(rng, rng.choice([10, 60, 150]))
        rows.append((len(rows), text, "en", "s", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert cases.collected(jaccard.near_duplicates(cases.documents(spark, rows))) == brute(rows)


def test_frequent_shingles_and_many_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = corpus(3, 200)
    assert cases.collected(jaccard.near_duplicates(cases.documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("crowd", [1, jaccard.CROWD])
def test_near_copies_are_verified_in_their_block_not_as_all_their_pairs(spark, monkeypatch, crowd):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    kept, keep = {}, jaccard.materialise

    def noted(df, name):
        kept[name] = keep(df, name)
        return kept[name]

    monkeypatch.setattr(jaccard, "materialise", noted)
    rng = random.Random(12)
    base = cases.prose(rng, 40).split()
    texts = []
    for i in range(240):  # likeness of two copies is close to the limit, on either side
        words = list(base)
        words[rng.randrange(2, 6)] = f"left{i % 60}"
        words[rng.randrange(34, 38)] = f"right{i // 4}"
        texts.append(" ".join(words))
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(300, cases.prose(rng, 30), "en", "s", 1)]
    assert cases.collected(jaccard.near_duplicates(cases.documents(spark, rows))) == brute(rows)
    assert kept["jaccard-pairs"].count() <= 2 * kept["jaccard-rest"].count()


def test_a_block_hands_on_no_more_than_twice_its_rows():
    rng = np.random.default_rng(13)
    base = rng.integers(0, 1 << 62, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[:86], rng.integers(0, 1 << 62, 14).astype(np.uint64)))) for _ in range(60)]
    key = (5, 6, 0, 0, 0)
    row = lambda i, value: (*key, 100 + i, len(sets[i]), i, True, i % 2, value)
    screened = jaccard._screened([row(i, jaccard.signature(s)) for i, s in enumerate(sets)])
    assert 0 < len(screened) <= 2 * len(sets)
    near = [np.unique(np.concatenate((base[:96], rng.integers(0, 1 << 62, 4).astype(np.uint64)))) for _ in range(60)]
    sets[:] = near
    screened = jaccard._screened([row(i, jaccard.signature(s)) for i, s in enumerate(sets)])
    assert [r[:3] for r in screened] == [(100 + i, None, 5) for i in range(60)]
    assert len(jaccard._forest([row(i, s.tobytes()) for i, s in enumerate(sets)])) == 59


def test_no_frequent_list_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 10**9)
    rows = corpus(4, 150)
    assert cases.collected(jaccard.near_duplicates(cases.documents(spark, rows))) == brute(rows)


def test_signatures_never_rule_out_an_overlap():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a = np.unique(scan.mix(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)))
        b = np.unique(scan.mix(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)))
        x, y = (np.frombuffer(jaccard.signature(s), np.uint64) for s in (a, b))
        n = min(len(x), len(y))
        assert jaccard.overlap_bound(jaccard.fold(x, n), jaccard.fold(y, n), len(a), len(b)) >= len(np.intersect1d(a, b))


def test_shingles_match_words(monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    texts = ["".join(rng.choice(["a", "B", "b", " ", "\n", "\t", "é", "\x0b", "\x1c"]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    for size in (16, 1 << 20):
        monkeypatch.setattr(scan, "CHUNK", size)
        got = list(scan.shingle_sets(pa.array(texts), True))
        for i in range(0, 400, 7):
            for j in range(0, 400, 11):
                assert len(np.intersect1d(got[i], got[j])) == len(cases.shingles(texts[i], True) & cases.shingles(texts[j], True))


def test_components(spark):
    rng = random.Random(10)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0
