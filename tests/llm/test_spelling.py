"""Spelling variants against all pairs of words."""

import os
import random
import re
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import queries, spelling  # noqa: E402

SF = "/root/testdata/sf0.001"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def plain_variants(words):
    gaps = {}
    for w in words:  # words one edit apart share a word with one character less, or one is it
        for i in range(len(w)):
            gaps.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        gaps.setdefault(w, set()).add(w)
    around = {w: set() for w in words}
    for group in gaps.values():
        for a in group:
            around[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in words.items():
        top = min(around[w], key=lambda b: (-words[b], b), default=None)
        form[w] = top if top is not None and words[top] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(around[w]), None if form[w] is None else words[form[w]]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_variants_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abéÉ") for _ in range(rng.randint(1, 5))): rng.choice([5, 6, 30, 31, 160, 900, 5000]) for _ in range(400)}
    got = cases.collected(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain_variants(words)


def test_pairs_are_found_once(spark):
    words = [("aaaa", 1), ("aaa", 1), ("aab", 1), ("abab", 1), ("aabab", 1), ("aba", 1), ("z", 1)]
    got = [(r.word, r.near) for r in spelling.neighbours(spark.createDataFrame(words, "word string, n long")).collect()]
    want = [(a, b) for a, _ in words for b, _ in words if near(a, b)]
    assert sorted(got) == sorted(want)


def test_group_over_many_batches(spark):
    words = [("wort" + chr(c), 5 + c) for c in [*range(97, 123), *range(0xC0, 0x100)]] + [("wort", 9)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = cases.collected(spelling.variants(spark.createDataFrame(words, "word string, n long")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_variants(dict(words))


def test_edge_rows(spark):
    rng = random.Random(2)
    rows = cases.edge_rows() + [(k, "Straße STRASSE École école Ähnlich Kelvinİstanbul naïve×÷abc " * 5, "de", "s", 1) for k in range(20)]
    rows += [(None, "wooden wodden wood3en woodens " * 6, None, None, None), (77, "hospital hospitl hospitale " * 40, "en", "s", 1)]
    rows += [(1000 + k, " ".join(rng.choice(["claims", "Claims"] * 30 + ["claimss", "clayms", "claymss"]) for _ in range(300)), "en", "s", 1) for k in range(300)]
    got = cases.collected(spelling.document_variants(cases.documents(spark, rows, clashing=True)))
    assert got == plain_variants(plain_words([(r[0], r[1]) for r in rows]))
    assert any(r[1] for r in got)


def test_empty_table(spark):
    assert spelling.document_variants(cases.documents(spark, [])).count() == 0


def test_whole_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert cases.collected(queries.op12_spelling_variants(spark, SF)) == plain_variants(plain_words(rows))
