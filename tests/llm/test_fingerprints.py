"""Bottom-k fingerprints."""

import hashlib
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import fingerprints as fp  # noqa: E402


def jaccard(a, b):
    a, b = cases.shingles(a), cases.shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def sketch(text):
    return fp.sketches(pa.array([text]))[0]


def neighbours(spark, rows):
    from pyspark.sql import functions as F

    frame = cases.documents(spark, rows).withColumn("key", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    own = sorted(((r.doc_id is None, -(r.doc_id or 0), r.key, r.text or "", r.doc_id) for r in frame), key=lambda r: r[:4])
    return [(r[4], r[3], own[(i + 1) % len(own)][3]) for i, r in enumerate(own)]


@pytest.mark.parametrize(("n", "clashing"), [(1, False), (5, False), (40, True)])
def test_edits_of_edge_rows(spark, n, clashing):
    rows = cases.edge_rows()
    got = fp.edited_fingerprints(cases.documents(spark, rows, clashing), partitions=n).collect()
    want = []
    for doc_id, text, after in neighbours(spark, rows):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = sketch(text), sketch(changed), sketch(after)
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fp.to_text(a), fp.to_text(b), fp.resemblance(a, b), fp.resemblance(a, c), fp.distinct(a), fp.containment(a, b)))
    assert cases.collected(spark.createDataFrame(got)) == sorted(want, key=repr)


def test_small_tables(spark):
    assert fp.edited_fingerprints(cases.documents(spark, [])).count() == 0
    (row,) = fp.edited_fingerprints(cases.documents(spark, [(7, "a b c d e f", "en", "s", 1)])).collect()
    assert row.near_next == 1.0 and row.n_chars == 11
    assert row.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c d e f"[:5]).hexdigest()


def test_many_documents(spark):
    rng = random.Random(3)
    rows = [(i * 3, cases.prose(rng, rng.randint(0, 60)), "en", "s", 1) for i in range(300)]
    got = {r.doc_id: r for r in fp.edited_fingerprints(cases.documents(spark, rows).repartition(4), partitions=11).collect()}
    assert len(got) == 300
    for doc_id, text, after in neighbours(spark, rows):
        changed = fp.edited_text(text, after)
        assert got[doc_id].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[doc_id].near_edited == pytest.approx(jaccard(text, changed))  # these sets are smaller than a sketch
        assert got[doc_id].near_next == pytest.approx(jaccard(text, after))


def test_estimates_and_merging():
    rng = random.Random(4)
    errors = []
    for _ in range(30):
        base = cases.prose(rng, 3_000, 10**6).split()
        a, b = " ".join(base[:2_000]), " ".join(base[rng.randrange(1_900) :])
        x, y = sketch(a), sketch(b)
        errors.append(abs(fp.resemblance(x, y) - jaccard(a, b)))
        common = len(cases.shingles(a) & cases.shingles(b))
        assert abs(fp.containment(x, y) - common / len(cases.shingles(a))) < 0.3
        assert abs(fp.distinct(x) / len(cases.shingles(a)) - 1) < 0.35
        union = np.union1d(*(s for s in (x, y)))[: fp.K]
        assert (fp.merge(x, y) == union).all()
    assert max(errors) < 0.2 and sum(errors) / 30 < 0.05
    assert fp.resemblance(sketch(""), sketch("")) == 1.0 and fp.resemblance(sketch(""), sketch("a b")) == 0.0


def test_sketch_of_parts_equals_the_whole(spark):
    rng = random.Random(5)
    text = cases.prose(rng, 900, 10**6).split()
    parts = [(1, " ".join(text[max(0, i - 4) : i + 100])) for i in range(0, 900, 100)] + [(2, ""), (2, "a b")]
    rows = spark.createDataFrame(parts, "doc_id long, text string")
    sketches = fp.fingerprint(rows)
    got = {r.doc_id: r.fingerprint for r in fp.merged(sketches, "doc_id").collect()}
    assert got == {1: fp.to_text(sketch(" ".join(text))), 2: fp.to_text(sketch("a b"))}
    assert sorted((r.doc_id, r.fingerprint) for r in sketches.collect()) == sorted((d, fp.to_text(sketch(t))) for d, t in parts)
    assert (fp.from_text(fp.to_text(sketch("a b c d e f g")))[0] == sketch("a b c d e f g")).all()
