"""Toxicity, quality rules and licence scans."""

import os
import random
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import licenses, linear, quality, sample, scan, toxicity  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"


def labelled(seed, n=600):
    """Toxic texts use a hidden word list; poor texts are symbol soup."""
    rng = random.Random(seed)
    bad = [f"grobian{i}" for i in range(6)] + ["idiot", "stupid", "moron"]
    rows, labels = [], []
    for i in range(n):
        text, toxic, good = cases.prose(rng, rng.choice([15, 60, 200]), 3_000).split(), rng.random() < 0.15, rng.random() < 0.8
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        if not good:
            text = [w + rng.choice(["$$$", "###", "&&&"]) for w in text]
        rows.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled(1)
    docs, marks = cases.documents(spark, rows), spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    toxic = {d: t for d, _, t in labels}
    for held in (True, False):
        own = [r for r in got.values() if r.held_out == held]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in own)
        assert sum(r.predicted == toxic[r.doc_id] for r in own) / len(own) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, q, t in labels]
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs.repartition(3), spark.createDataFrame(flipped, LABELS)).collect()}
    assert all(got[d].score == pytest.approx(again[d]) for d in got)


@pytest.mark.parametrize("labels", [[], [(None, None, None), (1, None, None)], [(4, 1, 0), (4, 0, 1), (-3, 1, 1), (99, 1, 1)]])
def test_toxicity_edge_rows(spark, labels):
    rows = cases.edge_rows()
    got = toxicity.toxicity(cases.documents(spark, rows, clashing=True), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in rows), key=repr)
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in got if r.doc_id == 4}) == 1
    assert toxicity.toxicity(cases.documents(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0


def test_toxicity_without_labels_uses_the_lists(spark):
    rows, _ = labelled(2, 300)
    rows += [(1_000 + i, cases.prose(random.Random(i), 20) + " you stupid idiot , pathetic loser", "en", "s", 1) for i in range(40)]
    got = {r.doc_id: r.score for r in toxicity.toxicity(cases.documents(spark, rows), spark.createDataFrame([], LABELS)).collect()}
    assert min(got[1_000 + i] for i in range(40)) > 0.3
    assert np.mean([got[r[0]] < 0.3 for r in rows[:300] if not re.search("idiot|stupid|moron", r[1])]) > 0.95


def test_label_model_finds_rates_and_correlated_voters():
    rng = np.random.default_rng(3)
    n = 20_000
    y = rng.random(n) < 0.2
    votes = np.zeros((n, toxicity.N_VOTERS), int)
    for v in range(6):
        votes[:, v] = np.where(y, rng.random(n) < 0.7, rng.random(n) < 0.03)
    votes[:, 6] = np.where(rng.random(n) < 0.95, votes[:, 0], 1 - votes[:, 0])
    code = votes @ (1 << np.arange(toxicity.N_VOTERS))
    codes, place, counts = np.unique(code, return_inverse=True, return_counts=True)
    model = toxicity.LabelModel(codes, counts, np.zeros((len(codes), 2)))
    assert abs(model.prior - 0.2) < 0.03
    assert any({0, 6} <= set(g) for g in model.groups)
    assert np.mean((model.posterior()[place] > 0.5) == y) > 0.97
    assert abs(model.accuracies()[1] - np.mean(votes[:, 1] == y)) < 0.03


def rules(text):
    text = text or ""
    w = cases.words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    repeated = {x for x in windows if windows.count(x) > 1} if len(windows) < 3_000 else set()
    cover = {i + k for i, x in enumerate(windows) if x in repeated for k in range(5)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if cases.words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def test_rule_counts(spark):
    rng = random.Random(4)
    texts = [r[1] for r in cases.edge_rows() if r[0] != 7]
    texts += ["".join(rng.choice(["a", "b", " ", " ", "\n", "é", "#", "|"]) for _ in range(rng.randint(0, 80))) for _ in range(200)]
    texts += ["a b c d e a b c d e", "a b c d a b c d", "x\nx\n \n \nx ", "a a a a a a", "\n".join(["one two three four five six"] * 4)]
    import pyarrow as pa

    for _, data, off in scan.chunks(pa.array(texts, pa.string()), 500):
        counts = quality.rule_counts(data, off)
        got = list(zip(*(counts[r].tolist() for r in quality.RULES), strict=True))
        decoded = [bytes(data[off[i] : off[i + 1]]).decode() for i in range(len(off) - 1)]
        assert got == [rules(t) for t in decoded]


def test_quality_on_rows_outside_the_sample(spark):
    rows, labels = labelled(5, 500)
    docs, marks = cases.documents(spark, rows), spark.createDataFrame(labels, LABELS)
    good = {d: q for d, q, _ in labels}
    got = quality.quality(docs, marks, rows=250).collect()
    passed = [r for r in got if not r.base_failed]
    assert sum(r.kept == bool(good[r.doc_id]) for r in passed) / len(passed) > 0.97
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    assert all(r.kept == (not r.base_failed and r.probability >= quality.THRESHOLD) for r in got)
    assert got and sorted(r.doc_id for r in got) == list(range(500))


@pytest.mark.parametrize("labels", [[], [(None, None, None)], [(4, 1, 0), (4, 0, 1), (-3, 1, 1)]])
def test_quality_edge_rows(spark, labels):
    rows = cases.edge_rows()
    got = quality.quality(cases.documents(spark, rows, clashing=True), spark.createDataFrame(labels, LABELS)).collect()
    want = sorted(((r[0], *rules(r[1])[:4]) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) for r in got), key=repr) == want
    assert not any(r.kept for r in got if r.n_words < 10)
    assert quality.quality(cases.documents(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0


def test_bounded_samples(spark):
    table = spark.range(5_000).withColumnRenamed("id", "doc_id")
    chosen = [r.doc_id for r in sample.bounded(table, 1_000, "doc_id").collect()]
    assert len(set(chosen)) == 1_000 and max(chosen) > 4_000
    assert sorted(chosen) == sorted(r.doc_id for r in sample.bounded(table.repartition(9), 1_000, "doc_id").collect())
    assert sample.bounded(table, 10_000, "doc_id").count() == 5_000 and sample.bounded(table.limit(0), 5, "doc_id").count() == 0


def test_linear_fit_and_calibration():
    rng = np.random.default_rng(6)
    n = 2_000
    index = rng.integers(0, 50, (n, 8))
    y = (index < 10).sum(axis=1) >= 2
    w, b = linear.fit(index.ravel(), np.ones(n * 8), np.arange(0, n * 8 + 1, 8), y.astype(float), 50, 200)
    z = w[index].sum(axis=1) + b
    assert np.mean((z > 0) == y) > 0.97
    scores = rng.normal(0, 2, 5_000)
    truth = rng.random(5_000) < linear.sigmoid(0.5 * scores + 1)
    slope, shift = linear.calibrate(scores, truth.astype(float))
    assert abs(slope - 0.5) < 0.07 and abs(shift - 1) < 0.12


def license_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_licenses_against_all_windows(spark):
    rng = random.Random(7)
    rows = cases.edge_rows()
    names = list(licenses.TEMPLATES)
    for i in range(150):
        text = cases.prose(rng, rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            notice = licenses.TEMPLATES[rng.choice(names)].split()
            if rng.random() < 0.3:
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(text))
            text = text[:at] + " " + " ".join(notice).upper() + ".\n" + text[at:]
        rows.append((100 + i, text, "en", "s", 1))
    want = []
    for r in rows:
        w = license_words(r[1])
        sequence = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
        for name in names:
            t = license_words(licenses.TEMPLATES[name])
            template = {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
            scale = 1 << (len(template) - 1).bit_length()
            found = [len(template & set(sequence[s : s + 2 * scale])) for s in range(0, len(sequence), scale)]
            found = [m for m in found if 100 * m >= 80 * len(template)]
            if found:
                want.append((r[0], name, max(found), len(template), len(found)))
    got = licenses.scan_licenses(cases.documents(spark, rows, clashing=True)).collect()
    assert sorted(((r.doc_id, r.license, r.matched, r.template_shingles, r.n_windows) for r in got), key=repr) == sorted(want, key=repr)
    by_id = {r[0]: license_words(r[1]) for r in rows}
    for r in got:
        assert r.containment == r.matched / r.template_shingles >= 0.8
        assert by_id[r.doc_id][r.first_word] and r.first_word <= r.last_word < len(by_id[r.doc_id])
    assert len(want) > 100 and licenses.scan_licenses(cases.documents(spark, [])).count() == 0
