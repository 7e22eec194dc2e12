"""Quality rules: counted base rules, then a calibrated classifier on hashed word and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import linear, scan
from carelake.llm.sample import bounded

#: Labelled rows the classifier is fitted on at most (chosen by the hash of doc_id), and the part of them kept for calibration.
SAMPLE_ROWS = 4_000
CALIBRATION = 0.25
#: Hash dimensions for words, word pairs and character trigrams each.
DIMS = 1 << 15
EPOCHS = 60
#: A text goes when its calibrated probability of good quality is below this.
THRESHOLD = 0.3
LEAST_WORDS = 10
MOST_REPEATED = 20
SYMBOLS = b"#*$%&|<>"

_NEWLINE = np.arange(256) == 10
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_HEAD_BYTE = (np.arange(256) & 0xC0) != 0x80
_GROUPS = 3
RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def _repeats(hashes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value, whether an equal one stands elsewhere in its document, and whether one stands earlier."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off)).astype(np.uint64)
    key = scan.mix(hashes ^ scan.mix(doc))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def rule_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counted rules for each text of a slice, and word hashes with their offsets."""
    starts, ends, word_off = scan.words(data, off)
    hashes = scan.word_hashes(data, starts, ends)
    lines, line_ends, line_off = scan.words(data, off, _NEWLINE)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, lines)
    _, earlier = _repeats(scan.word_hashes(data, lines, line_ends), line_off)
    n = len(hashes)
    window = np.zeros(n, np.uint64)
    whole = np.zeros(n, bool)
    if n >= scan.SHINGLE:
        doc = np.repeat(np.arange(len(off) - 1), np.diff(word_off))
        whole[: n - 4] = doc[4:] == doc[: n - 4]
        for k in range(scan.SHINGLE):
            window[: n - 4] = scan.mix(window[: n - 4] + hashes[k : n - 4 + k])
    at = np.flatnonzero(whole)
    twice, _ = _repeats(window[at], np.searchsorted(at, word_off))
    cover = np.zeros(n + scan.SHINGLE + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + scan.SHINGLE, -1)
    covered = np.cumsum(cover)[:n] > 0
    return {
        "n_words": np.diff(word_off),
        "word_chars": scan.sums(_HEAD_BYTE[data] & ~scan.BLANK[data], off),
        "n_symbols": scan.sums(_SYMBOL[data], off),
        "n_dup_lines": scan.sums(worded & earlier, line_off),
        "n_repeat_words": scan.sums(covered, word_off),
        "hashes": hashes,
        "word_off": word_off,
    }


def _grams(data: np.ndarray, off: np.ndarray, hashes: np.ndarray, word_off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(dimension of every n-gram, offsets per text) for words, word pairs and character trigrams."""
    shift = np.uint64(64 - DIMS.bit_length() + 1)
    pairs, pair_off = scan.shingles(hashes, word_off, 2)
    size = np.maximum(np.diff(off) - 2, 0)
    gram_off = np.concatenate(([0], np.cumsum(size)))
    packed = np.zeros(len(data), np.uint32)
    if len(data) > 2:
        packed[:-2] = data[:-2].astype(np.uint32) | (data[1:-1].astype(np.uint32) << 8) | (data[2:].astype(np.uint32) << 16)
    grams = packed[np.arange(gram_off[-1]) + np.repeat(off[:-1] - gram_off[:-1], size)]
    grams = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIMS.bit_length() + 1)
    return [((hashes >> shift).astype(np.int64), word_off), ((pairs >> shift).astype(np.int64) + DIMS, pair_off), (grams.astype(np.int64) + 2 * DIMS, gram_off)]


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(labels, dimensions, shares) of the sampled rows; a share is an n-gram's part of its kind in the text."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    known = bounded(known.groupBy("doc_id").agg(F.min("quality").alias("quality")), rows, "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, off in scan.chunks(batch.column("text")):
                counts = rule_counts(data, off)
                kinds = _grams(data, off, counts["hashes"], counts["word_off"])
                found, shares = [], []
                for i in range(len(off) - 1):
                    parts = [np.unique(g[o[i] : o[i + 1]], return_counts=True) for g, o in kinds]
                    found.append(np.concatenate([p[0] for p in parts]).astype(np.int32))
                    shares.append(np.concatenate([p[1] / max(p[1].sum(), 1) for p in parts]).astype(np.float32))
                n = len(off) - 1
                columns = [batch.column("doc_id").slice(first, n), batch.column("quality").slice(first, n), pa.array(found, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "dims", "shares"])

    table = documents.join(F.broadcast(known), "doc_id").select("doc_id", "text", "quality").mapInArrow(scan.released(task), "doc_id long, quality int, dims array<int>, shares array<float>")
    table = table.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().combine_chunks()
    split = lambda c: (lambda x: np.split(x.flatten().to_numpy(), x.offsets.to_numpy()[1:-1]))(table.column(c).combine_chunks()) if len(table) else []
    return table.column("quality").to_numpy().astype(float), split("dims"), split("shares")


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """(weights, bias) on the scale of calibrated log-odds of good quality.

    Only ``rows`` labelled rows are used; their features, not their texts, come to the driver.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    y, dims, shares = _sample(docs, labels, rows)
    cut = len(y) - int(len(y) * CALIBRATION)
    join = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
    off = np.concatenate(([0], np.cumsum([len(d) for d in dims]))).astype(np.int64)
    index, values = join(dims, np.int32), join(shares, np.float32) * np.float32(10)
    w, b = linear.fit(index[: off[cut]], values[: off[cut]], off[: cut + 1], y[:cut], _GROUPS * DIMS, EPOCHS)
    z = scan.sums(w[index] * values, off) + b
    slope, shift = linear.calibrate(z[cut:], y[cut:])
    if slope <= 0:
        slope, shift = 1.0, 0.0
    return w * 10 * slope, b * slope + shift


def score(documents: DataFrame, weights: np.ndarray, bias: float, threshold: float = THRESHOLD) -> DataFrame:
    """Rule counts, calibrated probability of good quality and the verdict for every row of ``documents`` (doc_id, text).

    Null and empty texts have no words and fail the base rules; repeated rows are scored each for itself; other columns
    are ignored; an empty table gives no rows. Without usable labels every text that passes the base rules is kept.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), float(bias)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in batches:
            for first, data, off in scan.chunks(batch.column("text")):
                counts = rule_counts(data, off)
                z = np.full(len(off) - 1, b)
                for gram, gram_off in _grams(data, off, counts["hashes"], counts["word_off"]):
                    z += scan.sums(w[gram].astype(np.float64), gram_off) / np.maximum(np.diff(gram_off), 1)
                probability = linear.sigmoid(z)
                failed = (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])
                columns = [batch.column("doc_id").slice(first, len(off) - 1), *(pa.array(counts[r].astype(np.int64)) for r in RULES)]
                columns += [pa.array(failed), pa.array(probability), pa.array(~failed & (probability >= threshold))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *RULES, "base_failed", "probability", "kept"])

    return docs.mapInArrow(scan.released(task), RESULT)


def verdict_udf(weights: np.ndarray, bias: float, threshold: float = THRESHOLD):
    """A column function text -> kept, for filters that pass all other columns on."""
    packed = (weights.astype(np.float32), float(bias))

    @F.arrow_udf("boolean")
    def kept(text: pa.Array) -> pa.Array:
        w, b = packed
        out = []
        for _, data, off in scan.chunks(text):
            counts = rule_counts(data, off)
            z = np.full(len(off) - 1, b)
            for gram, gram_off in _grams(data, off, counts["hashes"], counts["word_off"]):
                z += scan.sums(w[gram].astype(np.float64), gram_off) / np.maximum(np.diff(gram_off), 1)
            failed = (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])
            out.append(~failed & (linear.sigmoid(z) >= threshold))
        scan.release()
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return kept


def quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``score`` with a classifier trained on ``labels`` (doc_id, quality 0 or 1)."""
    return score(documents, *train(documents, labels, rows), threshold)
