"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, and a linear classifier.

Voters look at distinct lower-case words and word beginnings. Some of their word lists are fixed, others are found in a
bounded sample of labelled rows. A label model with two classes learns from the vote patterns of all documents how often
each voter fires in each class; voters that stay correlated within the classes are put in one group and get a joint
table instead of separate rates. Its posteriors, joined with the label as one more, nearly sure voter, are the targets of
a logistic regression on hashed words, word beginnings and voters, which scores all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import linear, scan
from carelake.llm.sample import bounded

#: Labelled rows (chosen by the hash of doc_id) that lists and classifier are fitted on at most.
SAMPLE_ROWS = 8_000
#: Rows with this remainder of crc32(doc_id as text) by 4 are held out: their labels are never used.
HELD_OUT, FOLDS = 2, 4
THRESHOLD = 0.3
EPOCHS = 150
#: Documents of the sample that must have a word before it counts as evidence.
LEAST_SEEN = 5
#: Log-odds above which a word joins a voter's list.
STRONG = 2.5
#: Trust in a given label, as the rate at which it is right.
LABEL_RATE = 0.98
#: Correlation within a class above which two voters are modelled together, and the size of such a group.
CORRELATED, GROUP = 0.15, 4
PREFIX = 5

# Fixed word list: common English insults.
INSULTS = ("clown", "disgusting", "dumb", "fool", "garbage", "idiot", "idiots", "imbecile", "jerk", "loser", "losers", "moron", "morons", "pathetic", "scum", "stupid", "trash", "ugly", "vermin", "worthless")
# Fixed word list: words that address or point at somebody.
POINTERS = ("a", "an", "are", "is", "like", "such", "you", "your", "youre")

BITS = 22
N_VOTERS = 10
_FIXED, _FIXED_TWICE, _MINED, _MINED_PREFIX, _MINED_MANY, _POINTED, _SHOUT = 0, 1, 2, 6, 7, 8, 9


def _ids(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _word_ids(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = scan.words(data, np.array([0, len(data)]), scan.NON_LETTER)
    return _ids(scan.word_hashes(data, starts, ends))


def _word_lists() -> tuple[np.ndarray, np.ndarray]:
    """Which ids are those of the fixed words, and of the pointing ones; made once in a task."""
    fixed, pointers = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, bool)
    fixed[_word_ids(INSULTS)] = True
    pointers[_word_ids(POINTERS)] = True
    return fixed, pointers


def _features(column: pa.Array, lists: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, feature ids, offsets, pattern votes): ids of all words, then of their beginnings, text by text."""
    fixed, pointers = lists
    for first, raw, off in scan.chunks(column):
        data = scan.LOWER[raw]
        starts, ends, word_off = scan.words(data, off, scan.NON_LETTER)
        ids = _ids(scan.word_hashes(data, starts, ends))
        begin = _ids(scan.word_hashes(data, starts, ends, PREFIX)) + (1 << BITS)
        pointed = np.zeros(len(ids), bool)
        pointed[1:] = fixed[ids[1:]] & pointers[ids[:-1]]
        pointed[word_off[:-1][word_off[:-1] < len(ids)]] = False
        upper = scan.sums((raw >= 65) & (raw <= 90), off)
        letters = scan.sums((data >= 97) & (data <= 122), off)
        votes = ((scan.sums(pointed, word_off) > 0) << _POINTED) | (((upper * 2 > letters) & (letters > 20)) << _SHOUT)
        merged = np.empty(2 * len(ids), np.int64)
        merged[0::2], merged[1::2] = ids, begin
        yield first, merged, 2 * word_off, votes


def _votes(ids: np.ndarray, off: np.ndarray, pattern: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Vote bits per text. ``kind`` holds per feature: 0, or 1 fixed, or 2 + voter for found words, or both (+ 16)."""
    hit = np.flatnonzero(kind[ids])
    doc = np.searchsorted(off, hit, "right") - 1
    pair = np.unique(doc.astype(np.int64) << 32 | ids[hit])
    doc, k = pair >> 32, kind[pair & 0xFFFFFFFF]
    n = len(off) - 1
    fixed = np.bincount(doc, k & 1, n)
    found = np.bincount(doc, k > 1, n)
    out = pattern | ((fixed > 0) << _FIXED) | ((fixed > 1) << _FIXED_TWICE) | ((found > 2) << _MINED_MANY)
    for voter in range(_MINED, _MINED_PREFIX + 1):
        out |= (np.bincount(doc, (k >> 1) == voter, n) > 0) << voter
    return out


class LabelModel:
    """Two classes; each group of voters has a table P(votes of the group | class).

    Fitted by expectation maximisation on counts of vote patterns, where counts of labelled rows keep their class (up to
    LABEL_RATE). The first fit treats every voter by itself and yields the residual correlations that form the groups.
    """

    def __init__(self, codes: np.ndarray, unlabelled: np.ndarray, labelled: np.ndarray):
        self.codes, self.bits = codes, (codes[:, None] >> np.arange(N_VOTERS)) & 1
        self.weight = np.stack((unlabelled, labelled[:, 0], labelled[:, 1]), axis=1).astype(float)
        self.groups = [[v] for v in range(N_VOTERS)]
        self.prior = 0.1
        seed = np.clip(0.02 + 0.25 * (self.bits[:, :_POINTED].sum(axis=1)), 0, 0.98)
        self._fit(seed)
        seed, self.groups = self.posterior(), self._grouped()
        self._fit(seed)

    def _pattern(self, group: list[int]) -> np.ndarray:
        return (self.bits[:, group] << np.arange(len(group))).sum(axis=1)

    def _mass(self, p: np.ndarray) -> np.ndarray:
        sure = np.stack((p, np.full(len(p), 1 - LABEL_RATE), np.full(len(p), LABEL_RATE)), axis=1)
        return np.stack(((self.weight * (1 - sure)).sum(axis=1), (self.weight * sure).sum(axis=1)))

    def _fit(self, p: np.ndarray, steps: int = 50) -> None:
        for _ in range(steps):
            mass = self._mass(p)
            self.prior = float(np.clip(mass[1].sum() / max(mass.sum(), 1e-9), 1e-4, 0.5))
            self.tables = []
            for group in self.groups:
                counts = np.stack([np.bincount(self._pattern(group), m, 1 << len(group)) for m in mass]) + 0.1
                self.tables.append(counts / counts.sum(axis=1, keepdims=True))
            p = self.posterior()

    def posterior(self) -> np.ndarray:
        """P(toxic | votes) for each known pattern."""
        odds = np.full(len(self.codes), np.log(self.prior / (1 - self.prior)))
        for group, table in zip(self.groups, self.tables, strict=True):
            pattern = self._pattern(group)
            odds += np.log(table[1][pattern]) - np.log(table[0][pattern])
        return linear.sigmoid(odds)

    def accuracies(self) -> np.ndarray:
        """P(voter agrees with the class), voter by voter."""
        mass = self._mass(self.posterior())
        return (mass[1] @ self.bits + mass[0] @ (1 - self.bits)) / max(mass.sum(), 1e-9)

    def correlations(self) -> np.ndarray:
        """Correlation of each two voters within the classes, averaged over the classes by mass."""
        out = np.zeros((N_VOTERS, N_VOTERS))
        mass = self._mass(self.posterior())
        for m in mass:
            total = max(m.sum(), 1e-9)
            centred = self.bits - m @ self.bits / total
            cov = (centred * m[:, None]).T @ centred / total
            spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            out += cov / np.outer(spread, spread) * (total / max(mass.sum(), 1e-9))
        return out

    def _grouped(self) -> list[list[int]]:
        """Voters joined along the strongest correlations, up to GROUP in one group."""
        strength = np.abs(self.correlations())
        group = {v: [v] for v in range(N_VOTERS)}
        pairs = sorted(((strength[i, j], i, j) for i in range(N_VOTERS) for j in range(i)), reverse=True)
        for s, i, j in pairs:
            if s >= CORRELATED and group[i] is not group[j] and len(group[i]) + len(group[j]) <= GROUP:
                merged = group[i] + group[j]
                group.update(dict.fromkeys(merged, merged))
        return [list(g) for g in {id(g): g for g in group.values()}.values()]


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> pa.Table:
    """label (null without labels), distinct features and pattern votes of the sampled rows."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) != HELD_OUT)
    known = bounded(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), rows, "doc_id")
    if known.isEmpty():
        known = bounded(documents.where("doc_id is not null").select("doc_id").distinct(), rows, "doc_id").withColumn("toxic", F.lit(None).cast("int"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = _word_lists()
        for batch in batches:
            for first, ids, off, votes in _features(batch.column("text"), lists):
                found = [np.unique(ids[off[i] : off[i + 1]]).astype(np.int32) for i in range(len(off) - 1)]
                n = len(found)
                columns = [batch.column("doc_id").slice(first, n), batch.column("toxic").slice(first, n), pa.array(found, pa.list_(pa.int32())), pa.array(votes.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "features", "votes"])

    chosen = documents.join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")
    table = chosen.mapInArrow(scan.released(task), "doc_id long, toxic int, features array<int>, votes int").dropDuplicates(["doc_id"])
    return table.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().combine_chunks()


def _vote_counts(documents: DataFrame, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vote patterns, documents with each) over all documents; at most 2 ** N_VOTERS rows come back."""
    shared = documents.sparkSession.sparkContext.broadcast((np.flatnonzero(kind), kind[kind > 0]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 << BITS, np.int8)
        table[shared.value[0]] = shared.value[1]
        total, lists = np.zeros(1 << N_VOTERS, np.int64), _word_lists()
        for batch in batches:
            for _, ids, off, votes in _features(batch.column(0), lists):
                total += np.bincount(_votes(ids, off, votes, table), minlength=1 << N_VOTERS)
        codes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), pa.array(total[codes])], ["code", "n"])

    rows = documents.select("text").mapInArrow(scan.released(task), "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return rows.column("code").to_numpy().astype(np.int64), rows.column("n").to_numpy()


class Classifier(NamedTuple):
    """Weights of chosen words and word beginnings, and of the voters; ``listed`` are the features of the voters' lists."""

    features: np.ndarray
    weights: np.ndarray
    voters: np.ndarray
    bias: float
    listed: np.ndarray
    kinds: np.ndarray


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Classifier:
    """The classifier. Labels of held-out rows are never read into it."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = _sample(docs, labels, rows)
    if not len(table):
        return Classifier(np.zeros(0, np.int64), np.zeros(0), np.zeros(N_VOTERS), -3.0, np.zeros(0, np.int64), np.zeros(0, np.int64))
    features = table.column("features").combine_chunks()
    ids, off = features.flatten().to_numpy().astype(np.int64), features.offsets.to_numpy().astype(np.int64)
    label = table.column("toxic").to_numpy().astype(float)
    given = ~np.isnan(label)
    row = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(off))
    # the sample's distinct features are few beside all hash values, so tables are kept for those alone
    known, ids = np.unique(ids, return_inverse=True)
    ids = ids.astype(np.int32)
    in_toxic = np.bincount(ids, (label == 1)[row], len(known))
    in_clean = np.bincount(ids, (label == 0)[row], len(known))
    odds = np.log((in_toxic + 0.5) / ((label == 1).sum() + 1)) - np.log((in_clean + 0.5) / ((label == 0).sum() + 1))
    kind = np.zeros(2 << BITS, np.int8)
    kind[_word_ids(INSULTS)] = 1
    strong = np.flatnonzero((in_toxic >= LEAST_SEEN) & (odds >= STRONG) & (in_clean <= in_toxic / 10))
    for f in known[strong].tolist():
        voter = _MINED_PREFIX if f >> BITS else _MINED + f % (_MINED_PREFIX - _MINED)
        kind[f] = (kind[f] & 1) | voter << 1
    codes, counts = _vote_counts(docs, kind)
    votes = _votes(known[ids], off, table.column("votes").to_numpy().astype(np.int64), kind)
    codes, place = np.unique(np.concatenate((codes, votes)), return_inverse=True)
    all_counts = np.bincount(place[: len(counts)], counts, len(codes))
    mine = place[len(counts) :]
    labelled = np.stack([np.bincount(mine[label == c], minlength=len(codes)) for c in (0, 1)], axis=1)
    model = LabelModel(codes, np.maximum(all_counts - labelled.sum(axis=1), 0), labelled)
    target = model.posterior()[mine]
    trust = np.log(LABEL_RATE / (1 - LABEL_RATE)) * np.where(given, np.where(label == 1, 1, -1), 0)
    target = linear.sigmoid(np.log(np.clip(target, 1e-9, 1 - 1e-9) / np.clip(1 - target, 1e-9, 1)) + trust)
    soft = np.bincount(ids, target[row], len(known))
    seen = np.bincount(ids, minlength=len(known))
    rate = target.mean()
    z = (soft - seen * rate) / np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-9))
    chosen = np.flatnonzero((seen >= LEAST_SEEN) & ((np.abs(z) >= 4) | (kind[known] > 0)))
    place = np.full(len(known), -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    keep = place[ids] >= 0
    fired = (votes[:, None] >> np.arange(N_VOTERS)) & 1
    # a row's features are its chosen words, then the voters that fire on it
    owner = np.concatenate((row[keep], np.nonzero(fired)[0]))
    index = np.concatenate((place[ids[keep]], len(chosen) + np.nonzero(fired)[1]))
    order = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[order], np.arange(len(label) + 1))
    w, b = linear.fit(index[order], np.ones(len(index)), bounds, target, len(chosen) + N_VOTERS, EPOCHS, l2=1e-5)
    return Classifier(known[chosen], w[: len(chosen)], w[len(chosen) :], b, np.flatnonzero(kind), kind[kind > 0])


class Scorer:
    """A classifier's tables by feature, made once in a task."""

    def __init__(self, model: Classifier):
        self.model, self.lists = model, _word_lists()
        self.weight, self.kind = np.zeros(2 << BITS, np.float32), np.zeros(2 << BITS, np.int8)
        self.weight[model.features] = model.weights
        self.kind[model.listed] = model.kinds

    def scores(self, column: pa.Array) -> np.ndarray:
        out = []
        for _, ids, off, votes in _features(column, self.lists):
            hit = np.flatnonzero(self.weight[ids])
            pair = np.unique((np.searchsorted(off, hit, "right") - 1).astype(np.int64) << 32 | ids[hit])
            words = np.bincount(pair >> 32, self.weight[pair & 0xFFFFFFFF], len(off) - 1)
            fired = (_votes(ids, off, votes, self.kind)[:, None] >> np.arange(N_VOTERS)) & 1
            out.append(linear.sigmoid(words + fired @ self.model.voters + self.model.bias))
        return np.concatenate(out) if out else np.zeros(0)


def score_udf(model: Classifier):
    """A column function text -> score."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        try:
            for text in batches:
                yield pa.array(scorer.scores(text), pa.float64())
        finally:
            scan.release()

    return score


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``documents`` (doc_id, text).

    Null and empty texts get the classifier's score without any word, which is low; repeated rows get equal scores; a null
    id is not held out; other columns are ignored; an empty table gives no rows; without labels the fixed lists alone
    guide the label model.
    """
    score = score_udf(train(documents, labels, rows))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    out = documents.select("doc_id", held_out.alias("held_out"), score(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
