"""Token ids in Re-Pair grammar files: a writer in doc_id order and a reader with access to single documents.

A file is a run of blocks. A block holds the ids of consecutive documents as one sequence in which frequent adjacent
pairs were replaced, round after round, by nonterminals; its rules, the expansion length of every rule, and for each
document its first symbol and its first id. A pair never spans two documents, so one document is decoded from its own
symbols. Layout of a block, all integers little-endian: the lengths of the parts (six uint64: documents, symbols, rules,
and the bytes of the three compressed parts), then, each deflated: symbols (low 16 bits of each, then the 17th bits
packed), rules (left and right uint32, expansion length uint32), and the document index (doc_id int64, null flag uint8,
first symbol uint64, first id uint64, counted from the block's start).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import files, scan, tokens
from carelake.session import scratch_path

END_ID = 0
#: Ids of a block (a longer document is a block of its own).
BLOCK_IDS = 1 << 20
#: Rules a round may add, and those of a block, whose numbers have 16 bits.
ROUND_RULES, MOST_RULES = 4_096, 1 << 16
#: Occurrences that make a pair worth a rule.
LEAST = 16
NONTERMINAL = 1 << 16
MANIFEST = "shard int, file string, documents long, ids long, bytes long, sha1 string"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"

_HEAD = "<6Q"
_BUCKETS = 18
#: A symbol is an id below 2^16 or a nonterminal below 2^17; places of a block's symbols have 30 bits but in giant documents.
_SYMBOL_BITS, _PLACE_BITS = 17, 30
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: In place of a bucket where a pair would span two documents.
_CUT = 1 << _BUCKETS


def _peaks(weight: np.ndarray) -> np.ndarray:
    """Positions of local maxima, no two of them adjacent; on a plateau every second position."""
    starts = np.flatnonzero(np.concatenate(([True], weight[1:] != weight[:-1])))
    value = weight[starts]
    peak = value > 0
    peak[1:] &= value[1:] > value[:-1]
    peak[:-1] &= value[:-1] > value[1:]
    lens = np.diff(np.append(starts, len(weight)))[peak]
    picks = (lens + 1) // 2
    first = np.cumsum(picks) - picks
    return np.repeat(starts[peak] - 2 * first, picks) + 2 * np.arange(picks.sum())


def replace_pairs(symbols: np.ndarray, firsts: np.ndarray, round_rules: int = ROUND_RULES, least: int = LEAST):
    """(symbols, first symbol per document, rules) after Re-Pair over one block, until no pair occurs ``least`` times.

    Adjacent pairs are counted by hash bucket once, and a round counts anew those beside its replacements. It counts exactly in the
    fullest buckets, each of which stands for its most frequent pair. It replaces those occurrences that beat both neighbouring pairs in frequency, then in the same way what is
    left between them, so no two replacements overlap. Pairs that overlap themselves (as in a run of one symbol) count in full
    but are replaced every second time.
    """
    rules: list[np.ndarray] = []
    n_rules = 0
    symbols = symbols.copy()
    bucket = _bucket(symbols[:-1], symbols[1:])
    bucket[firsts[(firsts > 0) & (firsts < len(symbols))] - 1] = _CUT
    filled = np.bincount(bucket, minlength=_CUT + 1)
    while len(symbols) >= 2 * least and n_rules < MOST_RULES:
        room = min(round_rules, MOST_RULES - n_rules)
        # more buckets are counted exactly than there is room for rules, as a full one may hold rare pairs alone
        full = np.flatnonzero(filled[:_CUT] >= least)
        if not len(full):
            break
        leads, starts, at = _leaders(symbols, bucket, full[np.argsort(-filled[full], kind="stable")[: 2 * round_rules]])
        if len(full) > 2 * round_rules and not (leads >= least).any():
            leads, starts, at = _leaders(symbols, bucket, full)
        kept = np.argsort(-leads, kind="stable")[:room]
        kept = kept[leads[kept] >= least]
        if not len(kept):
            break
        leads, starts = leads[kept], starts[kept]
        pairs = np.stack((symbols[at[starts]], symbols[at[starts] + 1]), axis=1).astype(np.uint32)
        ends = np.cumsum(leads)
        places = at[np.repeat(starts - ends + leads, leads) + np.arange(ends[-1])]
        # a pair has 16 bits here, and its place the others
        places = np.sort((places << 16) | np.repeat(np.arange(len(kept)), leads))
        places, which = places >> 16, places & 0xFFFF
        chosen = _winners(places, leads[which])
        wins, rule = places[chosen], which[chosen]
        used = np.flatnonzero(np.bincount(rule, minlength=len(pairs)))
        number = np.zeros(len(pairs), np.int64)
        number[used] = np.arange(len(used))
        rules.append(pairs[used])
        symbols[wins] = (NONTERMINAL + n_rules + number[rule]).astype(np.uint32)
        n_rules += len(used)
        gone = wins + 1
        firsts = firsts - np.searchsorted(gone, firsts)
        # a replaced pair goes, and those beside it are pairs of the new symbol; the others and their buckets stay as they are
        before = bucket[wins]
        left = np.ones(len(symbols), bool)
        left[gone] = False
        symbols = symbols[left]
        bucket = bucket[left[1:]]  # of a replaced pair, the symbol after its place is gone
        now = wins - np.arange(len(wins))
        beside = np.stack((now - 1, now), axis=1).ravel()
        beside = beside[np.append(beside[1:] > beside[:-1], True) & (beside >= 0) & (beside < len(bucket))]
        beside = beside[bucket[beside] != _CUT]
        filled -= np.bincount(np.concatenate((before, bucket[beside])), minlength=_CUT + 1)
        after = bucket[beside] = _bucket(symbols[beside], symbols[beside + 1])
        filled += np.bincount(after, minlength=_CUT + 1)
    return symbols, firsts, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def _bucket(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash buckets of pairs, as the numbers that numpy indexes by."""
    pair = (left.astype(np.uint64) << np.uint64(32)) | right
    return ((pair * _ODD) >> np.uint64(64 - _BUCKETS)).astype(np.intp)


def _winners(places: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of ascending ``places`` beat both neighbours by weight, and then what is left between those that do."""
    wins = _beat(places, weight)
    beside = np.diff(places, prepend=-2, append=places[-1] + 2) == 1  # whether the place before is a neighbour
    left = np.ones(len(places), bool)
    left[wins] = False
    left[wins[beside[wins]] - 1] = False
    left[wins[beside[wins + 1]] + 1] = False
    left = np.flatnonzero(left)
    return np.sort(np.concatenate((wins, left[_beat(places[left], weight[left])])))


def _beat(places: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of ascending ``places`` are local maxima, with no weight at all others."""
    # places side by side stay so, and a place of no weight stands before each run of them
    slot = np.arange(len(places)) + np.cumsum(np.diff(places, prepend=-2) != 1)
    dense = np.zeros(slot[-1] + 2 if len(slot) else 1, np.int32)
    dense[slot] = weight
    which = np.zeros(len(dense), np.int32)
    which[slot] = np.arange(len(slot))
    return which[_peaks(dense)]


def _leaders(symbols: np.ndarray, bucket: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, ...]:
    """Count of the most frequent pair of each bucket in ``full``, where its places begin in the third array, and places by pair."""
    number = np.full(_CUT + 1, -1, np.int32)
    number[full] = np.arange(len(full))
    at = np.flatnonzero((number >= 0)[bucket])
    held = (symbols[at].astype(np.uint64) << np.uint64(_SYMBOL_BITS)) | symbols[at + 1]
    if len(symbols) <= 1 << _PLACE_BITS:  # a pair and its place in one number, which sorts several times as fast as by an index
        packed = np.sort((held << np.uint64(_PLACE_BITS)) | at.astype(np.uint64))
        at = (packed & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        held = packed >> np.uint64(_PLACE_BITS)
    else:
        order = np.argsort(held, kind="stable")
        at, held = at[order], held[order]
    starts = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1])))
    count = np.diff(np.append(starts, len(held)))
    # the last one written wins: the largest count, then the smallest pair
    last = len(starts) - 1
    best = last - (np.sort((count << 32) | (last - np.arange(len(starts)))) & 0xFFFFFFFF)
    leader = np.zeros(len(full), np.int64)
    leader[number[bucket[at[starts[best]]]]] = best
    return count[leader], starts[leader], at


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Ids that each rule stands for; a rule refers to earlier ones only."""
    out = np.zeros(len(rules), np.uint32)
    for i, (a, b) in enumerate(rules.tolist()):
        out[i] = (out[a - NONTERMINAL] if a >= NONTERMINAL else 1) + (out[b - NONTERMINAL] if b >= NONTERMINAL else 1)
    return out


def encode_block(doc_ids: list, parts: list[np.ndarray], round_rules: int = ROUND_RULES, least: int = LEAST) -> bytes:
    lens = np.array([len(p) for p in parts], np.int64)
    first_ids = np.cumsum(lens) - lens
    symbols, firsts, rules = replace_pairs(np.concatenate(parts).astype(np.uint32), first_ids, round_rules, least)
    table = np.concatenate((rules, expansion_lengths(rules)[:, None]), axis=1)
    index = [
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        firsts.astype("<u8").tobytes(),
        first_ids.astype("<u8").tobytes(),
    ]
    # Re-Pair leaves few repeats, so symbols are deflated by their frequencies alone, which takes less than half the time
    deflate = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    packed = [
        deflate.compress((symbols & 0xFFFF).astype("<u2").tobytes() + np.packbits(symbols >> 16 != 0).tobytes()) + deflate.flush(),
        zlib.compress(table.astype("<u4").tobytes(), 1),
        zlib.compress(b"".join(index), 1),
    ]
    return struct.pack(_HEAD, len(parts), len(symbols), len(rules), *map(len, packed)) + b"".join(packed)


class Block:
    """A block with its rules expanded; its documents are decoded one at a time or all at once."""

    def __init__(self, n_documents: int, n_symbols: int, n_rules: int, packed: list[bytes]):
        raw = zlib.decompress(packed[0])
        high = np.unpackbits(np.frombuffer(raw, np.uint8, offset=2 * n_symbols), count=n_symbols).astype(np.uint32)
        self.symbols = np.frombuffer(raw, "<u2", n_symbols).astype(np.uint32) | (high << np.uint32(16))
        self.rules = np.frombuffer(zlib.decompress(packed[1]), "<u4").reshape(n_rules, 3)
        raw = zlib.decompress(packed[2])
        null = np.frombuffer(raw, np.uint8, n_documents, 8 * n_documents)
        self.doc_ids = [None if z else d for d, z in zip(np.frombuffer(raw, "<i8", n_documents).tolist(), null.tolist(), strict=True)]
        self.firsts = np.append(np.frombuffer(raw, "<u8", n_documents, 9 * n_documents).astype(np.int64), n_symbols)
        self.first_ids = np.frombuffer(raw, "<u8", n_documents, 17 * n_documents).astype(np.int64)
        lens = self.rules[:, 2].astype(np.int64)
        self.starts = np.cumsum(lens) - lens
        # expansions of all rules, then every id as itself; a rule is filled in once both its symbols are
        self.pool = np.concatenate((np.zeros(int(lens.sum()), np.uint32), np.arange(NONTERMINAL, dtype=np.uint32)))
        self.lens = lens
        pairs = self.rules[:, :2].astype(np.int64)
        known = np.concatenate((np.zeros(n_rules, bool), [True]))
        places = np.where(pairs >= NONTERMINAL, pairs - NONTERMINAL, n_rules)
        waiting = np.arange(n_rules)
        while len(waiting):
            is_ready = known[places[waiting]].all(axis=1)
            ready, waiting = waiting[is_ready], waiting[~is_ready]
            if not len(ready):
                raise ValueError("rules refer to one another in a circle")
            ends = np.cumsum(lens[ready])
            self.pool[np.repeat(self.starts[ready] - ends + lens[ready], lens[ready]) + np.arange(ends[-1])] = self.expand(pairs[ready].ravel())
            known[ready] = True

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for."""
        symbols = symbols.astype(np.int64)
        rule = symbols - NONTERMINAL
        is_rule = rule >= 0
        lens = np.ones(len(symbols), np.int64)
        lens[is_rule] = self.lens[rule[is_rule]]
        starts = symbols + len(self.pool) - NONTERMINAL
        starts[is_rule] = self.starts[rule[is_rule]]
        ends = np.cumsum(lens)
        return self.pool[np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the block, decoded from its own symbols."""
        return self.expand(self.symbols[self.firsts[i] : self.firsts[i + 1]])

    def documents(self) -> Iterator[np.ndarray]:
        """Ids of every document of the block, which is expanded at once."""
        ids = self.expand(self.symbols)
        bounds = [*self.first_ids.tolist(), len(ids)]
        return (ids[a:b] for a, b in zip(bounds, bounds[1:]))


def blocks(stream) -> Iterator[Block]:
    while head := stream.read(struct.calcsize(_HEAD)):
        n_documents, n_symbols, n_rules, *sizes = struct.unpack(_HEAD, head)
        yield Block(n_documents, n_symbols, n_rules, [stream.read(n) for n in sizes])


def write(documents: DataFrame, folder: str, tokenizer: str = tokens.BYTE_BPE, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode ``documents`` (doc_id, text) in ascending doc_id order into grammar files; returns the manifest.

    A document is its ids and ``end_id``; null and empty texts are ``end_id`` alone. A null id comes first, equal ids in
    the order of their texts' hash; other columns are ignored; an empty table gives an empty manifest. The texts are
    shuffled once, by range. A task writes one file of bounded blocks under a temporary name, then moves it.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def write_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tokens.encoding(tokenizer) as encoder:
            yield from write_shard(batches, encoder)

    def write_shard(batches: Iterator[pa.RecordBatch], encoder: tokens.Encoder) -> Iterator[pa.RecordBatch]:
        shard, end = TaskContext.get().partitionId(), np.array([end_id], np.uint32)
        out, held, n_documents, n_ids = None, [], 0, 0
        waiting = 0
        for batch in batches:
            at = 0
            for part in tokens.slices(batch.column("text")):
                ids, off = encoder.encode(part)
                for i, doc_id in enumerate(batch.column("doc_id").slice(at, len(part)).to_pylist()):
                    one = np.concatenate((ids[off[i] : off[i + 1]], end))
                    if held and waiting + len(one) > block_ids:
                        out = out or files.Committed(folder, f"ids-{shard:06d}.rpa")
                        out.write(encode_block(*map(list, zip(*held, strict=True))))
                        held, waiting = [], 0
                    held.append((doc_id, one))
                    waiting += len(one)
                    n_documents, n_ids = n_documents + 1, n_ids + len(one)
                at += len(part)
        if held:
            out = out or files.Committed(folder, f"ids-{shard:06d}.rpa")
            out.write(encode_block(*map(list, zip(*held, strict=True))))
        if out is not None:
            out.commit()
            row = {"shard": shard, "file": out.name, "documents": n_documents, "ids": n_ids, "bytes": out.size, "sha1": out.digest.hexdigest()}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]))

    path = f"{folder.rstrip('/')}/manifest"
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(scan.released(write_task), MANIFEST).write.parquet(path)
    return documents.sparkSession.read.schema(MANIFEST).parquet(path)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files in the manifest: ids of all documents before it, its ids' number and their CRC-32."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    placed = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = row["start"]
                with files.reader(folder, row["file"]) as stream:
                    for block in blocks(stream):
                        out = []
                        for doc_id, ids in zip(block.doc_ids, block.documents(), strict=True):
                            out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False))))
                            start += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    n = max(1, min(manifest.count(), 100_000))
    return placed.repartition(n).mapInArrow(scan.released(read_task), DOCUMENTS)


def roundtrip(documents: DataFrame, tokenizer: str = tokens.BYTE_BPE) -> DataFrame:
    """Write ``documents`` to grammar files in the shared folder and read every document back."""
    folder = scratch_path(documents.sparkSession, "repair")
    write(documents, folder, tokenizer)
    return read(documents.sparkSession, folder)
