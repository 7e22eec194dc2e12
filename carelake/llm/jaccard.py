"""Exact Jaccard join of documents on sets of word n-grams, as classes of linked documents.

Equal sets are one node. Every node lists its prefix (the first n - ceil(t n) + 1 shingles of its set in one fixed order);
two sets that link share a shingle of both prefixes, so the nodes listing a shingle are the candidates, and no link is
lost. The order puts frequent shingles last, which keeps shared passages out of the prefixes of documents that have
anything of their own. Nodes under a shingle are compared in two rounds:

1. every node with one centre of its shingle; the links found join most copies into components;
2. where nodes of several components remain under a shingle, they are cut into tiles by size band (only neighbouring
   bands can link) and, beyond a fixed number of rows, into blocks; within a tile hashed bitmap signatures bound the
   overlap of every pair of different components from above.

Pairs that pass the bound are verified by exact intersection of the sorted shingle arrays. Pairs inside one component need
no comparison, since only components are asked for, so groups of copies are never expanded into all their pairs. Where a
block has more pairs to verify than PAIRS_EACH a row, its rows are handed on instead of its pairs: they get their shingles and are
intersected in the block, which gives a forest of the links it finds. So every step makes rows in proportion to those it reads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import scan
from carelake.llm.links import components
from carelake.session import materialise

#: Least similarity, as a fraction.
SIMILAR = (80, 100)
#: Documents that make a shingle frequent, and how many frequent shingles (the most frequent ones) move last in the
#: order. The list is broadcast, so its number is fixed; any order gives the same links.
FREQUENT, FREQUENT_KEPT = 48, 1 << 17
#: Buckets (a power of two) in which a task notes the shingles it has met.
SEEN_BITS = 24
#: Low bits that a token lacks of its shingle's hash, to be shuffled in fewer bytes. Two shingles with one token are two more
#: candidates, no lost link.
CUT_BITS = 24
#: Rows of a token up to which they are looked at in one task.
CROWD = 1 << 12
#: Bits of a signature: the next power of two to so many times the set's size, within these. A signature only saves exact
#: comparisons, and is shuffled more often than anything else here.
BITS_EACH, LEAST_BITS, MOST_BITS = 2, 64, 1 << 15
#: Random ranks by which centres are chosen in the first round.
RANKS = 16
#: Ratio of neighbouring size bands; a little above the largest ratio of linked sizes.
BAND = 1.26
#: Nodes, and shingles of them, a block of a tile holds on average.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Pairs a block of a tile hands on for every row it holds.
PAIRS_EACH = 2
#: Bits of the filter that tells which sets a later pass must send.
FILTER_BITS = 1 << 25


def prefix_size(n: int) -> int:
    return n - (SIMILAR[0] * n + SIMILAR[1] - 1) // SIMILAR[1] + 1


def linked(overlap, n_a, n_b):
    """Whether overlap / union reaches the least similarity, in whole numbers."""
    return SIMILAR[1] * overlap >= SIMILAR[0] * (n_a + n_b - overlap)


def signature(shingles: np.ndarray) -> bytes:
    """Bitmap with one bit set per shingle hash."""
    width = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * len(shingles) - 1).bit_length()))
    bits = np.zeros(width, bool)
    bits[(shingles >> np.uint64(7)) & np.uint64(width - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """A signature as it would be at a smaller width."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def overlap_bound(a: np.ndarray, b: np.ndarray, n_a, n_b):
    """Largest possible overlap: each bit set in one signature alone stands for a shingle the other lacks."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _tokens(shingles: np.ndarray) -> np.ndarray:
    return shingles >> np.uint64(CUT_BITS) << np.uint64(CUT_BITS)


def _signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, row, node (null for an empty set), n, bits for every row."""
    held = ["doc_id", "text_hash", "row"]
    schema = pa.schema([*((c, pa.int64()) for c in held), ("node", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(_node(s), len(s), signature(s)) if len(s) else (None, 0, None) for s in scan.shingle_sets(batch.column("text"), lower=True)]
            columns = zip(*out, strict=True) if out else ([], [], [])
            made = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[len(held) :], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in held), *made], schema=schema)

    return docs.mapInArrow(scan.released(task), "doc_id long, text_hash long, row long, node long, n long, bits binary")


def _frequent(docs: DataFrame) -> np.ndarray:
    """Tokens of the most frequent shingles among those that can be in a prefix, sorted; at most FREQUENT_KEPT.

    A task passes a token on from its second sight of its bucket, so those it meets once are not shuffled.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SEEN_BITS, bool)
        for batch in batches:
            held, size = [], 0
            for s in [*scan.shingle_sets(batch.column(0), lower=True), None]:
                if s is not None:
                    held.append(s[: 2 * prefix_size(len(s))] if len(s) else s)
                    size += len(held[-1])
                if held and (s is None or size > 1 << 19):
                    distinct, count = np.unique(_tokens(np.concatenate(held)), return_counts=True)
                    bucket = ((distinct * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
                    again = seen[bucket] | (count > 1)
                    seen[bucket] = True
                    yield pa.RecordBatch.from_arrays([pa.array(distinct[again].view(np.int64)), pa.array(count[again])], ["token", "n"])
                    held, size = [], 0

    counted = docs.select("text").mapInArrow(scan.released(task), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    kept = counted.orderBy(F.desc("n"), "token").limit(FREQUENT_KEPT).select("token").toArrow()
    return np.sort(kept.column(0).to_numpy().view(np.uint64))


def _prefixes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """token, node, n, is_frequent: the prefix of every row's set."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def is_in(values: np.ndarray) -> np.ndarray:
        late = shared.value
        if not len(late):
            return np.zeros(len(values), bool)
        return late[np.minimum(np.searchsorted(late, values), len(late) - 1)] == values

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(tokens, nodes, sizes, late):
            lens = [len(t) for t in tokens]
            columns = [np.concatenate(tokens).view(np.int64), np.repeat(np.array(nodes, np.int64), lens), np.repeat(np.array(sizes, np.int64), lens), np.concatenate(late)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "node", "n", "is_frequent"])

        for batch in batches:
            held: tuple[list, ...] = ([], [], [], [])
            size = 0
            for s in scan.shingle_sets(batch.column(0), lower=True):
                if not len(s):
                    continue
                p, late = prefix_size(len(s)), is_in(_tokens(s))
                take = np.flatnonzero(~late)[:p]
                if len(take) < p:
                    take = np.concatenate((take, np.flatnonzero(late)[: p - len(take)]))
                for column, value in zip(held, (_tokens(s[take]), _node(s), len(s), late[take]), strict=True):
                    column.append(value)
                size += p
                if size > 1 << 17:
                    yield flush(*held)
                    held, size = ([], [], [], []), 0
            if held[0]:
                yield flush(*held)

    return docs.select("text").mapInArrow(scan.released(task), "token long, node long, n long, is_frequent boolean")


def _tiles(docs: DataFrame) -> DataFrame:
    """token, node, n, a centre (c_node, c_n), and how many rows the token has (null: many), where several nodes list a token.

    A centre is the node with the smallest of RANKS random ranks, so the tokens of a group of copies have few centres.
    Frequent tokens are aggregated before any shuffle, and their centres, at most FREQUENT_KEPT, are broadcast.
    """
    frequent = _frequent(docs)
    rows = _prefixes(docs, frequent)
    rank = F.struct(F.xxhash64("node", F.pmod(F.shiftright("token", CUT_BITS), F.lit(RANKS))).alias("rank"), F.col("node"), F.col("n"))
    columns = ["token", "node", "n", F.col("centre.node").alias("c_node"), F.col("centre.n").alias("c_n"), "crowd"]
    by = Window.partitionBy("token")
    few = rows.where("not is_frequent").withColumn("low", F.min("node").over(by)).withColumn("high", F.max("node").over(by)).where("low <> high")
    few = few.withColumn("centre", F.min(rank).over(by)).withColumn("crowd", F.count(F.lit(1)).over(by)).select(*columns)
    if not len(frequent):
        return few
    many = materialise(rows.where("is_frequent").groupBy("token", "node").agg(F.min("n").alias("n")), "jaccard-frequent")
    centres = many.groupBy("token").agg(F.min(rank).alias("centre"), F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("token", "centre")
    return few.unionAll(many.join(F.broadcast(centres), "token").withColumn("crowd", F.lit(None).cast("long")).select(*columns))


def _bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures allow the overlap they need."""
    one = nodes.select("node", "n", "bits")
    both = pairs.join(one.toDF("a", "n_a", "bits_a"), "a").join(one.toDF("b", "n_b", "bits_b"), "b")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b = (batch.column(c).to_numpy() for c in ("a", "b", "n_a", "n_b"))
            keep = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                keep[i] = linked(overlap_bound(fold(x, words), fold(y, words), n_a[i], n_b[i]), n_a[i], n_b[i])
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(scan.released(task), "a long, b long")


def _places(keys: np.ndarray) -> list[np.ndarray]:
    """Three bit places per key in the filter of wanted sets."""
    h = keys.view(np.uint64)
    return [((h * np.uint64(m)) >> np.uint64(64 - FILTER_BITS.bit_length() + 1)).astype(np.int64) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _wanted(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter of the nodes, of fixed size; aggregated in Spark, at most FILTER_BITS / 64 rows come back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(_places(batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(place >> 6), pa.array((np.uint64(1) << (place & 63).astype(np.uint64)).view(np.int64))], ["word", "bits"])

    words = nodes.mapInArrow(scan.released(task), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles as bytes) for at least the given nodes, once each; texts are not shuffled.

    They are dealt by node once, however many joins by node in one job use them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(_wanted(nodes), bitorder="little").tobytes())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, sent = np.frombuffer(shared.value, np.uint8), set()
        for batch in batches:
            out, size = [], 0
            for s in scan.shingle_sets(batch.column(0), lower=True):
                if not len(s) or (node := _node(s)) in sent:
                    continue
                if all((wanted[p[0] >> 3] >> (p[0] & 7)) & 1 for p in _places(np.array([node], np.int64))):
                    if len(sent) < 1 << 20:
                        sent.add(node)
                    out.append((node, s.tobytes()))
                    size += 8 * len(s)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary()), strict=True)], ["node", "shingles"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary()), strict=True)], ["node", "shingles"])

    return docs.select("text").mapInArrow(scan.released(task), "node long, shingles binary").dropDuplicates(["node"])


def _links(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets link, by their exact intersection."""
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return bool(linked(int((y[place] == x).sum()), len(x), len(y)))


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by exact intersection of their sorted shingles."""
    if pairs.isEmpty():
        return pairs
    return _linking(pairs, _sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))


def _linking(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("x"), batch.column("y"), strict=True):  # row by row, without copying the sets
                keep.append(_links(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(scan.released(task), "a long, b long")


def _compare(sizes: np.ndarray, groups: np.ndarray, own: np.ndarray, parts: np.ndarray, bits: list[bytes], cross: bool):
    """Places of pairs of one block that may link: of different components, not both guests, of different parts if ``cross``."""
    words = min(len(b) for b in bits) // 8
    table = np.stack([fold(np.frombuffer(b, np.uint64), words) for b in bits])
    for i in range(len(sizes) - 1):
        j = np.arange(i + 1, len(sizes))
        j = j[(groups[j] != groups[i]) & (own[j] | own[i]) & (not cross or parts[j] != parts[i])]
        j = j[SIMILAR[1] * np.minimum(sizes[j], sizes[i]) >= SIMILAR[0] * np.maximum(sizes[j], sizes[i])]
        if len(j):
            j = j[linked(overlap_bound(table[i], table[j], sizes[i], sizes[j]), sizes[i], sizes[j])]
            yield from ((i, k) for k in j.tolist())


#: A block of a tile, and what its rows are compared by.
_KEY = ["home", "tile", "side", "i", "j"]
_HELD = ["node", "n", "group", "own", "part"]


def _in_blocks(rows: DataFrame, column: str, of_block, schema: str) -> DataFrame:
    """What ``of_block`` makes of the rows of each block, as (key and node, n, group, own, part, ``column``)."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.bool_() if f.endswith("boolean") else pa.int64() for f in schema.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*_KEY, *_HELD, column)), strict=True):
                if held and held[0][: len(_KEY)] != row[: len(_KEY)]:
                    out += of_block(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out = []
        if held and (out := of_block(held)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    dealt = rows.select(*_KEY, *_HELD, column).repartition(*_KEY).sortWithinPartitions(*_KEY, "node")
    return dealt.mapInArrow(scan.released(task), schema)


def _may_link(held: list[tuple], bits: list[bytes]):
    """Places of the pairs of a block that its signatures cannot rule out."""
    _, sizes, groups, own, parts = (np.array(c) for c in zip(*(r[len(_KEY) : len(_KEY) + len(_HELD)] for r in held), strict=True))
    return _compare(sizes, groups, own, parts, bits, held[0][2] == 0 or held[0][3] != held[0][4])


def _screened(held: list[tuple]) -> list[tuple]:
    """The pairs of a block that may link, as (a, b) and nulls, or its rows in them if these are fewer by far, as (node, null, ...)."""
    pairs, many = [], PAIRS_EACH * len(held)
    in_pairs: set[int] = set()
    for i, j in _may_link(held, [r[-1] for r in held]):
        if len(pairs) <= many:
            pairs.append((i, j))
        in_pairs.update((i, j))
    at = len(_KEY)
    if len(pairs) <= many:
        return [(min(held[i][at], held[j][at]), max(held[i][at], held[j][at]), *(None,) * (len(_KEY) + len(_HELD) - 1)) for i, j in pairs]
    return [(held[i][at], None, *held[i][:at], *held[i][at + 1 : -1]) for i in sorted(in_pairs)]


def _forest(held: list[tuple]) -> list[tuple]:
    """Links (a, b) of one block, by exact intersection, that join all that its links join."""
    sets, root = [np.frombuffer(r[-1], np.uint64) for r in held], list(range(len(held)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    out = []
    for i, j in _may_link(held, [signature(s) for s in sets]):
        if top(i) != top(j) and _links(sets[i], sets[j]):
            root[top(j)] = top(i)
            out.append((held[i][len(_KEY)], held[j][len(_KEY)]))
    return out


def _found(rest: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) among the pairs of ``_rest``, and a forest of those in the blocks it hands on whole."""
    pairs = rest.where("b is not null").select("a", "b")
    whole = rest.where("b is null").drop("b").withColumnRenamed("a", "node")
    if whole.isEmpty():
        return _verified(pairs, docs)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionAll(whole.select("node")).distinct()
    sets = _sets(docs, nodes)
    return _linking(pairs, sets).unionAll(_in_blocks(whole.join(sets, "node"), "shingles", _forest, "a long, b long"))


def _rest(tiles: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share a token and that the signatures cannot rule out.

    Of a block with many such pairs, its rows: the node as a, no b, and the block and all they are compared by.
    """
    sized = found.join(found.groupBy("component").agg(F.count("*").alias("size")), "component")
    band = F.floor(F.log("n") / F.log(F.lit(BAND))).cast("int")
    mark = F.xxhash64("node")
    columns = ["home", "tile", "node", "n", "group", "size", "own"]

    def placed(part: DataFrame) -> DataFrame:
        out = part.select("token", "node", "n").join(sized, "node", "left").withColumn("group", F.coalesce("component", "node"))
        return out.select("token", "node", "n", "group", F.coalesce("size", F.lit(1)).alias("size"))

    def tiled(part: DataFrame) -> DataFrame:
        rows = part.withColumn("band", band).withColumn("tile", F.explode(F.array(F.col("band"), F.col("band") + 1)))
        return rows.select("token", "tile", "node", "n", "group", "size", (F.col("tile") == F.col("band")).alias("own"))

    # tokens of one passage or one group of copies have nearly the same members, and mostly the same smallest one:
    # the tiles that share it are made one, so that a pair is not looked at under every token
    aggregates = {"low": F.min("group"), "high": F.max("group"), "any_own": F.max("own"), "home": F.min(mark)}
    # a token with few rows is dealt once, and everything about it is found where its rows are
    token, tile = Window.partitionBy("token"), Window.partitionBy("token", "tile")
    few = placed(tiles.where(F.col("crowd") <= CROWD)).withColumns({"low": F.min("group").over(token), "high": F.max("group").over(token)})
    few = tiled(few.where("low <> high")).withColumn("least", F.min(F.when(F.col("own"), F.col("n"))).over(tile))
    few = few.where(F.col("own") | (SIMILAR[1] * F.col("n") >= SIMILAR[0] * F.col("least"))).withColumns({c: f.over(tile) for c, f in aggregates.items()})
    rows = few.where("low <> high and any_own").select(*columns)
    crowded = tiles.where(F.col("crowd").isNull() | (F.col("crowd") > CROWD))
    if not crowded.isEmpty():  # the rows of such a token may be split in every step
        many = placed(crowded)
        mixed = many.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("token")
        many = tiled(many.join(mixed, "token"))
        seen = many.groupBy("token", "tile").agg(*[f.alias(c) for c, f in aggregates.items()])
        rows = rows.unionAll(many.join(seen.where("low <> high and any_own").select("token", "tile", "home"), ["token", "tile"]).select(*columns))
    rows = materialise(rows.groupBy("home", "tile", "node").agg(*[F.first(c).alias(c) for c in ("n", "group", "size", "own")]), "jaccard-rest")
    # the largest component of a tile needs no comparison with itself: its nodes are dealt over blocks once, and only
    # the other nodes go to each of these blocks
    parts = rows.groupBy("home", "tile", "group").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"), F.first("size").alias("size"))
    main = F.max_by(F.struct("group", "members", "shingles"), F.struct("size", "group")).alias("main")
    parts = parts.groupBy("home", "tile").agg(main, F.sum("members").alias("members"), F.sum("shingles").alias("shingles"))
    cut = lambda members, shingles: F.ceil(F.greatest(members / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")
    of_rest = cut(F.col("members") - F.col("main.members"), F.col("shingles") - F.col("main.shingles"))
    blocks = parts.select("home", "tile", F.col("main.group").alias("main"), cut(F.col("main.members"), F.col("main.shingles")).alias("n_main"), of_rest.alias("n_rest"))
    rows = rows.join(blocks.where("n_rest > 0"), ["home", "tile"]).join(nodes.select("node", "bits"), "node")
    is_main = F.col("group") == F.col("main")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.when(is_main, F.col("n_main")).otherwise(F.col("n_rest"))).cast("int"))
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda side, i, j, part: F.struct(F.lit(side).alias("side"), i.alias("i"), j.alias("j"), part.alias("part"))
    of_main = F.transform(each("n_rest"), lambda o: place(0, F.col("block"), o, F.lit(0)))
    with_main = F.transform(each("n_main"), lambda m: place(0, m, F.col("block"), F.lit(1)))
    with_rest = F.transform(each("n_rest"), lambda o: place(1, F.least(F.col("block"), o), F.greatest(F.col("block"), o), F.col("block")))
    rows = rows.withColumn("place", F.explode(F.when(is_main, of_main).otherwise(F.concat(with_main, with_rest))))
    rows = rows.select("home", "tile", "place.side", "place.i", "place.j", "node", "n", "group", "own", "place.part", "bits")
    handed = "a long, b long, home long, tile long, side long, i long, j long, n long, group long, own boolean, part long"
    return _in_blocks(rows, "bits", _screened, handed).distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``documents`` (doc_id, text).

    component_id is the smallest doc_id reachable by links, the row's own included. Null and empty texts have no shingles
    and link with nothing; repeated rows and equal sets always link; a null id never is a component id unless all ids of
    the component are null; other columns are ignored; an empty table gives no rows.
    """
    placed = classes(documents)
    lowest = placed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("lowest"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), F.coalesce("lowest", "doc_id").alias("component_id")]
    return placed.join(lowest, "class", "left").select(*columns)


def classes(documents: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, text_hash, row, n and class (null without shingles) for every row of ``documents`` (doc_id, text).

    Rows of one class are linked; ``row`` is the value of the long column of that name, null without one.
    """
    text = F.col("text").cast("string")
    number = F.col(row) if row else F.lit(None).cast("long")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"), number.alias("row"))
    signatures = materialise(_signatures(docs), "jaccard-signatures")
    nodes = materialise(signatures.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "jaccard-nodes")
    tiles = materialise(_tiles(docs), "jaccard-tiles")
    near_size = SIMILAR[1] * F.least("n", "c_n") >= SIMILAR[0] * F.greatest("n", "c_n")
    stars = tiles.where("node <> c_node").where(near_size).select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()
    first = materialise(_verified(materialise(_bounded(stars, nodes), "jaccard-stars"), docs), "jaccard-links")
    found = materialise(components(first), "jaccard-components")
    rest = materialise(_rest(tiles, nodes, found), "jaccard-pairs")
    if not rest.isEmpty():
        found = materialise(components(first.unionAll(_found(rest, docs))), "jaccard-components")
    return signatures.join(found, "node", "left").select("doc_id", "text_hash", "row", "n", F.coalesce("component", "node").alias("class"))
