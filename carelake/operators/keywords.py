"""BM25 over a stored inverted index.

Documents are dealt into parts of bounded size. The index holds, per part, one row a term with the documents that hold it and how
often, in folders by a hash of the term, and one row that names the documents and their lengths; a second table has a row per term
with its document count and weight. Terms of a text are split once, as Arrow arrays of its part, and no posting is a row of its own.

A search reads the term folders it is asked for, brings the asked terms of a part together, and streams the stored questions past
it in blocks: a question's scores are sums over the lists of its terms in arrays of the part's size, of which the ``k`` best go on.
So no pair of question and document is a row, and memory is bounded by a part. The result is the exact one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from carelake.functions.text import SPACE_CODES, words
from carelake.session import materialise
from carelake.sources.blocks import blocks, stored

# Keyword scoring constants.
K1, B, EPSILON = 1.5, 0.75, 0.25

#: Folders of postings, by a hash of the term, and words in a part of the documents.
TERM_BUCKETS, BLOCK = 16, 1 << 21
#: The folder of the rows that name a part's documents.
DOCUMENTS = -1
#: Questions that meet a part at a time.
BLOCK_QUESTIONS = 1_024
#: Scores are compared at this many digits, so equal documents tie exactly and ids decide.
DIGITS = 9

_COLUMNS = "kind string, avg_length double"
_SPACES = "[" + "".join(f"\\x{{{c:x}}}" for c in SPACE_CODES) + "]"


def tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens."""
    return words(F.lower(text))


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, one after the other, and how many each text has; the same words as ``words`` gives.

    Texts are cut at single spaces, and only distinct runs between them are looked at for other white space.
    """
    lists = pc.split_pattern(texts, " ")
    runs = lists.flatten().dictionary_encode()
    pieces = pc.split_pattern_regex(runs.dictionary, _SPACES)
    found = pieces.flatten()
    filled = np.asarray(pc.binary_length(found)) > 0
    words_of = found.filter(pa.array(filled)).dictionary_encode()
    # places of a run's words among those of all distinct runs, then of all runs in the order of the texts
    ends = np.append(0, np.cumsum(filled))[np.append(0, np.cumsum(np.asarray(pc.list_value_length(pieces), dtype=np.int64)))]
    run = np.asarray(runs.indices)
    sizes = np.diff(ends)[run]
    total = np.append(0, np.cumsum(sizes))
    codes = np.asarray(words_of.indices)[np.repeat(ends[:-1][run] - total[:-1], sizes) + np.arange(total[-1])]
    lengths = np.diff(total[np.append(0, np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64)))])
    return pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), words_of.dictionary), lengths


def corpus_bm25_stats(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Keyword statistics: (document count, mean length) as one row, and document frequency per term.

    Both come from one pass, in which the row without a term stands for the document itself; the result
    is stored, so that using both does not read the corpus twice.
    """
    words_of = docs.filter(F.col(text).isNotNull()).select(tokens(F.col(text)).alias("tokens"))
    marked = words_of.select(F.size("tokens").alias("length"), F.explode(F.array_append(F.array_distinct("tokens"), F.lit(None))).alias("term"))
    own = F.when(F.col("term").isNull(), F.col("length"))
    counted = materialise(marked.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum(own).alias("words")), "bm25-terms")
    corpus = counted.filter("term is null").agg(
        F.coalesce(F.sum("doc_freq"), F.lit(0)).alias("n_docs"), (F.sum("words") / F.sum("doc_freq")).alias("avg_length")
    )
    return corpus, counted.filter("term is not null").select("term", "doc_freq")


def _bucket(term: Column, buckets: int) -> Column:
    """Folder of a term; the rows that name documents have one of their own."""
    return F.when(term.isNull(), F.lit(DOCUMENTS)).otherwise(F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int"))


def build(docs: DataFrame, path: str, buckets: int = TERM_BUCKETS, block: int = BLOCK) -> None:
    """Write the index of ``docs`` (id, text) to the folders ``postings``, ``terms`` and ``columns`` of ``path``.

    Statistics cover these documents; a negative idf is replaced by a quarter of the mean idf over the vocabulary. Documents
    without a text are left out; every row is a document of its own, also where ids repeat. A part holds ``block`` words, or one
    longer document.
    """
    spark = docs.sparkSession
    lowered = docs.filter(F.col("text").isNotNull()).select("id", F.lower("text").alias("text"))
    kind = f"part long, term string, size int, docs array<int>, freqs array<int>, ids array<{docs.schema['id'].dataType.simpleString()}>"
    arrow = to_arrow_schema(StructType.fromDDL(kind))

    def listed(held: list[tuple[pa.Array, pa.DictionaryArray, np.ndarray]], part: int) -> pa.RecordBatch:
        """The lists of one part, by term, and its documents in a row without a term."""
        ids, lengths = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[2] for h in held])
        n, words_of = len(ids), pa.chunked_array([h[1] for h in held]).unify_dictionaries().combine_chunks()
        # equal (term, document) keys stand side by side
        keys = np.sort(words_of.indices.to_numpy().astype(np.int64) * n + np.repeat(np.arange(n), lengths))
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        sizes = np.bincount(keys[first] // n, minlength=len(words_of.dictionary))
        # a batch that is dealt to two parts brings words that one of them lacks
        own, sizes = np.flatnonzero(sizes), np.append(sizes[sizes > 0], 0)
        ends = np.append(0, np.cumsum(sizes))
        lists = lambda values, ends, f: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, arrow.field(f).type.value_type))
        none = np.zeros(len(sizes) + 1, dtype=np.int32)
        none[-1] = n
        ends_with = np.append(ends[:-1], ends[-1] + n)  # the last row has the lengths where others have frequencies
        columns = [
            pa.array(np.full(len(sizes), part)), pa.concat_arrays([words_of.dictionary.take(pa.array(own)).cast(pa.string()), pa.nulls(1, pa.string())]),
            pa.array(sizes.astype(np.int32)), lists(keys[first] % n, ends, "docs"),
            lists(np.append(np.diff(np.append(first, len(keys))), lengths), ends_with, "freqs"),
            pa.ListArray.from_arrays(pa.array(none), ids.cast(arrow.field("ids").type.value_type)),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # numbers of a task's own; a task run again writes them anew
        part, held, room = TaskContext.get().partitionId() << 32, [], block
        for batch in batches:
            words_of, lengths = split_words(batch.column(1))
            ends = np.cumsum(lengths)
            at = 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                stop = max(int(np.searchsorted(ends, before + room, "right")), at if held else at + 1)
                if stop > at:
                    n_words = int(ends[stop - 1]) - before
                    held.append((batch.column(0).slice(at, stop - at), words_of.slice(before, n_words), lengths[at:stop]))
                    room -= n_words
                    at = stop
                if at < batch.num_rows:
                    yield listed(held, part)
                    part, held, room = part + 1, [], block
        if held:
            yield listed(held, part)

    rows = lowered.mapInArrow(deal, kind).withColumn("bucket", _bucket(F.col("term"), buckets))
    rows.write.partitionBy("bucket").parquet(f"{path}/postings")
    # an index of no words has no files to tell its columns
    index = spark.read.schema(f"{kind}, bucket int").parquet(f"{path}/postings")
    lengths = F.expr("aggregate(freqs, 0L, (n, length) -> n + length)")
    named = index.where(F.col("bucket") == DOCUMENTS).select(F.size("ids").alias("n"), lengths.alias("words"))
    n_docs, n_words = named.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum("words")).first()
    avg_length = float(n_words) / n_docs if n_words else 1.0
    frequencies = index.where(F.col("bucket") != DOCUMENTS).groupBy("term").agg(F.sum("size").alias("doc_freq"))
    rare = F.log(F.lit(float(n_docs)) - F.col("doc_freq") + 0.5) - F.log(F.col("doc_freq") + 0.5)
    idf = materialise(frequencies.select("term", "doc_freq", rare.alias("idf")), "keyword-idf")
    mean = idf.agg(F.avg("idf")).first()[0] or 0.0
    weight = F.when(F.col("idf") >= 0, F.col("idf")).otherwise(F.lit(EPSILON * mean))
    idf.select("term", "doc_freq", weight.alias("weight")).write.parquet(f"{path}/terms")
    columns = spark.range(0, 1, 1, 1).select(F.lit(f"{kind}, bucket int").alias("kind"), F.lit(avg_length).alias("avg_length"))
    columns.write.parquet(f"{path}/columns")


def _columns(spark: SparkSession, path: str) -> tuple[str, float]:
    """Columns of the postings and mean length of the documents."""
    return tuple(spark.read.schema(_COLUMNS).parquet(f"{path}/columns").first())


def postings(spark: SparkSession, path: str, asked: list[int]) -> DataFrame:
    """The stored rows of the given buckets; other folders are not read."""
    return spark.read.schema(_columns(spark, path)[0]).parquet(f"{path}/postings").where(F.col("bucket").isin(asked))


def search(queries: DataFrame, path: str, k: int, buckets: int = TERM_BUCKETS) -> DataFrame:
    """``query_id, doc_id, score`` of documents that hold the ``k`` best of each question (query_id, text), positive scores only.

    At least all of the ``k`` best are returned, with exact scores; others may be among the rows. Texts of a repeated question
    id are one question. Nothing of the questions passes the driver but the numbers of the buckets they need.
    """
    spark = queries.sparkSession
    words_of = queries.select("query_id", F.explode(tokens(F.col("text"))).alias("term"))
    asked = materialise(words_of.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times")), "keyword-asked")
    terms = materialise(asked.select("term").distinct().withColumn("bucket", _bucket(F.col("term"), buckets)), "keyword-terms")
    needed = sorted(r[0] for r in terms.select("bucket").distinct().collect())  # at most the number of buckets
    weights = spark.read.schema("term string, doc_freq long, weight double").parquet(f"{path}/terms").join(terms.select("term"), "term")
    # a question's words in one order for all documents, so equal texts have equal sums
    whole = asked.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "times"))).alias("words"))
    asking = stored(whole.select("query_id", F.col("words.term").alias("terms"), F.col("words.times").alias("times")), "keyword-questions")
    avg_length = _columns(spark, path)[1]

    lists = postings(spark, path, needed).drop("bucket", "ids").join(weights.select("term", "weight"), "term")
    named = postings(spark, path, [DOCUMENTS]).drop("bucket")
    id_type = named.schema["ids"].dataType.elementType
    schema = StructType([queries.schema["query_id"], StructField("doc_id", id_type), StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All questions meet one part."""
        part = pa.Table.from_batches(list(batches)).combine_chunks()
        heads = part.filter(pc.is_null(part.column("term")))
        part = part.filter(pc.is_valid(part.column("term")))
        if not part.num_rows:
            return
        one = lambda table, name: table.column(name).combine_chunks()
        ids, lengths = one(heads, "ids").flatten(), np.asarray(one(heads, "freqs").flatten(), dtype=np.float64)
        place = np.empty(len(ids), dtype=np.int64)
        place[np.asarray(pc.array_sort_indices(ids, order="ascending", null_placement="at_start"))] = np.arange(len(ids))
        known, sizes = one(part, "term"), np.asarray(one(part, "size"))
        docs, freq = np.asarray(one(part, "docs").flatten()), np.asarray(one(part, "freqs").flatten(), dtype=np.float64)
        saturated = freq * (K1 + 1) / (freq + K1 * (1 - B + B * lengths[docs] / avg_length))
        impacts = np.repeat(np.asarray(one(part, "weight")), sizes) * saturated
        ends = np.append(0, np.cumsum(sizes)).tolist()
        for block in blocks(asking, BLOCK_QUESTIONS):
            slots = np.asarray(pc.fill_null(pc.index_in(block.column(1).flatten(), known), -1))
            times = np.asarray(block.column(2).flatten(), dtype=np.float64).tolist()
            bounds = np.append(0, np.cumsum(np.asarray(pc.list_value_length(block.column(1))))).tolist()
            found = [_best(slots[a:b].tolist(), times[a:b], ends, docs, impacts, place, k) for a, b in zip(bounds, bounds[1:])]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            columns = [block.column(0).take(rows), ids.take(pa.array(np.concatenate([f[0] for f in found]))), pa.array(np.concatenate([f[1] for f in found]))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    met = lists.unionByName(named, allowMissingColumns=True).groupBy("part").applyInArrow(meet, schema)
    return met.withColumn("score", F.round("score", DIGITS)).where("score > 0")


def _best(
    slots: list[int], times: list[float], ends: list[int], docs: np.ndarray, impacts: np.ndarray, place: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of a part and their scores for one question; equal scores go by ``place``."""
    scores = np.zeros(len(place))
    for slot, n in zip(slots, times):
        if slot >= 0:
            at = slice(ends[slot], ends[slot + 1])
            scores[docs[at]] += n * impacts[at]
    hits = np.flatnonzero(scores > 0)
    if len(hits) > k:
        low = np.partition(scores[hits], -k)[-k]
        hits = hits[scores[hits] >= low - 10.0 ** (1 - DIGITS)]
    order = np.lexsort((place[hits], -np.round(scores[hits], DIGITS)))[:k]
    return hits[order], scores[hits[order]]
