"""Token counts through two tiers: a broadcast table of frequent pieces, and a cache in each worker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import scan, tokens
from carelake.llm.sample import bounded

#: Entries of the broadcast table, and documents whose pieces are counted to choose them. They bear on speed alone.
TABLE_UNITS = 65_536
TABLE_DOCUMENTS = 4_096
#: Pieces longer than this stay out of the table, which bounds its bytes.
UNIT_BYTES = 64
LIMIT = 1_024
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def frequent_lengths(documents: DataFrame, tokenizer: str = tokens.BYTE_BPE, units: int = TABLE_UNITS, sample: int = TABLE_DOCUMENTS) -> tuple[pa.Array, np.ndarray]:
    """(most frequent pre-token pieces of a bounded sample of documents, their token counts); at most ``units``."""
    chosen = bounded(documents.select("doc_id", "text"), sample, "doc_id", "text").select("text").repartition(16)

    def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tokens.encoding(tokenizer) as encoder:
            yield from count_units(batches, encoder)

    def count_units(batches: Iterator[pa.RecordBatch], encoder: tokens.Encoder) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch.column(0)):
                found = encoder.units(part)
                keep = pc.less_equal(pc.binary_length(found.pieces), UNIT_BYTES)
                yield pa.RecordBatch.from_arrays([found.pieces.filter(keep), pa.array(found.counts()[keep.to_numpy(zero_copy_only=False)])], ["unit", "n"])

    counted = chosen.mapInArrow(scan.released(count_task), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "unit").limit(units).toArrow()
    frequent = top.column("unit").combine_chunks().cast(pa.string())
    return frequent, tokens.Encoder(tokenizer).lengths(frequent)


def token_counts(documents: DataFrame, tokenizer: str = tokens.BYTE_BPE, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row of ``documents`` (doc_id, text).

    Counts equal those of the library for the whole text without added special tokens. Null and empty texts have none;
    repeated rows are counted each for itself; other columns are ignored; an empty table gives no rows. The table of
    frequent pieces is bounded in entries and bytes. No piece is shuffled: a task looks its pieces up in the table, then
    in its worker's cache, and only what is in neither goes to the tokenizer.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent, lengths = frequent_lengths(docs, tokenizer)
    table = docs.sparkSession.sparkContext.broadcast((frequent.to_pylist(), lengths.astype(np.int32)))

    def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tokens.encoding(tokenizer) as encoder:
            yield from count_documents(batches, encoder)

    def count_documents(batches: Iterator[pa.RecordBatch], encoder: tokens.Encoder) -> Iterator[pa.RecordBatch]:
        known, known_lengths = pa.array(table.value[0], pa.string()), table.value[1]
        for batch in batches:
            at = 0
            for part in tokens.slices(batch.column("text")):
                found = encoder.units(part)
                place = pc.fill_null(pc.index_in(found.pieces, value_set=known), -1).to_numpy(zero_copy_only=False)
                lens = np.zeros(len(place), np.int64)
                hit = place >= 0
                lens[hit] = known_lengths[place[hit]]
                if not hit.all():
                    lens[~hit] = encoder.lengths(found.pieces.filter(pa.array(~hit)))
                n = found.lengths(lens)
                size = pc.fill_null(pc.binary_length(part), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), size, pa.array(n, pa.int64()), pa.array(n > limit)], schema=_ARROW)
                at += len(part)

    return docs.mapInArrow(scan.released(count_task), COUNTS)
