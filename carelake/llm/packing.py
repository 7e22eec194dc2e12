"""Sum-of-squares packing of token sequences into windows of fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import scan, tokens

WINDOW = 1024
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])


class Packer:
    """Online packing: each piece goes to the fill level that keeps the sum of squared level counts smallest.

    ``counts[h]`` is the number of partly filled windows that hold ``h`` ids. Moving one of them from level ``h`` to
    ``h + n`` changes the sum of squares by 2 (counts[h + n] - counts[h]) + 2; a new window counts as level 0 and a full
    window as gone, so their terms drop out. Ties go to the fullest level. Texts longer than a window fill whole windows
    first, and only the rest is placed. What is still open at the end is cut freely to fill windows up; the very last
    rest becomes sequences whose lengths are powers of two, which need no padding.
    """

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.window, self.sequence = window, first_sequence
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def level(self, n: int) -> int:
        """Fill level at which a piece of ``n`` ids is placed; 0 opens a window."""
        top = self.window - n
        change = 2 * (self.counts[n : n + top + 1] - self.counts[: top + 1]) + 2
        change[self.counts[: top + 1] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * self.counts[n] + 1 if n < self.window else 0
        if top and self.counts[top]:
            change[top] = 1 - 2 * self.counts[top]
        return top - int(np.argmin(change[::-1]))

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self._close([(doc_id, start, ids[start : start + self.window], len(ids))])
        n = len(ids) - whole
        if not n:
            return
        h = self.level(n)
        pieces = self.open[h].pop() if h else []
        if h:
            self.counts[h] -= 1
        pieces.append((doc_id, whole, ids[whole:].copy(), len(ids)))
        if h + n == self.window:
            self._close(pieces)
        else:
            self.open.setdefault(h + n, []).append(pieces)
            self.counts[h + n] += 1

    def _take(self, pieces: list[tuple], n: int) -> list[tuple]:
        """Cut the first ``n`` ids off a list of pieces."""
        taken = []
        while n:
            doc_id, start, ids, doc_tokens = pieces[0]
            taken.append((doc_id, start, ids[:n], doc_tokens))
            if len(ids) > n:
                pieces[0] = (doc_id, start + n, ids[n:], doc_tokens)
            else:
                pieces.pop(0)
            n -= min(n, len(ids))
        return taken

    def finish(self) -> None:
        windows = [(h, pieces) for h in sorted(self.open, reverse=True) for pieces in self.open[h]]
        spare = [p for _, pieces in reversed(windows) for p in pieces]
        left = sum(h for h, _ in windows)
        for h, pieces in windows:
            if left < self.window:
                break
            # the fullest windows stay as they are and are filled up from the emptiest
            spare = spare[: len(spare) - len(pieces)]
            self._close(pieces + self._take(spare, self.window - h))
            left -= self.window
        left = sum(len(p[2]) for p in spare)
        while left:
            n = min(self.window, 1 << (left.bit_length() - 1))
            self._close(self._take(spare, n))
            left -= n
        self.open, self.counts[:] = {}, 0

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)


def pack(documents: DataFrame, window: int = WINDOW, tokenizer: str = tokens.BYTE_BPE, end_id: int = END_ID) -> DataFrame:
    """Sequences of at most ``window`` ids over ``documents`` (doc_id, text); one row per piece of a document.

    A document is its ids and ``end_id``; null and empty texts are ``end_id`` alone. Repeated rows are packed each for
    itself, null ids stay null, other columns are ignored, an empty table gives no rows. Every input partition is packed
    on its own, in its own order, without a shuffle; sequence ids begin with the partition number. A partition ends
    without padding, so the number of partitions does not matter, and a partition holds a few hundred open windows at most.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 36, window)
        end = np.array([end_id], np.uint32)
        with tokens.encoding(tokenizer) as encoder:
            for batch in batches:
                at = 0
                for part in tokens.slices(batch.column("text")):
                    ids, off = encoder.encode(part)
                    for i, doc_id in enumerate(batch.column("doc_id").slice(at, len(part)).to_pylist()):
                        packer.add(doc_id, np.concatenate((ids[off[i] : off[i + 1]], end)))
                    at += len(part)
                    yield packer.drain()
        packer.finish()
        yield packer.drain()

    return docs.mapInArrow(scan.released(pack_task), PIECES)
