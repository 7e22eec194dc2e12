"""Stored tables that tasks read by themselves, block by block, beside the rows Spark deals to them.

Where every row of a large table meets every row of a table of questions, the questions are stored once in the shared folder
and each task streams them in blocks of bounded size: nothing passes the driver, nothing is broadcast, and the large table is
scanned once however many questions there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame

from carelake.session import scratch_path


def stored(df: DataFrame, name: str) -> str:
    """Write ``df`` to the shared folder; the path that ``blocks`` reads."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, as Arrow opens them (``file:``, ``hdfs:``, object stores, or a plain path)."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def blocks(path: str, rows: int, columns: list[str] | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of a stored table, file by file in the order of names, at most ``rows`` at a time; same order in every task."""
    system, root = resolve(path)
    files = sorted(f.path for f in system.get_file_info(fs.FileSelector(root)) if f.is_file and f.base_name.startswith("part-"))
    for file in files:
        with system.open_input_file(file) as source, pq.ParquetFile(source) as table:
            yield from table.iter_batches(batch_size=rows, columns=columns)
