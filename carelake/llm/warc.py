"""WARC archives: a deterministic sharded writer and its reader.

Records are range-sorted by page, one gzip member each; a task rolls its file when the next member would pass the size
limit, so files hold contiguous page ranges. Headers and digests come from the payload alone. Every file is written under
a temporary name, moved to a name made of task and number, and listed in a manifest that Spark commits when all tasks
are through; readers take only files of the manifest, so what a lost task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import files
from carelake.session import scratch_path

ROLL_BYTES = 64 << 20
#: Payloads with fewer bytes are always stored as responses.
REVISIT_BYTES = 1
DATE = "2020-01-01T00:00:00Z"

# Fixed texts of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

MANIFEST = "shard int, number int, file string, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}/{copy}')}>"


def _line(value) -> str:
    return " ".join(str(value).split())


def _record(page_id, url, payload: bytes, digest: str, copy: int, refers_to, is_revisit: bool, date: str) -> bytes:
    block = HTTP_HEAD.format(len(payload)).encode() + (b"" if is_revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest, copy)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: sha1:{_digest(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if is_revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}", f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``; returns the manifest.

    Null html is an empty payload. Of equal payloads of at least ``revisit_bytes`` bytes the one with the largest page_id
    is a response and the others revisit it (a null id counts as smallest; of rows that repeat the same page and payload
    all but one revisit that page). Other columns are ignored. An empty table gives an empty manifest.
    The html is shuffled once; who revisits whom is found on digests alone and sent along as rows of its own.
    """
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    page = page.withColumn("digest", F.unhex(F.sha1("html")))
    seen = page.where(F.octet_length("html") >= revisit_bytes).select("digest", "page_id")
    keeper = seen.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1")
    smaller = F.col("keeper").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper")))
    revisits = seen.join(keeper, "digest").where(smaller).groupBy("page_id", "digest").agg(F.max("keeper").alias("keeper"))
    rows = revisits.select("page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "keeper")
    rows = rows.unionByName(page.select("page_id", "digest", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("long").alias("keeper")))

    def write_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, records, listed = TaskContext.get().partitionId(), None, 0, []
        keeper_of, previous, copy = None, None, 0

        def close():
            out.commit()
            listed.append({"shard": shard, "number": len(listed), "file": out.name, "records": records, "bytes": out.size, "sha1": out.digest.hexdigest()})

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["page_id"], r["digest"])
                if r["kind"] == 0:
                    keeper_of = (key, r["keeper"])
                    continue
                payload = r["html"].encode()
                copy = copy + 1 if key == previous else 0
                previous = key
                revisit, refers_to = False, None
                if keeper_of is not None and keeper_of[0] == key:
                    revisit, refers_to = True, keeper_of[1]
                elif copy and len(payload) >= revisit_bytes and r["page_id"] is not None:
                    revisit, refers_to = True, r["page_id"]
                member = _record(r["page_id"], r["url"], payload, base64.b32encode(r["digest"]).decode(), copy, refers_to, revisit, date)
                if out is not None and out.size + len(member) > roll_bytes:
                    close()
                    out, records = None, 0
                if out is None:
                    out = files.Committed(folder, f"pages-{shard:06d}-{len(listed):05d}.warc.gz")
                out.write(member)
                records += 1
        if out is not None:
            close()
        if listed:
            yield pa.RecordBatch.from_pylist(listed, pa.schema([("shard", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]))

    ordered = rows.repartitionByRange("page_id").sortWithinPartitions("page_id", "digest", "kind", "url")
    path = f"{folder.rstrip('/')}/manifest"
    ordered.mapInArrow(write_task, MANIFEST).write.parquet(path)
    return pages.sparkSession.read.schema(MANIFEST).parquet(path)


def _members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    data = b""
    while True:
        data = data or stream.read(files.BLOCK)
        if not data:
            return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data and not (data := stream.read(files.BLOCK)):
                raise ValueError("archive ends inside a record")
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
        yield b"".join(parts)


def _parse(record: bytes, with_payload: bool) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{_digest(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    length = int(http.rpartition(b"Content-Length: ")[2])
    if not revisit and (length != len(payload) or _digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page"),
        "payload": payload.decode() if with_payload and not revisit else None,
    }


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in the manifest of ``folder``; sizes and digests are checked on the way.

    A revisit has no payload of its own; its size and digest are those of the full payload.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())])

    def read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.reader(folder, row["file"]) as stream:
                    found, held = [], 0
                    for member in _members(stream):
                        found.append(_parse(member, with_payload))
                        held += len(member) if with_payload else 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, held = [], 0
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema)

    n = max(1, min(manifest.count(), 100_000))
    return manifest.select("file").repartition(n).mapInArrow(read_task, RECORDS)


def archive(pages: DataFrame, roll_bytes: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, without payloads."""
    folder = scratch_path(pages.sparkSession, "warc")
    write(pages, folder, roll_bytes, revisit_bytes)
    return read(pages.sparkSession, folder, with_payload=False).drop("payload", "url")
