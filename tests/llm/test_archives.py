"""WARC writer and reader."""

import base64
import gzip
import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import files, warc  # noqa: E402
from carelake.session import scratch_path  # noqa: E402

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least):
    keeper = {}
    for page_id, _, html in rows:
        if len((html or "").encode()) >= least and page_id is not None:
            keeper[html or ""] = max(keeper.get(html or "", page_id), page_id)
    out, kept = [], set()
    for page_id, _, html in rows:
        html = html or ""
        to = keeper.get(html)
        revisit = to is not None and (page_id is None or page_id < to or (page_id, html) in kept)
        if page_id is not None and page_id == to:
            kept.add((page_id, html))
        out.append((page_id, len(html.encode()), digest(html), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, None, "<p>é \U0001f600</p>\r\n\r\nWARC/1.1"),
    (4, "http://a/ 4\n", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "x" * 300_000),
    (7, "u", "<p>one</p>"),
    (7, "u", "<p>one</p>"),
    (7, "v", "other"),
    (8, "u", "other"),
    (None, "u", "other"),
    (None, None, None),
]


@pytest.mark.parametrize("least", [0, 1, 8])
@pytest.mark.parametrize("clashing", [False, True])
def test_round_trip(spark, least, clashing):
    df = spark.createDataFrame(ROWS, SCHEMA)
    if clashing:
        for c in cases.CLASHING:
            df = df.withColumn(c, F.lit(1))
    assert cases.collected(warc.archive(df, revisit_bytes=least)) == expected(ROWS, least)


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], SCHEMA)).count() == 0


def test_files_are_rolled_sorted_listed_and_reproducible(spark):
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", cases.prose(rng, 400, 10**6)) for i in range(200)]
    shas = []
    for _ in range(2):
        folder = scratch_path(spark, "warc-test")
        manifest = sorted(warc.write(spark.createDataFrame(rows, SCHEMA).repartition(5), folder, roll_bytes=20_000).collect(), key=lambda m: m.file)
        assert all(m.bytes <= 20_000 for m in manifest) and len(manifest) > 8
        seen = []
        for m in manifest:
            with files.reader(folder, m.file) as stream:
                data = stream.read()
            assert hashlib.sha1(data).hexdigest() == m.sha1 and len(data) == m.bytes
            records = gzip.decompress(data)
            assert records.count(b"WARC/1.1\r\nWARC-Type: response") == m.records
            seen += [int(line[11:]) for line in records.split(b"\r\n") if line.startswith(b"X-Page-ID: ")]
        assert seen == list(range(200))
        shas.append([m.sha1 for m in manifest])
        system, root = files.resolve(folder)
        system.open_output_stream(f"{root}/pages-999999-00000.warc.gz").close()
        read = warc.read(spark, folder).collect()
        assert {(r.page_id, r.url, r.payload) for r in read} == set(rows)
    assert shas[0] == shas[1]


def test_damaged_payload_is_noticed(spark):
    record = gzip.decompress(warc._record(1, "u", b"payload", digest("payload"), 0, None, False, warc.DATE))
    assert warc._parse(record, True)["payload"] == "payload"
    with pytest.raises(ValueError):
        warc._parse(record.replace(b"payload", b"paxload"), True)
