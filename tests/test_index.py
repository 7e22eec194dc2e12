"""The stored index: upsert by id, files left alone, vectors used again, runs that die."""

import glob
import os
import sys

import numpy as np
import pytest
from conftest import rows
from pyspark import cloudpickle

from carelake.operators import index

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DAY = "2024-01-0{} 00:00:00"


def lengths(texts):
    return np.array([[len(t), 1.0] for t in texts], dtype=np.float64).reshape(len(texts), 2)


def refuse(texts):
    raise AssertionError("nothing is to be encoded")


@pytest.fixture
def docs(spark):
    made = [(f"d{i}", f"text {i}", "s" if i % 3 else "t", i) for i in range(200)]
    return spark.createDataFrame(made, "id string, text string, shard string, owner int")


def stored_files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/rows/*/*/*.parquet")}


def stored(spark, path):
    return rows(index.read(spark, path).selectExpr("id", "text", "shard", "day(indexed_at)", "day(encoded_at)"))


def test_a_run_on_equal_input_encodes_nothing(spark, docs, tmp_path):
    path, calls = str(tmp_path / "i"), spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return lengths(texts)

    index.create(docs, counted, path, DAY.format(1))
    assert calls.value == 200
    vectors = rows(index.read(spark, path).select("id", "vector"))
    index.update(spark, path, docs, refuse, DAY.format(2))
    assert rows(index.read(spark, path).select("id", "vector")) == vectors
    assert {r[3:] for r in stored(spark, path)} == {(2, 1)}
    change = docs.selectExpr("id", "if(owner < 5, 'other', text) AS text", "shard", "owner")
    index.update(spark, path, change, counted, DAY.format(3))
    assert calls.value == 205


def test_only_the_buckets_of_the_ids_are_written(spark, docs, tmp_path):
    path = str(tmp_path / "i")
    index.create(docs, lengths, path, DAY.format(1), buckets=32)
    before = stored_files(path)
    index.update(spark, path, docs.filter("id = 'd7'").selectExpr("id", "'new' AS text", "shard", "owner"), lengths, DAY.format(2))
    after = stored_files(path)
    assert len(before.keys() - after.keys()) == 1 and len(after.keys() - before.keys()) == 1
    assert all(before[f] == after[f] for f in before.keys() & after.keys())
    got = {r[0]: r[1:] for r in stored(spark, path)}
    assert got["d7"] == ("new", "s", 2, 2) and len(got) == 200
    assert sum(v[2:] == (1, 1) for v in got.values()) == 199


def test_documents_of_one_route_share_a_bucket(spark, docs, tmp_path):
    path = str(tmp_path / "i")
    grouped = docs.selectExpr("id", "text", "'s' AS shard", "owner div 20 AS owner")
    index.create(grouped, lengths, path, DAY.format(1), route="owner", buckets=64)
    before = stored_files(path)
    index.update(spark, path, grouped.filter("owner = 3"), refuse, DAY.format(2))
    assert len(before.keys() - stored_files(path).keys()) == 1
    # d0 goes from owner 0 to owner 9, whose bucket does not hold it
    moved = grouped.filter("id = 'd0'").selectExpr("id", "text", "shard", "9L AS owner")
    index.update(spark, path, moved, refuse, DAY.format(3))
    assert rows(index.read(spark, path).filter("id = 'd0'").selectExpr("owner", "day(indexed_at)", "day(encoded_at)")) == [(9, 3, 1)]
    assert index.read(spark, path).count() == 200


def test_a_shard_that_loses_its_last_document_is_empty(spark, tmp_path):
    path = str(tmp_path / "i")
    one = spark.createDataFrame([("a", "x", "s"), ("b", "y", "t")], "id string, text string, shard string")
    index.create(one, lengths, path, DAY.format(1))
    index.update(spark, path, one.filter("id = 'a'").selectExpr("id", "text", "'t' AS shard"), refuse, DAY.format(2))
    assert stored(spark, path) == [("a", "x", "t", 2, 1), ("b", "y", "t", 1, 1)]
    index.update(spark, path, one.filter("id = 'a'"), refuse, DAY.format(3))
    assert stored(spark, path) == [("a", "x", "s", 3, 1), ("b", "y", "t", 1, 1)]


def test_nulls_shared_ids_empty_tables_and_shards_like_numbers(spark, tmp_path):
    path = str(tmp_path / "i")
    odd = [(None, None, None), (None, "z", ""), ("a", "", "01"), ("a", "", "01"), ("b", None, "1")]
    df = spark.createDataFrame(odd, "id string, text string, shard string")
    index.create(df, lengths, path, DAY.format(1))
    want = sorted([("a", "", "01", 1, 1)] * 2 + [("b", None, "1", 1, 1), (None, "z", None, 1, 1), (None, None, None, 1, 1)], key=repr)
    assert stored(spark, path) == want
    index.update(spark, path, df.limit(0), refuse, DAY.format(2))
    assert stored(spark, path) == want
    index.update(spark, path, df, refuse, DAY.format(3))
    assert stored(spark, path) == [(*r[:3], 3, 1) for r in want]
    index.update(spark, path, df.filter("id = 'a'").limit(1), refuse, DAY.format(4))
    assert stored(spark, path) == sorted([("a", "", "01", 4, 1)] + [(*r[:3], 3, 1) for r in want if r[0] != "a"], key=repr)
    empty = str(tmp_path / "e")
    index.create(df.limit(0), refuse, empty, DAY.format(1))
    assert stored(spark, empty) == []
    index.update(spark, empty, df, lengths, DAY.format(2))
    assert len(stored(spark, empty)) == 5


def test_a_run_that_dies_while_files_are_swapped_is_completed(spark, docs, tmp_path, monkeypatch):
    path = str(tmp_path / "i")
    index.create(docs, lengths, path, DAY.format(1), buckets=8)
    change = docs.filter("owner < 50").selectExpr("id", "concat('new ', text) AS text", "shard", "owner")
    whole = index._write

    def dies(rows, path, mode="errorifexists"):
        if mode == "overwrite":
            whole(rows.filter("bucket < 3"), path, mode)
            raise OSError("lost")
        whole(rows, path, mode)

    monkeypatch.setattr(index, "_write", dies)
    with pytest.raises(OSError):
        index.update(spark, path, change, lengths, DAY.format(2))
    monkeypatch.undo()
    index.recover(spark, path)
    got = {r[0]: r[1] for r in stored(spark, path)}
    assert got == {f"d{i}": ("new " if i < 50 else "") + f"text {i}" for i in range(200)}
    files = stored_files(path)
    index.recover(spark, path)
    assert stored_files(path) == files


def test_a_run_that_dies_while_it_stores_its_rows_changes_nothing(spark, docs, tmp_path):
    path = str(tmp_path / "i")
    index.create(docs, lengths, path, DAY.format(1))
    docs.limit(3).write.parquet(f"{path}/pending")
    for name in glob.glob(f"{path}/pending/*SUCCESS") + glob.glob(f"{path}/pending/.*SUCCESS*"):
        os.remove(name)
    index.recover(spark, path)
    assert len(stored(spark, path)) == 200


def test_a_shard_filter_prunes_files(spark, docs, tmp_path):
    path = str(tmp_path / "i")
    index.create(docs, lengths, path, DAY.format(1))
    plan = index.read(spark, path).filter("shard = 't'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan
