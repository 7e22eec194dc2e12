"""Nested reports in parts, tables from rows with differing keys, and catalog updates."""

import json

import oracle
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_queries import ORACLES, QUERIES

from carelake.operators import analytics, keys, medications, nesting
from carelake.plans import claims_queries
from carelake.session import scratch_path
from carelake.sources import writers


@pytest.mark.parametrize("size", [1, 7, 64, 100_000])
def test_parts_flatten_to_the_groups(spark, size):
    """One patient holds most rows, some repeat, one group is null."""
    data = [("hot", i % 900) for i in range(2_000)] + [(f"p{i % 40}", i) for i in range(300)] + [(None, 5), (None, None)]
    df = spark.createDataFrame(data, "patient string, code long")
    parts = nesting.nested_parts(df, ["patient"], ["code"], F.col("code"), "codes", size).collect()
    assert max(len(r.codes) for r in parts) <= size
    found = {}
    for r in sorted(parts, key=lambda r: r.part):
        assert r.part == found.setdefault(r.patient, [0, []])[0]
        found[r.patient][0] += 1
        found[r.patient][1] += r.codes
    expected = {}
    for patient, code in sorted(data, key=lambda d: (d[1] is not None, d[1])):
        expected.setdefault(patient, []).append(code)
    assert {p: codes for p, (_, codes) in found.items()} == expected


def test_parts_of_nothing(spark):
    assert nesting.nested_parts(spark.createDataFrame([], "g string, v int"), ["g"], ["v"], F.col("v"), "all").collect() == []


def test_multi_medication_parts_equal_the_nested_report(spark):
    data = [(str(i), f"p{i % 7}", f"c{i * i % 31}", f"name {i % 5}") for i in range(400)]
    df = spark.createDataFrame(data, "id string, patient string, code string, description string")
    patients = spark.createDataFrame([(f"p{i}", "A", str(i)) for i in range(6)], "id string, first string, last string")
    whole = {r.patient_id: r.medications for r in medications.patients_with_multiple_medications(df, patients).collect()}
    parts = sorted(medications.multi_medication_parts(df, patients, 4).collect(), key=lambda r: (r.patient_id, r.part))
    joined = {}
    for r in parts:
        assert len(r.medications) <= 4
        joined.setdefault(r.patient_id, []).extend(r.medications)
    assert joined == whole


def test_display_name_parts(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", ""), ("a", None), ("a", "y"), ("b", "")], "patient string, n string")
    assert rows(analytics.display_name_parts(df, "patient", "n", 100)) == [("a", 0, "x, y, y")]
    small = analytics.display_name_parts(df, "patient", "n", 2).orderBy("part").collect()
    assert [(r.part, r.names) for r in small] == [(0, "x, y"), (1, "y")]


def test_keys_in_order_of_first_sight(spark):
    """As a dictionary in Python collects them, row after row."""
    texts = ['{"z": 1, "b": null}', "not json", None, '{"a": {"x": [1, 2.5]}, "z": "t", "b": false}', "{}", "[1]", '{"k k": "", "a": [1]}', '{"z": 1, "z": 2}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, body string").repartition(5)
    out = keys.union_of_keys(df, "body", ["n"], keep=["n"])
    objects = [json.loads(t) if t and t.startswith("{") else {} for t in texts]
    assert out.columns == ["n", *dict.fromkeys(k for o in objects for k in o)]
    found = [tuple(r) for r in out.orderBy("n").collect()]
    assert found[0] == (0, "1", None, None, None)
    assert found[1:3] == [(1,) + (None,) * 4, (2,) + (None,) * 4]
    assert found[3] == (3, "t", "false", '{"x":[1,2.5]}', None)
    assert found[4:] == [(4,) + (None,) * 4, (5,) + (None,) * 4, (6, None, None, "[1]", ""), (7, "2", None, None, None)]


def test_keys_apart_from_case_none_and_too_many(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"a": 1, "A": 2, "N": 3}'), (2, '{"A": 4}')], "n int, body string")
    out = keys.union_of_keys(df, "body", ["n"], keep=["n"])
    assert out.columns == ["n", "a", "A_2", "N_2"]
    assert rows(out) == [(1, "1", "2", "3"), (2, None, "4", None)]
    writers.export_csv(out.coalesce(1), f"{tmp_path}/csv")
    assert sorted(next((tmp_path / "csv").glob("*.csv")).read_text().split()) == ["1,1,2,3", "2,,4,", "n,a,A_2,N_2"]
    assert keys.union_of_keys(df.limit(0), "body", ["n"], keep=["n"]).columns == ["n"]
    with pytest.raises(ValueError):
        keys.union_of_keys(df, "body", ["n"], max_keys=2)


def test_table_of_other_columns_replaces_the_old_one(spark, tmp_path):
    """Also when a session was lost after the old table was renamed aside."""
    try:
        for i, columns in enumerate((["id"], ["id", "id * 2 AS twice"])):
            spark.range(3 + i).selectExpr(*columns).write.parquet(f"{tmp_path}/{i}")
            assert writers.register_table(spark, "nesting_db", "t", f"{tmp_path}/{i}", "parquet") == ("updated" if i else "created")
        assert spark.table("nesting_db.t").columns == ["id", "twice"] and spark.table("nesting_db.t").count() == 4
        spark.sql("ALTER TABLE nesting_db.t RENAME TO nesting_db.t_replaced")
        assert writers.register_table(spark, "nesting_db", "t", f"{tmp_path}/0", "parquet") == "updated"
        assert spark.table("nesting_db.t").columns == ["id"]
        assert [t.name for t in spark.catalog.listTables("nesting_db")] == ["t"]
    finally:
        spark.sql("DROP DATABASE IF EXISTS nesting_db CASCADE")


def test_clean_claims_see_new_input(spark, monkeypatch):
    stored = claims_queries.clean(spark, "/root/testdata/sf0.001").inputFiles()
    assert claims_queries.clean(spark, "/root/testdata/sf0.001").inputFiles() == stored
    state = claims_queries._state(spark, "/root/testdata/sf0.001")
    folder = scratch_path(spark, "state")
    spark.range(1).write.parquet(f"{folder}/a.parquet")
    before = claims_queries._state(spark, folder)
    spark.range(1).write.mode("append").parquet(f"{folder}/a.parquet")
    assert claims_queries._state(spark, folder) != before != state


@pytest.mark.parametrize("name", ["patients_multi_medication_parts", "display_name_parts", "key_union", "file_listing", "nested_json"])
def test_queries_on_larger_tables(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name]) == []
