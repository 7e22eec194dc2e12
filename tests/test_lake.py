import os
import time

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_cleaning import claims

from carelake.operators import cleaning, runs
from carelake.sources import readers, writers
from carelake.streaming import files as file_streams
from carelake.streaming import logs


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_readers(spark, tmp_path):
    path = put(tmp_path / "My File-1.csv", '﻿ A ,b\n x ,NA\ny\n"q ""z""",n/a,extra\n\n')
    trimmed = readers.read_csv_trimmed(spark, path)
    assert trimmed.columns == ["A", "b"]
    assert rows(trimmed) == [('q "z"', "n/a"), ("x", "NA"), ("y", None)]
    plain = readers.read_csv_strings(spark, path, ["a", "b"])
    assert rows(plain) == [(" x ", None), ('q "z"', None), ("y", None)]
    assert rows(cleaning.drop_any_blank(trimmed)) == [('q "z"', "n/a"), ("x", "NA")]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Id No", "id-no", "", "é1"])
    assert readers.csv_schema_from_header(df).columns == ["id_no", "id_no_2", "col", "_1"]
    names = spark.createDataFrame([("a/b/ My-File.v2.CSV",), ("__x__.csv",)], "n string")
    assert [r[0] for r in names.select(readers.table_name_from_file(F.col("n"))).collect()] == ["my_file_v2", "x"]


def test_listing(spark, tmp_path):
    old = put(tmp_path / "in" / "old.csv", "aa")
    put(tmp_path / "in" / "sub" / "new.csv", "bbb")
    put(tmp_path / "in" / "other.txt", "c")
    past = time.time() - 1000
    os.utime(old, (past, past))
    files = readers.list_files(spark, str(tmp_path / "in"), ".csv")
    assert [r.name for r in readers.newest_files(files).collect()] == ["new.csv", "old.csv"]
    assert tuple(readers.total_bytes(files).first()) == (2, 5)
    assert readers.latest_file(files).first().key.endswith("sub/new.csv")
    rows_of = readers.file_rows(spark.read.text(str(tmp_path / "in"), recursiveFileLookup=True), "old.csv")
    assert rows(rows_of) == [("aa",)]


def test_code_table_last_row_wins(spark, tmp_path):
    path = put(tmp_path / "codes.csv", "LOINC_NUM,LONG_COMMON_NAME\n1, first\n1,second \n2,\n,x\n3,c\n")
    assert rows(readers.read_code_table(spark, path)) == [("1", "second"), ("3", "c")]


def test_nested_json(spark, tmp_path):
    from carelake.operators import items

    text = '{"catalog": [{"categoryName": "Watches", "categoryId": "1", "itemsCount": 1,\n "items": [{"itemId": "i", "itemName": "W", "price": 150, "currency": "EUR"}]}]}'
    schema = "catalog array<struct<categoryName string, categoryId string, itemsCount int, items array<struct<itemId string, itemName string, price double, currency string>>>>"
    doc = readers.read_nested_json(spark, put(tmp_path / "c.json", text), schema)
    assert items.catalog_items(doc, "1", "i").first().price == 150.0
    assert items.catalog_items(doc, "2").count() == 0
    assert rows(items.catalog_categories(doc)) == [("1", "Watches")]


def test_exports(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, array('a', 'b') AS tags, cast(NULL AS string) AS n, cast(2.50 AS decimal(9,2)) AS d, cast(3 AS decimal(9,2)) AS w, 'q\"x' AS q")
    writers.export_csv(df, str(tmp_path / "csv"))
    back = readers.read_csv_trimmed(spark, str(tmp_path / "csv"))
    assert rows(back.na.fill("")) == [("1", '["a","b"]', "", "2.5", "3", 'q"x')]
    writers.export_ndjson(df, str(tmp_path / "json"))
    text = "".join(p.read_text() for p in (tmp_path / "json").glob("part*"))
    assert '"d":2.5' in text and '"w":3,' in text and '"n"' not in text


def test_export_all_goes_on_after_an_error(spark, tmp_path):
    bad = spark.range(1).select(F.expr("raise_error('no')").cast("string").alias("x"))
    db = "export_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path}/db'")
    out = {r.table_name: r for r in writers.export_all(spark, {"bad": bad, "good": spark.range(3)}, str(tmp_path / "o"), db, "parquet").collect()}
    assert out["bad"].action == "failed" and out["good"].rows == 3 and out["good"].bytes > 0


def test_export_csv_directory(spark, tmp_path):
    put(tmp_path / "in" / "payers.csv", "Id,NAME\n1,a\n2,b\n")
    put(tmp_path / "in" / "supplies.csv", "DATE,CODE\n")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dir_test LOCATION '{tmp_path}/db'")
    out = writers.export_csv_directory(spark, str(tmp_path / "in"), str(tmp_path / "lake"), "dir_test")
    assert rows(out.select("table_name", "rows", "action")) == [("payers", 2, "created"), ("supplies", 0, "created")]
    assert spark.table("dir_test.payers").count() == 2
    assert rows(writers.catalog_browse(spark, "dir_test").select("table_name", "column_name"))[0] == ("payers", "Id")


def test_import_refuses_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.import_table(spark.range(4), path) == 4
    with pytest.raises(AnalysisException):
        writers.import_table(spark.range(1), path)
    assert writers.import_table(spark.range(2), path, replace=True) == 2


def test_claims_run_writes_everything(spark, tmp_path):
    raw = claims(spark, {}, {"claim_id": "2", "service_date": "2024-02-01"}, {"claim_id": "3", "service_date": ""})
    run = runs.claims_run(spark, raw, str(tmp_path / "run"), "s1", "2024-03-01", "2024-04")
    assert run["report"].first().clean_rows == 2 == run["claims"].count()
    assert run["manifest"].agg(F.sum("rows")).first()[0] == 2
    assert len(run["forecast"].first().forecast) == 2


def test_stream_clean_csv_picks_up_new_files(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    put(source / "a.csv", "x,y\n1, 2\n3,\n")
    put(source / "skip.txt", "x,y\n9,9\n")
    run = lambda: file_streams.stream_clean_csv(file_streams.csv_stream(spark, str(source), ["x", "y"]), out, state).awaitTermination()
    run()
    put(source / "b.csv", "x,y\n5,6\n")
    run()
    assert rows(spark.read.parquet(out)) == [("1", "2"), ("5", "6")]


def test_stream_claims_skip_only_equal_rows(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: file_streams.stream_clean_claims(
        file_streams.csv_stream(spark, source, cleaning.CLAIM_COLUMNS), out, state
    ).awaitTermination()
    claims(spark, {}, {}, {"claim_id": "2"}).write.option("header", True).csv(source)
    run()
    claims(spark, {"patient_id": "zz"}, {"claim_id": "3"}, {"claim_id": "2"}, {"claim_id": "4", "diagnosis_code": "NA"}).write.mode("append").option("header", True).csv(source)
    run()
    stored = spark.read.parquet(out)
    assert rows(stored.select("claim_id", "patient_id", "batch")) == [("2", "p", 0), ("3", "p", 1), ("c1", "p", 0), ("c1", "zz", 1)]


def test_stream_log_statistics_closes_windows_behind_the_watermark(spark, tmp_path):
    line = '{"lambda_name": "f", "duration_ms": 2, "status": "ERROR"}'
    data = [("2024-01-01 00:00:01", line), ("2024-01-01 00:59:59", line), ("2024-01-01 01:30:00", line)]
    spark.createDataFrame(data, "ts string, line string").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts string, line string").json(str(tmp_path / "in"))
    logs.stream_log_statistics(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("lambda_name", "calls", "errors")) == [("f", 2, 2)]
