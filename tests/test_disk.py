"""What queries leave on disk while they run: sources, shuffles, states."""

import os
import sys
import time

import numpy as np
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_cleaning import claims

from carelake.operators import cleaning, corpus, index
from carelake.plans import domain, lake_queries, retrieval_queries
from carelake.session import held
from carelake.streaming import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])
TABLES = {
    "customer": "id AS c_custkey, concat('C', id) AS c_name FROM range(50)",
    "supplier": "id AS s_suppkey, concat('S', id) AS s_name FROM range(4)",
    "part": "id AS p_partkey, concat('P ', id) AS p_name, 'T' AS p_type, 10.0d + id AS p_retailprice FROM range(60)",
    # an order without a customer, and one that comes twice
    "orders": "id % 400 AS o_orderkey, if(id = 7, NULL, id % 50) AS o_custkey, 'F' AS o_orderstatus, concat(id % 5, '-P') AS o_orderpriority FROM range(401)",
    "lineitem": "if(id = 5, NULL, id % 400) AS l_orderkey, id % 60 AS l_partkey, id % 4 AS l_suppkey, if(id % 100 = 11, NULL, int(id div 500)) AS l_linenumber,"
    " double(id % 5) AS l_quantity, 12.5d AS l_extendedprice, timestamp'2001-02-03' AS l_shipdate, 'O' AS l_linestatus, 'N' AS l_returnflag FROM range(3000)",
}


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """Small tables whose claims are cut into as many slices as large ones; scratch folders below ``tmp_path``."""
    for name, text in TABLES.items():
        spark.sql(f"SELECT {text}").write.parquet(f"{tmp_path}/in/{name}.parquet")
    monkeypatch.setattr(domain, "SLICE_BYTES", 1, raising=False)
    monkeypatch.setattr(lake_queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    return f"{tmp_path}/in"


def size(folder, start=""):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.startswith(start))


def shuffled(spark, least=0):
    """Bytes of shuffle files, once no more than ``least`` are left, or after a while."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    for _ in range(40):
        if (found := sum(size(str(f), "shuffle_") for f in folders)) <= least:
            break
        time.sleep(0.1)
    return found


def given_claims(spark, folder):
    return domain.run_sql(spark, folder, domain.VIEWS["claims"])


def test_stream_clean_csv_keeps_no_shuffles_and_little_text(spark, tables, tmp_path):
    expected, text = rows(cleaning.drop_any_blank(given_claims(spark, tables))), f"{tmp_path}/text"
    given_claims(spark, tables).write.csv(text)
    before = shuffled(spark)
    found = lake_queries.QUERIES["stream_clean_csv"](spark, tables)
    assert shuffled(spark, before) <= before
    assert size(f"{tmp_path}/arrivals", "part-") < size(text, "part-") / 2
    assert rows(found) == expected and len(expected) > 1000
    assert len(domain.claim_slices(spark, tables)) == domain.SLICES


def test_claim_files_report_keeps_no_shuffles_and_little_text(spark, tables, tmp_path):
    text = f"{tmp_path}/text"
    given_claims(spark, tables).write.csv(text)
    before = shuffled(spark)
    found = lake_queries.QUERIES["claim_files_report"](spark, tables)
    assert shuffled(spark, before) <= before
    assert size(f"{tmp_path}/claim-files", "part-") < size(text, "part-") / 2
    counts = given_claims(spark, tables).groupBy(F.substring("priority", 1, 1)).count()
    assert rows(found.select("file", "original_rows")) == rows(counts) and counts.count() == 5


@pytest.mark.parametrize("few", [100_000, 0])
def test_a_stored_report_reads_whole_claims_of_disputed_ids_alone(spark, monkeypatch, few):
    """Rows of an id that differ in what is counted or not, ids in several files or in none, files without valid rows."""
    monkeypatch.setattr(cleaning, "FEW_IDS", few, raising=False)
    odd = [
        {}, {}, {"patient_id": "q"}, {"claim_id": " c1 ", "patient_id": "a", "service_date": "2024-02-30"},
        {"claim_id": "2", "currency": "us"}, {"claim_id": "2", "currency": None, "net_amount": "7"},
        {"claim_id": "3", "diagnosis_code": None, "patient_id": "b"}, {"claim_id": "3", "currency": "x", "patient_id": "c"},
        {"claim_id": None}, {"claim_id": "", "diagnosis_code": "nan"}, {"claim_id": "nan"},
        {"claim_id": "4", "quantity": "0"}, {"claim_id": "4", "quantity": "x"}, {"claim_id": "4", "service_date": " "},
        {"claim_id": "5", "net_amount": "1e999"}, {"claim_id": "5", "service_date": "soon"}, {"claim_id": "5"},
    ]
    raw = claims(spark, *odd).withColumn("file", F.lit("a"))
    raw = raw.unionByName(claims(spark, *odd[3:9]).withColumn("file", F.lit(None).cast("string")))
    raw = raw.unionByName(claims(spark, *odd[11:14]).withColumn("file", F.lit("c"))).repartition(5)
    found, expected = cleaning.stored_quality_report(raw, ["file"]), cleaning.quality_report(raw, ["file"])
    assert found.columns == expected.columns and found.dtypes == expected.dtypes
    assert rows(found) == rows(expected) and found.count() == 3
    narrow = cleaning.stored_quality_report(raw.limit(0), ["file"])
    assert narrow.columns == expected.columns and narrow.count() == 0


def test_stream_clean_claims_keeps_digests_and_no_sources(spark, tables, tmp_path):
    given = given_claims(spark, tables)
    name = F.concat(F.trim("patient_name"), F.lit(" corrected"))
    corrected = given.filter(F.substring_index("claim_id", "-", 1).cast("bigint") % 6 == 0).withColumn("patient_name", name)
    expected = cleaning.clean_claims(given).unionByName(cleaning.clean_claims(corrected))
    before = shuffled(spark)
    found = lake_queries.QUERIES["stream_clean_claims"](spark, tables)
    assert shuffled(spark, before) <= before
    assert rows(found) == rows(expected) and found.count() > 1000
    # a digest a claim; neither the files that arrived nor cleaned rows a second time
    assert not os.path.exists(f"{tmp_path}/arrivals")
    assert {f for _, _, names in os.walk(f"{tmp_path}/state") for f in names if f.endswith((".parquet", ".sst", ".zip"))} == {
        f for _, _, names in os.walk(f"{tmp_path}/state/known") for f in names if f.endswith(".parquet")
    }
    assert spark.read.parquet(f"{tmp_path}/state/known").count() == found.count()


def test_a_repeated_batch_of_claims_overwrites_its_own_rows(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    run = lambda: files.stream_clean_claims(files.csv_stream(spark, source, cleaning.CLAIM_COLUMNS), out, state).awaitTermination()
    read = lambda: rows(spark.read.parquet(out).select("claim_id", "patient_id", "batch"))
    claims(spark, {}, {"claim_id": "2"}).write.option("header", True).csv(source)
    run()
    claims(spark, {}, {"patient_id": "q"}, {"claim_id": "2", "net_amount": "-0"}).write.mode("append").option("header", True).csv(source)
    run()
    # the first of c1 is the stored one, so its other row is none
    expected = [("2", "p", 0), ("2", "p", 1), ("c1", "p", 0)]
    assert read() == expected
    for name in ("1", ".1.crc"):  # as if it had died before it was noted as done
        os.remove(f"{state}/cleaning/commits/{name}")
    run()
    assert read() == expected


def test_new_claims_are_shuffled_once(spark):
    raw = claims(spark, {}, {"claim_id": "2"}, {"claim_id": "3", "net_amount": "-0"}, {"claim_id": "4"}, {"claim_id": None})
    known = cleaning.clean_claims(claims(spark, {}, {"claim_id": "3", "net_amount": "0"}, {"claim_id": "4", "priority": None}))
    known = known.select("claim_id", cleaning.claim_digest().alias("digest"))
    with held(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"), held(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        found = cleaning.new_claims(raw, known)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found.select("claim_id", "priority")) == [("2", "normal"), ("4", "normal")]
    # the claims once; the known claims for their own keep-first and for the digests
    assert plan.count("Exchange hashpartitioning") == 3
    assert found.dtypes == cleaning.clean_claims(raw).dtypes


def letters(texts):
    return np.array([[len(t), 1.0] for t in texts], dtype=np.float64).reshape(len(texts), 2)


def test_an_index_in_parts_is_that_of_all_and_stores_no_text_hash(spark, tmp_path):
    docs = spark.range(300).selectExpr("if(id = 7, NULL, concat('d', id div 2)) AS id", "if(id = 9, NULL, concat('text ', id)) AS text", "concat('s', id % 2) AS shard")
    read = lambda path: rows(index.read(spark, path).select("id", "text", "shard", "vector", "text_hash", "indexed_at"))
    one, parted = f"{tmp_path}/one", f"{tmp_path}/parted"
    before = shuffled(spark)
    index.create(docs, letters, one, "2024-01-01 00:00:00", buckets=4)
    index.create([docs.filter("shard = 's0'"), docs.filter("false"), docs.filter("shard = 's1'")], letters, parted, "2024-01-01 00:00:00", buckets=4)
    assert read(parted) == read(one) and len(read(one)) == 300
    assert "text_hash" not in spark.read.parquet(f"{parted}/rows").columns
    change = docs.filter("id < 'd2'").withColumn("text", F.concat("text", F.lit(" new")))
    for path in (one, parted):
        index.update(spark, path, change, letters, "2024-01-02 00:00:00")
    assert read(parted) == read(one) != [] and "text_hash" not in spark.read.parquet(f"{parted}/rows").columns
    assert shuffled(spark, before) <= before


def test_an_index_that_stores_text_hashes_is_kept_up(spark, tmp_path):
    docs, path = spark.range(40).selectExpr("concat('d', id) AS id", "concat('text ', id) AS text", "'s' AS shard"), f"{tmp_path}/old"
    old = index._encoded(index._keyed(docs, "id", 4), letters, "2024-01-01 00:00:00")
    spark.createDataFrame([(4, "id", old.schema.json())], "buckets int, route string, schema string").write.parquet(f"{path}/layout")
    index._write(old, path)
    index.update(spark, path, docs.filter("id < 'd2'").withColumn("text", F.lit("new")), letters, "2024-01-02 00:00:00")
    stored = spark.read.schema(old.schema).parquet(f"{path}/rows").filter("indexed_at IS NOT NULL")
    assert rows(stored.select("id", "text", "text_hash")) == rows(stored.selectExpr("id", "text", "sha2(text, 256)"))
    assert stored.count() == 40 and stored.filter("text = 'new'").count() == 12


def test_index_one_patient_holds_one_slice_of_shuffles(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(retrieval_queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    before = shuffled(spark)
    found = retrieval_queries.QUERIES["index_one_patient"](spark, tables)
    assert shuffled(spark, before) <= before
    docs = corpus.medication_documents(domain.view(spark, tables, "medications"))
    own = F.when(F.col("metadata")["patient"] == "42", "2024-03-01").otherwise("2024-02-01")
    assert rows(found.select("id", "text", "indexed_on")) == rows(docs.select("id", "text", own)) and found.filter("indexed_on = '2024-03-01'").count() > 10
