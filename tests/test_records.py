import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carelake.operators import analytics, forecast, items, medications, monitoring


def meds(spark, *data):
    return spark.createDataFrame(data, "id string, patient string, code string, description string")


def test_lookups_and_limit(spark):
    df = meds(spark, ("1", "alice", "111", ""), ("2", "alice", "222", ""), ("3", "bob", "333", ""), ("4", "c", "ASPIRIN", ""), ("5", "d", "ASPIRIN", ""))
    assert medications.find_medications(df, patient_id="alice").count() == 2
    assert medications.find_medications(df, patient_id="nobody").count() == 0
    assert medications.find_medications(df, medication_id="ASPIRIN").count() == 2
    assert medications.page_after(df, ["id"], None, 2).count() == 2
    assert [r.id for r in medications.page_after(df, ["id"], ["2"], 2).collect()] == ["3", "4"]


def test_multiple_medications(spark):
    df = meds(
        spark, ("1", "a", "x", ""), ("2", "a", "x", "Xan"), ("3", "a", "y", "Yan"), ("4", "b", "x", "Xan"), ("5", "b", None, "?"), ("6", "", "z", ""),
        ("7", "c", "y", None), ("8", "c", "z", "Zan"), ("9", "c", "x", "Xan"),
    )
    patients = spark.createDataFrame([("a", "Ann", "Lee"), ("c", "", "Poe")], "id string, first string, last string")
    out = [r.asDict(recursive=True) for r in medications.patients_with_multiple_medications(df, patients).collect()]
    assert [(r["patient_id"], r["patient_name"], r["medication_count"]) for r in out] == [("c", "Poe", 3), ("a", "Ann Lee", 2)]
    assert [(m["medicationId"], m["medicationName"], m["count"]) for m in out[1]["medications"]] == [("x", "Xan", 2), ("y", "Yan", 1)]
    assert medications.patients_with_multiple_medications(df, patients, top_n=1).count() == 1


def test_column_types(spark):
    df = spark.createDataFrame([("1", "1", "", "1e3"), ("2.5", "2", None, "4"), ("x", " 3 ", " ", "5")], "mixed string, ints string, blank string, exp string")
    assert medications.column_types(df) == {"mixed": "string", "ints": "bigint", "blank": "string", "exp": "string"}
    numbers = spark.createDataFrame([("1",), ("2.5",)], "n string")
    assert medications.column_types(numbers) == {"n": "double"}


def test_generic_rows_get_ids_and_keep_own(spark):
    df = spark.createDataFrame([("a", "1", None), ("b", " ", "own")], "` Name ` string, N string, ID string")
    out = medications.type_generic_rows(df, [" Name "])
    assert rows(out.select("id", "name", "n")) == [("a-1-0", "a", 1), ("own", "b", None)]


def test_routes_and_default_ids(spark):
    df = spark.createDataFrame([("p", ""), ("", ""), (None, "d")], "PATIENT string, DESCRIPTION string")
    assert [d.count() for d in medications.route_rows(df)] == [2, 1]
    body = spark.createDataFrame([(None, None, "c")], "id string, patient string, code string")
    assert medications.medication_items(body).first().id == "patient-encounter-c"


def test_sort_key_and_conditions(spark):
    df = spark.createDataFrame([("NDA020503 200 ACTUAT Albuterol",), ("24 HR Metformin ",)], "description string")
    assert [r[0] for r in df.select(medications.drug_sort_key(F.col("description"))).collect()] == ["albuterol", "metformin"]
    mapping = spark.createDataFrame([("m", " a \n\n b")], "drug_name string, conditions string")
    out = medications.drug_conditions(spark.createDataFrame([("m",), ("n",)], "drug_name string"), mapping)
    assert rows(out) == [("m", ["a", "b"]), ("n", None)]


def claims_of(spark, *months):
    data = [(p, n, d) for p, n, d in months]
    return spark.createDataFrame(data, "provider_id string, provider_name string, d string").withColumn("service_date", F.to_date("d"))


def test_forecast_edges(spark):
    claims = claims_of(
        spark, ("one", "B", "2024-01-05"), ("one", "A", "2024-01-06"), ("flat", "F", "2024-01-01"), ("flat", "F", "2024-02-01"),
        ("gap", "G", "2024-01-01"), ("gap", "G", "2024-05-01"), ("gap", "G", "2024-05-02"), ("done", "D", "2024-06-01"), (None, "N", "2024-01-01"),
    )
    trend = {r.provider_id: r for r in forecast.provider_regression(forecast.monthly_counts(claims)).collect()}
    assert (trend["one"].slope, trend["one"].intercept, trend["one"].r2, trend["one"].provider_name) == (0.0, 2.0, 1.0, "A")
    assert (trend["flat"].slope, trend["flat"].intercept, trend["flat"].r2) == (0.0, 1.0, 1.0)
    assert (trend["gap"].slope, trend["gap"].n_months) == (1.0, 2)
    flat = forecast.provider_forecast(claims, "2024-06")
    assert flat.filter("provider_id = 'done'").count() == 0
    assert rows(flat.filter("provider_id = 'gap'").select("month", "predicted_claims")) == [("2024-06", 3)]
    docs = {r.provider_id: r for r in forecast.provider_documents(claims, "2024-06").collect()}
    assert len(docs["flat"].forecast) == 4 and docs["done"].forecast == [] and set(docs) == {"one", "flat", "gap", "done"}


def test_rounding_is_half_even_and_never_negative(spark):
    df = spark.createDataFrame([(0.5, 0.0, 1), (0.5, 1.0, 1), (-3.0, 1.0, 1)], "s double, i double, x int")
    assert [r[0] for r in df.select(forecast.predicted_count(F.col("s"), F.col("i"), F.col("x"))).collect()] == [0, 2, 0]


def test_activity_merges_same_named_patients(spark):
    patients = spark.createDataFrame([("1", "A", "B", "M", "w"), ("2", "A", "B", "M", "w"), ("3", "C", "D", "F", "w")], "id string, first string, last string, gender string, race string")
    encounters = spark.createDataFrame([("e1", "1"), ("e2", "2"), ("e3", "2")], "id string, patient string")
    codes = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "2")], "code string, patient string")
    out = analytics.patient_activity(patients, encounters, codes, codes)
    assert rows(out) == [("A", "B", "M", "w", 3, 2, 2), ("C", "D", "F", "w", 0, 0, 0)]


def test_patient_activity_numbers_name_groups(spark):
    patients = spark.createDataFrame(
        [("1", "A", None, "M", "w"), ("2", "A", None, "M", "w"), ("1", "C", "D", "F", "w"), (None, "E", "F", "F", "w"), ("1", "A", None, "M", "w")],
        "id string, first string, last string, gender string, race string",
    )
    encounters = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "2"), ("c", "9"), ("d", None)], "id string, patient string")
    codes = spark.createDataFrame([("1", "x"), ("2", "x"), ("2", None)], "patient string, code string")
    out = analytics.patient_activity(patients, encounters, codes, codes)
    assert rows(out) == [("A", None, "M", "w", 2, 1, 1), ("C", "D", "F", "w", 1, 1, 1), ("E", "F", "F", "w", 0, 0, 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert dealt and not any("value#" in d and "last#" in d for d in dealt)  # the names do not go with every value


def test_step_status(spark):
    events = spark.createDataFrame(
        [(1, 1, "clean_claims", "TaskStateEntered"), (1, 2, "clean_claims", "TaskStateExited"), (1, 3, "forecast_claims", "TaskTimedOut"), (1, 4, "clean_claims", "Other")],
        "execution_id int, event_id int, step string, type string",
    )
    found = {r.step: r.status for r in analytics.step_status(events).collect()}
    assert found == {"generate_synthetic_claims": "PENDING", "clean_claims": "SUCCEEDED", "store_claims_manifest": "PENDING", "forecast_claims": "FAILED"}


def test_limited_result_and_column_union(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert [analytics.limited_result(df, ["k"], n)[1] for n in (4, 5, 6)] == [True, True, False]
    joined = analytics.column_union([df.limit(1), spark.createDataFrame([("x",)], "z string")])
    assert joined.columns == ["k", "z"] and joined.count() == 2


@pytest.fixture
def stock(spark):
    return spark.createDataFrame(
        [("1", "Sports Watch", 100.0, "EUR", ["Watches", "Sports Watches"]), ("2", "Ring", 5.0, "USD", ["Rings"])],
        "itemId string, itemName string, price double, currency string, categories array<string>",
    )


def test_item_lookups(spark, stock):
    assert [r.itemId for r in items.find_by_category(stock, "Sports Watches").collect()] == ["1"]
    assert items.find_by_attributes(stock, {"currency": "EUR", "price": 100.0}).count() == 1
    assert items.find_by_attributes(stock, {"currency": "EUR", "price": 5.0}).count() == 0
    assert [r.itemId for r in items.page(stock, ["itemId"], 2, 1).collect()] == ["2"]


def test_upsert_merge_delete(spark, stock):
    source = stock.select("itemId", F.upper("itemName").alias("itemName"), "price", "currency", "categories", F.lit(1).alias("v")).filter("itemId = '1'")
    newer = source.withColumns({"itemName": F.lit("last"), "v": F.lit(2)})
    extra = source.withColumn("itemId", F.lit("3"))
    out = items.upsert(stock, source.unionByName(newer).unionByName(extra), ["itemId"], ["v"])
    assert rows(out.select("itemId", "itemName")) == [("1", "last"), ("2", "Ring"), ("3", "SPORTS WATCH")]
    changes = spark.createDataFrame([("2", "Band"), ("9", "None")], "itemId string, itemName string")
    assert rows(items.merge_update(stock, changes, "itemId").select("itemId", "itemName", "price")) == [("1", "Sports Watch", 100.0), ("2", "Band", None)]
    keys = spark.createDataFrame([("2",), ("9",), ("2",)], "itemId string")
    assert rows(items.deleted_keys(stock, keys)) == [("2", True), ("9", False)]
    assert rows(items.delete_rows(stock, keys=keys).select("itemId")) == [("1",)]
    assert rows(items.delete_rows(stock, where=F.col("price") > 50).select("itemId")) == [("2",)]


def test_messages_and_alarms(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("broken",), (None,), ("broken",)], "body string")
    decoded = monitoring.decode_messages(df, "k int").select("fields.k", "raw")
    assert rows(decoded) == [(1, None), (None, "broken"), (None, "broken"), (None, None)]
    assert rows(monitoring.quarantine(df, [])) == [("broken", 2), (None, 1)]
    metrics = spark.sql("SELECT * FROM VALUES (timestamp'2024-01-01 00:00:00', 1L), (timestamp'2024-01-01 00:03:00', 0L) AS t(window_start, errors)")
    states = [r.state for r in monitoring.alarms(metrics, F.col("errors") > 0, False).orderBy("window_start").collect()]
    assert states == ["ALARM", "OK", "OK", "OK"]
    states = [r.state for r in monitoring.alarms(metrics, F.col("errors") > 0, True).orderBy("window_start").collect()]
    assert states == ["ALARM", "ALARM", "ALARM", "OK"]


def test_sorted_queries_return_every_row(spark):
    from carelake.plans import records_queries
    from carelake.plans.domain import view

    sf_dir = "/root/testdata/sf0.01"
    got = [(r.id, r.last, r.first) for r in records_queries.QUERIES["sorted_patients"](spark, sf_dir).collect()]
    people = [(r.id, r.last, r.first) for r in view(spark, sf_dir, "patients").collect()]
    assert len(people) > 300 and got == sorted(people, key=lambda r: (r[1].lower(), r[2].lower(), r[0]))
    got = [r.code for r in records_queries.QUERIES["sorted_codes"](spark, sf_dir).collect()]
    codes = {r.code for r in view(spark, sf_dir, "medications").select("code").distinct().collect()}
    assert len(codes) > 300 and got == sorted(codes)
