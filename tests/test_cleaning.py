import datetime

from conftest import rows
from pyspark.sql import functions as F

from carelake.functions.dates import iso8601, parse_date
from carelake.functions.numbers import nullable_number
from carelake.functions.text import SPACE_CHARS, contains_text, slug, strip, words
from carelake.operators import cleaning
from carelake.operators.ordinals import row_ordinal

BASE = {
    "claim_id": "c1", "patient_id": "p", "patient_name": "n", "service_date": "2024-01-02", "status": "Active",
    "claim_type": "Professional", "use": "CLAIM", "provider_id": "d", "provider_name": "doc", "diagnosis_code": "dx",
    "diagnosis_description": "x", "procedure_code": "px", "procedure_description": "y", "unit_price": "10",
    "quantity": "2", "net_amount": "20", "currency": "USD", "insurance_member_id": "m", "priority": "Normal",
}


def claims(spark, *changes):
    data = [tuple({**BASE, **c}[n] for n in cleaning.CLAIM_COLUMNS) for c in changes]
    return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in cleaning.CLAIM_COLUMNS))


def report(spark, *changes):
    return cleaning.quality_report(claims(spark, *changes)).first().asDict()


def test_kept_first_row_with_bad_date_removes_claim(spark):
    raw = claims(spark, {"service_date": "2024-02-30", "patient_id": "a"}, {"patient_id": "b"})
    assert cleaning.clean_claims(raw).count() == 0
    out = cleaning.quality_report(raw).first()
    assert (out.dropped_duplicate_claims, out.dropped_invalid_dates, out.clean_rows) == (1, 1, 0)


def test_early_rejects_do_not_become_first(spark):
    raw = claims(spark, {"service_date": "", "patient_id": "a"}, {"quantity": "x", "patient_id": "b"}, {"patient_id": "c"})
    assert [r.patient_id for r in cleaning.clean_claims(raw).collect()] == ["c"]


def test_currency_rules(spark):
    values = {"1": None, "2": "NAN", "3": "nan", "4": "us", "5": " usd ", "6": "eur"}
    raw = claims(spark, *[{"claim_id": k, "currency": v} for k, v in values.items()])
    found = {r.claim_id: r.currency for r in cleaning.clean_claims(raw).collect()}
    assert found == {"1": "USD", "2": "NAN", "3": "NAN", "4": "USD", "5": "USD", "6": "EUR"}
    assert cleaning.quality_report(raw).first().corrected_currency == 2


def test_missing_names_stay_null_and_text_nan_counts_as_missing(spark):
    raw = claims(spark, {"patient_name": None}, {"claim_id": "c2", "diagnosis_code": "nan"}, {"claim_id": "c3", "service_date": " nan "})
    assert [(r.claim_id, r.patient_name) for r in cleaning.clean_claims(raw).collect()] == [("c1", None)]


def test_number_parsing(spark):
    texts = ["1.5d", "nan", "inf", " 7 ", "1e3", "1_0", "-2", "", None, ".5", "5.", "\t3 "]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(nullable_number(F.col("x")).alias("v"))
    assert [r.v for r in df.collect()] == [None, None, None, 7.0, 1000.0, None, -2.0, None, None, 0.5, 5.0, 3.0]


def test_date_parsing(spark):
    texts = ["2024", "2024-1-5", "2024-02-30", "2024-02-29", "2024-03-01T10:00:00", " 2024-03-02 ", "2024-03-01x", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(parse_date(F.col("x")).alias("v"))
    expected = [None, None, None, datetime.date(2024, 2, 29), datetime.date(2024, 3, 1), datetime.date(2024, 3, 2), None, None]
    assert [r.v for r in df.collect()] == expected


def test_iso8601_of_short_texts(spark):
    texts = ["", " ", "2024", "2024-01-1", " 2024-01-1 ", "2024-01-01T", "2024-01-01T08:30"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(iso8601(F.col("x")).alias("v"))
    assert [r.v for r in df.collect()] == [None] * 6 + ["2024-01-01T08:30:00"]


def test_iso8601(spark):
    cases = {
        "2020-01-02": "2020-01-02T00:00:00", "2020-01-02T03:04:05Z": "2020-01-02T03:04:05Z",
        "2020-01-02 03:04": "2020-01-02T03:04:00", "2020-01-02T03:04:05.5+00:00": "2020-01-02T03:04:05.500000Z",
        "2020-01-02T03:04:05+02:00": "2020-01-02T03:04:05+02:00", "2020-13-02": None, "2020-01-02T25:00:00": None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", iso8601(F.col("x")).alias("v"))
    assert {r.x: r.v for r in df.collect()} == cases


def test_quantity_is_checked_before_truncation(spark):
    raw = claims(spark, *[{"claim_id": q, "quantity": q, "net_amount": "5"} for q in ("0.5", "1.9", "0", "-1")])
    assert {r.claim_id: r.quantity for r in cleaning.clean_claims(raw).collect()} == {"0.5": 0, "1.9": 1}
    out = cleaning.quality_report(raw).first()
    assert out.dropped_non_positive_qty == 2 and out.rows_amount_mismatch == 1


def test_report_adds_up_and_empty_input(spark):
    out = report(spark, {}, {"claim_id": "2", "procedure_code": " "}, {"claim_id": "3", "unit_price": "n/a"}, {"net_amount": "99"})
    drops = sum(v for k, v in out.items() if k.startswith("dropped"))
    assert out["original_rows"] == 4 and out["clean_rows"] == out["original_rows"] - drops
    empty = cleaning.quality_report(claims(spark, {}).limit(0)).first()
    assert empty.original_rows == 0 and empty.clean_rows == 0


def test_explicit_order_decides_first(spark):
    raw = claims(spark, {"patient_id": "a"}, {"patient_id": "b"}).withColumn("line", F.when(F.col("patient_id") == "b", 1).otherwise(2))
    assert cleaning.clean_claims(raw, order_by=["line"]).first().patient_id == "b"


def test_any_blank_drops_missing_and_blank(spark):
    df = spark.createDataFrame([("a", " b "), ("a", " "), ("a", None), (None, "b")], "x string, y string")
    assert rows(cleaning.drop_any_blank(df)) == [("a", "b")]
    assert tuple(cleaning.blank_report(df).first()) == (4, 3, 1)


def test_anti_join_keeps_incoming_copies_and_is_null_safe(spark):
    incoming = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), (None, "a"), ("c", "y"), ("c", "y")], "k string, v string")
    stored = spark.createDataFrame([("a", None), ("b", "z")], "k string, v string")
    assert rows(cleaning.anti_join_existing(incoming, stored)) == rows(incoming.filter("k IS NULL OR k <> 'a'"))
    dated = incoming.withColumn("d", F.lit("2024-01-01").cast("date"))
    assert cleaning.anti_join_existing(dated, dated.limit(0), prune="d").count() == 6


def test_created_is_absent_without_date(spark):
    clean = cleaning.clean_claims(claims(spark, {})).withColumn("service_date", F.lit(None).cast("date"))
    text = cleaning.claims_resource(clean).select(F.to_json("resource").alias("j")).first().j
    assert '"created"' not in text and '"reference":"Patient/p"' in text


def test_ordinals_are_consecutive_with_a_dominant_key(spark):
    df = spark.range(0, 3000, numPartitions=7).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    numbered = row_ordinal(df, ["k"]).collect()
    assert sorted(r.ordinal for r in numbered) == list(range(3000))
    assert [r.k for r in sorted(numbered, key=lambda r: r.ordinal)] == sorted(r.k for r in numbered)


def test_text_follows_python(spark):
    texts = [SPACE_CHARS + "a" + SPACE_CHARS + "b" + SPACE_CHARS, " ", "", "x​y", "\x1ca\x1fb"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", strip(F.col("x")).alias("s"), words(F.col("x")).alias("w"))
    for r in df.collect():
        assert r.s == r.x.strip() and r.w == r.x.split()


def test_slug_and_contains(spark):
    df = spark.createDataFrame([("Hello,  World! " + "z" * 60, "Ring")], "x string, y string")
    assert df.select(slug(F.col("x"))).first()[0] == "hello-world-" + "z" * 28
    assert df.filter(contains_text(" RIN ", [F.col("x"), F.col("y")])).count() == 1
    assert df.filter(contains_text("  ", [F.col("x")])).count() == 1 and df.filter(contains_text("q", [F.col("y")])).count() == 0


def test_dominant_claim_id_shrinks_before_the_shuffle(spark):
    """One id on a third of the rows: the result is whole, and tasks hand on one row per id."""
    base = claims(spark, {}).drop("claim_id", "patient_id")
    ids = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("claim_id"),
        F.format_string("%05d", F.col("id")).alias("patient_id"),
    )
    raw = ids.join(F.broadcast(base.withColumn("k", F.lit(1))), F.lit(1) == F.col("k")).drop("k")
    out = cleaning.clean_claims(raw)
    assert out.count() == 2001 and out.filter("claim_id = 'hot'").first().patient_id == "00000"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")
    assert cleaning.quality_report(raw).first().dropped_duplicate_claims == 999


def test_claims_partitioned_by_order_are_shuffled_no_more(spark, tmp_path):
    """The claims view leaves its rows partitioned by order, in which a claim's rows meet already."""
    from carelake.plans import claims_queries, domain

    made = {
        "customer": "id AS c_custkey, concat('C', id) AS c_name FROM range(5)",
        "supplier": "id AS s_suppkey, concat('S', id) AS s_name FROM range(4)",
        "part": "id AS p_partkey, concat('P', id) AS p_name, 'T' AS p_type, 10.0d + id AS p_retailprice FROM range(6)",
        "orders": "id AS o_orderkey, if(id = 7, NULL, id % 5) AS o_custkey, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority FROM range(40)",
        "lineitem": "id % 40 AS l_orderkey, id % 6 AS l_partkey, id % 4 AS l_suppkey, if(id = 11, NULL, int(id % 3)) AS l_linenumber,"
        " double(id % 5) AS l_quantity, 12.5d AS l_extendedprice, timestamp'2001-02-03' AS l_shipdate FROM range(300)",
    }
    for name, text in made.items():
        spark.sql(f"SELECT {text}").write.parquet(f"{tmp_path}/{name}.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = claims_queries.QUERIES["clean_claims"](spark, str(tmp_path))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # two sides of each of the four joins; none for the claims
    assert plan.count("Exchange hashpartitioning") == 8
    plain = cleaning.clean_claims(domain.run_sql(spark, str(tmp_path), domain.VIEWS["claims"]))
    assert rows(found) == rows(plain) and found.count() > 50


def test_report_counts_claims_without_id_once_in_any_partitioning(spark):
    raw = claims(spark, {"claim_id": "a"}, {"claim_id": None}, {"claim_id": " "}, {"claim_id": "a"})
    parted = raw.withColumn("part", F.coalesce("claim_id", F.lit("2")))
    verdicts = cleaning.merge_unidentified(cleaning.claim_verdicts(parted, ["part"]))
    assert cleaning.report_from_verdicts(verdicts).first() == cleaning.quality_report(raw).first()


def test_stored_rows_are_known_by_digest(spark):
    """One exchange a side; null, empty text, negative zero and NaN compare as Spark compares them."""
    kind = "k string, v double, n int"
    incoming = spark.createDataFrame([("a", 0.0, 1), ("a", -0.0, None), (None, float("nan"), 1), ("", None, 1), ("b", 1.0, 2), ("b", 1.0, 2)], kind)
    stored = spark.createDataFrame([("a", -0.0, 1), (None, float("nan"), 1), (None, None, 1), ("b", 1.5, 2)], kind)
    found = cleaning.anti_join_existing(incoming, stored)
    assert rows(found) == rows(spark.createDataFrame([("a", -0.0, None), ("", None, 1), ("b", 1.0, 2), ("b", 1.0, 2)], kind))
    assert "sha2" in found._jdf.queryExecution().optimizedPlan().toString()
