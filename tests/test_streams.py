"""Streams that keep state between arrivals: alarms with missing windows, the bounded log, stored claims."""

import glob

from conftest import rows
from pyspark.sql import functions as F
from test_cleaning import claims

from carelake.operators import analytics, cleaning, monitoring
from carelake.streaming import alarms, files, logs

LINES = "ts string, message string"


def rules():
    return {"errors": (F.col("errors") > 0, False), "health": (F.col("health_ok") <= 0, True)}


def expected(lines, until):
    """Batch alarms of all windows that end by ``until``."""
    metrics = monitoring.log_metrics(lines.withColumn("ts", F.col("ts").cast("timestamp")))
    out = []
    for name, (breach, missing) in rules().items():
        told = monitoring.alarms(metrics, breach, missing).filter(F.col("window_start") + F.expr("INTERVAL 60 SECONDS") <= F.lit(until).cast("timestamp"))
        out += [(name, *r) for r in told.select("window_start", "state", "has_data").collect()]
    return sorted(out, key=repr)


def test_alarms_tell_every_closed_window_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrivals = [
        [("2024-01-01 00:00:10", "ERROR a"), ("2024-01-01 00:01:05", "GET /health 200"), ("2024-01-01 00:01:59", "x Traceback")],
        # the watermark passes windows 0 to 4; of them 2 to 4 have no lines, and none later has closed
        [("2024-01-01 00:15:30", "INFO"), (None, "ERROR without a time")],
        [("2024-01-01 00:07:00", "ERROR late, but its window is open"), ("2024-01-01 00:40:00", "GET /health 200")],
        [("2024-01-01 01:10:00", "INFO")],
    ]
    seen, last = [], None
    for batch, until in zip(arrivals, [None, "00:05:30", "00:30:00", "01:00:00"], strict=True):
        spark.createDataFrame(batch, LINES).write.mode("append").json(source)
        stream = spark.readStream.schema(LINES).json(source)
        alarms.stream_alarms(stream, out, state, rules()).awaitTermination()
        seen += batch
        told = rows(spark.read.parquet(out).select("alarm", "window_start", "state", "has_data")) if until else []
        if until:
            assert told == expected(spark.createDataFrame(seen, LINES), f"2024-01-01 {until}")
            assert told != last
        last = told
    assert sum(r[0] == "health" and r[2] == "ALARM" and not r[3] for r in last) > 40


def test_the_newest_entries_are_all_that_is_stored(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    by, every = ["at", "id"], []
    for part in ([(5, i) for i in range(30)], [(9, 1), (1, 1)], [(0, 7)], [(7, i) for i in range(12)]):
        every += part
        spark.createDataFrame(part, "at long, id long").write.mode("append").parquet(source)
        logs.stream_newest(spark.readStream.schema("at long, id long").parquet(source), out, state, by, 10).awaitTermination()
        got = [tuple(r) for r in logs.stored_newest(spark, out, by).collect()]
        assert got == sorted(every, reverse=True)[:10]
        assert got == [tuple(r) for r in analytics.newest(spark.createDataFrame(every, "at long, id long"), by, 10).collect()]
        assert spark.read.parquet(out).count() <= 20
    assert len(glob.glob(f"{out}/slot=*")) == 2


def test_an_empty_first_arrival_of_the_log(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    run = lambda: logs.stream_newest(spark.readStream.schema("id long").parquet(source), out, state, ["id"], 3).awaitTermination()
    spark.range(0).write.parquet(source)
    run()
    spark.range(5).write.mode("append").parquet(source)
    run()
    assert [r[0] for r in logs.stored_newest(spark, out, ["id"]).collect()] == [4, 3, 2]


def test_stored_claims_equal_the_batch_after_arrivals_and_restarts(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = [{}, {"claim_id": "2", "priority": None}, {"claim_id": "3", "net_amount": "0"}]
    arrivals = [
        first,
        first + [{"patient_id": "aa"}, {"claim_id": "4"}],
        [{"claim_id": "3", "net_amount": "-0"}, {"claim_id": "4"}, {"claim_id": "2", "priority": "x"}],
    ]
    stored = None
    for batch in arrivals:
        arrived = claims(spark, *batch)
        arrived.write.mode("append").option("header", True).csv(source)
        stream = files.csv_stream(spark, source, cleaning.CLAIM_COLUMNS)
        files.stream_clean_claims(stream, out, state).awaitTermination()
        clean = cleaning.clean_claims(arrived)
        new = clean if stored is None else cleaning.anti_join_existing(clean, stored)
        expected = rows(new) if stored is None else sorted(rows(stored) + rows(new), key=repr)
        stored = spark.createDataFrame(expected, clean.schema)
        assert rows(spark.read.parquet(out).select(*clean.columns)) == expected
    assert stored.count() == 6
    # a repeated batch brings its rows again, in new files
    cleaning.clean_claims(arrived).write.mode("overwrite").parquet(f"{state}/cleaned/batch=2")
    files.stream_clean_claims(files.csv_stream(spark, source, cleaning.CLAIM_COLUMNS), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 6
