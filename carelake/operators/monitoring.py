"""Messages, log metrics, alarms and structured log statistics (batch and streaming alike)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as an error line, and the terms of a health check line.
ERROR_PATTERN = "ERROR|Exception|Traceback|CRITICAL"
HEALTH_TERMS = ["GET", "/health", "200"]
WINDOW_SECONDS = 60
WINDOW = f"{WINDOW_SECONDS} seconds"
LOG_SCHEMA = (
    "timestamp string, level string, logger string, message string, lambda_name string, request_id string,"
    " duration_ms double, status string"
)


def is_json(body: Column) -> Column:
    return F.try_parse_json(body).isNotNull()


def decode_messages(df: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """Message bodies as fields of ``schema``; bodies that are no JSON keep their text in ``raw``."""
    valid = is_json(F.col(body))
    fields = F.from_json(F.when(valid, F.col(body)), schema)
    return df.withColumns({"fields": fields, "raw": F.when(~F.coalesce(valid, F.lit(False)), F.col(body))})


def quarantine(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Undeliverable messages, each once, with how often it was received."""
    bad = df.filter(~F.coalesce(is_json(F.col(body)), F.lit(False)))
    return bad.groupBy(*keys, body).agg(F.count(F.lit(1)).alias("receive_count"))


def notification_fields(df: DataFrame, body: str = "body") -> DataFrame:
    """Subject fields of a completion message with their fallbacks."""
    get = lambda path: F.get_json_object(body, path)
    key = F.coalesce(get("$.key"), F.lit(""))
    return df.withColumns(
        {
            "lambda_name": F.coalesce(get("$.lambda"), F.lit("result")),
            "filename": F.coalesce(F.nullif(get("$.filename"), F.lit("")), F.substring_index(key, "/", -1)),
            "rows": F.coalesce(F.nullif(get("$.rows_written"), F.lit("0")), get("$.quality_report.clean_rows"), F.lit("?")),
            "size_bytes": get("$.size_bytes").try_cast("bigint"),
        }
    )


def is_error_line(message: Column) -> Column:
    return message.rlike(ERROR_PATTERN)


def is_health_line(message: Column) -> Column:
    hit = F.lit(True)
    for term in HEALTH_TERMS:
        hit = hit & F.contains(message, F.lit(term))
    return hit


def window_counts(lines: DataFrame, ts: str = "ts", message: str = "message") -> DataFrame:
    """Error and health-check lines per tumbling 60-second ``window``."""
    return lines.groupBy(F.window(ts, WINDOW)).agg(
        F.count_if(is_error_line(F.col(message))).alias("errors"),
        F.count_if(is_health_line(F.col(message))).alias("health_ok"),
    )


def log_metrics(lines: DataFrame, ts: str = "ts", message: str = "message") -> DataFrame:
    """``window_counts`` by the start of the window."""
    return window_counts(lines, ts, message).select(F.col("window.start").alias("window_start"), "errors", "health_ok")


def alarms(metrics: DataFrame, breach: Column, missing_breaches: bool, start: str = "window_start") -> DataFrame:
    """State of every window between the first and last one, windows without data included.

    The window series is a distributed range; only its two end points pass through the driver.
    """
    spark = metrics.sparkSession
    seconds = F.unix_timestamp(F.col(start).cast("timestamp"))
    low, high = metrics.agg(F.min(seconds), F.max(seconds)).first()
    if low is None:
        return metrics.select(start, F.lit("OK").alias("state"), F.lit(False).alias("has_data"))
    series = spark.range(low, high + 1, 60).select(F.col("id").alias("at"))
    observed = metrics.select(seconds.alias("at"), F.coalesce(breach, F.lit(False)).alias("breached"))
    state = F.coalesce("breached", F.lit(missing_breaches))
    return series.join(observed, "at", "left").select(
        F.timestamp_seconds("at").cast(metrics.schema[start].dataType).alias(start),
        F.when(state, "ALARM").otherwise("OK").alias("state"),
        F.col("breached").isNotNull().alias("has_data"),
    )


def log_statistics(lines: DataFrame, ts: str = "ts", line: str = "line", width: str = "1 hour") -> DataFrame:
    """Calls, durations and errors per function and window from JSON log lines."""
    parsed = lines.select(ts, F.from_json(line, LOG_SCHEMA).alias("log")).filter(F.col("log.lambda_name").isNotNull())
    return (
        parsed.groupBy(F.window(ts, width), F.col("log.lambda_name").alias("lambda_name"))
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.round(F.avg("log.duration_ms"), 4).alias("avg_ms"),
            F.max("log.duration_ms").alias("max_ms"),
            F.count_if(F.col("log.status") == "ERROR").alias("errors"),
        )
        .select(F.col("window.start").alias("window_start"), "lambda_name", "calls", "avg_ms", "max_ms", "errors")
    )
