"""Message decoding, log metrics and the newest-entries log as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carelake.operators import analytics, monitoring
from carelake.session import materialise

# How long a window waits for late lines before it is closed and written.
LATENESS = "10 minutes"


def _append(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)


def stream_log_metrics(lines: DataFrame, out: str, checkpoint: str, ts: str = "ts") -> StreamingQuery:
    """Error and health counts per 60 seconds; a window is written once the watermark has passed it."""
    timed = lines.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, LATENESS)
    return _append(monitoring.log_metrics(timed, ts), out, checkpoint)


def stream_log_statistics(lines: DataFrame, out: str, checkpoint: str, ts: str = "ts") -> StreamingQuery:
    """Statistics of JSON log lines per hour and function, closed by the same watermark."""
    timed = lines.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, LATENESS)
    return _append(monitoring.log_statistics(timed, ts), out, checkpoint)


def stream_messages(messages: DataFrame, schema: str, out: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Decoded messages to one table, undeliverable ones to another."""

    def store(batch: DataFrame, batch_id: int) -> None:
        decoded = materialise(monitoring.decode_messages(batch, schema), "decoded")
        decoded.filter(F.col("raw").isNull()).drop("raw").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        decoded.filter(F.col("raw").isNotNull()).drop("fields").write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")

    writer = messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_newest(entries: DataFrame, out: str, checkpoint: str, by: Sequence[str], n: int = 100) -> StreamingQuery:
    """Keep the ``n`` newest entries by the columns ``by``, which should tell all entries apart.

    Each batch is cut to its ``n`` newest, put to those of the batch before and cut again. Batches take turns with two folders, so
    a batch never overwrites what it reads, a repeated batch gives the same rows, and no more than ``2 * n`` rows are stored.
    """
    schema = T.StructType([*entries.schema.fields, T.StructField("batch", T.LongType())])
    slot = lambda batch_id: f"{out}/slot={batch_id % 2}"

    def store(batch: DataFrame, batch_id: int) -> None:
        top = analytics.newest(batch, by, n)
        if batch_id > 0:
            before = batch.sparkSession.read.schema(schema).parquet(slot(batch_id - 1)).drop("batch")
            top = analytics.newest(top.unionByName(before), by, n)
        top.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(slot(batch_id))

    writer = entries.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stored_newest(spark: SparkSession, out: str, by: Sequence[str]) -> DataFrame:
    """The entries ``stream_newest`` kept last, newest first."""
    kept = spark.read.parquet(out)
    last = kept.agg(F.max("batch")).first()[0]  # of two folders
    return analytics.newest(kept.filter(F.col("batch") == last).drop("batch", "slot"), by, None)
