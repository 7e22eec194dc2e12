"""Alarms on live logs: window counts into a state per alarm, with timers for windows that stay away."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from carelake.operators import monitoring
from carelake.session import keyed_state
from carelake.streaming.logs import LATENESS

_WIDTH = monitoring.WINDOW_SECONDS * 1000


class _Series(StatefulProcessor):
    """Every window of an alarm from the first on, in order; the state is the start of the last one told.

    A batch brings the windows that the watermark has passed in it, one row a minute, before timers run. So when the timer of a
    window fires, all earlier windows with lines are told, and those up to the watermark had none.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, missing boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        last = None
        if self.last.exists():
            last = self.last.get()[0]
            self.handle.deleteTimer(last + 2 * _WIDTH)
        for at, breached, missing in sorted((r.at, r.breached, r.missing) for r in rows):
            if last is not None:
                yield from self._silent(key, last, at, missing)
            yield Row(alarm=key[0], at=at, breached=breached, has_data=True)
            last = at
        self._told(last, missing)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        last, missing = self.last.get()
        # the last window that ends by the watermark
        closed = timerValues.getCurrentWatermarkInMs() // _WIDTH * _WIDTH - _WIDTH
        yield from self._silent(key, last, closed + _WIDTH, missing)
        self._told(closed, missing)

    def close(self) -> None:
        pass

    def _silent(self, key, last: int, until: int, missing: bool) -> Iterator[Row]:
        """Windows without lines between the last one told and ``until``."""
        for at in range(last + _WIDTH, until, _WIDTH):
            yield Row(alarm=key[0], at=at, breached=missing, has_data=False)

    def _told(self, last: int, missing: bool) -> None:
        self.last.update((last, missing))
        self.handle.registerTimer(last + 2 * _WIDTH)


def stream_alarms(lines: DataFrame, out: str, checkpoint: str, rules: Mapping[str, tuple[Column, bool]], ts: str = "ts") -> StreamingQuery:
    """State of every closed 60-second window per alarm: ``alarm, window_start, state, has_data``.

    A rule is a condition over ``errors`` and ``health_ok`` and whether a window without lines breaches it. Windows close when the
    watermark passes them; one without lines is told as soon as that happens, not with the next one that has lines. A null
    condition is no breach; lines without a time are in no window.
    """
    timed = lines.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, LATENESS)
    # the window column stays: it carries the watermark
    told = [
        F.struct(F.lit(n).alias("alarm"), F.coalesce(breach, F.lit(False)).alias("breached"), F.lit(missing).alias("missing"))
        for n, (breach, missing) in rules.items()
    ]
    counts = monitoring.window_counts(timed, ts).withColumn("rule", F.explode(F.array(*told)))
    windows = counts.select("window", F.unix_millis("window.start").alias("at"), "rule.*")
    series = windows.groupBy("alarm").transformWithState(
        _Series(), "alarm string, at bigint, breached boolean, has_data boolean", "append", "eventTime"
    )
    state = F.when(F.col("breached"), "ALARM").otherwise("OK").alias("state")
    states = series.select("alarm", F.timestamp_millis("at").alias("window_start"), state, "has_data")
    with keyed_state(lines.sparkSession):
        writer = states.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start(out)
