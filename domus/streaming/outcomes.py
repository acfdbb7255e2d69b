"""I2 stream_outcome_metrics: D7 and D8 for each event-time window, append mode with a watermark.

One aggregate holds for each window the counts of both outcomes and the whole vector of latency buckets. It emits a window
once the watermark (max event time - delay) has passed its end, so the last windows stay open and later events of a
closed window are dropped. Behind it a second state, one for the stream, remembers which window is due: windows without a
single event have no row in the aggregate, and are emitted with zeros when a later window arrives or, by an event-time
timer, when the watermark passes their end. That state sees one row a window, whatever the number of events.

Each window gives two rows, ``ok`` and ``error``; latencies are those of ok events, so an error row has no sum and empty
buckets. Parquet ``ts`` columns read as TIMESTAMP_NTZ; ``withWatermark`` needs TIMESTAMP, so the event time is cast
first (session time zone UTC).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from domus import constants as C
from domus.operators.monitoring import LATENCY_BUCKETS

# functions for Python workers travel by value: executors need no copy of this package for them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

WINDOWS = "start long, width long, n_ok long, n_error long, latency_sum double, buckets array<long>"


def bucket_name(bound: float) -> str:
    """Column of a latency bucket: ``le_0_25`` for 0.25."""
    return f"le_{bound}".replace(".", "_")


def window_vectors(events: DataFrame, window: str, delay: str, buckets: tuple[float, ...]) -> DataFrame:
    """One row for each closed window that has events (``WINDOWS``, times in microseconds)."""
    ev = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    ok = F.coalesce(F.col("event_type") != "error", F.lit(True))

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).cast("long")

    found = ev.groupBy(F.window("ts", window).alias("w")).agg(
        counted(ok).alias("n_ok"), counted(~ok).alias("n_error"),
        F.coalesce(F.sum(F.when(ok, F.col("value"))), F.lit(0.0)).alias("latency_sum"),
        F.array(*[counted(ok & (F.col("value") <= b)) for b in buckets]).alias("buckets"))
    start = F.unix_micros("w.start")
    return found.select(F.lit(0).alias("stream"), F.window_time("w").alias("at"), start.alias("start"), (F.unix_micros("w.end") - start).alias("width"),
                        "n_ok", "n_error", "latency_sum", "buckets")


class EveryWindow(StatefulProcessor):
    """Passes windows on in order and adds the ones without events: those before a window that arrives, and, when a
    timer says that the watermark has passed their end, those behind the last one."""

    def __init__(self, n_buckets: int):
        self.n_buckets = n_buckets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("due", "due long, width long")

    def _emit(self, rows: list[tuple], watermark_ms: int) -> Iterator[pd.DataFrame]:
        due, width = self.state.get() if self.state.exists() else (None, 0)
        out: list[tuple] = []

        def add_empty() -> None:
            nonlocal due
            out.append((due, width, 0, 0, 0.0, [0] * self.n_buckets))
            due += width

        for row in rows:
            while due is not None and due < row[0]:
                add_empty()
            out.append(row)
            due, width = row[0] + row[1], row[1]
        while due is not None and due + width <= watermark_ms * 1000:
            add_empty()
        if due is not None:
            self.state.update((due, width))
            self.handle.registerTimer((due + width) // 1000)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in WINDOWS.split(", ")])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values("start")
        listed = [(int(r.start), int(r.width), int(r.n_ok), int(r.n_error), float(r.latency_sum), [int(b) for b in r.buckets])
                  for r in found.itertuples(index=False)]
        yield from self._emit(listed, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._emit([], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def windowed_outcomes(events: DataFrame, window: str = "1 hour", delay: str = "1 hour",
                      buckets: tuple[float, ...] = LATENCY_BUCKETS) -> DataFrame:
    """window_start, window_end, outcome, n, latency_sum and a column for each bucket (cumulative counts, +Inf is n):
    two rows for every window from the first with an event on."""
    vectors = window_vectors(events, window, delay, buckets)
    every = vectors.groupBy("stream").transformWithStateInPandas(EveryWindow(len(buckets)), WINDOWS, "Append", "EventTime")
    rows = every.withColumn("outcome", F.explode(F.array(*[F.lit(o) for o in C.OUTCOMES])))
    ok = F.col("outcome") == "ok"
    return rows.select(F.timestamp_micros("start").alias("window_start"),
                       F.timestamp_micros(F.col("start") + F.col("width")).alias("window_end"), "outcome",
                       F.when(ok, F.col("n_ok")).otherwise(F.col("n_error")).alias("n"),
                       F.when(ok, F.col("latency_sum")).alias("latency_sum"),
                       *[F.when(ok, F.get("buckets", F.lit(k))).otherwise(0).alias(bucket_name(b)) for k, b in enumerate(buckets)])


def stream_outcome_metrics(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str,
                           file_glob: str = "events.parquet", window: str = "1 hour",
                           delay: str = "1 hour") -> DataFrame:
    """Run the windowed stream over the event files (availableNow) and read the sink back."""
    src = (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", file_glob)
           .parquet(source_dir))
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # the state of the second operator needs it; taken when the query starts
    try:
        q = (windowed_outcomes(src, window, delay).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_path))
        q.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return spark.read.parquet(out_path)
