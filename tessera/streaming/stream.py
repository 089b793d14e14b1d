"""Structured Streaming over the landing folder (SS-1..3, windowed rollup).

* SS-1: the landing folder is an append-only change stream; the checkpoint
  keeps the offset (which files were consumed), so a restart or redeploy
  resumes instead of re-reading history.
* SS-2: ``trigger(availableNow=True)`` processes whatever is new and stops; a
  run with nothing new processes no batch at all.
* SS-3: ``foreachBatch`` runs the keyed upsert on each micro-batch. The
  checkpoint says which rows are new, so no watermark of the tables is asked
  and rows may come in any order; a batch that is repeated, under its own or
  another batch id, leaves the tables unchanged.

Event time of the landing is TIMESTAMP_NTZ; a watermark needs TIMESTAMP, so
stream helpers derive an instant column in UTC first.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tessera.functions.scalar import utc_wall
from tessera.operators import incremental as I


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """SS-1: a stream over a landing folder or glob (not a bare file path)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def with_event_time(df: DataFrame, ntz_col: str, out_col: str = "event_time") -> DataFrame:
    """NTZ wall time (UTC) -> TIMESTAMP instant usable by ``withWatermark``."""
    # the cast reads the wall time in the session's zone; shifting it there first makes it UTC's
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(ntz_col))
    return df.withColumn(out_col, local.cast("timestamp"))


class _RowCount(StreamingQueryListener):
    """Adds up the input rows of all batches of one query run."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        with self.changed:
            run = str(event.progress.runId)
            self.rows[run] = self.rows.get(run, 0) + int(event.progress.numInputRows)

    def onQueryTerminated(self, event):
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, run: str, seconds: float = 60.0) -> int:
        with self.changed:
            self.changed.wait_for(lambda: run in self.ended, seconds)
            return self.rows.get(run, 0)


def run_available_now(stream_df: DataFrame, checkpoint: str,
                      batch_fn: Callable[[DataFrame, int], None] | None = None,
                      sink_path: str | None = None, output_mode: str = "append",
                      partition_by: Sequence[str] = ()) -> int:
    """SS-2: drain what is new, then stop. Returns the number of input rows read."""
    w = stream_df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if batch_fn is not None:
        w = w.foreachBatch(batch_fn).outputMode(output_mode)
    else:
        w = w.format("parquet").option("path", sink_path).outputMode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
    streams = stream_df.sparkSession.streams
    counted = _RowCount()
    streams.addListener(counted)
    try:
        q = w.start()
        q.awaitTermination()
        return counted.of(str(q.runId))
    finally:
        streams.removeListener(counted)


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], event_col: str, delay: str) -> DataFrame:
    """Drop repeats of ``keys`` arriving within ``delay`` of each other (bounded state)."""
    return df.withWatermark(event_col, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_daily(df: DataFrame, key: str, event_col: str, value_col: str, delay: str) -> DataFrame:
    """1-day tumbling windows per key with a late-data watermark (update mode).

    Rows later than ``delay`` behind the max event time are dropped; their
    windows' state has been evicted. Sums are exact decimals.
    """
    v = F.col(value_col).cast("decimal(20,8)")
    return (df.withWatermark(event_col, delay)
            .groupBy(F.window(event_col, "1 day").alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum(v).alias("sum_value"), F.max(v).alias("max_value"))
            .select(key, utc_wall("w.start").cast("date").alias("day"), "n_events", "sum_value", "max_value"))


def upsert_batches(spark: SparkSession, target: str, keys: Sequence[str], partition_col: str
                   ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts each batch's rows by key.

    What it does depends on the rows alone, not on the batch id, so a repeated
    batch, also one of a fresh checkpoint, is simply applied.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        I.upsert(spark, batch, target, keys, partition_col)
    return fn
