"""What running queries did, as a table: rows read, rows that came too late, times of each batch."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = """query string, query_id string, run_id string, batch_id long, started timestamp, input_rows long, late_rows long,
    state_rows long, updated_rows long, batch_ms long, watermark timestamp, newest_event timestamp, event_lag_ms long"""


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class ProgressListener(StreamingQueryListener):
    """Keeps a row for each batch of every query that runs, and appends them to a Parquet folder, ``every`` at a time.

    ``late_rows`` are those that stateful operators dropped for the watermark, as they reached them: of a grouping that Spark
    reduces before the shuffle, groups. ``event_lag_ms`` is the age of the newest event when its batch was written, the time
    from event to visible result of an input read as it happens.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        started, took = _time(p.timestamp), int(p.durationMs.get("triggerExecution", 0))
        newest = _time(p.eventTime.get("max"))
        lag = int((started - newest).total_seconds() * 1000) + took if newest else None
        state = p.stateOperators
        row = (p.name, str(p.id), str(p.runId), p.batchId, started, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in state),
               sum(s.numRowsTotal for s in state), sum(s.numRowsUpdated for s in state), took, _time(p.eventTime.get("watermark")),
               newest, lag)
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        """Write what is held."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


@contextmanager
def progress_to(spark: SparkSession, path: str, every: int = 100) -> Iterator[ProgressListener]:
    """Appends the progress of all queries that run in this block to ``path``; wait for the queries inside it."""
    listener = ProgressListener(spark, path, every)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        # Events arrive after the batch: let those of finished queries come in.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        spark.streams.removeListener(listener)
        listener.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
