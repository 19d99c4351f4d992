"""Event time for streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions.timeutil import interval


def with_event_time(
    df: DataFrame, time_col: str = "event_timestamp", delay: str = "30 seconds", idle: str | None = None,
    clock: DataFrame | None = None,
) -> DataFrame:
    """Add ``event_time`` with a watermark that tolerates ``delay`` of disorder.

    Quarantine rows without a time first. Set the watermark here, on the source, before any rule narrows the rows.

    ``idle`` keeps a silent input from holding back the windows it shares with others: a heartbeat advances its event time to
    ``idle`` before the present, so a row may still be ``idle`` and ``delay`` old when it arrives, whatever the other inputs
    do. Only for inputs that are read as they happen. ``clock`` is a stream with the present in its column ``timestamp``, by
    default one row a second; heartbeats reach no result.
    """
    if idle is None:
        return df.withColumn("event_time", F.col(time_col).cast("timestamp")).withWatermark("event_time", delay)
    if clock is None:
        clock = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]
    beats = clock.select(*empty, (F.col("timestamp") - interval(idle)).alias("event_time"), F.lit(True).alias("_beat"))
    rows = df.withColumns({"event_time": F.col(time_col).cast("timestamp"), "_beat": F.lit(False)})
    timed = rows.unionByName(beats).withWatermark("event_time", delay)
    # Stated in terms of the event time, so that Spark does not move it below the watermark; rows without a time go, too.
    kept = F.when(F.col("event_time").isNotNull(), ~F.col("_beat")).otherwise(F.lit(False))
    return timed.where(kept).drop("_beat")


@contextmanager
def watermark_policy(spark: SparkSession, policy: str | None) -> Iterator[None]:
    """How queries with several inputs that start in this block advance time: with their slowest input (``min``) or their
    fastest (``max``).

    ``max`` keeps a silent input from holding back windows, at the price of dropping its rows if it is only late. A query
    keeps its policy when it restarts from its checkpoint.
    """
    if policy not in (None, "min", "max"):
        raise ValueError(policy)
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(name)
    if policy:
        spark.conf.set(name, policy)
    try:
        yield
    finally:
        spark.conf.set(name, before)
