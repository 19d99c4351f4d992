"""Pre-aggregation for sliding windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.timeutil import micros


def pane_width(window: str, slide: str) -> str:
    """The longest step at which every window of this size and slide begins and ends."""
    return f"{math.gcd(micros(window), micros(slide))} microseconds"


def by_pane(
    df: DataFrame, time_col: str, window: str, slide: str, keys: list[str], sums: dict[str, Column],
    mins: dict[str, Column] | None = None, panes: bool = True, stream_panes: bool = False,
) -> DataFrame:
    """Rows as (time, keys, measures), already summed per pane.

    A sliding window counts each row ``window / slide`` times. Batch rows are first summed per pane, the stretch
    between two window edges, and only the sums are multiplied. A stream keeps its rows unless ``stream_panes`` is set: then
    a tumbling aggregation goes first, whose rows stand for their pane once the watermark has passed it. That is one more
    level of state, worth it where a key repeats within a slide: the copies in the state of the windows are then as many as
    the sums.
    """
    mins = mins or {}
    if not (stream_panes if df.isStreaming else panes):
        return df.select(time_col, *keys, *[c.alias(n) for n, c in {**sums, **mins}.items()])
    pane = F.window(time_col, pane_width(window, slide)).alias("pane")
    summed = df.groupBy(pane, *keys).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()], *[F.min(c).alias(n) for n, c in mins.items()])
    # Any time of the pane falls into the same windows; a stream's must be the one that carries the watermark on.
    time = F.window_time("pane") if df.isStreaming else F.col("pane.start")
    return summed.select(time.alias(time_col), *keys, *sums, *mins)
