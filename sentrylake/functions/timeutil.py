"""Interval text and time-bin helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
}


def micros(interval: str) -> int:
    """``"2 minutes"`` -> microseconds. Only fixed-length units."""
    amount, unit = interval.split()
    return int(amount) * _UNIT_MICROS[unit.lower().rstrip("s")]


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def time_bin(time: Column, width_micros: int, shift_micros: int = 0) -> Column:
    """Number of the fixed-width, epoch-aligned bin that holds ``time + shift``."""
    return F.floor((F.unix_micros(time) + F.lit(shift_micros)) / F.lit(width_micros)).cast("bigint")
