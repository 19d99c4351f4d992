"""Row filters of the investigation queries. All are plain predicates, so they reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def time_range(
    df: DataFrame, start: str, end: str, time_col: str = "event_timestamp", date_col: str | None = None,
    run: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows between two times, both included, optionally of one run (``(column, id)``).

    Give ``date_col`` on a date-partitioned table: the same range on the partition column prunes folders.
    """
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    out = df.where(F.col(time_col).between(lo, hi))
    if date_col:
        out = out.where(F.col(date_col).between(F.to_date(lo), F.to_date(hi)))
    if run:
        out = eq_filter(out, run[0], run[1])
    return out


def eq_filter(df: DataFrame, column: str, value: str | int) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def isin_filter(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def ip_pivot(df: DataFrame, ip: str) -> DataFrame:
    """Rows with the address in either role."""
    return df.where((F.col("source_ip") == ip) | (F.col("destination_ip") == ip))


def large_transfers(df: DataFrame, at_least: int = 1000) -> DataFrame:
    return df.where(F.col("network_bytes") >= at_least)


def severity_at_most(df: DataFrame, ceiling: int) -> DataFrame:
    """Severity present and not above the ceiling (1 is the most severe)."""
    return df.where(F.col("event_severity").isNotNull() & (F.col("event_severity") <= ceiling))


def payload_int(payload: str, key: str) -> Column:
    """An integer field of a JSON document; NULL if the key is missing, empty or not a number."""
    value = F.get_json_object(payload, f"$['{key}']")
    return F.nullif(value, F.lit("")).try_cast("int")


def prefix_count(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return count_where(df, F.col(column).startswith(prefix), "row_count")


def count_where(df: DataFrame, condition: Column, name: str = "event_count") -> DataFrame:
    """One-row table with the number of matching rows."""
    return df.where(condition).agg(F.count("*").alias(name))
