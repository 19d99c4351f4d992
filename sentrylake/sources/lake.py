"""Reading the lake table and its file listing."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.schemas import LAKE_SCHEMA


def _is_path(table: str) -> bool:
    return "/" in table


def read_lake(spark: SparkSession, table: str) -> DataFrame:
    """Lake rows from a Parquet folder (a path) or from a catalog table (a name), in declared column order."""
    rows = spark.read.schema(LAKE_SCHEMA).parquet(table) if _is_path(table) else spark.table(table)
    return rows.select(*LAKE_SCHEMA.names)


def lake_files(spark: SparkSession, table: str) -> DataFrame:
    """Data files with format, row count and path.

    A catalog table with metadata tables answers from those. For a Parquet folder Spark counts rows per file, which
    reads no column.
    """
    if not _is_path(table):
        return spark.table(f"{table}.files").select(
            "file_format", "record_count", "file_path", F.col("file_size_in_bytes").alias("file_size"))
    return (
        spark.read.schema(LAKE_SCHEMA).parquet(table)
        .groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
        .agg(F.count("*").alias("record_count"))
        .select(F.lit("PARQUET").alias("file_format"), "record_count", "file_path", "file_size"))


def lake_snapshots(spark: SparkSession, table: str) -> DataFrame:
    """Commits of the table: when, what, and which.

    A Parquet folder keeps no history, but Spark names all files of one write with that write's id: files with the same
    id are one commit, dated by its last file. What it did to older rows is not recorded, so ``operation`` is ``write``.
    """
    if not _is_path(table):
        return spark.table(f"{table}.snapshots").select("committed_at", "operation", "snapshot_id")
    name = F.element_at(F.split("file_path", "/"), -1)
    files = spark.read.schema(LAKE_SCHEMA).parquet(table).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("written"))
    # One row per file first; names look like part-00003-<id of the write>-c000 or .c000.
    per_file = files.groupBy("file_path", "written").agg(F.count("*").alias("n"))
    write = F.regexp_extract(name, r"^part-\d+-([0-9a-fA-F-]{36})", 1)
    return per_file.groupBy(write.alias("snapshot_id")).agg(
        F.max("written").alias("committed_at"), F.lit("write").alias("operation"), F.sum("n").alias("record_count")).select(
        "committed_at", "operation", "snapshot_id", "record_count")


def lake_dates(spark: SparkSession, table: str) -> list[datetime.date | None]:
    """The dates that the table has partitions of, newest first, rows without a date (None) last. Opens no file."""
    if _is_path(table):
        names = spark.read.schema(LAKE_SCHEMA).parquet(table).inputFiles()
    else:
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    values = {found[1] for name in names if (found := re.search(r"event_date=([^/]*)", name))}
    known = sorted((datetime.date.fromisoformat(v) for v in values if v[0].isdigit()), reverse=True)
    return [*known, *([None] if len(known) < len(values) else [])]


def newest_first(
    spark: SparkSession, table: str, n: int, found: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    tie: str = "event_original",
) -> DataFrame:
    """The newest n of the rows that ``found`` keeps, newest first; equal times are ordered by ``tie``.

    Dates are opened from the newest backwards, twice as many each time, until n rows are found: all rows of an older date
    are older, so nothing further back can be among the n, and no tie crosses a date. Rows without a date come last. Counting
    stops at the n-th row; the dates visited are then sorted down to n rows in one pass.
    """
    rows, visited, left, step = read_lake(spark, table), [], lake_dates(spark, table), 1
    held = 0
    while left and held < n:
        dates, left, step = left[:step], left[step:], step * 2
        held += found(rows.where(_on_dates(dates))).limit(n - held).count()
        visited += dates
    kept = found(rows.where(_on_dates(visited))) if visited else found(rows).limit(0)
    return kept.orderBy(F.desc_nulls_last("event_timestamp"), tie).limit(n)


def _on_dates(dates: list[datetime.date | None]) -> Column:
    """On one of a stretch of neighbouring dates of :func:`lake_dates`."""
    known = [d for d in dates if d is not None]
    date = F.col("event_date")
    inside = date.between(F.lit(min(known)), F.lit(max(known))) if known else F.lit(False)
    return inside | date.isNull() if None in dates else inside


def _from_footers(spark: SparkSession, path: str) -> DataFrame:
    """The folder through Spark's second file source, which answers counts by partition from file footers."""
    # Off by default in Spark; it concerns this source alone.
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    name = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(name)
    spark.conf.set(name, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        return spark.read.schema(LAKE_SCHEMA).parquet(path)
    finally:
        spark.conf.set(name, before)


def volume(spark: SparkSession, table: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of each (``event_date``, ``event_dataset``) between two times, both included.

    Dates that lie in the range as a whole are counted from the footers of their files; rows are read of its first and
    last date alone, and of each only the time. Without a range no row is read. Rows without a time count where there is no
    range.
    """
    keys = ["event_date", "event_dataset"]
    whole = _from_footers(spark, table) if _is_path(table) else spark.table(table)
    if start is None and end is None:
        return whole.groupBy(*keys).agg(F.count("*").alias("event_count"))
    lo, hi = (F.lit(x).cast("timestamp") for x in (start or "0001-01-01 00:00:00", end or "9999-12-31 23:59:59.999999"))
    first, last = F.to_date(lo), F.to_date(hi)
    date = F.col("event_date")
    inner = whole.where((date > first) & (date < last)).groupBy(*keys).agg(F.count("*").alias("event_count"))
    edges = read_lake(spark, table).where(
        ((date == first) | (date == last)) & F.col("event_timestamp").between(lo, hi))
    return inner.unionByName(edges.groupBy(*keys).agg(F.count("*").alias("event_count")))
