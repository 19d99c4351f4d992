"""Event streams and normalised JSON files: one JSON document per record, decoded tolerantly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrylake.schemas import CONN_SCHEMA, IDS_SCHEMA, to_flat
from sentrylake.streaming.eventtime import with_event_time

CORRUPT, ORIGIN = "_corrupt_record", "_origin"


def decode_json(df: DataFrame, schema: T.StructType, value: str = "value", origin: bool = False) -> DataFrame:
    """JSON text -> flat columns plus ``_corrupt_record``.

    A field of the wrong type becomes NULL and the other fields stay; an unreadable document is all NULL. In both
    cases ``_corrupt_record`` holds the text. NULL records (deletions) are dropped. ``origin`` keeps the text and where it
    came from, the other columns of ``df``, as the struct ``_origin``.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kept = [F.struct(*df.columns).alias(ORIGIN)] if origin else []
    rows = df.where(F.col(value).isNotNull()).select(parsed.alias("doc"), *kept)
    return to_flat(rows.select("doc.*", *([ORIGIN] if origin else [])))


def split_quarantine(df: DataFrame, time_col: str = "event_timestamp") -> tuple[DataFrame, DataFrame]:
    """(usable events, quarantined rows). A row without an event time cannot enter a window and is quarantined."""
    good = df.where(F.col(time_col).isNotNull())
    bad = df.where(F.col(time_col).isNull())
    return good.drop(CORRUPT, ORIGIN), bad


def dead_letters(bad: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """Quarantined rows with all that is needed to repair them: ``raw_value``, ``reason``, where and when they came in."""
    broken = F.col(CORRUPT).isNotNull() & F.to_json(F.struct(*[c for c in bad.columns if c not in (CORRUPT, ORIGIN)])).eqNullSafe("{}")
    reason = F.when(broken, "unreadable document").when(F.col(CORRUPT).isNotNull(), f"unreadable {time_col}").otherwise(f"no {time_col}")
    return bad.select(F.col(f"{ORIGIN}.value").alias("raw_value"), reason.alias("reason"), f"{ORIGIN}.source", f"{ORIGIN}.arrived_at")


_PLACE = "concat_ws('/', topic, partition, offset) AS source"


def _records(spark: SparkSession, source: dict[str, str], starting: str) -> DataFrame:
    """(value, source, arrived_at) from a message bus or from a folder of JSON lines."""
    options = dict(source)
    kind = options.pop("format", "text")
    if kind == "kafka":
        reader = spark.readStream.format("kafka").option("startingOffsets", starting).options(**options)
        return reader.load().selectExpr("CAST(value AS STRING) AS value", _PLACE, "timestamp AS arrived_at")
    path, since = options.pop("path"), options.pop("since", None)
    if starting == "latest" and since is None:
        raise ValueError("a folder has no end to start at: give the source 'since', a time that stays the same on restarts")
    lines = spark.readStream.options(**options).text(path).select(
        "value", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_modification_time").alias("arrived_at"))
    return lines.where(F.col("arrived_at") >= F.to_timestamp(F.lit(since))) if starting == "latest" else lines


def _read(spark: SparkSession, source: dict[str, str], schema: T.StructType, starting: str,
          watermark: str | None, idle: str | None) -> DataFrame:
    if starting not in ("earliest", "latest"):
        raise ValueError(starting)
    good, _ = split_quarantine(decode_json(_records(spark, source, starting), schema))
    return with_event_time(good, "event_timestamp", watermark, idle) if watermark else good


def read_conn_stream(
    spark: SparkSession, source: dict[str, str], starting: str = "earliest", watermark: str | None = "30 seconds",
    idle: str | None = None,
) -> DataFrame:
    """Connection events as a stream.

    ``source`` is ``{"format": "kafka", "kafka.bootstrap.servers": ..., "subscribe": ...}`` (needs the connector on
    the class path) or ``{"path": folder}``, with further reader options. ``starting="latest"`` leaves out what was there
    before: on a bus by its offsets, in a folder by the write time of the files, from the source's ``since`` on.
    ``watermark=None`` is the archive scan: an independent reader whose position is its own checkpoint. ``idle`` (such as
    ``"5 seconds"``) lets event time go on while a live input is silent, see
    :func:`sentrylake.streaming.eventtime.with_event_time`.
    """
    return _read(spark, source, CONN_SCHEMA, starting, watermark, idle)


def read_ids_stream(
    spark: SparkSession, source: dict[str, str], starting: str = "earliest", watermark: str | None = "30 seconds",
    idle: str | None = None,
) -> DataFrame:
    """Intrusion alerts as a stream; see :func:`read_conn_stream`."""
    return _read(spark, source, IDS_SCHEMA, starting, watermark, idle)


def quarantined_stream(spark: SparkSession, source: dict[str, str], schema: T.StructType,
                       starting: str = "earliest") -> DataFrame:
    """The records the event streams leave out, for a dead-letter sink of their own; see :func:`dead_letters`."""
    _, bad = split_quarantine(decode_json(_records(spark, source, starting), schema, origin=True))
    return dead_letters(bad)


def read_events_jsonl(
    spark: SparkSession, paths: str | list[str], schema: T.StructType,
) -> tuple[DataFrame, DataFrame]:
    """Normalised JSON lines -> (events, dead letters)."""
    lines = spark.read.text(paths).where(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_modification_time").alias("arrived_at"))
    good, bad = split_quarantine(decode_json(lines, schema, origin=True))
    return good, dead_letters(bad)
