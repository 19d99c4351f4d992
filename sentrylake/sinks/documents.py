"""Alert documents, keyed messages, serving rows and result files."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentrylake.schemas import DOTTED, to_dotted

# The key parts of an intrusion alert, and the promoted columns of a serving row.
IDS_KEY = ("rule_id", "event_timestamp", "source_ip", "source_port", "destination_ip", "destination_port")
PROMOTED = (
    "event_timestamp", "event_dataset", "event_module", "event_kind", "event_severity", "source_ip", "destination_ip",
    "rule_id", "rule_name", "network_bytes", "message", "event_original",
)


def document(df: DataFrame) -> Column:
    """The whole row as a JSON document with dotted field names in name order."""
    names = sorted(df.columns, key=lambda c: DOTTED.get(c, c))
    fields = ", ".join(f"`{c}` AS `{DOTTED.get(c, c)}`" for c in names)
    return F.expr(f"to_json(struct({fields}))")


def conn_key() -> Column:
    return F.col("zeek_conn_uid")


def ids_key(columns: tuple[str, ...] = IDS_KEY) -> Column:
    """The parts of an alert's identity joined by bars; a missing part is left out."""
    def part(name: str) -> Column:
        if name != "event_timestamp":
            return F.col(name).cast("string")
        whole = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")
        fraction = F.date_format(name, ".SSSSSS")
        return F.concat(whole, F.when(fraction != ".000000", fraction).otherwise(""), F.lit("+00:00"))

    return F.concat_ws("|", *[part(c) for c in columns])


def with_event_key(df: DataFrame, key: Column) -> DataFrame:
    """Messages (``key``, ``value``) for a bus; rows without a value are not sent."""
    return df.select(key.alias("key"), document(df).alias("value")).where(F.col("value").isNotNull())


def write_alerts(
    alerts: DataFrame, path: str, checkpoint: str | None = None, options: dict[str, str] | None = None,
    trigger: str = "available",
) -> StreamingQuery | None:
    """Alerts as JSON documents: to a bus if ``options`` name one (``{"format": "kafka", ...}``), else to files.

    On a bus alerts are keyed by rule and addresses, so that the few rules do not fill as few partitions.
    """
    options = dict(options or {})
    kind = options.pop("format", "json")
    rows = with_event_key(alerts, F.concat_ws("|", "rule_id", "source_ip", "destination_ip")) if kind == "kafka" else to_dotted(alerts)
    if not alerts.isStreaming:
        writer = rows.write.format(kind).options(**options)
        writer.save() if kind == "kafka" else writer.mode("append").save(path)
        return None
    stream = rows.writeStream.outputMode("append").format(kind).options(**options).option("checkpointLocation", checkpoint)
    timing = {"availableNow": True} if trigger == "available" else {"processingTime": trigger}
    return (stream if kind == "kafka" else stream.option("path", path)).trigger(**timing).start()


def to_serving(df: DataFrame, run_id: str | None = None, id_name: str = "event_id") -> DataFrame:
    """Promoted columns beside the full JSON payload."""
    run = F.lit(run_id) if run_id is not None else F.col("benchmark_id")
    have = set(df.columns)
    promoted = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in PROMOTED]
    return df.select(run.alias("benchmark_id"), F.col(id_name).cast("string").alias(id_name), *promoted,
                     document(df).alias("payload"))


def write_by(df: DataFrame, column: str, path: str, fmt: str = "json") -> None:
    """One folder of files per value of a column."""
    df.withColumn("_split", F.col(column)).hint("rebalance", "_split").write.partitionBy("_split").mode("overwrite") \
        .format(fmt).save(path)


def write_results(df: DataFrame, path: str) -> None:
    """A result table as JSON and as CSV with a header; nested samples appear in JSON only. Both are of one computation."""
    flat = [f.name for f in df.schema if f.dataType.typeName() not in ("array", "struct", "map")]
    own = df.storageLevel == StorageLevel.NONE  # what the caller keeps stays kept
    if own:
        df.persist(StorageLevel.DISK_ONLY)
    try:
        df.write.mode("overwrite").json(f"{path}/json")
        df.select(*flat).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    finally:
        if own:
            df.unpersist()
