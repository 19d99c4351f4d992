"""Connection logs: one whitespace-separated line per connection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions.net import conn_message, related_ips
from sentrylake.schemas import CONN_FIELDS, flat_name

# Field order of a line, and the markers of a missing value and of an empty list.
FIELDS = (
    "ts", "uid", "orig_h", "orig_p", "resp_h", "resp_p", "proto", "service", "duration", "orig_bytes", "resp_bytes",
    "conn_state", "local_orig", "missed_bytes", "history", "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes",
    "tunnel_parents",
)
NUMERIC = {
    "ts": "decimal(20,6)", "duration": "double", "orig_p": "int", "resp_p": "int", "orig_bytes": "bigint",
    "resp_bytes": "bigint", "missed_bytes": "bigint", "orig_pkts": "bigint", "orig_ip_bytes": "bigint",
    "resp_pkts": "bigint", "resp_ip_bytes": "bigint",
}
MISSING, EMPTY = "-", "(empty)"
TRUE_TEXTS, FALSE_TEXTS = ("T", "true", "True"), ("F", "false", "False")
_BLANKS = " \t\r\n\x0b\x0c"


def _raw(name: str) -> Column:
    return F.col("part")[FIELDS.index(name)]


def _present(name: str) -> Column:
    """The text of a field; NULL for a missing value or an empty list."""
    return F.when(~_raw(name).isin(MISSING, EMPTY), _raw(name))


def _reason() -> Column:
    """Why a line cannot be an event; NULL for a good line."""
    unreadable = F.when(F.size("part") != len(FIELDS), F.lit("field count"))
    for name, kind in NUMERIC.items():
        unreadable = unreadable.when(_present(name).isNotNull() & _present(name).try_cast(kind).isNull(), F.lit(name))
    return unreadable.when(_present("ts").isNull(), F.lit("ts"))


def parse_conn_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Log lines -> (events, rejects). Comments and blank lines are in neither; works on streams too."""
    line = F.btrim(F.col(column), F.lit(_BLANKS))
    kept = lines.select(line.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    # Generating the fields as a row of their own makes Spark split a line once: the conditions on the fields below
    # would otherwise be moved under the projection, with the split repeated in each of them.
    split = kept.select("line", F.explode(F.array(F.split("line", r"\s+"))).alias("part")).withColumn("reason", _reason())
    return _events(split.where(F.col("reason").isNull())), split.where(F.col("reason").isNotNull()).select("line", "reason")


def _events(good: DataFrame) -> DataFrame:
    def number(name: str) -> Column:
        return _present(name).try_cast(NUMERIC[name])

    def counted(name: str) -> Column:
        return F.coalesce(number(name), F.lit(0).cast("bigint"))

    flag = F.when(_raw("local_orig").isin(*TRUE_TEXTS), True).when(_raw("local_orig").isin(*FALSE_TEXTS), False)
    parents = F.when(
        _present("tunnel_parents").isNull() | (_raw("tunnel_parents") == "[]"), F.array().cast("array<string>")
    ).otherwise(F.filter(F.split(_raw("tunnel_parents"), ","), lambda p: p != ""))
    typed = good.select(
        F.timestamp_micros((number("ts") * 1_000_000).cast("bigint")).alias("event_timestamp"),
        F.lit("event").alias("event_kind"), F.array(F.lit("network")).alias("event_category"),
        F.array(F.lit("connection")).alias("event_type"), F.lit("zeek").alias("event_module"),
        F.lit("zeek.conn").alias("event_dataset"),
        _present("orig_h").alias("source_ip"), number("orig_p").alias("source_port"),
        counted("orig_bytes").alias("source_bytes"), counted("orig_pkts").alias("source_packets"),
        _present("resp_h").alias("destination_ip"), number("resp_p").alias("destination_port"),
        counted("resp_bytes").alias("destination_bytes"), counted("resp_pkts").alias("destination_packets"),
        _present("proto").alias("network_transport"), _present("service").alias("network_protocol"),
        (counted("orig_bytes") + counted("resp_bytes")).alias("network_bytes"),
        (counted("orig_pkts") + counted("resp_pkts")).alias("network_packets"),
        F.col("line").alias("event_original"), _present("uid").alias("zeek_conn_uid"),
        _present("service").alias("zeek_conn_service"), number("duration").alias("zeek_conn_duration"),
        _present("conn_state").alias("zeek_conn_state"), _present("history").alias("zeek_conn_history"),
        number("missed_bytes").alias("zeek_conn_missed_bytes"), flag.alias("zeek_conn_local_orig"),
        parents.alias("zeek_conn_tunnel_parents"))
    full = typed.withColumns({"related_ip": related_ips("source_ip", "destination_ip"), "message": conn_message()})
    return full.select([flat_name(name) for name in CONN_FIELDS])


def read_conn_log(
    spark: SparkSession, path: str, limit: int | None = None, glob: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Read connection logs in parallel -> (events, rejects). ``limit`` keeps some N events, in no fixed order."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    events, rejects = parse_conn_lines(reader.text(path))
    return (events.limit(limit) if limit is not None else events), rejects
