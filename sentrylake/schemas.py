"""Declared schemas of the event streams, the alert stream and the lake table.

On the bus every field is one flat key with dots in its name; inside Spark and in the lake the same field is written
with underscores (``source.ip`` -> ``source_ip``) so that expressions need no quoting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
    "array": T.ArrayType(T.StringType()),
}

# The public document schemas (field name, type).
CONN_FIELDS = {
    "@timestamp": "timestamp", "event.kind": "string", "event.category": "array", "event.type": "array",
    "event.module": "string", "event.dataset": "string", "source.ip": "string", "source.port": "int",
    "source.bytes": "bigint", "source.packets": "bigint", "destination.ip": "string", "destination.port": "int",
    "destination.bytes": "bigint", "destination.packets": "bigint", "network.transport": "string",
    "network.protocol": "string", "network.bytes": "bigint", "network.packets": "bigint", "related.ip": "array",
    "message": "string", "event.original": "string", "zeek.conn.uid": "string", "zeek.conn.service": "string",
    "zeek.conn.duration": "double", "zeek.conn.state": "string", "zeek.conn.history": "string",
    "zeek.conn.missed_bytes": "bigint", "zeek.conn.local_orig": "boolean", "zeek.conn.tunnel_parents": "array",
}
IDS_FIELDS = {
    "@timestamp": "timestamp", "event.kind": "string", "event.category": "array", "event.type": "array",
    "event.module": "string", "event.dataset": "string", "event.severity": "int", "rule.id": "string",
    "rule.name": "string", "rule.category": "string", "source.ip": "string", "source.port": "int",
    "destination.ip": "string", "destination.port": "int", "network.transport": "string", "related.ip": "array",
    "message": "string", "event.original": "string", "snort.generator_id": "int", "snort.signature_id": "int",
    "snort.signature_revision": "int", "snort.ip.ttl": "int", "snort.ip.tos": "string", "snort.ip.id": "int",
    "snort.ip.len": "int", "snort.ip.flags": "string", "snort.packet.len": "int", "snort.tcp.flags_raw": "string",
    "snort.tcp.seq": "string", "snort.tcp.ack": "string", "snort.tcp.window": "string", "snort.tcp.len": "int",
    "snort.xref": "string", "log.file.path": "string",
}
ALERT_FIELDS = {
    "@timestamp": "string", "event.kind": "string", "event.category": "array", "event.type": "array",
    "event.module": "string", "event.dataset": "string", "event.severity": "int", "rule.id": "string",
    "rule.name": "string", "rule.category": "string", "source.ip": "string", "destination.ip": "string",
    "destination.port": "int", "network.bytes": "bigint", "alert.reason": "string", "alert.evidence": "string",
    "alert.count": "bigint", "alert.rule_ids": "string", "window.start": "string", "window.end": "string",
    "related.ip": "array", "pipeline": "string", "message": "string",
    "zeek.scan.unique_destination_ports": "bigint", "zeek.scan.unique_destination_ips": "bigint",
    "zeek.volume.direction": "string", "zeek.volume.total_bytes": "bigint", "zeek.connection.count": "bigint",
    "correlation.type": "string",
}
# Column order of the lake table; the types come from the two event schemas.
LAKE_ORDER = """
    event_timestamp event_date event_kind event_category event_type event_module event_dataset event_severity message
    event_original source_ip source_port source_bytes source_packets destination_ip destination_port destination_bytes
    destination_packets related_ip network_transport network_protocol network_bytes network_packets rule_id rule_name
    rule_category zeek_conn_uid zeek_conn_service zeek_conn_duration zeek_conn_state zeek_conn_history
    zeek_conn_missed_bytes zeek_conn_local_orig zeek_conn_tunnel_parents snort_generator_id snort_signature_id
    snort_signature_revision snort_ip_ttl snort_ip_tos snort_ip_id snort_ip_len snort_ip_flags snort_packet_len
    snort_tcp_flags_raw snort_tcp_seq snort_tcp_ack snort_tcp_window snort_tcp_len snort_xref log_file_path
""".split()


def flat_name(dotted: str) -> str:
    return "event_timestamp" if dotted == "@timestamp" else dotted.replace(".", "_")


# Both directions of the renaming; extra names are fields that exist only in derived documents.
_EXTRA = ["event.id", "benchmark.id", "benchmark.size", "benchmark.cycle", "benchmark.seq"]
DOTTED = {flat_name(n): n for n in [*CONN_FIELDS, *IDS_FIELDS, *ALERT_FIELDS, *_EXTRA]}


def dotted_schema(fields: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


def flat_schema(fields: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(flat_name(name), _TYPES[kind]) for name, kind in fields.items()])


def _lake_schema() -> T.StructType:
    kinds = {flat_name(n): k for n, k in {**CONN_FIELDS, **IDS_FIELDS}.items()} | {"event_date": "date"}
    return T.StructType([T.StructField(name, _TYPES[kinds[name]]) for name in LAKE_ORDER])


CONN_SCHEMA = dotted_schema(CONN_FIELDS)
IDS_SCHEMA = dotted_schema(IDS_FIELDS)
ALERT_SCHEMA = flat_schema(ALERT_FIELDS)
LAKE_SCHEMA = _lake_schema()


def to_flat(df: DataFrame) -> DataFrame:
    """Dotted field names -> underscore column names."""
    return df.selectExpr(*[f"`{c}` AS {flat_name(c)}" for c in df.columns])


def to_dotted(df: DataFrame) -> DataFrame:
    """Underscore column names -> dotted field names, as documents carry them."""
    return df.selectExpr(*[f"`{c}` AS `{DOTTED.get(c, c)}`" for c in df.columns])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: cast what exists, pad what is missing with a typed NULL."""
    have = set(df.columns)
    return df.selectExpr(*[
        f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema])


def with_event_date(df: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """Partition date of the lake table."""
    return df.withColumn("event_date", F.to_date(time_col))


def union_events(conns: DataFrame, ids: DataFrame) -> DataFrame:
    """Both event streams as lake rows (UNION ALL)."""
    return align(with_event_date(conns), LAKE_SCHEMA).unionByName(align(with_event_date(ids), LAKE_SCHEMA))
