"""Registered queries: log parsing, decoding, lake and serving tables. Raw inputs are rendered from the events table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions.net import with_internal_flags
from sentrylake.operators.aggregates import count_by, lake_counts
from sentrylake.operators.detections import detect_protocol_anomaly
from sentrylake.operators.filters import ip_pivot
from sentrylake.operators.joins import count_delta
from sentrylake.operators.search import match_all
from sentrylake.plans import adapter as a
from sentrylake.plans.detect import ORACLES as RULE_SQL
from sentrylake.plans.detect import RULES
from sentrylake.schemas import ALERT_FIELDS, CONN_FIELDS, CONN_SCHEMA, IDS_FIELDS, dotted_schema, flat_name, to_dotted, to_flat, union_events
from sentrylake.session import shared_dir
from sentrylake.sinks.documents import (
    conn_key, document, ids_key, to_serving, with_event_key, write_alerts, write_by, write_results)
from sentrylake.sinks.lake import overwrite_run, upsert, write_lake
from sentrylake.sources.conn_log import read_conn_log
from sentrylake.sources.ids_blocks import read_ids_blocks
from sentrylake.sources.lake import lake_files, lake_snapshots, newest_first, read_lake, volume
from sentrylake.sources.streams import read_conn_stream, read_events_jsonl, read_ids_stream, split_quarantine
from sentrylake.streaming.run import drain

Query = Callable[[SparkSession, str], DataFrame]


def _text(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("-"))


def _conn_lines(spark: SparkSession, sf_dir: str) -> str:
    """Connection-log files; a line has an unreadable port where k is 13."""
    c = a.conns(spark, sf_dir)
    port = F.when(F.col("k") == 13, "n/a").otherwise(F.col("destination_port").cast("string"))
    epoch = (F.unix_micros("event_timestamp") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(16,6)")
    parents = F.when(F.col("k") % 7 == 0, "(empty)").when(F.col("k") % 7 == 1, "p1,p2").otherwise("-")
    fields = [
        epoch, "zeek_conn_uid", "source_ip", "source_port", "destination_ip", port, "network_transport", "network_protocol",
        "value", "source_bytes", "destination_bytes", F.lit("SF"), F.when(F.col("k") % 2 == 0, "T").otherwise("F"), F.lit(0),
        F.lit("ShADfFa"), F.col("k"), F.lit(40), F.lit(None), F.lit(40), parents,
    ]
    lines = c.select(F.concat_ws("\t", *[_text(f) for f in fields]))
    return a.derived(spark, sf_dir, "conn-log", lambda path: lines.write.text(path))


def _parse_conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _ = read_conn_log(spark, _conn_lines(spark, sf_dir))
    return a.flat_arrays(a.iso_text(events.select(
        "event_timestamp", "zeek_conn_uid", "source_ip", "source_port", "destination_ip", "destination_port",
        "network_transport", "network_protocol", "zeek_conn_duration", "network_bytes", "source_packets", "network_packets",
        "zeek_conn_local_orig", "zeek_conn_tunnel_parents", "related_ip", "message"), "event_timestamp"))


def _conn_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = read_conn_log(spark, _conn_lines(spark, sf_dir))
    return count_by(rejects, "reason", name="line_count")


def _ids_blocks(spark: SparkSession, sf_dir: str) -> str:
    """Alert-block files. No class line where k is a multiple of 7; no ports (and so no time) where k is 13."""
    i = a.ids(spark, sf_dir)
    has_class, no_ports, tcp = F.col("k") % 7 != 0, F.col("k") == 13, F.col("network_transport") == "tcp"
    port = F.when(no_ports, "").otherwise(F.concat(F.lit(":"), F.col("destination_port").cast("string")))
    source_port = F.when(no_ports, "").otherwise(F.concat(F.lit(":"), F.col("source_port").cast("string")))
    lines = F.array_compact(F.array(
        F.concat(F.lit("[**] ["), "rule_id", F.lit("] event "), F.col("event_id").cast("string"), F.lit(" [**]")),
        F.when(has_class, F.concat(F.lit("[Classification: Misc activity] [Priority: "),
                                   F.col("event_severity").cast("string"), F.lit("] "))),
        F.concat(F.date_format("event_timestamp", "MM/dd-HH:mm:ss.SSSSSS"), F.lit(" "), "source_ip", source_port,
                 F.lit(" -> "), "destination_ip", port),
        F.concat(F.upper("network_transport"), F.lit(" TTL:64 TOS:0x0 ID:"), F.col("k").cast("string"),
                 F.lit(" IpLen:20 DgmLen:60 DF")),
        F.when(tcp, F.lit("***AP*** Seq: 0x1  Ack: 0x2  Win: 0x2000  TcpLen: 20")),
        F.lit("[Xref => url,first.example]"), F.lit("[Xref => url,last.example]")))
    # The writer ends each record with a line feed, so this leaves one blank line between blocks.
    blocks = i.select(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return a.derived(spark, sf_dir, "ids-blocks", lambda path: blocks.write.text(path))


def _parse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _ = read_ids_blocks(spark, _ids_blocks(spark, sf_dir), year=2024, newline="\n")
    good, _ = split_quarantine(events)
    return a.flat_arrays(a.iso_text(good.select(
        "event_timestamp", "rule_id", "rule_name", "rule_category", "event_severity", "source_ip", "source_port",
        "destination_ip", "destination_port", "network_transport", "snort_signature_id", "snort_ip_id", "snort_ip_flags",
        "snort_tcp_len", "snort_xref", "related_ip"), "event_timestamp"))


def _parse_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same blocks with carriage returns, parted by lines that hold blanks, read in splits that cut through blocks."""
    text = spark.read.text(_ids_blocks(spark, sf_dir)).select(F.when(F.col("value") == "", " \t ").otherwise(F.col("value")).alias("value"))
    path = a.derived(spark, sf_dir, "loose-blocks", lambda p: text.write.option("lineSep", "\r\n").text(p))
    events, _ = read_ids_blocks(spark, path, year=2024)
    return events.where("event_timestamp IS NOT NULL").select(
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("event_timestamp"), "rule_id", "rule_name", "rule_category",
        "source_ip", "destination_port", "snort_tcp_len", "snort_xref")


def _ids_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _ = read_ids_blocks(spark, _ids_blocks(spark, sf_dir), year=2024, newline="\n")
    _, bad = split_quarantine(events)
    return bad.select("rule_id", "rule_name", "event_severity")


def _documents(spark: SparkSession, sf_dir: str) -> str:
    """Connection documents as JSON lines; cut short where k is 13, with a port of the wrong type where k is 14."""
    c = a.conns(spark, sf_dir)
    doc = document(c.select([n for n in map(flat_name, CONN_FIELDS) if n in c.columns]))
    odd = F.regexp_replace(doc, '"destination.port":[0-9]+', '"destination.port":"odd"')
    broken = F.when(F.col("k") == 13, F.substring(doc, 1, 40)).when(F.col("k") == 14, odd).otherwise(doc)
    lines = c.select(broken.alias("value"))
    return a.derived(spark, sf_dir, "documents", lambda path: lines.write.text(path))


def _decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = read_events_jsonl(spark, _documents(spark, sf_dir), CONN_SCHEMA)
    return a.iso_text(good.select("event_timestamp", "zeek_conn_uid", "source_ip", "destination_port", "network_bytes",
                                  "message"), "event_timestamp")


def _json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the documents, and of one without a time for each event with k = 15."""
    timeless = a.conns(spark, sf_dir).where("k = 15").select(F.format_string('{"source.ip":"%s"}', "source_ip").alias("value"))
    path = a.derived(spark, sf_dir, "timeless", lambda p: timeless.write.text(p))
    _, bad = read_events_jsonl(spark, [_documents(spark, sf_dir), path], CONN_SCHEMA)
    return bad.select("raw_value", "reason", F.col("source").rlike("/part-").alias("from_file"), F.col("arrived_at").isNotNull().alias("dated"))


def _stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive scan: the same documents through the stream reader, without a watermark."""
    stream = read_conn_stream(spark, {"path": _documents(spark, sf_dir)}, watermark=None)
    folder = shared_dir(spark, "archive")
    rows = stream.select("event_timestamp", "zeek_conn_uid", "network_bytes")
    return a.iso_text(drain(rows, f"{folder}/out", f"{folder}/checkpoint"), "event_timestamp")


def _stream_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intrusion-alert documents through their stream reader."""
    i = a.ids(spark, sf_dir)
    doc = document(i.select([n for n in map(flat_name, IDS_FIELDS) if n in i.columns])).alias("value")
    path = a.derived(spark, sf_dir, "ids-documents", lambda p: i.select(doc).write.text(p))
    stream = read_ids_stream(spark, {"path": path}, watermark=None)
    folder = shared_dir(spark, "ids-stream")
    rows = stream.select("event_timestamp", "rule_id", "event_severity", "source_ip", "destination_port")
    return a.iso_text(drain(rows, f"{folder}/out", f"{folder}/checkpoint"), "event_timestamp")


def _stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is stopped, gets more documents and goes on from its checkpoint."""
    folder, c = shared_dir(spark, "restart"), a.conns(spark, sf_dir)
    doc = document(c.select([n for n in map(flat_name, CONN_FIELDS) if n in c.columns])).alias("value")
    found = None
    for part in ("k < 40", "k >= 40"):
        c.where(part).select(doc).write.mode("append").text(f"{folder}/in")
        stream = read_conn_stream(spark, {"path": f"{folder}/in"}, watermark=None)
        found = drain(stream.select("event_timestamp", "zeek_conn_uid"), f"{folder}/out", f"{folder}/checkpoint")
    return a.iso_text(found, "event_timestamp")


def _ids_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert blocks of the files that match a pattern, each with its file; other files in the folder are left alone."""
    blocks, i = shared_dir(spark, "glob"), a.ids(spark, sf_dir)
    i.select(F.format_string("[**] [%s] event %d [**]\n%s %s:1 -> %s:2\nTCP TTL:1 TOS:0x0 ID:1 IpLen:20 DgmLen:60\n", "rule_id", "event_id",
                             F.date_format("event_timestamp", "MM/dd-HH:mm:ss.SSSSSS"), "source_ip", "destination_ip")).write.text(blocks)
    a.table(spark, sf_dir, "region").select("r_name").write.mode("append").csv(blocks)
    events, _ = read_ids_blocks(spark, blocks, year=2024, glob="*.txt")
    return events.select("rule_name", F.col("log_file_path").rlike(r"/part-.*\.txt$").alias("from_text_file"))


def _ingest_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events a limited ingest takes from either log."""
    conns, _ = read_conn_log(spark, _conn_lines(spark, sf_dir), limit=100)
    ids, _ = read_ids_blocks(spark, _ids_blocks(spark, sf_dir), year=2024, newline="\n", limit=10)
    both = conns.select(F.lit(1).alias("conn"), F.lit(0).alias("ids")).unionByName(ids.select(F.lit(0).alias("conn"), F.lit(1).alias("ids")))
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"{c}_count") for c in ("conn", "ids")])


def _internal_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections and bytes by whether either side is internal."""
    flagged = with_internal_flags(a.conns(spark, sf_dir))
    return flagged.groupBy("source_is_internal", "destination_is_internal").agg(
        F.count("*").alias("event_count"), F.sum("network_bytes").alias("network_bytes"))


def _lake(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "lake")
    write_lake(union_events(a.conns(spark, sf_dir), a.ids(spark, sf_dir)), path)
    return path


def _lake_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = lake_counts(read_lake(spark, _lake(spark, sf_dir)))
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


def _lake_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by date between two times: from footers, but for the first and the last date."""
    counts = volume(spark, _lake(spark, sf_dir), "2024-01-05 06:00:00", "2024-01-20 17:30:00")
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


def _latest_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows of the lake, its dates read from the newest backwards."""
    found = newest_first(spark, _lake(spark, sf_dir), 25, tie="zeek_conn_uid")
    return a.iso_text(found.select("event_timestamp", "source_ip", "destination_port"), "event_timestamp")


def _search_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest hits of a search that only few rows of a date pass."""
    found = newest_first(spark, _lake(spark, sf_dir), 40, lambda df: match_all(df, ["message"], "udp ssl 8080"), "zeek_conn_uid")
    return a.iso_text(found.select("event_timestamp", "message"), "event_timestamp")


def _pivot_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address pivot in a lake that is clustered by both addresses."""
    path = shared_dir(spark, "clustered")
    write_lake(a.corpus(spark, sf_dir), path, cluster_by=["source_ip", "destination_ip"])
    found = ip_pivot(read_lake(spark, path), "192.168.0.8")
    return a.iso_text(found.select("event_timestamp", "event_dataset", "source_ip", "destination_ip"), "event_timestamp")


def _stream_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "stream-lake")
    rows = union_events(a.conn_stream(spark, sf_dir), a.ids_stream(spark, sf_dir))
    write_lake(rows, f"{folder}/lake", f"{folder}/checkpoint").awaitTermination()
    counts = lake_counts(read_lake(spark, f"{folder}/lake"))
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


def _lake_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.regexp_extract("file_path", "event_date=([0-9-]+)", 1)
    return lake_files(spark, _lake(spark, sf_dir)).groupBy("file_format", date.alias("event_date")).agg(
        F.sum("record_count").alias("record_count"))


def _lake_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second of the intrusion alerts alone: two commits."""
    path = _lake(spark, sf_dir)
    write_lake(a.ids(spark, sf_dir), path)
    return lake_snapshots(spark, path).select("operation", "record_count")


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = union_events(a.conns(spark, sf_dir), a.ids(spark, sf_dir))
    return a.flat_arrays(a.iso_text(rows.select(
        "event_timestamp", F.col("event_date").cast("string").alias("event_date"), "event_dataset", "event_severity",
        "source_ip", "source_bytes", "network_protocol", "rule_id", "zeek_conn_uid", "snort_xref", "related_ip"),
        "event_timestamp"))


def _alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "alerts")
    write_alerts(detect_protocol_anomaly(a.conns(spark, sf_dir), RULES.protocol_anomaly), path)
    return a.flat_arrays(to_flat(spark.read.schema(dotted_schema(ALERT_FIELDS)).json(path)))


def _serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_serving(a.corpus(spark, sf_dir).drop("k", "user_id", "kind", "value"))
    keep = ["benchmark_id", "event_id", "event_dataset", "event_severity", "source_ip", "rule_id", "network_bytes", "message"]
    return rows.select(*keep, F.get_json_object("payload", "$['destination.port']").alias("payload_port"),
                       F.get_json_object("payload", "$['event.id']").alias("payload_id"))


def _event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    conns = with_event_key(a.conns(spark, sf_dir), conn_key())
    ids = with_event_key(a.ids(spark, sf_dir), ids_key())
    return conns.unionByName(ids).select("key", F.get_json_object("value", "$['source.ip']").alias("source_ip"))


def _overwrite_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "runs")
    rows = to_serving(a.corpus(spark, sf_dir))
    overwrite_run(rows, path)
    overwrite_run(rows.withColumn("benchmark_id", F.lit("run-2")), path)
    overwrite_run(rows.where(F.col("event_dataset") == "zeek.conn"), path)
    return count_by(spark.read.parquet(path), "benchmark_id")


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of every event; then corrections of the intrusion alerts, of which those with an even k are older."""
    path = shared_dir(spark, "documents-by-id")
    old = a.corpus(spark, sf_dir).select("event_id", "event_dataset", "event_timestamp", "network_bytes", "k")
    late = F.when(F.col("k") % 2 == 0, -1).otherwise(1)
    new = old.where(F.col("event_dataset") == "snort.alert").withColumns({
        "network_bytes": F.lit(0).cast("bigint"), "event_timestamp": F.col("event_timestamp") + F.make_dt_interval(days=late)})
    for delivery in (old, old, new):
        upsert(delivery, ["event_id"], "event_timestamp", path=path, partition_by=["event_dataset"])
    stored = spark.read.schema(old.schema).parquet(path).select("event_id", "event_dataset", "event_timestamp", "network_bytes")
    return a.iso_text(stored, "event_timestamp")


def _upsert_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day; then corrections that move every alert a day on, into another partition."""
    path = shared_dir(spark, "documents-by-day")
    old = a.corpus(spark, sf_dir).select(
        "event_id", F.to_date("event_timestamp").cast("string").alias("day"), F.lit(1).alias("version"), "event_dataset")
    new = old.where(F.col("event_dataset") == "snort.alert").withColumns({
        "day": F.date_add("day", 1).cast("string"), "version": F.lit(2)})
    for delivery in (old, new):
        upsert(delivery, ["event_id"], "version", path=path, partition_by=["day"])
    return spark.read.schema(old.schema).parquet(path).select("event_id", "day", "version")


def _write_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "by-dataset")
    write_by(to_dotted(a.corpus(spark, sf_dir)).withColumnRenamed("event.dataset", "dataset"), "dataset", path)
    schema = "dataset string, `event.id` bigint, _split string"
    return count_by(spark.read.schema(schema).json(path), "_split")


def _write_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "results")
    counts = count_by(a.corpus(spark, sf_dir), "source_ip")
    write_results(counts, path)
    csv = spark.read.option("header", True).schema("source_ip string, event_count bigint").csv(f"{path}/csv")
    json = spark.read.schema("source_ip string, event_count bigint").json(f"{path}/json")
    return csv.join(json.withColumnRenamed("event_count", "json_count"), "source_ip")


def _count_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth by dataset and protocol; some protocols are NULL."""
    rows = a.corpus(spark, sf_dir)
    before = rows.where((F.col("event_dataset") == "zeek.conn") & (F.col("k") < 50))
    return count_delta(before, rows, ["event_dataset", "network_protocol"], 2)


QUERIES: dict[str, Query] = {
    "parse_conn_log": _parse_conn,
    "conn_log_rejects": _conn_rejects,
    "parse_ids_blocks": _parse_ids,
    "parse_ids_blocks_loose": _parse_loose,
    "ids_quarantine": _ids_quarantine,
    "decode_json": _decode_json,
    "json_quarantine": _json_quarantine,
    "stream_archive_scan": _stream_scan,
    "stream_ids": _stream_ids,
    "stream_restart": _stream_restart,
    "ids_provenance": _ids_provenance,
    "ingest_limit": _ingest_limit,
    "lake_counts": _lake_counts,
    "lake_volume": _lake_volume,
    "latest_events_by_date": _latest_by_date,
    "message_search_by_date": _search_by_date,
    "ip_pivot_clustered": _pivot_clustered,
    "stream_lake": _stream_lake,
    "lake_files": _lake_files,
    "lake_snapshots": _lake_snapshots,
    "union_events": _union,
    "internal_flags": _internal_flags,
    "alert_documents": _alert_documents,
    "serving_rows": _serving,
    "event_keys": _event_keys,
    "overwrite_run": _overwrite_run,
    "upsert": _upsert,
    "upsert_moved": _upsert_moved,
    "write_by_dataset": _write_by,
    "write_results": _write_results,
    "count_delta": _count_delta,
}

_LAKE = """lake AS (
  SELECT CAST(event_time AS DATE) AS d, 'zeek.conn' AS event_dataset FROM conn
  UNION ALL SELECT CAST(event_time AS DATE), 'snort.alert' FROM ids)"""
_LAKE_COUNTS = a.sql("SELECT strftime(d, '%Y-%m-%d') AS event_date, event_dataset, count(*) AS event_count FROM lake "
                     "GROUP BY 1, 2", _LAKE)
_DATASET = "CASE WHEN event_type = 'error' THEN 'snort.alert' ELSE 'zeek.conn' END"
_STAMP = f"strftime(event_time, {a.ISO})"
_INTERNAL = r"regexp_matches({}, '^(10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)')"

ORACLES: dict[str, str] = {
    "parse_conn_log": a.sql(f"""
      SELECT {_STAMP} AS event_timestamp, zeek_conn_uid, source_ip, source_port, destination_ip, destination_port,
        network_transport, network_protocol, value AS zeek_conn_duration, network_bytes, CAST(k AS BIGINT) AS source_packets,
        CAST(k AS BIGINT) AS network_packets, k % 2 = 0 AS zeek_conn_local_orig,
        CASE WHEN k % 7 = 1 THEN 'p1,p2' ELSE '' END AS zeek_conn_tunnel_parents,
        source_ip || ',' || destination_ip AS related_ip, message
      FROM conn WHERE k <> 13"""),
    "conn_log_rejects": a.sql("SELECT 'resp_p' AS reason, count(*) AS line_count FROM conn WHERE k = 13"),
    "parse_ids_blocks": a.sql(f"""
      SELECT {_STAMP} AS event_timestamp, rule_id, 'event ' || event_id AS rule_name,
        CASE WHEN k % 7 <> 0 THEN 'Misc activity' END AS rule_category, CASE WHEN k % 7 <> 0 THEN event_severity END AS event_severity,
        source_ip, source_port, destination_ip, destination_port, network_transport, k AS snort_signature_id, k AS snort_ip_id,
        'DF' AS snort_ip_flags, CASE WHEN network_transport = 'tcp' THEN 20 END AS snort_tcp_len,
        'url,last.example' AS snort_xref, source_ip || ',' || destination_ip AS related_ip
      FROM ids WHERE k <> 13"""),
    "parse_ids_blocks_loose": a.sql(f"""
      SELECT {_STAMP} AS event_timestamp, rule_id, 'event ' || event_id AS rule_name,
        CASE WHEN k % 7 <> 0 THEN 'Misc activity' END AS rule_category, source_ip, destination_port,
        CASE WHEN network_transport = 'tcp' THEN 20 END AS snort_tcp_len, 'url,last.example' AS snort_xref
      FROM ids WHERE k <> 13"""),
    "ids_quarantine": a.sql("SELECT rule_id, 'event ' || event_id AS rule_name, event_severity FROM ids WHERE k = 13"),
    "decode_json": a.sql(f"""
      SELECT {_STAMP} AS event_timestamp, zeek_conn_uid, source_ip,
        CASE WHEN k <> 14 THEN destination_port END AS destination_port, network_bytes, message FROM conn WHERE k <> 13"""),
    "json_quarantine": a.sql(f"""
      SELECT substr('{{"@timestamp":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","event.kind":"event"', 1, 40) AS raw_value,
        'unreadable document' AS reason, true AS from_file, true AS dated FROM conn WHERE k = 13
      UNION ALL SELECT '{{"source.ip":"' || source_ip || '"}}', 'no event_timestamp', true, true FROM conn WHERE k = 15"""),
    "stream_archive_scan": a.sql(f"SELECT {_STAMP} AS event_timestamp, zeek_conn_uid, network_bytes FROM conn WHERE k <> 13"),
    "stream_ids": a.sql(f"SELECT {_STAMP} AS event_timestamp, rule_id, event_severity, source_ip, destination_port FROM ids"),
    "stream_restart": a.sql(f"SELECT {_STAMP} AS event_timestamp, zeek_conn_uid FROM conn"),
    "ids_provenance": a.sql("SELECT 'event ' || event_id AS rule_name, true AS from_text_file FROM ids"),
    "ingest_limit": a.sql("""
      SELECT (SELECT least(100, count(*)) FROM conn WHERE k <> 13) AS conn_count, (SELECT least(10, count(*)) FROM ids) AS ids_count"""),
    "lake_counts": _LAKE_COUNTS,
    "lake_volume": a.sql(f"""SELECT strftime(event_time, '%Y-%m-%d') AS event_date, event_dataset, count(*) AS event_count
      FROM (SELECT event_time, 'zeek.conn' AS event_dataset FROM conn UNION ALL SELECT event_time, 'snort.alert' FROM ids)
      WHERE event_time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 17:30:00' GROUP BY 1, 2"""),
    "latest_events_by_date": a.sql(f"""SELECT {_STAMP} AS event_timestamp, source_ip, destination_port
      FROM (SELECT * FROM conn UNION ALL SELECT * EXCLUDE (event_severity, rule_id) FROM ids)
      ORDER BY event_time DESC, zeek_conn_uid LIMIT 25"""),
    "message_search_by_date": a.sql(f"""SELECT {_STAMP} AS event_timestamp, message FROM conn
      WHERE message LIKE 'ssl udp connection %:8080' ORDER BY event_time DESC, zeek_conn_uid LIMIT 40"""),
    "ip_pivot_clustered": a.sql(f"""SELECT {_STAMP} AS event_timestamp, {_DATASET} AS event_dataset, source_ip, destination_ip
      FROM conn WHERE source_ip = '192.168.0.8' OR destination_ip = '192.168.0.8'"""),
    "stream_lake": _LAKE_COUNTS,
    "lake_files": a.sql("SELECT 'PARQUET' AS file_format, strftime(d, '%Y-%m-%d') AS event_date, count(*) AS record_count "
                        "FROM lake GROUP BY 2", _LAKE),
    "lake_snapshots": a.sql("SELECT 'write' AS operation, count(*) AS record_count FROM lake "
                            "UNION ALL SELECT 'write', count(*) FROM ids", _LAKE),
    "internal_flags": a.sql(f"""
      SELECT {_INTERNAL.format('source_ip')} AS source_is_internal, {_INTERNAL.format('destination_ip')} AS destination_is_internal,
        count(*) AS event_count, CAST(sum(network_bytes) AS BIGINT) AS network_bytes FROM conn GROUP BY 1, 2"""),
    "union_events": a.sql(f"""
      SELECT {_STAMP} AS event_timestamp, strftime(event_time, '%Y-%m-%d') AS event_date, 'zeek.conn' AS event_dataset,
        NULL AS event_severity, source_ip, source_bytes, network_protocol, NULL AS rule_id, zeek_conn_uid, NULL AS snort_xref,
        source_ip || ',' || destination_ip AS related_ip FROM conn
      UNION ALL
      SELECT {_STAMP}, strftime(event_time, '%Y-%m-%d'), 'snort.alert', event_severity, source_ip, source_bytes, network_protocol,
        rule_id, zeek_conn_uid, NULL, source_ip || ',' || destination_ip FROM ids"""),
    "alert_documents": RULE_SQL["rule_protocol_anomaly"],
    "serving_rows": a.sql("""
      SELECT 'run-1' AS benchmark_id, CAST(event_id AS VARCHAR) AS event_id, event_dataset, event_severity, source_ip, rule_id,
        network_bytes, message, CAST(destination_port AS VARCHAR) AS payload_port, CAST(event_id AS VARCHAR) AS payload_id
      FROM corpus"""),
    "event_keys": a.sql("""
      SELECT zeek_conn_uid AS key, source_ip FROM conn
      UNION ALL
      SELECT rule_id || '|' || strftime(event_time, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN '' ELSE strftime(event_time, '.%f') END || '+00:00'
        || '|' || source_ip || '|' || source_port || '|' || destination_ip || '|' || destination_port, source_ip
      FROM ids"""),
    "overwrite_run": a.sql("""
      SELECT 'run-1' AS benchmark_id, count(*) AS event_count FROM corpus WHERE event_dataset = 'zeek.conn'
      UNION ALL SELECT 'run-2', count(*) FROM corpus"""),
    "upsert_moved": a.sql("""
      SELECT event_id, strftime(CAST(event_time AS DATE) + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END, '%Y-%m-%d') AS day,
        CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS version FROM conn"""),
    "upsert": a.sql("""
      SELECT event_id, event_dataset,
        CASE WHEN event_dataset = 'snort.alert' AND k % 2 = 1 THEN strftime(event_time + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%g')
          ELSE event_timestamp END AS event_timestamp,
        CASE WHEN event_dataset = 'snort.alert' AND k % 2 = 1 THEN 0 ELSE network_bytes END AS network_bytes FROM corpus"""),
    "write_by_dataset": a.sql("SELECT event_dataset AS _split, count(*) AS event_count FROM corpus GROUP BY 1"),
    "write_results": a.sql("SELECT source_ip, count(*) AS event_count, count(*) AS json_count FROM corpus GROUP BY 1"),
    "count_delta": a.sql("""
      SELECT *, delta >= 2 AS reached FROM (
        SELECT event_dataset, network_protocol, count(*) FILTER (event_dataset = 'zeek.conn' AND k < 50) AS before_count,
          count(*) AS after_count, count(*) FILTER (NOT (event_dataset = 'zeek.conn' AND k < 50)) AS delta
        FROM corpus GROUP BY 1, 2)"""),
}
