"""Registered queries: detection rules, in batch and as streams, and the joins around them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.operators import detections as d
from sentrylake.operators.aggregates import top_counts
from sentrylake.operators.joins import alert_latency, evidence_for, interval_join, missing_rules
from sentrylake.operators.search import recent_alerts
from sentrylake.plans import adapter as a
from sentrylake.schemas import ALERT_FIELDS, flat_name
from sentrylake.session import shared_dir
from sentrylake.streaming.eventtime import with_event_time
from sentrylake.streaming.progress import progress_to, read_progress
from sentrylake.streaming.run import drain, run_rules

# The table holds few events per user and hour, so windows span hours and days instead of minutes.
RULES = d.RuleSet(
    port_scan=d.PortScan(window="1 day", slide="6 hours", ports=4, ips=6),
    top_talkers=d.TopTalkers(window="1 day", bytes=200_000, flows=3),
    exfiltration=d.Exfiltration(window="1 day", slide="6 hours", bytes=100_000, flows=2),
    alert_burst=d.AlertBurst(window="1 day", slide="6 hours", severity_max=2, count=2),
    correlation=d.Correlation(window="12 hours", severity_max=2, bytes=40_000, salt=4),
    protocol_anomaly=d.ProtocolAnomaly(unknown_bytes=20_000),
)
DELAY_SECONDS = 30


def _batch(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return a.flat_arrays(d.run_rule(name, a.conns(spark, sf_dir), a.ids(spark, sf_dir), RULES))
    return run


def _stream(name: str, rules: d.RuleSet = RULES) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        delay = f"{DELAY_SECONDS} seconds"
        alerts = d.run_rule(name, a.conn_stream(spark, sf_dir, delay), a.ids_stream(spark, sf_dir, delay), rules)
        folder = shared_dir(spark, f"stream-{name}")
        return a.flat_arrays(drain(alerts, f"{folder}/out", f"{folder}/checkpoint"))
    return run


def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.all_alerts(a.conns(spark, sf_dir), a.ids(spark, sf_dir), RULES)


def _all_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One streaming query per rule, started together, each with its own checkpoint; alerts by rule.

    As all of them hold state at once, they read a large table in order of time, in triggers of bounded size.
    """
    delay = f"{DELAY_SECONDS} seconds"
    folder = shared_dir(spark, "all-rules")
    outputs = d.rule_outputs(a.conn_stream(spark, sf_dir, delay, paced=True), a.ids_stream(spark, sf_dir, delay, paced=True), RULES)
    for query in run_rules(outputs, f"{folder}/out", f"{folder}/checkpoint").values():
        query.awaitTermination()
    counts = [spark.read.schema(alerts.schema).parquet(f"{folder}/out/rule={name}").groupBy("rule_name").count()
              for name, alerts in outputs.items()]
    return reduce(DataFrame.unionByName, counts).withColumnRenamed("count", "alert_count")


def _stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read by two streaming queries, from the table of their progress."""
    folder, delay = shared_dir(spark, "progress"), f"{DELAY_SECONDS} seconds"
    with progress_to(spark, f"{folder}/progress"):
        for name in ("top_talkers", "protocol_anomaly"):
            alerts = d.run_rule(name, a.conn_stream(spark, sf_dir, delay), a.ids_stream(spark, sf_dir, delay), RULES)
            drain(alerts, f"{folder}/{name}", f"{folder}/checkpoint-{name}", name=name)
    rows = read_progress(spark, f"{folder}/progress")
    return rows.groupBy("query").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


def _stream_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and dataset of both streams together, of which each may be silent without holding back the other."""
    delay, folder = f"{DELAY_SECONDS} seconds", shared_dir(spark, "volume")
    # The present, as a stream: each event of the table happens now. One more, days later, closes the last day.
    path = a.derived(spark, sf_dir, "clock", lambda p: a.conns(spark, sf_dir).agg(F.max("event_timestamp").alias("timestamp")).withColumn(
        "timestamp", F.col("timestamp") + F.expr("INTERVAL 2 DAYS")).write.parquet(p))
    clock = spark.readStream.schema("timestamp timestamp").parquet(path)
    columns = ["event_timestamp", "event_dataset"]
    both = [with_event_time(rows.select(*columns), delay=delay, idle="5 seconds", clock=clock) for rows in (
        a.conn_stream(spark, sf_dir, None), a.ids_stream(spark, sf_dir, None).where("k < 0"))]
    counts = both[0].unionByName(both[1]).groupBy(F.window("event_time", "1 day"), "event_dataset").agg(F.count("*").alias("event_count"))
    found = drain(counts.select(F.col("window.start").alias("day"), "event_dataset", "event_count"), f"{folder}/out", f"{folder}/checkpoint")
    return a.iso_text(found, "day")


def _interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = a.ids(spark, sf_dir).select("source_ip", F.col("event_time").alias("t"), F.col("event_id").alias("alert_id"))
    right = a.conns(spark, sf_dir).select("source_ip", F.col("event_time").alias("u"), F.col("event_id"))
    return interval_join(left, right, "source_ip", "t", "u", upper="3 hours", lower="-1 hours", bin_width="2 hours", salt=3) \
        .select("alert_id", "event_id", "source_ip")


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Alert keys that are stable across engines: rule, source and window.
    alerts = d.detect_port_scan(a.conns(spark, sf_dir), RULES.port_scan)
    found = evidence_for(
        alerts, a.conns(spark, sf_dir), bin_width="6 hours", alert_cols=("window_start", "source_ip"),
        event_cols=("event_id", "network_bytes"))
    return found


def _missing_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = d.detect_protocol_anomaly(a.conns(spark, sf_dir), RULES.protocol_anomaly).select(
        F.col("correlation_type").alias("rule_id"))
    expected = a.table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("_unexpected_port")).alias("rule_id")).distinct().unionByName(
        fired.distinct())
    return missing_rules(expected, fired)


def _alerts_per_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_counts(all_alerts(spark, sf_dir), "rule_id", 10, "alert_count")


def _recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_alerts(all_alerts(spark, sf_dir), 50)


def _alert_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that become visible k hours after their event, against the arrivals of all events of the source."""
    arrivals = a.conns(spark, sf_dir).select("source_ip", F.col("event_time").alias("ingest_ts"))
    written = F.col("event_time") + F.make_dt_interval(hours=F.col("k"))
    alerts = a.ids(spark, sf_dir).select("source_ip", "event_id", written.alias("written_at"))
    found = alert_latency(alerts, arrivals, "source_ip", window="2 days", bin_width="6 hours")
    return found.select("source_ip", "event_id", "latency_ms")


# ---------------------------------------------------------------------------------------------- SQL for the check
_COMMON = {
    "event_kind": "'alert'", "event_module": "'flink'", "event_dataset": "'siem.alert'",
}


# Rule name, category, event categories, event types.
_SCAN = "zeek.port_scan", "reconnaissance", "network", "indicator,connection"
_TALKER = "zeek.top_talker", "network_volume", "network", "indicator"
_EXFILTRATION = "zeek.possible_exfiltration", "exfiltration", "network,data_access", "indicator"
_BURST = "snort.repeated_critical", "intrusion_detection", "intrusion_detection", "indicator"
_CORRELATION = "snort_zeek.correlation", "correlation", "intrusion_detection,network", "indicator,correlation"
_ANOMALY = "zeek.protocol_anomaly", "protocol_anomaly", "network", "indicator,anomaly"


def _alert_select(rule: tuple[str, str, str, str], source: str, **fields: str) -> str:
    name, category, categories, types = rule
    values = {
        **_COMMON, "rule_id": f"'flink.{name}'", "rule_name": f"'{name}'", "rule_category": f"'{category}'",
        "pipeline": f"'flink.{name}'", "event_category": f"'{categories}'", "event_type": f"'{types}'", **fields,
    }
    listed = [f"{values.get(n, 'NULL')} AS {n}" for n in map(flat_name, ALERT_FIELDS)]
    return "SELECT " + ", ".join(listed) + f" FROM {source}"


def _iso(column: str) -> str:
    return f"strftime({column}, {a.ISO})"


def _hop(source: str, where: str = "TRUE") -> str:
    return (f"SELECT s.*, time_bucket(INTERVAL 6 HOUR, event_time) - to_hours(CAST(6 * i AS INTEGER)) AS ws "
            f"FROM {source} s, range(0, 4) g(i) WHERE {where}")


_HOP_TEXT = dict(event_timestamp=_iso("ws + INTERVAL 1 DAY"), window_start=_iso("ws"), window_end=_iso("ws + INTERVAL 1 DAY"))


def _port_scan_sql(closed: str = "TRUE") -> str:
    counts = f"""scan AS (
      SELECT ws, source_ip, count(*) AS flows, count(DISTINCT destination_port) AS ports,
             count(DISTINCT destination_ip) AS ips, CAST(sum(network_bytes) AS BIGINT) AS bytes
      FROM ({_hop('conn')}) GROUP BY ALL
      HAVING (ports >= 4 OR ips >= 6) AND {closed})"""
    return a.sql(_alert_select(
        _SCAN, "scan", **_HOP_TEXT,
        event_severity="CASE WHEN ports >= 8 OR ips >= 12 THEN 2 ELSE 3 END", source_ip="source_ip",
        network_bytes="bytes", alert_count="flows", related_ip="source_ip",
        alert_reason="format('Source IP {} contacted {} unique destination ports across {} destination IPs in 1 day.', "
                     "source_ip, ports, ips)",
        alert_evidence="format('flow_count={}, unique_destination_ports={}, unique_destination_ips={}, "
                       "total_network_bytes={}', flows, ports, ips, bytes)",
        message="'Possible port scan from ' || source_ip", zeek_scan_unique_destination_ports="ports",
        zeek_scan_unique_destination_ips="ips", zeek_volume_total_bytes="bytes", zeek_connection_count="flows"), counts)


def _top_talkers_sql(closed: str = "TRUE") -> str:
    volume = f"""roles AS (
      SELECT event_time, network_bytes, 'source' AS direction, source_ip AS host FROM conn
      UNION ALL SELECT event_time, network_bytes, 'destination', destination_ip FROM conn),
    volume AS (
      SELECT * FROM (
        SELECT time_bucket(INTERVAL 1 DAY, event_time) AS ws, direction, host, count(*) AS flows,
               CAST(sum(network_bytes) AS BIGINT) AS bytes
        FROM roles GROUP BY ALL)
      WHERE bytes >= 200000 AND flows >= 3 AND {closed})"""
    return a.sql(_alert_select(
        _TALKER, "volume", **_HOP_TEXT,
        event_severity="CASE WHEN bytes >= 400000 THEN 2 ELSE 3 END",
        source_ip="CASE WHEN direction = 'source' THEN host END",
        destination_ip="CASE WHEN direction = 'destination' THEN host END", network_bytes="bytes", alert_count="flows",
        alert_reason="format('Host {} exceeded the top-talker threshold as {}.', host, direction)",
        alert_evidence="format('direction={}, total_bytes={}, flow_count={}', direction, bytes, flows)",
        related_ip="host", message="format('High-volume {} host detected: {}', direction, host)",
        zeek_volume_direction="direction", zeek_volume_total_bytes="bytes", zeek_connection_count="flows"), volume)


def _exfiltration_sql(closed: str = "TRUE") -> str:
    outbound = f"""outbound AS (
      SELECT ws, source_ip, min(destination_ip) AS sample, count(*) AS flows, count(DISTINCT destination_ip) AS peers,
             CAST(sum(source_bytes) AS BIGINT) AS sent, CAST(sum(destination_bytes) AS BIGINT) AS got,
             CAST(sum(network_bytes) AS BIGINT) AS bytes
      FROM ({_hop('conn', "source_ip LIKE '192.168.%' AND NOT destination_ip LIKE '10.%'")}) GROUP BY ALL
      HAVING sent >= 100000 AND flows >= 2 AND {closed})"""
    return a.sql(_alert_select(
        _EXFILTRATION, "outbound", **_HOP_TEXT,
        event_severity="CASE WHEN sent >= 200000 THEN 1 ELSE 2 END", source_ip="source_ip", destination_ip="sample",
        network_bytes="bytes", alert_count="flows", related_ip="source_ip || ',' || sample",
        alert_reason="format('Internal source {} sent sustained outbound traffic to external destinations.', source_ip)",
        alert_evidence="format('total_source_bytes={}, total_destination_bytes={}, total_network_bytes={}, "
                       "destination_count={}', sent, got, bytes, peers)",
        message="'Possible exfiltration from ' || source_ip", zeek_scan_unique_destination_ips="peers",
        zeek_volume_direction="'source'", zeek_volume_total_bytes="bytes", zeek_connection_count="flows",
        correlation_type="'internal-to-external'"), outbound)


def _alert_burst_sql(closed: str = "TRUE") -> str:
    burst = f"""burst AS (
      SELECT ws, source_ip, min(destination_ip) AS sample, count(*) AS n, string_agg(rule_id, ',' ORDER BY rule_id) AS fired
      FROM ({_hop('ids', 'event_severity <= 2')}) GROUP BY ALL HAVING n >= 2 AND {closed})"""
    return a.sql(_alert_select(
        _BURST, "burst", **_HOP_TEXT,
        event_severity="CASE WHEN n >= 4 THEN 1 ELSE 2 END", source_ip="source_ip", destination_ip="sample",
        alert_reason="format('Source IP {} triggered repeated critical Snort alerts.', source_ip)",
        alert_evidence="format('alert_count={}, rule_ids={}', n, fired)", alert_count="n", alert_rule_ids="fired",
        related_ip="source_ip || ',' || sample", message="'Repeated critical Snort alerts from ' || source_ip",
        zeek_connection_count="n", correlation_type="'snort-burst'"), burst)


def _correlation_sql() -> str:
    pairs = """pairs AS (
      SELECT i.source_ip, i.event_time AS alert_at, i.event_severity AS sev, i.rule_id, c.event_time AS flow_at,
             c.destination_ip, c.destination_port, c.network_bytes AS bytes, c.zeek_conn_uid AS uid
      FROM ids i JOIN conn c ON i.source_ip = c.source_ip
        AND c.event_time >= i.event_time AND c.event_time <= i.event_time + INTERVAL 12 HOUR
      WHERE i.event_severity <= 2 AND c.network_bytes >= 40000)"""
    return a.sql(_alert_select(
        _CORRELATION, "pairs", event_timestamp=_iso("flow_at"), window_start=_iso("alert_at"), window_end=_iso("flow_at"),
        event_severity="CASE WHEN sev <= 1 AND bytes >= 80000 THEN 1 ELSE 2 END", source_ip="source_ip",
        destination_ip="destination_ip", destination_port="destination_port", network_bytes="bytes",
        alert_reason="'Critical Snort alert was followed by unusual Zeek traffic from the same source IP.'",
        alert_evidence="format('snort_rule_id={}, snort_severity={}, zeek_uid={}, zeek_bytes={}', rule_id, sev, uid, bytes)",
        alert_count="2", alert_rule_ids="rule_id", related_ip="source_ip || ',' || destination_ip",
        message="'Snort-to-Zeek correlation for ' || source_ip", zeek_volume_direction="'source'",
        zeek_volume_total_bytes="bytes", zeek_connection_count="1", correlation_type="'snort-followed-by-high-bytes'"), pairs)


_ODD = """odd AS (
  SELECT *, CASE
      WHEN network_protocol IS NULL AND network_bytes >= 20000 THEN 'unknown_service_high_bytes'
      WHEN network_protocol = 'http' AND destination_port NOT IN (80, 8080, 8000, 8888) THEN 'http_unexpected_port'
      WHEN network_protocol = 'dns' AND destination_port NOT IN (53, 5353) THEN 'dns_unexpected_port'
      WHEN network_protocol = 'ssh' AND destination_port <> 22 THEN 'ssh_unexpected_port'
      WHEN network_protocol = 'http' AND network_transport = 'udp' THEN 'http_over_udp' END AS odd_kind
  FROM conn)"""


def _anomaly_sql() -> str:
    reasons = """CASE odd_kind WHEN 'unknown_service_high_bytes' THEN 'Unknown or null service carried unusually high bytes.'
      WHEN 'http_unexpected_port' THEN 'HTTP-like traffic appeared on an uncommon destination port.'
      WHEN 'dns_unexpected_port' THEN 'DNS-like traffic appeared on an uncommon destination port.'
      WHEN 'ssh_unexpected_port' THEN 'SSH-like traffic appeared on a non-standard destination port.'
      ELSE 'HTTP service was paired with UDP transport.' END"""
    return a.sql(_alert_select(
        _ANOMALY, "odd WHERE odd_kind IS NOT NULL", event_timestamp=_iso("event_time"),
        window_start=_iso("event_time"), window_end=_iso("event_time"),
        event_severity="CASE WHEN odd_kind = 'unknown_service_high_bytes' THEN 2 ELSE 3 END", source_ip="source_ip",
        destination_ip="destination_ip", destination_port="destination_port", network_bytes="network_bytes",
        alert_reason=reasons,
        alert_evidence="format('service={}, transport={}, destination_port={}, network_bytes={}', "
                       "coalesce(network_protocol, 'null'), network_transport, destination_port, network_bytes)",
        alert_count="1", related_ip="source_ip || ',' || destination_ip",
        message="'Protocol anomaly from ' || source_ip", zeek_volume_direction="'source'",
        zeek_volume_total_bytes="network_bytes", zeek_connection_count="1", correlation_type="odd_kind"), _ODD)


def _closed(source: str) -> str:
    return f"ws + INTERVAL 1 DAY <= (SELECT max(event_time) FROM {source}) - INTERVAL {DELAY_SECONDS} SECOND"


_RULE_COUNTS = f"""fired AS (
  SELECT 'zeek.port_scan' AS rule, count(*) AS n FROM (
    SELECT ws, source_ip FROM ({_hop('conn')}) GROUP BY ALL
    HAVING count(DISTINCT destination_port) >= 4 OR count(DISTINCT destination_ip) >= 6)
  UNION ALL SELECT 'zeek.top_talker', count(*) FROM (
    SELECT time_bucket(INTERVAL 1 DAY, event_time) AS ws, side, host FROM (
      SELECT event_time, network_bytes, 's' AS side, source_ip AS host FROM conn
      UNION ALL SELECT event_time, network_bytes, 'd', destination_ip FROM conn)
    GROUP BY ALL HAVING sum(network_bytes) >= 200000 AND count(*) >= 3)
  UNION ALL SELECT 'zeek.possible_exfiltration', count(*) FROM (
    SELECT ws, source_ip FROM ({_hop('conn', "source_ip LIKE '192.168.%' AND NOT destination_ip LIKE '10.%'")})
    GROUP BY ALL HAVING sum(source_bytes) >= 100000 AND count(*) >= 2)
  UNION ALL SELECT 'snort.repeated_critical', count(*) FROM (
    SELECT ws, source_ip FROM ({_hop('ids', 'event_severity <= 2')}) GROUP BY ALL HAVING count(*) >= 2)
  UNION ALL SELECT 'snort_zeek.correlation', count(*) FROM ids i JOIN conn c ON i.source_ip = c.source_ip
    AND c.event_time BETWEEN i.event_time AND i.event_time + INTERVAL 12 HOUR
    WHERE i.event_severity <= 2 AND c.network_bytes >= 40000
  UNION ALL SELECT 'zeek.protocol_anomaly', count(*) FROM odd WHERE odd_kind IS NOT NULL)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_port_scan": _batch("port_scan"),
    "rule_top_talkers": _batch("top_talkers"),
    "rule_exfiltration": _batch("exfiltration"),
    "rule_alert_burst": _batch("alert_burst"),
    "rule_correlation": _batch("correlation"),
    "rule_protocol_anomaly": _batch("protocol_anomaly"),
    "stream_port_scan": _stream("port_scan"),
    "stream_port_scan_panes": _stream("port_scan", replace(RULES, port_scan=replace(RULES.port_scan, stream_panes=True))),
    "stream_alert_burst_panes": _stream("alert_burst", replace(RULES, alert_burst=replace(RULES.alert_burst, stream_panes=True))),
    "stream_progress": _stream_progress,
    "stream_volume_idle": _stream_volume,
    "stream_top_talkers": _stream("top_talkers"),
    "stream_exfiltration": _stream("exfiltration"),
    "stream_alert_burst": _stream("alert_burst"),
    "stream_correlation": _stream("correlation"),
    "stream_protocol_anomaly": _stream("protocol_anomaly"),
    "interval_join_binned": _interval_join,
    "evidence_for": _evidence,
    "missing_rules": _missing_rules,
    "alerts_per_rule": _alerts_per_rule,
    "stream_all_rules": _all_streams,
    "recent_alerts": _recent_alerts,
    "alert_latency": _alert_latency,
}

ORACLES: dict[str, str] = {
    "rule_port_scan": _port_scan_sql(),
    "rule_top_talkers": _top_talkers_sql(),
    "rule_exfiltration": _exfiltration_sql(),
    "rule_alert_burst": _alert_burst_sql(),
    "rule_correlation": _correlation_sql(),
    "rule_protocol_anomaly": _anomaly_sql(),
    "stream_port_scan_panes": _port_scan_sql(_closed("conn")),
    "stream_alert_burst_panes": _alert_burst_sql(_closed("ids")),
    "stream_progress": a.sql("SELECT q AS query, count(*) AS input_rows, 0 AS late_rows FROM conn, (VALUES ('top_talkers'), ('protocol_anomaly')) v(q) GROUP BY q"),
    "stream_volume_idle": a.sql(f"""SELECT strftime(time_bucket(INTERVAL 1 DAY, event_time), {a.ISO}) AS day, 'zeek.conn' AS event_dataset,
      count(*) AS event_count FROM conn GROUP BY 1"""),
    "stream_port_scan": _port_scan_sql(_closed("conn")),
    "stream_top_talkers": _top_talkers_sql(_closed("conn")),
    "stream_exfiltration": _exfiltration_sql(_closed("conn")),
    "stream_alert_burst": _alert_burst_sql(_closed("ids")),
    "stream_correlation": _correlation_sql(),
    "stream_protocol_anomaly": _anomaly_sql(),
    "interval_join_binned": a.sql("""
      SELECT i.event_id AS alert_id, c.event_id, i.source_ip FROM ids i JOIN conn c ON i.source_ip = c.source_ip
        AND c.event_time BETWEEN i.event_time - INTERVAL 1 HOUR AND i.event_time + INTERVAL 3 HOUR"""),
    "evidence_for": a.sql(f"""
      SELECT strftime(s.ws, {a.ISO}) AS window_start, s.source_ip, c.event_id, c.network_bytes
      FROM scan s JOIN conn c ON (c.source_ip = s.source_ip OR c.destination_ip = s.source_ip)
        AND c.event_time BETWEEN s.ws AND s.ws + INTERVAL 1 DAY""", f"""scan AS (
      SELECT ws, source_ip FROM ({_hop('conn')}) GROUP BY ALL
      HAVING count(DISTINCT destination_port) >= 4 OR count(DISTINCT destination_ip) >= 6)"""),
    "missing_rules": a.sql("""
      SELECT DISTINCT event_type || '_unexpected_port' AS rule_id FROM events
      WHERE event_type || '_unexpected_port' NOT IN (SELECT odd_kind FROM odd WHERE odd_kind IS NOT NULL)""", _ODD),
    "alerts_per_rule": a.sql(
        "SELECT 'flink.' || rule AS rule_id, n AS alert_count FROM fired WHERE n > 0", _ODD, _RULE_COUNTS),
    "alert_latency": a.sql("""
      SELECT i.source_ip, i.event_id, (epoch_us(i.written_at) - epoch_us(c.event_time)) / 1000.0 AS latency_ms
      FROM (SELECT *, event_time + to_hours(k) AS written_at FROM ids) i
      ASOF JOIN conn c ON i.source_ip = c.source_ip AND i.written_at >= c.event_time
      WHERE i.written_at - c.event_time <= INTERVAL 2 DAY"""),
}


def _recent_sql() -> str:
    selects = [_port_scan_sql(), _top_talkers_sql(), _exfiltration_sql(), _alert_burst_sql(), _correlation_sql(), _anomaly_sql()]
    parts = " UNION ALL ".join(f"SELECT * FROM ({s})" for s in selects)
    return (f"SELECT event_timestamp, rule_name, event_severity, source_ip, destination_ip, pipeline, message FROM ({parts}) "
            "ORDER BY event_timestamp DESC, rule_name, source_ip NULLS FIRST, destination_ip NULLS FIRST, message LIMIT 50")


ORACLES["recent_alerts"] = _recent_sql()
ORACLES["stream_all_rules"] = "SELECT rule_name, count(*) AS alert_count FROM (" + " UNION ALL ".join(
    f"SELECT rule_name FROM ({ORACLES[name]})" for name in ORACLES if name.startswith("stream_")) + ") GROUP BY 1"
