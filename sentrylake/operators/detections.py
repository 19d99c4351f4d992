"""Detection rules. Each is ``DataFrame -> alert DataFrame`` and runs unchanged on batch tables and on streams.

Two choices make the windowed rules safe for busy addresses and for streams:

* Distinct counts are two grouped aggregations: first one row per (window, source, contacted value), then per
  (window, source). The first shuffle is keyed by the contacted value as well, so a source with a third of all traffic
  is spread out, the second sees only pre-aggregated rows, and streaming state holds small counter rows, never sets.
* On a stream a filter below the window would also be moved below the watermark and stop unmatched rows from advancing
  event time. There the condition nulls the grouping key and the measures instead; the unmatched rows of a window fold
  into one NULL group, which the threshold on the aggregate removes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.alerts import PRODUCER, RuleMeta, escalate, iso, say, to_alert
from sentrylake.functions.net import INTERNAL_PATTERNS, is_internal
from sentrylake.operators.joins import interval_join
from sentrylake.operators.windows import by_pane

# Rule names, categories and the default thresholds; in the rules below, the sentences and evidence texts of alerts.
PORT_SCAN_RULE = RuleMeta("zeek.port_scan", "reconnaissance", ("network",), ("indicator", "connection"))
TOP_TALKER_RULE = RuleMeta("zeek.top_talker", "network_volume", ("network",), ("indicator",))
EXFILTRATION_RULE = RuleMeta(
    "zeek.possible_exfiltration", "exfiltration", ("network", "data_access"), ("indicator",))
BURST_RULE = RuleMeta(
    "snort.repeated_critical", "intrusion_detection", ("intrusion_detection",), ("indicator",))
CORRELATION_RULE = RuleMeta(
    "snort_zeek.correlation", "correlation", ("intrusion_detection", "network"), ("indicator", "correlation"))
ANOMALY_RULE = RuleMeta("zeek.protocol_anomaly", "protocol_anomaly", ("network",), ("indicator", "anomaly"))
ALL_RULES = (PORT_SCAN_RULE, TOP_TALKER_RULE, EXFILTRATION_RULE, BURST_RULE, CORRELATION_RULE, ANOMALY_RULE)


@dataclass(frozen=True)
class PortScan:
    window: str = "2 minutes"
    slide: str = "30 seconds"
    ports: int = 5
    ips: int = 3
    exact: bool = True
    panes: bool = True  # sum per pane first; turn off for sparse traffic that repeats little within a slide
    stream_panes: bool = False  # the same on streams, where it costs a level of state


@dataclass(frozen=True)
class TopTalkers:
    window: str = "5 minutes"
    bytes: int = 5_000_000
    flows: int = 3


@dataclass(frozen=True)
class Exfiltration:
    window: str = "5 minutes"
    slide: str = "1 minute"
    bytes: int = 4_000_000
    flows: int = 3
    internal: tuple[str, ...] = INTERNAL_PATTERNS
    panes: bool = True
    stream_panes: bool = False


@dataclass(frozen=True)
class AlertBurst:
    window: str = "5 minutes"
    slide: str = "1 minute"
    severity_max: int = 2
    count: int = 3
    panes: bool = True
    stream_panes: bool = False


@dataclass(frozen=True)
class Correlation:
    window: str = "2 minutes"
    severity_max: int = 2
    bytes: int = 1_000_000
    salt: int | None = None  # None: none on streams, measured in batch


@dataclass(frozen=True)
class ProtocolAnomaly:
    unknown_bytes: int = 750_000
    http_ports: tuple[int, ...] = (80, 8080, 8000, 8888)
    dns_ports: tuple[int, ...] = (53, 5353)
    ssh_port: int = 22


def or_zero(column: Column | str) -> Column:
    return F.coalesce(column, F.lit(0))


def sum0(column: Column | str) -> Column:
    """SUM that counts NULL as 0."""
    return F.sum(or_zero(column))


def _scope(df: DataFrame, wanted: Column, keys: list[str]) -> DataFrame:
    """Restrict a rule's input to ``wanted`` rows, marked by ``_hit``; see the module text for streams."""
    if not df.isStreaming:
        return df.where(wanted).withColumn("_hit", F.lit(True))
    hit = F.coalesce(wanted, F.lit(False))
    return df.withColumns({"_hit": hit, **{k: F.when(hit, F.col(k)) for k in keys}})


_WINDOW_TEXT = {
    "event_timestamp": iso("window.end"), "window_start": iso("window.start"), "window_end": iso("window.end"),
}


def port_scan_counts(conns: DataFrame, cfg: PortScan = PortScan(), time_col: str = "event_time") -> DataFrame:
    """Per window and source: flows, bytes, distinct destination ports and addresses."""
    window = F.window(time_col, cfg.window, cfg.slide)
    if not cfg.exact:
        return conns.groupBy(window, "source_ip").agg(
            F.count("*").alias("flows"),
            F.approx_count_distinct("destination_port").alias("ports"),
            F.approx_count_distinct("destination_ip").alias("ips"),
            sum0("network_bytes").alias("bytes"))
    flows = by_pane(
        conns, time_col, cfg.window, cfg.slide, ["source_ip", "destination_ip", "destination_port"],
        {"n": F.lit(1), "b": or_zero("network_bytes")}, panes=cfg.panes, stream_panes=cfg.stream_panes)
    contacts = F.array(
        F.struct(F.lit(True).alias("is_ip"), F.col("destination_ip").alias("peer")),
        F.struct(F.lit(False).alias("is_ip"), F.col("destination_port").cast("string").alias("peer")))
    per_peer = (
        flows.select(time_col, "source_ip", "n", "b", F.explode(contacts).alias("contact"))
        .groupBy(window, "source_ip", F.col("contact.is_ip").alias("is_ip"), F.col("contact.peer").alias("peer"))
        .agg(F.sum("n").alias("n"), F.sum("b").alias("b")))
    # Every flow is in exactly one address row, so the address rows alone carry the totals.
    return per_peer.groupBy("window", "source_ip").agg(
        F.sum(F.when(F.col("is_ip"), F.col("n"))).alias("flows"),
        F.count(F.when(~F.col("is_ip"), F.col("peer"))).alias("ports"),
        F.count(F.when(F.col("is_ip"), F.col("peer"))).alias("ips"),
        F.sum(F.when(F.col("is_ip"), F.col("b"))).alias("bytes"))


def detect_port_scan(
    conns: DataFrame, cfg: PortScan = PortScan(), time_col: str = "event_time", producer: str = PRODUCER,
) -> DataFrame:
    """One source reaching many destination ports or many addresses within a sliding window."""
    found = port_scan_counts(conns, cfg, time_col).where(f"ports >= {cfg.ports} OR ips >= {cfg.ips}")
    amount, unit = cfg.window.split()
    length = f"{amount} minute(s)" if unit.startswith("minute") else cfg.window
    return to_alert(
        found, PORT_SCAN_RULE, producer, **_WINDOW_TEXT,
        event_severity=f"if(ports >= {2 * cfg.ports} OR ips >= {2 * cfg.ips}, 2, 3)",
        source_ip="source_ip",
        network_bytes="bytes",
        alert_reason=say(
            "Source IP {source_ip} contacted {ports} unique destination ports across {ips} destination IPs in " + length + "."),
        alert_evidence=say(
            "flow_count={flows}, unique_destination_ports={ports}, unique_destination_ips={ips}, "
            "total_network_bytes={bytes}"),
        alert_count="flows",
        related_ip="array(source_ip)",
        message=say("Possible port scan from {source_ip}"),
        zeek_scan_unique_destination_ports="ports",
        zeek_scan_unique_destination_ips="ips",
        zeek_volume_total_bytes="bytes",
        zeek_connection_count="flows")


def detect_top_talkers(
    conns: DataFrame, cfg: TopTalkers = TopTalkers(), time_col: str = "event_time", producer: str = PRODUCER,
) -> DataFrame:
    """Hosts with a high byte volume in a tumbling window, as source or as destination."""
    roles = F.array(
        F.struct(F.lit("source").alias("direction"), F.col("source_ip").alias("host")),
        F.struct(F.lit("destination").alias("direction"), F.col("destination_ip").alias("host")))
    # Both directions come from one scan and one shuffle.
    volumes = (
        conns.select(time_col, "network_bytes", F.explode(roles).alias("role"))
        .groupBy(F.window(time_col, cfg.window), F.col("role.direction").alias("direction"),
                 F.col("role.host").alias("host"))
        .agg(F.count("*").alias("flows"), sum0("network_bytes").alias("bytes")))
    found = volumes.where(f"host IS NOT NULL AND bytes >= {cfg.bytes} AND flows >= {cfg.flows}")
    return to_alert(
        found, TOP_TALKER_RULE, producer, **_WINDOW_TEXT,
        event_severity=escalate("bytes", cfg.bytes, 2, 3),
        source_ip="if(direction = 'source', host, NULL)",
        destination_ip="if(direction = 'destination', host, NULL)",
        network_bytes="bytes",
        alert_reason=say("Host {host} exceeded the top-talker threshold as {direction}."),
        alert_evidence=say("direction={direction}, total_bytes={bytes}, flow_count={flows}"),
        alert_count="flows",
        related_ip="array(host)",
        message=say("High-volume {direction} host detected: {host}"),
        zeek_volume_direction="direction",
        zeek_volume_total_bytes="bytes",
        zeek_connection_count="flows")


def detect_exfiltration(
    conns: DataFrame, cfg: Exfiltration = Exfiltration(), time_col: str = "event_time", producer: str = PRODUCER,
) -> DataFrame:
    """Sustained volume from one internal source to external addresses within a sliding window."""
    outbound = is_internal("source_ip", cfg.internal) & ~is_internal("destination_ip", cfg.internal)
    measures = ["source_bytes", "destination_bytes", "network_bytes"]
    scoped = _scope(
        conns.select(time_col, "source_ip", "destination_ip", *measures), outbound,
        ["source_ip", "destination_ip", *measures])
    flows = by_pane(
        scoped, time_col, cfg.window, cfg.slide, ["source_ip", "destination_ip"],
        {"flows": F.col("_hit").cast("int"), **{m: or_zero(m) for m in measures}}, panes=cfg.panes, stream_panes=cfg.stream_panes)
    per_pair = flows.groupBy(F.window(time_col, cfg.window, cfg.slide), "source_ip", "destination_ip").agg(
        *[F.sum(m).alias(m) for m in ["flows", *measures]])
    per_source = per_pair.groupBy("window", "source_ip").agg(
        F.sum("flows").alias("flows"),
        F.count("destination_ip").alias("peers"),
        F.min("destination_ip").alias("sample"),
        *[F.sum(m).alias(m) for m in measures])
    found = per_source.where(f"source_bytes >= {cfg.bytes} AND flows >= {max(cfg.flows, 1)}")
    return to_alert(
        found, EXFILTRATION_RULE, producer, **_WINDOW_TEXT,
        event_severity=escalate("source_bytes", cfg.bytes, 1, 2),
        source_ip="source_ip",
        destination_ip="sample",
        network_bytes="network_bytes",
        alert_reason=say("Internal source {source_ip} sent sustained outbound traffic to external destinations."),
        alert_evidence=say(
            "total_source_bytes={source_bytes}, total_destination_bytes={destination_bytes}, "
            "total_network_bytes={network_bytes}, destination_count={peers}"),
        alert_count="flows",
        related_ip="array(source_ip, sample)",
        message=say("Possible exfiltration from {source_ip}"),
        zeek_scan_unique_destination_ips="peers",
        zeek_volume_direction="'source'",
        zeek_volume_total_bytes="network_bytes",
        zeek_connection_count="flows",
        correlation_type="'internal-to-external'")


def repeated_list(pairs: Column, value: str, times: str) -> Column:
    """Sorted (value, times) structs written out as a comma list with every repetition; NULL if there are none."""
    # Each value is repeated as text; the list is as long as the alerts are many, but no array of that length is made.
    runs = F.transform(pairs, lambda p: F.repeat(F.concat(p[value], F.lit(",")), p[times].cast("int")))
    written = F.array_join(runs, "")
    return F.when(F.size(pairs) > 0, F.left(written, F.length(written) - 1))


def detect_alert_burst(
    ids: DataFrame, cfg: AlertBurst = AlertBurst(), time_col: str = "event_time", producer: str = PRODUCER,
) -> DataFrame:
    """Repeated severe alerts of one source within a sliding window, with the rule ids that fired."""
    severe = F.col("event_severity").isNotNull() & (F.col("event_severity") <= cfg.severity_max) \
        & F.col("source_ip").isNotNull()
    keys = ["source_ip", "destination_ip", "rule_id"]
    scoped = _scope(ids.select(time_col, "event_severity", *keys), severe, keys)
    # One row per rule id first: the list below is then as long as the rule set, not as the alert volume.
    fired = by_pane(
        scoped, time_col, cfg.window, cfg.slide, ["source_ip", "rule_id"], {"n": F.col("_hit").cast("int")},
        {"sample": F.col("destination_ip")}, panes=cfg.panes, stream_panes=cfg.stream_panes)
    per_rule = fired.groupBy(F.window(time_col, cfg.window, cfg.slide), "source_ip", "rule_id").agg(
        F.sum("n").alias("n"), F.min("sample").alias("sample"))
    per_source = per_rule.groupBy("window", "source_ip").agg(
        F.sum("n").alias("alerts"),
        F.min("sample").alias("sample"),
        F.collect_list(F.when(F.col("rule_id").isNotNull(), F.struct("rule_id", "n"))).alias("rules"))
    found = per_source.where(f"alerts >= {max(cfg.count, 1)}").withColumn(
        "rule_list", repeated_list(F.sort_array("rules"), "rule_id", "n"))
    return to_alert(
        found, BURST_RULE, producer, **_WINDOW_TEXT,
        event_severity=escalate("alerts", cfg.count, 1, 2),
        source_ip="source_ip",
        destination_ip="sample",
        alert_reason=say("Source IP {source_ip} triggered repeated critical Snort alerts."),
        alert_evidence=say("alert_count={alerts}, rule_ids={rule_list}"),
        alert_count="alerts",
        alert_rule_ids="rule_list",
        related_ip="array(source_ip, sample)",
        message=say("Repeated critical Snort alerts from {source_ip}"),
        zeek_connection_count="alerts",
        correlation_type="'snort-burst'")


def _counting(rows: DataFrame, condition: str, time_col: str) -> DataFrame:
    """Rows that count for a join by ``source_ip``.

    On a stream the condition and the key are written in terms of the event time: Spark moves a filter below the watermark
    only if it does not look at that column. So all rows carry event time forward, and only those that count reach the join.
    """
    if not rows.isStreaming:
        return rows.where(condition)
    timed = F.col(time_col).isNotNull()
    counted = rows.where(F.when(timed, F.expr(condition)).otherwise(F.lit(False)))
    return counted.withColumn("source_ip", F.when(timed, F.col("source_ip")))


def detect_correlation(
    ids: DataFrame, conns: DataFrame, cfg: Correlation = Correlation(), time_col: str = "event_time",
    producer: str = PRODUCER,
) -> DataFrame:
    """A severe alert followed by high-volume traffic of the same source within the window."""
    left = _counting(ids, f"event_severity <= {cfg.severity_max}", time_col).selectExpr(
        "source_ip", f"{time_col} AS alert_time", "event_severity AS severity", "rule_id AS fired")
    right = _counting(conns, f"coalesce(network_bytes, 0) >= {cfg.bytes}", time_col).selectExpr(
        "source_ip", f"{time_col} AS flow_time", "destination_ip AS peer", "destination_port AS port",
        "network_bytes AS bytes", "zeek_conn_uid AS uid")
    found = interval_join(left, right, "source_ip", "alert_time", "flow_time", upper=cfg.window, salt=cfg.salt)
    return to_alert(
        found, CORRELATION_RULE, producer,
        event_timestamp=iso("flow_time"),
        event_severity=f"if(severity <= 1 AND coalesce(bytes, 0) >= {2 * cfg.bytes}, 1, 2)",
        source_ip="source_ip",
        destination_ip="peer",
        destination_port="port",
        network_bytes="bytes",
        alert_reason="'Critical Snort alert was followed by unusual Zeek traffic from the same source IP.'",
        alert_evidence=say(
            "snort_rule_id={coalesce(fired, 'unknown')}, snort_severity={severity}, zeek_uid={coalesce(uid, 'unknown')}, "
            "zeek_bytes={coalesce(bytes, 0)}"),
        alert_count="2",
        alert_rule_ids="fired",
        window_start=iso("alert_time"),
        window_end=iso("flow_time"),
        related_ip="array(source_ip, peer)",
        message=say("Snort-to-Zeek correlation for {source_ip}"),
        zeek_volume_direction="'source'",
        zeek_volume_total_bytes="bytes",
        zeek_connection_count="1",
        correlation_type="'snort-followed-by-high-bytes'")


def _anomaly_checks(cfg: ProtocolAnomaly) -> list[tuple[str, str, int, str]]:
    """(condition, type, severity, reason), first match wins. A NULL port or protocol satisfies no port check."""
    http = ", ".join(map(str, cfg.http_ports))
    dns = ", ".join(map(str, cfg.dns_ports))
    return [
        (f"network_protocol IS NULL AND coalesce(network_bytes, 0) >= {cfg.unknown_bytes}", "unknown_service_high_bytes",
         2, "Unknown or null service carried unusually high bytes."),
        (f"network_protocol = 'http' AND NOT destination_port IN ({http})", "http_unexpected_port", 3,
         "HTTP-like traffic appeared on an uncommon destination port."),
        (f"network_protocol = 'dns' AND NOT destination_port IN ({dns})", "dns_unexpected_port", 3,
         "DNS-like traffic appeared on an uncommon destination port."),
        (f"network_protocol = 'ssh' AND destination_port != {cfg.ssh_port}", "ssh_unexpected_port", 3,
         "SSH-like traffic appeared on a non-standard destination port."),
        ("network_protocol = 'http' AND network_transport = 'udp'", "http_over_udp", 3,
         "HTTP service was paired with UDP transport."),
    ]


def detect_protocol_anomaly(
    conns: DataFrame, cfg: ProtocolAnomaly = ProtocolAnomaly(), time_col: str = "event_time",
    producer: str = PRODUCER,
) -> DataFrame:
    """Single connections whose service, port, transport or volume do not fit together. Stateless."""
    verdicts = ", ".join(
        f"if({condition}, struct('{kind}' AS kind, {severity} AS severity, '{reason}' AS reason), NULL)"
        for condition, kind, severity, reason in _anomaly_checks(cfg))
    found = conns.withColumn("verdict", F.expr(f"coalesce({verdicts})")).where("verdict IS NOT NULL")
    return to_alert(
        found, ANOMALY_RULE, producer,
        event_timestamp=iso(time_col),
        event_severity="verdict.severity",
        source_ip="source_ip",
        destination_ip="destination_ip",
        destination_port="destination_port",
        network_bytes="network_bytes",
        alert_reason="verdict.reason",
        alert_evidence=say(
            "service={coalesce(network_protocol, 'null')}, transport={coalesce(network_transport, 'null')}, "
            "destination_port={coalesce(destination_port, -1)}, network_bytes={coalesce(network_bytes, 0)}"),
        alert_count="1",
        window_start=iso(time_col),
        window_end=iso(time_col),
        related_ip="related_ip",
        message=say("Protocol anomaly from {source_ip}"),
        zeek_volume_direction="'source'",
        zeek_volume_total_bytes="network_bytes",
        zeek_connection_count="1",
        correlation_type="verdict.kind")


@dataclass(frozen=True)
class RuleSet:
    """Settings of all rules, for running them together."""

    port_scan: PortScan = PortScan()
    top_talkers: TopTalkers = TopTalkers()
    exfiltration: Exfiltration = Exfiltration()
    alert_burst: AlertBurst = AlertBurst()
    correlation: Correlation = Correlation()
    protocol_anomaly: ProtocolAnomaly = ProtocolAnomaly()


RULE_NAMES = ("port_scan", "top_talkers", "exfiltration", "alert_burst", "correlation", "protocol_anomaly")


def run_rule(name: str, conns: DataFrame, ids: DataFrame, rules: RuleSet = RuleSet(), **kw: str) -> DataFrame:
    """Alerts of one rule, by name."""
    cfg = getattr(rules, name)
    if name == "alert_burst":
        return detect_alert_burst(ids, cfg, **kw)
    if name == "correlation":
        return detect_correlation(ids, conns, cfg, **kw)
    on_conns = {
        "port_scan": detect_port_scan, "top_talkers": detect_top_talkers, "exfiltration": detect_exfiltration,
        "protocol_anomaly": detect_protocol_anomaly,
    }
    return on_conns[name](conns, cfg, **kw)


def rule_outputs(conns: DataFrame, ids: DataFrame, rules: RuleSet = RuleSet(), **kw: str) -> dict[str, DataFrame]:
    """Alerts of every rule by name, not yet combined (a stream runs one query per rule)."""
    return {name: run_rule(name, conns, ids, rules, **kw) for name in RULE_NAMES}


def all_alerts(conns: DataFrame, ids: DataFrame, rules: RuleSet = RuleSet(), **kw: str) -> DataFrame:
    """All rules' alerts as one batch table."""
    first, *rest = rule_outputs(conns, ids, rules, **kw).values()
    for alerts in rest:
        first = first.unionByName(alerts)
    return first
