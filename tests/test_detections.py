import plain_rules as plain
import pytest
from fixture_rows import CONN_FLUSH, CONNS, IDS, IDS_FLUSH, batch, conn, ids, write_lines

from sentrylake.operators import detections as d
from sentrylake.schemas import ALERT_SCHEMA, CONN_SCHEMA, IDS_SCHEMA
from sentrylake.sources.streams import read_conn_stream, read_ids_stream
from sentrylake.streaming.run import drain, run_rules, start_query

ALL_CONNS, ALL_IDS = [*CONNS, CONN_FLUSH], [*IDS, IDS_FLUSH]
SCAN = plain.port_scan(ALL_CONNS)
COUNTS = plain.counts(ALL_CONNS, ALL_IDS)
# Without a later row the windows of the last half minute and more stay open.
OPEN_COUNTS = plain.counts(CONNS, IDS, until=30)


def test_the_rows_raise_every_rule():
    assert min(COUNTS.values()) > 0 and sum(OPEN_COUNTS.values()) < sum(COUNTS.values())


@pytest.fixture(scope="module")
def tables(spark):
    return batch(spark, ALL_CONNS, CONN_SCHEMA), batch(spark, ALL_IDS, IDS_SCHEMA)


def scan_rows(df):
    return {
        (r.window_start[11:19], r.window_end[11:19], r.source_ip, r.alert_count, r.zeek_scan_unique_destination_ports,
         r.zeek_scan_unique_destination_ips, r.network_bytes, r.event_severity) for r in df.collect()
    }


def test_port_scan(tables):
    alerts = d.detect_port_scan(tables[0])
    assert alerts.schema.names == ALERT_SCHEMA.names
    assert scan_rows(alerts) == SCAN
    row = alerts.where("source_ip = '10.4.7.9'").orderBy("window_start").first()
    assert row.event_timestamp == row.window_end == "2031-09-04T07:16:00.000"
    assert row.rule_id == row.pipeline == "flink.zeek.port_scan"
    assert row.alert_reason == "Source IP 10.4.7.9 contacted 6 unique destination ports across 3 destination IPs in 2 minute(s)."
    assert row.alert_evidence == "flow_count=6, unique_destination_ports=6, unique_destination_ips=3, total_network_bytes=507"


def test_port_scan_approximate_agrees_on_small_counts(tables):
    assert scan_rows(d.detect_port_scan(tables[0], d.PortScan(exact=False))) == SCAN


def test_port_scan_without_source_has_null_texts(spark):
    rows = [conn(f"12:40:0{i}", None, "198.51.100.1", 100 + i, 1, 1) for i in range(5)]
    found = d.detect_port_scan(batch(spark, rows, CONN_SCHEMA)).collect()
    assert len(found) == 4
    assert all(r.source_ip is None and r.message is None and r.alert_reason is None for r in found)
    assert all(r.zeek_scan_unique_destination_ports == 5 for r in found)


def test_port_scan_ignores_null_ports_and_escalates(spark):
    rows = [conn("12:40:01", "10.0.0.1", f"198.51.100.{i}", None, 1, 1) for i in range(6)]
    found = d.detect_port_scan(batch(spark, rows, CONN_SCHEMA)).collect()
    assert {(r.zeek_scan_unique_destination_ports, r.zeek_scan_unique_destination_ips, r.event_severity, r.alert_count)
            for r in found} == {(0, 6, 2, 6)}


def test_top_talkers(tables):
    found = {(r.source_ip, r.destination_ip, r.network_bytes, r.alert_count, r.event_severity, r.window_start[11:19])
             for r in d.detect_top_talkers(tables[0]).collect()}
    assert found == plain.top_talkers(ALL_CONNS) and len(found) > 1


def test_top_talkers_as_destination(spark):
    rows = [conn(f"12:40:0{i}", f"10.0.0.{i}", "10.9.9.9", 80, 4_000_000, 0) for i in range(3)]
    row, = d.detect_top_talkers(batch(spark, rows, CONN_SCHEMA)).collect()
    assert (row.source_ip, row.destination_ip, row.zeek_volume_direction, row.event_severity) == (
        None, "10.9.9.9", "destination", 2)


def test_exfiltration(tables):
    found = {(r.source_ip, r.window_start[11:19], r.destination_ip, r.network_bytes,
              r.zeek_scan_unique_destination_ips, r.alert_count, r.event_severity)
             for r in d.detect_exfiltration(tables[0]).collect()}
    assert found == plain.exfiltration(ALL_CONNS) and {x[-1] for x in found} == {1, 2}


def test_alert_burst(tables):
    found = {(r.source_ip, r.window_start[11:19], r.destination_ip, r.alert_count, r.alert_rule_ids, r.event_severity)
             for r in d.detect_alert_burst(tables[1]).collect()}
    assert found == plain.alert_burst(ALL_IDS) and "3:12:4,3:300:9,3:77:1,3:77:1" in {x[4] for x in found}


def test_alert_burst_repeats_rule_ids(spark):
    rows = [ids(f"12:40:0{i}", "10.0.0.1", "10.0.0.2", 80, 1, rule) for i, rule in enumerate(["b", "a", "b", None])]
    found = d.detect_alert_burst(batch(spark, rows, IDS_SCHEMA), d.AlertBurst(slide="5 minutes")).collect()
    assert [(r.alert_rule_ids, r.alert_count) for r in found] == [("a,b,b", 4)]


@pytest.mark.parametrize("salt", [1, 5])
def test_correlation(tables, salt):
    found = {(r.window_start[11:19], r.window_end[11:19], r.destination_ip, r.network_bytes, r.event_severity)
             for r in d.detect_correlation(tables[1], tables[0], d.Correlation(salt=salt)).collect()}
    assert found == plain.correlation(ALL_IDS, ALL_CONNS) and len(found) == 3


def test_correlation_bounds_are_inclusive(spark):
    flows = batch(spark, [conn(t, "10.0.0.1", "10.0.0.2", 80, 1_000_000, 0)
                          for t in ("12:40:59", "12:41:00", "12:43:00", "12:43:01")], CONN_SCHEMA)
    alerts = batch(spark, [ids("12:41:00", "10.0.0.1", "10.0.0.2", 80, 2, "r"),
                           ids("12:41:00", "10.0.0.1", "10.0.0.2", 80, None, "unrated")], IDS_SCHEMA)
    assert sorted(r.window_end[11:19] for r in d.detect_correlation(alerts, flows).collect()) == ["12:41:00", "12:43:00"]


def test_protocol_anomaly(tables):
    found = {(r.event_timestamp[11:19], r.source_ip, r.destination_port, r.correlation_type, r.event_severity)
             for r in d.detect_protocol_anomaly(tables[0]).collect()}
    assert found == plain.anomalies(ALL_CONNS) and len({x[3] for x in found}) == 5


@pytest.mark.parametrize(("port", "service", "transport", "kind"), [
    (None, "http", "tcp", None), (None, "ssh", "tcp", None), (None, "http", "udp", "http_over_udp"),
    (80, "http", "udp", "http_over_udp"), (81, "http", "udp", "http_unexpected_port"),
    (54, "dns", "udp", "dns_unexpected_port"), (5353, "dns", "udp", None), (2222, "ssh", "tcp", "ssh_unexpected_port"),
])
def test_protocol_anomaly_cases(spark, port, service, transport, kind):
    row = conn("12:40:00", "10.0.0.1", "10.0.0.2", port, 1, 1, service, transport)
    found = d.detect_protocol_anomaly(batch(spark, [row], CONN_SCHEMA)).collect()
    assert [r.correlation_type for r in found] == ([kind] if kind else [])


def test_all_alerts(tables):
    counts = {r.rule_name: r["count"] for r in d.all_alerts(*tables).groupBy("rule_name").count().collect()}
    assert sum(counts.values()) == sum(COUNTS.values()) and len(counts) == 6


@pytest.mark.parametrize(("flush", "expected"), [(True, COUNTS), (False, OPEN_COUNTS)])
def test_streams_agree_with_batch(spark, tmp_path, flush, expected):
    conn_dir = write_lines(tmp_path / "conn", [*CONNS, *([CONN_FLUSH] if flush else []), "{not json"])
    ids_dir = write_lines(tmp_path / "ids", [*IDS, *([IDS_FLUSH] if flush else [])])
    outputs = d.rule_outputs(read_conn_stream(spark, {"path": conn_dir}), read_ids_stream(spark, {"path": ids_dir}))
    started = run_rules(outputs, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    for query in started.values():
        query.awaitTermination()
    batch_outputs = d.rule_outputs(batch(spark, ALL_CONNS, CONN_SCHEMA), batch(spark, ALL_IDS, IDS_SCHEMA))
    for name, count in expected.items():
        got = spark.read.schema(ALERT_SCHEMA).parquet(str(tmp_path / "out" / f"rule={name}"))
        assert got.count() == count, name
        assert got.exceptAll(batch_outputs[name]).isEmpty(), name


def test_late_rows_are_dropped(spark, tmp_path):
    folder = tmp_path / "conn"
    checkpoint, out = str(tmp_path / "ckpt"), str(tmp_path / "out")

    def run():
        stream = read_conn_stream(spark, {"path": str(folder)})
        return drain(d.detect_top_talkers(stream, d.TopTalkers(bytes=1, flows=1)), out, checkpoint)

    write_lines(folder, [conn("07:10:00", "10.0.0.1", "10.0.0.2", 80, 5, 5)], "a.jsonl")
    write_lines(folder, [CONN_FLUSH], "b.jsonl")
    assert run().count() == 2
    # The window 07:10-07:15 was closed by the first run; the restart continues from its checkpoint.
    write_lines(folder, [conn("07:11:00", "10.0.0.7", "10.0.0.2", 80, 5, 5)], "c.jsonl")
    assert run().where("source_ip = '10.0.0.7'").count() == 0


@pytest.mark.parametrize("salt", [1, 4])
def test_stream_correlation_follows_all_rows(spark, tmp_path, salt):
    """Rows that count for nothing still carry event time forward, so that state is let go."""
    quiet = [conn(f"07:{m}:00", "10.9.9.9", "10.9.9.8", 80, 1, 1) for m in range(30, 50, 5)]
    calm = [ids(f"07:{m}:00", "10.9.9.9", "10.9.9.8", 80, 3, "3:1:1") for m in range(30, 50, 5)]
    folders = [write_lines(tmp_path / "conn", CONNS, "a.jsonl"), write_lines(tmp_path / "ids", IDS, "a.jsonl")]
    out = tmp_path / "out"

    def run():
        flows, alerts = (read({"path": f}) for read, f in zip((lambda x: read_conn_stream(spark, x), lambda x: read_ids_stream(spark, x)), folders))
        query = start_query(d.detect_correlation(alerts, flows, d.Correlation(salt=salt)), str(out), str(tmp_path / "ckpt"))
        query.awaitTermination()
        return [p for p in query.recentProgress if p["stateOperators"]]

    first = run()
    got = {(r.window_start[11:19], r.window_end[11:19], r.destination_ip, r.network_bytes, r.event_severity)
           for r in spark.read.schema(ALERT_SCHEMA).parquet(str(out)).collect()}
    assert got == plain.correlation(IDS, CONNS)
    assert first[-1]["stateOperators"][0]["numRowsTotal"] > 0
    write_lines(tmp_path / "conn", quiet, "b.jsonl")
    write_lines(tmp_path / "ids", calm, "b.jsonl")
    last = run()[-1]
    assert last["eventTime"]["watermark"] == "2031-09-04T07:44:30.000Z"
    assert last["stateOperators"][0]["numRowsTotal"] == 0


@pytest.mark.parametrize(("policy", "watermark"), [("min", "07:29:30"), ("max", "07:49:30"), (None, "07:29:30")])
def test_watermark_policy_of_a_query(spark, tmp_path, policy, watermark):
    flows = write_lines(tmp_path / "conn", [conn("07:30:00", "10.0.0.1", "10.0.0.2", 80, 1, 1)])
    alerts = write_lines(tmp_path / "ids", [ids("07:50:00", "10.0.0.1", "10.0.0.2", 80, 1, "r")])
    found = d.detect_correlation(read_ids_stream(spark, {"path": alerts}), read_conn_stream(spark, {"path": flows}))
    query = start_query(found, str(tmp_path / "out"), str(tmp_path / "ckpt"), watermark_policy=policy)
    query.awaitTermination()
    assert query.recentProgress[-1]["eventTime"]["watermark"] == f"2031-09-04T{watermark}.000Z"
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
    with pytest.raises(ValueError):
        start_query(found, str(tmp_path / "o"), str(tmp_path / "c"), watermark_policy="middle")
