import json
import os
import random
from datetime import datetime

import plain_rules as plain
import pyarrow.parquet as pq
import pytest
from pyspark import StorageLevel
from fixture_rows import CONNS, IDS, batch, conn, write_lines

from sentrylake.schemas import CONN_SCHEMA, IDS_SCHEMA, LAKE_SCHEMA, align, to_dotted, to_flat, union_events
from sentrylake.sinks.documents import ids_key, to_serving, with_event_key, write_alerts, write_results
from sentrylake.sinks.lake import newest_by_key, overwrite_run, upsert, write_lake
from sentrylake.operators.detections import detect_protocol_anomaly
from sentrylake.sources.conn_log import read_conn_log
from sentrylake.sources.ids_blocks import read_ids_blocks
from sentrylake.sources.lake import lake_files, lake_snapshots, read_lake
from sentrylake.sources.streams import decode_json, quarantined_stream, read_conn_stream, read_events_jsonl, read_ids_stream, split_quarantine
from sentrylake.streaming.run import drain
from pyspark.sql import functions as F

GOOD = ("1331901000.010000 C1 10.0.0.1 1000 10.0.0.2 80 tcp http 1.5 100 200 SF T 0 ShAD 3 40 4 40 {parents}")


def conn_line(**changes):
    names = ("ts uid orig_h orig_p resp_h resp_p proto service duration orig_bytes resp_bytes conn_state local_orig missed_bytes "
             "history orig_pkts orig_ip_bytes resp_pkts resp_ip_bytes tunnel_parents").split()
    values = dict(zip(names, GOOD.format(parents="-").split()))
    return "\t".join({**values, **changes}.values())


def parse(spark, tmp_path, *lines):
    events, rejects = read_conn_log(spark, write_lines(tmp_path / "log", list(lines), "conn.log"))
    return events.orderBy("zeek_conn_uid").collect(), rejects.collect()


def test_conn_line(spark, tmp_path):
    (e,), rejects = parse(spark, tmp_path, "#fields ts uid", "", "   ", conn_line())
    assert rejects == []
    assert e.event_timestamp == datetime(2012, 3, 16, 12, 30, 0, 10000)
    assert (e.network_bytes, e.network_packets, e.source_port, e.zeek_conn_duration) == (300, 7, 1000, 1.5)
    assert e.message == "http tcp connection 10.0.0.1:1000 -> 10.0.0.2:80"
    assert e.related_ip == ["10.0.0.1", "10.0.0.2"] and e.zeek_conn_local_orig is True
    assert e.event_original == conn_line()


def test_conn_missing_values(spark, tmp_path):
    lines = [conn_line(uid="a", service="-", orig_bytes="-", resp_pkts="-", tunnel_parents="-", local_orig="-"),
             conn_line(uid="b", tunnel_parents="(empty)", local_orig="F", resp_h="-"),
             conn_line(uid="c", tunnel_parents="x,,y", local_orig="what", service="(empty)")]
    (a, b, c), rejects = parse(spark, tmp_path, *lines)
    assert rejects == []
    assert (a.network_protocol, a.source_bytes, a.network_bytes, a.destination_packets) == (None, 0, 200, 0)
    assert a.message.startswith("tcp connection") and a.zeek_conn_tunnel_parents == [] and a.zeek_conn_local_orig is None
    assert b.zeek_conn_tunnel_parents == [] and b.zeek_conn_local_orig is False and b.related_ip == ["10.0.0.1"]
    assert b.message == "http tcp connection 10.0.0.1:1000 -> None:80"
    assert c.zeek_conn_tunnel_parents == ["x", "y"] and c.zeek_conn_local_orig is None and c.zeek_conn_service is None


def test_conn_rejects(spark, tmp_path):
    events, rejects = parse(spark, tmp_path, conn_line() + " extra", conn_line().rsplit("\t", 1)[0], conn_line(orig_p="http"),
                            conn_line(ts="-"), conn_line(duration="long"), conn_line())
    assert len(events) == 1
    assert sorted(r.reason for r in rejects) == ["duration", "field count", "field count", "orig_p", "ts"]


FULL = """[**] [1:2000:3] BAD traffic here [**]
[Classification: Attempted Leak] [Priority: 2]
03/16-07:30:00.010000 10.0.0.1:1000 -> 10.0.0.2:80
TCP TTL:64 TOS:0x0 ID:7 IpLen:20 DgmLen:60 DF
***AP*** Seq: 0xAB  Ack: 0x1  Win: 0x2000  TcpLen: 20
[Xref => url,one]
[Xref => url,two]"""
NO_CLASS = FULL.replace("[Classification: Attempted Leak] [Priority: 2]\n", "").replace("1:2000:3", "1:2001:1")
NO_PORTS = "[**] [1:2002:1] PING [**]\n[Classification: Misc] [Priority: 3]\n03/16-07:30:01.000000 10.0.0.1 -> 10.0.0.2\nICMP TTL:64"
UDP = """[**] [1:2003:1] UDP thing [**]
[Classification: Misc] [Priority: 3]
03/16-07:30:02.500000 10.0.0.1:5 -> 10.0.0.2:53
UDP TTL:64 TOS:0x0 ID:8 IpLen:20 DgmLen:60
Len: 32"""
SHORT, NO_RULE = "[**] [1:2004:1] short [**]\nx", "nothing\nof\nthis"
BLOCKS = [FULL, NO_CLASS, NO_PORTS, UDP, SHORT, NO_RULE]


def read_blocks(spark, tmp_path, text, **kw):
    (tmp_path / "alert.1").write_bytes(text.encode())
    events, rejects = read_ids_blocks(spark, str(tmp_path), glob="alert.*", **kw)
    return {r.rule_id: r for r in events.collect()}, rejects.count()


def check_blocks(found, rejects):
    assert rejects == 2 and set(found) == {"1:2000:3", "1:2001:1", "1:2002:1", "1:2003:1"}
    full = found["1:2000:3"]
    assert full.event_timestamp == datetime(2012, 3, 16, 7, 30, 0, 10000)
    assert (full.rule_name, full.rule_category, full.event_severity) == ("BAD traffic here", "Attempted Leak", 2)
    assert (full.source_ip, full.source_port, full.destination_ip, full.destination_port) == ("10.0.0.1", 1000, "10.0.0.2", 80)
    assert (full.network_transport, full.snort_ip_ttl, full.snort_ip_flags, full.snort_packet_len) == ("tcp", 64, "DF", 60)
    assert (full.snort_tcp_seq, full.snort_tcp_len, full.snort_xref, full.snort_extra) == ("0xAB", 20, "url,two", None)
    assert full.log_file_path.endswith("alert.1") and full.event_original == FULL
    assert found["1:2001:1"].event_severity is None and found["1:2001:1"].snort_tcp_len == 20
    ping = found["1:2002:1"]
    assert ping.event_timestamp is None and ping.source_ip is None and ping.event_severity == 3 and ping.related_ip is None
    udp = found["1:2003:1"]
    assert (udp.network_transport, udp.snort_ip_flags, udp.snort_tcp_seq) == ("udp", None, None)
    assert udp.snort_extra == ["Len: 32"]


def test_ids_blocks(spark, tmp_path):
    check_blocks(*read_blocks(spark, tmp_path, "\n\n".join(BLOCKS) + "\n"))


def test_ids_blocks_with_odd_separators(spark, tmp_path):
    check_blocks(*read_blocks(spark, tmp_path, "\n\n\n" + "\n \t\n\n".join(BLOCKS) + "\n\n \n"))


def test_ids_blocks_crlf(spark, tmp_path):
    check_blocks(*read_blocks(spark, tmp_path, "\r\n\r\n".join(b.replace("\n", "\r\n") for b in BLOCKS), newline="\r\n"))


def test_ids_blocks_crlf_read_with_the_wrong_line_ending(spark, tmp_path):
    check_blocks(*read_blocks(spark, tmp_path, "\r\n \r\n".join(b.replace("\n", "\r\n") for b in BLOCKS)))


@pytest.mark.parametrize("newline, parted", [("\n", "\n\n"), (None, "\n\n"), (None, "\r\n \t\r\n\x0b\r\n")])
def test_ids_blocks_over_file_splits(spark, tmp_path, newline, parted):
    text = parted.join(FULL.replace("1:2000:3", f"1:{i}:1") for i in range(500))
    (tmp_path / "alert.1").write_bytes(text.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1009")
    try:
        events, rejects = read_ids_blocks(spark, str(tmp_path), newline=newline)
        assert events.rdd.getNumPartitions() > 10
        assert events.select("rule_id").distinct().count() == events.count() == 500 and rejects.isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_decode_json(spark):
    rows = [json.dumps(CONNS[0]), "{broken", json.dumps({**CONNS[1], "source.port": "many"}), None,
            json.dumps({**CONNS[2], "@timestamp": "2031-09-04T07:15:20+00:00"}), json.dumps({**CONNS[3], "@timestamp": "never"})]
    raw = spark.createDataFrame([(r,) for r in rows], "value string")
    good, bad = split_quarantine(decode_json(raw, CONN_SCHEMA))
    assert good.count() == 3 and bad.count() == 2
    assert good.where("source_port is null").select("source_ip").first()[0] == "10.4.7.9"
    assert {r._corrupt_record for r in bad.collect()} == {rows[1], rows[5]}


def test_streams_start_and_quarantine(spark, tmp_path):
    folder = write_lines(tmp_path / "conn", [CONNS[0], "{broken", CONNS[1]])
    stream = read_conn_stream(spark, {"path": folder}, watermark=None)
    assert drain(stream, str(tmp_path / "o1"), str(tmp_path / "c1")).count() == 2
    bad = quarantined_stream(spark, {"path": folder}, CONN_SCHEMA)
    row, = drain(bad, str(tmp_path / "o2"), str(tmp_path / "c2")).collect()
    assert (row.raw_value, row.reason) == ("{broken", "unreadable document") and row.source.endswith("part-0.jsonl") and row.arrived_at


def test_start_at_the_end_of_a_folder(spark, tmp_path):
    folder = write_lines(tmp_path / "conn", CONNS[:3], "old.jsonl")
    os.utime(tmp_path / "conn/old.jsonl", (1_700_000_000, 1_700_000_000))
    with pytest.raises(ValueError):
        read_conn_stream(spark, {"path": folder}, starting="latest")
    source = {"path": folder, "since": "2024-01-01 00:00:00"}
    for added, expected in (([], 0), (CONNS[3:5], 2), (CONNS[5:6], 3)):
        if added:
            write_lines(tmp_path / "conn", added, f"new{expected}.jsonl")
        latest = read_conn_stream(spark, source, starting="latest", watermark=None)
        assert drain(latest, str(tmp_path / "out"), str(tmp_path / "ckpt")).count() == expected


def test_dead_letters_keep_text_reason_and_origin(spark, tmp_path):
    rows = ["{cut", '{"source.ip":"1.1.1.1"}', json.dumps({**CONNS[0], "@timestamp": "soon"}), json.dumps(CONNS[1]), "", "{}"]
    folder = write_lines(tmp_path / "j", rows)
    good, bad = read_events_jsonl(spark, folder, CONN_SCHEMA)
    assert good.count() == 1 and good.columns == [c for c in good.columns if not c.startswith("_")]
    found = {r.raw_value: (r.reason, r.source.endswith(".jsonl"), r.arrived_at is not None) for r in bad.collect()}
    assert found == {rows[0]: ("unreadable document", True, True), rows[1]: ("no event_timestamp", True, True),
                     rows[2]: ("unreadable event_timestamp", True, True), rows[5]: ("no event_timestamp", True, True)}


def test_names_and_alignment(spark):
    events = batch(spark, CONNS, CONN_SCHEMA).drop("event_time")
    assert to_dotted(events).columns == CONN_SCHEMA.names and to_flat(to_dotted(events)).columns == events.columns
    assert align(events, LAKE_SCHEMA).schema.names == LAKE_SCHEMA.names and len(LAKE_SCHEMA) == 50
    both = union_events(events, batch(spark, IDS, IDS_SCHEMA))
    assert both.count() == len(CONNS) + len(IDS) and both.where("event_severity is null").count() == len(CONNS)


def test_lake_in_batch_and_stream(spark, tmp_path):
    conns, ids = batch(spark, CONNS, CONN_SCHEMA), batch(spark, IDS, IDS_SCHEMA)
    write_lake(union_events(conns, ids), str(tmp_path / "lake"))
    table = read_lake(spark, str(tmp_path / "lake"))
    total = len(CONNS) + len(IDS)
    assert table.schema == LAKE_SCHEMA and table.count() == total
    assert lake_files(spark, str(tmp_path / "lake")).agg(F.sum("record_count")).first()[0] == total
    commit, = lake_snapshots(spark, str(tmp_path / "lake")).collect()
    assert (commit.operation, commit.record_count) == ("write", total) and len(commit.snapshot_id) == 36
    write_lake(union_events(conns, ids), str(tmp_path / "twice"))
    write_lake(union_events(conns.limit(2), ids), str(tmp_path / "twice"))
    assert sorted(c.record_count for c in lake_snapshots(spark, str(tmp_path / "twice")).collect()) == [len(IDS) + 2, total]
    pruned = table.where("event_date = date'2031-09-04' and event_dataset = 'snort.alert'")
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().toString() and pruned.count() == len(IDS)

    c, i = write_lines(tmp_path / "c", CONNS), write_lines(tmp_path / "i", IDS)
    for _ in range(2):  # the second run finds nothing new
        rows = union_events(read_conn_stream(spark, {"path": c}, watermark=None), read_ids_stream(spark, {"path": i}, watermark=None))
        write_lake(rows, str(tmp_path / "streamed"), str(tmp_path / "ckpt")).awaitTermination()
    streamed = read_lake(spark, str(tmp_path / "streamed"))
    assert streamed.count() == total and streamed.exceptAll(table).isEmpty()


def test_runs_are_replaced_and_documents_loaded_once(spark, tmp_path):
    events = batch(spark, CONNS, CONN_SCHEMA).withColumn("event_id", F.col("zeek_conn_uid"))
    rows = to_serving(events.drop("event_time"), "r1")
    assert json.loads(rows.orderBy("event_id").first().payload)["destination.port"] == 21
    overwrite_run(rows, str(tmp_path / "t"))
    overwrite_run(to_serving(events.drop("event_time"), "r2"), str(tmp_path / "t"))
    overwrite_run(rows.limit(3), str(tmp_path / "t"))
    assert {r.benchmark_id: r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("benchmark_id").count().collect()} == {
        "r1": 3, "r2": len(CONNS)}


def delivery(spark, rows):
    return spark.createDataFrame([(i, day, datetime(2031, 9, 4, 7, m) if m is not None else None, x) for i, day, m, x in rows],
                                 "event_id string, day string, event_timestamp timestamp, message string")


def test_upsert_finds_ids_that_move(spark, tmp_path):
    """Random loads in which ids change their partition, against a dictionary."""
    rng, target, want = random.Random(4), str(tmp_path / "moved"), {}
    schema = "event_id int, day string, seq int, text string"
    for load in range(6):
        rows = [(rng.randrange(40), rng.choice(["a", "b b", "c/d", None]), rng.randrange(50), f"t{rng.randrange(3)}") for _ in range(rng.choice([3, 25]))]
        rows.append((None, "a", load, "no id"))
        if load == 3:
            rows = [(i, "b b", 99, "all move") for i in range(40)]
        upsert(spark.createDataFrame(rows, schema), ["event_id"], "seq", path=target, partition_by=["day"])
        hashed = {tuple(r)[:4]: r.h for r in spark.createDataFrame(rows, schema).withColumn("h", F.xxhash64("event_id", "day", "seq", "text")).collect()}
        for r in rows:
            if r[0] not in want or (r[2], hashed[r]) > want[r[0]][1]:
                want[r[0]] = (r, (r[2], hashed[r]))
        got = sorted((tuple(r) for r in spark.read.schema(schema).parquet(target).select("event_id", "day", "seq", "text").collect()), key=str)
        assert got == sorted((r for r, _ in want.values()), key=str), load


def test_upsert_into_a_folder_without_id_table(spark, tmp_path):
    schema, target = "event_id int, day string, seq int", str(tmp_path / "old")
    spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], schema).write.partitionBy("day").parquet(target)
    upsert(spark.createDataFrame([(1, "b", 2), (3, "c", 0)], schema), ["event_id"], "seq", path=target, partition_by=["day"])
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(target).select("event_id", "day", "seq").collect())
    assert got == [(1, "b", 2), (2, "a", 1), (3, "b", 1)]


def test_upsert_keeps_the_latest_delivery(spark, tmp_path):
    target = str(tmp_path / "t")
    first = [("a", "d1", 5, "a5"), ("a", "d1", 3, "a3"), ("b", "d1", 4, "b4"), ("c", "d2", 1, "c1"), (None, "d2", 1, "n1"), ("a", "d1", 5, "a5")]
    upsert(delivery(spark, first), ["event_id"], "event_timestamp", path=target, partition_by=["day"])
    untouched = sorted((tmp_path / "t/day=d2").glob("*.parquet"))
    second = [("a", "d1", 4, "older"), ("b", "d1", 6, "b6"), ("d", "d1", None, "d?"), ("b", "d1", None, "late?")]
    upsert(delivery(spark, second), ["event_id"], "event_timestamp", path=target, partition_by=["day"])
    got = {(r.event_id, r.message) for r in spark.read.parquet(target).collect()}
    assert got == {("a", "a5"), ("b", "b6"), ("c", "c1"), ("d", "d?"), (None, "n1")}
    assert sorted((tmp_path / "t/day=d2").glob("*.parquet")) == untouched and spark.read.parquet(target).count() == 5

    source = tmp_path / "s"
    delivery(spark, first).coalesce(1).write.parquet(str(source))
    for rows in (second, second[:1]):
        stream = spark.readStream.schema(delivery(spark, first).schema).parquet(str(source))
        upsert(stream, ["event_id"], "event_timestamp", path=str(tmp_path / "u"), checkpoint=str(tmp_path / "k")).awaitTermination()
        delivery(spark, rows).coalesce(1).write.mode("append").parquet(str(source))
    streamed = {(r.event_id, r.message) for r in spark.read.parquet(str(tmp_path / "u")).collect()}
    assert streamed == got
    with pytest.raises(ValueError):
        upsert(delivery(spark, first), ["event_id"], "event_timestamp")


def test_lake_files_are_sorted_and_filtered(spark, tmp_path):
    write_lake(union_events(batch(spark, CONNS, CONN_SCHEMA), batch(spark, IDS, IDS_SCHEMA)), str(tmp_path / "lake"))
    files = list((tmp_path / "lake").rglob("*.parquet"))
    for file in files:
        times = pq.read_table(file, columns=["event_timestamp"]).column(0).to_pylist()
        assert times == sorted(times)
    # A Bloom filter answers for an address that no row has: nothing is read.
    size = sum(file.stat().st_size for file in files)
    assert size > 0 and spark.read.parquet(str(tmp_path / "lake")).where("source_ip = '10.4.7.10'").count() == 0


def test_keys_and_results(spark, tmp_path):
    ids = batch(spark, IDS[:1], IDS_SCHEMA).drop("event_time")
    keyed = with_event_key(ids, ids_key()).first()
    assert keyed.key == "3:510:2|2031-09-04T07:17:20+00:00|172.16.5.5|52525|100.64.8.11|8883"
    assert json.loads(keyed.value)["rule.id"] == "3:510:2"
    assert with_event_key(ids.withColumn("source_port", F.lit(None).cast("int")), ids_key()).first().key.count("|") == 4
    write_results(ids.select("rule_id", "related_ip"), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r/csv")).columns == ["rule_id"]
    assert spark.read.json(str(tmp_path / "r/json")).count() == 1
    drawn = spark.range(50).select("id", F.uuid().alias("u"))  # another computation would draw others
    for kept in (False, True):
        if kept:
            drawn.persist()
        write_results(drawn, str(tmp_path / "u"))
        csv, again = spark.read.option("header", True).csv(str(tmp_path / "u/csv")), spark.read.json(str(tmp_path / "u/json"))
        assert csv.select("u").exceptAll(again.select("u")).isEmpty() and csv.count() == 50
        assert (drawn.storageLevel != StorageLevel.NONE) == kept
    drawn.unpersist()


def test_alert_documents_in_batch_and_stream(spark, tmp_path):
    write_alerts(detect_protocol_anomaly(batch(spark, CONNS, CONN_SCHEMA)), str(tmp_path / "b"))
    source = write_lines(tmp_path / "c", [*CONNS, conn("07:25:00", None, None, None, 1, 1)])
    write_alerts(detect_protocol_anomaly(read_conn_stream(spark, {"path": source})), str(tmp_path / "s"), str(tmp_path / "k")).awaitTermination()
    b, s = (spark.read.json(str(tmp_path / x)) for x in "bs")
    assert b.count() == s.count() == len(plain.anomalies(CONNS)) and "source.ip" in b.columns and "@timestamp" in s.columns


def test_newest_by_key_shuffles_rows_once(spark):
    """Of 300 deliveries of an id, equal ones among them, a task hands on one."""
    rows = spark.range(0, 3000, 1, 4).selectExpr("if(id % 10 = 9, NULL, id % 10) AS k", "if(id % 7 = 0, NULL, id % 50) AS at", "concat('x', id % 90) AS text")
    found = newest_by_key(rows, ["k"], "at")
    shown = found._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Exchange hashpartitioning") == 1 and "Join" not in shown
    got = {r.k: (r["at"], r.text) for r in found.collect()}
    assert len(got) == found.count() == 10
    best = {}
    for r in rows.withColumn("h", F.xxhash64("k", "at", "text")).collect():
        best[r.k] = max(best.get(r.k, ((-1, -2 ** 63), None)), ((-1 if r["at"] is None else r["at"], r.h), (r["at"], r.text)))
    assert got == {k: v for k, (_, v) in best.items()}
