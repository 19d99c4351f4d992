"""Pane cascades, silent inputs and the progress of running queries."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from fixture_rows import CONN_FLUSH, CONNS, IDS, IDS_FLUSH, conn, write_lines
from pyspark.sql import functions as F

from sentrylake.operators import detections as d
from sentrylake.operators.joins import interval_join
from sentrylake.plans import adapter, detect
from sentrylake.schemas import ALERT_SCHEMA
from sentrylake.sources.streams import read_conn_stream, read_ids_stream
from sentrylake.streaming.eventtime import with_event_time
from sentrylake.streaming.progress import progress_to, read_progress
from sentrylake.streaming.run import drain

T0 = datetime(2024, 5, 1, 10, 0, 0)


@pytest.mark.parametrize(("name", "cfg"), [
    ("port_scan", d.PortScan()), ("exfiltration", d.Exfiltration()), ("alert_burst", d.AlertBurst())])
def test_pane_cascade_raises_the_same_alerts(spark, tmp_path, name, cfg):
    conn_dir = write_lines(tmp_path / "conn", [*CONNS, CONN_FLUSH])
    ids_dir = write_lines(tmp_path / "ids", [*IDS, IDS_FLUSH])
    found = []
    for panes in (False, True):
        rules = replace(d.RuleSet(), **{name: replace(cfg, stream_panes=panes)})
        alerts = d.run_rule(name, read_conn_stream(spark, {"path": conn_dir}), read_ids_stream(spark, {"path": ids_dir}), rules)
        drain(alerts, str(tmp_path / f"out{panes}"), str(tmp_path / f"ckpt{panes}"))
        found.append(spark.read.schema(ALERT_SCHEMA).parquet(str(tmp_path / f"out{panes}")))
    assert found[0].count() > 0
    assert found[0].exceptAll(found[1]).isEmpty() and found[1].exceptAll(found[0]).isEmpty()


def files(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).parquet(str(folder))


def counted(streams):
    both = streams[0].unionByName(streams[1])
    return both.groupBy(F.window("event_time", "1 minute"), "who").agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("start"), "who", "n")


def test_a_silent_input_does_not_hold_back_windows(spark, tmp_path):
    schema = "event_timestamp timestamp, who string"
    at = [(T0 + timedelta(seconds=s), "busy") for s in (1, 2, 61, 200)]
    busy = files(spark, tmp_path / "busy", at, schema)
    silent = files(spark, tmp_path / "silent", [], schema)
    clock = files(spark, tmp_path / "clock", [(T0 + timedelta(seconds=130),)], "timestamp timestamp")

    def run(name, **kw):
        streams = [with_event_time(x, delay="10 seconds", **kw) for x in (busy, silent)]
        return sorted((r.start, r.who, r.n) for r in drain(counted(streams), str(tmp_path / f"out-{name}"), str(tmp_path / f"ckpt-{name}")).collect())

    assert run("plain") == []
    # The present is 130 s: the silent input has come to 125 s, less 10 s of delay.
    first = [(T0, "busy", 2)]
    assert run("idle", idle="5 seconds", clock=clock) == first
    # Rows of the silent input that are no older than that still count; older ones do not; heartbeats are never counted.
    files(spark, tmp_path / "silent", [(T0 + timedelta(seconds=s), "late") for s in (30, 116, 118)], schema)
    files(spark, tmp_path / "clock", [(T0 + timedelta(seconds=400),)], "timestamp timestamp")
    minute = timedelta(minutes=1)
    assert run("idle", idle="5 seconds", clock=clock) == sorted(
        [*first, (T0 + minute, "busy", 1), (T0 + minute, "late", 2), (T0 + 3 * minute, "busy", 1)])


def test_the_default_clock_is_the_present(spark):
    rows = spark.readStream.format("rate").load().select(F.col("timestamp").alias("event_timestamp"), F.lit("x").alias("who"))
    timed = with_event_time(rows, idle="5 seconds")
    assert timed.columns == ["event_timestamp", "who", "event_time"] and timed.isStreaming


def test_rows_dropped_by_the_watermark_are_counted(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "conn", str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        stream = read_conn_stream(spark, {"path": str(folder)})
        drain(d.detect_top_talkers(stream, d.TopTalkers(bytes=1, flows=1)), out, checkpoint, name="talkers")

    path = str(tmp_path / "progress")
    with progress_to(spark, path, every=2):
        write_lines(folder, [conn("07:10:00", "10.0.0.1", "10.0.0.2", 80, 5, 5)], "a.jsonl")
        write_lines(folder, [CONN_FLUSH], "b.jsonl")
        run()
        write_lines(folder, [conn("07:11:00", "10.0.0.7", "10.0.0.2", 80, 5, 5)], "c.jsonl")
        run()
    rows = read_progress(spark, path)
    total = rows.groupBy("query").agg(F.sum("input_rows").alias("read"), F.sum("late_rows").alias("late"), F.max("state_rows").alias("state")).collect()
    # The late flow reaches the grouping as two rows, one for each of its hosts.
    assert [(r.query, r.read, r.late) for r in total] == [("talkers", 3, 2)] and total[0].state > 0
    timed = rows.where("newest_event IS NOT NULL").collect()
    assert all(r.batch_ms > 0 and r.event_lag_ms is not None and r.started.year > 2000 for r in timed)
    assert rows.select("run_id").distinct().count() == 2


@pytest.mark.parametrize("salt", [None, 3])
def test_a_stream_join_compares_rows_near_in_time(spark, tmp_path, capsys, salt):
    # One source all day long: rows of one key are told apart by bins, and pairs on their edges are kept, each once.
    left = [("a", T0 + timedelta(minutes=m)) for m in range(0, 600, 7)] + [("b", T0), (None, T0), ("a", None)]
    right = [("a", T0 + timedelta(minutes=m), m) for m in range(0, 600, 5)] + [("b", T0 + timedelta(hours=1), -1), (None, T0, -2), ("a", None, -3)]
    alerts = files(spark, tmp_path / "left", left, "who string, t timestamp").withWatermark("t", "30 seconds")
    flows = files(spark, tmp_path / "right", right, "who string, u timestamp, n int").withWatermark("u", "30 seconds")
    joined = interval_join(alerts, flows, "who", "t", "u", "1 hour", "-10 minutes", salt=salt)
    joined.explain()
    keys = next(line for line in capsys.readouterr().out.splitlines() if "StreamingSymmetricHashJoin [" in line).split("]")[0]
    assert "_bin" in keys
    found = drain(joined.select("who", "t", "u", "n"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    wanted = sorted((k, t, u, n) for k, t in left if k and t for o, u, n in right
                    if o == k and u and t - timedelta(minutes=10) <= u <= t + timedelta(hours=1))
    assert sorted(map(tuple, found.collect())) == wanted


@pytest.mark.parametrize("name", ["port_scan", "correlation"])
def test_paced_streams_raise_the_same_alerts_with_less_state(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(adapter, "FEED_ROWS", 20)
    sf_dir, found, state = "/root/testdata/sf0.001", [], []
    for paced in (False, True):
        path = str(tmp_path / f"progress{paced}")
        with progress_to(spark, path):
            streams = [read(spark, sf_dir, paced=paced) for read in (adapter.conn_stream, adapter.ids_stream)]
            found.append(drain(d.run_rule(name, *streams, detect.RULES), str(tmp_path / f"out{paced}"), str(tmp_path / f"ckpt{paced}")))
        rows = read_progress(spark, path)
        state.append(rows.agg(F.max("state_rows")).first()[0])
        assert rows.agg(F.sum("late_rows")).first()[0] == 0
        assert (rows.where("input_rows > 0").count() > 1) == paced
    assert found[0].count() > 0
    assert found[0].exceptAll(found[1]).isEmpty() and found[1].exceptAll(found[0]).isEmpty()
    assert 2 * state[1] < state[0]


def test_a_feed_is_written_in_order_of_time(spark, tmp_path):
    # Many events at one time, some without any, in no order: each file has events, each write all files of its trigger.
    rows = [(T0 + timedelta(minutes=(37 * i) % 100 if i % 3 else 50), i) for i in range(300)] + [(None, -1), (None, -2)]
    events = spark.createDataFrame(rows, "event_timestamp timestamp, n long").repartition(4)
    path = str(tmp_path / "feed")
    adapter.write_feed(events, path, 30)
    written = spark.read.parquet(path).selectExpr("*", "_metadata.file_path f", "_metadata.file_modification_time w")
    files = written.groupBy("f", "w").agg(F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi")).orderBy("f").collect()
    assert len(files) > 2 * adapter.FEED_FILES
    groups = [files[i:i + adapter.FEED_FILES] for i in range(0, len(files), adapter.FEED_FILES)]
    for now, then in zip(groups, groups[1:], strict=False):
        assert max(f.w for f in now) < min(f.w for f in then) and max(f.hi for f in now) < min(f.lo for f in then)
    assert sorted(r.n for r in written.collect()) == sorted(n for _, n in rows)


def test_events_are_shuffled_before_they_are_normalised(spark, tmp_path):
    rows = [(i, T0 + timedelta(minutes=(37 * i) % 100) if i % 9 else None, i % 40 if i % 5 else None,
             "view" if i % 2 else "error", 0.5 * i if i % 4 else None, f'{{"k": {i % 11}}}') for i in range(400)]
    rows += rows[:20]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    ordered = adapter._in_order(events.repartition(3))
    plan = ordered._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.index("get_json_object") < plan.index("RepartitionByExpression")
    ordered.write.parquet(f"{tmp_path}/events")
    assert sorted(map(str, ordered.collect())) == sorted(map(str, adapter._normalised(events).collect()))
    ranges = []
    for file in (tmp_path / "events").glob("*.parquet"):
        times = [r.event_timestamp for r in spark.read.parquet(str(file)).collect()]
        known = [t for t in times if t is not None]
        assert known == sorted(known) and times[len(times) - len(known):] == known
        ranges += [(min(known), max(known))] if known else []
    ranges.sort()
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
