import random
from datetime import datetime, timedelta

import plain_rules as plain
import pytest
from fixture_rows import CONNS, IDS, batch
from pyspark.sql import functions as F

from sentrylake.operators import aggregates as g
from sentrylake.operators import filters as f
from sentrylake.operators import runs as r
from sentrylake.operators import search as s
from sentrylake.operators.corpus import derive_alerts, multiplier, scale_out
from sentrylake.operators.detections import PORT_SCAN_RULE, Correlation, PortScan, RuleSet, TopTalkers, all_alerts, detect_port_scan
from sentrylake.operators.joins import alert_latency, count_delta, evidence_for, heavy_keys, interval_join, missing_rules
from sentrylake.schemas import CONN_SCHEMA, IDS_SCHEMA, LAKE_SCHEMA

T0 = datetime(2024, 1, 1)


def linear(values, p):
    ordered = sorted(values)
    spot = (len(ordered) - 1) * p
    low = int(spot)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (spot - low)


@pytest.mark.parametrize("kind", ["spread", "ties", "hot", "single"])
def test_exact_percentiles(spark, kind):
    rng = random.Random(3)
    rows = {
        "spread": [(rng.choice("ab"), rng.uniform(-5, 5)) for _ in range(3000)],
        "ties": [(rng.choice("ab"), float(rng.randint(0, 3))) for _ in range(3000)],
        "hot": [("a" if i % 3 else "b", rng.gauss(0, 1e-6) if i % 7 else 1e9) for i in range(3000)],
        "single": [("a", 4.0), (None, 5.0), (None, 7.0), ("c", None)],
    }[kind]
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    found = g.exact_percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", probs).collect()
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert {x.k for x in found} == set(groups)
    for x in found:
        for name, p in probs.items():
            assert x[name] == pytest.approx(linear(groups[x.k], p), rel=1e-12), (x.k, name)


def test_exact_percentiles_of_a_large_group(spark):
    """More values than the sketch keeps, with few and with many percentiles."""
    values = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("double").alias("v"), (F.col("id") % 2).alias("k"))
    probs = {f"p{i}": i / 20 for i in range(21)}
    built_in = values.groupBy("k").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()]).orderBy("k").collect()
    got = g.exact_percentiles(values, ["k"], "v", probs, accuracy=200).orderBy("k").collect()
    for x, y in zip(got, built_in, strict=True):
        assert list(x) == pytest.approx(list(y), rel=1e-12)


def test_stored_sketches_of_three_runs(spark, tmp_path):
    values = spark.range(90_000).select((F.col("id") % 3).alias("run"), F.lit("q").alias("query"), F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double").alias("sample_ms"))
    for run in range(3):  # each run stores its own
        g.run_sketches(values.where(f"run = {run}"), ["run", "query"]).write.mode("append").parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    row = g.sketched_percentiles(stored, ["query"], {"p50": 0.5, "p95": 0.95}).first()
    assert row.iterations == 90_000
    for name, p in (("p50", 0.5), ("p95", 0.95)):
        rank = values.where(F.col("sample_ms") <= row[name]).count() / 90_000
        assert abs(rank - p) <= 2 / 2000
    assert g.run_sketches(values.where("false"), ["run"]).count() == 0


def test_latency_summary(spark):
    rows = spark.createDataFrame([("q", float(i)) for i in range(5)] + [(None, 1.0), ("none", None)], "query string, sample_ms double")
    found = {x.query: x for x in g.latency_summary(rows, ["query"]).collect()}
    assert found["q"].p95_ms == 3.8 and found["q"].avg_ms == 2.0 and found["q"].iterations == 5
    assert found[None].p50_ms == 1.0
    assert (found["none"].iterations, found["none"].p50_ms, found["none"].max_ms) == (0, None, None)


def test_row_index_is_dense_and_ordered(spark):
    keys = random.Random(1).sample(range(10**9), 5000) + [0, 10**12]
    found = g.row_index(spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(7), "k").collect()
    assert [x.k for x in sorted(found, key=lambda x: x.row_index)] == sorted(keys)
    assert sorted(x.row_index for x in found) == list(range(len(keys)))


@pytest.mark.parametrize(("lower", "upper", "width", "salt"), [
    ("0 seconds", "2 minutes", None, 1), ("-1 minutes", "30 seconds", "10 seconds", 1), ("0 seconds", "0 seconds", None, 2),
    ("10 seconds", "1 minute", "7 minutes", 4),
])
def test_interval_join_against_brute_force(spark, lower, upper, width, salt):
    rng = random.Random(5)
    lefts = [("hot" if rng.random() < 0.5 else rng.choice("abc"), rng.randint(0, 900)) for _ in range(150)] + [(None, 5)]
    rights = [("hot" if rng.random() < 0.5 else rng.choice("abc"), rng.randint(0, 900)) for _ in range(300)] + [(None, 5)]
    make = lambda rows, t: spark.createDataFrame(
        [(i, k, T0 + timedelta(seconds=x)) for i, (k, x) in enumerate(rows)], f"{t}_id int, ip string, {t} timestamp")
    units = {"seconds": 1, "minutes": 60, "minute": 60}
    lo, hi = (int(x.split()[0]) * units[x.split()[1]] for x in (lower, upper))
    got = interval_join(make(lefts, "t"), make(rights, "u"), "ip", "t", "u", upper, lower, width, salt).select("t_id", "u_id")
    want = sorted((i, j) for i, (k, x) in enumerate(lefts) for j, (m, y) in enumerate(rights)
                  if k is not None and k == m and x + lo <= y <= x + hi)
    assert sorted((x.t_id, x.u_id) for x in got.collect()) == want


def test_hot_pairs_are_measured_and_split(spark):
    """One source with half of all rows, all in one bin: no task gets more than three times the median."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        at = F.timestamp_seconds(F.lit(1_699_999_920) + F.col("id") % 60)
        right = spark.range(60_000).select(
            F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2000)).alias("ip"), at.alias("u"),
            F.col("id").alias("event"))
        left = right.select("ip").distinct().withColumn("t", F.timestamp_seconds(F.lit(1_699_999_920)))
        heavy = heavy_keys(right, ["ip"]).collect()
        assert [r._pair for r in heavy] == [spark.sql("SELECT xxhash64('hot')").first()[0]] and 30 <= heavy[0]._salts <= 34
        met = interval_join(left, right, "ip", "t", "u", upper="2 minutes")
        sizes = sorted(r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == met.select("event").distinct().count() == 60_000 and len(sizes) == 16
        assert sizes[-1] < 3 * sizes[8]
        plain = interval_join(left, right, "ip", "t", "u", upper="2 minutes", salt=1)
        assert max(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()) >= 30_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_no_rows_no_heavy_keys(spark):
    empty = spark.createDataFrame([], "ip string, t timestamp")
    assert heavy_keys(empty, ["ip"]).count() == 0
    assert heavy_keys(spark.createDataFrame([(None,)] * 9, "ip string"), ["ip"]).count() == 0
    assert interval_join(empty, empty.withColumnRenamed("t", "u"), "ip", "t", "u", upper="1 minute").count() == 0


def test_evidence_with_equal_and_missing_addresses(spark):
    alerts = spark.createDataFrame([("x", ["a", "b", None], "2024-01-01 00:00:00", "2024-01-01 00:10:00"), ("y", ["c"], "2024-01-01 00:00:00", "2024-01-01 00:10:00")],
                                   "alert_id string, related_ip array<string>, window_start string, window_end string")
    at = T0.replace(year=2024, month=1, day=1, hour=0, minute=5)
    events = spark.createDataFrame([(1, "a", "b", at), (2, "b", "a", at), (3, "a", "a", at), (4, None, "a", at), (5, "c", None, at), (6, "c", "a", at), (7, "d", "e", at), (8, None, None, at)],
                                   "event_id int, source_ip string, destination_ip string, event_time timestamp")
    for salt in (None, 1, 3):
        got = sorted(map(tuple, evidence_for(alerts, events, salt=salt).collect()))
        assert got == [("x", 1), ("x", 2), ("x", 3), ("x", 4), ("x", 6), ("y", 5), ("y", 6)]


@pytest.mark.parametrize("salt", [None, 1, 3])
def test_evidence_meets_once(spark, salt):
    conns = batch(spark, CONNS, CONN_SCHEMA).withColumn("event_id", F.col("zeek_conn_uid"))
    alerts = all_alerts(conns, batch(spark, IDS, IDS_SCHEMA)).withColumn("alert_id", F.concat("rule_id", "window_start", "window_end", "message"))
    correlated = alerts.where("rule_name = 'snort_zeek.correlation'")
    # The three alerts begin at 07:17:20 and end with a flow each; each shares both addresses with its flow.
    found = evidence_for(correlated, conns, salt=salt).groupBy("alert_id").count().collect()
    assert sorted(x["count"] for x in found) == [1, 2, 3]
    pairs = evidence_for(alerts, conns, salt=salt, slack="10 seconds")
    assert pairs.count() == pairs.distinct().count() > 0
    scan = evidence_for(alerts.where(F.col("rule_name") == PORT_SCAN_RULE.name), conns, salt=salt)
    sweeps = [x for x in plain.port_scan(CONNS) if x[2] == "10.4.7.9"]
    assert scan.where("alert_id like '%10.4.7.9'").count() == sum(x[3] for x in sweeps) > 0


def test_missing_rules_and_deltas(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "rule_id string")
    alerts = spark.createDataFrame([("a",), ("a",)], "rule_id string")
    assert [x.rule_id for x in missing_rules(expected, alerts).collect()] == ["b"]
    after = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "rule_id string")
    assert {tuple(x) for x in count_delta(alerts, after, ["rule_id"], 1).collect()} == {("a", 2, 3, 1, True), ("b", 0, 1, 1, True)}
    nulls = spark.createDataFrame([(None,), (None,)], "rule_id string")
    assert [tuple(x) for x in count_delta(nulls.limit(1), nulls, ["rule_id"], 2).collect()] == [(None, 1, 2, 1, False)]


def test_alert_latency(spark):
    at = lambda ms: T0 + timedelta(milliseconds=ms)
    events = spark.createDataFrame([("x", at(0)), ("x", at(-500)), ("x", at(6500)), ("y", at(-400_000)), (None, at(0)), ("x", None)],
                                   "id string, ingest_ts timestamp")
    alerts = spark.createDataFrame([("x", at(1500), 1), ("x", at(1500), 2), ("y", at(0), 3), (None, at(5), 4)], "id string, written_at timestamp, n int")
    assert sorted((r.n, r.latency_ms) for r in alert_latency(alerts, events, "id").collect()) == [(1, 1500), (2, 1500)]
    assert alert_latency(alerts, events, "id", window="10 minutes", salt=3).where("id = 'y'").first().latency_ms == 400_000


def test_timelines(spark):
    times = [T0, T0 + timedelta(seconds=59), T0 + timedelta(minutes=3), T0 + timedelta(days=1, minutes=1)]
    rows = spark.createDataFrame([(t,) for t in times], "event_timestamp timestamp")
    assert [x.event_count for x in g.timeline(rows).collect()] == [1, 1, 2]
    for step, size in (("1 minute", 60), ("7 minutes", 420), ("1 hour", 3600), ("1 day", 86400)):
        filled = g.timeline(rows, step, fill=True).collect()
        starts = [x.bucket.timestamp() for x in filled]
        assert sum(x.event_count for x in filled) == 4
        assert starts == sorted(starts, reverse=True) and all(a - b == size for a, b in zip(starts, starts[1:])), step
    assert g.timeline(rows.limit(0), fill=True).count() == 0
    assert len(g.timeline(rows, newest=2).collect()) == 2


def test_filters_and_top_lists(spark):
    conns = batch(spark, CONNS, CONN_SCHEMA)
    assert f.ip_pivot(conns, "100.64.8.13").count() == 2
    assert f.large_transfers(conns).count() == sum(c["network.bytes"] >= 1_000 for c in CONNS) == 10
    assert f.time_range(conns, "2031-09-04 07:17:05", "2031-09-04 07:17:50").count() == 3
    assert f.severity_at_most(batch(spark, IDS, IDS_SCHEMA), 1).count() == 2
    assert [tuple(x) for x in g.top_counts(conns, "source_ip", 2).collect()] == [("10.4.7.9", 6), ("172.16.5.5", 4)]
    assert [tuple(x) for x in g.top_sum(conns, "source_ip", "network_bytes", 1).collect()] == [("10.8.8.8", 13_260_003)]
    assert g.top_sum(conns, "source_ip", "network_bytes", 1, order_by="count").first().source_ip == "10.4.7.9"
    payload = spark.createDataFrame([('{"a.b":"5"}',), ('{"a.b":""}',), ('{"a.b":"x"}',), ("{}",), ('{"a.b":7}',)], "p string")
    assert [x[0] for x in payload.select(f.payload_int("p", "a.b")).collect()] == [5, None, None, None, 7]


def test_corpus(spark):
    n = len(CONNS)
    base = batch(spark, CONNS, CONN_SCHEMA).drop("event_time").repartition(3)
    grown = scale_out(base, "run", target_rows=2 * n + 4).orderBy("benchmark_seq").collect()
    assert [x.benchmark_seq for x in grown] == list(range(1, 2 * n + 5)) and grown[0].event_id == "run-event-1"
    assert grown[n].benchmark_cycle == 1 and grown[n].event_timestamp == grown[0].event_timestamp + timedelta(minutes=1)
    assert [x.source_ip for x in grown[:n]] == [c["source.ip"] for c in sorted(CONNS, key=lambda c: c["@timestamp"])]
    assert scale_out(base, "run", "medium").count() == 10 * n and multiplier(n, 2 * n + 4) == 3
    assert scale_out(base, "run", target_rows=3).count() == 3
    # Doubles and events without a time are numbered too; an id that is there stays.
    odd = base.unionByName(base).unionByName(base.limit(1).withColumn("event_timestamp", F.lit(None).cast("timestamp")))
    odd = odd.withColumn("event_id", F.when(F.col("source_ip") == "10.4.7.9", F.col("zeek_conn_uid")))
    made = scale_out(odd, "run", "small").collect()
    assert sorted(x.benchmark_seq for x in made) == list(range(1, 2 * n + 2))
    assert all(x.event_id == (x.zeek_conn_uid if x.source_ip == "10.4.7.9" else f"run-event-{x.benchmark_seq}") for x in made)

    tagged = scale_out(base, "run", target_rows=n).withColumns({c: F.lit(None).cast("string") for c in ("rule_id", "rule_name", "rule_category")}) \
        .withColumn("event_severity", F.lit(None).cast("int"))
    alerts = derive_alerts(tagged).orderBy("benchmark_seq").collect()
    assert [x.benchmark_seq for x in alerts] == [5, 10, 15] and alerts[1].rule_id == "benchmark.zeek.large_transfer"
    assert alerts[0].event_timestamp - alerts[0].window_start == timedelta(seconds=2)
    only, = derive_alerts(tagged, every=50).collect()
    assert only.benchmark_seq == 1 and only.event_id == "run-alert-1" and only.rule_id == "benchmark.zeek.connection"
    bare = derive_alerts(tagged.withColumns({c: F.lit(None).cast("string") for c in ("event_id", "event_dataset")})).first()
    assert bare.alert_evidence.startswith("event_id=None dataset=None bytes=")
    row = g.corpus_summary(tagged).first()
    assert (row.event_count, row.alert_count, row.dataset_values, row.sample_source_ip) == (n, 3, "zeek.conn", "10.4.7.9")
    assert row.time_range_mid - row.time_range_start == row.time_range_end - row.time_range_mid


def test_run_reports(spark):
    runs = spark.createDataFrame(
        [("a", "q", 100, 1, 10.0), ("b", "q", 300, 2, 20.0), ("b", "r", 300, 2, 5.0), ("c", "q", 300, 3, 0.0)],
        "run_id string, query string, event_count bigint, node_count int, p95_ms double")
    got = {(x.run_id, x.query): (x.data_growth, x.value_growth, x.efficiency) for x in r.scaling_report(runs).collect()}
    assert got == {("a", "q"): (1, 1, 1), ("b", "q"): (3, 2, 1.5), ("b", "r"): (3, None, None), ("c", "q"): (3, None, None)}
    nodes = {(x.run_id, x.query): (x.speedup, x.efficiency) for x in r.node_scaling(runs).collect()}
    assert nodes[("b", "q")] == (0.5, 0.25) and nodes[("c", "q")] == (None, None)
    compared = {x.query: x.ratio for x in r.compare_runs(runs.where("run_id = 'a'"), runs.where("run_id = 'b'")).collect()}
    assert compared == {"q": 2.0, "r": None}
    old = spark.createDataFrame([("a", "phrase_latest_hits", 1.0), ("b", "phrase_latest_hits", 2.0), ("b", "multi_field_latest_hits", 3.0),
                                 ("b", "x", 4.0)], "run_id string, query string, p95_ms double")
    assert {tuple(x) for x in r.alias_map(old, ["run_id"], "p95_ms").collect()} == {
        ("a", "multi_field_latest_hits", 1.0), ("b", "multi_field_latest_hits", 3.0), ("b", "x", 4.0)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path):
    """Listings keep a bounded heap, joins are equi-joins, filters reach the scan, nothing runs in Python."""
    folder = str(tmp_path / "lake")
    spark.createDataFrame([], LAKE_SCHEMA).write.parquet(folder)
    lake = spark.read.parquet(folder).withColumns({"event_time": F.col("event_timestamp"), "event_id": F.col("zeek_conn_uid")})
    assert "TakeOrderedAndProject" in plan(s.latest(lake, 25)) and "TakeOrderedAndProject" in plan(g.top_counts(lake, "source_ip"))
    found = f.eq_filter(f.time_range(lake, "2024-01-01", "2024-01-02"), "source_ip", "10.0.0.1").select("event_id")
    assert "GreaterThanOrEqual(event_timestamp" in plan(found) and "EqualTo(source_ip,10.0.0.1)" in plan(found)
    assert "ReadSchema: struct<event_timestamp:timestamp,source_ip:string,zeek_conn_uid:string>" in plan(found)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alerts = all_alerts(lake, lake, RuleSet(correlation=Correlation(salt=1))).withColumn("alert_id", F.col("message"))
        # Where salts are measured, the sketch's few heavy keys are broadcast, once for each side, and nothing else.
        for text in map(plan, (evidence_for(alerts, lake), all_alerts(lake, lake))):
            assert "approx_top_k" in text and text.count("BroadcastHashJoin") == 2
            assert not any(x in text for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"))
        frames = [alerts, evidence_for(alerts, lake, salt=1), g.latency_summary(lake, ["source_ip"], "network_bytes"),
                  s.match_fuzzy(lake, "message", "connectio"), s.match_trigram(lake, "message", "ssl tcp")]
        for text in map(plan, frames):
            assert not any(x in text for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "BroadcastExchange"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_source_with_a_third_of_the_rows(spark):
    """A hot source gives the same windows as a count by hand, with panes and without."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "10.0.0.1").otherwise(F.concat(F.lit("10.1.0."), F.col("id") % 200)).alias("source_ip"),
        F.concat(F.lit("8.8.8."), F.col("id") % 50).alias("destination_ip"), (F.col("id") % 40).cast("int").alias("destination_port"),
        F.lit(10).cast("bigint").alias("network_bytes"),
        F.timestamp_seconds(F.lit(1_699_999_920) + F.col("id") % 600).alias("event_time"))
    for cfg in (PortScan(), PortScan(panes=False)):
        hot = detect_port_scan(rows, cfg).where("source_ip = '10.0.0.1'")
        wanted = rows.where("source_ip = '10.0.0.1'").groupBy(F.window("event_time", "2 minutes", "30 seconds")).agg(
            F.count("*").alias("n"), F.count_distinct("destination_port").alias("p"), F.count_distinct("destination_ip").alias("i"))
        assert sorted((x.alert_count, x.zeek_scan_unique_destination_ports, x.zeek_scan_unique_destination_ips) for x in hot.collect()) \
            == sorted((x.n, x.p, x.i) for x in wanted.collect())
    assert TopTalkers().flows == 3


@pytest.mark.parametrize("dialect", ["search", "sql"])
def test_suites(spark, dialect):
    from sentrylake.operators.suites import SuiteParams, baseline_suite, showcase_suite
    from sentrylake.sinks.documents import to_serving

    flat = batch(spark, CONNS, CONN_SCHEMA).drop("event_time").withColumns({
        "event_id": F.col("zeek_conn_uid"), "benchmark_id": F.lit("r"), "event_severity": F.lit(2), "rule_id": F.lit("x")})
    p = SuiteParams("r", "2031-09-04 07:15:00", "2031-09-04 07:17:05", "2031-09-04 07:30:00", "zeek.conn", "10.4.7.9",
                    "100.64.3.1", "tcp connection 100.64.3.1")
    for events in (flat, to_serving(flat)):
        base, show = baseline_suite(events, events, p), showcase_suite(events, p, dialect)
        assert (len(base), len(show)) == (10, 7)
        assert {n: q().count() for n, q in base.items()} == {
            "time_range_search": 7, "filter_by_dataset": 1, "filter_by_source_ip": 1, "filter_by_destination_ip": 1,
            "alerts_by_severity": 1, "alerts_by_rule": 1, "top_source_ip_by_event_count": 6,
            "top_destination_ip_by_event_count": 10, "top_talkers_by_network_bytes": 6, "message_search": 2}
        found = {n: q().count() for n, q in show.items()}
        assert found["multi_field_latest_hits"] == 2 and found["search_facet_top_destination_ports"] == 2
        assert found["search_timeline_histogram"] == 1 and found["ip_pivot_latest_hits"] == 6
        # All texts but one have the token ``tcp``; none starts with ``tcp connection 100``, as the sources are 10. and 172.
        assert found["autocomplete_latest_hits"] == (len(CONNS) if dialect == "search" else 0)
        assert found["fuzzy_latest_hits"] >= 2
    other = SuiteParams("else", p.start, p.mid, p.end, p.dataset, p.source_ip, p.destination_ip)
    assert baseline_suite(flat, flat, other)["message_search"]().isEmpty()


def test_internal_flags(spark):
    from sentrylake.functions.net import with_internal_flags

    rows = spark.createDataFrame([("10.0.0.1", "172.25.1.1"), ("172.32.0.1", None), ("192.168.1.1", "8.8.8.8")],
                                 "source_ip string, destination_ip string")
    assert [(r.source_is_internal, r.destination_is_internal) for r in with_internal_flags(rows).collect()] == [
        (True, True), (False, None), (True, False)]
