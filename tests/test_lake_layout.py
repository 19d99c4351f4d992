import datetime
import random
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sentrylake.operators.filters import ip_pivot
from sentrylake.operators.layout import cluster_key, cut_points, interleaved, part_of
from sentrylake.schemas import LAKE_SCHEMA
from sentrylake.sinks.lake import overwrite_run, write_lake
from sentrylake.sources.lake import lake_dates, newest_first, read_lake, volume


def events(spark, days=6, per_day=4000, seed=1):
    rng, start = random.Random(seed), datetime.datetime(2024, 3, 1)
    rows = [(start + datetime.timedelta(days=rng.randrange(days), seconds=rng.randrange(86_400)), rng.choice(["zeek.conn", "snort.alert"]),
             f"10.0.{rng.randrange(30)}.{rng.randrange(40)}", f"172.16.{rng.randrange(30)}.{rng.randrange(40)}", f"m{i}")
            for i in range(days * per_day)]
    return spark.createDataFrame(rows, "event_timestamp timestamp, event_dataset string, source_ip string, destination_ip string, message string")


def row_groups(folder):
    """(groups, groups that may hold the address by their smallest and largest values)."""
    total, may = 0, 0
    ip = "10.0.7.7"
    for file in Path(folder).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(names.index(c)).statistics for c in ("source_ip", "destination_ip")]
            total += 1
            may += any(s.min <= ip <= s.max for s in stats)
    return total, may


def test_bits_are_taken_in_turn(spark):
    rows = [(a, b) for a in range(8) for b in range(8)]
    key = interleaved([F.col("a"), F.col("b")], 3)
    got = {(r.a, r.b): r.key for r in spark.createDataFrame(rows, "a long, b long").select("a", "b", key.alias("key")).collect()}
    assert got == {(a, b): int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}", strict=True)), 2) for a, b in rows}


def test_parts_and_their_edges(spark):
    df = spark.createDataFrame([(v,) for v in [None, "a", "b", "b", "c", "z", "é"]], "v string")
    got = [r[0] for r in df.select(part_of("v", ["b", "c", "x"])).collect()]
    assert got == [0, 0, 1, 1, 2, 3, 3]
    assert df.select(part_of("v", [])).distinct().count() == 1
    assert cut_points(df.limit(0), ["v"]) == {"v": []}
    same = cut_points(df.where("v = 'b'"), ["v"], bits=3)
    assert same == {"v": ["b"]}
    with pytest.raises(ValueError):
        cluster_key({f"c{i}": [] for i in range(11)})


def test_pivot_reads_a_fifth_of_the_row_groups(spark, tmp_path):
    rows = events(spark, days=1, per_day=60_000).withColumn("event_dataset", F.lit("zeek.conn"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 256)
    try:
        by_time, by_place = str(tmp_path / "time"), str(tmp_path / "place")
        overwrite_run(rows.withColumn("benchmark_id", F.lit("r")), by_time)
        write_lake(rows, by_place, cluster_by=["source_ip", "destination_ip"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    total, may = row_groups(by_time)
    clustered_total, clustered_may = row_groups(by_place)
    assert total >= 200 and clustered_total >= 200 and may > total * 0.9
    assert clustered_may < may / 5
    want = sorted(r.message for r in ip_pivot(rows, "10.0.7.7").collect())
    assert sorted(r.message for r in ip_pivot(read_lake(spark, by_place), "10.0.7.7").collect()) == want
    assert read_lake(spark, by_place).count() == 60_000


def test_clustered_run_keeps_all_rows(spark, tmp_path):
    rows = events(spark, 2, 200).withColumn("benchmark_id", F.lit("r")).withColumn("source_ip", F.expr("if(rand(3) < 0.5, NULL, source_ip)"))
    overwrite_run(rows, str(tmp_path / "r"), cluster_by=["source_ip", "event_timestamp"])
    assert spark.read.parquet(str(tmp_path / "r")).count() == 400
    with pytest.raises(ValueError):
        write_lake(spark.readStream.format("rate").load(), "x", cluster_by=["source_ip"])


def spoil(lake, dates):
    """Make the files of these dates unreadable."""
    for date in dates:
        for file in Path(lake).glob(f"event_date={date}/**/*.parquet"):
            file.write_bytes(b"no parquet")
        for crc in Path(lake).glob(f"event_date={date}/**/.*.crc"):
            crc.unlink()


def test_newest_rows_open_one_date_of_many(spark, tmp_path):
    rows, lake = events(spark, 6, 300), str(tmp_path / "lake")
    write_lake(rows, lake)
    want = [tuple(r) for r in rows.orderBy(F.desc("event_timestamp"), "message").limit(50).select("event_timestamp", "message").collect()]
    spoil(lake, [f"2024-03-0{d}" for d in range(1, 6)])
    assert lake_dates(spark, lake) == [datetime.date(2024, 3, d) for d in range(6, 0, -1)]
    got = newest_first(spark, lake, 50, tie="message")
    assert [tuple(r) for r in got.select("event_timestamp", "message").collect()] == want


def test_newest_rows_go_back_as_far_as_needed(spark, tmp_path):
    rows, lake = events(spark, 5, 60), str(tmp_path / "lake")
    late = spark.createDataFrame([(None, "zeek.conn", f"none {i}") for i in range(3)],
                                 "event_timestamp timestamp, event_dataset string, message string")
    write_lake(rows, lake)
    write_lake(late, lake)
    ordered = [r.message for r in rows.orderBy(F.desc("event_timestamp"), "message").collect()] + ["none 0", "none 1", "none 2"]
    for n in (0, 1, 100, 130, 301, 900):
        assert [r.message for r in newest_first(spark, lake, n, tie="message").collect()] == ordered[:n]
    ends = [m for m in ordered if m.endswith("7")]
    got = newest_first(spark, lake, 20, lambda df: df.where("message LIKE '%7'"), "message")
    assert [r.message for r in got.collect()] == ends[:20]
    assert newest_first(spark, lake, 5, lambda df: df.where("message = 'absent'")).count() == 0


def test_equal_times_are_ordered_by_the_tie(spark, tmp_path):
    rows = events(spark, 1, 40).withColumn("event_timestamp", F.lit("2024-03-01 10:00:00").cast("timestamp"))
    write_lake(rows, str(tmp_path / "lake"))
    got = [r.message for r in newest_first(spark, str(tmp_path / "lake"), 7, tie="message").collect()]
    assert got == sorted(f"m{i}" for i in range(40))[:7]


def test_counts_come_from_footers(spark, tmp_path):
    rows, lake = events(spark, 6, 200), str(tmp_path / "lake")
    write_lake(rows, lake)
    whole = volume(spark, lake)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint>" in plan.replace("event_date:date,event_dataset:string,", "")
    assert sum(r.event_count for r in whole.collect()) == 1200
    start, end = "2024-03-02 06:00:00", "2024-03-05 18:00:00"
    want = {(str(r.d), r.event_dataset): r["count"] for r in rows.where(F.col("event_timestamp").between(start, end)).groupBy(
        F.to_date("event_timestamp").alias("d"), "event_dataset").count().collect()}
    got = volume(spark, lake, start, end)
    assert {(str(r.event_date), r.event_dataset): r.event_count for r in got.collect()} == want
    for a, b in ((start, None), (None, end), (start, "2024-03-02 07:00:00"), (end, start)):
        asked = rows.where(F.col("event_timestamp").between(a or "2000-01-01", b or "2100-01-01")).count()
        assert sum(r.event_count for r in volume(spark, lake, a, b).collect()) == asked
    # Only footers of the inner dates are opened: their data may be gone.
    inner = Path(lake, "event_date=2024-03-03")
    for file in inner.rglob("*.parquet"):
        raw = bytearray(file.read_bytes())
        footer = int.from_bytes(raw[-8:-4], "little") + 8
        raw[4:len(raw) - footer] = bytes(len(raw) - footer - 4)
        file.write_bytes(raw)
    for crc in inner.rglob(".*.crc"):
        crc.unlink()
    assert {(str(r.event_date), r.event_dataset): r.event_count for r in volume(spark, lake, start, end).collect()} == want


def test_empty_lake(spark, tmp_path):
    spark.createDataFrame([], LAKE_SCHEMA).write.parquet(str(tmp_path / "lake"))
    assert newest_first(spark, str(tmp_path / "lake"), 5).count() == 0
    assert volume(spark, str(tmp_path / "lake")).count() == 0


@pytest.mark.parametrize("watermark", [False, True])
def test_files_of_a_stream_follow_its_bytes(spark, tmp_path, watermark):
    rows = events(spark, days=3, per_day=6000)
    busy = F.when(F.rand(1) < 0.9, F.lit("2024-03-01 10:00:00").cast("timestamp")).otherwise(F.col("event_timestamp"))
    rows = rows.withColumns({"event_timestamp": busy, "message": F.concat(F.sha2("message", 512), F.sha2("source_ip", 512))})
    rows.write.parquet(str(tmp_path / "in"))

    def written(name, **kw):
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        stream = stream.withWatermark("event_timestamp", "1 minute") if watermark else stream
        write_lake(stream, str(tmp_path / name), str(tmp_path / f"{name}-log"), **kw).awaitTermination()
        got = read_lake(spark, str(tmp_path / name))
        wanted = spark.read.parquet(str(tmp_path / "in")).select("event_timestamp", "event_dataset", "message")
        assert got.count() == 18_000 and got.select(*wanted.columns).exceptAll(wanted).isEmpty()
        return Counter(f.parent for f in (tmp_path / name).rglob("*.parquet"))

    names = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        assert set(written("few").values()) == {1}
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
        split = written("split")
        assert len(split) == 6 and max(split.values()) >= 4 and sum(split.values()) < 60  # the busy date in several tasks
        assert max(written("dealt", writers=3).values()) == 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
