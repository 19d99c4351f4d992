"""Counts, top lists, timelines and order statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.functions.timeutil import interval, micros
from sentrylake.operators.detections import sum0
from sentrylake.session import shared_dir


def count_by(df: DataFrame, *keys: str, name: str = "event_count") -> DataFrame:
    """Rows per group, ordered by the keys."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(*keys)


def top_counts(df: DataFrame, key: str, k: int = 10, name: str = "event_count") -> DataFrame:
    """The k most frequent values; equal counts are ordered by value."""
    return df.groupBy(key).agg(F.count("*").alias(name)).orderBy(F.desc(name), key).limit(k)


def top_sum(df: DataFrame, key: str, measure: str, k: int = 10, name: str = "total", order_by: str = "sum") -> DataFrame:
    """The k values with the largest sum, or with the most rows (``order_by="count"``), each with its sum."""
    if order_by not in ("sum", "count"):
        raise ValueError(order_by)
    totals = df.groupBy(key).agg(sum0(measure).alias(name), F.count("*").alias("_rows"))
    rank = name if order_by == "sum" else "_rows"
    return totals.orderBy(F.desc(rank), key).limit(k).drop("_rows")


def lake_counts(df: DataFrame) -> DataFrame:
    """Rows per partition of the lake table."""
    return count_by(df, "event_date", "event_dataset")


def timeline(
    df: DataFrame, step: str = "1 minute", time_col: str = "event_timestamp", fill: bool = False,
    newest: int | None = None,
) -> DataFrame:
    """Rows per epoch-aligned time bucket, newest first; ``fill`` adds the empty buckets in between."""
    counts = df.groupBy(F.window(time_col, step)["start"].alias("bucket")).agg(F.count("*").alias("event_count"))
    if fill:
        counts = _all_buckets(counts, step).join(counts, "bucket", "left").select(
            "bucket", F.coalesce("event_count", F.lit(0).cast("bigint")).alias("event_count"))
    ordered = counts.orderBy(F.desc("bucket"))
    return ordered.limit(newest) if newest else ordered


def _all_buckets(counts: DataFrame, step: str) -> DataFrame:
    """Every bucket from the first to the last, made day by day so that no single array spans the whole range."""
    width, day = micros(step), micros("1 day")
    ends = counts.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    if width >= day:
        return ends.select(F.explode(F.sequence("lo", "hi", interval(step))).alias("bucket"))
    lo, hi = F.unix_micros("lo"), F.unix_micros("hi")
    first = (F.col("d") * day + (width - 1) - F.pmod(F.col("d") * day + (width - 1), F.lit(width)))
    # The few rows of days are dealt out before each grows to its buckets.
    days = ends.where(lo.isNotNull()).select(
        lo.alias("lo"), hi.alias("hi"),
        F.explode(F.sequence(F.floor(lo / day).cast("bigint"), F.floor(hi / day).cast("bigint"))).alias("d")).repartition("d")
    # The buckets that start inside day d, clipped to the range; a step that does not divide the day still fits.
    inside = days.select(
        F.greatest(first, "lo").alias("a"), F.least((F.col("d") + 1) * day - 1, F.col("hi")).alias("b"))
    starts = inside.where("a <= b").select(F.explode(F.sequence("a", "b", F.lit(width))).alias("start"))
    return starts.select(F.timestamp_micros("start").alias("bucket"))


def exact_percentiles(
    df: DataFrame, by: list[str], value: str, probs: dict[str, float], accuracy: int = 10_000,
) -> DataFrame:
    """Exact percentiles with linear interpolation between neighbours, one column per entry of ``probs``.

    Works without bringing a group together. A sketch of bounded size brackets each wanted rank between two values; the
    second read counts what lies below, and only values between the brackets, about ``6 / accuracy`` of a group for each
    percentile, are shuffled and sorted. The sketch's error is bounded, so a rank is never outside its brackets.
    """
    named = df.select(F.struct(*by).alias("g"), F.col(value).cast("double").alias("v"))
    brackets = named.groupBy("g").agg(*_brackets("v", probs, accuracy))
    return _ranked(named, brackets, probs).select("g.*", *probs)


def _brackets(value: str, probs: dict[str, float], accuracy: int) -> list[Column]:
    """Per group: values surely not above (``lo``) and not below (``hi``) each wanted rank and its neighbour.

    From ``2 * accuracy`` values on the room of three times the sketch's error holds the neighbouring ranks, too; a group of
    fewer is ``small`` and keeps all its values.
    """
    room = 3 / accuracy
    sides = {"lo": [max(0.0, p - room) for p in probs.values()], "hi": [min(1.0, p + room) for p in probs.values()]}
    return [(F.count(value) < 2 * accuracy).alias("small"), *[
        F.percentile_approx(value, F.array(*[F.lit(q) for q in qs]), F.lit(accuracy)).alias(side) for side, qs in sides.items()]]


def _ranked(named: DataFrame, brackets: DataFrame, probs: dict[str, float]) -> DataFrame:
    """(g, one column per entry of ``probs``) for rows (g, v), with each group's brackets: the second read of the rows.

    The brackets cut a group's values into stretches. Those between brackets keep their values, of the others only the
    number of rows is needed.
    """
    # The keys travel as one struct, which also keeps a group whose key is NULL through the joins.
    tagged = named.where(F.col("v").isNotNull()).join(brackets.select("g", "small", "lo", "hi"), "g")
    n = range(len(probs))
    # The least sketched value is no bound below the first rank of a group; the greatest none above the last.
    edges = [0.0 if p <= 0 else 1.0 if p >= 1 else p for p in probs.values()]
    reached = sum((F.col("small") | F.lit(edges[i] == 0.0) | (F.col("v") >= F.col("lo")[i])).cast("int") for i in n)
    passed = sum((~F.col("small") & F.lit(edges[i] < 1.0) & (F.col("v") > F.col("hi")[i])).cast("int") for i in n)
    stretches = tagged.select("g", reached.alias("a"), passed.alias("b"), "v").select(
        "g", (F.col("a") + F.col("b")).alias("bucket"), F.when(F.col("a") > F.col("b"), F.col("v")).alias("v"))
    tagged = stretches.groupBy("g", "bucket", "v").agg(F.count("*").alias("n"))

    group = Window.partitionBy("g")  # at most two rows per group and percentile, and one
    totals = tagged.groupBy("g", "bucket").agg(F.sum("n").alias("m")).select(
        "g", "bucket", "m",
        F.coalesce(F.sum("m").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("before"),
        F.sum("m").over(group).alias("total"))
    spot = {name: F.lit(float(p)) * (F.col("total") - 1) for name, p in probs.items()}
    ranks = F.array(*[f(s).cast("bigint") for s in spot.values() for f in (F.floor, F.ceil)])
    wanted = totals.where(F.exists(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("m"))))

    inside = Window.partitionBy("g", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = tagged.join(wanted, ["g", "bucket"]).withColumn("upto", F.col("before") + F.sum("n").over(inside))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")), F.col("v")))

    picked = placed.groupBy("g").agg(
        F.max("total").alias("total"),
        *[c for name, s in spot.items() for c in (at(F.floor(s)).alias(f"{name}_lo"), at(F.ceil(s)).alias(f"{name}_hi"))])
    return picked.select("g", *[
        (F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (s - F.floor(s))).alias(name)
        for name, s in spot.items()])


def run_sketches(samples: DataFrame, by: list[str], value: str = "sample_ms", size: int = 2000) -> DataFrame:
    """One row per group with a quantile ``sketch`` of its values, to be stored with the run it belongs to.

    A sketch takes some ``14 * size`` bytes however many values it stands for; ranks read from it, or from any number of them
    merged, are wrong by about ``2 / size`` at most. NULL values are left out.
    """
    known = samples.where(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.expr(f"kll_sketch_agg_double(CAST(`{value}` AS DOUBLE), {size})").alias("sketch"),
                                  F.count("*").alias("iterations"))


def sketched_percentiles(sketches: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """Percentiles of all values that the stored sketches of a group stand for, without reading the values again."""
    merged = sketches.groupBy(*by).agg(F.expr("kll_merge_agg_double(sketch)").alias("_all"), F.sum("iterations").alias("iterations"))
    return merged.select(*by, "iterations", *[
        F.expr(f"kll_sketch_get_quantile_double(_all, {float(p)}D)").alias(name) for name, p in probs.items()])


def latency_summary(samples: DataFrame, by: list[str], value: str = "sample_ms", digits: int = 3) -> DataFrame:
    """Latency statistics per group: samples, mean, 50th/95th/99th percentile, minimum, maximum."""
    # One read gives the plain figures and the brackets, a second the percentiles. A group without a value keeps its row.
    probs = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}
    named = samples.select(F.struct(*by).alias("g"), F.col(value).alias("x"), F.col(value).cast("double").alias("v"))
    plain = named.groupBy("g").agg(
        F.count("x").alias("iterations"), F.avg("x").alias("avg_ms"), F.min("x").alias("min_ms"), F.max("x").alias("max_ms"),
        *_brackets("v", probs, 10_000))
    both = plain.join(_ranked(named, plain, probs), "g", "left")
    stats = ["avg_ms", "p50_ms", "p95_ms", "p99_ms", "min_ms", "max_ms"]
    return both.select("g.*", "iterations", *[F.round(F.col(c).cast("double"), digits).alias(c) for c in stats])


def row_index(df: DataFrame, key: str, name: str = "row_index") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of a column without sorting them in one task."""
    return row_number_from_one(df, [key], name).withColumn(name, (F.col(name) - 1).cast("bigint"))


def row_number_from_one(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Number the rows 1, 2, 3, ... in the order of any columns without sorting them in one task.

    The rows are dealt out by range; each part's first number is the sum of the parts before it. Where the ranges end
    depends on a sample, so the parts are written down once, to the shared folder.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, "numbered")
    df.repartitionByRange(parts, *order_by).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_part", before.alias("_before"))  # one row for each part
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order_by))
    return dealt.join(F.broadcast(starts), "_part").withColumn(name, place + F.col("_before")).drop("_part", "_before")


def corpus_summary(events: DataFrame, alert_every: int = 5, seq: str = "benchmark_seq") -> DataFrame:
    """One row about a corpus: counts, datasets, first/middle/last time, first known addresses in sequence order."""
    per_dataset = events.groupBy("event_dataset").agg(
        F.count("*").alias("n"),
        F.count_if(F.col(seq) % max(1, alert_every) == 0).alias("alerts"),
        F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi"),
        *[agg for ip in ("source_ip", "destination_ip") for agg in (
            F.min_by(ip, F.when(F.col(ip).isNotNull(), F.col(seq))).alias(ip),
            F.min(F.when(F.col(ip).isNotNull(), F.col(seq))).alias(f"{ip}_seq"))])
    # From here on there is one row per dataset.
    total = per_dataset.agg(
        F.sum("n").alias("event_count"), F.sum("alerts").alias("alerts"),
        F.array_join(F.sort_array(F.collect_set("event_dataset")), ",").alias("dataset_values"),
        F.min_by("source_ip", "source_ip_seq").alias("sample_source_ip"),
        F.min_by("destination_ip", "destination_ip_seq").alias("sample_destination_ip"),
        F.min("lo").alias("time_range_start"), F.max("hi").alias("time_range_end"))
    lo, hi = F.unix_micros("time_range_start"), F.unix_micros("time_range_end")
    return total.select(
        "event_count", F.greatest("alerts", F.lit(1)).alias("alert_count"), "dataset_values", "sample_source_ip",
        "sample_destination_ip", "time_range_start", F.timestamp_micros(F.floor((lo + hi) / 2)).alias("time_range_mid"),
        "time_range_end")
