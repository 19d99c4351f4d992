"""Interval joins and table checks.

Time joins are equi-joins on (key, time bin[, salt]) with the exact time bound as a residual condition, so one busy
address is spread over its time bins, and over the salt within a bin, instead of landing in one task. How many salts a
(key, bin) needs is measured unless it is given: a sketch of bounded size finds those that hold much, and only their rows are
salted and repeated.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.timeutil import interval, micros, time_bin


def _salted(df: DataFrame, salt: int) -> DataFrame:
    """Give each row one of ``salt`` numbers, fixed by its content so that a retried task repeats it."""
    if salt <= 1:
        return df.withColumn("_salt", F.lit(0))
    return df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salt)).cast("int"))


def _replicated(df: DataFrame, salt: int) -> DataFrame:
    if salt <= 1:
        return df.withColumn("_salt", F.lit(0))
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))


# A (key, bin) with more than this part of a task's even share is split.
_SHARE = 4
_MOST_HEAVY = 100_000


def heavy_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(``_pair``, ``_salts``) of the keys that hold so many rows that they must be split, and over how many salts.

    ``_pair`` is a hash of the keys. They are found by one aggregate over all rows, whose state has a fixed size for the
    number of shuffle partitions; with p of them a key counts as heavy from 1 / (4 p) of the rows on, so there are at most
    4 p rows here. A key that the sketch takes for heavy without need is split all the same: nothing else changes.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(_SHARE * parts, _MOST_HEAVY)
    known = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    counts = known.select(F.xxhash64(*keys).alias("pair")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(pair, {most}, {8 * most})").alias("top"))
    found = counts.select("n", F.explode("top").alias("t"))
    salts = F.ceil(F.col("t.count") * most / F.col("n")).cast("int")
    return found.select(F.col("t.item").alias("_pair"), salts.alias("_salts")).where("_salts > 1")


def _salted_sides(left: DataFrame, right: DataFrame, keys: list[str], salt: int | None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: the right side's rows are dealt out, the left side's repeated, ``salt`` or, if that is
    None, as often as the right side's share of the key asks for."""
    if salt is not None:
        return _replicated(left, salt), _salted(right, salt)
    heavy = F.broadcast(heavy_keys(right, keys))  # see there for its bound
    content = F.xxhash64(*[F.col(f"`{c}`") for c in right.columns])

    def counted(df: DataFrame) -> DataFrame:
        named = df.withColumn("_pair", F.xxhash64(*keys))
        return named.join(heavy, "_pair", "left").drop("_pair").withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    dealt = counted(right.withColumn("_content", content)).withColumn("_salt", F.pmod("_content", "_salts").cast("int"))
    copies = counted(left).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    return copies.drop("_salts"), dealt.drop("_salts", "_content")


def interval_join(
    left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, upper: str,
    lower: str = "0 seconds", bin_width: str | None = None, salt: int | None = None,
) -> DataFrame:
    """Inner join: equal key and ``right_time`` within ``[left_time + lower, left_time + upper]``, both ends included.

    ``on`` names the key on both sides; the other columns of the two inputs must differ. Streams use Spark's own
    stream-stream join, which derives state expiry from the time bound; both inputs then need a watermark. Its state is
    keyed by bins as wide as the bound, so that a row is compared with the rows near it in time, not with all that its key
    has in state. ``salt`` splits the right side of every key (in batch: of each of its bins), on streams its state as
    well, and repeats the left side as often. In batch without it the heavy (key, bin) pairs of the right side are measured,
    which reads its key and time once more, and only those are split.
    """
    between = F.col(right_time).between(
        F.col(left_time) + interval(lower), F.col(left_time) + interval(upper))
    streaming = left.isStreaming or right.isStreaming
    if streaming and bin_width:
        raise ValueError("the bins of a stream join are as wide as its bound")
    width = micros(bin_width) if bin_width else max(micros(upper) - micros(lower), 1_000_000)
    first = time_bin(F.col(left_time), width, micros(lower))
    last = time_bin(F.col(left_time), width, micros(upper))
    # A left row visits every bin its range touches, a right row sits in one bin: each pair meets once.
    left = left.withColumn("_bin", F.explode(F.sequence(first, last)))
    right = right.withColumn("_bin", time_bin(F.col(right_time), width))
    if streaming:
        salt = salt or 1
        keyed = _salted(right, salt).withColumnsRenamed({on: "_key", "_bin": "_right_bin", "_salt": "_right_salt"})
        met = (F.col(on) == F.col("_key")) & (F.col("_bin") == F.col("_right_bin")) \
            & (F.col("_salt") == F.col("_right_salt")) & between
        return _replicated(left, salt).join(keyed, met).drop("_key", "_bin", "_right_bin", "_salt", "_right_salt")

    binned_left, binned_right = _salted_sides(left, right, [on, "_bin"], salt)
    joined = binned_left.join(binned_right, [on, "_bin", "_salt"])
    return joined.where(between).drop("_bin", "_salt")


def evidence_for(
    alerts: DataFrame, events: DataFrame, slack: str = "0 seconds", bin_width: str = "5 minutes", salt: int | None = None,
    alert_cols: tuple[str, ...] = ("alert_id",), event_cols: tuple[str, ...] = ("event_id",),
    start: str = "window_start", end: str = "window_end", event_time: str = "event_time",
) -> DataFrame:
    """Drill-down: the events that share an address with an alert inside the alert's window, widened by ``slack``.

    Both inputs are keyed by each of their addresses. An alert and an event with two addresses in common meet twice;
    only the meeting on the smaller one is kept, so no shuffle is needed to remove doubles. ``salt`` as in
    :func:`interval_join`.
    """
    width, margin = micros(bin_width), micros(slack)
    left = (
        alerts.select(
            *[F.col(c) for c in alert_cols], F.array_distinct(F.array_compact("related_ip")).alias("_alert_ips"),
            (F.to_timestamp(start) - interval(slack)).alias("_from"),
            (F.to_timestamp(end) + interval(slack)).alias("_to"))
        .withColumn("_ip", F.explode("_alert_ips"))
        .withColumn("_bin", F.explode(F.sequence(time_bin(F.col("_from"), width), time_bin(F.col("_to"), width)))))
    source, destination = F.col("source_ip"), F.col("destination_ip")
    # Each event once by each address; ``_other`` is the other one, if there is another.
    roles = F.array(
        F.struct(source.alias("_ip"), F.nullif(destination, source).alias("_other")),
        F.struct(F.nullif(destination, source).alias("_ip"), source.alias("_other")))
    right = (
        events.select(*[F.col(c) for c in event_cols], F.col(event_time).alias("_at"), F.inline(roles))
        .where("_ip IS NOT NULL").withColumn("_bin", time_bin(F.col("_at"), width)))
    copies, dealt = _salted_sides(left, right, ["_ip", "_bin"], salt)
    inside = F.col("_at").between(F.col("_from"), F.col("_to"))
    # The smaller of two shared addresses: the other one is not smaller, or the alert does not have it.
    once = F.col("_other").isNull() | (F.col("_ip") < F.col("_other")) | ~F.array_contains("_alert_ips", F.col("_other"))
    met = copies.join(dealt, ["_ip", "_bin", "_salt"])
    return met.where(inside & F.coalesce(once, F.lit(True))).select(*alert_cols, *event_cols)


def missing_rules(expected: DataFrame, alerts: DataFrame, key: str = "rule_id") -> DataFrame:
    """Expected rules that raised no alert."""
    # The alert side shrinks to one row per rule before the join, however many alerts a rule raised.
    return expected.join(alerts.select(key).groupBy(key).agg(F.count("*").alias("_n")), key, "left_anti")


def count_delta(
    before: DataFrame, after: DataFrame, by: list[str], min_delta: int = 1,
) -> DataFrame:
    """Rows per group before and after a run, and whether the growth reached ``min_delta``."""
    both = before.select(*by, F.lit(False).alias("_after")).unionByName(after.select(*by, F.lit(True).alias("_after")))
    counts = both.groupBy(*by).agg(F.count_if(~F.col("_after")).alias("before_count"), F.count_if("_after").alias("after_count"))
    delta: Column = F.col("after_count") - F.col("before_count")
    return counts.withColumns({"delta": delta, "reached": delta >= min_delta})


def alert_latency(
    alerts: DataFrame, events: DataFrame, on: str, written_at: str = "written_at", ingested_at: str = "ingest_ts",
    window: str = "5 minutes", bin_width: str | None = None, salt: int | None = None,
) -> DataFrame:
    """Milliseconds from an event's arrival to its alert becoming visible: one row for each alert that has one.

    Counted is the last arrival for the alert's key that is not after the alert and at most ``window`` before it. Alerts
    are told apart by all their columns. The key is spread over time bins and salts as in :func:`interval_join`.
    """
    columns = alerts.columns
    arrivals = events.select(on, F.col(ingested_at).alias("_arrived")).where(F.col("_arrived").isNotNull())
    met = interval_join(alerts, arrivals, on, written_at, "_arrived", "0 seconds", f"-{window}", bin_width, salt)
    last = met.groupBy(*columns).agg(F.max("_arrived").alias("_arrived"))
    spent = (F.unix_micros(written_at) - F.unix_micros("_arrived")) / 1000
    return last.select(*columns, spent.alias("latency_ms"))
