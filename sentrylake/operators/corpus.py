"""Benchmark corpora: scale a base table out, derive alerts from it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.net import related_ips
from sentrylake.operators.aggregates import row_number_from_one
from sentrylake.schemas import DOTTED

# Corpus sizes as multiples of the base table, or as row targets.
SIZE_MULTIPLES = {"small": 1, "medium": 10, "large": 50}
SIZE_TARGETS = {"single-1m": 1_000_000, "distributed-1m": 1_000_000, "distributed-3m": 3_000_000}
HTTP_PORTS = (80, 8080, 8000, 8888)
LARGE_TRANSFER = 1_000_000


def scale_out(
    base: DataFrame, run_id: str, size: str = "small", target_rows: int | None = None,
    order_by: tuple[str, ...] = ("event_timestamp",), id_name: str = "event_id",
) -> DataFrame:
    """Repeat a base table up to a row target, one minute later with each repetition.

    Row ``i`` is base row ``i mod n`` moved by ``i div n`` minutes; an event that has an id keeps it. The base rows are
    numbered once, by ``order_by`` and then by their content (equal rows in any order), and each makes its own copies:
    the target is never shuffled.
    """
    content = F.xxhash64(*[F.col(c).cast("string") if base.schema[c].dataType.typeName() == "map" else F.col(c) for c in base.columns])
    numbered = row_number_from_one(base.withColumn("_content", content), [*order_by, "_content"], "_at").drop("_content")
    n = base.count()
    if n == 0:
        raise ValueError("the base table is empty")
    target = target_rows or SIZE_TARGETS.get(size) or n * SIZE_MULTIPLES[size]
    copies = F.floor((F.lit(target) - F.col("_at")) / n).cast("int")
    grown = numbered.where(F.col("_at") <= target).withColumn("benchmark_cycle", F.explode(F.sequence(F.lit(0), copies)))
    grown = grown.withColumn("benchmark_seq", F.col("benchmark_cycle") * F.lit(n).cast("bigint") + F.col("_at")).drop("_at")
    made = F.concat(F.lit(f"{run_id}-event-"), F.col("benchmark_seq").cast("string"))
    return grown.withColumns({
        "event_timestamp": F.col("event_timestamp") + F.make_dt_interval(mins=F.col("benchmark_cycle")),
        "benchmark_id": F.lit(run_id),
        "benchmark_size": F.lit(size),
        id_name: F.coalesce(F.col(id_name).cast("string"), made) if id_name in base.columns else made,
    })


def multiplier(base_rows: int, target_rows: int) -> int:
    return math.ceil(target_rows / base_rows)


def _family() -> Column:
    """(rule id, rule name, category, severity) by the kind of event; the first match counts.

    Fixed values: the names of the families.
    """
    def family(rule: str, name: str, category: str, severity: int) -> Column:
        return F.struct(F.lit(rule).alias("id"), F.lit(name).alias("name"), F.lit(category).alias("category"),
                        F.lit(severity).alias("severity"))

    own = F.struct(
        F.coalesce("rule_id", F.lit("benchmark.snort.alert")).alias("id"),
        F.coalesce("rule_name", F.lit("benchmark.snort")).alias("name"),
        F.coalesce("rule_category", F.lit("intrusion_detection")).alias("category"),
        F.coalesce("event_severity", F.lit(2)).alias("severity"))
    port = F.col("destination_port")
    odd_http = F.lower("message").contains("http") & (port.isNull() | ~port.isin(*HTTP_PORTS))
    return (
        F.when(F.col("event_dataset") == "snort.alert", own)
        .when(F.col("network_bytes") >= LARGE_TRANSFER,
              family("benchmark.zeek.large_transfer", "benchmark.large_transfer", "network_volume", 2))
        .when(odd_http,
              family("benchmark.zeek.protocol_anomaly", "benchmark.protocol_anomaly", "protocol_anomaly", 3))
        .when(F.col("event_dataset") == "zeek.conn",
              family("benchmark.zeek.connection", "benchmark.connection", "network", 3))
        .otherwise(family("benchmark.generic", "benchmark.generic", "generic", 3)))


def derive_alerts(events: DataFrame, every: int = 5, delay: str = "2 seconds", seq: str = "benchmark_seq") -> DataFrame:
    """Every k-th event as an alert two seconds later; a corpus shorter than k yields one alert from its first event."""
    every = max(1, every)
    # A corpus of ``every`` rows or more has a row with that number, which the search for one stops at.
    short = events.where(F.col(seq) >= every).limit(1).isEmpty()
    chosen = events.where(F.col(seq) == 1 if short else F.col(seq) % every == 0)
    record = F.to_json(F.struct(*[
        F.col(c).alias(d) for c, d in sorted(((c, DOTTED.get(c, c)) for c in events.columns), key=lambda p: p[1])]))
    at = F.col("event_timestamp") + F.expr(f"INTERVAL {delay}")
    size = F.coalesce("network_bytes", F.lit(0)).cast("bigint")
    dataset = F.coalesce("event_dataset", F.lit("event"))
    f = F.col("family")
    return chosen.withColumns({"family": _family(), "record": record}).select(
        at.alias("event_timestamp"), "benchmark_id", "benchmark_size", "benchmark_cycle", seq,
        F.lit("alert").alias("event_kind"), F.array(f["category"]).alias("event_category"),
        F.array(F.lit("indicator")).alias("event_type"), F.lit("benchmark").alias("event_module"),
        F.lit("siem.alert").alias("event_dataset"), f["severity"].alias("event_severity"), f["id"].alias("rule_id"),
        f["name"].alias("rule_name"), f["category"].alias("rule_category"), "source_ip", "destination_ip",
        size.alias("network_bytes"),
        F.concat(F.lit("Benchmark-derived alert for "), dataset, F.lit(".")).alias("alert_reason"),
        F.concat(F.lit("event_id="), F.coalesce(F.col("event_id").cast("string"), F.lit("None")), F.lit(" dataset="),
                 F.coalesce("event_dataset", F.lit("None")), F.lit(" bytes="), size.cast("string")).alias("alert_evidence"),
        F.lit(1).cast("bigint").alias("alert_count"), F.col("event_timestamp").alias("window_start"),
        at.alias("window_end"), related_ips("source_ip", "destination_ip").alias("related_ip"),
        F.lit("benchmark.synthetic").alias("pipeline"),
        F.concat(F.lit("Benchmark alert for "), f["name"]).alias("message"), F.col("record").alias("event_original"),
        F.concat(F.col("benchmark_id"), F.lit("-alert-"), F.col(seq).cast("string")).alias("event_id"))
