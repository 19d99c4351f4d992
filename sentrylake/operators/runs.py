"""Comparison of measured runs. Ratios are NULL where a side is missing or zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Query names of earlier runs, by the name used now.
QUERY_ALIASES = {"multi_field_latest_hits": ["phrase_latest_hits"]}


def ratio(over: Column | str, under: Column | str) -> Column:
    """``over / under``, NULL if either is NULL or zero."""
    zero = F.lit(0)
    return F.try_divide(F.nullif(over, zero), F.nullif(under, zero))


def compare_runs(a: DataFrame, b: DataFrame, on: str = "query", value: str = "p95_ms", digits: int = 2) -> DataFrame:
    """The same measure of two runs or backends side by side, and how many times larger the second is.

    A key that only one side has is kept with NULLs.
    """
    left = a.select(on, F.col(value).alias(f"a_{value}"))
    right = b.select(on, F.col(value).alias(f"b_{value}"))
    return left.join(right, on, "full_outer").select(
        on, f"a_{value}", f"b_{value}", F.round(ratio(f"b_{value}", f"a_{value}"), digits).alias("ratio"))


def alias_map(
    rows: DataFrame, keys: list[str], value: str, aliases: dict[str, list[str]] = QUERY_ALIASES, name: str = "query",
) -> DataFrame:
    """Rename queries of earlier runs; a run that has both names keeps the row under the present one."""
    order = {old: (new, i + 1) for new, olds in aliases.items() for i, old in enumerate(olds)}
    known = reduce(
        lambda c, item: c.when(F.col(name) == item[0], F.struct(F.lit(item[1][0]).alias("q"), F.lit(item[1][1]).alias("r"))),
        order.items(), F.when(F.lit(False), F.struct(F.lit("").alias("q"), F.lit(0).alias("r"))))
    place = F.coalesce(known, F.struct(F.col(name).alias("q"), F.lit(0).alias("r")))
    renamed = rows.select(*keys, place["q"].alias(name), place["r"].alias("_rank"), value)
    return renamed.groupBy(*keys, name).agg(F.min_by(value, "_rank").alias(value))


def _against_first(runs: DataFrame, by: str, order: list[str], value: str, size: str) -> DataFrame:
    """Each row with the row of the first run for the same key, and the first run's size.

    A run table has one row for each run and key, so two windows over it are read once and stay small.
    """
    everything = Window.partitionBy(F.lit(0))
    place = F.struct(*order)
    rows = runs.withColumn("_first", F.min(place).over(everything))
    is_first = place == F.col("_first")
    same = Window.partitionBy(by)
    return rows.withColumns({
        "base_value": F.max(F.when(is_first, F.col(value))).over(same),
        # The size of the first run is known even for keys it did not measure.
        "base_size": F.max(F.when(is_first, F.col(size))).over(everything)}).drop("_first")


def scaling_report(
    runs: DataFrame, by: str = "query", value: str = "p95_ms", higher_is_better: bool = False, digits: int = 2,
) -> DataFrame:
    """Growth of a measure against data growth, relative to the smallest run.

    ``efficiency`` is data growth over latency growth, or throughput growth over data growth.
    """
    joined = _against_first(runs, by, ["event_count", "run_id"], value, "event_count")
    growth = ratio(value, "base_value")
    data = ratio("event_count", "base_size")
    efficiency = ratio(growth, data) if higher_is_better else ratio(data, growth)
    return joined.select(
        "run_id", by, "event_count", value, F.round(data, digits).alias("data_growth"),
        F.round(growth, digits).alias("value_growth"), F.round(efficiency, digits).alias("efficiency"))


def node_scaling(
    runs: DataFrame, by: str = "query", value: str = "p95_ms", higher_is_better: bool = False, digits: int = 2,
) -> DataFrame:
    """Speed-up against the run with the fewest nodes, and the share of the added nodes it makes use of."""
    joined = _against_first(runs, by, ["node_count", "run_id"], value, "node_count")
    speedup = ratio(value, "base_value") if higher_is_better else ratio("base_value", value)
    return joined.select(
        "run_id", by, "node_count", value, F.round(speedup, digits).alias("speedup"),
        F.round(ratio(speedup, ratio("node_count", "base_size")), digits).alias("efficiency"))
