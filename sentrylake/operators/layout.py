"""Space-filling order of rows, so that files and row groups can be skipped by several columns at once.

A table sorted by one column can be skipped by that column alone. Here each column's values are cut into ranges of about
equal size, and the bits of the range numbers are interleaved: rows that are next to each other in this order are close in
every column, so the smallest and largest values that Parquet keeps of each column span little in all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 50_000


def cut_points(df: DataFrame, columns: list[str], bits: int = 6, rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """At most ``2 ** bits - 1`` sorted values of each column that cut its rows into about equal parts.

    They come from a sample of about ``rows`` rows of these columns, whatever the size of the table; it decides how even
    the parts are, nothing else. A value that holds many parts' rows makes one part.
    """
    total = df.count()
    # Four deviations more than expected, so that the collected rows stay bounded.
    sample = df.select(*columns).sample(min(1.0, rows / max(total, 1)), seed=11).limit(rows + 4 * int(rows ** 0.5) + 4).collect()
    found = {}
    for column in columns:
        values = sorted(r[column] for r in sample if r[column] is not None)
        picked = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        found[column] = sorted(set(picked))
    return found


def part_of(column: str, cuts: list) -> Column:
    """How many of the sorted cut points are not above the value, by bisection; NULL counts as below them all."""
    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(F.col(column) >= F.lit(cuts[middle]), between(middle + 1, hi)).otherwise(between(lo, middle))

    return between(0, len(cuts)).cast("long")


def interleaved(parts: list[Column], bits: int) -> Column:
    """One number of the parts' bits, taken in turn from the highest on."""
    key, place = F.lit(0).cast("long"), bits * len(parts) - 1
    for bit in reversed(range(bits)):
        for part in parts:
            key = key.bitwiseOR(F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("long")), place))
            place -= 1
    return key


def cluster_key(cuts: dict[str, list], bits: int = 6) -> Column:
    """The place of a row in the space-filling order of the columns in ``cuts`` (see :func:`cut_points`)."""
    if not 1 <= bits * len(cuts) <= 62:
        raise ValueError("the key must fit in a long")
    return interleaved([part_of(column, points) for column, points in cuts.items()], bits)


def clustered(df: DataFrame, first: list[str], columns: list[str], bits: int = 6, parts: int | None = None) -> DataFrame:
    """The rows, dealt out and sorted by ``first`` (such as partition columns) and the space-filling order of ``columns``.

    Each task, and so each file, gets one stretch of that order; equal keys may be split over neighbouring tasks.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_place", cluster_key(cut_points(df, columns, bits), bits))
    spread = F.xxhash64(*[F.col(c) for c in columns]) if columns else F.lit(0)
    order = [*[F.col(c) for c in first], F.col("_place")]
    return keyed.withColumn("_spread", spread).repartitionByRange(parts, *order, "_spread").sortWithinPartitions(
        *order, "_spread").drop("_place", "_spread")
