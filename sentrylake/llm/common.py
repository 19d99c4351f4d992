"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"


def reachable(spark: SparkSession) -> None:
    """Lets Python workers on this machine, or where it is installed alike, import this package from its folder.

    On a cluster without that, submit the package with ``--py-files``.
    """
    folder, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if folder not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [folder, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it survives lost executors and is computed once."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII white space, bytes in UTF-8."""
    return raw.lower().split() if raw else []


def raw_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def fold(id_column: str, parts: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id leaves 0."""
    rest = F.crc32(F.col(id_column).cast("string").cast("binary")) % parts
    return F.coalesce(rest, F.lit(0)) == remainder


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, limit: int) -> Iterator[pa.Table]:
    """Deals sorted batches out as tables that never split a key, of ``limit`` rows or fewer where no key has more."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, new]) if held is not None else new
        keys = held.column(key).to_numpy()
        # The last key may go on in the next batch.
        start, end = 0, int(np.searchsorted(keys, keys[-1]))
        while end - start >= limit:
            stop = int(np.searchsorted(keys, keys[start + limit])) if start + limit < end else end
            if stop <= start:
                stop = int(np.searchsorted(keys, keys[start], side="right"))
            yield held.slice(start, stop - start)
            start = stop
        held = held.slice(start)
    if held is not None and held.num_rows:
        yield held


def group_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each node's component, for links ``a[i] - b[i]`` between ``n`` nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while not np.array_equal(root, jumped := root[root]):
            root = jumped
        if np.array_equal(before, root):
            break
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (``a``, ``b``: long, not null): one row (``node``, ``root``) for each linked node.

    ``root`` is the smallest node of the component. Large-star and small-star rounds, each one written to the shared
    folder; a node's neighbours meet only in sums and joins, never in a list.
    """
    current = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "links")
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = cut(small.unionByName(nearest.withColumnRenamed("m", "b")).distinct(), "links")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    rest = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return rest.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
