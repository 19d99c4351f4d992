"""Near-duplicate vectors by randomised-rotation binary codes.

A vector is turned by a random rotation and kept as the signs of its components, with the factor that makes the inner
product with any rotated vector an unbiased estimate. The same signs, in groups, are the keys under which vectors meet:
enough groups that a pair at the threshold misses all of them with a probability of ``miss`` at most. Where vectors meet,
estimate and confidence bound decide which pairs can reach the threshold; only those are computed exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import components, cut, group_roots, sorted_groups
from sentrylake.llm.vectors import matrix, rotation, usable


@dataclass(frozen=True)
class Codes:
    """``bits`` signs make a key, of ``tables`` keys; ``spread`` is the number of deviations that the bounds allow."""

    bits: int
    tables: int
    seed: int = 5
    spread: float = 6.0

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """Signs under as many rotations as the keys need, one row for each vector."""
        turns = max(1, -(-self.bits * self.tables // unit.shape[1]))
        return np.hstack([unit @ rotation(unit.shape[1], self.seed, t) > 0 for t in range(turns)])

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The key in each table, as one column for each."""
        if not self.bits:
            return np.zeros((len(unit), 1), np.int64)
        signs = self.signs(unit)[:, :self.bits * self.tables].reshape(len(unit), self.tables, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))


def plan_codes(largest: int, threshold: float, room: int, miss: float, seed: int = 5) -> Codes:
    """Keys that leave about ``room`` of ``largest`` unrelated vectors together."""
    bits = min(60, max(0, math.ceil(math.log2(max(largest, 1) / room))))
    if not bits:
        return Codes(0, 1, seed)
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return Codes(bits, math.ceil(math.log(miss) / math.log1p(-same)), seed)


def close_pairs(unit: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float, codes: Codes,
                block: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (left row, right row) with a cosine of at least ``threshold``; the exact test follows the bound."""
    dimension = unit.shape[1]
    turned = (unit @ rotation(dimension, codes.seed, 0)).astype(np.float32)
    code = np.where(turned > 0, np.float32(1), np.float32(-1)) / np.float32(math.sqrt(dimension))
    factor = np.einsum("ij,ij->i", code, turned)  # how much of a vector its code keeps
    slack = codes.spread * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dimension - 1, 1))
    for at in range(0, len(left), block):
        rows = left[at:at + block]
        estimate = (code[rows] @ turned[right].T) / factor[rows, None]
        # |error| <= slack * sin(angle), so a pair at the threshold or above has an estimate of at least this much.
        least = threshold - slack[rows] * math.sqrt(1 - threshold**2) - 1e-4
        a, b = np.nonzero(estimate >= least[:, None])
        for start in range(0, len(a), 200_000):
            x, y = rows[a[start:start + 200_000]], right[b[start:start + 200_000]]
            close = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            yield x[close], y[close]


def _meetings(codes: Codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("dimension"))
            for size in np.unique(sizes):
                rows = batch.take(pa.array(np.flatnonzero(sizes == size)))
                vectors = matrix(rows.column("vector"))
                keys = codes.keys(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
                for table in range(keys.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(np.full(len(rows), table, np.int32)), pa.array(keys[:, table])],
                        [*rows.schema.names, "table", "key"])

    return run


def _linked(codes: Codes, threshold: float, rows: int):
    names = ["class", "dimension", "table", "key", "first", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, "cell", rows):
            part = part.combine_chunks()
            # Cells are hashes: what they stand for is compared as well.
            of = np.stack([part.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
            order = np.lexsort(of.T)
            of = of[order]
            ends = np.flatnonzero(np.append((of[1:] != of[:-1]).any(axis=1), True)) + 1
            for start, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                if end - start > 1 and (found := _in_cell(part.take(order[start:end]), codes, threshold)) is not None:
                    yield found

    return run


def _in_cell(cell: pa.Table, codes: Codes, threshold: float) -> pa.RecordBatch | None:
    node, copies, chunk = (cell.column(c).to_numpy() for c in ("node", "copies", "chunk"))
    table, first, second = (cell.column(c)[0].as_py() for c in ("table", "first", "second"))
    vectors = matrix(cell.column("vector"))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    keys = codes.keys(unit)
    left, right = np.flatnonzero(chunk == first), np.flatnonzero(chunk == second)
    degree, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for x, y in close_pairs(unit, left, right, threshold, codes):
        if first == second:
            x, y = x[x < y], y[x < y]
        # A pair counts in the first table in which it meets.
        new = (keys[x, :table] != keys[y, :table]).all(axis=1)
        x, y = x[new], y[new]
        np.add.at(degree, x, copies[y])
        np.add.at(degree, y, copies[x])
        kept = np.concatenate([np.arange(len(node)), x]), np.concatenate([root, y])
        root = group_roots(*kept, len(node))
    hit = np.flatnonzero(degree)
    if not len(hit):
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(node[hit]), pa.array(node[root[hit]]), pa.array(degree[hit])], ["node", "root", "links"])


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_column: str = "vec_id", vector_column: str = "embedding",
                 class_column: str = "label", room: int = 1024, miss: float = 1e-6, chunk: int = 2048,
                 rows: int = 20_000) -> DataFrame:
    """One row (id, n_links, component_id, kept) for each row of ``vectors``.

    Rows with the same class and dimension link if their cosine, in double precision, is at least ``threshold``. Rows
    without an id, class or usable vector (null, zero, null or non-finite components) link with nothing: 0 links, their
    own id as component, kept. Equal vectors are compared once and count as often as they occur; rows that repeat an id
    are rows of their own. ``miss`` bounds the chance that a pair right at the threshold is not compared. A key under
    which more than ``chunk`` vectors meet is split in pairs of chunks, all of which are compared. An empty table gives
    an empty result.
    """
    integral = vectors.schema[class_column].dataType.typeName() in ("byte", "short", "integer", "long")
    group = F.col(class_column).cast("long") if integral else F.xxhash64(class_column)
    takes_part = usable(vector_column) & F.col(class_column).isNotNull() & F.col(id_column).isNotNull()
    named = vectors.select(
        F.col(id_column).alias("id"), F.when(takes_part, F.col(vector_column)).alias("vector"), group.alias("class"))
    named = named.withColumn("dimension", F.size("vector"))
    named = named.withColumns({"node": F.xxhash64("class", "vector"), "check": F.xxhash64("vector", "class", F.lit(1))})
    some = named.where("vector is not null")
    distinct = cut(some.groupBy("node", "check").agg(
        F.first("vector").alias("vector"), F.first("class").alias("class"), F.first("dimension").alias("dimension"),
        F.min("id").alias("first_id"), F.count("*").alias("copies")), "vectors")
    largest = distinct.groupBy("class", "dimension").count().agg(F.max("count")).first()[0] or 0
    codes = plan_codes(largest, threshold, room, miss)

    kind = distinct.schema["vector"].dataType.simpleString()
    schema = f"node long, class long, dimension int, copies long, vector {kind}, table int, key long"
    met = distinct.select("node", "class", "dimension", "copies", "vector").mapInArrow(_meetings(codes), schema)
    meeting = ["class", "dimension", "table", "key"]
    crowded = cut(met.groupBy(*meeting).count().where(F.col("count") > chunk).select(
        *meeting, F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "vector-crowds")
    split = met.join(crowded, meeting, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    split = split.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    split = split.withColumn("other", F.explode(others)).withColumns({
        "first": F.least("chunk", "other"), "second": F.greatest("chunk", "other")})
    cells = split.withColumn("cell", F.xxhash64(*meeting, "first", "second")).drop("chunks", "other")
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    links = cut(cells.mapInArrow(_linked(codes, threshold, rows), "node long, root long, links long"), "vector-links")

    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degrees = links.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = distinct.select("node", "check", "first_id", "copies").join(degrees, "node", "left").join(roots, "node", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "node"))
    names = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    nodes = cut(nodes.join(names, "root").select(
        "node", "check", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "vector-nodes")
    found = named.select("id", "node", "check", F.col("vector").isNotNull().alias("takes"))
    keyed = found.where("takes").join(nodes, ["node", "check"]).select("id", "n_links", "component_id")
    alone = found.where("not takes").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return keyed.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def oracle_sql(threshold: float = 0.93) -> str:
    """The registered query's rows as SQL, for ids that do not repeat: all pairs of a class, and all that links reach."""
    return f"""
        WITH RECURSIVE vectors AS (
            SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        usable AS (SELECT *, list_inner_product(v, v) AS square FROM vectors WHERE list_inner_product(v, v) > 0),
        links AS (
            SELECT a.id AS a, b.id AS b
            FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.id <> b.id
            WHERE list_inner_product(a.v, b.v) / sqrt(a.square * b.square) >= {threshold}),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        lowest AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
        degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(vec_id, root), vec_id) AS component_id,
               root IS NULL OR vec_id <= root AS kept
        FROM embeddings LEFT JOIN lowest ON vec_id = lowest.a LEFT JOIN degrees ON vec_id = degrees.a"""
