"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample: each node parts its vectors at the median of their projection on the difference
of two of them. Every row of the table is sent down every tree to a leaf. A query walks all trees at once through one
priority queue, nearest margin first, until the leaves it has seen hold the share of the sample that reached the wanted
recall on the sample itself. Queries and rows meet leaf by leaf, and the candidates are ranked by their exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentrylake.llm.common import cut, sorted_groups
from sentrylake.llm.vectors import matrix, usable


@dataclass
class Tree:
    """Node ``i`` sends a vector left or right by ``x @ planes[i] < cuts[i]``; a negative child -k-1 is leaf k."""

    planes: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    members: list[np.ndarray]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector."""
        at = np.zeros(len(vectors), np.int64) if len(self.cuts) else np.full(len(vectors), -1, np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.planes[node]) >= self.cuts[node]
            at[inner] = self.children[node, side.astype(np.int64)]
        return -at - 1


def grow_tree(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    planes, cuts, children, members = [], [], [], []

    def grow(rows: np.ndarray) -> int:
        if len(rows) > leaf:
            for _ in range(4):  # a pair of equal vectors parts nothing
                a, b = sample[rng.choice(rows, 2, replace=False)]
                if (norm := np.linalg.norm(a - b)) > 0:
                    projected = sample[rows] @ ((a - b) / norm)
                    middle = float(np.median(projected))
                    right = projected >= middle
                    if not right.all():
                        node = len(cuts)
                        planes.append((a - b) / norm)
                        cuts.append(middle)
                        children.append([0, 0])
                        children[node] = [grow(rows[~right]), grow(rows[right])]
                        return node
        members.append(rows)
        return -len(members)

    grow(np.arange(len(sample)))
    return Tree(np.array(planes).reshape(len(cuts), sample.shape[1]), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), members)


@dataclass
class Forest:
    trees: list[Tree]
    size: int
    share: float = 1.0

    def search(self, query: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """Leaves as (tree, leaf, share of the sample seen so far), by the smallest margin crossed on the way."""
        sides = [tree.planes @ query - tree.cuts if len(tree.cuts) else np.zeros(0) for tree in self.trees]
        queue = [(0.0, t, 0 if len(tree.cuts) else -1) for t, tree in enumerate(self.trees)]
        seen, n = np.zeros(self.size, bool), 0
        while queue:
            margin, t, node = heapq.heappop(queue)
            tree, side = self.trees[t], sides[t]
            while node >= 0:
                right = int(side[node] >= 0)
                heapq.heappush(queue, (max(margin, abs(float(side[node]))), t, int(tree.children[node, 1 - right])))
                node = int(tree.children[node, right])
            own = tree.members[-node - 1]
            n += int((~seen[own]).sum())
            seen[own] = True
            yield t, -node - 1, n / max(self.size, 1)

    def leaves(self, query: np.ndarray) -> list[tuple[int, int]]:
        found = []
        for tree, leaf, share in self.search(query):
            found.append((tree, leaf))
            if share >= self.share:
                break
        return found


def grow_forest(sample: np.ndarray, trees: int, leaf: int, k: int, recall: float, tests: int, seed: int) -> Forest:
    """A forest, with the smallest share of the sample that ``tests`` of its vectors must search for ``recall``."""
    forest = Forest([grow_tree(sample, leaf, np.random.default_rng([seed, t])) for t in range(trees)], len(sample))
    if len(sample) <= k + 1:
        return forest
    needed = []
    for i in range(0, len(sample), max(1, len(sample) // tests)):
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        distance[i] = -1
        nearest = np.argpartition(distance, k)[:k + 1]
        when = np.full(len(sample), 1.0)
        before = 0.0
        for t, leaf_number, share in forest.search(sample[i]):
            own = forest.trees[t].members[leaf_number]
            when[own] = np.minimum(when[own], before)  # found once the share searched exceeds this
            before = share
            if share >= 1:
                break
        needed += when[nearest[nearest != i]].tolist()
    forest.share = min(1.0, float(np.quantile(needed, recall)) + 1e-9)
    return forest


def _rows_to_leaves(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("vector"))
            for t, tree in enumerate(forest.trees):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(len(batch), t, np.int32)), pa.array(tree.leaves(vectors))],
                    [*batch.schema.names, "tree", "leaf"])

    return run


def _queries_to_leaves(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                some = batch.slice(start, 256)
                found = [(i, t, leaf) for i, q in enumerate(matrix(some.column("vector"))) for t, leaf in forest.leaves(q)]
                at, trees, leaves = zip(*found, strict=True)
                rows = some.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(trees, pa.int32()), pa.array(leaves, pa.int64())],
                    [*rows.schema.names, "tree", "leaf"])

    return run


def _best(query: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` nearest different items of each query, ties to the smaller id."""
    order = np.lexsort((item, score, query))
    pair = np.lexsort((score, item, query))
    q, i = query[pair], item[pair]
    first = np.zeros(len(query), bool)
    first[pair] = np.append(True, (q[1:] != q[:-1]) | (i[1:] != i[:-1]))
    order = order[first[order]]
    q = query[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return order[rank < k]


def _ranked(k: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, "cell", rows):
            part = part.combine_chunks()
            cell, ids, asks = (part.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "id", "asks"))
            vectors = matrix(part.column("vector"))
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            held: list[list[np.ndarray]] = [[], [], []]
            for start, end in zip(starts, np.append(starts[1:], len(cell)), strict=True):
                here = np.arange(start, end)
                queries, items = here[asks[here]], here[~asks[here]]
                block = max(1, 4_000_000 // max(1, len(items) * vectors.shape[1]))
                for at in range(0, len(queries), block):
                    some = queries[at:at + block]
                    score = np.sqrt(((vectors[some][:, None, :] - vectors[items][None]) ** 2).sum(axis=2))
                    q, i = np.nonzero(ids[some][:, None] != ids[items][None])
                    q, i, s = ids[some][q], ids[items][i], score[q, i]
                    best = _best(q, i, s, k)
                    for column, values in zip(held, (q, i, s), strict=True):
                        column.append(values[best])
            if held[0]:
                q, i, s = (np.concatenate(x) for x in held)
                best = _best(q, i, s, k)
                yield pa.RecordBatch.from_arrays([pa.array(x[best]) for x in (q, i, s)], ["query_id", "item", "score"])

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
            trees: int = 8, leaf: int = 96, sample: int = 20_000, recall: float = 0.97, tests: int = 150, chunk: int = 4096,
            rows: int = 20_000, seed: int = 11) -> DataFrame:
    """The ``k`` nearest rows found for each query: (query_id, rank, id, score), by Euclidean distance in doubles.

    Queries are the rows for which ``is_query`` holds. The forest is grown on the ``sample`` rows with the smallest hash
    of their id; every row is indexed and can be found. Rows without an id or a usable vector take no part, nor do
    vectors of another dimension than most of the sample. Rows that repeat an id count as one item, at its nearest
    vector, and never answer themselves; ties go to the smaller id. A leaf with more than ``chunk`` rows is split, and its
    queries go to every part. Fewer than ``k`` rows come back where there are fewer; an empty table gives none.
    """
    some = vectors.where(usable(vector_column) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    taken = some.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow().column(0)
    sizes = np.array([len(x) for x in taken])
    if not len(sizes):
        empty = some.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_column),
                            F.lit(0.0).alias("score"))
        return empty.where("false")
    size = int(np.bincount(sizes).argmax())
    known = matrix(taken.filter(pa.array(sizes == size)))
    forest = grow_forest(known, trees, leaf, k, recall, tests, seed)  # bounded by the sample
    some = some.where(F.size("vector") == size)
    kind = some.schema["vector"].dataType.simpleString()
    schema = f"id long, vector {kind}, asks boolean, tree int, leaf long"
    items = some.withColumn("asks", F.lit(False)).mapInArrow(_rows_to_leaves(forest), schema)
    asked = some.where("asks").mapInArrow(_queries_to_leaves(forest), schema)
    # At most trees * sample / leaf * 2 leaves: the counts of all leaves are a small table.
    counts = items.groupBy("tree", "leaf").count()
    parts = cut(counts.select("tree", "leaf", F.ceil(F.col("count") / chunk).cast("int").alias("parts")), "leaf-parts")
    items = items.join(F.broadcast(parts), ["tree", "leaf"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    asked = asked.join(F.broadcast(parts), ["tree", "leaf"]).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = items.unionByName(asked).withColumn("cell", F.xxhash64("tree", "leaf", "part"))
    met = met.select("cell", "id", "asks", "vector").repartition("cell").sortWithinPartitions("cell")
    found = met.mapInArrow(_ranked(k, rows), "query_id long, item long, score double")
    found = found.groupBy("query_id", "item").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "item"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("item").alias(id_column), "score")
