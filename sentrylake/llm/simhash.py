"""SimHash near-duplicates: bit counts of short segments as a grid, joined within Manhattan distance, then verified.

Two bits make a segment. A segment's count (0, 1 or 2) is kept in unary by sorting its bits, so the Manhattan distance
of two count vectors is the number of differing bits of their sorted fingerprints, and it never exceeds the distance of
the fingerprints themselves. Of the two halves of a count vector at distance 3 or less, one is at distance 1 or less. A
fingerprint therefore stands in the grid cell of each half and visits the cells one count above it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import components, cut, group_roots, raw_texts, sorted_groups, words_of

_LOW = np.uint64(0x5555555555555555)
_HALF = np.uint64(0xFFFFFFFF)
# Byte value -> its eight bits, each in a byte of its own.
_SPREAD = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")[:, :, None]
                      .repeat(8, axis=2) & np.array([1, 0, 0, 0, 0, 0, 0, 0], np.uint8), axis=2, bitorder="little"
                      ).reshape(256, 8).view("<u8").ravel()


def fingerprint(raw: bytes | None, gram: int, seed: int) -> int:
    """Majority bits over the hashes of all word shingles; a text without words has fingerprint zero."""
    words = words_of(raw)
    if not words:
        return 0
    if len(words) <= gram:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, n = xxhash.xxh64_intdigest, len(words) - gram + 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(gram)), strict=False))
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 65_280):
        size = min(65_280, n - start)
        hashes = np.fromiter((digest(next(shingles), seed) for _ in range(size)), "<u8", size)
        lanes = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, size, 255), axis=0)
        ones += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", gram: int = 3,
                 seed: int = 42) -> DataFrame:
    """One row (id, ``fp``) for each document; ``fp`` is the 64-bit fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(raw, gram, seed) for raw in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp long")


def sorted_segments(fp: np.ndarray) -> np.ndarray:
    """Each two-bit segment with its ones moved to the low bit: its bit count in unary."""
    high = fp >> np.uint64(1)
    return ((fp | high) & _LOW) | ((fp & high & _LOW) << np.uint64(1))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        unary = sorted_segments(fp)
        for half in range(2):
            counts = (unary >> np.uint64(32 * half)) & _HALF
            salted = np.uint64(half << 32)
            yield _cell_rows(counts | salted, fp, False)
            for segment in range(16):
                low, high = np.uint64(1 << 2 * segment), np.uint64(2 << 2 * segment)
                up = np.where(counts & low, high, low)
                can = (counts & high) == 0
                yield _cell_rows((counts | up)[can] | salted, fp[can], True)


def _cell_rows(cell: np.ndarray, fp: np.ndarray, visits: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cell.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(np.full(len(fp), visits))],
        ["cell", "fp", "visits"])


def _links(limit: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, "cell", rows):
            cell = part.column("cell").to_numpy()
            fp = part.column("fp").to_numpy().view(np.uint64)
            visits = part.column("visits").to_numpy()
            unary = sorted_segments(fp)
            last = np.searchsorted(cell, cell, side="right")
            at = np.flatnonzero(last - np.arange(len(cell)) > 1)
            found, step = [], 1
            while len(at):
                a = at[~(visits[at] & visits[at + step])]
                a = a[np.bitwise_count(unary[a] ^ unary[a + step]) <= limit]
                found.append(np.stack([a, a + step])[:, np.bitwise_count(fp[a] ^ fp[a + step]) <= limit])
                step += 1
                at = at[at + step < last[at]]
            if not found:
                continue
            nodes, pairs = np.unique(fp, return_inverse=True)
            a, b = pairs[np.concatenate(found, axis=1)]
            root = group_roots(a, b, len(nodes))
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[moved].view(np.int64)), pa.array(nodes[root[moved]].view(np.int64))], ["a", "b"])

    return run


def link_fingerprints(prints: DataFrame, limit: int = 3, rows: int = 200_000) -> DataFrame:
    """Components of the distinct fingerprints that differ in ``limit`` (3 or fewer) bits: (``fp``, ``root``).

    Fingerprints without a partner have no row. All pairs of a cell are compared, in sorted runs of at least ``rows``
    rows; only a spanning set of their links leaves the task.
    """
    if not 0 <= limit <= 3:
        raise ValueError("the grid covers distances up to 3")
    cells = prints.select("fp").distinct().mapInArrow(_cells, "cell long, fp long, visits boolean")
    near = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_links(limit, rows), "a long, b long")
    return components(near).withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", gram: int = 3,
                    limit: int = 3, seed: int = 42) -> DataFrame:
    """One row (id, ``fingerprint``, ``component_id``) for each document.

    ``fingerprint`` is 16 hexadecimal digits; ``component_id`` the smallest id reachable by links of at most ``limit``
    differing bits. Null and empty texts have fingerprint zero and link like any other; rows that repeat an id count
    once as a class; null ids belong to the class of their fingerprint but never name it (null if all ids are null). An
    empty table gives an empty result. Other columns are not read.
    """
    prints = cut(fingerprints(docs, id_column, text_column, gram, seed), "simhash")
    roots = cut(link_fingerprints(prints, limit), "simhash-roots")
    first = prints.groupBy("fp").agg(F.min("id").alias("first"))
    named = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = cut(named.select("fp", "root").join(names, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
