"""Removal of repeated byte strings with a run-length index, split by anchors.

All occurrences of a repeated string agree on an anchor (``anchors.py``), so strings are compared only where anchors are
equal. Segments that are equal as a whole are repeated throughout and settled by counting. Different segments around the
same anchor are fetched, one copy of each, and indexed together (``run_index.py``): the matching statistics say which of
their windows stand twice. An anchor with too many different segments for one index is settled window by window, by
counting hashes of the windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.llm import run_index
from sentrylake.llm.anchors import prefix_sums, segments, span_hash
from sentrylake.llm.common import cut, sorted_groups

_SPANS = "array<struct<first:bigint,last:bigint>>"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _texts(column: pa.Array, most: int = 8_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``most`` bytes, with the row of the first one."""
    start, run, size = 0, [], 0
    for row, value in enumerate(column):
        run.append(value.as_buffer().to_pybytes() if value.is_valid else b"")
        size += len(run[-1])
        if size >= most:
            yield start, run
            start, run, size = row + 1, [], 0
    if run:
        yield start, run


def _anchored(docs: DataFrame, length: int, gram: int, columns: list[str]) -> DataFrame:
    """One row for each segment: ``anchor``, ``content``, ``start``, ``windows`` and ``columns`` of its document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in _texts(batch.column(0)):
                s = segments(texts, length, gram)
                own = [batch.column(c).take(pa.array(s.text + row)) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [_signed(s.anchor), _signed(s.content), pa.array(s.start), pa.array(s.windows), *own],
                    ["anchor", "content", "start", "windows", *columns])

    rows = docs.select(F.col("text").cast("binary").alias("text"), *columns)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(run, "anchor long, content long, start long, windows long" + (f", {kinds}" if kinds else ""))


def _squeezed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the text compressed, as it travels to a join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for row, texts in _texts(batch.column(0)):
                own = [batch.column(c).slice(row, len(texts)) for c in columns]
                yield pa.RecordBatch.from_arrays([*own, pa.array([squeeze(t) for t in texts], pa.binary())], [*columns, "packed"])

    rows = docs.select(F.col("text").cast("binary").alias("text"), *columns)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(run, f"{kinds}, packed binary")


def _fetch(length: int, gram: int):
    """Bytes of the wanted segments (anchor, content) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found = [], [], []
            for packed, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                text = expand(packed.as_py())
                s = segments([text], length, gram)
                at = {key: i for i, key in enumerate(zip(s.anchor.view(np.int64).tolist(), s.content.view(np.int64).tolist(), strict=True))}
                for want in wanted:
                    if (i := at.get((want["anchor"], want["content"]))) is not None:
                        start = int(s.start[i])
                        for column, value in zip(found, (*want.values(), text[start:start + int(s.windows[i]) + length - 1]), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.binary())],
                ["anchor", "content", "bytes"])

    return run


def _spans(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edge[::2].tolist(), (edge[1::2] - 1).tolist()


def _indexed(length: int, rows: int):
    """Spans of windows (first, last) of each segment that stand in another segment of the same anchors as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, "anchor", rows):
            # Rows that repeat a document were fetched with it.
            named = np.stack([part.column(c).to_numpy() for c in ("anchor", "content")], axis=1)
            part = part.filter(pa.array(np.append(True, (named[1:] != named[:-1]).any(axis=1))))
            out: tuple[list, list, list, list] = ([], [], [], [])
            hits = run_index.repeated(part.column("bytes").to_pylist(), length)
            for anchor, content, hit in zip(part.column("anchor").to_pylist(), part.column("content").to_pylist(), hits, strict=True):
                for first, last in zip(*_spans(hit), strict=True):
                    for column, value in zip(out, (anchor, content, first, last), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["anchor", "content", "first", "last"])

    return run


def _windows(length: int):
    """Every window of the segments, as a hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw in enumerate(batch.column("bytes").to_pylist()):
                sums, first = prefix_sums(np.frombuffer(raw, np.uint8)), np.arange(len(raw) - length + 1)
                own = [batch.column(c).take(pa.array(np.full(len(first), row))) for c in ("anchor", "content")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(first), _signed(span_hash(sums, first, first + length))], ["anchor", "content", "first", "window"])

    return run


def repeated_windows(docs: DataFrame, id_column: Column, length: int, gram: int, most: int, rows: int) -> DataFrame:
    """(id, key, first, last): spans of places in documents (``text``, ``key``) at which a repeated string starts."""
    docs = docs.withColumn("id", id_column)
    shared = _anchored(docs, length, gram, []).groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    shared = cut(shared.where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("settled")), "anchors")
    met = cut(_anchored(docs, length, gram, ["id", "key"]).join(shared, "anchor"), "segments")

    # One row for each different segment around an anchor that has several.
    different = met.where("not settled").groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min("key").alias("key"), F.min("windows").alias("windows"))
    different = cut(different, "different-segments")
    crowded = cut(different.groupBy("anchor").count().where(F.col("count") > most).select("anchor"), "crowded-anchors")
    wanted = different.groupBy("key").agg(F.collect_list(F.struct("anchor", "content")).alias("wanted"))
    fetched = _squeezed(docs, ["key"]).join(wanted, "key")
    fetched = fetched.select("packed", "wanted").mapInArrow(_fetch(length, gram), "anchor long, content long, bytes binary")
    fetched = cut(fetched, "fetched-segments")

    single = fetched.join(crowded, "anchor", "left_anti")
    single = single.repartition("anchor").sortWithinPartitions("anchor", "content")
    matched = single.mapInArrow(_indexed(length, rows), "anchor long, content long, first long, last long")
    many = fetched.join(crowded, "anchor", "left_semi").dropDuplicates(["anchor", "content"])
    many = many.mapInArrow(_windows(length), "anchor long, content long, first long, window long")
    twice = cut(many.groupBy("anchor", "window").count().where("count > 1").select("anchor", "window"), "crowded-windows")
    counted = many.join(twice, ["anchor", "window"]).select("anchor", "content", "first", F.col("first").alias("last"))
    copied = different.where("n > 1").select(
        "anchor", "content", F.lit(0).cast("long").alias("first"), (F.col("windows") - 1).alias("last"))
    spans = cut(matched.unionByName(counted).unionByName(copied).groupBy("anchor", "content").agg(
        F.collect_list(F.struct("first", "last")).alias("spans")), "segment-spans")
    whole = met.where("settled").select(
        "id", "key", F.col("start").alias("first"), (F.col("start") + F.col("windows") - 1).alias("last"))
    partly = met.where("not settled").join(spans, ["anchor", "content"]).select("id", "key", "start", F.explode("spans").alias("s"))
    partly = partly.select("id", "key", (F.col("start") + F.col("s.first")).alias("first"), (F.col("start") + F.col("s.last")).alias("last"))
    return whole.unionByName(partly)


def kept_bytes(raw: bytes, spans: list[dict], length: int) -> tuple[bytes, int]:
    """What is left of a text without the ``length`` bytes from each place of the spans; and the number of cuts."""
    kept, at, cuts = [], 0, 0
    for first, last in sorted((s["first"], s["last"]) for s in spans):
        if first > at or not cuts:
            kept.append(raw[at:first])
            cuts += 1
        at = max(at, last + length)
    kept.append(raw[at:])
    return b"".join(kept), cuts


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 200, gram: int = 32,
                   most: int = 2000, rows: int = 4000) -> DataFrame:
    """One row (id, n_bytes, n_removed, n_spans, kept) for each document; ``kept`` holds the bytes that stay.

    A byte goes if it is covered by a string of ``length`` bytes that starts at another place as well, in the same
    document or another one. A null text counts as empty. Rows that repeat an id and a text are occurrences of their own.
    An empty table gives an empty result. Other columns are not read. Strings are told apart by 64-bit hashes of the
    whole segment together with 64 bits of its anchor.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("id", "text"))
    found = repeated_windows(texts, F.col("id"), length, gram, most, rows)
    spans = found.groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    packed = _squeezed(texts, ["id", "key"]).alias("d").join(
        spans.alias("s"), F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.key") == F.col("s.key")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, cuts, left = [], [], [], []
            for text, own in zip(batch.column(1), batch.column(2), strict=True):
                raw = expand(text.as_py())
                kept, n = kept_bytes(raw, own.as_py() or [], length)
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept))
                cuts.append(n)
                left.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (sizes, removed, cuts)], pa.array(left, pa.binary())],
                [id_column, "n_bytes", "n_removed", "n_spans", "kept"])

    kind = texts.schema["id"].dataType.simpleString()
    return packed.select("d.id", "packed", F.col("spans").cast(_SPANS)).mapInArrow(
        run, f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
