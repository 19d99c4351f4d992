"""Blocks of lines from text files, read line by line in splits.

Blank lines part the blocks, whatever blanks they hold and however lines end. A split is read by one task, which joins its
lines to blocks in order; only the lines before the first blank line of a split and those after its last may belong to a
block that begins or ends in another split. These edges, two at most for each split, are put together by file; everything
else never leaves its task. Files of a single split have no edges and are read once; of larger ones the edges are found by
a second read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLANKS = " \t\r\n\x0b\x0c"
# What a piece of a split is, in the order in which pieces of one split follow each other.
WHOLE, HEAD, BLOCK, TAIL = range(4)
_PIECES = "file string, start long, kind int, raw string"


class _Split:
    """Joins the lines of one split. ``alone`` is a split that is its file."""

    def __init__(self, file: str, start: int, alone: bool):
        self.file, self.start, self.alone = file, start, alone
        self.open: list[str] = []
        self.parted = False

    def add(self, lines: pa.Array) -> Iterator[tuple[int, str]]:
        """The pieces that these lines finish."""
        blank = pc.equal(pc.utf8_trim(lines, BLANKS), "")
        places = pc.indices_nonzero(blank).to_pylist()
        if not places:
            self.open.append("\n".join(lines.to_pylist()))
            return
        text, at = lines.to_pylist(), 0
        for place in places:
            if place > at:
                self.open.append("\n".join(text[at:place]))
            at = place + 1
            first, self.parted = not self.parted, True
            if self.open or (first and not self.alone):
                yield HEAD if first and not self.alone else BLOCK, "\n".join(self.open)
            self.open = []
        if at < len(text):
            self.open.append("\n".join(text[at:]))

    def end(self) -> Iterator[tuple[int, str]]:
        if self.alone:
            if self.open:
                yield BLOCK, "\n".join(self.open)
        else:
            yield TAIL if self.parted else WHOLE, "\n".join(self.open)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows: list[tuple[str, int, int, str]] = []
        # A task may hold several splits, one after another.
        files, starts = batch.column("file"), batch.column("start")
        changed = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1]))
        edges = [0, *(i + 1 for i in pc.indices_nonzero(changed).to_pylist()), batch.num_rows]
        for at, after in itertools.pairwise(edges):
            file, start = files[at].as_py(), starts[at].as_py()
            if split is None or (split.file, split.start) != (file, start):
                if split is not None:
                    rows += [(split.file, split.start, *piece) for piece in split.end()]
                split = _Split(file, start, batch.column("alone")[at].as_py())
            rows += [(file, start, *piece) for piece in split.add(batch.column("line").slice(at, after - at))]
        yield _batch(rows)
    if split is not None:
        yield _batch([(split.file, split.start, *piece) for piece in split.end()])


def _batch(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "kind", "raw"])


def _split_lines(spark: SparkSession, path: str | list[str], glob: str | None, where: Column | None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path)
    lines = lines.where(where) if where is not None else lines
    block = F.col("_metadata.file_block_length")
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        ((F.col("_metadata.file_block_start") == 0) & (block == F.col("_metadata.file_size"))).alias("alone"),
        F.col("value").alias("line"))


def read_blocks(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(``file``, ``raw``) for each block of non-blank lines; ``raw`` holds the lines joined by line feeds.

    Lines end with LF, CRLF or CR. A line of blanks alone parts blocks like an empty one. Files without text have no block.
    Large files are read by many tasks; a block may lie on any number of splits. A block must fit in a task's memory.
    """
    pieces = _split_lines(spark, path, glob, None).mapInArrow(_pieces, _PIECES)
    inside = pieces.where(F.col("kind") == BLOCK).select("file", "raw")
    # Files that are too small to be split are not even read a second time.
    sizes = [_bytes(spark.conf.get(f"spark.sql.files.{name}")) for name in ("openCostInBytes", "maxPartitionBytes")]
    parted = _split_lines(spark, path, glob, F.col("_metadata.file_size") > min(sizes)).where("NOT alone")
    edges = parted.mapInArrow(_pieces, _PIECES).where(F.col("kind") != BLOCK)
    return inside.unionByName(_joined(edges))


def _bytes(setting: str) -> int:
    """A size such as ``4194304``, ``64k`` or ``128MB``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def _joined(edges: DataFrame) -> DataFrame:
    """The blocks that lie on several splits: each begins with the tail of a split or with the file."""
    order = Window.partitionBy("file").orderBy("start", "kind")  # at most two rows for each split of a file
    opened = F.sum((F.col("kind") == TAIL).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    text = F.array_sort(F.collect_list(F.when(F.col("raw") != "", F.struct("start", "kind", "raw"))))
    blocks = edges.withColumn("block", opened).groupBy("file", "block").agg(text.alias("parts"))
    return blocks.where(F.size("parts") > 0).select("file", F.array_join("parts.raw", "\n").alias("raw"))
