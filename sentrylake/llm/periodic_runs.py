"""Runs of repeated word groups, found by a suffix automaton with link-cut access.

The states on the suffix path of a prefix are the words' suffixes that end there. Each word in turn recolours that path
with its place: what a stretch of the path was coloured before is where these suffixes ended last. A suffix of ``length``
words that last ended ``d`` words earlier, ``d <= length``, repeats itself with period ``d`` over ``length + d`` words: a
square, which reaches back as far as the period does. It is a run if the next word breaks the period. The paths are kept
as splay trees, so a word costs a logarithmic number of steps on average.

Most texts hold no run, so a filter goes first that leaves no run out: every group of ``k`` neighbouring words of a run
occurs in the run again. Only stretches of groups that occur twice or more in their text get an automaton.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import WORD, raw_texts

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, length) of each state and the state of each prefix. State 1 is the empty word, its link 0."""
    following: list[dict[int, int]] = [{}, {}]
    link, length, prefix = [0, 0], [0, 0], []
    last = 1
    for word in words:
        new = len(link)
        following.append({})
        link.append(1)
        length.append(length[last] + 1)
        at = last
        while at and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at:
            old = following[at][word]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                short = len(link)
                following.append(following[old].copy())
                link.append(link[old])
                length.append(length[at] + 1)
                while at and following[at].get(word) == old:
                    following[at][word] = short
                    at = link[at]
                link[old] = link[new] = short
        prefix.append(new)
        last = new
    return link, length, prefix


class LastEnds:
    """The place where each state's words ended last: paths of one colour, each a splay tree ordered by depth."""

    def __init__(self, link: list[int]):
        n = len(link)
        self.up = link  # of a tree's root: the state above its path
        self.left, self.right = [0] * n, [0] * n
        self.colour = [-1] * n  # valid at the root of a tree

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            y = up[x]
            if not y:
                return
            if left[y] == x:
                x_left = True
            elif right[y] == x:
                x_left = False
            else:
                return
            z = up[y]
            top = not z or (left[z] != y and right[z] != y)
            if not top and (left[z] == y) == x_left:
                self._rotate(y)
                self._rotate(x)
            else:
                self._rotate(x)
                if not top:
                    self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            self.colour[x] = self.colour[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            up[inner] = y
        up[y] = x
        up[x] = z

    def access(self, state: int, place: int) -> list[tuple[int, int]]:
        """Colours the path from the state up with ``place``; (deepest state, colour before) of each piece of it."""
        found, below, x = [], 0, state
        up, right, colour = self.up, self.right, self.colour
        while x:
            self._splay(x)
            before = colour[x]
            if before >= 0:
                found.append((x, before))
            if rest := right[x]:
                colour[rest] = before
            right[x] = below
            below, x = x, up[x]
        colour[below] = place
        return found


def runs_of(words: list[int], least: int, periods: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run with at least ``least`` words and ``periods`` (2 or more) periods."""
    link, length, prefix = suffix_automaton(words)
    ends, found, n = LastEnds(link), [], len(words)
    for i, state in enumerate(prefix):
        for deepest, before in ends.access(state, i):
            size, period = length[deepest], i - before
            if size + period >= least and size >= (periods - 1) * period and (
                    i + 1 == n or words[i + 1] != words[i + 1 - period]):
                found.append((i + 1 - size - period, size + period, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def group_size(least: int, periods: int) -> int:
    """The most neighbouring words that occur twice or more in any run, wherever in the run they begin."""
    return max(1, min(max(least, periods * q) + 1 - 2 * q for q in range(1, least + 1)))


def repeated_stretches(ids: np.ndarray, text: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
    """(first, after) of the stretches of at least ``least`` words all of whose groups of ``k`` recur in their text.

    ``text`` numbers the text of each word; a word of its own after each text keeps stretches within texts. Groups are
    told apart by 64-bit hashes, so a stretch may be here without need, but none is lacking.
    """
    n = len(ids) - k + 1
    if n <= 0:
        return []
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * _SPREAD
        mixed ^= mixed >> np.uint64(29)
        hashes = text[:n].astype(np.uint64)
        for i in range(k):
            hashes *= _SPREAD
            hashes += mixed[i:i + n]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(n + 2, bool)
    again[order[1:][same] + 1] = True
    again[order[:-1][same] + 1] = True
    edges = np.flatnonzero(again[1:] != again[:-1])
    first, after = edges[::2], edges[1::2] + k - 1
    long = after - first >= least
    return list(zip(first[long].tolist(), after[long].tolist(), strict=True))


def _runs_of_texts(texts: list[list[bytes]], least: int, periods: int) -> list[list[tuple[int, int, int]]]:
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    ids = [list(map(numbers.__getitem__, words)) for words in texts]
    for i, part in enumerate(ids):
        part.append(-2 - i)
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate([np.array(part, np.int64) for part in ids])
    starts = np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, after in repeated_stretches(flat, np.repeat(np.arange(len(texts)), sizes), group_size(least, periods), least):
        text = int(np.searchsorted(starts, first, side="right")) - 1
        shift = first - int(starts[text])
        found[text] += [(shift + s, size, q) for s, size, q in runs_of(flat[first:after].tolist(), least, periods)]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def _in_parts(texts: list[bytes | None], size: int) -> Iterator[list[bytes]]:
    part, held = [], 0
    for text in texts:
        part.append(text or b"")
        held += len(part[-1])
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 24,
              periods: int = 3) -> DataFrame:
    """One row (id, ``runs``, ``collapsed``) for each document.

    Words are what ASCII white space parts; they are numbered from 0 and compared byte by byte. ``runs`` lists every
    stretch (start, length, period) that repeats with its smallest period, has at least ``least`` words and ``periods``
    periods and cannot be extended, by start, then period. ``collapsed`` is the text's words without those that stand in
    a run after its first period, joined by single blanks. Null and empty texts have no run and collapse to the empty
    text; repeated rows are answered each for itself, null ids kept; an empty table gives an empty result. Other columns
    are not read. A task holds about 2 MB of texts at once, or one longer text, and an automaton for one stretch of
    repeated words (some 1 kB a word).
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    if least < 1 or periods < 2:
        raise ValueError("runs have two periods or more")
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _in_parts(raw_texts(batch.column(1)), 2_000_000):
                texts = [raw.split() for raw in part]
                runs = _runs_of_texts(texts, least, periods)
                listed = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                collapsed = pa.array(list(map(_collapsed, texts, runs)), pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(listed, kind), collapsed], ["id", "runs", "collapsed"])
                at += len(part)

    id_kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {id_kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.withColumnRenamed("id", id_column)


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equals that with the smallest start, then period."""
    def before(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    return F.get(F.array_sort(runs, before), F.lit(0))


def with_repeated_tails(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, with the end of every tenth (by the id's crc32) replaced by repeats of a part of it.

    With h the crc32, g = h // 10 and n words, word i from a = g % n on becomes word a + (i - a) % p, where p = 1 +
    (n - a) // (3 + g % 8). A text without an id or without words stays as it is.
    """
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    chosen = docs.withColumns({
        "_g": F.floor(h / 10), "_words": F.when(h % 10 == 0, F.regexp_extract_all(F.col(text_column), F.lit(WORD), F.lit(0)))})
    n = F.size("_words")
    placed = chosen.withColumn("_a", F.when(n > 0, F.col("_g") % n).cast("int"))
    placed = placed.withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    rest = n - F.col("_a")
    unit = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("_p")).cast("int"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), tail), " ")
    return placed.withColumn(text_column, F.when(F.col("_a").isNotNull(), changed).otherwise(F.col(text_column))).drop(
        "_g", "_words", "_a", "_p")
