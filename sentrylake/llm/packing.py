"""Best-fit packing by the configuration linear program.

Tokens are counted in tasks; only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. A
configuration is a multiset of lengths that fits one sequence. The program - cover all pieces with as few configurations
as possible - is solved by multiplicative weights: each length has a price, a knapsack dynamic program finds the most
valuable configuration, it is used for a share of what is left, and the prices of the lengths it holds fall. Each use is
rounded to whole sequences and never holds more than is left, so what is left is the program's own remainder, solved on in
the next rounds. Tasks then look up the place of the r-th piece of each length.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentrylake.llm.common import cut

_PIECES: dict[str, Pieces] = {}
# Marks where texts are cut; a text that holds it is not cut.
_MARK = "\0"
# What a part begins or ends with: white space or nothing, a line feed that is the whole part, a comma or full stop, a letter
# or digit, something else. No part is cut off before or after white space, and before a comma only after a letter or digit.
_SPACE, _LINE, _MARKS, _ALNUM, _OTHER = range(5)


class Pieces:
    """Token ids of texts.

    A byte-level vocabulary always begins a token at a blank or a line feed between two characters that are no white space,
    and at a comma or full stop after a letter or digit, so a text may be cut there. Arrow cuts a batch of texts and finds
    its distinct parts; a part is tokenised once and remembered. Over ``most`` parts the less used half is forgotten. Ids
    are put together by offsets. A longer run of white space or of other characters is never cut.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.most = most
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.empty(0, "<u4"), np.zeros(1, np.int64)
        self.used = np.zeros(0, np.int64)
        # Of each part: what it begins and ends with, see the constants above.
        self.begins, self.ends = np.zeros(0, np.int8), np.zeros(0, np.int8)

    def _forget(self) -> None:
        """Keeps the half that was used most."""
        keep = np.sort(np.argsort(-self.used, kind="stable")[:self.most // 2])
        names = list(self.known)
        self.known = {names[j]: i for i, j in enumerate(keep.tolist())}
        sizes = np.diff(self.starts)[keep]
        self.flat = self.flat[_ranges(self.starts[keep], sizes)]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.used, self.begins, self.ends = self.used[keep] // 2, self.begins[keep], self.ends[keep]

    def _encode(self, parts: list[str]) -> list[np.ndarray]:
        """The ids of each part. What the tokenizer returns is many times as large, so it is asked for some parts at a time."""
        out, first, size = [], 0, 0
        for at, part in enumerate(parts, 1):
            size += len(part)
            if size >= 1 << 18 or at == len(parts):
                found = self.tokenizer.encode_batch_fast(parts[first:at], add_special_tokens=False)
                out += [np.array(e.ids, "<u4") for e in found]
                first, size = at, 0
        return out

    def _entries(self, words: list[str]) -> np.ndarray:
        """The number of each part; new ones are tokenised, plain words many at once with a line feed between them."""
        entry = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(entry < 0)
        if not len(new):
            return entry
        parts = [words[j] for j in new.tolist()]
        begins, ends = [_begin(w) for w in parts], [_end(w) for w in parts]
        plain = [self.line is not None and b == _OTHER and e in (_OTHER, _ALNUM) and "\n" not in w and not any(x in w for x in self.added)
                 for w, b, e in zip(parts, begins, ends, strict=True)]
        many = list(itertools.compress(range(len(parts)), plain))
        single = [i for i, one in enumerate(plain) if not one]
        runs = [many[i:i + 1000] for i in range(0, len(many), 1000)]
        found, sizes = [], [np.zeros(0, np.int64)]
        for run, ids in zip(runs, self._encode(["\n".join([parts[i] for i in run]) for run in runs]), strict=True):
            between = np.flatnonzero(ids == self.line)
            if len(between) == len(run) - 1:
                found.append(ids[ids != self.line])
                sizes.append(np.diff(np.concatenate([[-1], between, [len(ids)]])) - 1)
            else:  # no vocabulary of the kind described above
                each = self._encode([parts[i] for i in run])
                found += each
                sizes.append(np.array([len(x) for x in each]))
        each = self._encode([parts[i] for i in single])
        found += each
        sizes.append(np.array([len(x) for x in each], np.int64))
        order = many + single
        first = len(self.known)
        self.known.update(zip([parts[i] for i in order], range(first, first + len(order)), strict=True))
        self.flat = np.concatenate([self.flat, *found])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])
        self.used = np.concatenate([self.used, np.zeros(len(order), np.int64)])
        self.begins = np.concatenate([self.begins, np.array(begins, np.int8)[order]])
        self.ends = np.concatenate([self.ends, np.array(ends, np.int8)[order]])
        entry[new[order]] = np.arange(first, first + len(order))
        return entry

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's end; no text is null."""
        if len(self.known) > self.most:
            self._forget()
        words, index, ends = _parted(texts)
        at = self._entries(words)[index]
        begin, end = self.begins[at], self.ends[at]
        # What follows a line feed is cut off only if what goes before it is.
        good = np.ones(len(at) + 1, bool)
        good[1:-1] = (end[:-1] != _SPACE) & np.where(begin[1:] == _MARKS, end[:-1] == _ALNUM, begin[1:] != _SPACE)
        good[ends[:-1]] = True
        good[1:-1] &= (end[:-1] != _LINE) | good[:-2]
        if not good.all():
            first = np.flatnonzero(good[:-1])
            size = np.diff(np.append(first, len(at)))
            long = np.flatnonzero(size > 1)
            joined = ["".join([words[j] for j in index[i:i + n].tolist()]) for i, n in zip(first[long].tolist(), size[long].tolist(), strict=True)]
            ends = np.searchsorted(first, ends)
            at = at[first]
            distinct = list(dict.fromkeys(joined))
            places = dict(zip(distinct, self._entries(distinct).tolist(), strict=True))
            at[long] = [places[x] for x in joined]
        self.used += np.bincount(at, minlength=len(self.used))
        sizes = self.starts[at + 1] - self.starts[at]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[_ranges(self.starts[at], sizes)], upto[ends]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _begin(part: str) -> int:
    """What a part begins with, after one blank at most."""
    if part == "\n":
        return _LINE
    if part[:1] in (",", "."):
        return _MARKS
    rest = part[1:2] if part[:1] == " " else part[:1]
    return _OTHER if rest.strip() else _SPACE


def _end(part: str) -> int:
    if part == "\n":
        return _LINE
    last = part[-1:]
    return _ALNUM if last.isalnum() else _OTHER if last.strip() else _SPACE


def _parted(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct parts, the part at each place, and where each text's places end. Blanks stay with the part they begin."""
    marked = texts
    for before, after in ((" ", _MARK + " "), ("\n", f"{_MARK}\n{_MARK}"), (",", _MARK + ","), (".", _MARK + ".")):
        marked = pc.replace_substring(marked, before, after)
    parts = pc.split_pattern(marked, _MARK)
    if pc.any(pc.match_substring(texts, _MARK)).as_py():
        parts = pa.array([[t] if _MARK in t else p for t, p in zip(texts.to_pylist(), parts.to_pylist(), strict=True)],
                         pa.list_(pa.string()))
    ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False)).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), ends


def _in_runs(pieces: Pieces, texts: pa.Array, size: int = 1_000_000) -> Iterator[np.ndarray]:
    """Ids of each text, taken together in runs of about ``size`` bytes.

    The worker lives on and serves later stages, so memory that Arrow keeps for the parts of a run is given back after all.
    """
    lengths = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = int(lengths[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(lengths, before + size)))
        ids, ends = pieces.ids(texts.slice(start, stop - start))
        yield from np.split(ids, ends[:-1])
        start = stop
    pa.default_memory_pool().release_unused()


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_column: str,
                  text_column: str) -> DataFrame:
    """One row (id, piece, start, length, ids_crc32) for each piece; only documents over ``capacity`` are cut.

    All pieces of a cut document but the first are full.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(tokenizer_path)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(_in_runs(pieces, batch.column(1))):
                n, first = len(ids) + 1, 0
                to = n % capacity or capacity
                while first < n:
                    at.append(row)
                    piece.append(0 if first == 0 else piece[-1] + 1)
                    start.append(first)
                    length.append(to - first)
                    read = zlib.crc32(ids[first:to])
                    crc.append(zlib.crc32(end, read) if to == n else read)
                    first, to = to, to + capacity
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc)]], ["id", "piece", "start", "length", "ids_crc32"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def best_configuration(prices: np.ndarray, capacity: int, counts: np.ndarray) -> list[int]:
    """Lengths of the most valuable multiset that fits ``capacity``, none more often than ``counts`` (knapsack table).

    Multiples of a length are taken in powers of two, so the table has a few rows for each length.
    """
    best = np.zeros(capacity + 1)
    taken: list[tuple[int, int, np.ndarray]] = []
    for length in np.flatnonzero((prices > 0) & (counts > 0)):
        left, times = min(int(counts[length]), capacity // int(length)), 1
        while left > 0:
            times = min(times, left)
            size = int(length) * times
            with_it = best[:capacity + 1 - size] + times * prices[length]
            better = with_it > best[size:] + 1e-12
            taken.append((int(length), times, better))
            best[size:] = np.where(better, with_it, best[size:])
            left, times = left - times, times * 2
    room, found = int(np.argmax(best)), []
    for length, times, better in reversed(taken):
        size = length * times
        if room >= size and better[room - size]:
            found += [length] * times
            room -= size
    return sorted(found, reverse=True)


def solve(histogram: dict[int, int], capacity: int, step: float = 0.5, rate: float = 50.0, bend: float = 2.0,
          choice: int = 64) -> list[tuple[tuple[int, ...], int]]:
    """Configurations with how often each is used; together they hold exactly the pieces of ``histogram``.

    A piece's price is its length, up to ``1 + bend`` times as much for long ones, for which there are fewer gaps, and
    falls by exp(-share / rate) with the share of its length that is placed: among configurations that fill a sequence
    alike the lengths that are behind win, so all run out together and short ones are there to fill gaps up to the end. A
    configuration is used for at most the share ``step`` of any length in it, rounded down, once at least. The knapsack
    looks at the ``choice`` dearest lengths and as many others, at more if these do not fill a sequence.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan: Counter[tuple[int, ...]] = Counter()
    if left[capacity]:
        plan[(capacity,)] += int(left[capacity])
        left[capacity] = 0
    demand = np.maximum(left, 1)
    while len(there := np.flatnonzero(left)):
        placed = 1 - left[there] / demand[there]
        worth = there * np.exp(-(placed - placed.min()) / rate) * (1 + bend * there / capacity)
        # The dearest piece, and the most valuable filling of the room beside it.
        head = int(there[np.argmax(worth)])
        left[head] -= 1
        room = capacity - head
        fits = (there <= room) & (left[there] > 0)
        fitting, value = there[fits], worth[fits]
        dearest = fitting[np.argsort(-value / fitting, kind="stable")]
        filling: list[int] = []
        for few in (choice, 4 * choice, len(fitting)):
            some = np.union1d(dearest[:few], fitting[::max(1, len(fitting) // max(few, 1))])
            prices = np.zeros(room + 1)
            prices[some] = value[np.searchsorted(fitting, some)]
            filling = best_configuration(prices, room, left[:room + 1])
            if sum(filling) == room or len(some) == len(fitting):
                break
        left[head] += 1
        lengths = sorted([head, *filling], reverse=True)
        held = Counter(lengths)
        times = max(1, min(min(int(left[x]), int(demand[x] * step)) // n for x, n in held.items()))
        plan[tuple(lengths)] += times
        for x, n in held.items():
            left[x] -= n * times
    return sorted(plan.items(), key=lambda p: (p[0], p[1]), reverse=True)


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, first sequence, offset, step) that place the r-th piece of a length.

    A configuration used m times holds the same length at one offset in m neighbouring sequences.
    """
    rows, rank, sequence = [], Counter(), 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length, rank[length], times, sequence, offset))
            rank[length] += times
            offset += length
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_column: str = "doc_id",
         text_column: str = "text", salts: int = 128,
         solver: Callable[[dict[int, int], int], list[tuple[tuple[int, ...], int]]] = solve) -> DataFrame:
    """One row (id, piece, start, length, ids_crc32, sequence_id, offset) for each piece.

    A null text counts as empty and makes one piece that holds only the end id. Repeated rows are packed each for
    itself. An empty table gives an empty result. Other columns are not read.
    """
    pieces = cut_documents(docs, tokenizer_path, capacity, end_id, id_column, text_column)
    salt = F.pmod(F.xxhash64("id", "piece"), F.lit(salts)).cast("int")
    pieces = cut(pieces.withColumn("salt", salt), "pieces")
    counts = cut(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    spark = docs.sparkSession
    schema = T.StructType([T.StructField(x, T.LongType()) for x in ("length", "rank", "ranks", "sequence", "offset")])
    places = spark.createDataFrame(slots(solver(histogram, capacity)), schema)
    # A piece's rank among its length: its number within (length, salt) after all pieces of smaller salts.
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = F.row_number().over(W.partitionBy("length", "salt").orderBy("id", "piece")) - 1
    ranked = pieces.withColumn("number", numbered).join(
        F.broadcast(counts.select("length", "salt", before.alias("before"))), ["length", "salt"])  # capacity * salts rows
    ranked = ranked.withColumn("r", F.col("number") + F.col("before"))
    per_length = places.groupBy("length").agg(F.array_sort(F.collect_list(
        F.struct("rank", "ranks", "sequence", "offset"))).alias("places"))
    hit = F.get(F.filter("places", lambda p: (p["rank"] <= F.col("r")) & (F.col("r") < p["rank"] + p["ranks"])), F.lit(0))
    placed = ranked.join(F.broadcast(per_length), "length").withColumn("at", hit)
    return placed.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32",
        (F.col("at")["sequence"] + F.col("r") - F.col("at")["rank"]).alias("sequence_id"), F.col("at")["offset"].alias("offset"))
