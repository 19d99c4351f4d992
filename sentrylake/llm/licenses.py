"""License scans: MinHash bands of overlapping windows retrieve templates, exact shingle containment verifies them.

Texts and templates are sets of five-word shingles. Templates are grouped by size; for each size a text is read in windows
a quarter longer than the size, a quarter of it apart, so every passage of that size lies in one of them. A template of
which a window holds the share ``containment`` has at least the similarity ``least_similarity`` to it; the number of
bands, of one minimum each, is chosen so that the chance of missing it is ``miss`` at most.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import raw_texts, words_of
from sentrylake.llm.license_texts import TEMPLATES

SHINGLE = 5
_EDGE = b".,;:!?\"'()[]{}<>*#/\\|-=_`"
_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Words without marks at their edges, as hashes; what a token is hashed to is remembered, a million at a time."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _hash(self, token: bytes) -> int:
        if len(self.known) > 1_000_000:
            self.known.clear()
        word = token.strip(_EDGE)
        # Two checksums; 0 stands for a token of marks alone.
        found = (zlib.crc32(word) << 32 | zlib.adler32(word)) or 1 if word else 0
        self.known[token] = found
        return found

    def shingles(self, raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes, and the place of each shingle's words among the tokens of the text (one row for each shingle).

        A text of fewer words than a shingle is one shingle; one without words has none.
        """
        tokens, known = words_of(raw), self.known
        words = np.fromiter((known[t] if t in known else self._hash(t) for t in tokens), np.uint64, len(tokens))
        places = np.flatnonzero(words)
        words = words[places]
        width = min(SHINGLE, len(words))
        n = len(words) - width + 1 if width else 0
        sums = np.full(n, width, np.uint64)
        for i in range(width):
            sums = _mixed(sums * _M + words[i:i + n])
        return sums, np.stack([places[:n], places[width - 1:]], axis=1) if n else np.zeros((0, 2), np.int64)


def least_similarity(size: int, smallest: int, containment: float) -> float:
    """Least Jaccard similarity of a window to a template of ``smallest`` to ``size`` shingles that it holds enough of."""
    return containment * smallest / (window_of(size)[0] + (1 - containment) * smallest)


def window_of(size: int) -> tuple[int, int]:
    """Length and distance of the windows for templates of ``size`` shingles; edits may stretch a passage by a quarter."""
    step = max(1, size // 4)
    return -(-5 * size // 4) + step, step


@dataclass
class Templates:
    """Per size: templates' numbers, their shingles, and the minima under each band's hash."""

    sizes: dict[int, list[int]]
    shingles: list[np.ndarray]
    names: list[str]
    bands: int
    factors: np.ndarray

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """Hashes of the shingles under each band (a row each)."""
        return _mixed(shingles[None, :] * self.factors[:, None])


def prepare(templates: list[tuple[str, str]], containment: float, miss: float, seed: int = 3) -> Templates:
    shingler = Shingler()
    shingles = [np.unique(shingler.shingles(text.encode())[0]) for _, text in templates]
    sizes: dict[int, list[int]] = {}
    for number, own in enumerate(shingles):
        if len(own):
            size = 1
            while size < len(own):
                size = max(size + 1, round(size * 1.4))
            sizes.setdefault(size, []).append(number)
    worst = min((least_similarity(size, min(len(shingles[t]) for t in own), containment) for size, own in sizes.items()), default=1.0)
    bands = max(1, math.ceil(math.log(miss) / math.log1p(-worst))) if worst < 1 else 1
    factors = np.random.default_rng(seed).integers(0, 2**63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return Templates(sizes, shingles, [name for name, _ in templates], bands, factors)


class Scanner:
    def __init__(self, templates: Templates, containment: float):
        self.templates, self.containment, self.shingler = templates, containment, Shingler()
        self.every = np.unique(np.concatenate([*templates.shingles, np.zeros(0, np.uint64)]))
        # Per size: sorted minima of all bands, and whose they are. A value of another band would only be one more candidate.
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, own in templates.sizes.items():
            minima = np.concatenate([templates.minima(templates.shingles[t]).min(axis=1) for t in own])
            order = np.argsort(minima)
            self.keys[size] = minima[order], np.repeat(own, templates.bands)[order]

    def candidates(self, hashes: np.ndarray, size: int) -> set[tuple[int, int, int]]:
        """(first shingle, end, template) of the windows that share a minimum with a template in some band."""
        length, step = window_of(size)
        n = hashes.shape[1]
        edges = np.arange(0, n, step)
        least = np.minimum.reduceat(hashes, edges, axis=1)
        # A window is a run of whole steps; windows at the end are shorter.
        windows = least.copy()
        for i in range(1, min(-(-length // step), least.shape[1])):
            np.minimum(windows[:, :-i], least[:, i:], out=windows[:, :-i])
        keys, numbers = self.keys[size]
        flat = windows.ravel()
        lo = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
        hit = np.flatnonzero(keys[lo] == flat)
        hi = np.searchsorted(keys, flat[hit], side="right")
        found = set()
        for at, a, b in zip((hit % windows.shape[1]).tolist(), lo[hit].tolist(), hi.tolist(), strict=True):
            start = int(edges[at])
            found.update((start, min(n, start + -(-length // step) * step), int(t)) for t in numbers[a:b])
        return found

    def scan(self, raw: bytes | None) -> list[tuple[int, int, int, float]]:
        """(template, first token, end token, containment) of each passage; overlapping windows of a template make one."""
        shingles, places = self.shingler.shingles(raw)
        # A window has a template's minimum only if it holds that shingle: a text without any shingle of theirs is done.
        near = np.minimum(np.searchsorted(self.every, shingles), len(self.every) - 1)
        if not len(shingles) or not len(self.every) or not (self.every[near] == shingles).any():
            return []
        hashes = self.templates.minima(shingles)
        hits: dict[int, list[tuple[int, int, float]]] = {}
        for size in self.templates.sizes:
            for start, end, number in sorted(self.candidates(hashes, size)):
                wanted = self.templates.shingles[number]
                inside = np.flatnonzero(np.isin(shingles[start:end], wanted)) + start
                share = len(np.unique(shingles[inside])) / len(wanted)
                if share >= self.containment:
                    hits.setdefault(number, []).append((int(places[inside[0], 0]), int(places[inside[-1], 1]) + 1, share))
        found = []
        for number, spans in hits.items():
            first, end, best = None, -1, 0.0
            for a, b, share in sorted(spans):
                if a < end:
                    end, best = max(end, b), max(best, share)
                else:
                    if first is not None:
                        found.append((number, first, end, best))
                    first, end, best = a, b, share
            found.append((number, first, end, best))
        return sorted(found, key=lambda f: (f[1], f[2], f[0]))


def best_of(found: list[tuple[int, int, int, float]]) -> list[int]:
    """For each passage the template, of those whose passages overlap it, that matches best; of equals the longer passage.

    Overlap is not handed on: a passage between two others does not make them one.
    """
    best = []
    for number, a, b, share in found:
        over = [(s, y - x, -n) for n, x, y, s in found if x < b and a < y]
        best.append(-max(over)[2])
    return best


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  templates: list[tuple[str, str]] = TEMPLATES, containment: float = 0.8, miss: float = 1e-6) -> DataFrame:
    """One row (id, license, template, start, end, containment, best_license) for each template passage in whole texts.

    ``templates`` are (license, text), known to all tasks; ``template`` is their number. ``start`` and ``end`` count
    words split at white space, end exclusive; ``containment`` is the largest share of the template's shingles in one
    window. ``best_license`` is the license of the best-matching of the templates whose passages overlap this one: related
    notices match more than one template, and this is the license to report. Case and marks at the edges of words do not matter. Null, empty and word-less texts give no row, nor do
    templates without words; repeated rows give their rows each; an empty table gives none. Other columns are not read.
    """
    prepared = prepare(templates, containment, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(prepared, containment)
        for batch in batches:
            rows = [(at, *hit, best) for at, raw in enumerate(raw_texts(batch.column(1)))
                    for found in [scanner.scan(raw)] for hit, best in zip(found, best_of(found), strict=True)]
            at, number, start, end, share, best = zip(*rows, strict=True) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array([prepared.names[n] for n in number], pa.string()),
                 pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(share, pa.float64()),
                 pa.array([prepared.names[n] for n in best], pa.string())],
                [id_column, "license", "template", "start", "end", "containment", "best_license"])

    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("_text"))
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(
        run, f"`{id_column}` {kind}, license string, template int, start long, end long, containment double, best_license string")
