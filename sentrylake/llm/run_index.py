"""A run-length index of a set of strings: compressed transform, sampled run ends, streamed matching statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class RunIndex:
    """``head`` has a row (place of the run's first suffix, place of the suffix before it, their common length).

    The suffixes of all strings are sorted, each string ending in a mark of its own. Only where the preceding character
    changes - at the ends of the transform's runs - is the common length of neighbouring suffixes kept; everywhere else it
    is one less than for the suffix that starts one place earlier.
    """

    size: int
    runs: np.ndarray
    head: np.ndarray

    def matching_statistics(self) -> np.ndarray:
        """For each place, the length of the longest string from there that also starts elsewhere.

        One pass in text order for either neighbour: a sample counts down until a longer one takes over.
        """
        places, best = np.arange(self.size), np.zeros(self.size, np.int64)
        for column in (0, 1):
            reach = np.zeros(self.size, np.int64)
            np.maximum.at(reach, self.head[:, column], self.head[:, 2] + self.head[:, column])
            best = np.maximum(best, np.maximum.accumulate(reach) - places)
        return best


def _classes(ordered: np.ndarray) -> np.ndarray:
    """For each entry of a sorted array, where its run of equal entries begins."""
    first = np.append(True, ordered[1:] != ordered[:-1])
    return np.flatnonzero(first)[np.cumsum(first) - 1]


def build(strings: list[bytes]) -> RunIndex:
    sizes = np.array([len(s) for s in strings])
    n, marks = int(sizes.sum()) + len(strings), len(strings)
    text = np.empty(n, np.int64)
    ends = np.cumsum(sizes + 1) - 1
    mark = np.zeros(n, bool)
    mark[ends] = True
    text[mark] = np.arange(marks)
    text[~mark] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + marks
    # Suffixes by their first symbols, packed into one number; then by twice as many, until all differ.
    bits = int(marks + 256).bit_length()
    step = 63 // bits
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = key << bits
        key[:n - i] |= text[i:]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = starts = _classes(key[order])
    shared = np.append(starts[1:] == starts[:-1], False) | np.append(False, starts[1:] == starts[:-1])
    open_, depth, levels = order[shared], step, [rank.astype(np.int32)]
    while len(open_):
        after = open_ + depth
        key = rank[open_] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        key, open_ = key[order], open_[order]
        old = rank[open_]
        starts = old + _classes(key) - _classes(old)
        rank[open_] = starts
        shared = np.append(starts[1:] == starts[:-1], False) | np.append(False, starts[1:] == starts[:-1])
        open_, depth = open_[shared], depth * 2
        levels.append(rank.astype(np.int32))
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    before = text[suffixes - 1]  # the transform; before the first symbol stands the last mark
    change = np.flatnonzero(before[1:] != before[:-1]) + 1
    a, b = suffixes[change], suffixes[change - 1]
    return RunIndex(n, np.append(0, change), np.stack([a, b, _common(text, levels, step, a, b)], axis=1))


def _common(text: np.ndarray, levels: list[np.ndarray], step: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, from the classes of all depths."""
    length, last = np.zeros(len(a), np.int64), len(text) - 1
    for level in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + length, last), np.minimum(b + length, last)
        length += np.where(levels[level][x] == levels[level][y], step << level, 0)
    same = np.ones(len(a), bool)
    for _ in range(step - 1):
        same &= text[np.minimum(a + length, last)] == text[np.minimum(b + length, last)]
        length += same
    return length


def repeated(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, whether the ``length`` bytes from each place stand anywhere else in the set."""
    statistics = build(strings).matching_statistics() >= length
    ends = np.cumsum([len(s) + 1 for s in strings])
    return [statistics[end - 1 - len(s):end - length] if len(s) >= length else np.zeros(0, bool)
            for s, end in zip(strings, ends, strict=True)]
