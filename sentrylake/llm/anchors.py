"""Anchors: places in byte strings that all occurrences of a repeated string agree on.

Of the ``gram``-byte substrings of a window of ``length`` bytes the one with the smallest hash is the window's anchor,
the leftmost one in a tie. Equal windows have equal anchors at equal places. Neighbouring windows with the same anchor
make a segment: the bytes from the first one's start to the last one's end. A segment's windows are exactly the
``length``-byte strings in it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_BYTES = np.random.default_rng(2024).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 20) - 1)
_BUFFER = 1 << 18
_POWERS = np.cumprod(np.append(np.uint64(1), np.full(2 * _BUFFER, _BASE)))
_INVERSES = np.cumprod(np.append(np.uint64(1), np.full(2 * _BUFFER, _INVERSE)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums over all prefixes, from which ``span_hash`` takes the hash of any substring."""
    return np.append(np.uint64(0), np.cumsum(_BYTES[data] * _POWERS[:len(data)], dtype=np.uint64))


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _mixed((sums[end] - sums[start]) * _INVERSES[start] + (end - start).astype(np.uint64))


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values, from running minima within blocks of that width."""
    padded = np.append(values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    forth = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(back[:n], forth[width - 1:width - 1 + n])


@dataclass
class Segments:
    """``text`` numbers the text, ``start`` its first window's place; ``windows`` how many there are."""

    text: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def _pieces(texts: list[bytes], length: int):
    """Runs of (text number, offset, bytes) of about a buffer each; long texts come in parts that share no window."""
    run, size = [], 0
    for number, text in enumerate(texts):
        for offset in range(0, len(text) - length + 1, _BUFFER):
            part = text[offset:offset + _BUFFER + length - 1]
            if size + len(part) > 2 * _BUFFER - 1 and run:
                yield run
                run, size = [], 0
            run.append((number, offset, part))
            size += len(part)
    if run:
        yield run


def segments(texts: list[bytes], length: int, gram: int) -> Segments:
    """All segments of the texts; those shorter than ``length`` bytes have none."""
    found: list[list[np.ndarray]] = []
    for run in _pieces(texts, length):
        data = np.frombuffer(b"".join(part for _, _, part in run), np.uint8)
        sizes = np.array([len(part) for _, _, part in run])
        ends = np.cumsum(sizes)
        sums = prefix_sums(data)
        places = np.arange(len(data) - gram + 1)
        hashes = _mixed((sums[gram:] - sums[:-gram]) * _INVERSES[:len(places)])
        least = _window_minimum((hashes & ~_PLACE) | places.astype(np.uint64), length - gram + 1)
        anchor = (least & _PLACE).astype(np.int64)
        piece = np.repeat(np.arange(len(run)), sizes)[:len(anchor)]
        inside = np.flatnonzero(np.arange(len(anchor)) + length <= ends[piece])
        first = np.append(True, (anchor[inside[1:]] != anchor[inside[:-1]]) | (inside[1:] != inside[:-1] + 1))
        starts = inside[first]
        windows = np.diff(np.append(np.flatnonzero(first), len(inside)))
        of = piece[starts]
        numbers, offsets = np.array([n for n, _, _ in run]), np.array([o for _, o, _ in run])
        found.append([numbers[of], starts - (ends - sizes)[of] + offsets[of], windows, hashes[anchor[starts]],
                      span_hash(sums, starts, starts + windows + length - 1)])
    if not found:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Segments(*(np.concatenate(x) for x in zip(*found, strict=True)))
