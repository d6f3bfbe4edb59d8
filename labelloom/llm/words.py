"""Words of many texts at once, as numpy arrays.

A batch of texts is one byte array; words are found and hashed without a loop
over them. The hash is a 64-bit polynomial of the word's bytes, so equal words
have equal hashes in every batch and process.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALPHANUMERIC = bytes(i for i in range(128) if not chr(i).isalnum())
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_byte_values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
PIECE = 1 << 15  # bytes hashed at once, which fit a processor's cache
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of them. Only
    those for a usual piece are kept: workers live on from stage to stage."""
    if _powers and n <= len(_powers[0][0]):
        return _powers[0]
    size = max(n, PIECE + 1)
    both = np.full((2, size), [[MULTIPLIER], [INVERSE]], dtype=np.uint64)
    both[:, 0] = 1
    up, down = np.multiply.accumulate(both, axis=1)
    if size == PIECE + 1:
        _powers.append((up, down))
    return up, down


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each word, in pieces of whole words. It does not depend on
    where the word stands, nor on the pieces."""
    hashes = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        low = start[at]
        stop = max(at + 1, int(np.searchsorted(end, low + PIECE, side="right")))
        piece, s, e = data[low : end[stop - 1]], start[at:stop] - low, end[at:stop] - low
        up, down = powers(len(piece) + 1)
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_byte_values[piece] * up[: len(piece)], out=total[1:])
        hashes[at:stop] = mix64((total[e] - total[s]) * down[s])
        at = stop
    return hashes


@dataclass
class Words:
    data: np.ndarray  # all bytes, a line feed after each text
    text_start: np.ndarray  # (texts + 1), where each text begins in ``data``
    start: np.ndarray  # of each word, in ``data``
    end: np.ndarray
    text: np.ndarray  # which text a word belongs to
    hash: np.ndarray

    def counts(self, texts: int) -> np.ndarray:
        return np.bincount(self.text, minlength=texts)


def find_words(texts: Sequence[str | None], separators: bytes = WHITE_SPACE, lower: bool = True) -> Words:
    """Maximal runs of bytes that are no separator. ``lower`` changes A-Z only;
    a null text has no words. ``separators`` must contain the line feed."""
    raw = [t.encode() if t else b"" for t in texts]
    sizes = np.array([len(t) + 1 for t in raw], dtype=np.int64)
    joined = b"\n".join(raw) + b"\n" if raw else b""
    data = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
    text_start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    is_separator = np.zeros(256, dtype=bool)
    is_separator[list(separators)] = True
    inside = np.concatenate([[False], ~is_separator[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    hashes = _hashes(data, start, end)
    text = np.repeat(np.arange(len(raw)), np.diff(np.searchsorted(start, text_start)))
    return Words(data, text_start, start, end, text, hashes)


def shingle_sets(words: Words, texts: int, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of ``size`` words; a text
    with fewer words has its whole sequence as one; without words, none."""
    counts = words.counts(texts)
    ends = np.cumsum(counts)
    starts = ends - counts
    h, n = words.hash, len(words.hash)
    # A run's hash depends on its words, their order and, for short texts, their number.
    factors = [mix64(np.array([0x51ED + k], dtype=np.uint64))[0] | np.uint64(1) for k in range(size)]
    if n >= size:
        total = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            total += mix64(h[k : n - size + 1 + k] * factors[k])
        runs = mix64(total)
    else:
        runs = np.zeros(0, dtype=np.uint64)
    sets = []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        if e - s >= size:
            sets.append(np.unique(runs[s : e - size + 1]))
        elif e > s:
            part = np.array([e - s], dtype=np.uint64)
            for k in range(e - s):
                part = part + mix64(h[s + k : s + k + 1] * factors[k])
            sets.append(mix64(part))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
