"""Hashed words and shingles of whole texts, a batch of an Arrow column at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, U64), np.ones(1, U64)]
#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = mix(_LOWER.astype(U64) + U64(12345))
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: Everything of ASCII but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(n, base, U64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: pa.Array, gaps: np.ndarray = SPACE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of the batch: its first row, all words' hashes in order, and the rows' bounds among them.

    Words are maximal runs of bytes outside ``gaps``, with A-Z in lower case; a null text has none. A word's hash is a
    polynomial over its bytes, modulo 2 ** 64, taken from running sums over the piece and then mixed.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        cut = offsets[row : last + 1] - offsets[row]
        part = data[offsets[row] : offsets[last]]
        n = len(part)
        inside = ~gaps[part]
        first, end = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = cut[:-1][cut[:-1] < cut[1:]]
        first[edges] = inside[edges]
        end[edges[1:] - 1] = inside[edges[1:] - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(end) + 1
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, U64)
        np.cumsum(_BYTES[part] * up[:n], out=sums[1:])
        yield row, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)), np.searchsorted(starts, cut)
        row = last


def runs_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    if len(words) < n:
        return np.zeros(0, U64)
    h = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        h = h * U64(_BASE) + words[k : len(words) - n + 1 + k]
    return mix(h)


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of a text's n-word shingles, in order; of fewer words, the whole sequence is the one shingle."""
    if len(words) >= n:
        return runs_of(words, n)
    return runs_of(words, len(words)) + U64(len(words)) if len(words) else np.zeros(0, U64)


def text_shingles(texts: pa.Array, n: int = 5, gaps: np.ndarray = SPACE) -> Iterator[np.ndarray]:
    """Each row's shingles, in order, for all rows of the batch."""
    for _, words, bounds in word_hashes(texts, gaps):
        all_runs = runs_of(words, n)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield all_runs[a : b - n + 1] if b - a >= n else shingles(words[a:b], n)
