"""Elias-Fano code of a non-decreasing sequence, with a select structure over its upper bits."""

from __future__ import annotations

import struct

import numpy as np

#: Every so many-th set bit's place is kept, so that a select scans a bounded piece of the upper bits.
SAMPLE = 256
_HEAD = struct.Struct("<QQB")


def _pack(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


class EliasFano:
    """n values of at most ``top`` take about n * (2 + log2(top / n)) bits and n / SAMPLE four-byte samples."""

    def __init__(self, n: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.top, self.low_bits, self.low, self.high, self.samples = n, top, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        places = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) + 1) if n else 0, np.uint8)
        high[places] = 1
        return cls(n, top, low_bits, np.frombuffer(_pack(low.astype(np.uint8).ravel()), np.uint8), np.frombuffer(_pack(high), np.uint8), places[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return _HEAD.pack(self.n, self.top, self.low_bits) + b"".join(struct.pack("<I", len(p)) + p for p in parts)

    @classmethod
    def from_bytes(cls, data, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that starts at ``at``, and where it ends."""
        n, top, low_bits = _HEAD.unpack_from(data, at)
        at, parts = at + _HEAD.size, []
        for kind in (np.uint8, np.uint8, np.uint32):
            (size,) = struct.unpack_from("<I", data, at)
            parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 4))
            at += 4 + size
        return cls(n, top, low_bits, *parts), at

    def select(self, i: int) -> int:
        """Place of the i-th set bit of the upper bits: from the sample before it, byte by byte."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        if not left:
            return at
        bits = np.unpackbits(self.high[(at + 1) >> 3 :], count=None, bitorder="little")[(at + 1) & 7 :] if len(self.high) < 4096 else None
        if bits is not None:
            return at + 1 + int(np.flatnonzero(bits)[left - 1])
        start, width = at + 1, 4096
        while True:  # doubles until the piece holds enough set bits
            piece = np.unpackbits(self.high[start >> 3 : (start >> 3) + width], bitorder="little")[start & 7 :]
            found = np.flatnonzero(piece)
            if len(found) >= left:
                return start + int(found[left - 1])
            width *= 2

    def __getitem__(self, i: int) -> int:
        low, first = 0, i * self.low_bits
        for k in range(self.low_bits):
            low |= int(self.low[(first + k) >> 3] >> ((first + k) & 7) & 1) << k
        return ((self.select(i) - i) << self.low_bits) | low

    def decode(self) -> np.ndarray:
        """All values at once."""
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        out = high.astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            out |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out
