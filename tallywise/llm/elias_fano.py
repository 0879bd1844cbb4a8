"""Elias-Fano codes of non-decreasing integers, with a select structure.

A value is cut into ``width`` low bits, kept as they are, and high bits, kept as gaps in unary: bit ``high + i`` is set
for the i-th value. That takes about ``2 + log2(largest / count)`` bits a value. Every 256th set bit's place is kept,
so ``select`` reads a bounded stretch.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
HEAD = "<QQBQQ"  # count, first value, width, bytes of low bits, bytes of high bits


def encoded(values: np.ndarray) -> bytes:
    """The code of a non-decreasing array of non-negative integers."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return struct.pack(HEAD, 0, 0, 0, 0, 0)
    first = int(values[0])
    rest = values - values[0]
    width = max(0, (int(rest[-1]) // n).bit_length() - 1) if int(rest[-1]) >= n else 0
    shifts = np.arange(width, dtype=np.uint64)
    low = np.packbits(((rest[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") if width else np.zeros(0, np.uint8)
    place = (rest >> np.uint64(width)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(place[-1]) + 1, np.uint8)
    bits[place] = 1
    high = np.packbits(bits, bitorder="little")
    return struct.pack(HEAD, n, first, width, len(low), len(high)) + low.tobytes() + high.tobytes() + place[::STEP].astype("<u8").tobytes()


class Reader:
    """Reads a code from a buffer; ``end`` is where it ends."""

    def __init__(self, data, at: int = 0):
        self.n, self.first, self.width, lows, highs = struct.unpack_from(HEAD, data, at)
        at += struct.calcsize(HEAD)
        self.low = np.frombuffer(data, np.uint8, lows, at)
        self.high = np.frombuffer(data, np.uint8, highs, at + lows)
        marks = -(-self.n // STEP)
        self.marks = np.frombuffer(data, "<u8", marks, at + lows + highs)
        self.end = at + lows + highs + 8 * marks

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for b in range(self.width):
            bit = i * self.width + b
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.marks[i // STEP]), i % STEP
        byte = at >> 3
        size = 64
        while True:
            bits = np.unpackbits(self.high[byte : byte + size], bitorder="little")
            ones = np.flatnonzero(bits[at - 8 * byte :])
            if len(ones) > left:
                break
            size *= 4
        high, bit = at + int(ones[left]) - i, i * self.width
        low = int.from_bytes(self.low[bit >> 3 : (bit >> 3) + 9].tobytes(), "little") >> (bit & 7) & ((1 << self.width) - 1)
        return self.first + (high << self.width) + low

    def all(self) -> np.ndarray:
        """All values."""
        if not self.n:
            return np.zeros(0, np.uint64)
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        return high + self._low(np.arange(self.n)) + np.uint64(self.first)
