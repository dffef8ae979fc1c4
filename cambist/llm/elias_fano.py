"""Elias-Fano code of a non-decreasing sequence, with a select directory.

A value is cut at ``low`` bits. Low parts stand side by side; high parts are a bit
row in which one number i sets bit (high_i + i). The i-th value's high part is then
select1(i) - i. Every ``SAMPLE``-th set bit's place is listed, so that a select reads
one short stretch. About 2 + log2(universe / n) bits a value, no table of offsets:
the listed places are as wide as the longest needs, four bytes in any usual file.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQBBQQQ")


def _pack(values: np.ndarray, width: int) -> bytes:
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    def __init__(self, n, base, low, lows, highs, directory):
        self.n, self.base, self.low = n, base, low
        self.lows, self.highs, self.directory = lows, highs, directory

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        """``values``: non-decreasing 64-bit integers, signed or not."""
        values = np.asarray(values).astype(np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, b"", np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        base = int(values[0])
        shifted = values.view(np.uint64) - np.uint64(base % (1 << 64))
        low = max(0, (int(shifted[-1]) // n).bit_length() - 1)
        ones = (shifted >> np.uint64(low)) + np.arange(n, dtype=np.uint64)
        row = np.zeros(int(ones[-1]) + 1, np.uint8)
        row[ones.astype(np.int64)] = 1
        lows = _pack(shifted & np.uint64((1 << low) - 1), low) if low else b""
        places = ones[::SAMPLE]
        narrow = int(places[-1]) < 1 << 32
        return cls(n, base, low, lows, np.packbits(row, bitorder="little"), places.astype(np.uint32 if narrow else np.uint64))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bits = np.frombuffer(self.lows, np.uint8)
        place = i[:, None].astype(np.int64) * self.low + np.arange(self.low)
        got = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1
        return (got.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def _value(self, high, low) -> np.ndarray:
        return ((high.astype(np.uint64) << np.uint64(self.low)) + low + np.uint64(self.base % (1 << 64))).view(np.int64)

    def select(self, i: int) -> int:
        """The i-th value, from one stretch between two listed places."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        one = self._stretch(i // SAMPLE)[i % SAMPLE]
        return int(self._value(np.array([one - i]), self._low(np.array([i])))[0])

    def select_many(self, places) -> np.ndarray:
        """The values at many places, in their order, from the stretches behind the listed places they need."""
        places = np.asarray(places, np.int64)
        if len(places) and not (0 <= places.min() and places.max() < self.n):
            raise IndexError(places)
        order = np.argsort(places, kind="stable")
        wanted, ones = places[order], np.empty(len(places), np.int64)
        samples, first = np.unique(wanted // SAMPLE, return_index=True)
        for sample, a, b in zip(samples.tolist(), first.tolist(), [*first[1:].tolist(), len(wanted)]):
            ones[order[a:b]] = self._stretch(sample)[wanted[a:b] % SAMPLE]
        return self._value(ones - places, self._low(places))

    def _stretch(self, sample: int) -> np.ndarray:
        """The set bits' places from one listed place to the next."""
        begin = int(self.directory[sample])
        stop = int(self.directory[sample + 1]) + 1 if sample + 1 < len(self.directory) else 8 * len(self.highs)
        bits = np.unpackbits(self.highs[begin >> 3 : (stop + 7) >> 3], bitorder="little")[begin & 7 :]
        return np.flatnonzero(bits) + begin

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        return self._value(places - np.arange(self.n), self._low(np.arange(self.n)))

    def to_bytes(self) -> bytes:
        width = self.directory.itemsize
        highs, directory = self.highs.tobytes(), self.directory.astype(f"<u{width}").tobytes()
        head = _HEAD.pack(self.n, self.base % (1 << 64), self.low, width, len(self.lows), len(highs), len(directory))
        return head + self.lows + highs + directory

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple["EliasFano", int]:
        """The sequence at a place of a file, and the place behind it."""
        n, base, low, width, a, b, c = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        highs = np.frombuffer(data, np.uint8, b, at + a)
        directory = np.frombuffer(data, f"<u{width}", c // width, at + a + b)
        return cls(n, base - (1 << 64) * (base >> 63), low, data[at : at + a], highs, directory), at + a + b + c
