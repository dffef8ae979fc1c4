"""Words of many texts at once, with 64-bit codes, in numpy.

A word's code depends on its bytes alone, eight of which are mixed in at a step. Runs
of words are coded over the words' codes by doubling, so all windows of a text cost a
pass for each power of two up to their length. Nothing is summed modulo 2**64, where
patterned texts (Thue-Morse) cancel; ``same_bytes`` tells whether equal codes are
equal words, and whole texts are told apart by a digest of their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

U64 = np.uint64
SPACES = (0x20, *range(0x09, 0x0E))
#: Bytes of a run coded eight at a step.
STEPPED = 64
_ODD = U64(0x9E3779B97F4A7C15)


def _gaps(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


#: Bytes that part words: white space only, or every ASCII byte that is no letter or digit.
WHITE = _gaps(SPACES)
PUNCTUATION = _gaps(b for b in range(128) if not chr(b).isalnum())
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _seed(number: int) -> np.uint64:
    return U64(number * int(_ODD) % (1 << 64))


def byte_view(data: np.ndarray) -> np.ndarray:
    """Eight bytes, little-endian, from each place of the data on; zeros follow its end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def _upto(size: np.ndarray) -> np.ndarray:
    """Masks of the first bytes of eight; ``size`` from 1."""
    return ~U64(0) >> (U64(64) - U64(8) * np.minimum(size, 8).astype(np.uint64))


def byte_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A code for each run of bytes, eight bytes a step; runs over ``STEPPED`` bytes by a digest of their own."""
    size, view = end - start, byte_view(data)
    out = mix(size.astype(np.uint64) + _seed(seed))
    which = np.flatnonzero((size > 0) & (size <= STEPPED))
    for k in range(0, STEPPED, 8):
        which = which[size[which] > k]
        if not len(which):
            break
        out[which] = mix((out[which] ^ (view[start[which] + k] & _upto(size[which] - k))) * _ODD)
    long = np.flatnonzero(size > STEPPED).tolist()
    if long:
        out[long] = [xxh3_64_intdigest(data[start[i] : end[i]].tobytes(), seed) for i in long]
    return out


def same_bytes(data, start, end, others, begin, stop) -> np.ndarray:
    """Whether each run data[start:end] has the bytes of its partner others[begin:stop]."""
    size = end - start
    out = size == stop - begin
    left, right = byte_view(data), byte_view(others) if others is not data else None
    right = left if right is None else right
    which = np.flatnonzero(out & (size > 0))
    for i in which[size[which] > STEPPED].tolist():
        out[i] = np.array_equal(data[start[i] : end[i]], others[begin[i] : stop[i]])
    which = which[size[which] <= STEPPED]
    for k in range(0, STEPPED, 8):
        which = which[size[which] > k]
        if not len(which):
            break
        out[which] &= ((left[start[which] + k] ^ right[begin[which] + k]) & _upto(size[which] - k)) == 0
    return out


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left * _ODD + U64(1)) ^ right)


class Words:
    """Words of a column of texts: bytes, word bounds, words per row, codes."""

    def __init__(self, texts: pa.Array, gaps=WHITE, lower=False, seed=1):
        texts = texts.cast(pa.large_string()).fill_null("")
        buffers, n = texts.buffers(), len(texts)
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1]
        raw = buffers[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        self.data = LOWER[data] if lower else data
        self.offsets = offsets - offsets[0]
        inside = ~gaps[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        begins, ends = inside.copy(), inside
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        follows = np.zeros(len(data), bool)
        follows[:-1] = inside[1:] & ~edge[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends & ~follows) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.code = byte_codes(self.data, self.start, self.end, seed)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def joined(self, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all words, or of a sorted choice, each row's joined by one space, and the rows' bounds."""
        start, end, first = self.start, self.end, self.first
        if chosen is not None:
            start, end, first = start[chosen], end[chosen], np.searchsorted(chosen, first)
        behind = end.copy()  # the byte after a word becomes the space, but for a row's last
        inner = np.ones(len(end), bool)
        inner[first[1:][first[1:] > first[:-1]] - 1] = False
        behind[inner] += 1
        mark = np.zeros(len(self.data) + 1, np.int8)
        mark[start] += 1
        np.subtract.at(mark, behind, 1)
        data = self.data.copy()
        data[end[inner]] = 0x20
        sums = np.concatenate([[0], np.cumsum(behind - start)])
        return data[np.cumsum(mark[:-1], dtype=np.int8) > 0], sums[first]

    def windows(self, size: int, seed=11) -> tuple[np.ndarray, np.ndarray]:
        """Word positions at which ``size`` words of one text start, and the codes of those words."""
        n = len(self.start)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        row = np.repeat(np.arange(len(self.first) - 1), self.counts)
        at = np.flatnonzero(row[: n - size + 1] == row[size - 1 :])
        return at, self.runs(at, at + size, seed)

    def runs(self, start: np.ndarray, end: np.ndarray, seed=11) -> np.ndarray:
        """Codes of the words from start to end, by the words' codes.

        Codes of runs of 1, 2, 4, ... words, each made of two of half the length; a run is
        then two such, which may overlap. Every step mixes, so no sum over words can cancel.
        """
        size = end - start
        out = np.zeros(len(start), np.uint64)
        table, width, most = mix(self.code + _seed(seed)), 1, int(size.max(initial=0))
        while width <= most:
            which = np.flatnonzero((size >= width) & (size < 2 * width))
            out[which] = mix(_pair(table[start[which]], table[end[which] - width]) + size[which].astype(np.uint64))
            table, width = _pair(table[:-width], table[width:]), 2 * width
        return out

    def shingles(self, size: int, seed=11) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all runs of ``size`` words and their bounds by row; a shorter text is one run."""
        at, code = self.windows(size, seed)
        short = np.flatnonzero((self.counts > 0) & (self.counts < size))
        if len(short):
            where = np.concatenate([at, self.first[short]])
            code = np.concatenate([code, self.runs(self.first[short], self.first[short + 1], seed)])
            order = np.argsort(where, kind="stable")
            at, code = where[order], code[order]
        return code, np.searchsorted(at, self.first)
