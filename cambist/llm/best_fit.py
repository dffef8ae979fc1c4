"""Documents packed into sequences by bounded-space online best-fit, one stream a task.

A document's ids are one piece, or whole sequences and a rest where it is longer than
one. A task takes its documents as they come and keeps a fixed number of open sequences.
Their free spaces are keys of a bitset: the bits from a piece's length on, and of these
the lowest, give the fullest sequence that still takes the piece. If none does and all
places are taken, the fullest sequence closes and a new one opens.

A task's last open sequences may be loose. The pieces of those with more than ``SLACK``
of their room free, a few thousand a task at most, are written apart and go through the
same packer once more, longest first, in groups whose sequences can all be open at once.
So one loose sequence is left per group, not per task. Nothing else is shuffled or
sorted, and a task holds its open sequences only.

Defined cases: a null or empty text is the end id alone; repeated rows and equal doc_ids
are documents of their own; a null doc_id is carried; an empty table gives no rows; other
columns are not read. Which documents share a sequence depends on how the table is read
into tasks; every rerun of a task gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import END_ID, WORD_VOCABULARY, encoder
from .shared import by_size, map_arrow, record, saved, texts_of

CAPACITY, OPEN = 4096, 1024
#: Share of a sequence that may stay free in one that a task leaves behind.
SLACK = 1 / 64
#: Sequence numbers: a task's are its number times this, those of the second pass lie above ``SECOND``.
STRIDE, SECOND = 1 << 32, 1 << 62

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenSequences:
    """At most ``limit`` open sequences of ``capacity``, found by their free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits = 0  # bit f: some open sequence has f free
        self.by_free: dict[int, list[int]] = {}
        self.held: dict[int, list] = {}
        self.count = 0

    def place(self, length: int, item) -> list[tuple[int, list]]:
        """Put an item into the fullest sequence it fits; returns the sequences this closes, with their items."""
        closed = []
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if len(self.held) == self.limit:
                closed.append(self._close(self._take((self.bits & -self.bits).bit_length() - 1)))
            number, free = self.count, self.capacity
            self.count += 1
            self.held[number] = []
        self.held[number].append(item)
        free -= length
        if free:
            self.by_free.setdefault(free, []).append(number)
            self.bits |= 1 << free
        else:
            closed.append(self._close(number))
        return closed

    def _take(self, free: int) -> int:
        same = self.by_free[free]
        number = same.pop()
        if not same:
            del self.by_free[free]
            self.bits ^= 1 << free
        return number

    def _close(self, number: int) -> tuple[int, list]:
        return number, self.held.pop(number)

    def rest(self) -> list[tuple[int, int, list]]:
        """What is open at the end: number, free space, items."""
        return sorted((n, free, self.held[n]) for free, numbers in self.by_free.items() for n in numbers)


class _Rows:
    """Pieces of closed sequences, waiting to be a record batch."""

    def __init__(self, base: int):
        self.base, self.rows = base, []

    def add(self, number: int | None, items: list) -> None:
        at = 0
        for item in items:
            self.rows.append((*item, None if number is None else self.base + number, at))
            at += item[3]

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(_PIECES)
        self.rows = []
        return record(_PIECES, **{name: list(values) for name, values in zip(_PIECES.names, columns)})


def cut(ids: np.ndarray, bounds: np.ndarray, doc_ids: list, capacity: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, crc) of each piece; only documents longer than a sequence are cut."""
    ids = ids.astype("<u4")
    for doc_id, begin, end in zip(doc_ids, bounds[:-1].tolist(), bounds[1:].tolist()):
        for piece, start in enumerate(range(begin, end, capacity)):
            stop = min(start + capacity, end)
            yield doc_id, piece, start - begin, stop - start, zlib.crc32(ids[start:stop])


def _packer(vocabulary: str, end_id: int, capacity: int, limit: int):
    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences, rows = OpenSequences(capacity, limit), _Rows(TaskContext.get().partitionId() * STRIDE)
        for part in by_size(batches):
            ids, bounds = encoder(vocabulary).documents(part.column("text"), end_id)
            for item in cut(ids, bounds, part.column("doc_id").to_pylist(), capacity):
                if item[3] == capacity:  # a sequence of its own, closed at once
                    rows.add(sequences.count, [item])
                    sequences.count += 1
                    continue
                for number, items in sequences.place(item[3], item):
                    rows.add(number, items)
            yield rows.batch()
        for number, free, items in sequences.rest():
            rows.add(number if free <= SLACK * capacity else None, items)
        yield rows.batch()

    return pack_task


def _repacker(capacity: int, limit: int):
    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences, rows = OpenSequences(capacity, limit), _Rows(SECOND + TaskContext.get().partitionId() * STRIDE)
        for batch in batches:
            for item in zip(*(batch.column(name).to_pylist() for name in _PIECES.names[:5])):
                for number, items in sequences.place(item[3], item):
                    rows.add(number, items)
            yield rows.batch()
        for number, _, items in sequences.rest():
            rows.add(number, items)
        yield rows.batch()

    return pack_task


def pack(docs: DataFrame, vocabulary=WORD_VOCABULARY, end_id=END_ID, capacity=CAPACITY, open_sequences=OPEN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    first = saved(map_arrow(texts_of(docs), _packer(vocabulary, end_id, capacity, open_sequences), _DDL), "best-fit")
    loose = first.where("sequence_id IS NULL")
    tokens = loose.agg(F.sum("length")).first()[0]
    if not tokens:
        return first
    groups = 1 + 2 * tokens // (capacity * open_sequences)
    ordered = loose.coalesce(groups).sortWithinPartitions(F.desc("length"), "doc_id", "start", "ids_crc32")
    again = map_arrow(ordered, _repacker(capacity, open_sequences), _DDL)
    return first.where("sequence_id IS NOT NULL").unionByName(saved(again, "best-fit-loose"))
