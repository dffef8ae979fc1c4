"""Vectors as short codes: a codebook for each part of a vector, distances by dictionaries of values.

Components become integers, and a block of vectors keeps, for each dimension, the distinct
integers it holds and each vector's place among them. To assign a block under a codebook,
the squared differences of every distinct integer to all entries are tabulated once; a
part's distances to all entries are then rows gathered from these tables, added up. What
does not depend on the codebooks (dictionaries and places) is written once and read in
every round.

A round sums each entry's parts by task and again over tasks, as limbs of 40 bits, so no
sum can overflow. The driver holds the codebooks (entries times dimensions integers) and
nothing that grows with the rows.

Defined cases: a row whose vector is null, empty or holds null or non-finite components
takes no part, nor does one whose length is not that of the kept vector with the smallest
vec_id among lengths that the parts divide; with fewer rows than entries the codebooks have
as many entries as rows; equal vec_ids are rows of their own, told apart by their
components; a null vec_id comes after all others; components beyond 2**24 are computed with
exact integers of any size, and an error beyond 64 bits is null; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import flat, map_arrow, record, saved

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors that share dictionaries, and vectors whose distances are held at once.
BLOCK, AT_ONCE = 4096, 512
#: Beyond this, squares and their sums leave 64-bit integers; so does nothing below it up to 2**14 dimensions.
SMALL = 1 << 24
_LIMB = 40

_BLOCKS = pa.schema(
    [("vec_ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("values", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("places", pa.binary())]
)
_BLOCKS_DDL = "vec_ids array<long>, labels array<string>, values array<string>, sizes array<int>, places binary"
_SUMS = pa.schema([("entry", pa.int32()), ("position", pa.int32()), ("limb", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])
_CODES = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly: as 64-bit integers where all are small, else as Python's."""
    values = values.astype(np.float64)
    if (np.abs(values) < SMALL / scale).all():
        return np.floor(values * scale).astype(np.int64)
    # From 2**53 on a double is whole itself; its product might not be finite.
    return np.array([int(x) * scale if abs(x) >= 2.0**53 else floor(x * scale) for x in values.tolist()], object)


class Block:
    """Vectors as places in dictionaries of values, one for each dimension."""

    def __init__(self, dictionaries: list[np.ndarray], places: np.ndarray):
        self.dictionaries, self.places = dictionaries, places

    @classmethod
    def of(cls, rows: np.ndarray) -> Block:
        found = [np.unique(column, return_inverse=True) for column in rows.T]
        return cls([values for values, _ in found], np.stack([which for _, which in found], axis=1).astype(np.uint16))

    def assigned(self, part: int, entries: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry (the lowest of equals) of each vector's part, and its squared distance."""
        width = len(entries[0])
        columns = range(part * width, (part + 1) * width)
        tables = [_differences(self.dictionaries[c], [e[i] for e in entries]) for i, c in enumerate(columns)]
        nearest, least = [], []
        for at in range(0, len(self.places), AT_ONCE):
            places = self.places[at : at + AT_ONCE]
            distance = tables[0][places[:, columns[0]]]
            for table, column in zip(tables[1:], columns[1:]):
                distance = distance + table[places[:, column]]
            best = distance.argmin(axis=1)
            nearest.append(best)
            least.append(distance[np.arange(len(best)), best])
        return np.concatenate(nearest), np.concatenate(least)

    def part_sums(self, part: int, width: int, nearest: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the parts assigned to each entry, by position, and how many they are."""
        counts = np.bincount(nearest, minlength=entries)
        sums = np.zeros((entries, width), object if any(d.dtype == object for d in self.dictionaries) else np.int64)
        for i in range(width):
            column = part * width + i
            np.add.at(sums[:, i], nearest, self.dictionaries[column][self.places[:, column]])
        return sums, counts


def _differences(values: np.ndarray, entry: list[int]) -> np.ndarray:
    """Squared differences of each value (rows) to each entry's component."""
    wide = values.dtype == object or max(map(abs, entry)) >= SMALL
    kind = object if wide else np.int64
    return (values.astype(kind)[:, None] - np.array(entry, kind)) ** 2


def _blocks(width: int, scale: int):
    """Vectors of the width, in blocks; a task's batches are gathered to full ones."""

    def build(vec_ids: list, labels: list, rows: list[np.ndarray]) -> pa.RecordBatch:
        block = Block.of(np.concatenate(rows))
        values = [str(v) for d in block.dictionaries for v in d.tolist()]
        return record(
            _BLOCKS, vec_ids=[vec_ids], labels=[labels], values=[values], sizes=[[len(d) for d in block.dictionaries]], places=[block.places.tobytes()]
        )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vec_ids, labels, rows = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                values, _ = flat(part.column("embedding"))
                rows.append(integers(values, scale).reshape(-1, width))
                vec_ids += part.column("vec_id").to_pylist()
                labels += part.column("label").to_pylist()
                if len(vec_ids) >= BLOCK:
                    yield build(vec_ids, labels, rows)
                    vec_ids, labels, rows = [], [], []
        if vec_ids:
            yield build(vec_ids, labels, rows)

    return write


def _opened(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[Block, list, list]]:
    for batch in batches:
        for row in range(batch.num_rows):
            values, sizes = batch.column("values")[row].as_py(), batch.column("sizes")[row].as_py()
            numbers, ends = [int(v) for v in values], np.cumsum(sizes).tolist()
            small = max(map(abs, numbers)) < SMALL
            dictionaries = [np.array(numbers[b - n : b], np.int64 if small else object) for b, n in zip(ends, sizes)]
            places = np.frombuffer(batch.column("places")[row].as_buffer(), np.uint16).reshape(-1, width)
            yield Block(dictionaries, places), batch.column("vec_ids")[row].as_py(), batch.column("labels")[row].as_py()


def _summer(books: list[list[list[int]]], width: int):
    """A task's sums of the parts of each entry, as limbs."""
    part_width, entries = width // len(books), len(books[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(books), entries, part_width), object)
        counts = np.zeros((len(books), entries), np.int64)
        for block, _, _ in _opened(batches, width):
            for part, book in enumerate(books):
                more, n = block.part_sums(part, part_width, block.assigned(part, book)[0], entries)
                sums[part] += more
                counts[part] += n
        used = np.argwhere(counts > 0)
        out = {name: [] for name in _SUMS.names}
        for part, entry in used.tolist():
            for position, total in enumerate(sums[part, entry].tolist()):
                for limb, value in enumerate(limbs(int(total))):
                    for name, x in zip(_SUMS.names, (entry, part * part_width + position, limb, value, int(counts[part, entry]))):
                        out[name].append(x)
        yield record(_SUMS, **out)

    return add


def limbs(total: int) -> list[int]:
    """A whole number as a sum of limbs[i] << (40 * i), the last one signed."""
    out = []
    while not -(1 << _LIMB) < total < 1 << _LIMB:
        out.append(total & ((1 << _LIMB) - 1))
        total >>= _LIMB
    return [*out, total]


def next_books(blocks: DataFrame, books: list[list[list[int]]], width: int) -> list[list[list[int]]]:
    """Each entry replaced by the rounded-down mean of the parts assigned to it; unused ones stay."""
    part_width = width // len(books)
    sums = map_arrow(blocks.select("vec_ids", "labels", "values", "sizes", "places"), _summer(books, width), "entry int, position int, limb int, total long, n long")
    whole = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found: dict = {}
    # One row per entry, dimension and limb.
    for row in sums.groupBy("entry", "position", "limb").agg(whole, F.sum("n").alias("n")).collect():
        total, n = found.get((row["entry"], row["position"]), (0, 0))
        found[row["entry"], row["position"]] = (total + (int(row["total"]) << (_LIMB * row["limb"])), row["n"] if row["limb"] == 0 else n)

    def mean(entry: int, position: int, old: int) -> int:
        total, n = found.get((entry, position), (old, 1))
        return total // n

    return [
        [[mean(e, part * part_width + i, old) for i, old in enumerate(entry)] for e, entry in enumerate(book)] for part, book in enumerate(books)
    ]


def _coder(books: list[list[list[int]]], width: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, vec_ids, labels in _opened(batches, width):
            found = [block.assigned(part, book) for part, book in enumerate(books)]
            digits = [[f"{x:02x}" for x in nearest.tolist()] for nearest, _ in found]
            errors = [sum(int(x) for x in row) for row in zip(*(distance.tolist() for _, distance in found))]
            yield record(
                _CODES, vec_id=vec_ids, label=labels, code=["".join(row) for row in zip(*digits)], error=[x if x < 1 << 63 else None for x in errors]
            )

    return code


def _usable(vectors: DataFrame) -> DataFrame:
    held = F.col("embedding")
    finite = F.forall(held, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), held.alias("embedding")).where(
        held.isNotNull() & (F.size(held) > 0) & finite
    )


def trained(vectors: DataFrame, scale=SCALE, parts=PARTS, entries=ENTRIES, rounds=ROUNDS) -> tuple[DataFrame, list[list[list[int]]], int] | None:
    """Blocks of the vectors that take part, the codebooks, and the vectors' length; None without vectors."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    usable = _usable(vectors).where(F.size("embedding") % parts == 0)
    first = usable.orderBy(*order).limit(1).collect()
    if not first:
        return None
    width = len(first[0]["embedding"])
    kept = usable.where(F.size("embedding") == width)
    starts = [r["embedding"] for r in kept.select("vec_id", "embedding").orderBy(*order).limit(entries).collect()]
    rows = integers(np.array(starts, np.float64).ravel(), scale).reshape(-1, width).tolist()
    size = width // parts
    books = [[row[p * size : (p + 1) * size] for row in rows] for p in range(parts)]
    blocks = saved(map_arrow(kept, _blocks(width, scale), _BLOCKS_DDL), "vector-blocks")
    for _ in range(rounds):
        books = next_books(blocks, books, width)
    return blocks, books, width


def books_digest(books: list[list[list[int]]]) -> str:
    return sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def compressed(vectors: DataFrame, **options) -> DataFrame:
    """One row per vector that takes part: vec_id, label, code, error, label_error, codebooks_sha256."""
    found = trained(vectors, **options)
    ddl = "vec_id long, label string, code string, error long"
    if found is None:
        return vectors.sparkSession.createDataFrame([], f"{ddl}, label_error long, codebooks_sha256 string")
    blocks, books, width = found
    coded = saved(map_arrow(blocks, _coder(books, width), ddl), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    return out.withColumn("codebooks_sha256", F.lit(books_digest(books)))
