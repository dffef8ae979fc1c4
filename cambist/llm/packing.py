"""Documents cut and packed into sequences of a fixed length, by column generation.

A document's ids are cut at every ``capacity`` and, in what is left, at the last
multiple of ``unit``: pieces are whole units or a tail shorter than one. The histogram
of lengths is the demand of two cutting-stock problems, units and tails. Their linear
programs are solved over generated patterns (lengths that fit one sequence): revised
simplex, in which a knapsack by dynamic programming over the duals finds the next
pattern. Rounded down, each pattern has a whole number of full copies; the few pieces
left (bounded by patterns, not by data) are packed first fit. Pieces are ranked within
their length, in buckets so that one common length is spread over tasks, and rank r of
a length is a slot of one copy of one pattern.

Why units: with some 500 distinct lengths the program took minutes, with 64 it takes
half a second, and cutting at a unit rounds nothing up. Pieces of a sequence stand
close, in slot order; only a sequence's end is padded.

Defined cases: a null or empty text is the end id alone; repeated rows and equal doc_ids
are documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .encoding import BYTE_VOCABULARY, END_ID, encoder
from .shared import by_size, map_arrow, record, saved, texts_of

CAPACITY, UNIT = 2048, 32
#: The linear program ends when no pattern's reduced cost is below minus this.
GAP = 1e-4

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("size", pa.int32())]
)
_PLACED = pa.schema([*list(_PIECES)[:5], ("sequence_id", pa.int64()), ("slot", pa.int32())])
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def lengths(capacity: int, unit: int) -> np.ndarray:
    """The pieces' lengths: whole units up to the capacity, then tails."""
    return np.concatenate([np.arange(unit, capacity + 1, unit), np.arange(1, unit)])


def _cutter(vocabulary: str, end_id: int, capacity: int, unit: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            ids, bounds = encoder(vocabulary).documents(part.column("text"), end_id)
            ids, total = ids.astype("<u4"), np.diff(bounds)
            whole = total // unit * unit
            full = -(-whole // capacity)
            count = full + (whole < total)
            row = np.repeat(np.arange(len(total)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            tail = nth == full[row]
            start = np.where(tail, whole[row], nth * capacity)
            length = np.where(tail, total[row] - start, np.minimum(whole[row] - start, capacity))
            size = np.where(tail, capacity // unit + length - 1, length // unit - 1)
            begin = bounds[row] + start
            sums = [zlib.crc32(ids[a : a + n]) for a, n in zip(begin.tolist(), length.tolist())]
            yield record(
                _PIECES, doc_id=part.column("doc_id").take(pa.array(row)), start=start, length=length, ids_crc32=sums,
                doc_tokens=total[row], size=size,
            )

    return cut


def best_pattern(values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: sizes 1..room, ``values[s - 1]`` each; worth and counts by size."""
    worth, choice = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for c in range(1, room + 1):
        got = worth[c - 1 :: -1][:c] + values[:c]
        s = int(np.argmax(got))
        worth[c], choice[c] = got[s], s + 1
        if worth[c - 1] >= got[s]:
            worth[c], choice[c] = worth[c - 1], 0
    counts, c = np.zeros(room, np.int64), room
    while c > 0:
        if choice[c]:
            counts[choice[c] - 1] += 1
            c -= choice[c]
        else:
            c -= 1
    return float(worth[room]), counts


def generate_patterns(demand: np.ndarray, room: int, gap=GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows: counts by size) and how often each is used in the linear program's optimum.

    ``demand[s - 1]``: pieces of size s. Revised simplex from one-size patterns; each
    step brings in the pattern of best worth under the duals, until none is worth more
    than a sequence or the program is within ``gap`` of what the sizes alone need.
    """
    sizes = np.flatnonzero(demand)
    m, need = len(sizes), demand[sizes].astype(float)
    per = room // (sizes + 1)
    basis = np.diag(per).astype(float)
    inverse, level = np.diag(1.0 / per), need / per
    least = float(need @ (sizes + 1)) / room
    for step_number in range(100 * m + 100):
        if level.sum() <= least * (1 + gap):
            break
        duals = inverse.sum(axis=0)
        values = np.full(room, -1.0)
        values[sizes] = duals
        worth, column = best_pattern(values, room)
        if worth <= 1 + 1e-7:
            break
        column = column[sizes].astype(float)
        step = inverse @ column
        ratio = np.full(m, np.inf)
        up = step > 1e-7
        ratio[up] = level[up] / step[up]
        ties = np.flatnonzero(ratio <= ratio.min() + 1e-9)
        out = int(ties[np.argmax(step[ties])])
        level = np.maximum(level - ratio[out] * step, 0)
        level[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        basis[:, out] = column
        if step_number % 50 == 49:  # rounding errors add up
            inverse = np.linalg.inv(basis)
            level = np.maximum(inverse @ need, 0)
    patterns = np.zeros((m, room), np.int64)
    patterns[:, sizes] = np.rint(basis).astype(np.int64).T
    return patterns, level


def _full_copies(demand: np.ndarray, room: int) -> list[tuple[int, np.ndarray]]:
    """The linear program's patterns, rounded down to whole copies."""
    out, left = [], demand.astype(np.int64).copy()
    if not left.any():
        return out
    patterns, level = generate_patterns(left, room)
    for counts, x in zip(patterns, np.floor(level + 1e-6).astype(np.int64)):
        used = np.flatnonzero(counts)
        x = min(int(x), int((left[used] // counts[used]).min())) if len(used) else 0
        if x > 0:
            out.append((x, counts))
            left -= x * counts
    return out


def plan_sequences(demand: np.ndarray, capacity=CAPACITY, unit=UNIT) -> list[tuple[int, np.ndarray]]:
    """(copies, pieces by index of ``lengths``), whose sum is the demand exactly."""
    size, units = lengths(capacity, unit), capacity // unit
    plan = []
    for x, counts in _full_copies(demand[:units], units):
        plan.append((x, np.concatenate([counts, np.zeros(unit - 1, np.int64)])))
    tails = np.zeros(capacity, np.int64)
    tails[: unit - 1] = demand[units:]
    for x, counts in _full_copies(tails, capacity):
        plan.append((x, np.concatenate([np.zeros(units, np.int64), counts[: unit - 1]])))
    left = demand - sum((x * counts for x, counts in plan), np.zeros(len(size), np.int64))
    bins: list[list] = []  # first fit, longest first: [room left, pieces]
    for s in sorted(np.repeat(np.arange(len(size)), left).tolist(), key=lambda s: -size[s]):
        place = next((b for b in bins if b[0] >= size[s]), None)
        if place is None:
            bins.append(place := [capacity, []])
        place[0] -= size[s]
        place[1].append(s)
    return plan + [(1, np.bincount(b[1], minlength=len(size))) for b in bins]


def _slots(plan: list[tuple[int, np.ndarray]]):
    """For each size, from which rank on its pieces go to which pattern: arrays sorted by (size, rank)."""
    size, pattern, per, first, copies, base, number = [], [], [], [], [], [], 0
    for k, (x, counts) in enumerate(plan):
        used = np.flatnonzero(counts)
        size.append(used)
        per.append(counts[used])
        first.append(np.cumsum(counts[used]) - counts[used])
        pattern.append(np.full(len(used), k))
        copies.append(np.full(len(used), x))
        base.append(np.full(len(used), number))
        number += x
    size, pattern, per, first, copies, base = map(np.concatenate, (size, pattern, per, first, copies, base))
    order = np.lexsort((pattern, size))
    size, per, first, copies, base = (x[order] for x in (size, per, first, copies, base))
    taken = per * copies
    ends = np.cumsum(taken)
    begin = ends - taken
    start_of = np.searchsorted(size, size)
    return size, begin - begin[start_of], per, first, base


def _placer(slots, heads: dict[tuple[int, int], int]):
    size, rank_from, per, first, base = slots
    far = 1 << 44
    table = size.astype(np.int64) * far + rank_from

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, bucket = batch.column("size").to_numpy().astype(np.int64), batch.column("bucket").to_pylist()
            rank = batch.column("nth").to_numpy().astype(np.int64) - 1
            rank = rank + np.array([heads[key] for key in zip(own.tolist(), bucket)], np.int64)
            at = np.searchsorted(table, own * far + rank, "right") - 1
            inside = rank - rank_from[at]
            same = {name: batch.column(name) for name in _PIECES.names[:5]}
            yield record(_PLACED, sequence_id=base[at] + inside // per[at], slot=first[at] + inside % per[at], **same)

    return place


def pack(docs: DataFrame, vocabulary=BYTE_VOCABULARY, end_id=END_ID, capacity=CAPACITY, unit=UNIT) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if capacity % unit:
        raise ValueError("capacity must be a multiple of unit")
    spark = docs.sparkSession
    cut = map_arrow(texts_of(docs), _cutter(vocabulary, end_id, capacity, unit), f"{_DDL}, size int")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()  # tells repeated rows apart; fixed by the write
    pieces = saved(cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", place), F.lit(buckets)).cast("int")), "pieces")
    # At most (capacity / unit + unit) x buckets rows, whatever the number of documents.
    found = sorted((r["size"], r["bucket"], r["n"]) for r in pieces.groupBy("size", "bucket").agg(F.count("*").alias("n")).collect())
    if not found:
        return spark.createDataFrame([], f"{_DDL}, sequence_id long, offset long")
    demand, heads = np.zeros(len(lengths(capacity, unit)), np.int64), {}
    for size, part, n in found:
        heads[size, part] = int(demand[size])
        demand[size] += n
    slots = _slots(plan_sequences(demand, capacity, unit))
    ranked = pieces.withColumn("nth", F.row_number().over(W.partitionBy("size", "bucket").orderBy("doc_id", "start", "ids_crc32")))
    placed = map_arrow(ranked, _placer(slots, heads), f"{_DDL}, sequence_id long, slot int")
    before = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("slot")
