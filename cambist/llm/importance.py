"""Importance resampling towards a target: documents drawn by how much their n-grams are the target's.

Separators are collapsed to single spaces, so that an overlapped regex scan, anchored
between spaces, gives at each word the span of the run of up to three words that starts
there; its shorter runs end where the next spans begin. Each run's CRC32 is carried on
from the shorter one's, over all spans of a batch at once, and names one of ``BUCKETS``
buckets. Bucket counts of all documents (S, s) and of
the target's texts (T, t) give each bucket a gain, a document's weight is the sum of its
features' gains, and a Gumbel term from a hash of its doc_id makes the greatest scores a
draw without replacement.

The scan is run once: each document's buckets are written as sorted 16-bit numbers, which
the counts and the weights read. Ranks come from a range exchange by score, counted by
partition; no task and no driver holds more than a partition. What is sent to the driver
and back is one number per bucket.

Defined cases: null or empty text has no features and weight 0; a null doc_id hashes as
the empty text; equal doc_ids are rows of their own, ties between them stand in the order
of weight and features; an empty target gives gains from S alone; an empty table gives no
rows; other columns are kept by ``resampled`` and else not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import by_size, map_arrow, record, saved

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 5, 42
#: Fixed value: the CRC32 polynomial, bits reversed.
POLYNOMIAL = 0xEDB88320
# A run of up to three words from each word on; words stand between spaces, texts between line ends.
_RUNS = regex.compile(rb"(?<![^ \n])[^ \n]++(?: [^ \n]++(?: [^ \n]++)?+)?+(?![^ \n])")
_COLLAPSED = regex.compile(rb" ++")


def _separators() -> bytes:
    """Letters A-Z in lower case; every ASCII byte that is then no letter or digit is a space."""
    out = bytearray(range(256)).lower()
    for b in range(128):
        if not chr(out[b]).isalnum():
            out[b] = 0x20
    return bytes(out)


_PLAIN = _separators()
_BUCKETED = pa.schema([("n_words", pa.int64()), ("buckets", pa.binary())])


def collapsed(text: bytes) -> bytes:
    """Words in lower case with one space between them."""
    return _COLLAPSED.sub(b" ", text.translate(_PLAIN)).strip(b" ")


def _crc_table() -> np.ndarray:
    """What the low byte of a CRC32's state turns into when a byte is shifted out, for each of its values."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> np.uint32(1)) ^ np.where(state & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return state


_TABLE = _crc_table()
#: Bytes of a span summed in steps over all spans; a longer rest is summed by itself.
STEPPED = 48


def carried_on(sums: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC32 of what the sums stand for with the bytes data[begin:end] after it."""
    state, which = ~sums, np.arange(len(sums))
    for k in range(STEPPED):
        which = which[end[which] - begin[which] > k]
        if not len(which):
            return ~state
        old = state[which]
        state[which] = _TABLE[(old ^ data[begin[which] + k]) & np.uint32(255)] ^ (old >> np.uint32(8))
    out = ~state
    for i in which.tolist():
        out[i] = crc32(data[begin[i] + STEPPED : end[i]].tobytes(), int(out[i]))
    return out


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and of all runs of one to three words the text's number and the CRC32."""
    plain = [collapsed(text) for text in texts]
    joined = b"\n".join(plain)
    spans = np.fromiter(chain.from_iterable(m.span() for m in _RUNS.finditer(joined, overlapped=True)), np.int64)
    begin, stop, data = spans[::2], spans[1::2], np.frombuffer(joined, np.uint8)
    starts = np.cumsum([0, *(len(t) + 1 for t in plain)])
    row = np.searchsorted(starts, begin, "right") - 1
    followed = row[:-1] == row[1:]
    end = stop.copy()  # of the first word: the run's own, or the space before the next word
    end[:-1][followed] = begin[1:][followed] - 1
    one = carried_on(np.zeros(len(begin), np.uint32), data, begin, end)
    two = np.flatnonzero(followed)
    second = carried_on(one[two], data, end[two], end[two + 1])
    three = np.flatnonzero(np.append(followed, False)[two + 1])
    third = carried_on(second[three], data, end[two[three] + 1], stop[two[three]])
    rows = np.concatenate([row, row[two], row[two[three]]])
    return np.bincount(row, minlength=len(texts)), rows, np.concatenate([one, second, third])


def _scanner(buckets: int, names: list[str]):
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches):
            raw = (text.as_buffer() for text in part.column("text"))
            n_words, rows, found = codes([b"" if r is None else r.to_pybytes() for r in raw])
            keyed = np.sort(rows * buckets + found % np.uint32(buckets))
            bounds = np.searchsorted(keyed, np.arange(part.num_rows + 1) * buckets).tolist()
            held = (keyed % buckets).astype(kind)
            kept = [part.column(name) for name in names]
            sets = pa.array([held[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_words, pa.int64()), sets], [*names, *_BUCKETED.names])

    return scan


def _bucketed(texts: DataFrame, buckets: int, label: str) -> DataFrame:
    """The frame with its ``text`` replaced by n_words and buckets, written."""
    fields = [f for f in texts.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())])
    return saved(map_arrow(texts, _scanner(buckets, [f.name for f in fields]), schema), label)


def _counter(buckets: int):
    schema, kind = pa.schema([("bucket", pa.int32()), ("n", pa.int64())]), np.uint16 if buckets <= 1 << 16 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in by_size(batches, "buckets"):
            total += np.bincount(np.frombuffer(b"".join(part.column("buckets").to_pylist()), kind), minlength=buckets)
        yield record(schema, bucket=np.arange(buckets), n=total)

    return count


def bucket_counts(bucketed: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket; one row per bucket reaches the driver."""
    counted = map_arrow(bucketed.select("buckets"), _counter(buckets), "bucket int, n long")
    out = np.zeros(buckets, object)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    buckets, all_source, all_target = len(source), float(sum(source)), float(sum(target))
    ratio = [(t + 1) * (all_source + buckets) / ((s + 1) * (all_target + buckets)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate that depends on the seed and the document's id alone."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gain: np.ndarray, seed: int, names: list[str]):
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, "buckets"):
            weight, size = [], []
            for held in part.column("buckets"):
                found = np.frombuffer(held.as_buffer(), kind)
                size.append(len(found))
                weight.append(int(gain[found].sum()))
            total = [w + gumbel(i, seed) for w, i in zip(weight, part.column("doc_id").to_pylist())]
            kept = [part.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in (size, weight, total))], [*names, "n_features", "weight", "score"])

    return score


def _ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """Rows with their place in the order of falling scores, where it is among the first ``drawn``."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.desc("weight"), F.desc("n_features")]
    placed = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()  # of a partition in the upper bits, of its row in the lower 33
    placed = saved(placed.withColumn("_task", F.shiftright(number, 33)).withColumn("_row", number.bitwiseAND(F.lit((1 << 33) - 1))), "ranked")
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    tasks = placed.groupBy("_task").agg(F.count("*").alias("n")).select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    rank = F.col("_base") + F.col("_row") + 1
    return placed.join(F.broadcast(tasks), "_task").withColumn("rank", F.when(rank <= drawn, rank)).drop("_task", "_row", "_base")


def scores(
    docs: DataFrame, target: DataFrame, percent=PERCENT, min_words=MIN_WORDS, buckets=BUCKETS, seed=SEED, carried: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (null where not drawn), and the carried columns.

    ``target``: rows of ``text``. Of the documents with ``min_words``, ``percent`` of a
    hundred are drawn, the greatest scores first, ties to the smaller doc_id.
    """
    text = F.col("text").cast("string").alias("text")
    source = _bucketed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *carried), buckets, "buckets")
    wanted = _bucketed(target.select(text), buckets, "target-buckets")
    gain = gains(bucket_counts(source, buckets), bucket_counts(wanted, buckets))
    fields = [f for f in source.schema.fields if f.name != "buckets"]
    schema = T.StructType([*fields, *(T.StructField(name, T.LongType()) for name in ("n_features", "weight", "score"))])
    scored = saved(map_arrow(source, _scorer(gain, seed, [f.name for f in fields]), schema), "scores")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return _ranked(able, drawn).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, all columns kept."""
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document"))
    return scores(whole, target, carried=("_document",), **options).where("rank IS NOT NULL").select("_document.*")
