"""Token ids as binary files: one id array per shard, document bounds in Elias-Fano code.

Documents are put in ascending doc_id order by a range exchange (nulls first; equal
ids are told apart by their place in the input, so one hot id is spread too), encoded
where they land and written as shards of at most ``shard_ids`` ids, unless one document
has more. Shard names sort as the documents do.

A shard: magic, bytes per id, number of null doc_ids, Elias-Fano of the other doc_ids,
Elias-Fano of the documents' ends, ids little-endian. A task writes a shard under a name
of its own and renames it, so a repeated task leaves the same single file.

Defined cases: a null or empty text is the end id alone; repeated rows are repeated
documents; an empty table gives no files and no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_dir
from .elias_fano import EliasFano
from .encoding import END_ID, WORD_VOCABULARY, encoder
from .shared import by_size, map_arrow, record, texts_of

MAGIC = b"IDEF0002"
SHARD_IDS = 2 << 20
SUFFIX = ".idef"
_HEAD = struct.Struct("<8sBQ")
#: Names that Spark and Arrow give to the same kinds of store.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}

_SHARDS = pa.schema([("shard", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])
_READ = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.string())]
)


def shard_bytes(doc_ids: list, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """``doc_ids`` ascending, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return b"".join(
        [
            _HEAD.pack(MAGIC, width, nulls),
            EliasFano.of(np.array(doc_ids[nulls:], np.int64)).to_bytes(),
            EliasFano.of(ends).to_bytes(),
            ids.astype(f"<u{width}").tobytes(),
        ]
    )


class Shard:
    """A shard's bytes, opened: doc_ids, ``len`` and the ids of any document by its bounds."""

    def __init__(self, data: bytes):
        magic, width, self.nulls = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no shard of token ids")
        self.keys, at = EliasFano.from_bytes(data, _HEAD.size)
        self.ends, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", offset=at)

    def __len__(self):
        return self.ends.n

    def doc_ids(self) -> list:
        return [None] * self.nulls + self.keys.all().tolist()

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def bounds_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the documents at these places, by the select directory."""
        inner = places > 0
        starts = np.zeros(len(places), np.int64)
        starts[inner] = self.ends.select_many(places[inner] - 1)
        return starts, self.ends.select_many(places)

    def document(self, i: int) -> np.ndarray:
        begin, end = self.bounds(i)
        return self.ids[begin:end]


def _store(folder: str):
    from pyarrow import fs

    scheme, mark, rest = folder.partition("://")
    if mark:
        folder = f"{ARROW_SCHEMES.get(scheme, scheme)}://{rest}"
    elif folder.startswith("file:"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, data: bytes) -> None:
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    own = f"{root}/_{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{root}/{name}")


def _writer(folder: str, vocabulary: str, end_id: int, shard_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held_ids, held_docs, held_ends, held = [], [], [], 0

        def flush():
            nonlocal number, held
            name = f"{task:08d}-{number:06d}{SUFFIX}"
            ids = np.concatenate(held_ids)
            _put(folder, name, shard_bytes(held_docs, np.array(held_ends, np.int64), ids))
            row = record(_SHARDS, shard=[name], documents=[len(held_docs)], ids=[len(ids)])
            number, held = number + 1, 0
            for x in (held_ids, held_docs, held_ends):
                x.clear()
            return row

        for part in by_size(batches):
            ids, bounds = encoder(vocabulary).documents(part.column("text"), end_id)
            doc_ids, first = part.column("doc_id").to_pylist(), 0
            while first < len(doc_ids):
                room = int(np.searchsorted(bounds, bounds[first] + shard_ids - held, "right")) - 1
                last = min(max(room, first if held else first + 1), len(doc_ids))
                if last > first:
                    held_ids.append(ids[bounds[first] : bounds[last]].astype(np.uint32))
                    held_docs += doc_ids[first:last]
                    held_ends += (bounds[first + 1 : last + 1] - bounds[first] + held).tolist()
                    held += int(bounds[last] - bounds[first])
                if last < len(doc_ids) or held >= shard_ids:
                    yield flush()
                first = last
        if held_docs:
            yield flush()

    return write


def write_ids(docs: DataFrame, folder: str, vocabulary=WORD_VOCABULARY, end_id=END_ID, shard_ids=SHARD_IDS) -> DataFrame:
    """Write all documents' ids to ``folder``; returns one row per shard: shard, documents, ids."""
    ordered = (
        texts_of(docs)
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"))
        .repartitionByRange("doc_id", "place")
        .sortWithinPartitions("doc_id", "place")
        .select("doc_id", "text")
    )
    shards = map_arrow(ordered, _writer(folder, vocabulary, end_id, shard_ids), "shard string, documents long, ids long")
    shards.write.parquet(f"{folder}/_shards")  # the one action that runs the writers
    return docs.sparkSession.read.schema(shards.schema).parquet(f"{folder}/_shards")


def _reader(folder: str):
    """Rows of the documents of each named shard, one file at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            store, root = _store(folder)
            for name, before in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist()):
                with store.open_input_stream(f"{root}/{name}") as file:
                    yield shard_rows(name, Shard(file.read()), before)

    return read


def shard_rows(name: str, shard: Shard, before: int) -> pa.RecordBatch:
    """``before``: ids in the shards before this one."""
    starts, ends = shard.bounds_of(np.arange(len(shard)))
    sums = [zlib.crc32(shard.ids[a:b].astype("<u4")) for a, b in zip(starts.tolist(), ends.tolist())]
    return record(_READ, shard=[name] * len(shard), doc_id=shard.doc_ids(), start=starts + before, n_tokens=ends - starts, ids_crc32=sums)


def read_documents(folder: str, shards: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``shards``: what ``write_ids`` returned; a shard's start is a running sum over
    shards, first within tasks, then over tasks, so no single window holds them all.
    """
    task = F.substring("shard", 1, 8)
    within = W.partitionBy(task).orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    tasks = shards.groupBy(task.alias("task")).agg(F.sum("ids").alias("n")).select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    starts = shards.select("shard", task.alias("task"), F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("inside")).join(tasks, "task")
    begun = starts.select("shard", (F.col("inside") + F.col("base")).alias("before"))
    # A number of its own: these few rows stand for all ids, and would else be put into one task.
    dealt = begun.repartition(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    return map_arrow(dealt, _reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long, shard string")


def encode_to_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ids and read them back. ``folder``: in a store every executor reaches; else in the shared folder."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-ids")
    shards = write_ids(docs, folder, **options)
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, shard string")
    return read_documents(folder, shards)
