"""Small helpers of this subpackage: tables written to the shared folder, Arrow batches cut to a size."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Bytes of text worked on at once in a task. A longer document is worked on alone.
CHUNK_BYTES = 1 << 20


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers of the session's application, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    # On the driver's own disk: Spark serves it to the executors from there.
    target = os.path.join(tempfile.mkdtemp(prefix="library-"), "library.zip")
    with open(target, "wb") as out:
        out.write(packed.getvalue())
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def map_arrow(frame: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this library."""
    ship(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text of documents, whatever else they have; a null text stays null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def rows_of(docs: DataFrame) -> DataFrame:
    """Whole documents as ``document``, beside their id and two hashes of their text, so that no name can clash."""
    text = F.col("text").cast("string")
    return docs.select(
        F.struct("*").alias("document"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        F.xxhash64(F.lit(1), text).alias("text_key"),
    )


def by_size(batches, column="text", limit=CHUNK_BYTES):
    """Record batches cut into slices of at most ``limit`` bytes of a column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in schema], schema=schema)


def _array(values, kind):
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive runs of one flat array as a list column; ``bounds`` has one entry more than rows."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column without nulls, and the bounds of its rows."""
    bounds = np.asarray(column.offsets, dtype=np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    return values[bounds[0] : bounds[-1]], bounds - bounds[0]


def matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    """A binary column of equally long values as rows of numbers."""
    if not len(column):
        return np.zeros((0, width), kind)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), width)


def as_binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    bounds = np.arange(len(rows) + 1, dtype=np.int64) * size
    return pa.Array.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(rows.tobytes())]
    ).cast(pa.binary())
