"""Where the tables of each layer live, and reading and replacing them."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: What Spark calls the partition of rows without a value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
LAYERS = ("bronze", "silver", "gold", "raw", "marts")


@dataclass(frozen=True)
class Lakehouse:
    """Layer tables as folders under one root; names as ``catalog.layer.name``."""

    root: str
    catalog: str = "lakehouse"

    def table(self, layer: str, name: str) -> str:
        return f"{self.catalog}.{self._known(layer)}.{name}"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self._known(layer)}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"

    def read(self, spark: SparkSession, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(self.path(layer, name))

    @staticmethod
    def _known(layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
        return layer


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """An empty typed table, unless something is there already."""
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_table(frame: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a whole table.

    With a partition column the rows are rebalanced on it first: few files per
    partition, and a day that holds a third of the rows is split over tasks.
    """
    if partition_by is None:
        frame.write.mode("overwrite").parquet(path)
        return
    (
        frame.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition_by)
        .parquet(path)
    )


def replace_partitions(frame: DataFrame, path: str, partition_by: str) -> None:
    """Replace those partitions of a table that the frame has rows for, and no others."""
    (
        frame.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def day_folder(path: str, column: str, day: dt.date | None) -> str:
    return f"{path.rstrip('/')}/{column}={NO_DAY if day is None else day}"


def days_of(path: str, column: str) -> set[dt.date | None]:
    """The days a table has partitions for, from folder names: one name per calendar day, no files are listed."""
    names = (name.partition("=") for name in child_folders(path))
    found = {value for name, _, value in names if name == column}
    return {None if value == NO_DAY else dt.date.fromisoformat(value) for value in found}


def read_days(spark: SparkSession, path: str, column: str, days, schema: T.StructType) -> DataFrame:
    """The rows of these days. Only their folders are opened; a day without one has no rows."""
    there = [day_folder(path, column, day) for day in sorted(set(days) & days_of(path, column), key=str)]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*there)


def _store(path: str):
    """Arrow's view of a path: a full URI, or a path of this machine, as Spark has it where no other store is the default."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{known}://{rest}" if mark else os.path.abspath(path.removeprefix("file:")))


def child_folders(path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    from pyarrow import fs

    store, root = _store(path)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def exists(path: str) -> bool:
    from pyarrow import fs

    store, root = _store(path)
    return store.get_file_info(root).type != fs.FileType.NotFound


def put_text(path: str, text: str) -> None:
    """A small file, written aside and renamed: readers see the old one or the new one."""
    store, root = _store(path)
    parent, _, name = root.rpartition("/")
    store.create_dir(parent, recursive=True)
    own = f"{parent}/_{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(text.encode())
    store.move(own, root)


def get_text(path: str) -> str | None:
    if not exists(path):
        return None
    store, root = _store(path)
    with store.open_input_stream(root) as file:
        return file.read().decode()


def remove_file(path: str) -> None:
    if exists(path):
        store, root = _store(path)
        store.delete_file(root)


def remove_folder(path: str) -> None:
    """Delete one folder of a table, in any store Arrow knows; nothing there is no error."""
    from pyarrow import fs

    store, root = _store(path)
    if store.get_file_info(root).type == fs.FileType.Directory:
        store.delete_dir(root)
