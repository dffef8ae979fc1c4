"""Silver apply: decode each micro-batch, quarantine what fails, log the winners."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.collapse import state_rows
from ..operators.decode import COORDINATES, counter_columns, decoded_changes, quarantine
from ..operators.offsets import offset_runs
from ..schemas import CapturedTable
from ..sources.silver_store import SilverStore
from .progress import drained

Metrics = dict[str, int]


def packed(decoded: DataFrame, table: CapturedTable) -> DataFrame:
    """What a batch's writes read of its decoded messages, as one column.

    The raw value is that of quarantined messages only, as no other write reads it. A
    cache takes one column of rows as bytes; of two dozen columns, it would compress and
    take the bounds of each value, which costs about as much as the decode itself.
    """
    names = {*COORDINATES, *table.state_schema.names, "is_tombstone", "decode_ok", "reason"}
    raw = F.when(~F.col("decode_ok") & ~F.col("is_tombstone"), F.col("value"))
    return decoded.select(F.struct(raw.alias("value"), *[c for c in decoded.columns if c in names]).alias("_message"))


def apply_batch(
    store: SilverStore, messages: DataFrame, query_id: str, batch_id: int, decimal_mode: str = "auto"
) -> Metrics:
    """Counters and writes over one decode; every write replaces the batch's own folder.

    Counted by an aggregate over the kept rows, not by observed metrics: those
    count a task twice when a lost executor makes it run again. The counters are kept
    beside the changes, and so are the runs of offsets that were read.
    """
    kept = packed(decoded_changes(messages, store.table, decimal_mode=decimal_mode), store.table)
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    decoded = kept.select("_message.*")
    try:
        counts = decoded.agg(*counter_columns()).first().asDict()
        if counts["decoded"]:
            store.append_changes(state_rows(decoded, store.table), query_id, batch_id)
        if counts["quarantined"]:
            store.append_quarantine(quarantine(decoded), query_id, batch_id)
        store.keep_metrics(counts, query_id, batch_id)
        if {"topic", "partition", "offset"} <= set(decoded.columns):
            store.keep_offsets(offset_runs(decoded), query_id, batch_id)
        return {"batch_id": batch_id, **counts}
    finally:
        kept.unpersist()


def start_silver(
    bronze: DataFrame,
    store: SilverStore,
    checkpoint: str,
    on_batch: Callable[[Metrics], None] | None = None,
    decimal_mode: str = "auto",
) -> StreamingQuery:
    def process(messages: DataFrame, batch_id: int) -> None:
        # Batch ids restart with a new checkpoint; the query id does not repeat.
        query_id = messages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        metrics = apply_batch(store, messages, query_id, batch_id, decimal_mode)
        if on_batch:
            on_batch(metrics)

    return (
        bronze.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_silver(bronze: DataFrame, store: SilverStore, checkpoint: str, on_batch=None, decimal_mode="auto") -> None:
    store.create()
    drained(store.spark, lambda: start_silver(bronze, store, checkpoint, on_batch, decimal_mode), store.progress_path())
