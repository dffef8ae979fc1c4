"""Bronze ingest: append the message log to a table, undecoded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.change_log import to_bronze


def start_bronze(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain what is there and stop; the next run goes on from the checkpoint."""
    return (
        to_bronze(records)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def run_bronze(records: DataFrame, path: str, checkpoint: str) -> None:
    start_bronze(records, path, checkpoint).awaitTermination()
