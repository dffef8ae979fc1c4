"""What the engine says about each micro-batch, kept as one small file per query and batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..schemas import BIGINT, STRING, columns
from ..sources.layers import exists, put_text

PROGRESS = columns(query_id=STRING, batch_id=BIGINT, started_at=STRING, input_rows=BIGINT, duration_ms=BIGINT)


def _row(progress) -> dict:
    return {
        "query_id": str(progress.id),
        "batch_id": progress.batchId,
        "started_at": progress.timestamp,
        "input_rows": progress.numInputRows,
        "duration_ms": progress.durationMs.get("triggerExecution"),
    }


class KeptProgress(StreamingQueryListener):
    """Writes the progress of one query's batches; a batch that is tried again replaces its file."""

    def __init__(self, folder: str):
        self.folder, self.query_id = folder, None

    def keep(self, progress) -> None:
        row = _row(progress)
        if row["input_rows"]:
            put_text(f"{self.folder}/{row['query_id']}-{row['batch_id']}.json", json.dumps(row))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.query_id is None or str(event.progress.id) == self.query_id:
            self.keep(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def drained(spark: SparkSession, start, folder: str) -> StreamingQuery:
    """Run a query to its end under a listener. Events come late, so what the query remembers of its last batches is kept too."""
    listener = KeptProgress(folder)
    spark.streams.addListener(listener)
    try:
        query = start()
        listener.query_id = str(query.id)
        query.awaitTermination()
        for progress in query.recentProgress:
            listener.keep(progress)
    finally:
        spark.streams.removeListener(listener)
    return query


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    if not exists(folder):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(folder)
