"""Current state without a table format: collapsed changes, read through a fold.

Each micro-batch leaves its collapsed changes in a folder named after the query
and the batch, so a retried batch rewrites its own folder. Readers take the
newest change per key over all of them. Being a maximum over a total order, the
result does not depend on how events were split, ordered or repeated.

So folding needs no order: ``compact`` writes the newest change per key of all complete
batches as one more folder, which takes the place of theirs. ``replay`` does the same
with the rows of some keys decoded anew.

The state is published as a table by creation day, which is what marts read, pruned to
the days they need. ``publish`` writes all of it. ``publish_changes`` takes the batches
that are not in it yet, finds where their keys stand by reading key and position alone,
and rewrites only the days that lose or gain a row. Delete marks are published too, on
the day of the row they end, so that a late change cannot bring it back; ``live`` leaves
them out.

What is published is noted in a file beside the changes, once it is. A publication that
was cut short leaves a mark, and the next one writes the whole state from the changes.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.collapse import ORDER_COLUMNS, live_rows, newest_per_key, state_rows
from ..operators.decode import decoded_changes
from ..operators.offsets import RUNS
from ..schemas import BIGINT, DATE, INT, PAYMENTS, STRING, TIMESTAMP, CapturedTable, columns
from ..session import scratch_dir
from .layers import (
    child_folders, day_folder, exists, get_text, put_text, read_days, remove_file, remove_folder,
    replace_partitions, replace_table,
)

FOLDED, DAY = "folded", "created_date"
Batches = set[tuple[str, int]]
_BATCH_COLUMNS = columns(query_id=STRING, batch_id=BIGINT)
_METRICS = columns(messages=BIGINT, decoded=BIGINT, quarantined=BIGINT, tombstones=BIGINT)
_QUARANTINE = columns(
    value=STRING, topic=STRING, partition=INT, offset=BIGINT, kafka_timestamp=TIMESTAMP,
    reason=STRING, ingested_at=TIMESTAMP
)


@dataclass(frozen=True)
class SilverStore:
    spark: SparkSession
    root: str
    table: CapturedTable = PAYMENTS

    # -- layout ---------------------------------------------------------
    def changes_path(self) -> str:
        return f"{self.root}/changes"

    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    @staticmethod
    def batch_folder(parent: str, query_id: str, batch_id: int) -> str:
        return f"{parent}/query_id={query_id}/batch_id={batch_id}"

    def create(self) -> SilverStore:
        """Empty tables, unless they exist."""
        for path, schema in (
            (self.changes_path(), self.table.state_schema),
            (self.quarantine_path(), _QUARANTINE),
        ):
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").parquet(self.batch_folder(path, "created", 0))
        return self

    # -- writing --------------------------------------------------------
    def append_changes(self, collapsed: DataFrame, query_id: str, batch_id: int) -> None:
        target = self.batch_folder(self.changes_path(), query_id, batch_id)
        collapsed.select(*self.table.state_schema.names).write.mode("overwrite").parquet(target)

    def append_quarantine(self, bad: DataFrame, query_id: str, batch_id: int) -> None:
        rows = bad.select(
            *[
                (F.col(f.name) if f.name in bad.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in _QUARANTINE.fields
            ]
        )
        rows.write.mode("overwrite").parquet(self.batch_folder(self.quarantine_path(), query_id, batch_id))

    def keep_metrics(self, counts: dict[str, int], query_id: str, batch_id: int) -> None:
        """A batch's counters, in a folder of its own: a retry replaces them."""
        row = self.spark.createDataFrame([tuple(counts[name] for name in _METRICS.names)], _METRICS)
        row.coalesce(1).write.mode("overwrite").parquet(self.batch_folder(f"{self.root}/metrics", query_id, batch_id))

    def keep_offsets(self, runs: DataFrame, query_id: str, batch_id: int) -> None:
        runs.write.mode("overwrite").parquet(self.batch_folder(f"{self.root}/offsets", query_id, batch_id))

    def progress_path(self) -> str:
        return f"{self.root}/progress"

    # -- reading --------------------------------------------------------
    def changes(self) -> DataFrame:
        return self.changes_of(self.batches())

    def quarantined(self) -> DataFrame:
        """Quarantine with a re-read message once; messages without a place are all kept."""
        schema = T.StructType(_QUARANTINE.fields + _BATCH_COLUMNS.fields)
        rows = self.spark.read.schema(schema).parquet(self.quarantine_path())
        place = ["topic", "partition", "offset"]
        placed = rows.where(F.col("offset").isNotNull()).dropDuplicates(place)
        return placed.unionByName(rows.where(F.col("offset").isNull()))

    def _kept(self, name: str, schema: T.StructType) -> DataFrame:
        schema = T.StructType(schema.fields + _BATCH_COLUMNS.fields)
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(path) else self.spark.createDataFrame([], schema)

    def metrics(self) -> DataFrame:
        """One row per query and batch: what became of its messages, and whether that is all of them."""
        kept = self._kept("metrics", _METRICS)
        whole = F.col("messages") == F.col("decoded") + F.col("quarantined") + F.col("tombstones")
        return kept.withColumn("reconciles", whole)

    def offsets(self) -> DataFrame:
        """The runs of offsets of all batches, not merged."""
        return self._kept("offsets", RUNS)

    def state(self) -> DataFrame:
        """The newest change per key, delete marks included."""
        return newest_per_key(self.changes(), self.table.key)

    def current(self) -> DataFrame:
        return live_rows(self.state(), self.table)

    # -- upkeep ---------------------------------------------------------
    def batches(self) -> Batches:
        """(query, batch) of every folder of changes, from names alone: as many as since the last compaction.

        Folders that another has taken the place of are left out, though they may not be removed yet.
        """
        return self._folders() - self._superseded()

    def _superseded(self) -> Batches:
        return {(query, batch) for query, batch in json.loads(get_text(self._superseded_path()) or "[]")}

    def _superseded_path(self) -> str:
        return f"{self.root}/_superseded.json"

    def _supersede(self, state: DataFrame, old: Batches) -> tuple[str, int]:
        """Write changes as a fold that takes the place of other folders. Readers see all of it from one rename on."""
        number = 1 + max((b for q, b in self._folders() if q == FOLDED), default=0)
        state.write.mode("overwrite").parquet(self.batch_folder(self.changes_path(), FOLDED, number))
        old = old | self._superseded()
        put_text(self._superseded_path(), json.dumps(sorted(old)))
        for query, batch in sorted(old):
            remove_folder(self.batch_folder(self.changes_path(), query, batch))
        remove_file(self._superseded_path())
        return FOLDED, number

    def _folders(self) -> Batches:
        found, parent = set(), self.changes_path()
        for query in child_folders(parent):
            name, _, query_id = query.partition("=")
            if name == "query_id":
                batches = (batch.partition("=") for batch in child_folders(f"{parent}/{query}"))
                found |= {(query_id, int(number)) for key, _, number in batches if key == "batch_id"}
        return found

    def changes_of(self, batches: Batches) -> DataFrame:
        """The changes of some batches; no other folder is opened."""
        if not batches:
            return self.spark.createDataFrame([], self.table.state_schema)
        folders = [self.batch_folder(self.changes_path(), query, batch) for query, batch in sorted(batches)]
        return self.spark.read.schema(self.table.state_schema).parquet(*folders)

    def compact(self) -> int:
        """Fold the complete batches into one folder and remove theirs; returns how many they were.

        The newest batch of each query stays, as it may still be being written; the
        one before it is complete. One compaction at a time, and not while another
        job reads the folders it removes.
        """
        found = self.batches()
        newest = {query: max(b for q, b in found if q == query) for query in {q for q, _ in found} - {FOLDED}}
        complete = {(q, b) for q, b in found if q == FOLDED or b < newest[q]}
        if len(complete) < 2:
            return 0
        noted = complete <= (known := self.noted())
        folded = self._supersede(newest_per_key(self.changes_of(complete), self.table.key), complete)
        if noted:
            self._note(known | {folded})
        return len(complete)

    def replay(self, bronze: DataFrame, where: Column, path: str, decimal_mode: str = "auto", keyed: bool = False) -> set:
        """Messages that ``where`` selects, by place or time, decoded again, as after a change of the decoder.

        What that can change are the keys they now have and the keys of the rows that came
        from them. The whole history of these keys is decoded and folded anew, and takes
        the place of their rows in the changes and in the published table, whatever its
        position; no other key is shuffled, no other day is written. Returns the days
        written. Not while batches are being applied.

        ``keyed``: the message key names the row, so that only messages with the keys of
        the selected ones are decoded; else all of bronze is, without a shuffle of its rows.
        """
        self.publish_changes(path)
        keys, scratch = list(self.table.key), scratch_dir(self.spark, "replay")
        selected = bronze.where(where)
        now = decoded_changes(selected, self.table, decimal_mode=decimal_mode).where("decode_ok").select(*keys)
        place = ["partition", "offset"]
        before = self.published(path).join(selected.select(*place).distinct(), place, "left_semi").select(*keys)
        affected = self._written(now.unionByName(before).distinct(), f"{scratch}/keys")
        history = bronze
        if keyed:
            named = selected.select("message_key").unionByName(self._message_keys(bronze, affected)).distinct()
            history = bronze.join(named, "message_key", "left_semi")
        decoded = decoded_changes(history, self.table, decimal_mode=decimal_mode).join(affected, keys, "left_semi")
        rows = self._written(self.by_day(state_rows(decoded, self.table)), f"{scratch}/rows")
        found = self.batches()
        put_text(self._mark_path(), "")  # from here to the note, a publication starts from the changes
        days = self._replace_keys(path, affected, rows)
        others = newest_per_key(self.changes_of(found), self.table.key).join(affected, keys, "left_anti")
        self._supersede(others.unionByName(rows.drop(DAY)), found)
        self._note(self.batches())
        remove_file(self._mark_path())
        return days

    def _message_keys(self, bronze: DataFrame, affected: DataFrame) -> DataFrame:
        """Message keys under which the affected rows were last seen, by the places their state came from."""
        seen = self.changes_of(self.batches()).join(affected, list(self.table.key), "left_semi").select("partition", "offset").distinct()
        return bronze.join(seen, ["partition", "offset"], "left_semi").select("message_key")

    def _replace_keys(self, path: str, affected: DataFrame, rows: DataFrame) -> set:
        """The published rows of some keys replaced; the days rewritten."""
        keys = list(self.table.key)
        held = self.published(path).select(*keys, DAY).join(affected, keys, "left_semi")
        # One row per calendar day at most.
        touched = {row[0] for row in held.select(DAY).unionByName(rows.select(DAY)).distinct().collect()}
        kept = read_days(self.spark, path, DAY, touched, self.published_schema).join(affected, keys, "left_anti")
        merged = self._written(kept.unionByName(rows.select(*self.published_schema.names)), scratch_dir(self.spark, "replaced"))
        self._swap_days(path, merged, touched)
        return touched

    def _swap_days(self, path: str, merged: DataFrame, touched: set) -> None:
        replace_partitions(merged, path, DAY)
        for day in touched - {row[0] for row in merged.select(DAY).distinct().collect()}:
            remove_folder(day_folder(path, DAY, day))

    # -- publication ----------------------------------------------------
    @property
    def published_schema(self) -> T.StructType:
        return T.StructType(self.table.state_schema.fields + columns(**{DAY: DATE}).fields)

    def published(self, path: str) -> DataFrame:
        """The published state, delete marks included."""
        return self.spark.read.schema(self.published_schema).parquet(path)

    def live(self, path: str) -> DataFrame:
        """The published rows that are not deleted, with their day."""
        return self.published(path).where(~F.col("is_deleted")).select(*self.table.silver_schema.names, DAY)

    def by_day(self, state: DataFrame) -> DataFrame:
        return state.select(*self.table.state_schema.names).withColumn(DAY, F.to_date("created_at"))

    def noted(self) -> Batches:
        """The batches that the published table holds."""
        return {(query, batch) for query, batch in json.loads(get_text(self._note_path()) or "[]")}

    def _note_path(self) -> str:
        return f"{self.root}/_published.json"

    def _mark_path(self) -> str:
        return f"{self.root}/_publishing"

    def _note(self, batches: Batches) -> None:
        put_text(self._note_path(), json.dumps(sorted(batches & self.batches())))

    def publish(self, path: str) -> None:
        """The whole state, from all changes."""
        found = self.batches()
        put_text(self._mark_path(), "")
        replace_table(self.by_day(newest_per_key(self.changes_of(found), self.table.key)), path, DAY)
        self._note(found)
        remove_file(self._mark_path())

    def publish_changes(self, path: str) -> set | None:
        """Bring the published table up to date with the batches it does not hold yet.

        Returns the days whose rows have changed, or None if all were written, as on the
        first call and after one that was cut short.
        """
        known = self.noted()
        if exists(self._mark_path()) or not known or not exists(path):
            self.publish(path)
            return None
        found = self.batches()
        new = found - known
        if not new:
            return set()
        days = self.merge_published(path, newest_per_key(self.changes_of(new), self.table.key))
        self._note(found)
        remove_file(self._mark_path())
        return days

    def merge_published(self, path: str, changes: DataFrame) -> set:
        """Merge one change per key into the published table; the days rewritten.

        The table's keys and positions are read to find what each change replaces and
        whether it is newer. Rows are read of the days that then lose or gain one.
        """
        keys, scratch = list(self.table.key), scratch_dir(self.spark, "publish")
        incoming = self._written(self.by_day(changes), f"{scratch}/incoming")
        held = self.published(path).select(*keys, DAY, F.struct(*ORDER_COLUMNS).alias("_held"))
        held = held.withColumnRenamed(DAY, "_day").join(incoming.select(*keys), keys, "left_semi")
        paired = incoming.join(held, keys, "left")
        newer = F.col("_held").isNull() | (F.struct(*ORDER_COLUMNS) > F.col("_held"))
        winners = self._written(paired.where(newer).withColumn("_replaces", F.col("_held").isNotNull()).drop("_held"), f"{scratch}/winners")
        # One row per calendar day at most, whatever the number of changes.
        gained = {row[0] for row in winners.select(DAY).distinct().collect()}
        lost = {row[0] for row in winners.where("_replaces").select("_day").distinct().collect()}
        touched = gained | lost
        if not touched:
            return touched
        kept = read_days(self.spark, path, DAY, touched, self.published_schema).join(winners.select(*keys), keys, "left_anti")
        merged = self._written(kept.unionByName(winners.select(*self.published_schema.names)), f"{scratch}/merged")
        put_text(self._mark_path(), "")  # from here to the note, the table may hold half of this
        self._swap_days(path, merged, touched)
        return touched

    def _written(self, frame: DataFrame, path: str) -> DataFrame:
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
