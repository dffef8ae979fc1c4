"""The latest change per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CapturedTable
from .decode import applicable

# Log position first; time and arrival only decide where it is missing or equal.
# A missing part comes before any value.
ORDER_COLUMNS = ("cdc_lsn", "cdc_source_ts", "partition", "offset")


def newest_per_key(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key.

    ``row_number() = 1`` is planned as a group limit on both sides of the
    shuffle, so each task sends at most one row per key: a key that holds a
    third of all changes costs its task count, not its row count. Ordering by
    bare columns adds no projection, so an input that is already hashed by key
    is not shuffled again.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in ORDER_COLUMNS if c in changes.columns]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return changes.withColumn("_position", position).where("_position = 1").drop("_position")


def latest_change_per_key(decoded: DataFrame, table: CapturedTable) -> DataFrame:
    """Collapse decoded messages to the winner per key, deletes included."""
    return newest_per_key(applicable(decoded).dropna(subset=list(table.key)), table.key)


def state_rows(decoded: DataFrame, table: CapturedTable) -> DataFrame:
    """Collapsed changes in the state schema (silver columns, delete mark, arrival)."""
    collapsed = latest_change_per_key(decoded, table)
    return collapsed.select(
        *[
            (F.col(f.name) if f.name in collapsed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.state_schema.fields
        ]
    )


def live_rows(state: DataFrame, table: CapturedTable) -> DataFrame:
    """What a reader of silver sees: no delete marks, the declared columns."""
    return state.where(~F.col("is_deleted")).select(*table.silver_schema.names)


def current_rows(decoded: DataFrame, table: CapturedTable) -> DataFrame:
    """Silver computed in one batch from a whole log: the replay after a decoder change."""
    return live_rows(state_rows(decoded, table), table)
