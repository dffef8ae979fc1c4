"""Merging a collapsed batch of changes into current state, as one full outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PAYMENTS, CapturedTable
from .collapse import ORDER_COLUMNS


def merge_changes(
    target: DataFrame, batch: DataFrame, table: CapturedTable = PAYMENTS, strict: bool = True
) -> DataFrame:
    """Apply at most one change per key.

    ``strict``: target and batch carry the state schema. The newer side wins
    whatever it is, and a delete stays as a mark, so neither a stale delete nor
    a stale insert can move a row backwards.

    Otherwise ``target`` is plain silver and the literal clauses apply: matched
    and delete → drop; matched and higher log position → replace; not matched
    and no delete → insert. A delete is not guarded and leaves no memory.
    """
    return _merge_state(target, batch, table) if strict else _merge_clauses(target, batch, table)


def _paired(target: DataFrame, batch: DataFrame, table: CapturedTable) -> DataFrame:
    t, s = target.alias("t"), batch.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in table.key]
    return t.join(s, on, "full_outer")


def _merge_state(target: DataFrame, batch: DataFrame, table: CapturedTable) -> DataFrame:
    key = table.key[0]
    newer = F.struct(*[f"s.{c}" for c in ORDER_COLUMNS]) > F.struct(*[f"t.{c}" for c in ORDER_COLUMNS])
    take_batch = F.col(f"t.{key}").isNull() | (F.col(f"s.{key}").isNotNull() & newer)
    names = table.state_schema.names
    return _paired(target, batch, table).select(
        *[F.when(take_batch, F.col(f"s.{n}")).otherwise(F.col(f"t.{n}")).alias(n) for n in names]
    )


def _merge_clauses(target: DataFrame, batch: DataFrame, table: CapturedTable) -> DataFrame:
    key = table.key[0]
    in_target, in_batch = F.col(f"t.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    deleted = F.coalesce(F.col("s.is_deleted"), F.lit(False))
    lsn_s = F.coalesce(F.col("s.cdc_lsn"), F.lit(-1))
    lsn_t = F.coalesce(F.col("t.cdc_lsn"), F.lit(-1))
    take_batch = ~in_target | (in_batch & (lsn_s > lsn_t))
    names = table.silver_schema.names
    return (
        _paired(target, batch, table)
        .where(~(in_batch & deleted))
        .select(*[F.when(take_batch, F.col(f"s.{n}")).otherwise(F.col(f"t.{n}")).alias(n) for n in names])
    )
