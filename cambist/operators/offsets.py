"""Offsets of a message log as interval sets: runs that each batch leaves and that can be merged.

A run is (topic, partition, block, first, last, records): offsets of one block of
``BLOCK``, all of them read, with how many records were read for them. Runs of any
batches can be put together and merged again, so a log's gaps and repeats are known
without its records. Everything is grouped by block, so a partition that holds the
whole log is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import BIGINT, INT, STRING, columns

BLOCK_BITS = 20
PLACE = ("topic", "partition")
RUNS = columns(topic=STRING, partition=INT, block=BIGINT, first_offset=BIGINT, last_offset=BIGINT, records=BIGINT)


def _block(offset: Column) -> Column:
    return F.shiftright(offset.cast("bigint"), BLOCK_BITS)


def offset_runs(messages: DataFrame) -> DataFrame:
    """The runs of a batch; a message without an offset is in none."""
    placed = messages.where(F.col("offset").isNotNull()).select(F.col("topic").cast("string"), F.col("partition").cast("int"), F.col("offset").cast("bigint"))
    read = placed.groupBy(*PLACE, "offset").agg(F.count("*").alias("records")).withColumn("block", _block(F.col("offset")))
    within = Window.partitionBy(*PLACE, "block").orderBy("offset")
    # Consecutive offsets are as far from their row numbers as each other.
    island = read.withColumn("_island", F.col("offset") - F.row_number().over(within))
    runs = island.groupBy(*PLACE, "block", "_island").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.sum("records").alias("records")
    )
    return runs.select(*RUNS.names)


def merged_runs(runs: DataFrame) -> DataFrame:
    """Runs that overlap or touch as one, by block: gaps stay gaps, records add up."""
    in_order = Window.partitionBy(*PLACE, "block").orderBy("first_offset", "last_offset")
    reached = F.max("last_offset").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.col("first_offset") <= reached + 1, 0).otherwise(1)
    numbered = runs.withColumn("_starts", starts).withColumn("_run", F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*PLACE, "block", "_run").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"), F.sum("records").alias("records")
    )
    return merged.select(*RUNS.names)


def coverage(runs: DataFrame) -> DataFrame:
    """Per topic and partition: first and last offset, offsets between them that no run holds, records beyond one per offset."""
    size = F.col("last_offset") - F.col("first_offset") + 1
    summed = merged_runs(runs).groupBy(*PLACE).agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
        F.sum(size).alias("_held"), F.sum("records").alias("_records"),
    )
    return summed.select(
        *PLACE, "first_offset", "last_offset", (size - F.col("_held")).alias("missing_offsets"),
        (F.col("_records") - F.col("_held")).alias("repeated_records"),
    )


def gap_list(runs: DataFrame) -> DataFrame:
    """Every run of missing offsets, first to last; one that spans blocks is found between the blocks."""
    merged = merged_runs(runs)
    blocks = merged.groupBy(*PLACE, "block").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
    inside = merged.withColumn("_next", F.lead("first_offset").over(Window.partitionBy(*PLACE, "block").orderBy("first_offset")))
    between = blocks.withColumn("_next", F.lead("first_offset").over(Window.partitionBy(*PLACE).orderBy("block")))
    found = inside.select(*PLACE, "last_offset", "_next").unionByName(between.select(*PLACE, "last_offset", "_next"))
    gaps = found.where(F.col("_next") > F.col("last_offset") + 1)
    return gaps.select(*PLACE, (F.col("last_offset") + 1).alias("first_missing"), (F.col("_next") - 1).alias("last_missing"))
