"""Change events: raw messages → typed rows, quarantine, counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import wire
from ..schemas import CHANGE_OPS, DELETE_OP, PAYMENTS, STRING, TRUNCATE_OP, UPSERT_OPS, CapturedTable, columns

COORDINATES = ("topic", "partition", "offset", "kafka_timestamp")


def envelope_schema(table: CapturedTable) -> T.StructType:
    """The parts of an envelope that are read, bare or under ``payload``; all else is skipped unread."""
    image = T.StructType([T.StructField(f.name, wire.wire_type(f)) for f in table.image.fields])
    envelope = columns(
        op=STRING, before=image, after=image, source=columns(table=STRING, lsn=STRING, ts_ms=STRING)
    )
    return T.StructType([*envelope.fields, T.StructField("payload", envelope), T.StructField("unfit", STRING)])


def decoded_changes(
    bronze: DataFrame,
    table: CapturedTable = PAYMENTS,
    value_column: str = "value",
    decimal_mode: str = "auto",
) -> DataFrame:
    """One typed row per message, in one narrow JVM stage.

    ``decode_ok`` is false for anything that is not an applicable change of
    this table; no message makes the job fail. Log coordinates are passed
    through where the input has them, and so is the raw ``value``.
    """
    carried = [name for name in COORDINATES if name in bronze.columns]
    opened = opened_envelopes(bronze, table, value_column)
    # Amounts become columns of their own first: decoding refers to them many times.
    decimals = [f.name for f in table.image.fields if isinstance(f.dataType, T.DecimalType)]
    typed = opened.select("*", *[wire.variant_text(F.col(f"_row.{name}")).alias(f"_text_{name}") for name in decimals]).select(
        *carried,
        "value",
        "is_envelope",
        *[_image_column(column, decimal_mode) for column in table.image.fields],
        "cdc_op",
        F.coalesce("_source.table", F.lit("")).alias("cdc_table"),
        wire.log_position(F.col("_source.lsn")).alias("cdc_lsn"),
        wire.milli_timestamp(F.col("_source.ts_ms")).alias("cdc_source_ts"),
        F.coalesce(F.col("cdc_op").isin(*UPSERT_OPS), F.lit(False)).alias("is_upsert"),
        F.coalesce(F.col("cdc_op") == DELETE_OP, F.lit(False)).alias("is_deleted"),
        "is_tombstone",
    )
    has_key = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in table.key])
    decode_ok = F.col("cdc_op").isNotNull() & has_key
    reason = (
        F.when(F.col("is_tombstone") | decode_ok, None)
        .when(~F.col("is_envelope"), "not_an_envelope")
        .when(F.col("cdc_op").isNull(), "unknown_operation")
        .when(F.col("cdc_op") == TRUNCATE_OP, "truncate")
        .otherwise("missing_key")
    )
    return typed.select(
        *[c for c in typed.columns if c != "is_envelope"],
        decode_ok.alias("decode_ok"),
        reason.alias("reason"),
        F.current_timestamp().alias("ingested_at"),
    )


def opened_envelopes(bronze: DataFrame, table: CapturedTable, value_column: str = "value") -> DataFrame:
    """Messages with their operation, source and row image; these are NULL unless the operation is known."""
    raw = F.col(value_column)
    if isinstance(bronze.schema[value_column].dataType, T.BinaryType):
        raw = F.make_valid_utf8(raw.cast("string"))
    carried = [name for name in COORDINATES if name in bronze.columns]
    parsed = F.from_json(
        F.col("value"),
        envelope_schema(table),
        {"columnNameOfCorruptRecord": "unfit", "allowSingleQuotes": "false"},
    )
    messages = bronze.select(*carried, raw.alias("value")).select("*", parsed.alias("_doc"))

    # Space around a document is looked for only where it does not simply end in a brace.
    closes = F.col("value").endswith("}")
    is_tombstone = F.col("value").isNull() | (~closes & F.col("value").rlike(r"^[ \t\r\n]*null[ \t\r\n]*$"))
    ends_in_brace = closes | F.col("value").rlike(r"\}[ \t\r\n]+$")
    # A payload that is present but no object hides whatever else the document holds.
    hidden = F.col("value").contains('"payload"') & F.array_contains(F.json_object_keys("value"), "payload")
    is_envelope = (
        F.col("_doc.unfit").isNull()
        & ends_in_brace
        & _one_document(F.col("value"))
        & (F.col("_doc.payload").isNotNull() | ~F.coalesce(hidden, F.lit(False)))
    )
    wrapped = F.col("_doc.payload").isNotNull()
    flagged = messages.select(
        "*", is_tombstone.alias("is_tombstone"), F.coalesce(~is_tombstone & is_envelope, F.lit(False)).alias("is_envelope")
    )

    def part(name: str) -> Column:
        return F.when(wrapped, F.col(f"_doc.payload.{name}")).otherwise(F.col(f"_doc.{name}"))

    known_op = F.when(F.col("is_envelope") & part("op").isin(*CHANGE_OPS), part("op"))
    named = flagged.select("*", known_op.alias("cdc_op"))
    row = F.when(F.col("cdc_op") == DELETE_OP, part("before")).otherwise(F.coalesce(part("after"), part("before")))
    opened = named.select(
        *carried, "value", "is_tombstone", "is_envelope", "cdc_op",
        *[F.when(F.col("cdc_op").isNotNull(), p).alias(n) for n, p in (("_row", row), ("_source", part("source")))],
    )
    # A generator output cannot be substituted into what is above it. As plain
    # projections, `where(decode_ok)` would be pushed down and repeat all of this.
    parts = F.struct("is_tombstone", "is_envelope", "cdc_op", "_row", "_source")
    return opened.select(*carried, "value", F.inline(F.array(parts)))


def _one_document(text: Column) -> Column:
    """Whether the text is one JSON value and nothing more.

    The parser stops where the first value ends. As a member of an object, a text
    that ends early takes the member after it along, or breaks the object.
    """
    keys = F.json_object_keys(F.concat(F.lit('{"document":'), text, F.lit(',"~end~":0}')))
    return F.coalesce(F.try_element_at(keys, F.lit(2)) == "~end~", F.lit(False))


def _image_column(column: T.StructField, decimal_mode: str) -> Column:
    name = column.name
    if isinstance(column.dataType, T.DecimalType):
        decoded = wire.money(F.col(f"_row.{name}"), F.col(f"_text_{name}"), column.dataType, decimal_mode)
    elif isinstance(column.dataType, T.LongType):
        decoded = wire.integer(F.col(f"_row.{name}"))
    elif isinstance(column.dataType, T.TimestampType):
        decoded = wire.micro_timestamp(F.col(f"_row.{name}"))
    else:
        decoded = F.col(f"_row.{name}")
    return decoded.alias(name)


def quarantine(decoded: DataFrame) -> DataFrame:
    """Messages that could not be decoded, with the raw payload, place and reason."""
    carried = [c for c in COORDINATES if c in decoded.columns]
    return decoded.where(~F.col("decode_ok") & ~F.col("is_tombstone")).select(
        "value", *carried, "reason", "ingested_at"
    )


def applicable(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("decode_ok") & ~F.col("is_tombstone"))


def counter_columns() -> list[Column]:
    """Aggregates over decoded messages; messages = decoded + quarantined + tombstones."""
    ok, tombstone = F.col("decode_ok"), F.col("is_tombstone")
    return [
        F.count(F.lit(1)).alias("messages"),
        F.count_if(ok).alias("decoded"),
        F.count_if(~ok & ~tombstone).alias("quarantined"),
        F.count_if(tombstone).alias("tombstones"),
    ]


def reconciliation(decoded: DataFrame, *by: str) -> DataFrame:
    """Every message is accounted for exactly once, in one pass."""
    return (
        decoded.groupBy(*by)
        .agg(*counter_columns())
        .withColumn(
            "reconciles",
            F.col("messages") == F.col("decoded") + F.col("quarantined") + F.col("tombstones"),
        )
    )
