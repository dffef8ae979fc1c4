"""Declared schemas, controlled vocabularies and captured-table descriptions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Change operations.
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"
TRUNCATE_OP = "t"
CHANGE_OPS = ("c", "u", "d", "r", "t")

# Payment vocabularies.
PAYMENT_STATUSES = ("authorized", "captured", "failed", "pending", "refunded", "chargeback", "cancelled")
SETTLED_STATUSES = ("authorized", "captured")
REPORTING_CURRENCY = "USD"
FEED_CURRENCIES = ("EUR", "GBP", "CAD", "AUD", "CHF")

MONEY = T.DecimalType(12, 2)
MONEY_USD = T.DecimalType(18, 2)
FX_RATE = T.DecimalType(18, 8)


BIGINT, INT, STRING, BINARY = T.LongType(), T.IntegerType(), T.StringType(), T.BinaryType()
DATE, TIMESTAMP, BOOLEAN = T.DateType(), T.TimestampType(), T.BooleanType()


def columns(**types: T.DataType) -> T.StructType:
    """A schema without a session, which parsing DDL text would need."""
    return T.StructType([T.StructField(name, data_type) for name, data_type in types.items()])


@dataclass(frozen=True)
class CapturedTable:
    """A source table whose changes are captured.

    The type of an image column selects how its wire form is decoded: bigint =
    integer coercion, decimal = base64 unscaled integer, timestamp = epoch
    microseconds, string = as is.
    """

    name: str
    topic: str
    key: tuple[str, ...]
    image: T.StructType

    @property
    def silver_schema(self) -> T.StructType:
        return T.StructType(
            self.image.fields + columns(cdc_lsn=BIGINT, cdc_source_ts=TIMESTAMP, ingested_at=TIMESTAMP).fields
        )

    @property
    def state_schema(self) -> T.StructType:
        """Silver plus what is needed to order changes and to remember deletes."""
        return T.StructType(
            self.silver_schema.fields + columns(is_deleted=BOOLEAN, partition=INT, offset=BIGINT).fields
        )


PAYMENTS = CapturedTable(
    name="payments",
    topic="cdc.public.payments",
    key=("payment_id",),
    image=columns(
        payment_id=BIGINT, merchant_id=BIGINT, shopper_id=BIGINT, amount=MONEY, currency=STRING,
        payment_method=STRING, payment_status=STRING, country_code=STRING, created_at=TIMESTAMP,
        updated_at=TIMESTAMP,
    ),
)

MERCHANTS = CapturedTable(
    name="merchants",
    topic="cdc.public.merchants",
    key=("merchant_id",),
    image=columns(
        merchant_id=BIGINT, merchant_name=STRING, country_code=STRING, category=STRING, created_at=TIMESTAMP
    ),
)

REFUNDS = CapturedTable(
    name="refunds",
    topic="cdc.public.refunds",
    key=("refund_id",),
    image=columns(
        refund_id=BIGINT, payment_id=BIGINT, refund_amount=MONEY, refund_reason=STRING, created_at=TIMESTAMP
    ),
)

CAPTURED_TABLES = {table.name: table for table in (PAYMENTS, MERCHANTS, REFUNDS)}

# The six columns of a message-log record, whatever source delivers it.
LOG_RECORD = columns(
    key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=BIGINT, timestamp=TIMESTAMP
)

BRONZE = columns(
    value=STRING, message_key=STRING, topic=STRING, partition=INT, offset=BIGINT,
    kafka_timestamp=TIMESTAMP, ingested_at=TIMESTAMP
)

RAW_PAYMENTS = columns(
    payment_id=STRING, merchant_id=STRING, shopper_id=STRING, amount=STRING, currency=STRING,
    payment_method=STRING, payment_status=STRING, country_code=STRING, created_at=STRING
)
RAW_MERCHANTS = columns(merchant_id=STRING, merchant_name=STRING, country_code=STRING, category=STRING)
RAW_FX_SEED = columns(rate_date=STRING, base_currency=STRING, currency=STRING, rate=STRING)

# One landed rate per line; the rate travels as text so that no float touches it.
LANDED_FX = columns(rate_date=STRING, base_currency=STRING, currency=STRING, rate=STRING)
RAW_FX_RATES = columns(
    rate_date=DATE, base_currency=STRING, currency=STRING, rate=FX_RATE, loaded_at=TIMESTAMP,
    source_file=STRING
)
