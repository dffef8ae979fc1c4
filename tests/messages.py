"""Change messages for tests, built from one sample payment."""

from __future__ import annotations

import base64
import json

NEW_YEAR_MICROS = 1767225600000000

# What the sample payment holds.
SAMPLE = {
    "payment_id": 1001,
    "merchant_id": 1,
    "shopper_id": 501,
    "currency": "EUR",
    "payment_method": "card",
    "payment_status": "authorized",
    "country_code": "NL",
    "created_at": NEW_YEAR_MICROS,
    "updated_at": NEW_YEAR_MICROS,
}


def wire_amount(cents: int, size: int | None = None) -> str:
    """Base64 of a big-endian two's complement, in the fewest bytes that hold the sign unless ``size`` is given."""
    if size is None:
        size = cents.bit_length() // 8 + 1 if cents >= 0 else (cents + 1).bit_length() // 8 + 1
    return base64.b64encode(cents.to_bytes(size, "big", signed=True)).decode()


def image(payment_id=1001, cents=14999, status="authorized", **changes) -> dict:
    """A row image with the captured table's columns."""
    return SAMPLE | {"payment_id": payment_id, "amount": wire_amount(cents), "payment_status": status} | changes


def envelope(op="c", lsn=100, row=None, ts_ms=NEW_YEAR_MICROS // 1000, **row_changes) -> dict:
    if row is None:
        row = image(**row_changes)
    source = {"table": "payments", "lsn": lsn, "ts_ms": ts_ms}
    if op == "d":
        return {"before": row, "after": None, "source": source, "op": op}
    return {"before": None, "after": row, "source": source, "op": op}


def message(op="c", lsn=100, **changes) -> str:
    return json.dumps(envelope(op, lsn, **changes))


def bronze(spark, messages):
    """Messages as a bronze frame; the position in the list is the offset."""
    rows = [(m, "cdc.public.payments", 0, i) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "value string, topic string, partition int, offset long")
