"""What a message becomes: money, times, images, quarantine."""

from __future__ import annotations

import base64
import json
from decimal import Decimal

import pytest
from messages import bronze, envelope, image, message, wire_amount
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cambist.catalogue import adapters
from cambist.catalogue.queries import QUERIES, WIDE_DIGITS, halves
from cambist.functions import wire
from cambist.operators.decode import decoded_changes, quarantine, reconciliation
from cambist.schemas import CAPTURED_TABLES, MERCHANTS, MONEY, REFUNDS
from cambist.sources import change_log


def decode(spark, *messages, **options):
    return decoded_changes(bronze(spark, messages), **options).orderBy("offset").collect()


def amounts(spark, *texts, mode="auto"):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, json string")
    parsed = frame.select("i", F.try_parse_json("json").alias("v")).select("*", wire.variant_text(F.col("v")).alias("t"))
    decoded = parsed.select("i", wire.money(F.col("v"), F.col("t"), MONEY, mode).alias("amount"))
    return [r.amount for r in decoded.orderBy("i").collect()]


def quoted(text):
    return json.dumps(text)


def test_amount_forms(spark):
    assert amounts(
        spark,
        quoted(wire_amount(14999)), quoted(wire_amount(10)), quoted(wire_amount(-2550)), quoted(wire_amount(123456789)),
        quoted("149.99"), "14999", "149.99", "1.4999E2", "null", None, '""', quoted("EHU"), quoted("no money"), "{}", "true",
    ) == [
        Decimal("149.99"), Decimal("0.10"), Decimal("-25.50"), Decimal("1234567.89"),
        Decimal("149.99"), Decimal("149.99"), Decimal("149.99"), Decimal("149.99"), None, None, None, None, None, None, None,
    ]


def test_amount_edges(spark):
    wide = base64.b64encode((-2550).to_bytes(20, "big", signed=True)).decode()
    huge = base64.b64encode((10**30).to_bytes(16, "big", signed=True)).decode()
    assert amounts(spark, *map(quoted, (
        wire_amount(-128), wire_amount(-32768), wire_amount(999999999999), wire_amount(-999999999999),
        wire_amount(10**14), wide, huge, "AA==", "gA==",
    ))) == [
        Decimal("-1.28"), Decimal("-327.68"), Decimal("9999999999.99"), Decimal("-9999999999.99"),
        None, Decimal("-25.50"), None, Decimal("0.00"), Decimal("-1.28"),
    ]


def test_digits_that_look_like_base64_need_a_declared_mode(spark):
    assert amounts(spark, quoted("1499")) == [Decimal("-26502.43")]
    assert amounts(spark, quoted("1499"), mode="string") == [Decimal("1499.00")]
    assert amounts(spark, quoted("149.99"), mode="precise") == [None]
    with pytest.raises(ValueError):
        wire.money(F.col("x"), F.col("x"), MONEY, "exact")


def test_amounts_round_trip(spark):
    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.integers(-(10**12) + 1, 10**12 - 1), min_size=200, max_size=200))
    def check(cents):
        texts = [quoted(wire_amount(c)) for c in cents]
        assert amounts(spark, *texts) == [Decimal(c).scaleb(-2) for c in cents]

    check()


def test_micro_timestamp(spark):
    row = decode(spark, message(created_at=1790395387456703, updated_at="not-a-number"))[0]
    assert row.updated_at is None
    text = decoded_changes(bronze(spark, [message(created_at=1790395387456703)])).select(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    assert text.first()[0] == "2026-09-26 04:03:07.456703"


def test_times_outside_the_calendar_are_null(spark):
    row = decode(spark, message(created_at=10**18, updated_at=-(10**18), ts_ms=10**16))[0]
    assert (row.created_at, row.updated_at, row.cdc_source_ts) == (None, None, None)
    assert row.decode_ok


def test_operations(spark):
    rows = decode(spark, *[message(op) for op in "curd"])
    assert [r.is_upsert for r in rows] == [True, True, True, False]
    assert [r.is_deleted for r in rows] == [False, False, False, True]
    assert all(r.decode_ok and r.payment_id == 1001 and r.cdc_table == "payments" for r in rows)


def test_update_without_after_image_uses_before(spark):
    body = envelope("u")
    body["before"], body["after"] = body["after"], None
    assert decode(spark, json.dumps(body))[0].payment_id == 1001


def test_payload_wrapper(spark):
    wrapped = {"schema": {"type": "struct"}, "payload": envelope("c")}
    hidden = {"payload": None, **envelope("c")}
    odd = {"payload": 5, **envelope("c")}
    rows = decode(spark, json.dumps(wrapped), json.dumps(hidden), json.dumps(odd))
    assert [r.decode_ok for r in rows] == [True, False, False]
    assert rows[0].amount == Decimal("149.99") and rows[0].cdc_lsn == 100


def test_log_position(spark):
    rows = decode(spark, *[message(lsn=v) for v in (987654, "77", -5, "x", 7.5, None, True)])
    assert [r.cdc_lsn for r in rows] == [987654, 77, None, None, None, None, None]


def test_tombstones(spark):
    rows = decode(spark, None, "null", " null\n")
    assert [(r.is_tombstone, r.decode_ok, r.reason) for r in rows] == [(True, False, None)] * 3


def test_nothing_undecodable_raises(spark):
    cases = {
        "not json at all": "not_an_envelope",
        "": "not_an_envelope",
        "[]": "not_an_envelope",
        '"not a mapping"': "not_an_envelope",
        '{"op":"c","after":{"payment_id":1': "not_an_envelope",
        '{"op":"c"} trailing': "not_an_envelope",
        "{'op':'c'}": "not_an_envelope",
        json.dumps({**envelope("c"), "source": "text"}): "not_an_envelope",
        json.dumps({**envelope("c"), "after": "text"}): "not_an_envelope",
        "{}": "unknown_operation",
        '{"op":"x"}': "unknown_operation",
        '{"op":["c"]}': "unknown_operation",
        '{"payload":null}': "not_an_envelope",
        json.dumps({**envelope("t"), "after": None}): "truncate",
        json.dumps(envelope("c", row={"merchant_id": 1})): "missing_key",
        json.dumps(envelope("c", row=image(payment_id="abc"))): "missing_key",
    }
    decoded = decoded_changes(bronze(spark, list(cases)))
    assert {r.value: r.reason for r in quarantine(decoded).collect()} == cases


def test_quarantine_keeps_payload_and_place(spark):
    decoded = decoded_changes(bronze(spark, [message(), "not json at all", None]))
    rows = quarantine(decoded).collect()
    assert [(r.value, r.topic, r.partition, r.offset) for r in rows] == [("not json at all", "cdc.public.payments", 0, 1)]


def test_reconciliation(spark):
    decoded = decoded_changes(bronze(spark, [message(), "not json at all", None, message("d")]))
    row = reconciliation(decoded).first()
    assert (row.messages, row.decoded, row.quarantined, row.tombstones, row.reconciles) == (4, 2, 1, 1, True)


def test_duplicate_members_keep_the_last(spark):
    body = message().replace('"op": "c"', '"op": "x", "op": "c"')
    assert decode(spark, body)[0].decode_ok


def test_binary_values(spark):
    raw = [(bytearray(message().encode()),), (bytearray(b"\xff\xfe"),), (None,)]
    decoded = decoded_changes(spark.createDataFrame(raw, "value binary")).collect()
    assert sorted((r.decode_ok, r.is_tombstone) for r in decoded) == [(False, False), (False, True), (True, False)]


def test_new_columns_are_ignored_and_removed_ones_are_null(spark):
    row = image(loyalty="gold")
    del row["currency"]
    got = decode(spark, json.dumps(envelope("c", row=row)))[0]
    assert got.currency is None and got.decode_ok and "loyalty" not in got.asDict()


def test_other_captured_tables(spark):
    merchant = {"merchant_id": 1, "merchant_name": "A", "country_code": "NL", "category": "home", "created_at": 0}
    refund = {"refund_id": 9, "payment_id": 1, "refund_amount": wire_amount(-250), "refund_reason": "x", "created_at": 0}
    got = decode(spark, json.dumps(envelope("c", row=merchant)), table=MERCHANTS)[0]
    assert (got.merchant_id, got.merchant_name, got.decode_ok) == (1, "A", True)
    got = decode(spark, json.dumps(envelope("c", row=refund)), table=REFUNDS)[0]
    assert (got.refund_id, got.refund_amount, got.decode_ok) == (9, Decimal("-2.50"), True)
    assert {n: t.key for n, t in CAPTURED_TABLES.items()} == {
        "payments": ("payment_id",), "merchants": ("merchant_id",), "refunds": ("refund_id",)
    }


def test_captured_messages(spark):
    """The shapes and values a real connector sent."""
    at = 1790395387456703
    snapshot = envelope("r", lsn=27977000, row=image(amount="EHU=", created_at=at), ts_ms=1790395453590)
    update = envelope("u", lsn=28008072, row=image(amount="EHU=", status="refunded", created_at=at))
    update["before"] = snapshot["after"]
    delete = envelope("d", lsn=28016896, row=image(1002, amount="FyY=", status="failed"))
    for body in (snapshot, update, delete):
        body["source"] |= {"version": "2.7.3.Final", "snapshot": "first", "sequence": '[null,"27977000"]', "xmin": None}
        body |= {"transaction": None, "ts_ms": 1790395453695, "ts_ns": 1790395453695147013}
    first, second, third = decode(spark, *map(json.dumps, (snapshot, update, delete)))
    assert first.amount == Decimal("42.13") and first.is_upsert and first.cdc_op == "r"
    assert second.payment_status == "refunded" and second.cdc_lsn > first.cdc_lsn
    assert third.is_deleted and (third.payment_id, third.amount, third.payment_status) == (1002, Decimal("59.26"), "failed")


def test_sums_do_not_drift(spark):
    decoded = decoded_changes(bronze(spark, [message(payment_id=i, cents=10) for i in range(300)]))
    assert decoded.agg(F.sum("amount")).first()[0] == Decimal("30.00")


def test_decode_is_narrow_and_without_python(spark):
    plan = decoded_changes(bronze(spark, [message()])).where("decode_ok")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("tail", ["{0}", " garbage }}", "}}", "]}}", ",{0}", "]}},{{}}", "\n{0}", ' "}}'])
def test_more_than_one_document_is_quarantined(spark, tail):
    good = message()
    rows = decoded_changes(bronze(spark, [good + tail.format(good), good + " \n", " " + good])).orderBy("offset").collect()
    assert [(r.decode_ok, r.reason) for r in rows] == [(False, "not_an_envelope"), (True, None), (True, None)]


def test_whole_keys_with_a_fraction_of_zeros(spark):
    texts = [message().replace('"payment_id": 1001', f'"payment_id": {key}') for key in ("1001.0", "1001.00", "1001.5", '"1001.0"')]
    rows = decoded_changes(bronze(spark, texts)).orderBy("offset").collect()
    assert [r.payment_id for r in rows] == [1001, 1001, None, 1001]


@pytest.mark.parametrize("precision, scale", [(38, 0), (38, 10), (38, 38), (24, 4)])
def test_wide_amounts(spark, precision, scale):
    """Unscaled integers of any width up to 38 digits, minimal and padded, as base64, whole numbers and digits."""
    values = [s * v for n in (1, 17, 18, 19, 20, 30, 37, 38) for v in (10**n - 1, 10 ** (n - 1)) for s in (1, -1)]
    values += [0, 2**63, -(2**63), -(2**63) - 1, 2**64, -(2**64), 2**127 - 1, -(2**127), 10**38, 2**140]
    rows = [(str(v), quoted(wire_amount(v, size))) for v in values for size in (None, 20)]
    rows += [(str(v), str(v)) for v in values if abs(v) < 10**38]
    frame = spark.createDataFrame(rows, "whole string, json string")
    parsed = frame.select("whole", F.try_parse_json("json").alias("v")).select("*", wire.variant_text(F.col("v")).alias("t"))
    kind = T.DecimalType(precision, scale)
    for row in parsed.select("whole", wire.money(F.col("v"), F.col("t"), kind).alias("amount")).collect():
        want = Decimal(f"{row.whole}E-{scale}") if abs(int(row.whole)) < 10**precision else None
        assert row.amount == want, row


def test_wide_amounts_as_digits(spark):
    texts = ['"12345678901234567890.5"', '"-0.0001"', "12345678901234567890123.25", '"no"', "null"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, json string")
    parsed = frame.select("i", F.try_parse_json("json").alias("v")).select("*", wire.variant_text(F.col("v")).alias("t"))
    got = parsed.select("i", wire.money(F.col("v"), F.col("t"), T.DecimalType(38, 4)).alias("a")).orderBy("i").collect()
    assert [r.a for r in got] == [Decimal("12345678901234567890.5"), Decimal("-0.0001"), Decimal("12345678901234567890123.25"), None, None]


def test_wide_amounts_are_compiled(spark):
    """Lambdas are interpreted, and repeat what they refer to."""
    frame = spark.createDataFrame([('"AQ=="',)], "json string").select(F.try_parse_json("json").alias("v"))
    texts = frame.select("*", wire.variant_text(F.col("v")).alias("t"))
    plan = texts.select(wire.money(F.col("v"), F.col("t"), T.DecimalType(38, 4)))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def one_row_group(spark, folder, n):
    """A table of events in one file of one row group, which one task reads whatever the split size."""
    rows = spark.range(0, n, 1, 1).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 3 == 0, "view").otherwise("click").alias("event_type"),
        (F.col("id") / 4).alias("value"), F.lit('{"k": 30}').alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("made", [adapters.event_facts, adapters.messages])
def test_events_of_one_row_group_are_spread_over_tasks(spark, tmp_path, made):
    folder = one_row_group(spark, tmp_path, 4_000)
    counts = [r["count"] for r in made(spark, folder).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 4_000 and len(counts) >= 4 and max(counts) < 2_000


def test_wide_decimals_of_spread_events(spark, tmp_path):
    folder = one_row_group(spark, tmp_path, 500)
    rows = QUERIES["decode_wide_decimals"](spark, folder)
    assert rows.groupBy(F.spark_partition_id()).count().count() >= 4
    found = {(r.event_id, r.form): r.amount for r in rows.collect()}
    want = {
        (i, f"{form}_{n}"): Decimal(f"{10 ** (n - 1) + i * 25}E-4")
        for i in range(500) for n in WIDE_DIGITS for form in ("base64", "whole", "digits")
    }
    assert found == want


def test_gold_refreshed_of_one_row_group(spark, tmp_path):
    """Each batch that is applied is spread over tasks, and the refreshed gold is that of all messages at once."""
    folder = one_row_group(spark, tmp_path, 4_000)
    for half in halves(change_log.to_bronze(adapters.messages(spark, folder))):
        counts = [r["count"] for r in decoded_changes(half).groupBy(F.spark_partition_id()).count().collect()]
        assert len(counts) >= 4 and max(counts) < sum(counts) / 2
    got, want = (sorted(map(str, QUERIES[name](spark, folder).collect())) for name in ("gold_refreshed", "gold_from_change_events"))
    assert got and got == want
