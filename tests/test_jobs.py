"""All runs in a row, from the message log and rate documents to the marts."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from messages import message
from test_merge import log_records

from cambist import jobs
from cambist.plans import staging
from cambist.schemas import MERCHANTS, PAYMENTS
from cambist.sources.change_log import FileLogSource, offset_gaps
from cambist.sources.layers import Lakehouse


def test_from_log_to_marts(spark, tmp_path):
    lake, log, docs = Lakehouse(str(tmp_path / "lake")), str(tmp_path / "log"), tmp_path / "docs"
    docs.mkdir()
    (docs / "2026-01-01.json").write_text(json.dumps({"base": "USD", "date": "2026-01-01", "rates": {"EUR": 0.92, "XXX": None}}))
    log_records(spark, [message("c", 100), message("c", 101, payment_id=2, status="captured"), "bad", None]).write.parquet(log)

    def run():
        jobs.ingest(spark, lake, FileLogSource(log))
        jobs.apply_changes(spark, lake)
        jobs.publish(spark, lake)
        jobs.rebuild_marts(spark, lake)
        payments = staging.stg_payments(jobs.published(spark, lake))
        jobs.build_warehouse(spark, lake, payments, refresh=(tmp_path / "lake" / "marts").exists())
        return {n: lake.read(spark, "marts", n).collect() for n in ("fct_payments_usd", "fct_daily_revenue_usd")}

    jobs.land_rates(spark, lake, str(docs))
    jobs.load_rates(spark, lake)
    first = run()
    assert {r.payment_id: r.amount_usd for r in first["fct_payments_usd"]} == {1001: Decimal("163.03"), 2: Decimal("163.03")}
    assert first["fct_daily_revenue_usd"][0].gross_amount_usd == Decimal("326.06")
    assert lake.read(spark, "gold", "daily_merchant_revenue").first().gross_amount == Decimal("299.98")
    assert jobs.silver_store(spark, lake).quarantined().count() == 1

    log_records(spark, [message("u", 200, status="refunded")], 4).write.mode("append").parquet(log)
    (docs / "2026-01-01.json").write_text(json.dumps({"base": "USD", "date": "2026-01-01", "rates": {"EUR": "0.50"}}))
    jobs.land_rates(spark, lake, str(docs))
    jobs.load_rates(spark, lake)
    second = run()
    assert {r.payment_id: r.amount_usd for r in second["fct_payments_usd"]} == {1001: Decimal("299.98"), 2: Decimal("299.98")}
    assert second["fct_daily_revenue_usd"][0].settled_count == 1
    assert lake.read(spark, "gold", "daily_merchant_revenue").first().gross_amount == Decimal("149.99")


    compacted = [r.payment_status for r in jobs.published(spark, lake).orderBy("payment_id").collect()]
    jobs.silver_store(spark, lake).compact()
    jobs.publish(spark, lake)
    assert [r.payment_status for r in jobs.published(spark, lake).orderBy("payment_id").collect()] == compacted
    jobs.rebuild(spark, lake)
    assert [r.payment_status for r in jobs.published(spark, lake).orderBy("payment_id").collect()] == compacted
    found = {r.metric: (r.value, r.healthy) for r in jobs.check(spark, lake).collect()}
    assert found["fct_payments_usd.unique_payment_id"] == (0, True)
    assert found[f"missing_offsets.{PAYMENTS.topic}.0"] == (0, True)


def test_checks_of_every_model(spark, tmp_path):
    lake, log, docs, seed = Lakehouse(str(tmp_path / "lake")), str(tmp_path / "log"), tmp_path / "docs", str(tmp_path / "m.csv")
    docs.mkdir()
    for day in ("2026-01-01", "2026-01-06"):
        (docs / f"{day}.json").write_text(json.dumps({"base": "USD", "date": day, "rates": {"EUR": 0.92}}))
    (tmp_path / "m.csv").write_text("merchant_id,merchant_name,country_code,category\n1,Shop,nl,books\n1,Shop,nl,books\n,None,nl,books\n")
    log_records(spark, [message("c", 100), "bad"]).write.parquet(log)
    jobs.land_rates(spark, lake, str(docs))
    jobs.load_rates(spark, lake)
    jobs.ingest(spark, lake, FileLogSource(log))
    jobs.apply_changes(spark, lake)
    jobs.publish(spark, lake)
    jobs.build_warehouse(spark, lake, staging.stg_payments(jobs.published(spark, lake)))
    missing = {r.metric: (r.value, r.healthy) for r in jobs.check(spark, lake).collect()}
    assert missing["dim_merchants.not_checked"] == missing["stg_merchants.not_checked"] == (1, False)
    jobs.build_dimensions(spark, lake, seed)
    merchants = lake.read(spark, "marts", "dim_merchants").collect()
    jobs.write_checks(spark, lake, seed)
    found = {r.metric: (r.value, r.healthy) for r in lake.read(spark, "marts", "checks").collect()}
    assert found["stg_merchants.unique_merchant_id"] == (1, False) and found["stg_merchants.not_null_merchant_id"] == (1, False)
    keys = [r.merchant_id for r in merchants]
    assert found["dim_merchants.not_null_merchant_id"][0] == keys.count(None)
    assert found["dim_merchants.unique_merchant_id"][0] == (keys.count(1) > 1)
    assert found["fx_rates_daily.carried_forward_implies_a_rate_exists"] == (0, True)
    assert found["quarantined"] == (1, False) and found["batches_not_reconciled"] == (0, True)
    assert found["longest_rate_gap_days"][0] >= 4 and not found["longest_rate_gap_days"][1]
    assert not any(m.endswith("not_checked") for m in found)


def test_land_rates_of_a_range(spark, tmp_path):
    lake, docs = Lakehouse(str(tmp_path / "lake")), tmp_path / "docs"
    docs.mkdir()
    for day in range(1, 6):
        (docs / f"{day}.json").write_text(json.dumps({"base": "USD", "date": f"2026-01-0{day}", "rates": {"EUR": "0.9", "GBP": 4e-9}}))
    jobs.land_rates(spark, lake, str(docs), dt.date(2026, 1, 2), dt.date(2026, 1, 3), ["gbp"])
    landed = spark.read.json(lake.path("raw", "fx_landing")).collect()
    assert sorted((r.rate_date, r.currency) for r in landed) == [("2026-01-02", "GBP"), ("2026-01-03", "GBP")]
    assert {float(r.rate) for r in landed} == {4e-9}


def test_dimensions(spark, tmp_path):
    (tmp_path / "m.csv").write_text("merchant_id,merchant_name,country_code,category\n1, Shop ,nl,books\n")
    lake = Lakehouse(str(tmp_path / "lake"))
    jobs.build_dimensions(spark, lake, str(tmp_path / "m.csv"))
    assert lake.read(spark, "marts", "dim_merchants").first().merchant_name == "Shop"


def test_offset_gaps(spark):
    rows = [("t", 0, o) for o in (3, 4, 4, 7)] + [("t", 1, 0)]
    gaps = offset_gaps(spark.createDataFrame(rows, "topic string, partition int, offset long")).orderBy("partition").collect()
    assert [(r.missing_offsets, r.repeated_records) for r in gaps] == [(2, 1), (0, 0)]


def test_names():
    assert jobs.bronze_name(PAYMENTS) == "payments_cdc_raw" and MERCHANTS.topic == "cdc.public.merchants"
