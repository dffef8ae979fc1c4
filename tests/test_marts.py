"""Staging, facts, gold, reports, quality checks, layer tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cambist.functions import money
from cambist.functions.money import money_string, or_zero
from cambist.plans import facts, gold, quality, reports, staging
from cambist.schemas import PAYMENTS, RAW_FX_SEED, RAW_MERCHANTS, RAW_PAYMENTS
from cambist.sources.fx_files import read_seed
from cambist.sources.layers import Lakehouse, create_table, day_folder, remove_folder, replace_partitions, replace_table

# Own extracts: a weekend without rates, a currency that never has one, a payment before the first rate.
PAYMENT_SEED = """\
payment_id,merchant_id,shopper_id,amount,currency,payment_method,payment_status,country_code,created_at
71,20,9001,46.00,chf , PAYPAL,authorized,ch,2024-03-08 07:15:00
72,20,9002,12.60,GBP,card, Captured ,gb,2024-03-09 22:40:10
73,31,9001,300.00,USD,bank_transfer,pending,US,2024-03-11 00:00:00
74,31,9003,88.00,CHF,card,captured,CH,2024-03-11 16:05:00
75,31,9003,5.20,Chf,card,cancelled,CH,2024-03-11 16:06:30
76,42,9004,700.00,SEK,card,captured,SE,2024-03-11 18:20:00
77,20,9005,31.00,GBP,card,authorized,GB,2024-02-20 13:00:00
78,42,9006,64.00,AUD,apple_pay,refunded,AU,2024-03-12 03:30:00
80,42,9006,3.00,AUD,card,failed,AU,2024-03-12 03:31:00
"""
RATE_SEED = """\
rate_date,base_currency,currency,rate
2024-03-08,usd,CHF,0.80
2024-03-08,USD,gbp,0.75
2024-03-08, Usd,AUD,1.6
2024-03-11,USD,CHF,0.88
2024-03-11,USD,GBP,0.70
2024-03-11,USD,NOK,-2
2024-03-11,USD,ISK,
2024-03-11,USD,DKK,0
"""
MERCHANT_SEED = """\
merchant_id,merchant_name,country_code,category
20, Kestrel Cycles,gb,Outdoor
31,Quire & Spine Books ,CH, BOOKS
"""


def seed(spark, folder, name, text, schema):
    path = folder / name
    path.write_text(text)
    return read_seed(spark, str(path), schema)


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("seeds")
    return (
        staging.stg_payments(seed(spark, folder, "payments.csv", PAYMENT_SEED, RAW_PAYMENTS)),
        staging.stg_fx_rates(seed(spark, folder, "rates.csv", RATE_SEED, RAW_FX_SEED)),
        staging.stg_merchants(seed(spark, folder, "merchants.csv", MERCHANT_SEED, RAW_MERCHANTS)),
    )


def day(text):
    return dt.date.fromisoformat(text)


def test_staging(staged):
    payments, rates, merchants = staged
    row = payments.where("payment_id = 71").first()
    assert (row.currency, row.payment_method, row.amount, row.payment_date) == ("CHF", "paypal", Decimal("46.00"), day("2024-03-08"))
    assert payments.where("payment_id = 72").first().payment_status == "captured"
    assert rates.count() == 5 and {r.base_currency for r in rates.collect()} == {"USD"}
    row = staging.dim_merchants(merchants).where("merchant_id = 20").first()
    assert (row.merchant_name, row.country_code, row.category) == ("Kestrel Cycles", "GB", "outdoor")


def test_fact(staged):
    payments, rates, _ = staged
    rows = {r.payment_id: r for r in facts.fct_payments_usd(payments, rates).collect()}
    got = {i: (r.fx_rate, r.amount_usd, r.fx_rate_carried_forward, r.is_revenue, r.is_unconverted) for i, r in rows.items()}
    assert got == {
        71: (Decimal("0.80"), Decimal("57.50"), False, True, False),
        72: (Decimal("0.75"), Decimal("16.80"), True, True, False),
        73: (Decimal(1), Decimal("300.00"), False, False, False),
        74: (Decimal("0.88"), Decimal("100.00"), False, True, False),
        75: (Decimal("0.88"), Decimal("5.91"), False, False, False),
        76: (None, None, False, True, True),
        77: (None, None, False, True, True),
        78: (Decimal("1.6"), Decimal("40.00"), True, False, False),
        80: (Decimal("1.6"), Decimal("1.88"), True, False, False),
    }


def test_daily_revenue_and_unconverted(staged):
    payments, rates, _ = staged
    fact = facts.fct_payments_usd(payments, rates)
    daily = {(str(r.revenue_date), r.merchant_id): r for r in facts.fct_daily_revenue_usd(fact).collect()}
    row = daily["2024-03-11", 31]
    assert (row.payment_count, row.settled_count, row.gross_amount_usd, row.distinct_shoppers) == (3, 1, Decimal("100.00"), 2)
    row = daily["2024-03-11", 42]
    assert (row.settled_count, row.unconverted_count, row.gross_amount_usd) == (1, 1, Decimal(0))
    assert daily["2024-03-09", 20].carried_forward_count == 1 and daily["2024-03-12", 42].carried_forward_count == 2
    got = {r.currency: (r.payment_count, str(r.first_date)) for r in facts.unconverted_by_currency(fact).collect()}
    assert got == {"SEK": (1, "2024-03-11"), "GBP": (1, "2024-02-20")}
    months = {r.merchant_id: (str(r.period_start), r.distinct_shoppers) for r in facts.shoppers_by_period(facts.daily_shoppers(fact.where("payment_id <> 77")), "month").collect()}
    assert months == {20: ("2024-03-01", 2), 31: ("2024-03-01", 2), 42: ("2024-03-01", 2)}


def test_refresh_rewrites_the_window_and_the_days_payments_left(spark, staged, tmp_path):
    payments, rates, _ = staged
    path = str(tmp_path / "fact")
    facts.build_fact(path, payments, rates)

    def read():
        return {r.payment_id: (r.amount_usd, str(r.payment_date)) for r in spark.read.parquet(path).collect()}

    before = read()
    moved = F.col("payment_id") == 77  # the only payment of its day
    late = payments.withColumn("payment_date", F.when(moved, F.lit(day("2024-03-11"))).otherwise(F.col("payment_date")))
    late = late.unionByName(late.where("payment_id = 73").withColumn("payment_id", F.lit(79).cast("bigint")))
    restated = rates.withColumn("rate", F.when(F.col("currency") == "GBP", F.lit("0.50").cast("decimal(18,8)")).otherwise(F.col("rate")))
    for _ in range(2):
        facts.refresh_fact(spark, path, late, restated)
        after = read()
        assert spark.read.parquet(path).count() == 10
        assert after[72][0] == Decimal("25.20") and after[77] == (Decimal("62.00"), "2024-03-11")
        assert after[79][0] == Decimal("300.00") and after[74] == before[74]
    assert not (tmp_path / "fact" / "payment_period=2024-02-20").exists()
    expected = {r.payment_id: r.amount_usd for r in facts.incremental_fact(
        facts.fct_payments_usd(payments, rates), late, restated).collect()}
    assert {i: a for i, (a, _) in after.items()} == expected


def test_refresh_takes_the_undated_and_the_moved_once(spark, staged, tmp_path):
    payments, rates, _ = staged
    path, date = str(tmp_path / "fact"), F.col("payment_date")

    def dated(changes, gone=()):
        value = date
        for payment_id, to in changes.items():
            value = F.when(F.col("payment_id") == payment_id, F.lit(to).cast("date")).otherwise(value)
        return payments.where(~F.col("payment_id").isin(*gone)).withColumn("payment_date", value)

    newest = payments.agg(F.max("payment_date")).first()[0]
    some = [r.payment_id for r in payments.where(date == newest).select("payment_id").collect()]
    facts.build_fact(path, dated({71: None, 72: None}), rates)
    steps = [
        dated({71: newest, 72: None}),  # one repaired into the window
        dated({71: newest, 72: "2024-01-05"}),  # the other before it
        dated({71: None, 72: "2024-01-05", some[0]: "2024-01-06"}),  # lost again; one moved out of the window
        dated({71: None, 72: "2024-01-05", some[0]: "2024-01-06"}, gone=[71, *some[1:]]),  # deleted at the source
    ]
    for wanted in steps:
        for _ in range(2):
            facts.refresh_fact(spark, path, wanted, rates)
            got = sorted((r.payment_id, str(r.payment_date)) for r in spark.read.parquet(path).collect())
            assert len({i for i, _ in got}) == len(got)
            now = {r.payment_id: str(r.payment_date) for r in wanted.collect()}
            assert all(now.get(i) == d for i, d in got if i in (71, 72, *some))
            assert {i for i, _ in got} >= set(now)


def test_refresh_of_changed_days_and_of_what_hangs_on_them(spark, staged, tmp_path):
    """A payment deleted before the window goes if its day is named; daily revenue and kept checks follow the touched partitions."""
    payments, rates, _ = staged
    path, daily = str(tmp_path / "fact"), str(tmp_path / "daily")
    for grain in ("day", "month"):
        facts.build_fact(path, payments, rates, grain)
        facts.build_daily_revenue(spark, daily, path, grain)
        kept = quality.KeptChecks(spark, str(tmp_path / "kept"), "fct_payments_usd", path, facts.FACT_PERIOD)
        kept.build()
        left = payments.where("payment_id <> 77").withColumn("payment_status", F.when(F.col("payment_id") == 80, "odd").otherwise(F.col("payment_status")))
        unnoticed = facts.refresh_fact(spark, path, left, rates, grain=grain)
        assert spark.read.parquet(path).count() == 9 and day("2024-02-20") not in unnoticed
        touched = facts.refresh_fact(spark, path, left, rates, changed_days={day("2024-02-20")}, grain=grain)
        facts.refresh_daily_revenue(spark, daily, path, touched, grain)
        kept.refresh(touched)
        want = facts.fct_payments_usd(left, rates)
        assert spark.read.parquet(path).select(want.columns).exceptAll(want).count() == 0 and spark.read.parquet(path).count() == 8
        whole = facts.fct_daily_revenue_usd(want)
        got = spark.read.parquet(daily).select(whole.columns)
        assert got.exceptAll(whole).count() == 0 and got.count() == whole.count()
        found = {r.check_name: r.violations for r in kept.violations().collect()}
        assert found == {r.check_name: r.violations for r in quality.check_model(want, "fct_payments_usd").collect()}
        assert found["accepted_values_payment_status"] == 1
        # A key that comes into a second partition is found, and gone again when that is rewritten.
        copy = spark.read.parquet(path).where("payment_id = 71").withColumn(facts.FACT_PERIOD, F.lit(day("2024-05-01"))).withColumn("payment_date", F.lit(day("2024-05-01")))
        replace_partitions(copy, path, facts.FACT_PERIOD)
        kept.refresh({day("2024-05-01")})
        assert {r.check_name: r.violations for r in kept.violations().collect()}["unique_payment_id"] == 1
        remove_folder(day_folder(path, facts.FACT_PERIOD, day("2024-05-01")))
        kept.refresh({day("2024-05-01")})
        assert {r.check_name: r.violations for r in kept.violations().collect()}["unique_payment_id"] == 0


def test_amounts_too_large_are_unconverted(spark):
    row = spark.sql("select cast('9999999999.99' as decimal(12,2)) a, cast('0.00000001' as decimal(18,8)) r")
    got = row.select(money.to_usd_half_up(F.col("a"), F.col("r")), money.to_base_half_even(F.col("a"), F.col("r"))).first()
    assert got == (None, None)


def test_refresh_ignores_what_is_older_than_the_window(spark, staged):
    payments, rates, _ = staged
    loaded = facts.fct_payments_usd(payments, rates)
    doubled = rates.withColumn("rate", (F.col("rate") * 2).cast("decimal(18,8)"))
    got = {r.payment_id: r.amount_usd for r in facts.incremental_fact(loaded, payments, doubled, days=1).collect()}
    assert got[72] == Decimal("16.80") and got[74] == Decimal("50.00")
    empty = loaded.limit(0)
    assert facts.incremental_fact(empty, payments, rates).count() == 9


SILVER = (
    "payment_id long, merchant_id long, shopper_id long, amount decimal(12,2), currency string,"
    " payment_method string, payment_status string, country_code string, created_at timestamp"
)


@pytest.fixture(scope="module")
def silver(spark):
    at = dt.datetime(2026, 1, 2, 10)
    # Every kind of status, two currencies, a merchant with nothing settled.
    rows = [
        (1, 1, 501, Decimal("100.00"), "EUR", "card", "authorized", "NL", at),
        (2, 1, 502, Decimal("50.00"), "EUR", "card", "captured", "NL", at),
        (3, 1, 501, Decimal("25.00"), "EUR", "paypal", "failed", "NL", at),
        (4, 1, 503, Decimal("10.00"), "EUR", "card", "refunded", "NL", at),
        (5, 1, 504, Decimal("75.00"), "USD", "card", "authorized", "US", at),
        (6, 2, 505, Decimal("40.00"), "EUR", "paypal", "chargeback", "NL", at),
    ]
    return spark.createDataFrame(rows, SILVER)


def test_gold_revenue(silver):
    rows = {(r.merchant_id, r.currency): r for r in gold.daily_merchant_revenue(silver).collect()}
    assert set(rows) == {(1, "EUR"), (1, "USD")}
    row = rows[1, "EUR"]
    assert (row.gross_amount, row.payment_count, row.average_amount, row.distinct_shoppers) == (
        Decimal("150.00"), 2, Decimal("75.00"), 2)
    assert rows[1, "USD"].gross_amount == Decimal("75.00")


def test_gold_method_mix(silver):
    rows = {(r.country_code, r.payment_method): r for r in gold.payment_method_mix(silver).collect()}
    assert {k: r.payment_count for k, r in rows.items()} == {("NL", "card"): 3, ("NL", "paypal"): 2, ("US", "card"): 1}
    assert rows["NL", "card"].share_pct + rows["NL", "paypal"].share_pct == pytest.approx(100.0)
    assert rows["US", "card"].share_pct == 100.0


def test_distinct_shoppers_spread_a_hot_group(silver):
    """The first shuffle is on (group, shopper), after a partial aggregate; only then on the group."""
    plan = gold.daily_merchant_revenue(silver)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(shuffles) == 2 and "shopper_id" in shuffles[1] and "shopper_id" not in shuffles[0]


def test_gold_rebuild_replaces(spark, silver, tmp_path):
    lake = Lakehouse(str(tmp_path))
    gold.rebuild_gold(silver, lake)
    gold.rebuild_gold(silver.where("payment_id <> 5"), lake)
    assert lake.read(spark, "gold", "daily_merchant_revenue").count() == 1
    assert lake.table("silver", "payments") == "lakehouse.silver.payments"
    with pytest.raises(ValueError):
        lake.path("bronce", "x")


def test_create_table_keeps_what_exists(spark, tmp_path):
    path = str(tmp_path / "silver")
    create_table(spark, path, PAYMENTS.silver_schema)
    row = spark.createDataFrame([(1,)], "payment_id long")
    replace_table(row, path)
    create_table(spark, path, PAYMENTS.silver_schema)
    assert spark.read.parquet(path).count() == 1


@pytest.fixture(scope="module")
def revenue(spark):
    rows = [
        (day("2026-01-01"), 1, "EUR", 3, Decimal("1234567.89"), Decimal("411522.63"), 3),
        (day("2026-01-01"), 1, "USD", 2, Decimal("500.00"), Decimal("250.00"), 2),
        (day("2026-01-02"), 1, "EUR", 1, Decimal("0.10"), Decimal("0.10"), 1),
        (day("2026-01-02"), 2, "GBP", 5, Decimal("999.99"), Decimal("200.00"), 4),
    ]
    return spark.createDataFrame(
        rows,
        "revenue_date date, merchant_id long, currency string, payment_count long, gross_amount decimal(12,2),"
        " average_amount decimal(12,2), distinct_shoppers long",
    )


FIRST, SECOND = dt.date(2026, 1, 1), dt.date(2026, 1, 2)


def test_revenue_report(revenue):
    report = reports.merchant_revenue(revenue, 1, FIRST, SECOND)
    days = report.days.collect()
    assert [(r.revenue_date, r.currency, r.gross_amount) for r in days] == [
        (FIRST, "EUR", "1234567.89"), (FIRST, "USD", "500.00"), (SECOND, "EUR", "0.10")]
    assert {r.currency: r.amount for r in report.totals.collect()} == {"EUR": "1234567.99", "USD": "500.00"}
    assert reports.merchant_revenue(revenue, 1, FIRST, FIRST).days.count() == 2


def test_all_days_unless_a_page_is_asked_for(spark, revenue):
    year = [(FIRST + dt.timedelta(d), 1, c, 1, None, None, 1) for d in range(366) for c in ("CHF", "EUR", "GBP", "SEK")]
    many = spark.createDataFrame(year, revenue.schema)
    whole = reports.merchant_revenue(many, 1, FIRST, FIRST + dt.timedelta(365))
    assert whole.days.count() == 1464 and not whole.truncated
    page = reports.merchant_revenue(many, 1, FIRST, FIRST + dt.timedelta(365), limit=10)
    assert page.days.count() == 10 and page.total_days == 1464 and page.truncated


def test_totals_cover_the_range_whatever_the_limit(revenue):
    report = reports.merchant_revenue(revenue, 1, FIRST, SECOND, limit=1)
    assert report.days.count() == 1 and report.truncated
    assert {r.currency: r.amount for r in report.totals.collect()} == {"EUR": "1234567.99", "USD": "500.00"}


def test_revenue_arguments(revenue):
    bad = [
        dict(start_date=SECOND, end_date=FIRST),
        dict(end_date=FIRST + dt.timedelta(367)),
        dict(limit=0),
        dict(limit=1.5),
        dict(limit=True),
        dict(merchant_id="1 OR 1=1; DROP TABLE x--"),
        dict(start_date="yesterday"),
        dict(end_date=dt.datetime(2026, 1, 2)),
    ]
    for change in bad:
        with pytest.raises(reports.InvalidArgument):
            reports.merchant_revenue(revenue, **{"merchant_id": 1, "start_date": FIRST, "end_date": SECOND, **change})
    with pytest.raises(reports.UnknownMerchant):
        reports.merchant_revenue(revenue, 999, FIRST, SECOND)
    assert reports.merchant_revenue(revenue, 1, FIRST, FIRST + dt.timedelta(366)).days.count() == 3


def test_report_pushes_its_filters_to_the_scan(spark, revenue, tmp_path):
    path = str(tmp_path / "gold")
    replace_table(revenue, path)
    plan = reports.merchant_revenue(spark.read.parquet(path), 1, FIRST, SECOND).days._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(merchant_id,1)" in plan and "GreaterThanOrEqual(revenue_date,2026-01-01)" in plan
    assert "TakeOrderedAndProject" not in plan  # nothing is cut off


def test_method_mix_report(spark):
    rows = [(FIRST, "NL", "paypal", 30, 30.0), (FIRST, "NL", "card", 70, 70.0), (FIRST, "US", "card", 100, 100.0)]
    mix = spark.createDataFrame(rows, "activity_date date, country_code string, payment_method string, payment_count long, share_pct double")
    got = reports.payment_method_mix_for(mix, FIRST, "nl").collect()
    assert [(r.country_code, r.payment_method) for r in got] == [("NL", "card"), ("NL", "paypal")]
    assert sum(r.payment_count for r in reports.payment_method_mix_for(mix, FIRST).collect()) == 200
    assert reports.payment_method_mix_for(mix, dt.date(2026, 6, 1)).count() == 0
    for country in ("NLD", "", "'; DROP TABLE x--", 5):
        with pytest.raises(reports.InvalidArgument):
            reports.payment_method_mix_for(mix, FIRST, country)


def test_known_merchants(spark, revenue):
    merchants = spark.createDataFrame([(1,), (7,)], "merchant_id long")
    assert [r.merchant_id for r in reports.known_merchants(revenue, merchants).collect()] == [1]


def test_money_text(spark):
    frame = spark.createDataFrame([(Decimal("0.10"),), (Decimal("1234567.80"),), (None,)], "a decimal(12,2)")
    assert [r[0] for r in frame.select(money_string(or_zero(F.col("a")))).collect()] == ["0.10", "1234567.80", "0.00"]


def test_checks_find_what_is_wrong(spark, staged):
    payments, rates, _ = staged
    clean = facts.fct_payments_usd(payments, rates)
    assert all(r.violations == 0 for r in quality.check_model(clean, "fct_payments_usd").collect())
    wrong = clean.withColumn("amount_usd", -F.col("amount_usd")).withColumn("payment_status", F.lit("held"))
    wrong = wrong.unionByName(wrong.where("payment_id = 71")).unionByName(
        wrong.where("payment_id = 73").withColumn("payment_id", F.lit(None).cast("bigint"))
    )
    found = {r.check_name: r.violations for r in quality.check_model(wrong, "fct_payments_usd").collect()}
    assert found == {
        "not_null_payment_id": 1, "accepted_values_payment_status": 11, "no_negative_converted_amounts": 9,
        "usd_payments_convert_one_to_one": 2, "unique_payment_id": 1,
    }
    assert [(r.payment_id, r.row_count) for r in quality.not_unique(wrong, "payment_id").collect()] == [(71, 2)]
    rows = quality.violating_rows(wrong, "fct_payments_usd", "not_null_payment_id")
    assert rows.count() == 1


def test_remaining_checks(spark):
    daily = spark.createDataFrame([(None, 1, None, 1, 2)], "revenue_date date, merchant_id long, gross_amount_usd decimal(18,2), payment_count long, settled_count long")
    assert {r.check_name: r.violations for r in quality.check_model(daily, "fct_daily_revenue_usd").collect()} == {
        "not_null_revenue_date": 1, "not_null_merchant_id": 0, "not_null_gross_amount_usd": 1,
        "revenue_never_exceeds_total_payments": 1}
    grid = spark.createDataFrame([(True, None)], "is_carried_forward boolean, effective_rate decimal(18,8)")
    assert quality.check_model(grid, "fx_rates_daily").first().violations == 1
    feed = spark.createDataFrame([(FIRST, "EUR", Decimal(1)), (FIRST, "EUR", Decimal(2))], "rate_date date, currency string, rate decimal(18,8)")
    assert {r.check_name: r.violations for r in quality.check_model(feed, "stg_fx_rates").collect()}["unique_rate_date_currency"] == 1
