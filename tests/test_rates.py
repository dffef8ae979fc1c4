"""Rates: documents, landing, restatement, lookup, fill, gaps."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cambist.functions.money import to_base_half_even
from cambist.operators.asof import asof_rate, feed_span, rate_currencies, usable_rates
from cambist.operators.rates import (
    gap_runs,
    landing_rows,
    merge_rates,
    missing_rate_dates,
    parse_rate_documents,
    rates_daily,
    rates_in_range,
)
from cambist.sources.fx_files import land_rates, load_landed_rates, read_rate_documents, read_raw_rates

FRIDAY, SATURDAY, SUNDAY, MONDAY = (dt.date(2026, 1, d) for d in (2, 3, 4, 5))
RATES = "rate_date date, base_currency string, currency string, rate decimal(18,8)"


def document(day, base="USD", **rates):
    return json.dumps({"base": base, "date": str(day), "rates": rates})


def parse(spark, *documents):
    return parse_rate_documents(spark.createDataFrame([(d,) for d in documents], "value string"))


@pytest.fixture(scope="module")
def feed(spark):
    """EUR moves over the weekend; GBP is published once."""
    return parse(
        spark,
        document(FRIDAY, EUR="0.92", GBP="0.79", JPY="157.2"),
        document(MONDAY, EUR="0.95", JPY="158.0"),
    )


def ask(spark, feed, *questions, **options):
    """(amount, currency, day) → [(rate, converted)]"""
    rows = [(i, Decimal(a) if a is not None else None, c, d) for i, (a, c, d) in enumerate(questions)]
    frame = spark.createDataFrame(rows, "i int, amount decimal(12,2), currency string, day date")
    looked_up = asof_rate(frame, feed, "currency", "day", **options)
    converted = to_base_half_even(F.col("amount"), F.col("rate")).alias("converted")
    return [(r.rate, r.converted) for r in looked_up.select("i", "rate", converted).orderBy("i").collect()]


def test_documents(spark):
    rows = parse(
        spark,
        document(FRIDAY, EUR=0.92, gbp="0.79", CHF="-1", CAD="0", AUD=None, SEK="NaN", NOK="abc"),
        document(SATURDAY, base=None, EUR=1),
        document(SUNDAY, base="", EUR=2),
        document("not-a-date", EUR=1),
        document("2026-1-1", EUR=1),
        json.dumps({"rates": {"EUR": 1}}),
        json.dumps({"date": "2026-01-06", "rates": None}),
        "[]",
        "broken",
    ).collect()
    assert {(r.rate_date, r.base_currency, r.currency, r.rate) for r in rows} == {
        (FRIDAY, "USD", "EUR", Decimal("0.92")),
        (FRIDAY, "USD", "GBP", Decimal("0.79")),
        (SATURDAY, "USD", "EUR", Decimal(1)),
        (SUNDAY, "USD", "EUR", Decimal(2)),
    }


def test_range_and_currencies(spark, feed):
    got = rates_in_range(feed, FRIDAY, SATURDAY, ("EUR", "GBP")).collect()
    assert {(r.rate_date, r.currency) for r in got} == {(FRIDAY, "EUR"), (FRIDAY, "GBP")}


def test_landed_rates_are_text(spark):
    rows = landing_rows(parse(spark, document(FRIDAY, EUR="0.92", JPY="157", GBP="10.0"))).collect()
    assert {r.currency: r.rate for r in rows} == {"EUR": "0.92", "JPY": "157", "GBP": "10.0"}
    assert {r.rate_date for r in rows} == {"2026-01-02"}


def test_landing_loads_each_file_once_and_restates(spark, tmp_path):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "_checkpoint"))
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(json.dumps(json.loads(document(FRIDAY, EUR="0.92", GBP="0.79")), indent=1))
    documents = read_rate_documents(spark, str(tmp_path / "docs"))
    land_rates(parse_rate_documents(documents), landing)
    for _ in range(2):
        load_landed_rates(spark, landing, raw, checkpoint)
    assert read_raw_rates(spark, raw).count() == 2
    land_rates(parse(spark, document(FRIDAY, EUR="0.93")), landing)
    load_landed_rates(spark, landing, raw, checkpoint)
    loaded = read_raw_rates(spark, raw)
    assert loaded.count() == 3
    current = spark.createDataFrame([(FRIDAY, "USD", "GBP", Decimal("0.50")), (SUNDAY, "USD", "CHF", Decimal(1))], RATES)
    merged = {(r.rate_date, r.currency): r.rate for r in merge_rates(current, loaded).collect()}
    assert merged == {
        (FRIDAY, "EUR"): Decimal("0.93"), (FRIDAY, "GBP"): Decimal("0.79"), (SUNDAY, "CHF"): Decimal(1)
    }


@pytest.mark.parametrize("line", ["{broken", '{"rate_date":"2026-01-02","base_currency":"USD","currency":"EUR","rate":"x"}'])
def test_a_bad_landed_line_stops_the_load(spark, tmp_path, line):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "part-0.json").write_text(line + "\n")
    with pytest.raises(Exception):
        load_landed_rates(spark, *(str(tmp_path / n) for n in ("landing", "raw", "_checkpoint")))


def test_rate_in_force(spark, feed):
    days = [("EUR", FRIDAY), ("EUR", SATURDAY), ("EUR", SUNDAY), ("EUR", MONDAY), ("eur", FRIDAY),
            ("GBP", dt.date(2026, 3, 1)), ("USD", SATURDAY), ("usd", SATURDAY),
            ("EUR", dt.date(2025, 12, 1)), ("XYZ", FRIDAY), (None, FRIDAY), ("EUR", None)]
    want = ["0.92", "0.92", "0.92", "0.95", "0.92", "0.79", "1", "1", None, None, None, None]
    for options in ({}, {"broadcast_rows": 0, "salts": 4}):
        got = [rate for rate, _ in ask(spark, feed, *[("1.00", c, d) for c, d in days], **options)]
        assert got == [None if w is None else Decimal(w) for w in want], options


def test_conversion(spark, feed):
    got = ask(
        spark, feed, ("149.99", "EUR", FRIDAY), ("499.50", "USD", SATURDAY), ("100.00", "EUR", FRIDAY),
        ("100.00", "EUR", MONDAY), ("1.00", "JPY", FRIDAY), ("100.00", "GBP", dt.date(2025, 1, 1)), (None, "EUR", FRIDAY),
    )
    want = ["163.03", "499.50", "108.70", "105.26", "0.01", None, None]
    assert [converted for _, converted in got] == [None if w is None else Decimal(w) for w in want]


def test_half_cents_go_to_even(spark):
    feed = spark.createDataFrame([(FRIDAY, "USD", "HKD", Decimal(8))], RATES)
    got = ask(spark, feed, ("0.04", "HKD", FRIDAY), ("0.12", "HKD", FRIDAY), ("-0.04", "HKD", FRIDAY))
    assert [c for _, c in got] == [Decimal("0.00"), Decimal("0.02"), Decimal("0.00")]


def test_base_filter_and_duplicates(spark):
    rows = [(FRIDAY, "EUR", "GBP", Decimal(5)), (FRIDAY, "usd", "gbp", Decimal(2)), (FRIDAY, "USD", "GBP", Decimal(3)),
            (FRIDAY, "USD", "CHF", Decimal(0))]
    feed = spark.createDataFrame(rows, RATES)
    assert ask(spark, feed, ("1.00", "GBP", FRIDAY), ("1.00", "CHF", FRIDAY)) == [(Decimal(3), Decimal("0.33")), (None, None)]
    assert [r.currency for r in rate_currencies(feed).collect()] == ["CHF", "GBP"]


def test_empty_feed(spark):
    feed = spark.createDataFrame([], RATES)
    assert ask(spark, feed, ("1.00", "EUR", FRIDAY), ("1.00", "USD", FRIDAY)) == [(None, None), (Decimal(1), Decimal("1.00"))]


def test_broadcast_only_when_counted_small(spark, feed):
    assert feed_span(usable_rates(feed)).calendar_rows == 3 * 4
    facts = spark.createDataFrame([], "currency string, day date")

    def plan(**options):
        return asof_rate(facts, feed, "currency", "day", **options)._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in plan() and "NestedLoop" not in plan()
    with_salt = plan(broadcast_rows=11)
    assert "ShuffledHashJoin" in with_salt and "_salt" in with_salt
    assert not any(join in with_salt for join in ("BroadcastHashJoin", "NestedLoop", "Cartesian"))
    assert "BroadcastHashJoin" in plan(span=feed_span(usable_rates(feed)))


def brute_force(published, currency, day):
    known = [(d, r) for d, c, r in published if c == currency and d <= day]
    return max(known)[1] if known else None


def test_lookup_equals_brute_force_and_the_filled_grid(spark):
    day = st.integers(0, 40).map(lambda n: dt.date(2026, 1, 1) + dt.timedelta(n))
    code = st.sampled_from(["EUR", "GBP", "CHF"])

    @settings(max_examples=50, deadline=None)
    @given(st.dictionaries(st.tuples(day, code), st.integers(1, 999), max_size=15), st.lists(st.tuples(code, day), min_size=1, max_size=25))
    def check(published, asked):
        feed = spark.createDataFrame([(d, "USD", c, Decimal(r)) for (d, c), r in published.items()], RATES)
        flat = [(d, c, Decimal(r)) for (d, c), r in published.items()]
        payments = spark.createDataFrame([(i, c, d) for i, (c, d) in enumerate(asked)], "i int, currency string, payment_date date")
        want = [brute_force(flat, c, d) for c, d in asked]
        got = asof_rate(payments, feed).orderBy("i").collect()
        assert [r.rate for r in got] == want
        grid = {(r.currency, r.calendar_date): r for r in rates_daily(payments, feed).collect()}
        assert [grid[c, d].effective_rate for c, d in asked] == want
        for r in got:
            carried = r.published_on is not None and r.published_on != r.payment_date
            assert grid[r.currency, r.payment_date].is_carried_forward == carried

    check()


def test_grid_covers_every_date_and_traded_currency_only(spark, feed):
    payments = spark.createDataFrame(
        [("EUR", SATURDAY), ("XYZ", SUNDAY), ("USD", dt.date(2025, 12, 31))], "currency string, payment_date date"
    )
    grid = rates_daily(payments, feed)
    got = {(r.currency, r.calendar_date): (r.published_rate, r.effective_rate, r.is_carried_forward) for r in grid.collect()}
    days = (dt.date(2025, 12, 31), FRIDAY, SATURDAY, SUNDAY, MONDAY)
    assert set(got) == {(c, d) for c in ("EUR", "XYZ") for d in days}
    assert got["EUR", SUNDAY] == (None, Decimal("0.92"), True)
    assert got["EUR", MONDAY] == (Decimal("0.95"), Decimal("0.95"), False)
    assert got["EUR", days[0]] == (None, None, False) and got["XYZ", MONDAY] == (None, None, False)
    plan = grid._jdf.queryExecution().sparkPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_missing_dates_and_runs(spark, feed):
    wanted = spark.createDataFrame([("EUR",), ("gbp",), ("XYZ",)], "currency string")
    missing = missing_rate_dates(feed, FRIDAY, MONDAY, wanted)
    by_currency = {}
    for r in missing.orderBy("missing_date").collect():
        by_currency.setdefault(r.currency, []).append(r.missing_date)
    assert by_currency == {
        "EUR": [SATURDAY, SUNDAY], "GBP": [SATURDAY, SUNDAY, MONDAY], "XYZ": [FRIDAY, SATURDAY, SUNDAY, MONDAY]
    }
    runs = gap_runs(missing_rate_dates(feed, dt.date(2026, 1, 1), MONDAY, wanted.where("currency = 'EUR'"))).collect()
    assert sorted((r.gap_start, r.gap_end, r.gap_days) for r in runs) == [
        (dt.date(2026, 1, 1), dt.date(2026, 1, 1), 1), (SATURDAY, SUNDAY, 2)
    ]
