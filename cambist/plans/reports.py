"""Parameterised reports over gold.

Arguments are checked by type and become literals of a plan; no text is ever
put into SQL.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money_string, or_zero

MAX_DAYS = 366


class InvalidArgument(ValueError):
    """The request can never be answered."""


class UnknownMerchant(LookupError):
    """No revenue is recorded for the merchant at all."""


@dataclass(frozen=True)
class RevenueReport:
    """``days`` are all of the range, or its first ``limit`` where a caller asks for a page; then ``truncated`` says so."""

    merchant_id: int
    start_date: dt.date
    end_date: dt.date
    days: DataFrame
    totals: DataFrame
    total_days: int | None = None
    truncated: bool = False
    next_after: tuple[dt.date, str] | None = None


def _whole_number(value) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _day(value) -> bool:
    return isinstance(value, dt.date) and not isinstance(value, dt.datetime)


def _country(value) -> bool:
    return value is None or (isinstance(value, str) and len(value) == 2)


def _position(value) -> bool:
    return value is None or (isinstance(value, tuple) and len(value) == 2 and _day(value[0]) and isinstance(value[1], str))


def _page(value) -> bool:
    return value is None or (_whole_number(value) and value > 0)


#: What each argument has to be: a test, and how to say it.
ARGUMENTS = {
    "merchant_id": (_whole_number, "a whole number"),
    "start_date": (_day, "a date without a time"),
    "end_date": (_day, "a date without a time"),
    "activity_date": (_day, "a date without a time"),
    "limit": (_page, "a positive whole number, or nothing for all days"),
    "after": (_position, "a (date, currency) that an earlier page ended with, or nothing for the first page"),
    "country_code": (_country, "two letters, or nothing for all countries"),
}


def checked(**arguments) -> None:
    """Every argument against its rule; the first that breaks it is named."""
    for name, value in arguments.items():
        fits, wanted = ARGUMENTS[name]
        if not fits(value):
            raise InvalidArgument(f"{name}: expected {wanted}, got {value!r}")


def checked_range(start: dt.date, end: dt.date) -> None:
    length = (end - start).days
    if not 0 <= length <= MAX_DAYS:
        raise InvalidArgument(f"a range goes forward by {MAX_DAYS} days at most; {start} to {end} goes {length}")


def merchant_exists(gold_revenue: DataFrame, merchant_id: int) -> bool:
    return not gold_revenue.where(F.col("merchant_id") == merchant_id).limit(1).isEmpty()


def known_merchants(gold_revenue: DataFrame, merchants: DataFrame) -> DataFrame:
    """The set form of the probe: those of ``merchants`` with any revenue."""
    return merchants.join(gold_revenue.select("merchant_id").distinct(), "merchant_id", "left_semi")


def merchant_revenue(
    gold_revenue: DataFrame,
    merchant_id: int,
    start_date: dt.date,
    end_date: dt.date,
    limit: int | None = None,
    after: tuple[dt.date, str] | None = None,
) -> RevenueReport:
    """All revenue days of one merchant on an inclusive range, and totals per currency.

    With a ``limit`` only the first days are listed, and the report tells how many
    there are and with which (day, currency) to ask for the next page; totals cover the
    whole range either way. A page is found by position, not by counting rows, so none is
    read twice or lost if earlier days change meanwhile. Totals never add currencies up.
    Money leaves as text.
    """
    checked(merchant_id=merchant_id, start_date=start_date, end_date=end_date, limit=limit, after=after)
    checked_range(start_date, end_date)
    if not merchant_exists(gold_revenue, merchant_id):
        raise UnknownMerchant(f"merchant {merchant_id} has no revenue on any day")

    own = gold_revenue.where(F.col("merchant_id") == merchant_id)
    selected = own.where(F.col("revenue_date").between(F.lit(start_date), F.lit(end_date)))
    as_text = {c: money_string(or_zero(F.col(c))) for c in ("gross_amount", "average_amount")}
    listed = ("revenue_date", "merchant_id", "currency", "payment_count", "gross_amount", "average_amount", "distinct_shoppers")
    position = F.struct("revenue_date", "currency")
    behind = selected
    if after is not None:
        day, currency = F.lit(after[0]), F.lit(after[1])
        behind = selected.where((F.col("revenue_date") > day) | ((F.col("revenue_date") == day) & (F.col("currency") > currency)))
    days = behind.withColumns(as_text).select(*listed).orderBy("revenue_date", "currency")
    totals = currency_totals(selected)
    if limit is None:
        return RevenueReport(merchant_id, start_date, end_date, days, totals)
    total, left = selected.count(), behind.count() if after is not None else None
    truncated = (total if left is None else left) > limit
    last = days.limit(limit).agg(F.max(position)).first()[0] if truncated else None
    return RevenueReport(merchant_id, start_date, end_date, days.limit(limit), totals, total, truncated, tuple(last) if last else None)


def currency_totals(revenue: DataFrame) -> DataFrame:
    total = F.sum(or_zero(F.col("gross_amount")))
    return revenue.groupBy("currency").agg(money_string(total).alias("amount")).orderBy("currency")


def payment_method_mix_for(gold_mix: DataFrame, activity_date: dt.date, country_code: str | None = None) -> DataFrame:
    """Methods of one day by volume; a day without activity gives an empty frame."""
    checked(activity_date=activity_date, country_code=country_code)
    selected = gold_mix.where(F.col("activity_date") == F.lit(activity_date))
    if country_code is not None:
        selected = selected.where(F.col("country_code") == country_code.upper())
    return selected.select("country_code", "payment_method", "payment_count", "share_pct").orderBy(
        F.col("payment_count").desc(), "country_code", "payment_method"
    )
