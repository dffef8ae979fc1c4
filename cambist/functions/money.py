"""Exact money arithmetic and rendering on decimal columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SETTLED_STATUSES


def is_settled(status: Column) -> Column:
    return status.isin(*SETTLED_STATUSES)


def money_string(amount: Column) -> Column:
    """Two decimals as text: a JSON number would be read back as a double."""
    return amount.cast("decimal(38,2)").cast("string")


def or_zero(amount: Column) -> Column:
    """A numeric as decimal, never through a float; NULL counts as zero."""
    return F.coalesce(amount.cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)"))


def to_usd_half_up(amount: Column, rate: Column) -> Column:
    """The fact table's conversion: a rate is units per USD, so divide; the cast rounds half up.

    A result too large for the column is NULL, as a payment without a rate is.
    """
    return F.when(rate > 0, F.try_divide(amount, rate).try_cast("decimal(18,2)"))


def to_base_half_even(amount: Column, rate: Column) -> Column:
    """The lookup's conversion: banker's rounding to cents; NULL without a usable rate or if too large."""
    return F.when(rate != 0, F.bround(F.try_divide(amount, rate), 2).try_cast("decimal(18,2)"))


def plain_decimal_string(value: Column) -> Column:
    """Decimal text without the zeros that only pad the scale: 0.92000000 → 0.92."""
    return F.rtrim(F.rtrim(value.cast("string"), F.lit("0")), F.lit("."))
