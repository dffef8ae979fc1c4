"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(value: Column) -> Column:
    """YYYY-MM-DD only; Spark's own cast would also take 2026-1-1."""
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), value.try_cast("date"))


def days_between(start: dt.date, end: dt.date) -> Column:
    """The inclusive calendar as an array."""
    return F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
