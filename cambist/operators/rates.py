"""Daily rates: documents, forward fill, restatement, gaps in the feed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_between, iso_date
from ..functions.money import plain_decimal_string
from ..schemas import FEED_CURRENCIES, REPORTING_CURRENCY

RATE_KEY = ("rate_date", "base_currency", "currency")

_DOCUMENT = "base string, date string, rates map<string,string>"


def parse_rate_documents(documents: DataFrame, value_column: str = "value") -> DataFrame:
    """One row per usable rate; a bad date, or a null, unreadable or non-positive rate gives none.

    Rates are read as text. ``rate_text`` has the digits of the document, which are
    what is landed; ``rate`` is the same in the rates' column type. A positive rate
    too small for that type is kept, as 0.
    """
    doc = documents.select(F.from_json(value_column, _DOCUMENT).alias("doc"))
    base = F.coalesce(F.when(F.col("doc.base") != "", F.col("doc.base")), F.lit(REPORTING_CURRENCY))
    exploded = doc.select(
        iso_date(F.col("doc.date")).alias("rate_date"),
        F.upper(base).alias("base_currency"),
        F.explode("doc.rates").alias("currency", "rate_text"),
    )
    typed = exploded.select(
        "rate_date",
        "base_currency",
        F.upper("currency").alias("currency"),
        F.col("rate_text").try_cast("decimal(18,8)").alias("rate"),
        "rate_text",
    )
    # Some digit of the number itself is not 0, and it has no minus.
    positive = F.col("rate_text").rlike("^[ +]*[0-9.]*[1-9]")
    return typed.where(F.col("rate_date").isNotNull() & F.col("rate").isNotNull() & positive)


def rates_in_range(
    rates: DataFrame, start: dt.date, end: dt.date, currencies: Iterable[str] = FEED_CURRENCIES
) -> DataFrame:
    """The configured currencies on an inclusive range; days without a document are simply absent."""
    return rates.where(
        F.col("rate_date").between(F.lit(start), F.lit(end)) & F.col("currency").isin(*currencies)
    )


def landing_rows(rates: DataFrame) -> DataFrame:
    """Rates as they are landed: all text, the document's own digits where they are known."""
    own = F.col("rate_text") if "rate_text" in rates.columns else plain_decimal_string(F.col("rate"))
    return rates.select(F.col("rate_date").cast("string").alias("rate_date"), "base_currency", "currency", own.alias("rate"))


def newest_rates(raw: DataFrame) -> DataFrame:
    """One row per natural key: the last load, then the last file, then the higher rate."""
    position = F.row_number().over(
        Window.partitionBy(*RATE_KEY).orderBy(
            F.col("loaded_at").desc_nulls_last(), F.col("source_file").desc_nulls_last(), F.col("rate").desc()
        )
    )
    return raw.withColumn("_position", position).where("_position = 1").select(*RATE_KEY, "rate")


def merge_rates(current: DataFrame, raw: DataFrame) -> DataFrame:
    """Restate: a newly loaded rate replaces the one in force, never adds a second row."""
    newest = newest_rates(raw)
    return current.select(*RATE_KEY, "rate").join(newest, list(RATE_KEY), "left_anti").unionByName(newest)


def rates_daily(
    payments: DataFrame, rates: DataFrame, reporting_currency: str = REPORTING_CURRENCY
) -> DataFrame:
    """The rate in force for every traded currency on every date that occurs.

    Dates come from the data, not from a calendar. They are gathered into arrays
    (at most one entry per calendar day, or currency) and exploded, so the grid
    needs no cross join and payments are read once. ``rates`` has one row per currency and day.
    """
    # One pass over the payments: their dates and currencies, a row of two sets.
    traded = payments.agg(
        F.collect_set("payment_date").alias("dates"),
        F.collect_set(F.when(F.col("currency") != reporting_currency, F.col("currency"))).alias("currencies"),
    )
    fed = rates.agg(F.collect_set("rate_date").alias("fed"))
    grid = (
        traded.withColumn("fed", fed.scalar())
        .select(F.explode("currencies").alias("currency"), F.array_union("dates", "fed").alias("days"))
        .select("currency", F.explode("days").alias("calendar_date"))
    )
    published = rates.where(F.col("base_currency") == reporting_currency).select(
        F.col("rate_date").alias("calendar_date"), "currency", F.col("rate").alias("published_rate")
    )
    so_far = (
        Window.partitionBy("currency")
        .orderBy("calendar_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = grid.join(published, ["currency", "calendar_date"], "left").withColumn(
        "effective_rate", F.last("published_rate", ignorenulls=True).over(so_far)
    )
    return filled.select(
        "calendar_date",
        "currency",
        "published_rate",
        "effective_rate",
        (F.col("published_rate").isNull() & F.col("effective_rate").isNotNull()).alias("is_carried_forward"),
    )


def missing_rate_dates(
    rates: DataFrame,
    start: dt.date,
    end: dt.date,
    currencies: DataFrame,
    base: str = REPORTING_CURRENCY,
) -> DataFrame:
    """Days of the range on which a currency has no published rate.

    ``currencies`` has one column ``currency``; one that is never published
    misses every day.
    """
    wanted = currencies.select(F.upper("currency").alias("currency")).distinct()
    days = wanted.select("currency", F.explode(days_between(start, end)).alias("missing_date"))
    published = rates.where(F.upper("base_currency") == base.upper()).select(
        F.upper("currency").alias("currency"), F.col("rate_date").alias("missing_date")
    )
    return days.join(published, ["currency", "missing_date"], "left_anti")


def gap_runs(missing: DataFrame) -> DataFrame:
    """Runs of consecutive missing days; two days is a weekend, many a stopped feed."""
    order = Window.partitionBy("currency").orderBy("missing_date")
    island = F.date_sub("missing_date", F.row_number().over(order))
    return (
        missing.withColumn("_island", island)
        .groupBy("currency", "_island")
        .agg(
            F.min("missing_date").alias("gap_start"),
            F.max("missing_date").alias("gap_end"),
            F.count(F.lit(1)).alias("gap_days"),
        )
        .drop("_island")
    )
