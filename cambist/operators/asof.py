"""As-of lookup of daily rates, planned as an equality join."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import REPORTING_CURRENCY

# Rows of (currency, day) that may be broadcast: about 180 currencies over 30 years.
BROADCAST_ROWS = 2_000_000
# Facts of one currency and month that one task sorts.
BLOCK_ROWS = 2_000_000


@dataclass(frozen=True)
class FeedSpan:
    """What the rates alone say about the size of a lookup."""

    currencies: int
    first_day: dt.date | None
    last_day: dt.date | None

    @property
    def calendar_rows(self) -> int:
        """An upper bound of the rows of ``effective_days``."""
        return self.currencies * ((self.last_day - self.first_day).days + 1) if self.first_day else 0


def usable_rates(rates: DataFrame, base: str = REPORTING_CURRENCY) -> DataFrame:
    usable = (F.upper("base_currency") == base.upper()) & (F.col("rate") > 0)
    return rates.where(usable).withColumn("currency", F.upper("currency"))


def feed_span(usable: DataFrame) -> FeedSpan:
    """One small job over the rates; no fact is read."""
    row = usable.agg(F.count_distinct("currency"), F.min("rate_date"), F.max("rate_date")).first()
    return FeedSpan(*row)


def published_rates(usable: DataFrame) -> DataFrame:
    """One rate per (currency, date).

    Where a date is given twice the last one wins: by load time and file where
    the input has them, else the higher rate.
    """
    newest = [F.col(c).desc_nulls_last() for c in ("loaded_at", "source_file") if c in usable.columns]
    position = F.row_number().over(
        Window.partitionBy("currency", "rate_date").orderBy(*newest, F.col("rate").desc())
    )
    return (
        usable.withColumn("_position", position)
        .where("_position = 1")
        .select("rate_date", "currency", F.col("rate").cast("decimal(18,8)").alias("rate"))
    )


def rate_currencies(rates: DataFrame, base: str = REPORTING_CURRENCY) -> DataFrame:
    return (
        rates.where(F.upper("base_currency") == base.upper())
        .select(F.upper("currency").alias("currency"))
        .distinct()
        .orderBy("currency")
    )


def effective_days(published: DataFrame, feed_end: Column) -> DataFrame:
    """Each day from a currency's first rate to the end of the feed, with the rate in force.

    The feed ends on the same day for all currencies, so a later date has the
    rate of that day: the calendar never has to reach the payments' last date,
    and finding that date never has to scan them.
    """
    next_date = F.lead("rate_date").over(Window.partitionBy("currency").orderBy("rate_date"))
    last_day = F.coalesce(F.date_sub("_next", 1), feed_end)
    return (
        published.where(F.col("rate_date") <= feed_end)
        .withColumn("_next", next_date)
        .select(
            "currency",
            F.explode(F.sequence("rate_date", last_day)).alias("rate_day"),
            F.col("rate_date").alias("published_on"),
            "rate",
        )
    )


def asof_rate(
    facts: DataFrame,
    rates: DataFrame,
    currency: str = "currency",
    as_of: str = "payment_date",
    base: str = REPORTING_CURRENCY,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int | None = None,
    span: FeedSpan | None = None,
) -> DataFrame:
    """Add ``rate`` and ``published_on``: the last rate on or before ``as_of``.

    The base currency gets rate 1; no earlier rate gives NULL. The rates are
    broadcast only if their calendar is counted to be small, so ``facts`` is not
    shuffled. Beyond that both sides are hashed on (currency, day, salt): the
    salt splits a currency-day that holds a large part of all facts. After the feed
    has stopped that is every later payment of a currency, so there are as many salts
    as shuffle partitions, which follow the size of the facts. ``span`` spares the job
    that counts the rates, where the caller knows it.
    """
    usable = usable_rates(rates, base)
    span = span or feed_span(usable)
    feed_end = F.lit(span.last_day).cast("date")
    days = effective_days(published_rates(usable), feed_end).select(
        F.col("currency").alias("_code"), F.col("rate_day").alias("_day"), "published_on", "rate"
    )
    code, day = F.upper(F.col(currency)), F.col(as_of).cast("date")
    # least() skips NULLs; a fact without a date has no rate.
    keyed = facts.withColumn("_code", F.when(code != base.upper(), code)).withColumn(
        "_day", F.when(day.isNotNull(), F.least(day, feed_end))
    )
    if span.calendar_rows <= broadcast_rows:
        joined = keyed.join(F.broadcast(days), ["_code", "_day"], "left")
    else:
        # A NULL code never matches; the salt also spreads those rows.
        salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
        days = days.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        # The hint keeps a small calendar from being broadcast after all.
        joined = keyed.join(days.hint("shuffle_hash"), ["_code", "_day", "_salt"], "left").drop("_salt")
    one = F.when(code == base.upper(), F.lit(1).cast("decimal(18,8)"))
    return joined.withColumn("rate", F.coalesce(one, F.col("rate"))).drop("_code", "_day")


def asof_carried(
    facts: DataFrame,
    rates: DataFrame,
    currency: str = "currency",
    as_of: str = "payment_date",
    base: str = REPORTING_CURRENCY,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The same lookup without a calendar: facts and rates sorted together, the last rate carried on to the facts.

    Rows are dealt by (currency, month, salt). Each month starts with the rate in force
    before it, so months do not wait for each other, and a currency that most facts are
    in is spread over its months. A month with more than ``block_rows`` facts is cut by
    salt, each cut with the month's few rates; what is sent is rates times cuts, never days
    times salts. The facts are exchanged once, in the union.
    """
    usable = usable_rates(rates, base)
    span = feed_span(usable)
    feed_end = F.lit(span.last_day).cast("date")
    code, day = F.upper(F.col(currency)), F.col(as_of).cast("date")
    # A later day has the rate of the feed's last. least() skips NULLs; a fact without a date has no rate.
    keyed = facts.select(
        F.struct("*").alias("_fact"), F.when(code != base.upper(), code).alias("_code"), F.when(day.isNotNull(), F.least(day, feed_end)).alias("_day")
    ).withColumn("_month", F.trunc("_day", "month"))
    salts = _cuts(keyed, block_rows)
    # Facts that need no lookup, those in the base currency among them, are dealt over all partitions.
    apart = F.when(F.col("_month").isNull() | F.col("_code").isNull(), F.lit(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = keyed.join(F.broadcast(salts), ["_code", "_month"], "left").withColumn("_cuts", F.coalesce(apart, "_cuts", F.lit(1)))
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64("_fact"), F.col("_cuts")).cast("int"))

    published = published_rates(usable).select(
        F.col("currency").alias("_code"), F.trunc("rate_date", "month").alias("_month"), F.col("rate_date").alias("_day"),
        F.struct("rate", F.col("rate_date").alias("published_on")).alias("_rate"),
    )
    known = published.unionByName(_carried_in(published, feed_end)).join(F.broadcast(salts), ["_code", "_month"], "left")
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_cuts", F.lit(1)) - 1)))
    both = salted.select("_code", "_month", "_salt", "_day", "_fact", F.lit(None).cast(known.schema["_rate"].dataType).alias("_rate")).unionByName(
        known.select("_code", "_month", "_salt", "_day", F.lit(None).cast(keyed.schema["_fact"].dataType).alias("_fact"), "_rate")
    )
    # On one day the rate comes before the facts: a missing fact sorts first.
    in_order = Window.partitionBy("_code", "_month", "_salt").orderBy("_day", F.col("_fact").isNotNull())
    carried = both.withColumn("_rate", F.last("_rate", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    found = carried.where(F.col("_fact").isNotNull())
    no_lookup = F.col("_code").isNull() | F.col("_day").isNull()
    rate, when = (F.when(~no_lookup, F.col(f"_rate.{name}")) for name in ("rate", "published_on"))
    one = F.when(F.upper(F.col(f"_fact.{currency}")) == base.upper(), F.lit(1).cast("decimal(18,8)"))
    return found.select("_fact.*", F.coalesce(one, rate).alias("rate"), when.alias("published_on"))


def _cuts(keyed: DataFrame, block_rows: int) -> DataFrame:
    """Months of a currency with more than ``block_rows`` facts, and in how many cuts each is dealt.

    The bound is raised to a quarter of a shuffle partition's even share, so these are at
    most four rows for each shuffle partition.
    """
    counted = keyed.groupBy("_code", "_month").agg(F.count("*").alias("_rows"))
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = keyed.agg(F.count("*")).first()[0]
    bound = max(block_rows, -(-total // (4 * partitions)))
    heavy = F.col("_code").isNotNull() & F.col("_month").isNotNull() & (F.col("_rows") > bound)
    return counted.where(heavy).select("_code", "_month", F.ceil(F.col("_rows") / F.lit(bound)).cast("int").alias("_cuts"))


def _carried_in(published: DataFrame, feed_end: Column) -> DataFrame:
    """For each month after a currency's first, up to the feed's end, the rate in force before it, dated before all its days."""
    last = published.groupBy("_code", "_month").agg(F.max(F.struct("_day", "_rate")).alias("_last"))
    following = F.lead("_month").over(Window.partitionBy("_code").orderBy("_month"))
    until = F.coalesce(following, F.trunc(feed_end, "month"))
    first = F.add_months("_month", 1)
    months = last.withColumn("_until", until).where(first <= F.col("_until"))
    return months.select(
        "_code", F.explode(F.sequence(first, F.col("_until"), F.expr("interval 1 month"))).alias("_month"), F.col("_last._rate").alias("_rate")
    ).select("_code", "_month", F.date_sub("_month", 1).alias("_day"), "_rate")
