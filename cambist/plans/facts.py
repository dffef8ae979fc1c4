"""Payments in the reporting currency, and daily revenue from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import is_settled, to_usd_half_up
from ..operators.asof import asof_rate
from ..schemas import REPORTING_CURRENCY
from ..session import scratch_dir
from ..sources.layers import day_folder, days_of, read_days, remove_folder, replace_partitions, replace_table

RESTATEMENT_DAYS = 7
#: Partition columns: the first day of the day, month or quarter that a partition holds.
FACT_PERIOD, REVENUE_PERIOD = "payment_period", "revenue_period"


def fct_payments_usd(payments: DataFrame, rates: DataFrame, currency: str = REPORTING_CURRENCY) -> DataFrame:
    """Every staged payment at the rate in force on its own date.

    No rate in force leaves ``amount_usd`` NULL and the row flagged; it is
    neither dropped nor converted at 1.
    """
    rated = asof_rate(payments, rates, "currency", "payment_date", currency)
    in_usd = F.col("currency") == currency
    amount_usd = F.when(in_usd, F.col("amount").cast("decimal(18,2)")).otherwise(
        to_usd_half_up(F.col("amount"), F.col("rate"))
    )
    carried = F.col("published_on").isNotNull() & (F.col("published_on") != F.col("payment_date"))
    converted = rated.select(
        "payment_id",
        "merchant_id",
        "shopper_id",
        "payment_date",
        "created_at",
        "currency",
        "amount",
        "payment_method",
        "payment_status",
        "country_code",
        F.col("rate").alias("fx_rate"),
        amount_usd.alias("amount_usd"),
        carried.alias("fx_rate_carried_forward"),
    )
    return converted.select(
        "*",
        is_settled(F.col("payment_status")).alias("is_revenue"),
        F.col("amount_usd").isNull().alias("is_unconverted"),
    )


def restatement_start(fact: DataFrame, days: int = RESTATEMENT_DAYS) -> DataFrame:
    """First day to process again: rates published late change payments already loaded."""
    newest = F.coalesce(F.max("payment_date"), F.lit("1900-01-01").cast("date"))
    return fact.agg(F.date_sub(newest, days).alias("start_date"))


def restated_payments(payments: DataFrame, fact: DataFrame, days: int = RESTATEMENT_DAYS) -> DataFrame:
    return payments.where(F.col("payment_date") >= restatement_start(fact, days).scalar())


def merge_fact(fact: DataFrame, changed: DataFrame) -> DataFrame:
    """Upsert on payment_id."""
    return fact.join(changed, "payment_id", "left_anti").unionByName(changed.select(*fact.columns))


def incremental_fact(
    fact: DataFrame, payments: DataFrame, rates: DataFrame, days: int = RESTATEMENT_DAYS
) -> DataFrame:
    return merge_fact(fact, fct_payments_usd(restated_payments(payments, fact, days), rates))


def _periods(day: Column, grain: str) -> Column:
    return day if grain == "day" else F.trunc(day, grain)


def build_fact(path: str, payments: DataFrame, rates: DataFrame, grain: str = "day") -> None:
    """The whole fact table, partitioned by the day, month or quarter (``grain``) of payment."""
    fact = fct_payments_usd(payments, rates)
    replace_table(fact.withColumn(FACT_PERIOD, _periods(F.col("payment_date"), grain)), path, FACT_PERIOD)


def refresh_fact(
    spark: SparkSession,
    path: str,
    payments: DataFrame,
    rates: DataFrame,
    days: int = RESTATEMENT_DAYS,
    dates_can_move: bool = True,
    changed_days: Collection = (),
    grain: str = "day",
) -> set:
    """Bring the fact table up to date by rewriting only the partitions that change; returns these.

    The window's days, ``changed_days`` (those that a publication of payments has
    rewritten) and the payments without a date are taken anew from ``payments``: what
    was deleted there goes. A payment that stood in them and now has an older day, a
    repaired date among them, is moved to that day; one that has come into them leaves
    its older day. Older days are otherwise left as they are, so a payment deleted there,
    or first seen there, is noticed only if its day is among the changed ones, or by a
    whole build. Finding payments that came in reads two columns of the older days; where
    the source never changes a payment's date, ``dates_can_move=False`` saves it.
    """
    schema = T.StructType([*fct_payments_usd(payments, rates).schema.fields, T.StructField(FACT_PERIOD, T.DateType())])
    fact = spark.read.schema(schema).parquet(path)
    loaded = days_of(path, FACT_PERIOD)
    newest = max((d for d in loaded if d is not None), default=None)
    last = read_days(spark, path, FACT_PERIOD, [newest], schema).agg(F.max("payment_date")).first()[0] if newest else None
    start = (last or dt.date(1900, 1, 1)) - dt.timedelta(days=days)
    in_window = F.coalesce(F.col("payment_date") >= F.lit(start), F.lit(True))  # without a date: always
    for first, last in day_runs({d for d in changed_days if d is not None and d < start}):
        in_window = in_window | F.col("payment_date").between(F.lit(first), F.lit(last))

    recent = payments.where(in_window)
    # Partitions that begin before the window may reach into it; the condition sorts their rows out.
    stood = fact.where(in_window).select("payment_id", FACT_PERIOD)
    scratch = scratch_dir(spark, "fact-changes")
    left = _written(stood, f"{scratch}/stood")
    moved_out = payments.where(~in_window).join(left.join(recent, "payment_id", "left_anti"), "payment_id", "left_semi")
    # Written once: the partitions, the older rows it replaces and the new ones all come from it.
    changed = fct_payments_usd(recent.unionByName(moved_out), rates)
    changed = _written(changed.withColumn(FACT_PERIOD, _periods(F.col("payment_date"), grain)), f"{scratch}/changed")
    touched = _days(left, FACT_PERIOD) | _days(changed, FACT_PERIOD)
    if dates_can_move:
        touched |= _days(fact.where(~in_window).join(changed.select("payment_id"), "payment_id", "left_semi"), FACT_PERIOD)
    kept = read_days(spark, path, FACT_PERIOD, touched, schema).where(~in_window)
    merged = _written(merge_fact(kept, changed), f"{scratch}/merged")
    replace_partitions(merged, path, FACT_PERIOD)
    # A dynamic overwrite leaves a partition alone that gets no rows. Should the job
    # end before this, the next refresh finds the same partitions empty again.
    for day in touched - _days(merged, FACT_PERIOD):
        remove_folder(day_folder(path, FACT_PERIOD, day))
    return touched


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _days(frame: DataFrame, column: str) -> set:
    """Distinct days on the driver: at most one row per calendar day."""
    return {row[0] for row in frame.select(column).distinct().collect()}


def day_runs(days: Collection[dt.date], most: int = 100) -> list[tuple[dt.date, dt.date]]:
    """Days as runs from first to last; the narrowest gaps are bridged until there are at most ``most`` runs."""
    ordered = sorted(days)
    gaps = sorted(((b - a).days, b) for a, b in zip(ordered, ordered[1:]) if (b - a).days > 1)
    cuts = sorted(b for _, b in gaps[::-1][: most - 1])
    firsts = [*ordered[:1], *cuts]
    return [(first, max(d for d in ordered if nxt is None or d < nxt)) for first, nxt in zip(firsts, [*cuts, None])]


def fct_daily_revenue_usd(fact: DataFrame) -> DataFrame:
    """Revenue by day and merchant. Only settled and converted rows are summed; the gap is counted."""
    revenue, unconverted = F.col("is_revenue"), F.col("is_unconverted")
    zero = F.lit(0).cast("decimal(18,2)")
    return fact.groupBy(F.col("payment_date").alias("revenue_date"), "merchant_id").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.count_if(revenue).alias("settled_count"),
        F.sum(F.when(revenue & ~unconverted, F.col("amount_usd")).otherwise(zero)).alias("gross_amount_usd"),
        F.count_if(revenue & unconverted).alias("unconverted_count"),
        F.count_distinct("shopper_id").alias("distinct_shoppers"),
        F.count_if("fx_rate_carried_forward").alias("carried_forward_count"),
    )


def build_daily_revenue(spark: SparkSession, path: str, fact_path: str, grain: str = "day") -> None:
    """Daily revenue of the whole written fact, partitioned as the fact is."""
    daily = fct_daily_revenue_usd(spark.read.parquet(fact_path))
    replace_table(daily.withColumn(REVENUE_PERIOD, _periods(F.col("revenue_date"), grain)), path, REVENUE_PERIOD)


def refresh_daily_revenue(spark: SparkSession, path: str, fact_path: str, periods: Collection, grain: str = "day") -> None:
    """Daily revenue of those partitions of the fact alone; one that the fact no longer has goes."""
    schema = spark.read.parquet(fact_path).schema
    daily = fct_daily_revenue_usd(read_days(spark, fact_path, FACT_PERIOD, periods, schema))
    replace_partitions(daily.withColumn(REVENUE_PERIOD, _periods(F.col("revenue_date"), grain)), path, REVENUE_PERIOD)
    for day in set(periods) - days_of(fact_path, FACT_PERIOD):
        remove_folder(day_folder(path, REVENUE_PERIOD, day))


def daily_shoppers(fact: DataFrame) -> DataFrame:
    """The shoppers of each day and merchant, one row each: sets that can be merged over any days.

    Rows and not bitmaps: a built-in bitmap takes 4 KB for each run of 32,768 numbers that
    a group touches, and a merchant's day touches many with a shopper or two.
    """
    return fact.where(F.col("shopper_id").isNotNull()).select(F.col("payment_date").alias("revenue_date"), "merchant_id", "shopper_id").distinct()


def shoppers_by_period(shoppers: DataFrame, period: str) -> DataFrame:
    """Distinct shoppers of each merchant by week, month, quarter or year; each shopper's days are merged before the count."""
    start = F.trunc("revenue_date", period).alias("period_start")
    merged = shoppers.select(start, "merchant_id", "shopper_id").distinct()
    return merged.groupBy("period_start", "merchant_id").agg(F.count("*").alias("distinct_shoppers"))


def unconverted_by_currency(fact: DataFrame) -> DataFrame:
    """Where to look first when USD revenue looks low."""
    return fact.where("is_unconverted").groupBy("currency").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.min("payment_date").alias("first_date"),
        F.max("payment_date").alias("last_date"),
    )
