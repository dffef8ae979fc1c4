"""Every registered query: (session, folder) → DataFrame over the whole given tables."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import wire
from ..functions.money import to_base_half_even
from ..operators import asof, collapse, decode, merge, offsets, rates
from ..plans import facts, gold, quality, reports, staging
from ..schemas import FEED_CURRENCIES, MERCHANTS, MONEY, PAYMENTS, RAW_MERCHANTS, REFUNDS
from ..session import prepare, scratch_dir
from ..sources import change_log, fx_files
from ..sources.layers import Lakehouse, days_of, replace_partitions, replace_table
from ..sources.silver_store import SilverStore
from ..streaming.bronze import run_bronze
from ..streaming.silver import apply_batch, run_silver
from . import adapters as a

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

REPORT_MERCHANT = 3
REPORT_START, REPORT_END = dt.date(1997, 1, 1), dt.date(1997, 12, 31)
MIX_DAY = dt.date(1998, 3, 4)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(prepare(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def comparable(frame: DataFrame) -> DataFrame:
    """Instants as plain UTC timestamps; run times left out."""
    return frame.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in frame.schema.fields
            if f.name not in ("ingested_at", "loaded_at")
        ]
    )


def feed_range(feed: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last day of the rates; a feed without rates has a range of one day."""
    first, last = feed.agg(F.min("rate_date"), F.max("rate_date")).first()
    return (first, last) if first else (dt.date(1970, 1, 1), dt.date(1970, 1, 1))


def decoded(spark, sf_dir):
    return decode.decoded_changes(change_log.to_bronze(a.messages(spark, sf_dir)), PAYMENTS)


def halves(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All messages in two batches, by hour, so each holds changes older than some in the other."""
    morning = F.hour("kafka_timestamp") < 12
    return messages.where(morning), messages.where(~morning)


# -- change events -------------------------------------------------------
@query
def bronze_projection(spark, sf_dir):
    """Records of the raw ``props`` texts, which both engines have verbatim."""
    records = a.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit(PAYMENTS.topic).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return change_log.to_bronze(records)


@query
def decode_changes(spark, sf_dir):
    return decoded(spark, sf_dir).drop("value", "kafka_timestamp")


@query
def decode_decimal_forms(spark, sf_dir):
    events = a.event_facts(spark, sf_dir).select("event_id", "cents")
    cents = F.col("cents")
    wide = F.lpad(a.sixteen_digits(cents), 32, F.when(cents < 0, F.lit("F")).otherwise(F.lit("0")))
    forms = {
        "base64_minimal": a.quoted(a.base64_of(a.minimal_digits(cents))),
        "base64_8_bytes": a.quoted(a.base64_of(a.sixteen_digits(cents))),
        "base64_16_bytes": a.quoted(a.base64_of(wide)),
        "digits": a.quoted(a.digits_of(cents)),
        "whole_cents": cents.cast("string"),
        "number": a.digits_of(cents),
        "null": F.lit("null"),
        "empty": F.lit('""'),
        "no_padding": F.lit('"EHU"'),
        "object": F.lit("{}"),
    }
    pairs = [F.struct(F.lit(name).alias("form"), text.alias("text")) for name, text in forms.items()]
    exploded = events.select("event_id", F.inline(F.array(*pairs)))
    parsed = exploded.select("event_id", "form", F.try_parse_json("text").alias("json"))
    texts = parsed.select("*", wire.variant_text(F.col("json")).alias("text"))
    return texts.select("event_id", "form", wire.money(F.col("json"), F.col("text"), MONEY).alias("amount"))


#: Digits of amounts beyond 64 bits, and up to them.
WIDE_DIGITS = (17, 18, 19, 20, 25, 31, 38)


@query
def decode_wide_decimals(spark, sf_dir):
    """Amounts of 17 to 38 digits with four places, both signs, in three forms."""
    events = a.event_facts(spark, sf_dir).select("event_id", "cents")
    sizes = [F.struct(F.lit(str(n)).alias("digits"), a.wide_amount(F.col("cents"), n).alias("whole")) for n in WIDE_DIGITS]
    wholes = events.select("event_id", F.inline(F.array(*sizes))).select("*", F.col("whole").cast("string").alias("plain"))
    text = F.col("plain")
    forms = {
        "base64": a.quoted(a.base64_of(a.minimal_digits_of(a.thirty_two_digits(F.col("whole"))))),
        "whole": text,
        "digits": a.quoted(F.concat(text.substr(F.lit(1), F.length(text) - 4), F.lit("."), F.right(text, F.lit(4)))),
    }
    pairs = [F.struct(F.concat(F.lit(f"{name}_"), "digits").alias("form"), value.alias("text")) for name, value in forms.items()]
    parsed = wholes.select("event_id", F.inline(F.array(*pairs))).select("event_id", "form", F.try_parse_json("text").alias("json"))
    texts = parsed.select("*", wire.variant_text(F.col("json")).alias("text"))
    return texts.select("event_id", "form", wire.money(F.col("json"), F.col("text"), T.DecimalType(38, 4)).alias("amount"))


@query
def quarantine_rows(spark, sf_dir):
    return decode.quarantine(decoded(spark, sf_dir)).select("topic", "partition", "offset", "reason")


@query
def quarantine_appended(spark, sf_dir):
    """What the batches put into quarantine, some messages having been read twice."""
    return _three_batches(spark, sf_dir).quarantined().select("topic", "partition", "offset", "reason")


@query
def bronze_reconciliation(spark, sf_dir):
    return decode.reconciliation(decoded(spark, sf_dir), "topic", "partition")


@query
def latest_change_per_key(spark, sf_dir):
    latest = collapse.latest_change_per_key(decoded(spark, sf_dir), PAYMENTS)
    return latest.drop("value", "kafka_timestamp", "reason", "topic")


@query
def merge_two_batches(spark, sf_dir):
    first, second = (collapse.state_rows(half, PAYMENTS) for half in halves(decoded(spark, sf_dir)))
    return collapse.live_rows(merge.merge_changes(first, second), PAYMENTS)


@query
def merge_replay(spark, sf_dir):
    first, second = (collapse.state_rows(half, PAYMENTS) for half in halves(decoded(spark, sf_dir)))
    once = merge.merge_changes(first, second)
    return collapse.live_rows(merge.merge_changes(once, first), PAYMENTS)


@query
def merge_reference_clauses(spark, sf_dir):
    first, second = (collapse.state_rows(half, PAYMENTS) for half in halves(decoded(spark, sf_dir)))
    return merge.merge_changes(collapse.live_rows(first, PAYMENTS), second, strict=False)


@query
def silver_current(spark, sf_dir):
    return collapse.current_rows(decoded(spark, sf_dir), PAYMENTS)


@query
def merchants_current(spark, sf_dir):
    return collapse.current_rows(decode.decoded_changes(a.merchant_messages(spark, sf_dir), MERCHANTS), MERCHANTS)


@query
def refunds_current(spark, sf_dir):
    return collapse.current_rows(decode.decoded_changes(a.refund_messages(spark, sf_dir), REFUNDS), REFUNDS)


@query
def silver_after_compaction(spark, sf_dir):
    bronze = change_log.to_bronze(a.messages(spark, sf_dir))
    first, second = halves(bronze)
    store = SilverStore(spark, scratch_dir(spark, "silver")).create()
    apply_batch(store, first, "q", 0)
    apply_batch(store, second, "q", 1)
    store.compact()
    apply_batch(store, first, "after-reset", 0)
    return store.current()


@query
def silver_published_changes(spark, sf_dir):
    """Published in three turns: the mornings, then what the afternoons change, then the mornings once more, which change nothing."""
    morning, afternoon = halves(change_log.to_bronze(a.messages(spark, sf_dir)))
    root = scratch_dir(spark, "silver")
    store = SilverStore(spark, root).create()
    for batch, part in enumerate((morning, afternoon, morning)):
        apply_batch(store, part, "q", batch)
        store.publish_changes(f"{root}/published")
    return store.live(f"{root}/published").drop("created_date")


@query
def silver_partial_replay(spark, sf_dir):
    """A stretch of the log first applied under the wrong decimal mode, then replayed."""
    bronze, root = change_log.to_bronze(a.messages(spark, sf_dir)), scratch_dir(spark, "silver")
    stretch = F.col("offset").between(2_000, 2_400)
    store = SilverStore(spark, root).create()
    apply_batch(store, bronze.where(~stretch), "q", 0)
    apply_batch(store, bronze.where(stretch), "q", 1, decimal_mode="string")
    store.replay(bronze, stretch, f"{root}/published")
    return store.live(f"{root}/published").drop("created_date")


def _three_batches(spark, sf_dir) -> SilverStore:
    """The log applied in batches: the mornings, all of it, and the mornings again under another query; the first is tried twice."""
    bronze = change_log.to_bronze(a.messages(spark, sf_dir))
    morning, _ = halves(bronze)
    store = SilverStore(spark, scratch_dir(spark, "silver")).create()
    for query_id, batch_id, part in (("q", 0, morning), ("q", 0, morning), ("q", 1, bronze), ("after-reset", 0, morning)):
        apply_batch(store, part, query_id, batch_id)
    return store


@query
def silver_batch_metrics(spark, sf_dir):
    """Counters kept by query and batch; one that was tried again is there once."""
    return _three_batches(spark, sf_dir).metrics()


@query
def offset_coverage(spark, sf_dir):
    """What the batches of a log together read and missed, from the runs of offsets they kept."""
    return offsets.coverage(_three_batches(spark, sf_dir).offsets())


@query
def offset_gap_list(spark, sf_dir):
    """Runs of offsets missing from two batches that overlap: the mornings and the log without every tenth event."""
    bronze = change_log.to_bronze(a.messages(spark, sf_dir))
    morning, _ = halves(bronze)
    thinned = bronze.where(F.col("offset") % 10 != 3)
    return offsets.gap_list(offsets.offset_runs(morning).unionByName(offsets.offset_runs(thinned)))


@query
def silver_stream(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    # As many files as the table is read in: each trigger takes some of them.
    a.messages(spark, sf_dir, spread=False).write.parquet(f"{root}/log")
    log = change_log.FileLogSource(f"{root}/log", max_files_per_trigger=4)
    run_bronze(log.stream(spark, PAYMENTS.topic), f"{root}/bronze", f"{root}/_checkpoints/bronze")
    store = SilverStore(spark, f"{root}/silver")
    run_silver(change_log.bronze_stream(spark, f"{root}/bronze"), store, f"{root}/_checkpoints/silver")
    return store.current()


# -- gold ----------------------------------------------------------------
@query
def gold_daily_merchant_revenue(spark, sf_dir):
    return gold.daily_merchant_revenue(a.payments(spark, sf_dir))


@query
def gold_payment_method_mix(spark, sf_dir):
    return gold.payment_method_mix(a.payments(spark, sf_dir))


@query
def gold_from_change_events(spark, sf_dir):
    """Change messages to gold in one plan."""
    return gold.daily_merchant_revenue(collapse.current_rows(decoded(spark, sf_dir), PAYMENTS))


@query
def gold_refreshed(spark, sf_dir):
    """Gold built when the mornings were published, then only of the days that the afternoons change."""
    morning, afternoon = halves(change_log.to_bronze(a.messages(spark, sf_dir)))
    root = scratch_dir(spark, "lake")
    lake, published = Lakehouse(root), f"{root}/published"
    store = SilverStore(spark, f"{root}/changes").create()
    apply_batch(store, morning, "q", 0)
    store.publish_changes(published)
    gold.rebuild_gold(store.live(published), lake, grain="month")
    apply_batch(store, afternoon, "q", 1)
    gold.refresh_gold(store, published, lake, store.publish_changes(published), grain="month")
    return lake.read(spark, "gold", "daily_merchant_revenue").drop(gold.GOLD_PERIOD)


# -- staging -------------------------------------------------------------
@query
def stg_payments(spark, sf_dir):
    return staging.stg_payments(a.raw_payments(spark, sf_dir))


@query
def stg_fx_rates(spark, sf_dir):
    return staging.stg_fx_rates(a.raw_rates(spark, sf_dir))


@query
def stg_merchants(spark, sf_dir):
    return staging.stg_merchants(a.raw_merchants(spark, sf_dir))


@query
def stg_merchants_from_seed(spark, sf_dir):
    """The merchants' extract as CSV files with a header, read as a seed."""
    path = f"{scratch_dir(spark, 'seed')}/merchants"
    a.raw_merchants(spark, sf_dir).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return staging.stg_merchants(fx_files.read_seed(spark, path, RAW_MERCHANTS))


@query
def dim_merchants(spark, sf_dir):
    return staging.dim_merchants(staging.stg_merchants(a.raw_merchants(spark, sf_dir)))


# -- rates ---------------------------------------------------------------
@query
def fx_parse_documents(spark, sf_dir):
    parsed = rates.parse_rate_documents(a.rate_documents(spark, sf_dir)).drop("rate_text")
    return rates.rates_in_range(parsed, *feed_range(parsed), FEED_CURRENCIES)


@query
def fx_landing_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "landing")
    fx_files.land_rates(a.rates(spark, sf_dir), f"{root}/landed")
    for _ in range(2):  # the second load finds nothing new
        fx_files.load_landed_rates(spark, f"{root}/landed", f"{root}/raw", f"{root}/_checkpoint")
    return fx_files.read_raw_rates(spark, f"{root}/raw").drop("source_file")


@query
def fx_restatement(spark, sf_dir):
    feed = a.rates(spark, sf_dir)
    first, later = F.lit("2001-12-31 00:00:00").cast("timestamp"), F.lit("2002-01-31 00:00:00").cast("timestamp")
    day = F.col("rate_date")
    current = feed.where(day < F.lit(dt.date(2000, 1, 1)))
    reloaded = feed.where(day >= F.lit(dt.date(1999, 1, 1)))
    corrected = reloaded.where(F.col("currency") == "EUR").withColumn("rate", _raised("0.01"))
    same_load = reloaded.where(F.col("currency") == "GBP").withColumn("rate", _raised("0.02"))
    raw = (
        reloaded.withColumn("loaded_at", first).withColumn("source_file", F.lit("a.json"))
        .unionByName(corrected.withColumn("loaded_at", later).withColumn("source_file", F.lit("a.json")))
        .unionByName(same_load.withColumn("loaded_at", first).withColumn("source_file", F.lit("b.json")))
    )
    return rates.merge_rates(current, raw)


def _raised(by: str):
    return (F.col("rate") + F.lit(by).cast("decimal(18,8)")).cast("decimal(18,8)")


@query
def fx_currencies(spark, sf_dir):
    return asof.rate_currencies(a.rates(spark, sf_dir))


@query
def fx_asof_rate(spark, sf_dir):
    looked_up = asof.asof_rate(a.payments(spark, sf_dir), a.rates(spark, sf_dir))
    return looked_up.select("payment_id", "currency", "payment_date", "rate", "published_on")


@query
def fx_asof_rate_salted(spark, sf_dir):
    """The same lookup by the way taken when the rates are too many to broadcast."""
    looked_up = asof.asof_rate(a.payments(spark, sf_dir), a.rates(spark, sf_dir), broadcast_rows=0)
    return looked_up.select("payment_id", "currency", "payment_date", "rate", "published_on")


@query
def fx_asof_rate_carried(spark, sf_dir):
    """The same lookup by sorting payments and rates together, months of many payments cut."""
    looked_up = asof.asof_carried(a.payments(spark, sf_dir), a.rates(spark, sf_dir), block_rows=50)
    return looked_up.select("payment_id", "currency", "payment_date", "rate", "published_on")


@query
def fx_to_base(spark, sf_dir):
    looked_up = asof.asof_rate(a.payments(spark, sf_dir), a.rates(spark, sf_dir))
    return looked_up.select(
        "payment_id", "currency", "amount", to_base_half_even(F.col("amount"), F.col("rate")).alias("amount_base")
    )


@query
def fx_rates_daily(spark, sf_dir):
    return rates.rates_daily(a.payments(spark, sf_dir), a.rates(spark, sf_dir))


@query
def fx_missing_dates(spark, sf_dir):
    traded, feed = a.payments(spark, sf_dir).select("currency").distinct(), a.rates(spark, sf_dir)
    return rates.missing_rate_dates(feed, *feed_range(feed), traded)


@query
def fx_gap_runs(spark, sf_dir):
    traded, feed = a.payments(spark, sf_dir).select("currency").distinct(), a.rates(spark, sf_dir)
    return rates.gap_runs(rates.missing_rate_dates(feed, *feed_range(feed), traded))


# -- facts ---------------------------------------------------------------
@query
def fct_payments_usd(spark, sf_dir):
    return facts.fct_payments_usd(a.payments(spark, sf_dir), a.rates(spark, sf_dir))


@query
def fct_payments_usd_incremental(spark, sf_dir):
    """A fact loaded to the end of 2000, then brought up to date under a feed corrected since."""
    payments, feed = a.payments(spark, sf_dir), a.rates(spark, sf_dir)
    loaded = facts.fct_payments_usd(payments.where(F.col("payment_date") <= F.lit(dt.date(2000, 12, 31))), feed)
    corrected = feed.withColumn("rate", F.when(F.year("rate_date") >= 2000, _raised("0.01")).otherwise(F.col("rate")))
    return facts.incremental_fact(loaded, payments, corrected)


def _refreshed_fact(spark, sf_dir, daily: str | None = None) -> str:
    """The written fact: loaded to the end of 2000 with flaws, refreshed from all payments and rates put right since.

    Flaws, by payment_id: every 97th without a date, every 89th a year early. Since then
    every 79th from December 2000 on has moved to a month earlier, every 83rd is deleted.
    Days are the payments' own; partitions hold a month.
    """
    payments, feed = a.payments(spark, sf_dir), a.rates(spark, sf_dir)
    known = payments.where(F.col("payment_date") <= F.lit(dt.date(2000, 12, 31)))
    every, day = (lambda n: F.col("payment_id") % n == 0), F.col("payment_date")
    first_day = F.when(every(97), None).when(every(89), F.add_months(day, -12)).otherwise(day)
    path = f"{scratch_dir(spark, 'fact')}/fact"
    facts.build_fact(path, known.withColumn("payment_date", first_day), feed, grain="month")
    if daily:
        facts.build_daily_revenue(spark, daily, path, grain="month")
    corrected = feed.withColumn("rate", F.when(F.year("rate_date") >= 2000, _raised("0.01")).otherwise(F.col("rate")))
    moved = F.when(every(79) & (day >= F.lit(dt.date(2000, 12, 1))), F.add_months(day, -1)).otherwise(day)
    touched = facts.refresh_fact(spark, path, payments.where(~every(83)).withColumn("payment_date", moved), corrected, grain="month")
    if daily:
        facts.refresh_daily_revenue(spark, daily, path, touched, grain="month")
    return path


@query
def fct_payments_usd_refreshed(spark, sf_dir):
    """The fact table after its refresh."""
    written = spark.read.parquet(_refreshed_fact(spark, sf_dir))
    return written.select(*facts.fct_payments_usd(a.payments(spark, sf_dir), a.rates(spark, sf_dir)).columns)


@query
def fct_daily_revenue_usd_refreshed(spark, sf_dir):
    """Daily revenue built before the fact's refresh, then only of the days it touched."""
    daily = f"{scratch_dir(spark, 'daily')}/daily"
    _refreshed_fact(spark, sf_dir, daily)
    written = spark.read.parquet(daily).drop(facts.REVENUE_PERIOD)
    return written.withColumn("gross_amount_usd", F.col("gross_amount_usd").cast("decimal(28,2)"))


@query
def shoppers_by_month(spark, sf_dir):
    """Distinct shoppers of a merchant's month, from its days' sets."""
    fact = facts.fct_payments_usd(a.payments(spark, sf_dir), a.rates(spark, sf_dir))
    return facts.shoppers_by_period(facts.daily_shoppers(fact), "month")


@query
def fct_daily_revenue_usd(spark, sf_dir):
    fact = facts.fct_payments_usd(a.payments(spark, sf_dir), a.rates(spark, sf_dir))
    daily = facts.fct_daily_revenue_usd(fact)
    return daily.withColumn("gross_amount_usd", F.col("gross_amount_usd").cast("decimal(28,2)"))


@query
def unconverted_by_currency(spark, sf_dir):
    fact = facts.fct_payments_usd(a.payments(spark, sf_dir), a.rates(spark, sf_dir))
    return facts.unconverted_by_currency(fact)


# -- quality -------------------------------------------------------------
def _written(frame: DataFrame, label: str) -> DataFrame:
    """A model as a run would leave it: computed once, read where it is needed."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _hurt_payments(spark, sf_dir) -> DataFrame:
    """Payments with damage: missing amounts, unknown statuses, some of them twice."""
    status = F.col("payment_status")
    payments = a.payments(spark, sf_dir)
    hurt = payments.withColumn("amount", F.when(status != "cancelled", F.col("amount"))).withColumn(
        "payment_status", F.when(status == "pending", F.lit("held")).otherwise(status)
    )
    return hurt.unionByName(hurt.where(F.col("payment_method") == "google_pay"))


def _damaged(spark, sf_dir) -> dict[str, DataFrame]:
    """All models with damage, so that each check finds something.

    Further damage, by fixed values: amounts of every 101st payment negated; daily
    revenue without a date for merchant 9, a merchant for 7, an amount for 5, and more
    settled than paid for 3; carried rates of GBP gone. Without a value: staged payments'
    key, currency and day of every 499th, 503rd and 509th, the fact's key of every 487th;
    rates of EUR on a 13th, days of GBP on a 14th, codes of CAD on a 15th; every 7th
    merchant's key, and every 5th merchant is there twice.
    """
    payments, feed = a.payments(spark, sf_dir), a.rates(spark, sf_dir)
    hurt = _written(_hurt_payments(spark, sf_dir), "hurt-payments")
    hurt_feed = _written(feed.unionByName(feed.where(F.col("currency") == "CHF")), "hurt-rates")
    fact, usd = facts.fct_payments_usd(hurt, hurt_feed), F.col("amount_usd")
    fact = _written(fact.withColumn("amount_usd", F.when(F.col("payment_id") % 101 == 0, -usd).otherwise(usd)), "hurt-fact")
    daily, merchant = facts.fct_daily_revenue_usd(fact), F.col("merchant_id")
    def without(frame: DataFrame, **holes) -> DataFrame:
        return frame.withColumns({name: F.when(~hole, F.col(name)) for name, hole in holes.items()})

    every, on = (lambda n: F.col("payment_id") % n == 0), (lambda code, n: (F.col("currency") == code) & (F.dayofmonth("rate_date") == n))
    daily = daily.select(
        F.when(merchant != 9, F.col("revenue_date")).alias("revenue_date"),
        F.when(merchant != 7, merchant).alias("merchant_id"),
        F.when(merchant != 5, F.col("gross_amount_usd")).alias("gross_amount_usd"),
        "payment_count",
        F.when(merchant == 3, F.col("payment_count") + 1).otherwise(F.col("settled_count")).alias("settled_count"),
    )
    grid = rates.rates_daily(payments, feed)
    lost = F.col("is_carried_forward") & (F.col("currency") == "GBP")
    merchants, number = staging.stg_merchants(a.raw_merchants(spark, sf_dir)), F.col("merchant_id")
    merchants = _written(without(merchants.unionByName(merchants.where(number % 5 == 0)), merchant_id=number % 7 == 0), "merchants")
    return {
        "stg_payments": without(hurt, currency=every(503), payment_date=every(509), payment_id=every(499)),
        "stg_fx_rates": without(hurt_feed, rate=on("EUR", 13), rate_date=on("GBP", 14), currency=on("CAD", 15)),
        "stg_merchants": merchants,
        "dim_merchants": staging.dim_merchants(merchants),
        "fx_rates_daily": grid.withColumn("effective_rate", F.when(~lost, F.col("effective_rate"))),
        "fct_payments_usd": without(fact, payment_id=every(487)),
        "fct_daily_revenue_usd": daily,
    }


@query
def dq_violations(spark, sf_dir):
    return quality.check_all(_damaged(spark, sf_dir))


@query
def dq_refreshed_checks(spark, sf_dir):
    """Kept checks of a fact whose partitions from 2000 on were rewritten: the damage before stays, that from then on goes.

    The rewritten months get every 50th payment of the December before once more.
    """
    root, feed, since = scratch_dir(spark, "checks"), a.rates(spark, sf_dir), F.lit(dt.date(2000, 1, 1))
    month = F.trunc("payment_date", "month")
    hurt = facts.fct_payments_usd(_hurt_payments(spark, sf_dir), feed).withColumn(facts.FACT_PERIOD, month)
    replace_table(hurt.where(F.col("payment_date") < F.lit(dt.date(2000, 6, 1))), f"{root}/fact", facts.FACT_PERIOD)
    kept = quality.KeptChecks(spark, f"{root}/kept", "fct_payments_usd", f"{root}/fact", facts.FACT_PERIOD)
    kept.build()
    clean = facts.fct_payments_usd(a.payments(spark, sf_dir), feed).withColumn(facts.FACT_PERIOD, month)
    twice = clean.where((F.col("payment_id") % 50 == 0) & (F.col(facts.FACT_PERIOD) == F.lit(dt.date(1999, 12, 1))))
    later = clean.where(F.col("payment_date") >= since).unionByName(twice.withColumn(facts.FACT_PERIOD, since))
    replace_partitions(later, f"{root}/fact", facts.FACT_PERIOD)
    kept.refresh({day for day in days_of(f"{root}/fact", facts.FACT_PERIOD) if day >= dt.date(2000, 1, 1)})
    return kept.violations()


@query
def dq_duplicate_payments(spark, sf_dir):
    return quality.not_unique(_hurt_payments(spark, sf_dir), "payment_id")


@query
def health_metrics(spark, sf_dir):
    payments, feed = a.payments(spark, sf_dir), a.rates(spark, sf_dir)
    gaps = rates.gap_runs(rates.missing_rate_dates(feed, *feed_range(feed), feed.select("currency")))
    reconciled = decode.reconciliation(decoded(spark, sf_dir), "topic")
    return quality.health_metrics(reconciled, facts.fct_payments_usd(payments, feed), gaps)


# -- reports -------------------------------------------------------------
@query
def report_merchant_revenue(spark, sf_dir):
    revenue = gold.daily_merchant_revenue(a.payments(spark, sf_dir))
    return reports.merchant_revenue(revenue, REPORT_MERCHANT, REPORT_START, REPORT_END).days


@query
def report_revenue_pages(spark, sf_dir):
    """The same report in pages of 40 rows, each asked for by where the one before it ended."""
    revenue = _written(gold.daily_merchant_revenue(a.payments(spark, sf_dir)), "revenue")
    pages, after = [], None
    while not pages or after:
        page = reports.merchant_revenue(revenue, REPORT_MERCHANT, REPORT_START, REPORT_END, limit=40, after=after)
        pages.append(page.days)
        after = page.next_after
    return functools.reduce(DataFrame.unionByName, pages)


@query
def report_revenue_totals(spark, sf_dir):
    revenue = gold.daily_merchant_revenue(a.payments(spark, sf_dir))
    return reports.merchant_revenue(revenue, REPORT_MERCHANT, REPORT_START, REPORT_END).totals


@query
def report_method_mix(spark, sf_dir):
    return reports.payment_method_mix_for(gold.payment_method_mix(a.payments(spark, sf_dir)), MIX_DAY)


@query
def report_known_merchants(spark, sf_dir):
    revenue = gold.daily_merchant_revenue(a.payments(spark, sf_dir))
    return reports.known_merchants(revenue, staging.stg_merchants(a.raw_merchants(spark, sf_dir)))
