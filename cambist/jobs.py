"""The runs that make up the platform, each safe to repeat.

    python -m cambist.jobs bronze --root s3a://bucket/lake --brokers kafka:9092
    python -m cambist.jobs silver --root ...
    python -m cambist.jobs compact | publish | rebuild | dimensions | gold --root ...
    python -m cambist.jobs replay --root ... --partition 3 --offsets 1000 2000
    python -m cambist.jobs land-rates | load-rates | facts | checks --root ...
"""

from __future__ import annotations

import argparse
import datetime as dt
import functools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.collapse import state_rows
from .operators.decode import decoded_changes
from .operators.offsets import coverage
from .operators.rates import gap_runs, missing_rate_dates, newest_rates, parse_rate_documents, rates_daily
from .plans import facts, gold, quality, staging
from .schemas import BRONZE, CAPTURED_TABLES, PAYMENTS, RAW_MERCHANTS, REPORTING_CURRENCY, CapturedTable
from .session import build_session
from .sources import fx_files
from .sources.change_log import BATCH_OFFSETS, FileLogSource, KafkaSource, bronze_stream
from .sources.layers import Lakehouse, replace_table
from .sources.silver_store import DAY, SilverStore
from .streaming.bronze import run_bronze
from .streaming.silver import run_silver


def bronze_name(table: CapturedTable) -> str:
    return f"{table.name}_cdc_raw"


def silver_store(spark: SparkSession, lake: Lakehouse, table: CapturedTable = PAYMENTS) -> SilverStore:
    return SilverStore(spark, lake.path("silver", f"{table.name}_changes"), table)


def ingest(spark: SparkSession, lake: Lakehouse, source: KafkaSource | FileLogSource, table: CapturedTable = PAYMENTS):
    name = bronze_name(table)
    run_bronze(source.stream(spark, table.topic), lake.path("bronze", name), lake.checkpoint(name))


def apply_changes(spark: SparkSession, lake: Lakehouse, table: CapturedTable = PAYMENTS, on_batch=None, files: int = 1_000):
    """``files``: bronze files in one batch."""
    bronze = bronze_stream(spark, lake.path("bronze", bronze_name(table)), files)
    run_silver(bronze, silver_store(spark, lake, table), lake.checkpoint(f"silver_{table.name}"), on_batch)


def publish(spark: SparkSession, lake: Lakehouse, table: CapturedTable = PAYMENTS):
    """The whole state as a table by creation day; marts read it."""
    silver_store(spark, lake, table).publish(lake.path("silver", table.name))


def publish_changes(spark: SparkSession, lake: Lakehouse, table: CapturedTable = PAYMENTS) -> set | None:
    """The published table brought up to date; the days that have changed, None for all."""
    return silver_store(spark, lake, table).publish_changes(lake.path("silver", table.name))


def rebuild(spark: SparkSession, lake: Lakehouse, table: CapturedTable = PAYMENTS):
    """The published table again from all of bronze, as after a change of the decoder; the change log is not read."""
    decoded = decoded_changes(lake.read(spark, "bronze", bronze_name(table), BRONZE), table)
    store = silver_store(spark, lake, table)
    replace_table(store.by_day(state_rows(decoded, table)), lake.path("silver", table.name), DAY)


def replay(spark: SparkSession, lake: Lakehouse, where, table: CapturedTable = PAYMENTS) -> set:
    """Part of bronze decoded again, ``where`` naming offsets or times; only its keys' rows change."""
    bronze = lake.read(spark, "bronze", bronze_name(table), BRONZE)
    return silver_store(spark, lake, table).replay(bronze, where, lake.path("silver", table.name))


def replayed_range(args):
    """The condition for the messages of a partition's offsets, or delivered in a range of time."""
    parts = []
    if args.offsets:
        parts += [F.col("partition") == args.partition, F.col("offset").between(*args.offsets)]
    if args.times:
        parts += [F.col("kafka_timestamp").between(*[F.lit(t) for t in args.times])]
    if not parts:
        raise ValueError("replay needs --offsets with --partition, or --times")
    return functools.reduce(lambda a, b: a & b, parts)


def published(spark: SparkSession, lake: Lakehouse, table: CapturedTable = PAYMENTS) -> DataFrame:
    """Current rows by creation day, as last published."""
    return silver_store(spark, lake, table).live(lake.path("silver", table.name))


def rebuild_marts(spark: SparkSession, lake: Lakehouse):
    gold.rebuild_gold(published(spark, lake), lake)


def refresh_marts(spark: SparkSession, lake: Lakehouse, days: set | None):
    """Gold after a publication that has rewritten these days; None: all of them."""
    if days is None:
        return rebuild_marts(spark, lake)
    if days:
        gold.refresh_gold(silver_store(spark, lake), lake.path("silver", PAYMENTS.name), lake, days)


def build_dimensions(spark: SparkSession, lake: Lakehouse, seed: str):
    merchants = staging.stg_merchants(fx_files.read_seed(spark, seed, RAW_MERCHANTS))
    replace_table(staging.dim_merchants(merchants), lake.path("marts", "dim_merchants"))


def land_rates(
    spark: SparkSession,
    lake: Lakehouse,
    documents: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    currencies: list[str] | None = None,
):
    """Rates of the documents, of the days and currencies asked for; of all where nothing is."""
    found = parse_rate_documents(fx_files.read_rate_documents(spark, documents))
    for wanted in (
        F.col("rate_date") >= F.lit(start) if start else None,
        F.col("rate_date") <= F.lit(end) if end else None,
        F.col("currency").isin([c.upper() for c in currencies]) if currencies else None,
    ):
        found = found if wanted is None else found.where(wanted)
    fx_files.land_rates(found, lake.path("raw", "fx_landing"))


def load_rates(spark: SparkSession, lake: Lakehouse):
    fx_files.load_landed_rates(
        spark, lake.path("raw", "fx_landing"), lake.path("raw", "fx_rates"), lake.checkpoint("fx_rates")
    )


def staged_rates(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """The rates in force: the newest load of each."""
    return staging.stg_fx_rates(newest_rates(fx_files.read_raw_rates(spark, lake.path("raw", "fx_rates"))))


def build_warehouse(spark: SparkSession, lake: Lakehouse, payments: DataFrame, refresh: bool = False, changed_days=()):
    """The USD fact from staged payments and daily revenue from it, whole, or only of the days that change.

    ``changed_days``: days of payments rewritten since, besides the trailing window.
    """
    path, daily, rates = lake.path("marts", "fct_payments_usd"), lake.path("marts", "fct_daily_revenue_usd"), staged_rates(spark, lake)
    if refresh:
        touched = facts.refresh_fact(spark, path, payments, rates, changed_days=changed_days)
        facts.refresh_daily_revenue(spark, daily, path, touched)
        for kept in kept_checks(spark, lake):
            kept.refresh(touched)
    else:
        facts.build_fact(path, payments, rates)
        facts.build_daily_revenue(spark, daily, path)
        for kept in kept_checks(spark, lake):
            kept.build()


def kept_checks(spark: SparkSession, lake: Lakehouse) -> list[quality.KeptChecks]:
    """Of the written marts that are refreshed by partition."""
    periods = {"fct_payments_usd": facts.FACT_PERIOD, "fct_daily_revenue_usd": facts.REVENUE_PERIOD}
    return [quality.KeptChecks(spark, lake.path("marts", "kept_checks"), m, lake.path("marts", m), p) for m, p in periods.items()]


def rate_gaps(payments: DataFrame, feed: DataFrame) -> DataFrame:
    """Runs of days without a rate of a currency paid in or fed, from the first fed day to the last fed or paid, today at most."""
    fed = feed.agg(F.min("rate_date").alias("first"), F.max("rate_date").alias("last")).first()
    paid = payments.agg(F.min("payment_date").alias("first"), F.least(F.max("payment_date"), F.current_date()).alias("last")).first()
    start = fed["first"] or paid["first"] or dt.date(1970, 1, 1)
    end = max([d for d in (fed["last"], paid["last"]) if d], default=start)
    currencies = payments.select("currency").unionByName(feed.select("currency")).where(F.upper("currency") != REPORTING_CURRENCY)
    return gap_runs(missing_rate_dates(feed, start, max(start, end), currencies))


def check(spark: SparkSession, lake: Lakehouse, seed: str | None = None) -> DataFrame:
    """Violations of every model, and what to watch: written models are read from where they were written.

    The staged models and the daily grid of rates are not written and come from what
    they are built from; ``seed`` is the merchants' extract. A model that is not there
    to be checked is a row of its own, not healthy.
    """
    payments, feed = staging.stg_payments(published(spark, lake)), staged_rates(spark, lake)
    fact = spark.read.parquet(lake.path("marts", "fct_payments_usd"))
    store = silver_store(spark, lake)
    models = {
        "stg_payments": payments,
        "stg_fx_rates": feed,
        "fx_rates_daily": rates_daily(payments, feed),
    }
    if seed:
        models["stg_merchants"] = staging.stg_merchants(fx_files.read_seed(spark, seed, RAW_MERCHANTS))
    try:
        models["dim_merchants"] = lake.read(spark, "marts", "dim_merchants")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    absent = [(f"{m}.not_checked", 1, False) for m in ("stg_merchants", "dim_merchants") if m not in models]
    rows = spark.createDataFrame(absent, "metric string, value long, healthy boolean")
    health = quality.health_metrics(store.metrics(), fact, rate_gaps(payments, feed))
    summaries = quality.check_all(models)
    for kept in kept_checks(spark, lake):  # of the marts, as their last build or refresh left them
        summaries = summaries.unionByName(kept.violations())
    found = summaries.select(
        F.concat_ws(".", "model", "check_name").alias("metric"), F.col("violations").alias("value"), (F.col("violations") == 0).alias("healthy")
    )
    unconverted = facts.unconverted_by_currency(fact).select(
        F.concat(F.lit("unconverted."), "currency").alias("metric"), F.col("payment_count").alias("value"), F.lit(False).alias("healthy")
    )
    gaps = coverage(store.offsets()).select(
        F.concat_ws(".", F.lit("missing_offsets"), "topic", F.col("partition").cast("string")).alias("metric"),
        F.col("missing_offsets").alias("value"), (F.col("missing_offsets") == 0).alias("healthy"),
    )
    for part in (unconverted, gaps, health, rows):
        found = found.unionByName(part)
    return found


def write_checks(spark: SparkSession, lake: Lakehouse, seed: str | None = None) -> None:
    replace_table(check(spark, lake, seed), lake.path("marts", "checks"))


JOBS = ("bronze", "silver", "compact", "publish", "rebuild", "replay", "dimensions", "gold", "land-rates", "load-rates", "facts", "checks")


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="cambist.jobs")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of all tables; a full URI unless it is on this machine")
    parser.add_argument("--table", choices=sorted(CAPTURED_TABLES), default="payments")
    parser.add_argument("--shuffle-partitions", type=int, help="total shuffle bytes / 128 MB; Spark's own otherwise")
    parser.add_argument("--brokers", help="message log to read (bronze)")
    parser.add_argument("--batch-offsets", type=int, default=BATCH_OFFSETS, help="offsets of a batch (bronze)")
    parser.add_argument("--log-files", help="folder of log records to read instead (bronze)")
    parser.add_argument("--batch-files", type=int, default=1_000, help="files of a batch (bronze from files, silver)")
    parser.add_argument("--partition", type=int, default=0, help="of the log (replay)")
    parser.add_argument("--offsets", type=int, nargs=2, metavar=("FIRST", "LAST"), help="messages to decode again (replay)")
    parser.add_argument("--times", type=dt.datetime.fromisoformat, nargs=2, metavar=("FROM", "TO"), help="messages to decode again (replay)")
    parser.add_argument("--documents", help="folder of rate documents (land-rates)")
    parser.add_argument("--start", type=dt.date.fromisoformat, help="first day (land-rates)")
    parser.add_argument("--end", type=dt.date.fromisoformat, help="last day (land-rates)")
    parser.add_argument("--currencies", nargs="*", help="only these (land-rates)")
    parser.add_argument("--seed", help="CSV extract of merchants (dimensions, checks)")
    parser.add_argument("--refresh", action="store_true", help="only what changes: the trailing window (facts), the days just published (silver: gold too)")
    args = parser.parse_args(argv)
    spark = build_session(f"cambist-{args.job}", shuffle_partitions=args.shuffle_partitions)
    lake, table = Lakehouse(args.root), CAPTURED_TABLES[args.table]
    if args.job == "bronze":
        from_files = FileLogSource(args.log_files, args.batch_files)
        ingest(spark, lake, KafkaSource(args.brokers, batch_offsets=args.batch_offsets) if args.brokers else from_files, table)
    elif args.job == "silver":
        apply_changes(spark, lake, table, print, args.batch_files)
        days = publish_changes(spark, lake, table)
        if args.refresh and table is PAYMENTS:
            refresh_marts(spark, lake, days)
    elif args.job == "compact":
        silver_store(spark, lake, table).compact()
    elif args.job in ("publish", "rebuild"):
        {"publish": publish, "rebuild": rebuild}[args.job](spark, lake, table)
    elif args.job == "replay":
        replay(spark, lake, replayed_range(args), table)
    elif args.job == "dimensions":
        build_dimensions(spark, lake, args.seed)
    elif args.job == "gold":
        rebuild_marts(spark, lake)
    elif args.job == "land-rates":
        land_rates(spark, lake, args.documents, args.start, args.end, args.currencies)
    elif args.job == "load-rates":
        load_rates(spark, lake)
    elif args.job == "facts":
        build_warehouse(spark, lake, staging.stg_payments(published(spark, lake)), args.refresh)
    else:
        write_checks(spark, lake, args.seed)


if __name__ == "__main__":
    main()
