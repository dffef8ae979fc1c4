"""Data-quality checks. Rows returned are violations."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PAYMENT_STATUSES, REPORTING_CURRENCY
from ..session import scratch_dir
from ..sources.layers import day_folder, days_of, exists, read_days, remove_folder, replace_partitions, replace_table


def not_unique(frame: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with how often; NULL keys are the not-null check's business."""
    return (
        frame.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
    )


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values=PAYMENT_STATUSES) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def row_checks(model: str, currency: str = REPORTING_CURRENCY) -> dict[str, Column]:
    """The conditions that must hold for no row of a model."""
    missing = {
        "stg_payments": ("payment_id", "amount", "currency", "payment_date"),
        "stg_fx_rates": ("rate", "rate_date", "currency"),
        "stg_merchants": ("merchant_id",),
        "dim_merchants": ("merchant_id",),
        "fct_payments_usd": ("payment_id",),
        "fct_daily_revenue_usd": ("revenue_date", "merchant_id", "gross_amount_usd"),
        "fx_rates_daily": (),
    }[model]
    checks = {f"not_null_{column}": is_missing(column) for column in missing}
    if model == "fct_payments_usd":
        checks["accepted_values_payment_status"] = not_accepted("payment_status")
        checks["no_negative_converted_amounts"] = (F.col("amount") > 0) & (F.col("amount_usd") < 0)
        checks["usd_payments_convert_one_to_one"] = (F.col("currency") == currency) & (
            (F.col("amount_usd") != F.col("amount")) | (F.col("fx_rate") != 1)
        )
    if model == "fct_daily_revenue_usd":
        checks["revenue_never_exceeds_total_payments"] = F.col("settled_count") > F.col("payment_count")
    if model == "fx_rates_daily":
        checks["carried_forward_implies_a_rate_exists"] = (
            F.col("is_carried_forward") & F.col("effective_rate").isNull()
        )
    return checks


UNIQUE_KEYS = {
    "stg_payments": ("payment_id",),
    "stg_fx_rates": ("rate_date", "currency"),
    "stg_merchants": ("merchant_id",),
    "dim_merchants": ("merchant_id",),
    "fct_payments_usd": ("payment_id",),
}


def violating_rows(frame: DataFrame, model: str, check: str) -> DataFrame:
    return frame.where(row_checks(model)[check])


def check_model(frame: DataFrame, model: str) -> DataFrame:
    """(model, check_name, violations) for all checks of a model, in one pass over it.

    Where a key has to be unique, rows are counted by key, with the row conditions
    counted along; the sums over keys are then both. A repeated or a missing key is
    one row per task after the partial aggregate.
    """
    checks = {f"check_{i}": (name, condition) for i, (name, condition) in enumerate(row_checks(model).items())}
    counts = [F.count_if(condition).alias(place) for place, (_, condition) in checks.items()]
    names = {place: name for place, (name, _) in checks.items()}
    if model in UNIQUE_KEYS:
        key = UNIQUE_KEYS[model]
        by_key = frame.groupBy(*key).agg(F.count("*").alias("row_count"), *counts)
        whole = F.lit(True)
        for column in key:
            whole = whole & F.col(column).isNotNull()
        repeated = F.count_if(whole & (F.col("row_count") > 1)).alias("repeated")
        counted = by_key.agg(*[F.coalesce(F.sum(place), F.lit(0)).alias(place) for place in checks], repeated)
        names["repeated"] = "unique_" + "_".join(key)
    else:
        counted = frame.agg(*counts)
    pairs = [F.struct(F.lit(name).alias("check_name"), F.col(place).alias("violations")) for place, name in names.items()]
    return counted.select(F.lit(model).alias("model"), F.inline(F.array(*pairs)))


@dataclass(frozen=True)
class KeptChecks:
    """Checks of a written, partitioned model, kept so that a refresh reads what it changed.

    For each partition the violations of every row condition are kept as counts, which
    add up; for the whole table the keys that stand more than once. After some partitions
    were rewritten, their counts are taken anew. A key can only have become repeated if
    it stands in one of them, or no longer be if it was: for these, the key column alone
    is read of the other partitions.
    """

    spark: SparkSession
    root: str
    model: str
    table_path: str
    period: str

    def _path(self, name: str) -> str:
        return f"{self.root}/{self.model}/{name}"

    def _rows(self, periods: Collection | None) -> DataFrame:
        schema = self.spark.read.parquet(self.table_path).schema
        whole = self.spark.read.schema(schema).parquet(self.table_path)
        return whole if periods is None else read_days(self.spark, self.table_path, self.period, periods, schema)

    def _counts(self, rows: DataFrame) -> DataFrame:
        """Each partition's violations of each condition; one without any rows or violations is there with zeros."""
        checks = row_checks(self.model)
        counted = rows.groupBy(self.period).agg(*[F.count_if(c).alias(f"check_{i}") for i, c in enumerate(checks.values())])
        pairs = [F.struct(F.lit(name).alias("check_name"), F.col(f"check_{i}").alias("violations")) for i, name in enumerate(checks)]
        return counted.select(F.inline(F.array(*pairs)), self.period)

    @property
    def _key(self) -> list[str]:
        return list(UNIQUE_KEYS.get(self.model, ()))

    def build(self) -> None:
        """From the whole table."""
        rows = self._rows(None)
        replace_table(self._counts(rows), self._path("counts"), self.period)
        if self._key:
            replace_table(not_unique(rows, *self._key), self._path("repeated"))

    def refresh(self, periods: Collection) -> None:
        """After these partitions were rewritten, and maybe others emptied among them."""
        if not exists(self._path("counts")):
            return self.build()
        rows = self._rows(periods)
        replace_partitions(self._counts(rows), self._path("counts"), self.period)
        for day in set(periods) - days_of(self.table_path, self.period):
            remove_folder(day_folder(self._path("counts"), self.period, day))
        if self._key:
            before = self.spark.read.parquet(self._path("repeated"))
            suspects = rows.select(*self._key).unionByName(before.select(*self._key)).dropna().distinct()
            keys = self._rows(None).select(*self._key).join(suspects, self._key, "left_semi")
            aside = scratch_dir(self.spark, "repeated")
            not_unique(keys, *self._key).write.parquet(aside)
            replace_table(self.spark.read.schema(before.schema).parquet(aside), self._path("repeated"))

    def violations(self) -> DataFrame:
        """The same rows as ``check_model`` over the whole table, from what is kept."""
        kept = self.spark.read.parquet(self._path("counts"))
        found = kept.groupBy("check_name").agg(F.sum("violations").alias("violations"))
        if self._key:
            repeated = self.spark.read.parquet(self._path("repeated"))
            found = found.unionByName(repeated.agg(F.count("*").alias("violations")).withColumn("check_name", F.lit("unique_" + "_".join(self._key))))
        return found.select(F.lit(self.model).alias("model"), "check_name", "violations")


def check_all(models: Mapping[str, DataFrame]) -> DataFrame:
    summaries = [check_model(frame, model) for model, frame in models.items()]
    combined = summaries[0]
    for more in summaries[1:]:
        combined = combined.unionByName(more)
    return combined


def health_metrics(reconciled: DataFrame, fact: DataFrame, gaps: DataFrame, weekend_days: int = 2) -> DataFrame:
    """(metric, value, healthy): quarantine and unconverted near zero, rates carried over weekends only."""
    quarantined = reconciled.agg(F.coalesce(F.sum("quarantined"), F.lit(0)).alias("value"))
    unreconciled = reconciled.agg(F.count_if(~F.col("reconciles")).alias("value"))
    fact_counts = fact.agg(
        F.count_if("is_unconverted").alias("unconverted"),
        F.count_if("fx_rate_carried_forward").alias("carried_forward"),
    )
    longest = gaps.agg(F.coalesce(F.max("gap_days"), F.lit(0)).alias("value"))
    named = [
        (quarantined, "quarantined", "value", F.col("value") == 0),
        (unreconciled, "batches_not_reconciled", "value", F.col("value") == 0),
        (longest, "longest_rate_gap_days", "value", F.col("value") <= weekend_days),
    ]
    parts = [
        frame.select(F.lit(name).alias("metric"), F.col(column).cast("bigint").alias("value"), ok.alias("healthy"))
        for frame, name, column, ok in named
    ]
    from_fact = fact_counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("unconverted").alias("metric"),
                    F.col("unconverted").alias("value"),
                    (F.col("unconverted") == 0).alias("healthy"),
                ),
                F.struct(
                    F.lit("carried_forward").alias("metric"),
                    F.col("carried_forward").alias("value"),
                    F.lit(True).alias("healthy"),
                ),
            )
        )
    )
    combined = from_fact
    for part in parts:
        combined = combined.unionByName(part)
    return combined
