"""Typed, lightly cleaned views over landed extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _code(name: str) -> Column:
    return F.upper(F.trim(F.col(name))).alias(name)


def _word(name: str) -> Column:
    return F.lower(F.trim(F.col(name))).alias(name)


def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("payment_id").cast("bigint").alias("payment_id"),
        F.col("merchant_id").cast("bigint").alias("merchant_id"),
        F.col("shopper_id").cast("bigint").alias("shopper_id"),
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        _code("currency"),
        _word("payment_method"),
        _word("payment_status"),
        _code("country_code"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("created_at").cast("date").alias("payment_date"),
    )


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    """Rates as units per base unit; only positive ones are rates."""
    return raw.select(
        F.col("rate_date").cast("date").alias("rate_date"),
        _code("base_currency"),
        _code("currency"),
        F.col("rate").cast("decimal(18,8)").alias("rate"),
    ).where(F.col("rate") > 0)


def stg_merchants(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("merchant_id").cast("bigint").alias("merchant_id"),
        F.trim("merchant_name").alias("merchant_name"),
        _code("country_code"),
        _word("category"),
    )


def dim_merchants(staged: DataFrame) -> DataFrame:
    return staged.select("merchant_id", "merchant_name", "country_code", "category")
