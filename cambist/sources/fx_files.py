"""Rate documents in, landed rates out and in again, and the seed extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rates import landing_rows
from ..schemas import LANDED_FX, RAW_FX_RATES


def read_rate_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: a daily document may be spread over lines."""
    return spark.read.text(path, wholetext=True)


def land_rates(rates: DataFrame, path: str) -> None:
    """Newline-delimited JSON, the rate as text. Each call adds files, none is rewritten."""
    landing_rows(rates).write.mode("append").json(path)


def load_landed_rates(spark: SparkSession, landing: str, raw: str, checkpoint: str) -> None:
    """Append newly landed files to the raw table, each once; a bad line stops the load.

    The checkpoint is the record of loaded files, so a second run over the same
    folder loads nothing.
    """
    landed = spark.readStream.schema(LANDED_FX).option("mode", "FAILFAST").json(landing)
    (
        typed_rates(landed)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(raw)
        .awaitTermination()
    )


def typed_rates(landed: DataFrame) -> DataFrame:
    """The raw table's columns. These casts must fail on bad text, whatever the session's ANSI setting."""

    def strict(name: str, target: str):
        value = F.col(name)
        typed = value.try_cast(target)
        message = F.concat(F.lit(f"bad {name} in landed rates: "), value)
        return F.when(value.isNotNull() & typed.isNull(), F.raise_error(message).cast(target)).otherwise(typed)

    return landed.select(
        strict("rate_date", "date").alias("rate_date"),
        "base_currency",
        "currency",
        strict("rate", "decimal(18,8)").alias("rate"),
        F.current_timestamp().alias("loaded_at"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def read_raw_rates(spark: SparkSession, raw: str) -> DataFrame:
    return spark.read.schema(RAW_FX_RATES).parquet(raw)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV extract with a header; all columns are text until staged."""
    return spark.read.schema(schema).option("header", True).csv(path)
