"""Reading the generated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str) -> Column:
    """A money amount as a whole number, which compares exactly."""
    return F.round(F.col(column) * 100).cast("bigint")


def day_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
