"""Manifests: lists of tables to load, one row per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("hive_table", "db_prop", "db_table", "where_condition", "diff_cols")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``warehouse table | connection | source table``, without a header; blank lines are skipped.

    A fourth field is a condition. All that follows it is the fifth: a column mapping, which has the separator between its own
    parts. Lines that end earlier have null there, and so have blank fields.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    fields = F.split("value", r"\|", len(COLUMNS))
    return lines.select(*[F.nullif(F.trim(F.get(fields, place)), F.lit("")).alias(name) for place, name in enumerate(COLUMNS)])
