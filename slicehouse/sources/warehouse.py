"""Warehouse tables: slices, their existence, and the columns a table is made of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slicehouse import text
from slicehouse.functions.columns import filter_with


class MissingSlice(Exception):
    """A slice that later work depends on is not there."""


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def data_schema(spark: SparkSession, table: str) -> StructType:
    """The table's schema without its partition columns, in table order."""
    partitions = set(partition_columns(spark, table))
    return StructType([field for field in spark.table(table).schema if field.name not in partitions])


def read_slice(
    spark: SparkSession,
    table: str,
    where: str | None = None,
    params: Mapping[str, object] | None = None,
    columns: Sequence[str] | None = None,
    at: Mapping[str, object] | None = None,
    **slice_: object,
) -> DataFrame:
    """Rows of the slices given by partition values (``pt="20240101"``) and, or, a condition.

    ``at`` gives partition values as a mapping, also for columns that have the name of a parameter.
    A condition on partition columns selects folders, so that other slices are not listed or opened.
    """
    rows = spark.table(table)
    for key, value in {**(at or {}), **slice_}.items():
        rows = rows.where(F.col(key).isNull() if value is None else F.col(key) == F.lit(value))
    rows = filter_with(rows, where, params)
    return rows.select(*columns) if columns else rows


def existing_slices(spark: SparkSession, table: str) -> DataFrame:
    """The slices the catalog knows, one row each and one string column per partition key. No data file is read.

    An empty slice exists: the load that made it has run.
    """
    keys = partition_columns(spark, table)
    if not keys:
        raise ValueError(f"{table} is not partitioned")
    listed = spark.sql(f"SHOW PARTITIONS {text.name(table)}")
    path = F.split("partition", "/")
    unescape = {key: _unescaped(F.split(path[place], "=", 2)[1]) for place, key in enumerate(keys)}
    return listed.select(
        *[F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(key) for key, value in unescape.items()]
    )


def _unescaped(value):
    # Folder names escape special characters as % and two hex digits; "+" stands for itself in them.
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def has_slice(spark: SparkSession, table: str, **slice_: object) -> bool:
    spec = ", ".join(f"{text.column(key)} = {text.literal(value)}" for key, value in slice_.items())
    return not spark.sql(f"SHOW PARTITIONS {text.name(table)} PARTITION ({spec})").isEmpty()


def require_slice(spark: SparkSession, table: str, **slice_: object) -> None:
    """The gate before dependent work: raise unless the slice exists."""
    if not has_slice(spark, table, **slice_):
        raise MissingSlice(f"{table} has no slice {slice_}")


def missing_slices(required: DataFrame, table: str) -> DataFrame:
    """Those of the required slices that the table lacks; ``required`` has the partition keys as columns."""
    keys = partition_columns(required.sparkSession, table)
    wanted = [key for key in keys if key in required.columns]
    if not wanted:
        raise ValueError(f"required slices have none of the partition columns {keys}")
    present = existing_slices(required.sparkSession, table).select(*wanted).distinct()
    return required.distinct().join(present, wanted, "left_anti")
