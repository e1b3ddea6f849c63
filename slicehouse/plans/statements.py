"""SQL statements with the values of a batch filled in, one step at a time."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from slicehouse.sinks.warehouse import overwrite_all

# The notations for the place of a value: ${name}, #{name} and $name.
PLACE = re.compile(r"[$#]\{(\w+)\}|\$([A-Za-z_]\w*)")
# What a batch value may consist of: digits and names, dates and times, but nothing that ends a literal.
BATCH_VALUE = re.compile(r"[\w\-: .]*")


def param_sql(
    spark: SparkSession, statement: str, params: Mapping[str, object] | None = None, **tables: DataFrame
) -> DataFrame:
    """Run one statement with typed ``:name`` values; ``{name}`` stands for a DataFrame.

    A parameter without a value is an error. Commands run at once, queries when their result is used.
    """
    return spark.sql(statement, args=dict(params or {}), **tables)


def fill(statement: str, params: Mapping[str, str]) -> str:
    """A statement with batch values in place of ``${name}``, ``#{name}`` and ``$name``, also inside a literal or a name.

    A missing value is an error, and so is one that could end the literal it stands in.
    """

    def value(found: re.Match) -> str:
        name = found[1] or found[2]
        if name not in params:
            raise ValueError(f"no value for {found[0]}")
        if not BATCH_VALUE.fullmatch(params[name]):
            raise ValueError(f"not a batch value for {found[0]}: {params[name]!r}")
        return params[name]

    return PLACE.sub(value, statement)


def run_step(
    spark: SparkSession, statement: str, params: Mapping[str, str], into: str | None = None, **tables: DataFrame
) -> DataFrame:
    """One step of a batch: fill in its values and run it. The rows of a query are stored in the table ``into`` if given.

    A table that is there keeps its definition and, until the new rows are computed, its rows; the query may read it.
    """
    result = param_sql(spark, fill(statement, params), None, **tables)
    if into is None:
        return result
    if spark.catalog.tableExists(into):
        overwrite_all(result, into)
    else:
        result.write.saveAsTable(into)
    return spark.table(into)
