"""Column work: calendar, filters, mapping, cleansing, casts."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from slicehouse.catalog.tables import cents, day_text, table
from slicehouse.functions.calendar import DAYS_AGO, MONTHS_AGO, shift_days, with_batch_calendar
from slicehouse.functions.columns import (
    align_to,
    complex_to_string,
    empty_to_null,
    filter_with,
    guard_column,
    incremental,
    land,
    map_columns,
    stamp,
)
from slicehouse.plans.statements import param_sql, run_step


def batch_calendar(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "orders").select("o_orderdate").distinct()
    return with_batch_calendar(days, "o_orderdate").drop("o_orderdate")


def batch_times(spark: SparkSession, folder: str) -> DataFrame:
    now = datetime.datetime(2024, 3, 1, 6, 30, 15)
    events = table(spark, folder, "events").select("event_id", "ts")
    only = ["pt_min", "pt_hour", "date_90min_later", "pt_sys", "datetime_sys", "pt_sys_1_day_ago", "data_date_sys_mon01"]
    return with_batch_calendar(events, "ts", only, with_time=True, now=now).drop("ts")


def days_ago(spark: SparkSession, folder: str) -> DataFrame:
    """A batch id per order, moved back to the begin of a look-back window."""
    batch = F.date_format("o_orderdate", "yyyyMMddHHmm")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        shift_days(batch, "yyyyMMddHHmm", 0, "yyyy-MM-dd HH:mm:00").alias("data_date"),
        shift_days(batch, "yyyyMMddHHmm", 1, "yyyyMMdd").alias("pt_1_day_ago"),
        shift_days(batch, "yyyyMMddHHmm", 90, "yyyy-MM-dd").alias("data_date_90_day_ago"),
    )


def _order_columns(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", day_text("o_orderdate").alias("o_orderdate"))


def incremental_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _order_columns(incremental(table(spark, folder, "orders"), "o_orderdate", "1998-10-03"))


def condition_filter(spark: SparkSession, folder: str) -> DataFrame:
    condition = "o_orderdate >= to_timestamp_ntz(:pt, 'yyyyMMdd') AND o_orderstatus IN ('O', 'P')"
    return _order_columns(filter_with(table(spark, folder, "orders"), condition, {"pt": "20000101"}))


def schema_contract(spark: SparkSession, folder: str) -> DataFrame:
    target = ["o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey", "o_orderpriority"]
    landed = align_to(land(table(spark, folder, "orders")), target)
    return landed.withColumn("o_totalprice", cents("o_totalprice"))


def column_mapping(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {
        "customer_id": "c_custkey",
        "segment": "lower(c_mktsegment)",
        "data_date": "date_format(to_date('2019-10-28 00:00', 'yyyy-MM-dd HH:mm'), 'yyyy-MM-dd')",
    }
    return map_columns(table(spark, folder, "customer"), mapping, ["customer_id", "c_name", "segment", "data_date"])


def null_cleansing(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", F.lit(""))
        .when(F.col("event_type") == "click", F.col("props"))
        .otherwise(F.col("event_id").cast("string"))
        .alias("as_number"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")).alias("as_text"),
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.col("event_type")).alias("as_code"),
    )
    target = StructType(
        [
            StructField("as_number", IntegerType()),
            StructField("as_text", StringType()),
            StructField("as_code", StringType()),
        ]
    )
    return empty_to_null(events, target, also=["as_code"])


def stamp_date(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    target = guard_column(["c_custkey", "load_date", "data_date"], [*customers.columns, "data_date"], "load_date")
    return align_to(stamp(customers, "2024-01-31"), target)


def nested_as_text(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", F.transform("embedding", lambda value: F.round(value.cast("double") * 10000).cast("int")).alias("vector")
    )
    both = vectors.withColumn("vector_json", F.col("vector"))
    return complex_to_string(complex_to_string(both, ["vector"]), ["vector_json"], lossless=True)


def typed_parameters(spark: SparkSession, folder: str) -> DataFrame:
    statement = """SELECT o_orderpriority, count(*) AS num, min(o_orderkey) AS first_key FROM {orders}
        WHERE o_orderdate >= :low AND o_orderdate < :high GROUP BY o_orderpriority"""
    values = {"low": datetime.date(1997, 1, 1), "high": datetime.date(1999, 1, 1)}
    return param_sql(spark, statement, values, orders=table(spark, folder, "orders"))


def batch_step(spark: SparkSession, folder: str) -> DataFrame:
    statement = """SELECT '${pt}' AS pt, '#{pt}_daily' AS label, event_type, count(*) AS num FROM {events}
        WHERE ts >= '${data_date_1_day_ago}' AND ts < '$data_date' GROUP BY event_type"""
    values = {"pt": "20240111", "data_date": "2024-01-11", "data_date_1_day_ago": "2024-01-10"}
    return run_step(spark, statement, values, events=table(spark, folder, "events"))


def order_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts pass a landing unchanged."""
    return land(table(spark, folder, "orders")).select("o_orderkey", cents("o_totalprice").alias("cents"))


QUERIES = {
    "batch_calendar": batch_calendar,
    "batch_times": batch_times,
    "days_ago": days_ago,
    "incremental_filter": incremental_filter,
    "condition_filter": condition_filter,
    "schema_contract": schema_contract,
    "landed_amounts": order_amounts,
    "column_mapping": column_mapping,
    "empty_to_null": null_cleansing,
    "stamp_date": stamp_date,
    "complex_to_string": nested_as_text,
    "param_sql": typed_parameters,
    "batch_step": batch_step,
}

_D, _M = "o_orderdate", "date_trunc('month', o_orderdate)"
_CALENDAR = {
    "pt_min": f"strftime({_D}, '%Y%m%d%H%M')",
    "pt_hour": f"strftime({_D}, '%Y%m%d%H')",
    "pt": f"strftime({_D}, '%Y%m%d')",
    "pt_month": f"strftime({_D}, '%Y%m')",
    "pt_mon01": f"strftime({_D}, '%Y%m') || '01'",
    "data_date": f"strftime({_D}, '%Y-%m-%d')",
    "data_date_mon01": f"strftime({_D}, '%Y-%m') || '-01'",
    "data_date_year0101": f"strftime({_D}, '%Y') || '-01-01'",
    **{f"pt_{n}_day_ago": f"strftime({_D} - INTERVAL {n} DAY, '%Y%m%d')" for n in DAYS_AGO},
    **{f"data_date_{n}_day_ago": f"strftime({_D} - INTERVAL {n} DAY, '%Y-%m-%d')" for n in DAYS_AGO},
    "pt_mon31": f"strftime({_M} + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y%m%d')",
    "data_date_mon31": f"strftime({_M} + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y-%m-%d')",
    "pt_lastmon31": f"strftime({_M} - INTERVAL 1 DAY, '%Y%m%d')",
    "data_date_lastmon31": f"strftime({_M} - INTERVAL 1 DAY, '%Y-%m-%d')",
    "pt_lastmon01": f"strftime({_M} - INTERVAL 1 MONTH, '%Y%m%d')",
    "data_date_lastmon01": f"strftime({_M} - INTERVAL 1 MONTH, '%Y-%m-%d')",
    "pt_lastmonth": f"strftime({_M} - INTERVAL 1 MONTH, '%Y%m')",
    "data_date_lastmonth": f"strftime({_M} - INTERVAL 1 MONTH, '%Y-%m')",
    **{f"data_date01_{n}month_ago": f"strftime({_M} - INTERVAL {n} MONTH, '%Y-%m-%d')" for n in MONTHS_AGO},
}
_ORDER = "o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate"

ORACLES = {
    "batch_calendar": "SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in _CALENDAR.items())
    + " FROM (SELECT DISTINCT o_orderdate FROM orders)",
    "batch_times": """SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS pt_min, strftime(ts, '%Y%m%d%H') AS pt_hour,
  strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS date_90min_later, '20240301' AS pt_sys,
  '2024-03-01 06:30:15' AS datetime_sys, '20240229' AS pt_sys_1_day_ago, '2024-03-01' AS data_date_sys_mon01 FROM events""",
    "days_ago": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') || ':00' AS data_date,
  strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS pt_1_day_ago,
  strftime(o_orderdate - INTERVAL 90 DAY, '%Y-%m-%d') AS data_date_90_day_ago FROM orders""",
    "incremental_filter": f"""SELECT {_ORDER} FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-10-03' AND o_orderdate < TIMESTAMP '1998-10-04'""",
    "condition_filter": f"SELECT {_ORDER} FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus IN ('O', 'P')",
    "schema_contract": """SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderkey,
  CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice, o_orderstatus, o_custkey, o_orderpriority FROM orders""",
    "landed_amounts": "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders",
    "column_mapping": """SELECT c_custkey AS customer_id, c_name, lower(c_mktsegment) AS segment, '2019-10-28' AS data_date
FROM customer""",
    "empty_to_null": """SELECT event_id, TRY_CAST(CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN props ELSE event_id::VARCHAR END AS INTEGER) AS as_number,
  CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS as_text, nullif(event_type, 'click') AS as_code FROM events""",
    "stamp_date": "SELECT c_custkey, '2024-01-31' AS data_date FROM customer",
    "complex_to_string": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 10000) AS INTEGER)) AS w
  FROM embeddings)
SELECT vec_id, '[' || array_to_string(w, ', ') || ']' AS vector, '[' || array_to_string(w, ',') || ']' AS vector_json FROM v""",
    "param_sql": """SELECT o_orderpriority, count(*) AS num, min(o_orderkey) AS first_key FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_orderpriority""",
    "batch_step": """SELECT '20240111' AS pt, '20240111_daily' AS label, event_type, count(*) AS num FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' GROUP BY event_type""",
}
