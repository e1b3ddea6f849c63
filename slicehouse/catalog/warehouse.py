"""Writes into warehouse tables, read back."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slicehouse.catalog.tables import cents, day_text, table
from slicehouse.functions.columns import compact_date, land, landing_schema, with_comments
from slicehouse.operators.status import snapshot_batch
from slicehouse.plans.jobs import import_rows, ingest_batch, ingest_manifest, ledger_state, load_specs, with_layout
from slicehouse.plans.specs import ImportSpec
from slicehouse.session import scratch_folder, scratch_name
from slicehouse.sinks.warehouse import (
    append_rows,
    create_table_if_absent,
    land_or_reject,
    overwrite_slice,
    overwrite_slices,
    overwrite_table,
    replace_rows,
)
from slicehouse.sources.manifest import read_manifest
from slicehouse.sources.warehouse import existing_slices, missing_slices, read_slice


def _new_table(spark: SparkSession, stem: str, columns: str, keys: tuple[str, ...], format: str = "parquet") -> str:
    name = scratch_name(spark, stem)
    create_table_if_absent(spark, name, StructType.fromDDL(columns), keys, format)
    return name


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "user_id", "event_type", day_text("ts").alias("op_date"))


def _sliced_events(spark: SparkSession, folder: str, stem: str) -> str:
    """All events in one slice per day."""
    name = _new_table(spark, stem, "event_id bigint, user_id bigint, event_type string", ("pt",))
    overwrite_slices(_events(spark, folder), name, {"pt": compact_date(F.col("op_date"))})
    return name


def partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    name = _sliced_events(spark, folder, "scan")
    return read_slice(spark, name, columns=["event_id", "event_type", "pt"], pt="20240115")


def partition_condition(spark: SparkSession, folder: str) -> DataFrame:
    name = _sliced_events(spark, folder, "scan")
    return read_slice(spark, name, "pt >= :low AND pt < :high", {"low": "20240110", "high": "20240120"})


def static_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """One slice gets other rows, one gets none; the rest stays."""
    name = _sliced_events(spark, folder, "static")
    events = _events(spark, folder)
    overwrite_slice(events.where((F.col("op_date") == "2024-01-02") & (F.col("event_type") == "purchase")), name, pt="20240102")
    overwrite_slice(events.where(F.col("op_date") > "2030"), name, pt="20240103")
    return spark.table(name)


def full_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    name = _new_table(spark, "full", "c_custkey bigint, c_name string, c_mktsegment string", ())
    customers = table(spark, folder, "customer")
    overwrite_table(customers.where(F.col("c_mktsegment") == "BUILDING"), name)
    overwrite_table(customers.where(F.col("c_mktsegment") != "BUILDING"), name)
    return spark.table(name)


def append_slice(spark: SparkSession, folder: str) -> DataFrame:
    name = _new_table(spark, "log", "c_custkey bigint, c_mktsegment string", ("pt",))
    customers = table(spark, folder, "customer")
    for pt in ("20240101", "20240102"):
        append_rows(customers.withColumn("pt", F.lit(pt)), name)
    return spark.table(name)


def dynamic_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct rows in one slice per day, then a reload of the last days with other rows."""
    name = _new_table(spark, "dynamic", "user_id bigint, event_type string", ("pt",))
    events = _events(spark, folder)
    pt = {"pt": compact_date(F.col("op_date"))}
    overwrite_slices(events, name, pt, distinct=True)
    late = events.where((F.col("op_date") >= "2024-01-25") & F.col("event_type").isin("click", "view"))
    overwrite_slices(late, name, pt, distinct=True)
    return spark.table(name)


def _mixed(spark: SparkSession, folder: str, whole_prefix: bool) -> DataFrame:
    name = _new_table(spark, "mixed", "event_id bigint, op_date string", ("pt", "loc"))
    events = _events(spark, folder).withColumn("loc", F.col("event_type"))
    overwrite_slices(events, name, pt="20240130")
    late = events.where(F.col("loc").isin("click", "view") & (F.col("op_date") >= "2024-01-15"))
    overwrite_slices(late, name, pt="20240130", whole_prefix=whole_prefix)
    return spark.table(name)


def mixed_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder, whole_prefix=False)


def mixed_overwrite_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder, whole_prefix=True)


def replace_slice(spark: SparkSession, folder: str) -> DataFrame:
    """One day is deleted and half-filled anew, four are emptied; elsewhere a condition, null for some rows, deletes single rows."""
    name = _new_table(spark, "replace", "event_id bigint, label string", ("data_date",))
    events = _events(spark, folder).withColumn("data_date", F.col("op_date"))
    labelled = events.withColumn("label", F.nullif("event_type", F.lit("view")))
    overwrite_slices(labelled, name)
    new = labelled.where((F.col("data_date") == "2024-01-10") & (F.col("event_type") == "click"))
    condition = "data_date = :day OR data_date BETWEEN '2024-01-03' AND '2024-01-06' OR (data_date >= '2024-01-20' AND label = 'error')"
    replace_rows(new, name, condition, {"day": "2024-01-10"})
    return spark.table(name)


def replace_unpartitioned(spark: SparkSession, folder: str) -> DataFrame:
    name = _new_table(spark, "rows", "c_custkey bigint, c_nationkey int, data_date string", ())
    customers = table(spark, folder, "customer")
    overwrite_table(customers.withColumn("data_date", F.when(F.col("c_acctbal") < 5000, F.lit("2024-01-01"))), name)
    new = customers.where(F.col("c_mktsegment") == "BUILDING").withColumn("data_date", F.lit("2024-01-01"))
    replace_rows(new, name, "data_date = '2024-01-01'")
    return spark.table(name)


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Texts landed as numbers and days: what fits, and beside it the values that do not."""
    name, rejects = _new_table(spark, "typed", "event_id bigint, worth int, day date", ("pt",)), scratch_name(spark, "rejects")
    kind = F.col("event_type")
    worth = F.when(kind == "view", "").when(kind == "click", F.col("props")).otherwise(F.col("event_id").cast("string"))
    day = F.when(F.col("user_id") % 3 != 0, F.date_format("ts", "yyyy-MM-dd")).when(F.col("user_id") % 2 == 0, F.date_format("ts", "dd.MM.yyyy"))
    rows = table(spark, folder, "events").select("event_id", worth.alias("given"), day.alias("day"))
    for _ in range(2):
        land_or_reject(rows, name, rejects, {"worth": "given"}, pt="20240131")
    landed = spark.table(name).select("event_id", F.lit("landed").alias("went"), F.concat_ws("/", F.col("worth").cast("string"), F.col("day").cast("string")).alias("value"))
    lost = spark.table(rejects).select(F.get_json_object("source", "$.event_id").cast("bigint").alias("event_id"), F.explode("errors").alias("e"))
    return landed.union(lost.select("event_id", F.concat(F.lit("rejected "), F.col("e.column")), "e.value"))


def grown_table(spark: SparkSession, folder: str) -> DataFrame:
    """A slice from before two columns came to the source, and one from after."""
    customers, name = table(spark, folder, "customer"), scratch_name(spark, "grown")
    import_rows(customers.select("c_custkey", "c_nationkey"), ImportSpec(name, "customer", pt="20240101"))
    wider = customers.select("c_custkey", "c_nationkey", "c_name", F.col("c_mktsegment").alias("segment"))
    import_rows(wider, ImportSpec(name, "customer", pt="20240102", extra="add"))
    return spark.table(name)


def create_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """An ORC table made from the landed schema of the orders, with comments, and filled; shown with a comment read back."""
    orders = table(spark, folder, "orders")
    noted = with_comments(landing_schema(orders.schema), {name: f"it's {name}" for name in orders.columns})
    name = scratch_name(spark, "created")
    for _ in range(2):
        create_table_if_absent(spark, name, noted, ("pt",), "orc", "orders' slices")
    overwrite_slice(land(orders), name, pt="20240101")
    columns = spark.catalog.listColumns(name)
    notes = ", ".join(f"{column.name} {column.dataType} {column.description or 'slice'}" for column in columns)
    return spark.table(name).withColumns({"o_totalprice": cents("o_totalprice"), "notes": F.lit(notes)})


def partition_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Days which the order dates, moved into the years of the events, ask for and which have no event slice."""
    name = _sliced_events(spark, folder, "gate")
    days = table(spark, folder, "orders").select(
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 27 YEAR"), "yyyyMMdd").alias("pt")
    )
    return missing_slices(days, name)


def slice_list(spark: SparkSession, folder: str) -> DataFrame:
    return existing_slices(spark, _sliced_events(spark, folder, "list"))


def manifest_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Four tables of a manifest, in three layouts; one of them does not exist."""
    targets = {
        "customer": _new_table(spark, "customer_his", "c_custkey bigint, c_name string", ("pt",), "orc"),
        "orders": _new_table(spark, "orders_his", "o_custkey bigint, o_orderstatus string", ("pt",), "orc"),
        "lineitem": _new_table(spark, "lineitem_his", "l_orderkey bigint, l_quantity double", ("pt", "l_returnflag"), "orc"),
        "no_such_table": _new_table(spark, "none_his", "id bigint", ("pt",), "orc"),
    }
    layouts = {"orders": "derived", "lineitem": "sub_slices"}
    specs = [
        with_layout(spec, layouts.get(spec.db_table, "slice"), "date_format(o_orderdate, 'yyyy-MM')")
        for spec in load_specs(_written_manifest(spark, [f"{target}|files|{source}" for source, target in targets.items()]))
    ]
    ledger = ingest_manifest(
        spark,
        specs,
        {"files": lambda source: table(spark, folder, source)},
        "daily",
        "2024013106",
        clock=lambda: datetime.datetime(2024, 1, 31, 7),
    )
    return ledger.select("db_table", "status", "num_rows", "batch", "update_time")


def _written_manifest(spark: SparkSession, lines: list[str]) -> DataFrame:
    listed = f"{scratch_folder(spark)}/manifest"
    spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(listed)
    return read_manifest(spark, listed)


def manifest_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of one hour side by side, from a manifest line with a condition and two mappings."""
    name = _new_table(spark, "minutes", "event_id bigint, kind string, worth bigint", ("pt",))
    line = f"{name} | files | events | date_format(ts, 'mm') = substring('#{{pt}}', 11, 2) | kind:upper(event_type) | worth:cast(value * 100 as bigint)"
    specs = load_specs(_written_manifest(spark, [line]))
    for batch in ("202401031000", "202401031005"):
        ingest_manifest(spark, specs, {"files": lambda source: table(spark, folder, source)}, "events", batch)
    return spark.table(name)


def batch_taken_up(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources of one table, one of which is late; the batch is run twice. Landed rows, and the ledger's as rows of their own."""
    name = _new_table(spark, "late", "key bigint, label string", ("pt",))
    listed = [
        f"{name}|files|customer||key:c_custkey|label:c_name",
        f"{name}|files|supplier||key:s_suppkey|label:s_name",
    ]
    days = {"customer": "'2024-01-01'", "supplier": "'2024-01-02'"}
    specs = [with_layout(spec, "derived", days[spec.db_table]) for spec in load_specs(_written_manifest(spark, listed))]
    ledger = scratch_name(spark, "ledger")
    there = {"customer"}

    def source(wanted: str) -> DataFrame:
        if wanted not in there:
            raise FileNotFoundError(wanted)
        return table(spark, folder, wanted)

    for _ in range(2):
        ingest_batch(spark, specs, {"files": source}, "daily", "20240101", ledger)
        there.add("supplier")
    kept = ledger_state(spark.table(ledger)).select("num_rows", F.concat_ws(" ", "db_table", "status"), F.lit("ledger"))
    return spark.table(name).union(kept)


def import_own_pt(spark: SparkSession, folder: str) -> DataFrame:
    """A source with a column pt of its own, landed without slices."""
    name = scratch_name(spark, "own_pt")
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("pt"))
    import_rows(customers, ImportSpec(name, "customer"))
    return spark.table(name)


def batch_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Instances for two batches, added to one table."""
    tasks = table(spark, folder, "part").select(
        F.lit("parts").alias("business_name"), F.col("p_partkey").alias("tid"), F.col("p_name").alias("name")
    )
    first = snapshot_batch(tasks, "2024010106", "2024-01-01 06:00:00")
    name = scratch_name(spark, "instances")
    create_table_if_absent(spark, name, StructType([field for field in first.schema]), ())
    append_rows(first, name)
    append_rows(snapshot_batch(tasks, "2024010206", "2024-01-02 06:00:00"), name)
    return spark.table(name)


QUERIES = {
    "partition_scan": partition_scan,
    "partition_condition": partition_condition,
    "static_overwrite": static_overwrite,
    "full_overwrite": full_overwrite,
    "rejected_rows": rejected_rows,
    "grown_table": grown_table,
    "append_slice": append_slice,
    "dynamic_overwrite": dynamic_overwrite,
    "mixed_overwrite": mixed_overwrite,
    "mixed_overwrite_prefix": mixed_overwrite_prefix,
    "replace_slice": replace_slice,
    "replace_unpartitioned": replace_unpartitioned,
    "create_if_absent": create_if_absent,
    "partition_gate": partition_gate,
    "slice_list": slice_list,
    "manifest_ingest": manifest_ingest,
    "manifest_batches": manifest_batches,
    "batch_taken_up": batch_taken_up,
    "import_own_pt": import_own_pt,
    "batch_snapshot": batch_snapshot,
}

_PT = "strftime(ts, '%Y%m%d')"
_DAY = "strftime(ts, '%Y-%m-%d')"
_SNAPSHOT = """SELECT 'parts' AS business_name, '{batch}' AS batch, p_partkey AS tid, p_name AS name, 'init' AS status,
  '{now}' AS create_time, '{now}' AS update_time, CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS finish_time FROM part"""

ORACLES = {
    "partition_scan": f"SELECT event_id, event_type, {_PT} AS pt FROM events WHERE {_PT} = '20240115'",
    "partition_condition": f"""SELECT event_id, user_id, event_type, {_PT} AS pt FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
    "static_overwrite": f"""SELECT event_id, user_id, event_type, {_PT} AS pt FROM events
WHERE {_PT} <> '20240103' AND ({_PT} <> '20240102' OR event_type = 'purchase')""",
    "full_overwrite": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'",
    "append_slice": """SELECT c_custkey, c_mktsegment, '20240101' AS pt FROM customer
UNION ALL SELECT c_custkey, c_mktsegment, '20240102' FROM customer""",
    "dynamic_overwrite": f"""SELECT DISTINCT user_id, event_type, {_PT} AS pt FROM events
WHERE {_DAY} < '2024-01-25' OR event_type IN ('click', 'view')""",
    "mixed_overwrite": f"""SELECT event_id, {_DAY} AS op_date, '20240130' AS pt, event_type AS loc FROM events
WHERE event_type NOT IN ('click', 'view') OR {_DAY} >= '2024-01-15'""",
    "mixed_overwrite_prefix": f"""SELECT event_id, {_DAY} AS op_date, '20240130' AS pt, event_type AS loc FROM events
WHERE event_type IN ('click', 'view') AND {_DAY} >= '2024-01-15'""",
    "replace_slice": f"""SELECT event_id, nullif(event_type, 'view') AS label, {_DAY} AS data_date FROM events
WHERE ({_DAY} <> '2024-01-10' OR event_type = 'click') AND {_DAY} NOT BETWEEN '2024-01-03' AND '2024-01-06' AND NOT ({_DAY} >= '2024-01-20' AND event_type = 'error')""",
    "replace_unpartitioned": """SELECT c_custkey, c_nationkey, CAST(NULL AS VARCHAR) AS data_date FROM customer WHERE c_acctbal >= 5000
UNION ALL SELECT c_custkey, c_nationkey, '2024-01-01' FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "create_if_absent": """SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice, '20240101' AS pt, 'o_orderkey bigint it''s o_orderkey, o_custkey bigint it''s o_custkey, '
  || 'o_orderstatus string it''s o_orderstatus, o_totalprice double it''s o_totalprice, o_orderdate string it''s o_orderdate, '
  || 'o_orderpriority string it''s o_orderpriority, pt string slice' AS notes FROM orders""",
    "partition_gate": f"""SELECT DISTINCT strftime(o_orderdate + INTERVAL 27 YEAR, '%Y%m%d') AS pt FROM orders
WHERE strftime(o_orderdate + INTERVAL 27 YEAR, '%Y%m%d') NOT IN (SELECT {_PT} FROM events)""",
    "slice_list": f"SELECT DISTINCT {_PT} AS pt FROM events",
    "manifest_ingest": """SELECT *, '2024013106' AS batch, '2024-01-31 07:00:00' AS update_time FROM (
  SELECT 'customer' AS db_table, 'finish' AS status, count(*) AS num_rows FROM customer
  UNION ALL SELECT 'orders', 'finish', count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m') FROM orders)
  UNION ALL SELECT 'lineitem', 'finish', count(*) FROM lineitem
  UNION ALL SELECT 'no_such_table', 'error', NULL)""",
    "manifest_batches": """SELECT event_id, upper(event_type) AS kind, CAST(trunc(value * 100) AS BIGINT) AS worth,
  '2024010310' || strftime(ts, '%M') AS pt FROM events WHERE strftime(ts, '%M') IN ('00', '05')""",
    "batch_taken_up": """SELECT DISTINCT c_custkey AS key, c_name AS label, '20240101' AS pt FROM customer
UNION ALL SELECT DISTINCT s_suppkey, s_name, '20240102' FROM supplier
UNION ALL SELECT (SELECT count(*) FROM (SELECT DISTINCT c_custkey, c_name FROM customer)), 'customer finish', 'ledger'
UNION ALL SELECT (SELECT count(*) FROM (SELECT DISTINCT s_suppkey, s_name FROM supplier)), 'supplier finish', 'ledger'""",
    "import_own_pt": "SELECT c_custkey, c_mktsegment AS pt FROM customer",
    "batch_snapshot": _SNAPSHOT.format(batch="2024010106", now="2024-01-01 06:00:00")
    + " UNION ALL "
    + _SNAPSHOT.format(batch="2024010206", now="2024-01-02 06:00:00"),
}
_GIVEN = """SELECT event_id, CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN props ELSE CAST(event_id AS VARCHAR) END AS worth,
  CASE WHEN user_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d') WHEN user_id % 2 = 0 THEN strftime(ts, '%d.%m.%Y') END AS day FROM events"""
ORACLES["rejected_rows"] = f"""WITH g AS ({_GIVEN}), t AS (SELECT *, TRY_CAST(worth AS INT) AS w, TRY_CAST(day AS DATE) AS d FROM g),
lost AS (SELECT event_id, 'rejected worth' AS went, worth AS value FROM t WHERE worth IS NOT NULL AND w IS NULL
  UNION ALL SELECT event_id, 'rejected day', day FROM t WHERE day IS NOT NULL AND d IS NULL)
SELECT event_id, 'landed' AS went, concat_ws('/', CAST(w AS VARCHAR), CAST(d AS VARCHAR)) AS value FROM t WHERE event_id NOT IN (SELECT event_id FROM lost)
UNION ALL SELECT * FROM lost"""
ORACLES["grown_table"] = """SELECT c_custkey, c_nationkey, NULL AS c_name, NULL AS segment, '20240101' AS pt FROM customer
UNION ALL SELECT c_custkey, c_nationkey, c_name, c_mktsegment, '20240102' FROM customer"""
