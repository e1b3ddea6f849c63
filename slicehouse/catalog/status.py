"""Status questions: orders and lines, and the turns of conversations, in the place of batches and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.catalog.tables import table
from slicehouse.operators import status as ops

NOW = "2024-01-31 06:00:00"


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn is an instance in two batches, in states that depend on the length of its text, and in the second on the turn."""
    shift = F.when(F.col("batch") == "b2", F.col("turn")).otherwise(0)
    place = ((F.length("text") + shift) % 4 + 1).cast("int")
    state = F.element_at(F.array(*map(F.lit, ("init", "running", "error", "finish"))), place)
    talks = table(spark, folder, "conversations").withColumn("batch", F.explode(F.array(F.lit("b1"), F.lit("b2"))))
    return talks.select(
        F.col("conv_id").alias("business_name"),
        "batch",
        F.col("turn").alias("tid"),
        F.col("role").alias("name"),
        state.alias("status"),
    )


def _turn_edges(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("business_name"),
        F.col("turn").alias("tid"),
        F.when(F.col("turn") > 0, F.col("turn") - 1).alias("parent_id"),
    )


def _order_instances(spark: SparkSession, folder: str) -> DataFrame:
    none = F.lit(None).cast("string")
    state = F.element_at(
        F.array(*map(F.lit, ("init", "ready", "running", "error", "finish"))), (F.col("o_custkey") % 5 + 1).cast("int")
    )
    return table(spark, folder, "orders").select(
        F.lit("orders").alias("business_name"),
        F.date_format("o_orderdate", "yyyyMM").alias("batch"),
        F.col("o_orderkey").alias("tid"),
        state.alias("status"),
        F.lit("2024-01-01 00:00:00").alias("update_time"),
        none.alias("start_time"),
        none.alias("finish_time"),
    )


def forall_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Orders all of whose lines are F; those without lines count as complete."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return ops.forall_gate(orders, lines, ["o_orderkey"], F.col("l_linestatus") != "F")


def ready_frontier(spark: SparkSession, folder: str) -> DataFrame:
    frontier = ops.ready_frontier(_turns(spark, folder), _turn_edges(spark, folder))
    return frontier.select("business_name", "batch", "tid", "name", "status")


def graph_roots(spark: SparkSession, folder: str) -> DataFrame:
    return ops.roots(_turns(spark, folder), _turn_edges(spark, folder)).select("business_name", "batch", "tid", "status")


def mark_roots(spark: SparkSession, folder: str) -> DataFrame:
    turns = _turns(spark, folder).withColumn("start_time", F.lit(None).cast("string"))
    marked = ops.mark_roots_ready(turns, _turn_edges(spark, folder), NOW)
    return marked.select("business_name", "batch", "tid", "status", "start_time")


def graph_children(spark: SparkSession, folder: str) -> DataFrame:
    """The turns after those that end in an error, batch by batch."""
    turns = _turns(spark, folder)
    failed = ops.select_status(turns, ["error"])
    below = ops.children_in_batch(turns, _turn_edges(spark, folder), failed)
    return below.select("business_name", "batch", "tid", "status")


def task_names(spark: SparkSession, folder: str) -> DataFrame:
    """Running turns with the definition of their task; those of user turns were dropped."""
    turns = _turns(spark, folder).where(F.col("batch") == "b1")
    tasks = turns.where(F.col("name") != "user").select("business_name", "tid", "name")
    running = ops.select_status(turns, ["running"])
    return ops.with_task(running, tasks).select("business_name", "tid", "name", "task_name")


def batch_completion(spark: SparkSession, folder: str) -> DataFrame:
    """An order is a batch, a line its instance, a part the task, where large parts are still defined."""
    lines = table(spark, folder, "lineitem").select(
        F.lit("lines").alias("business_name"),
        F.col("l_orderkey").alias("batch"),
        F.col("l_partkey").alias("tid"),
        F.when(F.col("l_linestatus") == "F", F.lit("finish")).otherwise(F.lit("init")).alias("status"),
    )
    parts = table(spark, folder, "part").where(F.col("p_size") > 10)
    tasks = parts.select(F.lit("lines").alias("business_name"), F.col("p_partkey").alias("tid"))
    return ops.batch_states(lines, tasks).select("batch", "state", "complete")


def status_transition(spark: SparkSession, folder: str) -> DataFrame:
    """Orders get a new status from their lines, but only orders in the state ``init``."""
    instances = _order_instances(spark, folder)
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("tid")).agg(
        F.when(F.bool_and(F.col("l_linestatus") == "F"), F.lit("finish")).otherwise(F.lit("ready")).alias("new_status")
    )
    changes = instances.select(*ops.INSTANCE).join(lines, "tid")
    changed = ops.transition(instances, changes, NOW, only_if="init")
    return changed.select("batch", "tid", "status", "update_time", "start_time", "finish_time")


def rerun_selection(spark: SparkSession, folder: str) -> DataFrame:
    reset = ops.reset_for_rerun(_order_instances(spark, folder), NOW)
    return ops.select_status(reset, ["ready", "error"]).select("batch", "tid", "status", "update_time", "start_time")


def open_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Short conversations are untouched batches, middling ones are finished, long ones under way; some are yet to be made."""
    turns = _turns(spark, folder).where(F.col("batch") == "b1")
    talks = table(spark, folder, "conversations").groupBy(F.col("conv_id").alias("business_name")).agg(
        F.count("*").alias("turns"), F.max(F.when(F.col("turn") == 0, F.length("text"))).alias("opening")
    )
    none = F.lit(None).cast("string")
    state = F.when(F.col("turns") <= 3, F.lit("init")).when(F.col("turns") <= 5, F.lit("finish")).otherwise(F.col("status"))
    instances = turns.join(talks.where(F.col("opening") > 400), "business_name").select(
        *ops.INSTANCE,
        "name",
        state.alias("status"),
        F.lit("2024-01-01 00:00:00").alias("create_time"),
        F.lit("2024-01-01 00:00:00").alias("update_time"),
        none.alias("start_time"),
        none.alias("finish_time"),
    )
    opened = ops.open_batch(instances, turns.select(*ops.TASK, "name"), _turn_edges(spark, folder), "b1", NOW)
    return opened.drop("batch", "finish_time")


QUERIES = {
    "forall_gate": forall_gate,
    "ready_frontier": ready_frontier,
    "graph_roots": graph_roots,
    "graph_roots_marked": mark_roots,
    "graph_children": graph_children,
    "task_names": task_names,
    "batch_completion": batch_completion,
    "status_transition": status_transition,
    "rerun_selection": rerun_selection,
    "open_batch": open_batch,
}

_TURNS = """SELECT conv_id AS business_name, turn AS tid, CASE WHEN turn > 0 THEN turn - 1 END AS parent_id, role AS name,
  CASE length(text) % 4 WHEN 0 THEN 'init' WHEN 1 THEN 'running' WHEN 2 THEN 'error' ELSE 'finish' END AS status
FROM conversations"""
_BATCHES = """SELECT conv_id AS business_name, batch, turn AS tid, CASE WHEN turn > 0 THEN turn - 1 END AS parent_id, role AS name,
  ['init', 'running', 'error', 'finish'][(length(text) + CASE batch WHEN 'b2' THEN turn ELSE 0 END) % 4 + 1] AS status
FROM conversations, (VALUES ('b1'), ('b2')) AS batches(batch)"""
_STATE = """CASE o_custkey % 5 WHEN 0 THEN 'init' WHEN 1 THEN 'ready' WHEN 2 THEN 'running' WHEN 3 THEN 'error' ELSE 'finish' END"""

ORACLES = {
    "forall_gate": """SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus <> 'F')""",
    "ready_frontier": f"""WITH t AS ({_BATCHES}) SELECT business_name, batch, tid, name, status FROM t a WHERE status = 'init'
AND NOT EXISTS (SELECT 1 FROM t b WHERE b.business_name = a.business_name AND b.batch = a.batch AND b.tid = a.parent_id AND b.status <> 'finish')""",
    "graph_roots": f"WITH t AS ({_BATCHES}) SELECT business_name, batch, tid, status FROM t WHERE parent_id IS NULL",
    "graph_roots_marked": f"""WITH t AS ({_BATCHES}) SELECT business_name, batch, tid,
  CASE WHEN parent_id IS NULL THEN 'ready' ELSE status END AS status, CASE WHEN parent_id IS NULL THEN '{NOW}' END AS start_time FROM t""",
    "graph_children": f"""WITH t AS ({_BATCHES}) SELECT a.business_name, a.batch, a.tid, a.status FROM t a
JOIN t b ON b.business_name = a.business_name AND b.batch = a.batch AND b.tid = a.parent_id WHERE b.status = 'error'""",
    "task_names": f"""WITH t AS ({_TURNS}) SELECT business_name, tid, name, nullif(name, 'user') AS task_name FROM t
WHERE status = 'running'""",
    "batch_completion": """SELECT l_orderkey AS batch,
  CASE WHEN bool_and(l_linestatus = 'F') THEN 'done' WHEN bool_and(l_linestatus <> 'F') THEN 'fresh' ELSE 'rerun' END AS state,
  NOT bool_or(p_size > 10 AND l_linestatus <> 'F') AS complete
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "status_transition": f"""WITH c AS (SELECT l_orderkey, CASE WHEN bool_and(l_linestatus = 'F') THEN 'finish' ELSE 'ready' END AS s
  FROM lineitem GROUP BY l_orderkey),
i AS (SELECT strftime(o_orderdate, '%Y%m') AS batch, o_orderkey AS tid, {_STATE} AS status FROM orders),
x AS (SELECT i.*, CASE WHEN status = 'init' THEN s END AS s FROM i LEFT JOIN c ON tid = l_orderkey)
SELECT batch, tid, coalesce(s, status) AS status, CASE WHEN s IS NULL THEN '2024-01-01 00:00:00' ELSE '{NOW}' END AS update_time,
  CASE WHEN s = 'ready' THEN '{NOW}' END AS start_time, CASE WHEN s = 'finish' THEN '{NOW}' END AS finish_time FROM x""",
    "rerun_selection": f"""WITH i AS (SELECT strftime(o_orderdate, '%Y%m') AS batch, o_orderkey AS tid, {_STATE} AS status FROM orders)
SELECT batch, tid, 'ready' AS status, CASE WHEN status = 'ready' THEN '2024-01-01 00:00:00' ELSE '{NOW}' END AS update_time,
  CASE WHEN status <> 'ready' THEN '{NOW}' END AS start_time FROM i WHERE status IN ('ready', 'running', 'error')""",
    "open_batch": f"""WITH t AS ({_TURNS}),
n AS (SELECT conv_id, count(*) AS turns, max(CASE WHEN turn = 0 THEN length(text) END) > 400 AS made FROM conversations GROUP BY conv_id),
i AS (SELECT t.*, made, CASE WHEN NOT made OR turns <= 3 THEN 'init' WHEN turns <= 5 THEN 'finish' ELSE status END AS s
  FROM t JOIN n ON business_name = conv_id),
b AS (SELECT business_name, bool_and(s = 'finish') AS done, bool_and(s = 'init') AS fresh FROM i GROUP BY business_name),
x AS (SELECT i.*, fresh AND parent_id IS NULL AS begins, NOT done AND NOT fresh AND s IN ('running', 'error') AS again
  FROM i JOIN b USING (business_name))
SELECT business_name, tid, name, CASE WHEN begins OR again THEN 'ready' ELSE s END AS status,
  CASE WHEN made THEN '2024-01-01 00:00:00' ELSE '{NOW}' END AS create_time,
  CASE WHEN again OR NOT made THEN '{NOW}' ELSE '2024-01-01 00:00:00' END AS update_time,
  CASE WHEN begins OR again THEN '{NOW}' END AS start_time FROM x""",
}
