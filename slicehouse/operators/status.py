"""Questions to status tables and to the edges between tasks.

Tables, each a DataFrame; the key of a task is (business_name, tid), that of an instance (business_name, batch, tid):

- tasks: business_name, tid, name
- edges: business_name, tid, parent_id; a null parent marks a root
- instances: business_name, batch, tid, name, status, create_time, update_time, start_time, finish_time

The state of many batches and businesses is answered at once; to ask about one, filter the instances first.
Times are given by the caller, so that a question has the same answer whenever it is asked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The states of an instance.
STATES = INIT, READY, RUNNING, FINISH, ERROR = ("init", "ready", "running", "finish", "error")

TASK = ["business_name", "tid"]
INSTANCE = ["business_name", "batch", "tid"]


def snapshot_batch(tasks: DataFrame, batch: str, now: str, status: str = INIT) -> DataFrame:
    """An instance of every task for one batch."""
    none = F.lit(None).cast("string")
    return tasks.select(
        "business_name",
        F.lit(batch).alias("batch"),
        "tid",
        "name",
        F.lit(status).alias("status"),
        F.lit(now).alias("create_time"),
        F.lit(now).alias("update_time"),
        none.alias("start_time"),
        none.alias("finish_time"),
    )


def select_status(instances: DataFrame, statuses: Sequence[str], batch: str | None = None) -> DataFrame:
    """Instances in one of the states, of one batch where given."""
    chosen = instances.where(F.col("status").isin(list(statuses)))
    return chosen if batch is None else chosen.where(F.col("batch") == batch)


def with_task(instances: DataFrame, tasks: DataFrame) -> DataFrame:
    """Instances with the definition of their task, which is null for a task that was dropped since."""
    return instances.join(tasks.withColumnRenamed("name", "task_name"), TASK, "left")


def roots(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """Instances of tasks that have an edge without a parent."""
    return instances.join(edges.where(F.col("parent_id").isNull()).select(*TASK).distinct(), TASK, "left_semi")


def children(instances: DataFrame, edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Instances whose task has one of ``parents`` (business_name, tid) as a parent."""
    wanted = parents.select("business_name", F.col("tid").alias("parent_id")).distinct()
    below = edges.join(wanted, ["business_name", "parent_id"], "left_semi")
    return instances.join(below.select(*TASK).distinct(), TASK, "left_semi")


def children_in_batch(instances: DataFrame, edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Instances which have one of the instances ``parents`` (business_name, batch, tid) as a parent in their own batch."""
    return instances.join(_below(instances, edges, parents), INSTANCE, "left_semi")


def _below(instances: DataFrame, edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Keys of those instances that have one of ``parents`` above them.

    Edges are looked up for the instances first: a parent with very many children then sits on the left of a semi-join
    whose right side has it once, where Spark can split it over tasks.
    """
    above = instances.select(*INSTANCE).join(edges.where(F.col("parent_id").isNotNull()), TASK)
    wanted = parents.select("business_name", "batch", F.col("tid").alias("parent_id")).distinct()
    return above.join(wanted, ["business_name", "batch", "parent_id"], "left_semi").select(*INSTANCE).distinct()


def forall_gate(items: DataFrame, members: DataFrame, on: Sequence[str], violation: Column) -> DataFrame:
    """Items none of whose members is in violation; an item without members passes.

    Violators are reduced to one row per item before the shuffle, so an item with very many members does no harm.
    """
    return items.join(members.where(violation).select(*on).distinct(), list(on), "left_anti")


def ready_frontier(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """``init`` instances that may start: no parent instance in their batch is in a state other than ``finish``.

    Tasks without parents may start, and a parent without an instance in the batch does not hold anything up.
    """
    unfinished = instances.where(F.col("status") != FINISH).select("business_name", "batch", F.col("tid").alias("parent_id"))
    held_up = edges.join(unfinished, ["business_name", "parent_id"]).select(*INSTANCE).distinct()
    return instances.where(F.col("status") == INIT).join(held_up, INSTANCE, "left_anti")


def transition(
    instances: DataFrame,
    changes: DataFrame,
    now: str,
    only_if: str | None = None,
) -> DataFrame:
    """Instances after status changes, given as (business_name, batch, tid, new_status), one per instance.

    With ``only_if``, a change applies only to instances in that state. ``ready`` sets the start time and ``finish`` the
    finish time. Two changes to one instance are an error, since their order is unknown.
    """
    # States are numbered here, because Spark aggregates numbers by hash but has to sort for text.
    number = F.array_position(F.array(*map(F.lit, STATES)), F.col("new_status"))
    single = changes.groupBy(*INSTANCE).agg(F.min(number).alias("number"), F.count(F.lit(1)).alias("changes"))
    key = F.concat_ws("/", *INSTANCE)
    status = (
        F.when(F.col("changes") > 1, F.raise_error(F.concat(F.lit("more than one change for instance "), key)))
        .when(F.coalesce("number", F.lit(0)) == 0, F.raise_error(F.concat(F.lit("unknown state for instance "), key)))
        .otherwise(F.element_at(F.array(*map(F.lit, STATES)), F.col("number").cast("int")))
    )
    single = single.select(*INSTANCE, status.alias("new_status"))
    applies = F.col("new_status").isNotNull()
    if only_if is not None:
        applies &= F.col("status") == only_if
    return _set_status(instances.join(single, INSTANCE, "left"), applies, F.col("new_status"), now, instances.columns)


def mark_roots_ready(instances: DataFrame, edges: DataFrame, now: str) -> DataFrame:
    """Instances with the roots set to ``ready``."""
    marked = edges.where(F.col("parent_id").isNull()).select(*TASK).distinct().withColumn("is_root", F.lit(True))
    joined = instances.join(marked, TASK, "left")
    return joined.withColumns(
        {
            "status": F.when(F.col("is_root"), F.lit(READY)).otherwise(F.col("status")),
            "start_time": F.when(F.col("is_root"), F.lit(now)).otherwise(F.col("start_time")),
        }
    ).select(*instances.columns)


def reset_for_rerun(instances: DataFrame, now: str) -> DataFrame:
    """Instances with ``running`` and ``error`` set back to ``ready``."""
    return _set_status(instances, F.col("status").isin(RUNNING, ERROR), F.lit(READY), now, instances.columns)


def _set_status(rows: DataFrame, applies: Column, status: Column, now: str, columns: Sequence[str]) -> DataFrame:
    def changed(value: Column, name: str, when: Column = F.lit(True)) -> Column:
        return F.when(applies & when, value).otherwise(F.col(name)).alias(name)

    new = {
        "status": changed(status, "status"),
        "update_time": changed(F.lit(now), "update_time"),
        "start_time": changed(F.lit(now), "start_time", status == READY),
        "finish_time": changed(F.lit(now), "finish_time", status == FINISH),
    }
    return rows.select(*[new.get(name, F.col(name)) for name in columns])


def batch_states(instances: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Per business and batch: ``state``, and with tasks given ``complete``.

    The state is ``done`` if every instance is finished, ``fresh`` if every one is ``init``, and ``rerun`` otherwise. A batch is
    complete if no instance of a task that still exists is unfinished.
    """
    finished = F.col("status").eqNullSafe(F.lit(FINISH))
    state = (
        F.when(F.bool_and(finished), F.lit("done"))
        .when(F.bool_and(F.col("status").eqNullSafe(F.lit(INIT))), F.lit("fresh"))
        .otherwise(F.lit("rerun"))
        .alias("state")
    )
    if tasks is None:
        return instances.groupBy("business_name", "batch").agg(state)
    known = instances.join(tasks.select(*TASK).distinct().withColumn("has_task", F.lit(True)), TASK, "left")
    holds_up = F.col("has_task") & (F.col("status") != FINISH)
    complete = (~F.bool_or(F.coalesce(holds_up, F.lit(False)))).alias("complete")
    return known.groupBy("business_name", "batch").agg(state, complete)


def open_batch(instances: DataFrame, tasks: DataFrame, edges: DataFrame, batch: str, now: str) -> DataFrame:
    """The instances of one batch, ready for its start, for all businesses that have tasks.

    A business without instances gets one per task. Where all instances are still ``init``, the roots become ``ready``.
    A batch that was begun gets its ``running`` and ``error`` instances set back to ``ready``. A finished one stays as it is.
    """
    present = instances.where(F.col("batch") == batch)
    absent = tasks.join(present.select("business_name").distinct(), "business_name", "left_anti")
    current = present.unionByName(snapshot_batch(absent, batch, now))
    top = edges.where(F.col("parent_id").isNull()).select(*TASK).distinct().withColumn("is_root", F.lit(True))
    told = current.join(batch_states(current), ["business_name", "batch"]).join(top, TASK, "left")
    again = (F.col("state") == "rerun") & F.col("status").isin(RUNNING, ERROR)
    starts = again | ((F.col("state") == "fresh") & F.col("is_root"))
    new = {
        "status": F.when(starts, F.lit(READY)).otherwise(F.col("status")),
        "start_time": F.when(starts, F.lit(now)).otherwise(F.col("start_time")),
        "update_time": F.when(again, F.lit(now)).otherwise(F.col("update_time")),
    }
    return told.select(*[new[name].alias(name) if name in new else F.col(name) for name in instances.columns])
