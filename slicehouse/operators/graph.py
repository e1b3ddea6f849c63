"""Questions to the graph of tasks that need more than one step along its edges.

Tables as in ``status``. Each question goes level by level: a level is one join of the rows reached last with the edges, written before the next one,
so that neither the plan nor what is lost with an executor grows with the depth of the graph. Edges are looked up for the instances once, so a parent with very
many children is one row on the side that only selects. The driver sees whether a level has rows, never which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicehouse.operators.status import ERROR, FINISH, INSTANCE, TASK
from slicehouse.session import written

PARENT = ["business_name", "batch", "parent_id"]


def batch_edges(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """(business_name, batch, tid, parent_id): the edges between instances that are both in a batch, each once."""
    above = instances.select(*INSTANCE).join(edges.where(F.col("parent_id").isNotNull()).select(*TASK, "parent_id").distinct(), TASK)
    known = instances.select("business_name", "batch", F.col("tid").alias("parent_id")).distinct()
    return above.join(known, PARENT, "left_semi").select(*INSTANCE, "parent_id").distinct()


def _as_parents(keys: DataFrame) -> DataFrame:
    return keys.select("business_name", "batch", F.col("tid").alias("parent_id"))


def descendants(instances: DataFrame, edges: DataFrame, start: DataFrame) -> DataFrame:
    """(business_name, batch, tid, level) of all instances below those of ``start`` in their own batch; level is the least number of edges.

    Rows of ``start`` are among them only if they are below another one, or below themselves by a cycle. There are as many rounds as levels.
    """
    between = written(batch_edges(instances, edges))
    found, frontier, level = None, start.select(*INSTANCE).distinct(), 0
    while True:
        level += 1
        below = between.join(_as_parents(frontier), PARENT, "left_semi").select(*INSTANCE).distinct()
        if found is not None:
            below = below.join(found, INSTANCE, "left_anti")
        frontier = written(below.withColumn("level", F.lit(level)))
        if found is not None and frontier.isEmpty():
            return found
        found = frontier if found is None else written(found.unionByName(frontier))


def rerun_set(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """What to run again after errors: instances in an error (level 0) and all below them in their batch, with all columns and ``level``.

    An instance below an error that is finished was run on what the failed task left, so it is run again too.
    """
    failed = instances.where(F.col("status") == ERROR).select(*INSTANCE)
    below = descendants(instances, edges, failed).join(failed, INSTANCE, "left_anti")
    levels = failed.distinct().withColumn("level", F.lit(0)).unionByName(below)
    return instances.join(levels, INSTANCE)


def never_free(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """Keys of the instances that stay held up even if every task that can start finishes: those on a cycle or below one.

    Instances without an unfinished parent are peeled off together with the edges below them, until none is left that could be.
    """
    open_ = instances.where(~F.col("status").eqNullSafe(F.lit(FINISH))).select(*INSTANCE)
    held = written(batch_edges(open_, edges))
    while True:
        keys = held.select(*INSTANCE).distinct()
        left = written(held.join(_as_parents(keys), PARENT, "left_semi"))
        # An edge stays while its parent is itself below an edge; nothing more goes once all do.
        if left.count() == held.count():
            return keys
        held = left


def stalled_instances(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """Unfinished instances that will not start by themselves: business_name, batch, tid, cause.

    ``cycle`` is on a cycle of edges or below one, ``error`` stands below an instance in an error, ``cycle and error`` both. An instance in an error is
    itself no stalled one: it has run.
    """
    cycles = never_free(instances, edges).withColumn("cyclic", F.lit(True))
    failed = instances.where(F.col("status") == ERROR)
    below = descendants(instances, edges, failed).select(*INSTANCE).withColumn("below", F.lit(True))
    open_ = instances.where(~F.col("status").isin(FINISH, ERROR) | F.col("status").isNull()).select(*INSTANCE)
    told = open_.join(cycles, INSTANCE, "left").join(below, INSTANCE, "left")
    cause = F.when(F.col("cyclic") & F.col("below"), "cycle and error").when(F.col("cyclic"), "cycle").when(F.col("below"), "error")
    return told.select(*INSTANCE, cause.alias("cause")).where(F.col("cause").isNotNull())


def batch_outlook(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """Per business and batch: state, cause, unfinished, stalled.

    ``done`` has nothing unfinished. ``stalled`` has only instances in an error or stalled ones, so nothing happens any more without help; ``cause`` then
    tells why: ``cycle``, which no new run mends, else ``error``. Any other batch is ``open``.
    """
    stuck = stalled_instances(instances, edges)
    told = instances.join(stuck, INSTANCE, "left")
    unfinished = ~F.col("status").eqNullSafe(F.lit(FINISH))
    idle = F.coalesce(F.col("status") == ERROR, F.lit(False)) | F.col("cause").isNotNull()
    counts = told.groupBy("business_name", "batch").agg(
        F.count_if(unfinished).alias("unfinished"),
        F.count_if(F.col("cause").isNotNull()).alias("stalled"),
        F.count_if(unfinished & ~idle).alias("moving"),
        F.coalesce(F.bool_or(F.col("cause").startswith("cycle")), F.lit(False)).alias("cyclic"),
    )
    state = F.when(F.col("unfinished") == 0, "done").when(F.col("moving") == 0, "stalled").otherwise("open")
    cause = F.when(F.col("cyclic"), "cycle").otherwise("error")
    return counts.select("business_name", "batch", state.alias("state"), F.when(state == "stalled", cause).alias("cause"), "unfinished", "stalled")


def deciding_chain(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """Per batch the chain of instances that decided when it ended: business_name, batch, place, tid, start_time, finish_time.

    Place 0 is the instance that finished last. Each further one is, of the parents that had finished when the one before started, the one that
    finished last; of equal times the smallest tid counts. A parent without times, or one that finished later than its child
    started, decided nothing. Unfinished instances are left out. On a chain times never rise, and where they are equal tids fall, so it ends even in a cycle of edges.
    """
    ended = instances.where((F.col("status") == FINISH) & F.col("finish_time").isNotNull()).select(*INSTANCE, "start_time", "finish_time")
    parents = ended.select("business_name", "batch", F.col("tid").alias("parent_id"), F.col("start_time").alias("p_start"), F.col("finish_time").alias("p_finish"))
    pairs = batch_edges(ended, edges).join(ended, INSTANCE).join(parents, PARENT)
    earlier = (F.col("p_finish") < F.col("finish_time")) | (F.col("parent_id") < F.col("tid"))
    held_up = pairs.where((F.col("p_finish") <= F.col("start_time")) & earlier)
    best = F.max_by(F.struct("parent_id", "p_start", "p_finish"), F.struct("p_finish", -F.col("parent_id"))).alias("p")
    decided = written(held_up.groupBy(*INSTANCE).agg(best).select(*INSTANCE, "p.*"))
    last = F.max_by(F.struct("tid", "start_time", "finish_time"), F.struct("finish_time", -F.col("tid"))).alias("last")
    link = written(ended.groupBy("business_name", "batch").agg(last).select("business_name", "batch", F.lit(0).alias("place"), "last.*"))
    chain = link
    while True:
        ahead = link.join(decided, INSTANCE).select(
            "business_name", "batch", (F.col("place") + 1).alias("place"), F.col("parent_id").alias("tid"), F.col("p_start").alias("start_time"), F.col("p_finish").alias("finish_time")
        )
        link = written(ahead)
        if link.isEmpty():
            return chain
        chain = written(chain.unionByName(link))
