"""Status questions on a diamond, loose ends, and two batches side by side."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from slicehouse.operators import status as ops

EDGES = [
    ("b", 1, None),
    ("b", 2, 1),
    ("b", 3, 1),
    ("b", 4, 2),
    ("b", 4, 3),
    ("b", 5, 99),  # a parent without an instance
    ("c", 1, None),
    ("c", 4, 2),
]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(EDGES, "business_name string, tid bigint, parent_id bigint")


def instances(spark, rows):
    frame = spark.createDataFrame(rows, "business_name string, batch string, tid bigint, status string")
    none = F.lit(None).cast("string")
    return frame.select(
        "business_name",
        "batch",
        "tid",
        F.concat(F.lit("task"), "tid").alias("name"),
        "status",
        F.lit("t0").alias("create_time"),
        F.lit("t0").alias("update_time"),
        none.alias("start_time"),
        none.alias("finish_time"),
    )


def keys(frame):
    return sorted((row.business_name, row.batch, row.tid) for row in frame.collect())


def test_frontier(spark, edges):
    frame = instances(
        spark,
        [
            ("b", "1", 1, "finish"),
            ("b", "1", 2, "finish"),
            ("b", "1", 3, "running"),
            ("b", "1", 4, "init"),
            ("b", "1", 5, "init"),
            ("b", "1", 6, "init"),  # without any edge
            ("b", "2", 1, "finish"),
            ("b", "2", 2, "finish"),
            ("b", "2", 3, "finish"),
            ("b", "2", 4, "init"),
            ("c", "1", 1, "init"),
            ("c", "1", 2, None),  # unknown state: not known to be unfinished
            ("c", "1", 4, "init"),
        ],
    )
    expected = [("b", "1", 5), ("b", "1", 6), ("b", "2", 4), ("c", "1", 1), ("c", "1", 4)]
    assert keys(ops.ready_frontier(frame, edges)) == expected


def test_roots_and_children(spark, edges):
    frame = instances(spark, [("b", batch, tid, "init") for batch in "12" for tid in range(1, 6)] + [("c", "1", 1, "init")])
    assert keys(ops.roots(frame, edges)) == [("b", "1", 1), ("b", "2", 1), ("c", "1", 1)]
    parents = spark.createDataFrame([("b", 1), ("b", 2), ("c", 1)], "business_name string, tid bigint")
    assert keys(ops.children(frame.where("batch = '1'"), edges, parents)) == [("b", "1", 2), ("b", "1", 3), ("b", "1", 4)]
    above = frame.where("batch = '2' AND tid = 2")
    assert keys(ops.children_in_batch(frame, edges, above)) == [("b", "2", 4)]
    marked = ops.mark_roots_ready(frame, edges, "t1")
    assert marked.columns == frame.columns
    assert keys(marked.where("status = 'ready' AND start_time = 't1' AND update_time = 't0'")) == keys(ops.roots(frame, edges))


def test_batch_states(spark):
    frame = instances(
        spark,
        [
            ("b", "done", 1, "finish"),
            ("b", "done", 2, "finish"),
            ("b", "fresh", 1, "init"),
            ("b", "rerun", 1, "finish"),
            ("b", "rerun", 9, "error"),  # its task was dropped
            ("b", "null", 1, None),
            ("b", "half", 1, "finish"),
            ("b", "half", 2, "init"),
        ],
    )
    tasks = spark.createDataFrame([("b", 1, "x"), ("b", 2, "y"), ("b", 2, "y")], "business_name string, tid bigint, name string")
    got = {row.batch: (row.state, row.complete) for row in ops.batch_states(frame, tasks).collect()}
    assert got == {
        "done": ("done", True),
        "fresh": ("fresh", False),
        "rerun": ("rerun", True),
        "null": ("rerun", True),
        "half": ("rerun", False),
    }
    assert {row.batch: row.state for row in ops.batch_states(frame).collect()} == {batch: state for batch, (state, _) in got.items()}


def test_transition(spark):
    frame = instances(spark, [("b", "1", tid, state) for tid, state in enumerate(["init", "running", "init", "init"], 1)])
    changes = spark.createDataFrame(
        [("b", "1", 1, "ready"), ("b", "1", 2, "finish"), ("b", "1", 3, "error"), ("b", "2", 4, "ready")],
        "business_name string, batch string, tid bigint, new_status string",
    )

    def shown(changed):
        return {row.tid: (row.status, row.update_time, row.start_time, row.finish_time) for row in changed.collect()}

    untouched = {4: ("init", "t0", None, None)}
    assert shown(ops.transition(frame, changes, "t1")) == {
        1: ("ready", "t1", "t1", None),
        2: ("finish", "t1", None, "t1"),
        3: ("error", "t1", None, None),
        **untouched,
    }
    assert shown(ops.transition(frame, changes, "t1", only_if="init"))[2] == ("running", "t0", None, None)
    assert ops.transition(frame, changes, "t1").columns == frame.columns
    with pytest.raises(PySparkException, match="more than one change"):
        ops.transition(frame, changes.union(changes), "t1").collect()
    with pytest.raises(PySparkException, match="unknown state"):
        ops.transition(frame, changes.withColumn("new_status", F.lit("redy")), "t1").collect()


def test_rerun(spark):
    frame = instances(spark, [("b", "1", tid, state) for tid, state in enumerate(["init", "ready", "running", "error", "finish"])])
    reset = ops.reset_for_rerun(frame, "t1")
    assert {row.tid: (row.status, row.start_time, row.update_time) for row in reset.collect()} == {
        0: ("init", None, "t0"),
        1: ("ready", None, "t0"),
        2: ("ready", "t1", "t1"),
        3: ("ready", "t1", "t1"),
        4: ("finish", None, "t0"),
    }
    assert keys(ops.select_status(frame, ["ready", "error"], "1")) == [("b", "1", 1), ("b", "1", 3)]
    assert ops.select_status(frame, ["ready"], "2").isEmpty()


def test_snapshot_and_definitions(spark):
    tasks = spark.createDataFrame([("b", 1, "x"), ("b", 2, "y")], "business_name string, tid bigint, name string")
    rows = ops.snapshot_batch(tasks, "2024010106", "t1")
    assert tuple(rows.orderBy("tid").first()) == ("b", "2024010106", 1, "x", "init", "t1", "t1", None, None)
    kept = ops.with_task(rows, tasks.where("tid = 1"))
    assert {row.tid: row.task_name for row in kept.collect()} == {1: "x", 2: None}


def test_open_batch(spark, edges):
    frame = instances(
        spark,
        [
            ("b", "1", 1, "init"),
            ("b", "1", 2, "init"),
            ("c", "1", 1, "finish"),
            ("c", "1", 4, "error"),
            ("d", "1", 1, "finish"),
            ("e", "2", 1, "running"),
        ],
    )
    tasks = spark.createDataFrame(
        [("b", 1, "x"), ("c", 1, "x"), ("d", 1, "x"), ("e", 1, "x"), ("e", 2, "y")], "business_name string, tid bigint, name string"
    )
    more = edges.union(spark.createDataFrame([("e", 1, None), ("e", 2, 1)], edges.schema))
    opened = ops.open_batch(frame, tasks, more, "1", "t1")
    assert opened.columns == frame.columns
    assert {(row.business_name, row.tid): (row.status, row.start_time, row.update_time) for row in opened.collect()} == {
        ("b", 1): ("ready", "t1", "t0"),
        ("b", 2): ("init", None, "t0"),
        ("c", 1): ("finish", None, "t0"),
        ("c", 4): ("ready", "t1", "t1"),
        ("d", 1): ("finish", None, "t0"),
        ("e", 1): ("ready", "t1", "t1"),
        ("e", 2): ("init", None, "t1"),
    }


def test_gate_with_one_huge_member_group(spark):
    items = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k bigint")
    members = spark.range(100_000).select(F.lit(1).cast("bigint").alias("k"), (F.col("id") == 77_777).alias("bad")).union(
        spark.createDataFrame([(2, False), (3, None)], "k bigint, bad boolean")
    )
    got = ops.forall_gate(items, members, ["k"], F.col("bad"))
    assert {row.k for row in got.collect()} == {2, 3, None}
