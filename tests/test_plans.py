"""The shape of the plans: scans, exchanges, pushed filters, and what never appears."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered

QUERIES = registered.queries()
READERS = [
    name for name, query in sorted(QUERIES.items()) if query.__module__.rpartition(".")[2] in ("reports", "columns", "status")
]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def count(plan, operator):
    return len(re.findall(rf"(?<!\w){operator}\b", plan))


@pytest.fixture
def without_broadcast(spark):
    """The plans for tables of which none is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Scans and exchanges when all tables are large. More of either is a loss at scale.
LARGEST = {
    "stage_funnel": (1, 2),
    "stage_anti_join": (2, 2),
    "stage_anti_join_multi": (1, 1),
    "lookback_dedupe": (2, 3),
    "forall_gate": (2, 2),
    "graph_roots": (2, 2),
    "batch_completion": (2, 4),
    "status_transition": (3, 4),
    "batch_calendar": (1, 1),
    "stuck_report": (5, 11),
}


@pytest.mark.parametrize("name", sorted(LARGEST))
def test_scans_and_exchanges(name, spark, folder, without_broadcast):
    plan = plan_of(QUERIES[name](spark, folder))
    assert (count(plan, "FileScan"), count(plan, "Exchange")) <= LARGEST[name]
    assert count(plan, "FileScan") <= LARGEST[name][0] and count(plan, "Exchange") <= LARGEST[name][1]


@pytest.mark.parametrize("name", READERS)
def test_nothing_pairs_everything(name, spark, folder, without_broadcast):
    plan = plan_of(QUERIES[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "SortAggregate", "Window", "Python\\w*"):
        assert count(plan, operator) == 0, operator
    assert "collect_" not in plan


def test_narrow_queries_do_not_shuffle(spark, folder):
    for name in ("batch_times", "days_ago", "incremental_filter", "schema_contract", "column_mapping", "empty_to_null", "rerun_selection"):
        assert count(plan_of(QUERIES[name](spark, folder)), "Exchange") == 0, name


@pytest.mark.parametrize(
    "name, filters, columns",
    [
        ("stage_funnel", ["GreaterThanOrEqual(ts", "LessThan(ts", "In(event_type"], "ts:timestamp_ntz,user_id:bigint,event_type:string>"),
        ("incremental_filter", ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"], "o_orderdate:timestamp_ntz>"),
        ("condition_filter", ["GreaterThanOrEqual(o_orderdate", "In(o_orderstatus"], "o_orderdate:timestamp_ntz>"),
        ("stuck_report", ["GreaterThanOrEqual(l_shipdate", "LessThan(l_shipdate"], "l_linenumber:int,l_shipdate:timestamp_ntz>"),
    ],
)
def test_filters_and_columns_reach_the_scan(name, filters, columns, spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(QUERIES[name](spark, folder))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for wanted in filters:
        assert wanted in plan
    assert columns in plan


def test_the_carried_funnel_scans_once(spark, folder, without_broadcast):
    frame = QUERIES["stage_funnel_carried"](spark, folder)
    frame.collect()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    assert count(final, "ReusedExchange") == 1
    assert count(final, "FileScan") == 1


def test_rows_shrink_before_the_first_exchange(spark, folder):
    """However often a unit was scanned, it goes through the shuffle once per task."""
    from slicehouse.operators.funnel import Stage, presence

    rows = spark.range(0, 400_000, 1, 8).select((F.col("id") % 10).alias("unit"), (F.col("id") % 4).cast("int").alias("station"))
    frame = presence(rows, ["unit"], "station", [Stage("a", 1, (2,)), Stage("b", 3, (1,))])
    frame.collect()
    tree = frame._jdf.queryExecution().executedPlan().executedPlan()
    written = []

    def visit(node):
        if "ShuffleQueryStage" in node.nodeName():
            written.append(node.shuffle().metrics().apply("shuffleRecordsWritten").value())
        elif "QueryStage" in node.nodeName():
            visit(node.plan())
        for place in range(node.children().size()):
            visit(node.children().apply(place))

    visit(tree)
    assert 0 < sum(written) <= 80
