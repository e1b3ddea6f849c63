"""Questions that take more than one step along the edges, on the turns of conversations in the place of tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.catalog.tables import table
from slicehouse.operators import graph


def _instances(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn is an instance in two batches; few are in an error. It starts when its text's length in minutes has gone since its turn came."""
    shift = F.when(F.col("batch") == "b2", F.col("turn") * 3 + 1).otherwise(0)
    state = F.element_at(F.array(*map(F.lit, ("finish", "finish", "finish", "init", "error", "finish", "finish"))), ((F.length("text") + shift) % 7 + 1).cast("int"))
    start = F.col("turn") * 100 + F.length("text") % 60
    talks = table(spark, folder, "conversations").withColumn("batch", F.explode(F.array(F.lit("b1"), F.lit("b2"))))
    return talks.select(
        F.col("conv_id").alias("business_name"),
        "batch",
        F.col("turn").alias("tid"),
        state.alias("status"),
        F.lpad(start.cast("string"), 6, "0").alias("start_time"),
        F.lpad((start + F.length("text") % 170 + shift).cast("string"), 6, "0").alias("finish_time"),
    )


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    """A turn has the one before it and the one two before as parents: two ways to each third turn. Some conversations have a cycle, some a self-edge."""
    talks = table(spark, folder, "conversations").select(F.col("conv_id").alias("business_name"), F.col("turn").alias("tid"))
    before = talks.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("back")).select(
        "business_name", "tid", F.when(F.col("tid") >= F.col("back"), F.col("tid") - F.col("back")).alias("parent_id")
    )
    cycles = talks.where("business_name % 7 = 0 AND tid = 1").select("business_name", "tid", (F.col("tid") + 1).alias("parent_id"))
    selves = talks.where("business_name % 11 = 0 AND tid = 2").select("business_name", "tid", F.col("tid").alias("parent_id"))
    return before.union(cycles).union(selves)


def rerun_set(spark: SparkSession, folder: str) -> DataFrame:
    found = graph.rerun_set(_instances(spark, folder), _edges(spark, folder))
    return found.select("business_name", "batch", "tid", "status", "level")


def stalled_instances(spark: SparkSession, folder: str) -> DataFrame:
    return graph.stalled_instances(_instances(spark, folder), _edges(spark, folder))


def batch_outlook(spark: SparkSession, folder: str) -> DataFrame:
    return graph.batch_outlook(_instances(spark, folder), _edges(spark, folder))


def deciding_chain(spark: SparkSession, folder: str) -> DataFrame:
    return graph.deciding_chain(_instances(spark, folder), _edges(spark, folder))


QUERIES = {"rerun_set": rerun_set, "stalled_instances": stalled_instances, "batch_outlook": batch_outlook, "deciding_chain": deciding_chain}

_TABLES = """i AS (
  SELECT conv_id AS business_name, batch, turn AS tid,
    ['finish', 'finish', 'finish', 'init', 'error', 'finish', 'finish'][CAST((length(text) + shift) % 7 + 1 AS INT)] AS status,
    lpad(CAST(turn * 100 + length(text) % 60 AS VARCHAR), 6, '0') AS start_time,
    lpad(CAST(turn * 100 + length(text) % 60 + length(text) % 170 + shift AS VARCHAR), 6, '0') AS finish_time
  FROM (SELECT *, CASE batch WHEN 'b2' THEN turn * 3 + 1 ELSE 0 END AS shift FROM conversations, (VALUES ('b1'), ('b2')) AS v(batch))
), given AS (
  SELECT conv_id AS business_name, turn AS tid, turn - back AS parent_id FROM conversations, (VALUES (1), (2)) AS v(back) WHERE turn >= back
  UNION SELECT conv_id, 1, 2 FROM conversations WHERE conv_id % 7 = 0 AND turn = 1
  UNION SELECT conv_id, 2, 2 FROM conversations WHERE conv_id % 11 = 0 AND turn = 2
), e AS (
  SELECT c.business_name, c.batch, c.tid, g.parent_id FROM given g JOIN i c ON c.business_name = g.business_name AND c.tid = g.tid
  JOIN i p ON p.business_name = c.business_name AND p.batch = c.batch AND p.tid = g.parent_id
)"""
_BELOW = """walk(business_name, batch, tid, level) AS (
  SELECT DISTINCT business_name, batch, tid, 0 FROM i WHERE status = 'error'
  UNION SELECT e.business_name, e.batch, e.tid, level + 1 FROM walk w JOIN e ON e.business_name = w.business_name AND e.batch = w.batch AND e.parent_id = w.tid
  WHERE level < 60
)"""
_STALLED = """open_edges AS (
  SELECT e.* FROM e JOIN i c ON c.business_name = e.business_name AND c.batch = e.batch AND c.tid = e.tid AND c.status <> 'finish'
  JOIN i p ON p.business_name = e.business_name AND p.batch = e.batch AND p.tid = e.parent_id AND p.status <> 'finish'
), reach(business_name, batch, top, tid) AS (
  SELECT business_name, batch, parent_id, tid FROM open_edges
  UNION SELECT r.business_name, r.batch, r.top, o.tid FROM reach r JOIN open_edges o ON o.business_name = r.business_name AND o.batch = r.batch AND o.parent_id = r.tid
), looped AS (SELECT DISTINCT business_name, batch, top FROM reach WHERE top = tid),
cyclic AS (
  SELECT DISTINCT r.business_name, r.batch, r.tid FROM reach r JOIN looped l ON l.business_name = r.business_name AND l.batch = r.batch AND l.top = r.top
), below AS (SELECT DISTINCT business_name, batch, tid FROM walk WHERE level > 0),
stalled AS (
  SELECT i.business_name, i.batch, i.tid, CASE WHEN c.tid IS NOT NULL AND b.tid IS NOT NULL THEN 'cycle and error' WHEN c.tid IS NOT NULL THEN 'cycle' ELSE 'error' END AS cause
  FROM i LEFT JOIN cyclic c USING (business_name, batch, tid) LEFT JOIN below b USING (business_name, batch, tid)
  WHERE i.status NOT IN ('finish', 'error') AND (c.tid IS NOT NULL OR b.tid IS NOT NULL)
)"""

ORACLES = {
    "rerun_set": f"""WITH RECURSIVE {_TABLES}, {_BELOW}
SELECT business_name, batch, tid, status, level FROM i JOIN (SELECT business_name, batch, tid, min(level) AS level FROM walk GROUP BY ALL) USING (business_name, batch, tid)""",
    "stalled_instances": f"WITH RECURSIVE {_TABLES}, {_BELOW}, {_STALLED} SELECT * FROM stalled",
    "batch_outlook": f"""WITH RECURSIVE {_TABLES}, {_BELOW}, {_STALLED}, counted AS (
  SELECT business_name, batch, count(*) FILTER (status <> 'finish') AS unfinished, count(cause) AS stalled,
    count(*) FILTER (status = 'init' AND cause IS NULL) AS moving, count(*) FILTER (cause LIKE 'cycle%') AS cyclic
  FROM i LEFT JOIN stalled USING (business_name, batch, tid) GROUP BY business_name, batch
) SELECT business_name, batch, CASE WHEN unfinished = 0 THEN 'done' WHEN moving = 0 THEN 'stalled' ELSE 'open' END AS state,
  CASE WHEN unfinished > 0 AND moving = 0 THEN CASE WHEN cyclic > 0 THEN 'cycle' ELSE 'error' END END AS cause, unfinished, stalled FROM counted""",
    "deciding_chain": f"""WITH RECURSIVE {_TABLES}, done AS (SELECT * FROM i WHERE status = 'finish'), ranked AS (
  SELECT c.business_name, c.batch, c.tid, p.tid AS parent_id, p.start_time, p.finish_time,
    row_number() OVER (PARTITION BY c.business_name, c.batch, c.tid ORDER BY p.finish_time DESC, p.tid) AS place
  FROM e JOIN done c ON c.business_name = e.business_name AND c.batch = e.batch AND c.tid = e.tid
  JOIN done p ON p.business_name = e.business_name AND p.batch = e.batch AND p.tid = e.parent_id
  WHERE p.finish_time <= c.start_time AND (p.finish_time < c.finish_time OR p.tid < c.tid)
), ends AS (SELECT *, row_number() OVER (PARTITION BY business_name, batch ORDER BY finish_time DESC, tid) AS place FROM done),
chain(business_name, batch, place, tid, start_time, finish_time) AS (
  SELECT business_name, batch, 0, tid, start_time, finish_time FROM ends WHERE place = 1
  UNION ALL SELECT r.business_name, r.batch, c.place + 1, r.parent_id, r.start_time, r.finish_time
  FROM chain c JOIN ranked r ON r.business_name = c.business_name AND r.batch = c.batch AND r.tid = c.tid AND r.place = 1
) SELECT * FROM chain""",
}
