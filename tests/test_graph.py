"""Questions along many edges, against plain searches: diamonds, hot parents, several batches, cycles and self-edges."""

import random

from pyspark.sql import functions as F

from slicehouse.operators import graph

INSTANCES = "business_name string, batch string, tid bigint, status string, start_time string, finish_time string"
EDGES = "business_name string, tid bigint, parent_id bigint"


def made(seed, nodes=14, cyclic=False):
    """Two businesses, two batches each; one of them lacks some instances."""
    rng = random.Random(seed)
    instances, edges = [], []
    for name in ("a", "b"):
        for tid in range(nodes):
            edges.append((name, tid, None))
            # Node 0 is above nearly all others; the rest makes diamonds.
            parents = {0, *rng.sample(range(nodes), 2)}
            edges += [(name, tid, p) for p in parents if (p < tid or (cyclic and rng.random() < 0.15)) and (p or rng.random() < 0.9)]
        edges.append((name, 3, 1))
        edges.append((name, 3, 1))
        for batch in ("b1", "b2"):
            for tid in range(nodes):
                if batch == "b2" and rng.random() < 0.2:
                    continue
                status = rng.choice(["finish"] * 4 + ["error", "init", "ready", "running", None])
                start = rng.randrange(40)
                instances.append((name, batch, tid, status, f"{start:03d}", f"{start + rng.randrange(8):03d}"))
    if cyclic:
        edges.append(("b", 5, 5))
    return instances, edges


def plain(instances, edges):
    """Per (business, batch): status by tid, times by tid, parents by tid."""
    out = {}
    for name, batch, tid, status, start, finish in instances:
        own = out.setdefault((name, batch), ({}, {}, {}))
        own[0][tid], own[1][tid] = status, (start, finish)
    for (name, _), (states, _, parents) in out.items():
        for other, tid, parent in edges:
            if other == name and parent is not None and tid in states and parent in states:
                parents.setdefault(tid, set()).add(parent)
    return out


def below(states, parents, start):
    level, found, frontier = 0, {}, set(start)
    while frontier:
        level += 1
        frontier = {t for t in states if parents.get(t, set()) & frontier} - set(found)
        found |= dict.fromkeys(frontier, level)
    return found


def held(states, parents):
    left = {t for t in states if states[t] != "finish"}
    while True:
        free = {t for t in left if not parents.get(t, set()) & left}
        if not free:
            return left
        left -= free


def frames(spark, seed, cyclic=False):
    instances, edges = made(seed, cyclic=cyclic)
    return instances, edges, spark.createDataFrame(instances, INSTANCES), spark.createDataFrame(edges, EDGES)


def test_rerun_set(spark):
    for seed, cyclic in ((1, False), (2, True)):
        instances, edges, i, e = frames(spark, seed, cyclic)
        want = set()
        for (name, batch), (states, _, parents) in plain(instances, edges).items():
            failed = [t for t in states if states[t] == "error"]
            levels = below(states, parents, failed) | dict.fromkeys(failed, 0)
            want |= {(name, batch, tid, states[tid], level) for tid, level in levels.items()}
        got = [tuple(row) for row in graph.rerun_set(i, e).select("business_name", "batch", "tid", "status", "level").collect()]
        assert set(got) == want and len(got) == len(want)


def test_stalled_and_outlook(spark):
    for seed, cyclic in ((3, False), (4, True)):
        instances, edges, i, e = frames(spark, seed, cyclic)
        want, outlook = set(), set()
        for (name, batch), (states, _, parents) in plain(instances, edges).items():
            cycles = held(states, parents)
            errors = below(states, parents, [t for t in states if states[t] == "error"])
            causes = {}
            for tid, state in states.items():
                if state not in ("finish", "error") and (tid in cycles or tid in errors):
                    causes[tid] = " and ".join([word for word, there in (("cycle", tid in cycles), ("error", tid in errors)) if there])
            want |= {(name, batch, tid, cause) for tid, cause in causes.items()}
            open_ = [t for t in states if states[t] != "finish"]
            moving = [t for t in open_ if states[t] != "error" and t not in causes]
            state = "done" if not open_ else "open" if moving else "stalled"
            cause = ("cycle" if any(c.startswith("cycle") for c in causes.values()) else "error") if state == "stalled" else None
            outlook.add((name, batch, state, cause, len(open_), len(causes)))
        assert {tuple(row) for row in graph.stalled_instances(i, e).collect()} == want
        assert {tuple(row) for row in graph.batch_outlook(i, e).collect()} == outlook


def test_a_self_edge_and_a_cycle_alone(spark):
    rows = [("a", "b1", 1, "init"), ("a", "b1", 2, "init"), ("a", "b1", 3, "finish"), ("a", "b2", 4, "init"), ("a", "b3", 5, "finish"), ("a", "b4", 6, "error"), ("a", "b4", 7, "init")]
    i = spark.createDataFrame([(*row, None, None) for row in rows], INSTANCES)
    e = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("a", 1, 3), ("a", 4, 4), ("a", 5, 5), ("a", 7, 6)], EDGES)
    got = {tuple(row) for row in graph.batch_outlook(i, e).collect()}
    assert got == {("a", "b1", "stalled", "cycle", 2, 2), ("a", "b2", "stalled", "cycle", 1, 1), ("a", "b3", "done", None, 0, 0), ("a", "b4", "stalled", "error", 2, 1)}
    assert graph.rerun_set(i.limit(0), e).count() == 0


def test_deciding_chain(spark):
    for seed, cyclic in ((5, False), (6, True)):
        instances, edges, i, e = frames(spark, seed, cyclic)
        want = set()
        for (name, batch), (states, times, parents) in plain(instances, edges).items():
            done = {t for t in states if states[t] == "finish"}
            at, place = max(done, key=lambda t: (times[t][1], -t), default=None), 0
            while at is not None:
                want.add((name, batch, place, at, *times[at]))
                start, finish = times[at]
                before = [p for p in parents.get(at, ()) if p in done and times[p][1] <= start and (times[p][1] < finish or p < at)]
                at, place = max(before, key=lambda t: (times[t][1], -t), default=None), place + 1
        got = [tuple(row) for row in graph.deciding_chain(i, e).collect()]
        assert set(got) == want and len(got) == len(want)


def test_a_parent_of_all_does_not_multiply_rows(spark):
    """A third of all edges have one parent: the frontier's rows stay one for each instance."""
    count = 3000
    i = spark.range(count).select(F.lit("a").alias("business_name"), F.lit("b").alias("batch"), F.col("id").alias("tid"), F.when(F.col("id") == 0, "error").otherwise("init").alias("status"))
    e = i.where("tid > 0").select("business_name", "tid", F.lit(0).alias("parent_id")).union(i.where("tid > 1").select("business_name", "tid", (F.col("tid") - 1 - F.col("tid") % 2).alias("parent_id")))
    found = graph.rerun_set(i, e)
    assert found.count() == count and found.agg(F.max("level")).first()[0] == 1
