"""Rows that differ between two tables, against counting all rows; equal ranges are read once."""

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from slicehouse.operators import reconcile
from slicehouse.operators.reconcile import differing_rows

SCHEMA = "id bigint, day date, at timestamp_ntz, name string, value double, more decimal(10,2)"


def rows_of(seed, count):
    rng = random.Random(seed)
    out = []
    for i in range(count):
        day = datetime.date(2023, 1, 1) + datetime.timedelta(days=rng.randrange(500))
        at = datetime.datetime(2023, 3, 26, 1) + datetime.timedelta(microseconds=rng.randrange(10**13))
        out.append((rng.choice([i, i, i, 77, None]), day, at, rng.choice([None, "", f"n{i}"]), rng.choice([None, 0.0, -0.0, float("nan"), i / 3]), None))
    return out


def changed(rows, seed, share):
    rng = random.Random(seed)
    out = []
    for row in rows:
        kind = rng.random()
        if kind < share / 3:
            continue
        out += [row[:3] + ("changed",) + row[4:]] if kind < 2 * share / 3 else [row] * (2 if kind < share else 1)
    rng.shuffle(out)
    return out


def counted(rows):
    return collections.Counter(tuple(0.0 if value == 0 else str(value) for value in row) for row in rows)


@pytest.mark.parametrize("key", ["id", "day", "at", "name"])
def test_against_counting_all_rows(spark, key):
    for share, settings in ((0.0, {}), (0.02, {"few": 5, "fanout": 4}), (0.5, {"few": 5, "fanout": 4, "ranges": 6})):
        left = rows_of(1, 600)
        right = changed(left, 2, share)
        names = [name.split()[0] for name in SCHEMA.split(", ")]
        a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).select(*reversed(names))
        got = [tuple(row) for row in differing_rows(a, b, key, **settings).collect()]
        want, other = counted(left) - counted(right), counted(right) - counted(left)
        for side, expected in (("left", want), ("right", other)):
            own = collections.Counter()
            for row in got:
                if row[0] == side:
                    own += collections.Counter({key_: row[1] for key_ in counted([row[2:]])})
            assert own == expected, (key, share, side)
        assert len(got) == len(want) + len(other)


def test_empty_and_one_sided(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, v string")
    assert differing_rows(rows, rows, "id").count() == 0
    assert differing_rows(rows.limit(0), rows.limit(0), "ID").count() == 0
    got = {tuple(row) for row in differing_rows(rows, rows.limit(0), "id").collect()}
    assert got == {("left", 2, 1, "a"), ("left", 1, 2, None)}
    nulls = spark.createDataFrame([(None, "a")], "id int, v string")
    assert [tuple(row) for row in differing_rows(nulls, rows.limit(0), "id").collect()] == [("left", 1, None, "a")]
    moved = spark.createDataFrame([(1, None, "x")], "id int, a string, b string"), spark.createDataFrame([(1, "x", None)], "id int, a string, b string")
    assert differing_rows(*moved, "id").count() == 2


def test_one_key_with_a_third_of_all_rows(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = differing_rows(rows, rows.where("v NOT IN (3000, 4000)"), "k", few=50)
    assert sorted(map(tuple, got.collect())) == [("left", 1, 5, 3000), ("left", 1, 4000, 4000)]


def test_equal_ranges_are_read_once(spark, monkeypatch):
    """Of 20,000 rows that differ in one place, the later rounds read the part around it, by a condition that reaches the scan."""
    asked = []
    real = reconcile._inside

    def inside(rows, key, place, ranges, nulls):
        found = real(rows, key, place, ranges, nulls)
        asked.append((ranges, found.count()))
        return found

    monkeypatch.setattr(reconcile, "_inside", inside)
    left = spark.range(20_000).withColumn("v", F.col("id") * 2)
    got = differing_rows(left, left.withColumn("v", F.when(F.col("id") == 12_345, 0).otherwise(F.col("v"))), "id", fanout=10, few=100)
    assert sorted(map(tuple, got.collect())) == [("left", 1, 12_345, 24_690), ("right", 1, 12_345, 0)]
    counts = [count for _, count in asked]
    assert counts[:4] == [20_000, 20_000, 2_000, 2_000] and sum(counts[4:]) <= 1_000
