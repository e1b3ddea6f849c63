"""Slices: what an overwrite replaces, what it leaves, and that running it again changes nothing."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from slicehouse.session import scratch_folder, scratch_name, shared_folder
from slicehouse.sinks.warehouse import (
    append_rows,
    create_table_if_absent,
    overwrite_slice,
    overwrite_slices,
    overwrite_table,
    replace_rows,
)
from slicehouse.sources.warehouse import (
    MissingSlice,
    data_schema,
    existing_slices,
    has_slice,
    missing_slices,
    partition_columns,
    read_slice,
    require_slice,
)


def new_table(spark, columns="id int, name string", keys=("pt",), format="parquet"):
    name = scratch_name(spark, "t")
    assert create_table_if_absent(spark, name, StructType.fromDDL(columns), keys, format)
    return name


def content(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def people(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string")


@pytest.mark.parametrize("format", ["parquet", "orc"])
@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_overwrite_slice_touches_one_slice(spark, format, session_mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        name = new_table(spark, format=format)
        assert overwrite_slice(people(spark, 1, 2), name, pt="20240101") == 2
        assert overwrite_slice(people(spark, 3), name, pt="20240102") == 1
        for _ in range(2):
            assert overwrite_slice(people(spark, 4), name, pt="20240101") == 1
            assert content(spark, name) == [(3, "n3", "20240102"), (4, "n4", "20240101")]
        for _ in range(2):
            assert overwrite_slice(people(spark).limit(0), name, pt="20240102") == 0
            assert content(spark, name) == [(4, "n4", "20240101")]
        assert has_slice(spark, name, pt="20240102")
        assert overwrite_slice(people(spark), name, pt="20240103") == 0
        assert has_slice(spark, name, pt="20240103")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_columns_go_by_name(spark):
    name = new_table(spark)
    swapped = people(spark, 1).select("name", F.col("id").alias("ID"), F.lit(0).alias("extra"))
    overwrite_slice(swapped, name, pt="1")
    assert content(spark, name) == [(1, "n1", "1")]
    with pytest.raises(ValueError, match="name"):
        overwrite_slice(people(spark, 2).select("id"), name, pt="1")
    with pytest.raises(ValueError, match="partitioned"):
        overwrite_slice(people(spark, 2), name, day="1")
    with pytest.raises(ValueError, match="partitioned"):
        overwrite_table(people(spark, 2), name)


def test_a_failed_load_leaves_the_old_slice(spark):
    name = new_table(spark)
    overwrite_slice(people(spark, 1, 2), name, pt="1")
    broken = people(spark, 3, 4).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(PySparkException):
        overwrite_slice(broken, name, pt="1")
    assert content(spark, name) == [(1, "n1", "1"), (2, "n2", "1")]


def test_a_slice_can_be_made_from_its_own_table(spark):
    name = new_table(spark)
    overwrite_slice(people(spark, 1, 2), name, pt="1")
    overwrite_slice(people(spark, 5), name, pt="2")
    overwrite_slice(spark.table(name).where("pt = '1' AND id = 2"), name, pt="1")
    assert content(spark, name) == [(2, "n2", "1"), (5, "n5", "2")]


def test_dynamic_slices(spark):
    name = new_table(spark)
    rows = people(spark, 1, 1, 2).withColumn("op_date", F.format_string("2024-01-0%d", "id"))
    pt = {"pt": F.replace("op_date", F.lit("-"), F.lit(""))}
    assert overwrite_slices(rows, name, pt, distinct=True) == 2
    assert overwrite_slices(rows.where("id = 2").withColumn("name", F.lit("new")), name, pt) == 1
    assert overwrite_slices(rows.where("id = 9"), name, pt) == 0
    assert content(spark, name) == [(1, "n1", "20240101"), (2, "new", "20240102")]


@pytest.mark.parametrize("whole_prefix", [False, True])
def test_mixed_slices(spark, whole_prefix):
    name = new_table(spark, keys=("pt", "loc"))
    rows = people(spark, 1, 2).withColumn("loc", F.concat(F.lit("l"), "id"))
    overwrite_slices(rows, name, pt="1")
    overwrite_slices(rows, name, pt="2")
    overwrite_slices(rows.where("id = 1").withColumn("name", F.lit("new")), name, pt="1", whole_prefix=whole_prefix)
    rest = [] if whole_prefix else [(2, "n2", "1", "l2")]
    assert content(spark, name) == sorted([(1, "n1", "2", "l1"), (2, "n2", "2", "l2"), (1, "new", "1", "l1"), *rest], key=str)


def test_one_slice_holds_most_rows(spark):
    """The hot slice is written by several tasks, so that it has several files."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        name = new_table(spark, "id bigint, name string")
        rows = spark.range(0, 200_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit("hot").alias("pt"))
        rows = rows.unionByName(spark.range(100).select("id", F.lit("x").alias("name"), (F.col("id") % 5).cast("string").alias("pt")))
        assert overwrite_slices(rows, name) == 200_100
        files = spark.table(name).select("pt", F.input_file_name().alias("file")).distinct().groupBy("pt").count()
        counts = {row.pt: row["count"] for row in files.collect()}
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert counts.pop("hot") > 3
    assert set(counts.values()) == {1}
    assert spark.table(name).count() == 200_100


def test_replace_rows_in_slices(spark):
    name = new_table(spark, "id int, name string", ("data_date",))
    rows = spark.createDataFrame(
        [(1, "a", "d1"), (2, None, "d1"), (3, "b", "d2"), (4, "a", "d3"), (5, "c", None), (6, "a", None)],
        "id int, name string, data_date string",
    )
    overwrite_slices(rows, name)
    new = spark.createDataFrame([(7, "a", "d2"), (8, "z", "d4")], rows.schema)
    for _ in range(2):
        added = replace_rows(new, name, "name = :name OR name = 'z' OR id = 7", {"name": "a"})
        assert added == 2
        expected = [(2, None, "d1"), (3, "b", "d2"), (7, "a", "d2"), (8, "z", "d4"), (5, "c", None)]
        assert content(spark, name) == sorted(expected, key=str)


def test_replace_rows_without_new_ones(spark):
    name = new_table(spark, "id int", ("pt", "loc"))
    rows = spark.createDataFrame([(1, "1", "a"), (2, "1", "b"), (3, "2", "a")], "id int, pt string, loc string")
    overwrite_slices(rows, name)
    assert replace_rows(rows.limit(0), name, "pt = '1'") == 0
    assert content(spark, name) == [(3, "2", "a")]
    assert replace_rows(rows.limit(0), name, "id = 99") == 0
    assert content(spark, name) == [(3, "2", "a")]


def test_replace_rows_reads_only_touched_slices(spark):
    name = new_table(spark, "id int", ("pt",))
    overwrite_slices(spark.createDataFrame([(i, str(i)) for i in range(5)], "id int, pt string"), name)
    before = {row.pt: row.file for row in spark.table(name).select("pt", F.input_file_name().alias("file")).collect()}
    replace_rows(spark.createDataFrame([(9, "3")], "id int, pt string"), name, "pt = '3'")
    after = {row.pt: row.file for row in spark.table(name).select("pt", F.input_file_name().alias("file")).collect()}
    assert {pt for pt in before if before[pt] != after[pt]} == {"3"}


def test_replace_rows_unpartitioned(spark):
    name = new_table(spark, keys=())
    there = {table.name for table in spark.catalog.listTables(name.split(".")[0])}
    overwrite_table(people(spark, 1, 2, 3), name)
    for _ in range(2):
        assert replace_rows(people(spark, 2, 9), name, "id IN (2, 3, 9)") == 2
        assert content(spark, name) == [(1, "n1"), (2, "n2"), (9, "n9")]
    assert replace_rows(people(spark).limit(0), name, "id = 9") == 0
    assert content(spark, name) == [(1, "n1"), (2, "n2")]
    assert {table.name for table in spark.catalog.listTables(name.split(".")[0])} == there


def test_replace_rows_takes_unsteady_rows_once(spark):
    """New rows that come out differently each time must not cost a slice its old rows."""
    name = new_table(spark, "id int", ("pt",))
    overwrite_slices(spark.createDataFrame([(i, str(i % 10)) for i in range(100)], "id int, pt string"), name)
    for seed in range(3):
        unsteady = spark.range(2).select(F.lit(1000 + seed).alias("id"), F.floor(F.rand() * 10).cast("string").alias("pt"))
        assert replace_rows(unsteady, name, f"id = {1000 + seed}") == 2
    assert spark.table(name).where("id < 1000").count() == 100
    assert spark.table(name).count() == 106


def test_full_overwrite_and_append(spark):
    name = new_table(spark, keys=())
    assert overwrite_table(people(spark, 1, 2), name) == 2
    assert append_rows(people(spark, 3).select("name", "id"), name) == 1
    assert content(spark, name) == [(1, "n1"), (2, "n2"), (3, "n3")]
    assert overwrite_table(people(spark), name) == 0
    assert content(spark, name) == []


def test_created_tables_keep_comments(spark):
    name = scratch_name(spark, "noted")
    notes = ["it's", "back\\slash", 'quo"te', None]
    schema = StructType()
    for place, note in enumerate(notes):
        schema.add(f"c {place}", IntegerType(), True, {"comment": note} if note else None)
    folder = scratch_folder(spark)
    assert create_table_if_absent(spark, name, schema, ("pt",), "orc", "a 'table'", folder)
    assert not create_table_if_absent(spark, name, schema)
    columns = spark.catalog.listColumns(name)
    assert [column.description for column in columns] == [*notes, None]
    assert [column.isPartition for column in columns] == [False] * 4 + [True]
    table = spark.catalog.getTable(name)
    assert (table.description, table.tableType) == ("a 'table'", "EXTERNAL")
    assert partition_columns(spark, name) == ["pt"] and len(data_schema(spark, name)) == 4


def test_slices_and_gate(spark):
    name = new_table(spark, "id int", ("pt", "loc"))
    odd = "a/b=c:d +%x é"
    overwrite_slices(spark.createDataFrame([(1, "1", "n"), (2, "1", odd), (3, "2", None)], "id int, pt string, loc string"), name)
    assert set(map(tuple, existing_slices(spark, name).collect())) == {("1", "n"), ("1", odd), ("2", None)}
    wanted = spark.createDataFrame([("1",), ("2",), ("3",), ("3",)], "pt string")
    assert [row.pt for row in missing_slices(wanted, name).collect()] == ["3"]
    assert has_slice(spark, name, pt="1", loc=odd) and has_slice(spark, name, pt="1") and not has_slice(spark, name, pt="7")
    require_slice(spark, name, pt="1")
    with pytest.raises(MissingSlice):
        require_slice(spark, name, pt="3")
    assert [row.id for row in read_slice(spark, name, columns=["id"], pt="1", loc=odd).collect()] == [2]
    assert read_slice(spark, name, "id > :low", {"low": 1}, loc=None).count() == 1
    with pytest.raises(ValueError):
        existing_slices(spark, new_table(spark, keys=()))


def test_slice_condition_prunes_folders(spark):
    name = new_table(spark, "id int", ("pt",))
    overwrite_slices(spark.createDataFrame([(i, str(i)) for i in range(5)], "id int, pt string"), name)
    plan = read_slice(spark, name, pt="3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pt" in plan
    assert len(read_slice(spark, name, pt="3").inputFiles()) >= 1
    assert read_slice(spark, name, pt="3").count() == 1


def test_tables_live_in_the_shared_folder(spark):
    name = new_table(spark)
    location = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first().data_type
    assert os.path.abspath(location.removeprefix("file:")).startswith(shared_folder(spark).removeprefix("file:"))
