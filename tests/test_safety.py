"""What stays when a write fails, what is refused instead of being cut, and batches that are taken up again."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slicehouse.functions.calendar import shift_days
from slicehouse.functions.columns import label_by_values
from slicehouse.plans.jobs import import_rows, ingest_batch, ingest_manifest, ledger_state, load_specs
from slicehouse.plans.specs import ImportSpec, LoadSpec
from slicehouse.plans.statements import run_step
from slicehouse.session import scratch_folder, scratch_name
from slicehouse.sinks import warehouse
from slicehouse.sinks.warehouse import append_rows, create_table_if_absent, overwrite_all, overwrite_table, replace_rows, sweep_folders
from slicehouse.sources.manifest import read_manifest
from slicehouse.sources.warehouse import read_slice


def new_table(spark, columns, keys=(), format="orc"):
    name = scratch_name(spark, "safe")
    create_table_if_absent(spark, name, StructType.fromDDL(columns), keys, format)
    return name


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=str)


def failing(spark, columns="id"):
    made = F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("no such row")).cast("bigint"))
    return spark.range(10).withColumn("id", made)


@pytest.mark.parametrize("format", ["orc", "parquet"])
def test_a_failing_source_leaves_an_unpartitioned_table(spark, format):
    table = new_table(spark, "id bigint", format=format)
    append_rows(spark.range(3), table)
    for write in (
        lambda: overwrite_table(failing(spark), table),
        lambda: replace_rows(failing(spark), table, "id = 1"),
        lambda: run_step(spark, "SELECT CASE WHEN id < 1 THEN id ELSE raise_error('no') END AS id FROM {t}", {}, table, t=spark.table(table)),
    ):
        with pytest.raises(Exception):
            write()
        assert rows_of(spark, table) == [(0,), (1,), (2,)]
    assert replace_rows(spark.range(7, 9), table, "id = 1") == 2
    assert rows_of(spark, table) == [(0,), (2,), (7,), (8,)]
    assert overwrite_table(spark.table(table).where("id > 2"), table) == 2  # from the table itself
    assert rows_of(spark, table) == [(7,), (8,)]
    assert overwrite_table(spark.range(0), table) == 0 and rows_of(spark, table) == []


class Killed(BaseException):
    """What no step of the library catches."""


def folders_of(spark, table):
    place = warehouse._location(spark, table)
    files, path = warehouse._folder(spark, warehouse._stem(place))
    names = [found.getPath().getName() for found in files.listStatus(path.getParent())]
    return {name for name in names if warehouse._stem(name) == path.getName()}, place.rsplit("/", 1)[-1]


STEPS = ["_insert", "_point_to", "_remove"]


@pytest.mark.parametrize("step, after", [(step, after) for step in STEPS for after in (False, True)])
def test_a_kill_between_any_two_steps_leaves_old_or_new_rows(spark, monkeypatch, step, after):
    table = new_table(spark, "id bigint")
    append_rows(spark.range(3), table)
    overwrite_table(spark.range(4), table)
    real = getattr(warehouse, step)

    def dying(*given, **named):
        if after:
            real(*given, **named)
        raise Killed

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, step, dying)
        with pytest.raises(Killed):
            overwrite_table(spark.range(9), table)
    new = step == "_remove" or (step == "_point_to" and after)
    assert rows_of(spark, table) == [(i,) for i in range(9 if new else 4)]
    every, current = folders_of(spark, table)
    left = every - {current}
    assert sweep_folders(spark, table) == []  # all of it is younger than a day
    assert {place.rsplit("/", 1)[-1] for place in sweep_folders(spark, table, datetime.timedelta(0))} == left
    assert folders_of(spark, table)[0] == {current}
    assert rows_of(spark, table) == [(i,) for i in range(9 if new else 4)]
    assert overwrite_table(spark.range(2), table) == 2 and rows_of(spark, table) == [(0,), (1,)]


def test_an_unsure_change_keeps_the_rows(spark, monkeypatch):
    """The catalog changes the location and then fails to say so: the new folder must not be removed."""
    table = new_table(spark, "id bigint", format="parquet")
    append_rows(spark.range(3), table)
    real = warehouse._point_to

    def unsure(*given):
        real(*given)
        raise OSError("timeout")

    monkeypatch.setattr(warehouse, "_point_to", unsure)
    with pytest.raises(OSError):
        overwrite_table(spark.range(5), table)
    assert rows_of(spark, table) == [(i,) for i in range(5)]
    monkeypatch.setattr(warehouse, "_point_to", lambda *given: (_ for _ in ()).throw(OSError("refused")))
    with pytest.raises(OSError):
        overwrite_table(spark.range(7), table)
    assert rows_of(spark, table) == [(i,) for i in range(5)]
    every, current = folders_of(spark, table)
    assert current in every and len(every) == 2  # the first folder is left, as nobody knew; the refused one is gone


def test_sweeping_spares_tables_of_like_names(spark):
    table = new_table(spark, "id bigint")
    longer = f"{table}__v2"
    create_table_if_absent(spark, longer, StructType.fromDDL("id bigint"), ())
    for name in (table, longer):
        append_rows(spark.range(3), name)
        for count in (4, 5):
            overwrite_table(spark.range(count), name)
    sweep_folders(spark, table, datetime.timedelta(0))
    assert rows_of(spark, table) == rows_of(spark, longer) == [(i,) for i in range(5)]
    spark.sql(f"DROP TABLE {table}")
    assert rows_of(spark, longer) == [(i,) for i in range(5)]


def test_a_failing_last_write_leaves_slices(spark, monkeypatch):
    table = new_table(spark, "id bigint", ("pt",), "parquet")
    append_rows(spark.range(6).withColumn("pt", (F.col("id") % 3).cast("string")), table)
    before = rows_of(spark, table)
    new = spark.range(50, 52).withColumn("pt", F.lit("0"))
    real = warehouse._insert

    def broken(rows, name, *rest, **named):
        if name == table:
            raise OSError("no space")
        return real(rows, name, *rest, **named)

    monkeypatch.setattr(warehouse, "_insert", broken)
    with pytest.raises(OSError):
        replace_rows(new, table, "pt IN ('0', '1')")
    assert rows_of(spark, table) == before
    with pytest.raises(RuntimeError, match="kept in") as told:
        overwrite_all(new, table)
    assert rows_of(spark, table) == before
    assert rows_of(spark, str(told.value).split()[-1]) == [(50, "0"), (51, "0")]
    monkeypatch.undo()
    replace_rows(new, table, "pt IN ('0', '1')")
    assert rows_of(spark, table) == [(2, "2"), (5, "2"), (50, "0"), (51, "0")]


def test_many_emptied_slices_go_by_one_statement(spark, monkeypatch):
    table = new_table(spark, "id bigint", ("pt", "loc"), "parquet")
    append_rows(spark.range(80).selectExpr("id", "cast(id as string) pt", "if(id = 3, null, 'x') loc"), table)
    inserts = []
    real = warehouse._insert
    monkeypatch.setattr(warehouse, "_insert", lambda *given, **named: (inserts.append(given[1]), real(*given, **named)))
    assert replace_rows(spark.range(0).selectExpr("id", "'' pt", "'' loc"), table, "id < 50") == 0
    assert sorted(row[0] for row in rows_of(spark, table)) == list(range(50, 80))
    assert len(inserts) <= 1  # for the slice whose name is null


def test_a_step_keeps_the_definition_of_its_table(spark):
    table = new_table(spark, "id bigint COMMENT 'key'", ("pt",), "parquet")
    append_rows(spark.range(4).selectExpr("id", "'a' pt"), table)
    run_step(spark, "SELECT id + 10 AS id, 'b' AS pt FROM {t} WHERE id < ${n}", {"n": "2"}, table, t=spark.table(table))
    assert rows_of(spark, table) == [(10, "b"), (11, "b")]
    columns = {column.name: column for column in spark.catalog.listColumns(table)}
    assert columns["pt"].isPartition and columns["id"].description == "key"


def test_import_of_a_source_with_its_own_pt(spark):
    source = spark.createDataFrame([(1, "own")], "id int, pt string")
    plain = scratch_name(spark, "plain")
    import_rows(source, ImportSpec(plain, "src"))
    assert rows_of(spark, plain) == [(1, "own")]
    sliced = scratch_name(spark, "sliced")
    with pytest.raises(ValueError, match="pt"):
        import_rows(source, ImportSpec(sliced, "src", pt="20240101"))
    import_rows(source, ImportSpec(sliced, "src", pt="20240101", extra="drop"))
    assert rows_of(spark, sliced) == [(1, "20240101")]
    mapped = new_table(spark, "id int, own string", ("pt",), "parquet")
    import_rows(source, ImportSpec(mapped, "src", pt="20240101", mapping={"own": "pt"}))
    assert rows_of(spark, mapped) == [(1, "own", "20240101")]


def test_import_of_a_source_that_grew(spark):
    table = new_table(spark, "id int", ("pt",), "parquet")
    source = spark.createDataFrame([(1, "x")], "id int, added string")
    with pytest.raises(ValueError, match="added"):
        import_rows(source, ImportSpec(table, "src", pt="20240101"))
    import_rows(source, ImportSpec(table, "src", pt="20240101", extra="drop"))
    assert rows_of(spark, table) == [(1, "20240101")]
    with pytest.raises(ValueError):
        ImportSpec(table, "src", extra="ignore")


def test_batches_of_one_day_stand_side_by_side(spark):
    table = new_table(spark, "id int", ("pt",), "parquet")
    for batch, ids in (("202401031000", [1]), ("202401031005", [2]), ("2024010311", [3])):
        source = spark.createDataFrame([(i,) for i in ids], "id int")
        ledger = ingest_manifest(spark, [LoadSpec(table, "db", "x", "'#{pt}' <> ''")], {"db": lambda _: source}, "b", batch)
        assert ledger.first().status == "finish", ledger.first().message
    assert rows_of(spark, table) == [(1, "202401031000"), (2, "202401031005"), (3, "20240103")]


def test_manifest_lines_keep_all_mappings(spark):
    folder = scratch_folder(spark) + "/manifest"
    lines = ["dw.a|c|s.a|x = 1|t1:s1|t2:s2", "dw.b|c|s.b||t3:concat(a, ':')", " ", "dw.c|c|s.c|"]
    spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(folder)
    first, second, third = load_specs(read_manifest(spark, folder))
    assert (first.where_condition, first.mapping) == ("x = 1", {"t1": "s1", "t2": "s2"})
    assert (second.where_condition, second.mapping) == (None, {"t3": "concat(a, ':')"})
    assert (third.where_condition, third.mapping) == (None, {})


def test_two_sources_of_one_table_are_both_loaded(spark):
    table = new_table(spark, "id int", ("pt",), "parquet")
    ledger = scratch_name(spark, "ledger")
    tables = {"a": spark.createDataFrame([(1, "2024-01-01")], "id int, op_date string")}
    specs = [LoadSpec(table, "db", name, layout="derived") for name in ("a", "b")]
    read = {"db": lambda name: tables[name]}
    assert not ingest_batch(spark, specs, read, "daily", "20240101", ledger)
    states = lambda: {row.db_table: row.status for row in ledger_state(spark.table(ledger)).collect()}
    assert states() == {"a": "finish", "b": "error"}
    tables["b"] = spark.createDataFrame([(2, "2024-01-02")], "id int, op_date string")
    assert ingest_batch(spark, specs, read, "daily", "20240101", ledger)
    assert states() == {"a": "finish", "b": "finish"}
    assert rows_of(spark, table) == [(1, "20240101"), (2, "20240102")]


def test_outcomes_are_recorded_as_tables_end(spark):
    table, other = new_table(spark, "id int", ("pt",), "parquet"), new_table(spark, "id int", ("pt",), "parquet")
    ledger = scratch_name(spark, "ledger")
    source = spark.createDataFrame([(1,)], "id int")

    def read(name):
        if name == "late":
            raise KeyboardInterrupt  # as if the driver died
        return source

    with pytest.raises(KeyboardInterrupt):
        ingest_batch(spark, [LoadSpec(table, "db", "first"), LoadSpec(other, "db", "late")], {"db": read}, "daily", "20240101", ledger, at_once=1)
    assert {row.db_table: row.status for row in ledger_state(spark.table(ledger)).collect()} == {"first": "finish", "late": "ready"}


def test_errors_keep_their_text(spark):
    table = new_table(spark, "id int", ("pt",), "parquet")

    def read(name):
        raise ValueError("first line\nsecond line")

    assert ingest_manifest(spark, [LoadSpec(table, "db", "x")], {"db": read}, "b", "20240101").first().message.endswith("second line")


def test_days_ago_in_a_zone_that_skips_an_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.createDataFrame([("202403110230",)], "t string").select(
            shift_days("t", "yyyyMMddHHmm", 1, "yyyyMMddHHmm").alias("a"), shift_days("t", "yyyyMMddHHmm", 1, "yyyy-MM-dd HH:mm:ss").alias("b")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("202403100230", "2024-03-10 02:30:00")


def test_labels_of_an_empty_mapping(spark):
    assert spark.range(1).select(label_by_values(F.col("id"), {}).alias("x")).first().x is None


def test_partition_columns_with_the_names_of_parameters(spark):
    table = new_table(spark, "id bigint", ("table", "columns"), "parquet")
    at = {"table": "a", "columns": "b"}
    assert warehouse.overwrite_slice(spark.range(2), table, at=at) == 2
    assert warehouse.overwrite_slices(spark.range(3).withColumn("columns", F.lit("c")), table, at={"table": "a"}) == 3
    assert read_slice(spark, table, at=at).count() == 2 and spark.table(table).count() == 5
