"""Writes into warehouse tables, each of which can be run again with the same result.

Every overwrite names its mode in the statement, so a session setting cannot turn the replacement of one slice into
the loss of all. Where slices are told by the data, rows are rebalanced on the partition columns first: few files per
slice, and Spark splits a slice that holds much more than the others over several tasks.
"""

from __future__ import annotations

import datetime
import re
import time
import uuid
import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from slicehouse import text
from slicehouse.functions.columns import ERRORS, align_to, conform, conform_or_reject, filter_with, holds, marked_with
from slicehouse.session import scratch_name, written
from slicehouse.sources.warehouse import data_schema, partition_columns


def create_table_if_absent(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: Sequence[str] = ("pt",),
    format: str = "orc",
    comment: str | None = None,
    location: str | None = None,
) -> bool:
    """Create a table with column and table comments; text partition columns are added to the schema.

    With a location the table is external. Returns whether the table was created.
    """
    if spark.catalog.tableExists(table):
        return False
    have = {field.name.lower() for field in schema}
    fields = [*schema, *[StructField(key, StringType()) for key in partition_by if key.lower() not in have]]

    clauses = [f"CREATE TABLE IF NOT EXISTS {text.name(table)} ({', '.join(map(_declared, fields))}) USING {format}"]
    if partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(map(text.column, partition_by))})")
    if location:
        clauses.append(f"LOCATION {text.literal(location)}")
    if comment:
        clauses.append(f"COMMENT {text.literal(comment)}")
    spark.sql(" ".join(clauses))
    return True


def _declared(field: StructField) -> str:
    note = (field.metadata or {}).get("comment")
    return f"{text.column(field.name)} {field.dataType.simpleString()}" + (f" COMMENT {text.literal(note)}" if note else "")


def _insert(rows: DataFrame, table: str, mode: str | None, partition: str = "") -> None:
    """``mode`` is static or dynamic for an overwrite, None for an append. Columns go by name."""
    head = f"INSERT INTO {text.name(table)}"
    if mode:
        head = f"INSERT OVERWRITE {text.name(table)} WITH ('partitionOverwriteMode' = '{mode}')"
    rows.sparkSession.sql(f"{head} {partition} BY NAME SELECT * FROM {{rows}}", rows=rows)


def _spec(slice_: Mapping[str, object]) -> str:
    return "PARTITION (" + ", ".join(f"{text.column(key)} = {text.literal(value)}" for key, value in slice_.items()) + ")"


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of with a second read."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _require_partitions(spark: SparkSession, table: str, given: Sequence[str]) -> None:
    keys = partition_columns(spark, table)
    if {key.lower() for key in keys} != {key.lower() for key in given}:
        raise ValueError(f"{table} is partitioned by {keys}, not by {list(given)}")


def append_rows(rows: DataFrame, table: str) -> int:
    """Add rows to a table by column name."""
    rows, seen = _counted(align_to(rows, rows.sparkSession.table(table).schema))
    _insert(rows, table, mode=None)
    return seen.get["rows"]


def overwrite_table(rows: DataFrame, table: str) -> int:
    """Replace all rows of an unpartitioned table.

    The rows are written into a new folder, which the table points to when all of them are there: until then, and if the job fails,
    the old rows stay, also for rows that are read from the table itself.
    """
    spark = rows.sparkSession
    _require_partitions(spark, table, [])
    rows, seen = _counted(align_to(rows, data_schema(spark, table)))
    _write_and_point(rows, table)
    return seen.get["rows"]


#: What the names of folders end in that a table was pointed to.
_VERSION = re.compile("__v[0-9a-f]{12}$")


def _stem(place: str) -> str:
    return _VERSION.sub("", place)


def _write_and_point(rows: DataFrame, table: str) -> None:
    """Fill a new folder of the table's format beside its folder, then let the table point to the new one.

    The change of the location is one statement to the catalog and the only step that readers see. Nothing is renamed, so no step takes longer
    on stores that rename by copying, and a driver that dies leaves the table with all of its old or all of its new rows. What it leaves beside them
    is a folder that no table points to, which ``sweep_folders`` removes.
    """
    spark = rows.sparkSession
    new = f"{_stem(_location(spark, table))}__v{uuid.uuid4().hex[:12]}"
    made = scratch_name(spark, "beside")
    spark.sql(f"CREATE TABLE {text.name(made)} LIKE {text.name(table)} LOCATION {text.literal(new)}")
    try:
        _insert(rows, made, mode=None)
        old = _location(spark, table)
        _point_to(spark, table, new)
    except Exception:
        # The catalog may have made the change and failed to say so.
        if _location(spark, table) != new:
            _remove(spark, new)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {text.name(made)}")
        spark.catalog.refreshTable(table)
    _remove(spark, old)


def _point_to(spark: SparkSession, table: str, place: str) -> None:
    spark.sql(f"ALTER TABLE {text.name(table)} SET LOCATION {text.literal(place)}")


def _folder(spark: SparkSession, place: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _remove(spark: SparkSession, place: str) -> None:
    files, path = _folder(spark, place)
    try:
        files.delete(path, True)
    except Exception as error:  # The table has its rows; what is left is for the next sweep.
        warnings.warn(f"{place} could not be removed: {error}", stacklevel=2)


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {text.name(table)}").collect()
    return next(row.data_type for row in reversed(described) if row.col_name == "Location").rstrip("/")


def sweep_folders(spark: SparkSession, table: str, older_than: datetime.timedelta = datetime.timedelta(days=1)) -> list[str]:
    """Remove folders beside a table that it was or was to be pointed to and does not point to now; returns them.

    A folder counts by its newest file. Overwrites that are at work have newer ones, if ``older_than`` is longer than a write can be silent, and
    so have the last rows that a long query may still be reading. The very first folder of a table has a plain name and is not looked at.
    """
    now_at = _location(spark, table)
    files, path = _folder(spark, _stem(now_at))
    limit = (time.time() - older_than.total_seconds()) * 1000
    removed = []
    for found in files.listStatus(path.getParent()) if files.exists(path.getParent()) else []:
        place = found.getPath()
        if not found.isDirectory() or _stem(place.getName()) != path.getName() or place.getName() == path.getName():
            continue
        if place.getName() == now_at.rsplit("/", 1)[-1] or _newest(files, found) > limit:
            continue
        files.delete(place, True)
        removed.append(place.toString())
    return sorted(removed)


def _newest(files, folder) -> int:
    newest, inside = folder.getModificationTime(), files.listFiles(folder.getPath(), True)
    while inside.hasNext():
        newest = max(newest, inside.next().getModificationTime())
    return newest


def overwrite_all(rows: DataFrame, table: str) -> int:
    """Replace all rows of a table, of all its slices if it has some. The old rows stay until the new ones are computed.

    Were the last step of a sliced table to fail, its new rows are kept in a scratch table, which the error names.
    """
    spark = rows.sparkSession
    keys = partition_columns(spark, table)
    if not keys:
        return overwrite_table(rows, table)
    counted, seen = _counted(conform(rows, spark.table(table).schema))
    aside = scratch_name(spark, "all")
    counted.write.format("parquet").saveAsTable(aside)
    _from_aside(spark, aside, lambda: _insert(spark.table(aside).hint("rebalance", *keys), table, "static"))
    return seen.get["rows"]


def _from_aside(spark: SparkSession, aside: str, step: Callable[[], None]) -> None:
    """A step that replaces rows with those of a scratch table, which is dropped only if the step succeeds."""
    try:
        step()
    except Exception as error:
        raise RuntimeError(f"the rows to be written are kept in {aside}") from error
    spark.sql(f"DROP TABLE IF EXISTS {text.name(aside)}")


def overwrite_slice(
    rows: DataFrame, table: str, rebalance: bool = False, at: Mapping[str, object] | None = None, **named: object
) -> int:
    """Replace exactly one slice; no rows leave an empty slice. Returns the number of rows written.

    The slice is given by name (``pt="20240101"``), or as the mapping ``at``, which takes any names.

    Rows are written by the tasks that have them, without a shuffle. Where a filter left those tasks with little,
    ``rebalance`` gives fewer and larger files.

    The rows take the place of the old ones when the job commits, so a job that fails half-way leaves the old slice.
    """
    spark, slice_ = rows.sparkSession, {**(at or {}), **named}
    _require_partitions(spark, table, list(slice_))
    placed = align_to(rows, data_schema(spark, table))
    counted, seen = _counted(placed.hint("rebalance") if rebalance else placed)
    _insert(counted.withColumns({key: F.lit(value) for key, value in slice_.items()}), table, mode="dynamic")
    written = seen.get["rows"]
    if written == 0:  # Without rows, the statement above touches no slice.
        _empty_slice(spark, table, slice_)
    return written


def _empty_slice(spark: SparkSession, table: str, slice_: Mapping[str, object]) -> None:
    _insert(spark.createDataFrame([], data_schema(spark, table)), table, "static", _spec(slice_))


#: What a table of rejects has beside its slices: what did not fit, and the whole source row as JSON.
REJECTS = f"errors {ERRORS}, source string"


def land_or_reject(
    rows: DataFrame, table: str, rejects: str, mapping: Mapping[str, str | Column] | None = None, at: Mapping[str, object] | None = None, **named: object
) -> tuple[int, int]:
    """Replace one slice of a table by the rows that fit its columns, and the same slice of ``rejects`` by those that do not.

    Returns how many went where; together they are all rows. The source is read once: its rows are written aside with what does not fit, and both slices
    are made from that. The table of rejects is made if it is not there. Its slice is written first, so what has landed is never without it.
    """
    spark, slice_ = rows.sparkSession, {**(at or {}), **named}
    _require_partitions(spark, table, list(slice_))
    create_table_if_absent(spark, rejects, StructType.fromDDL(REJECTS), list(slice_), "parquet")
    judged = written(conform_or_reject(rows, data_schema(spark, table), mapping, "errors of the row", "source of the row"))
    fits = F.size("errors of the row") == 0
    lost = judged.where(~fits).select(F.col("errors of the row").alias("errors"), F.col("source of the row").alias("source"))
    rejected = overwrite_slice(lost, rejects, at=slice_)
    return overwrite_slice(judged.where(fits).drop("errors of the row", "source of the row"), table, at=slice_), rejected


def grow_table(spark: SparkSession, table: str, fields: Sequence[StructField]) -> list[str]:
    """Add columns that a table lacks, by name without regard to case; returns their names. Slices from before read null in them.

    A column that it has must be able to hold what comes: a narrower type raises before anything is changed.
    """
    have = {field.name.lower(): field for field in spark.table(table).schema}
    narrow = [field for field in fields if field.name.lower() in have and not holds(have[field.name.lower()].dataType, field.dataType)]
    if narrow:
        told = [f"{field.name} {have[field.name.lower()].dataType.simpleString()} for {field.dataType.simpleString()}" for field in narrow]
        raise ValueError(f"{table} has columns too narrow for what comes: {', '.join(told)}")
    new = [field for field in fields if field.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {text.name(table)} ADD COLUMNS ({', '.join(map(_declared, new))})")
        spark.catalog.refreshTable(table)
    return [field.name for field in new]


def overwrite_slices(
    rows: DataFrame,
    table: str,
    derive: Mapping[str, Column] | None = None,
    distinct: bool = False,
    whole_prefix: bool = False,
    rebalance: bool = True,
    at: Mapping[str, object] | None = None,
    **named: object,
) -> int:
    """Replace those slices for which there are rows; slices without new rows stay as they are.

    ``derive`` computes partition columns from the row; leading ones may be given a constant
    (``pt="20240101"``, or the mapping ``at``, which takes any names). With ``whole_prefix``, all slices under the fixed values are replaced, also those that get no rows.
    ``distinct`` drops repeated rows before the write.
    """
    spark, fixed = rows.sparkSession, {**(at or {}), **named}
    keys = partition_columns(spark, table)
    if not keys:
        raise ValueError(f"{table} is not partitioned")
    derived = rows.withColumns(dict(derive or {}))
    free = [key for key in keys if key not in fixed]
    placed = align_to(derived, [*data_schema(spark, table).fieldNames(), *free])
    if distinct:
        placed = placed.distinct()
    if rebalance and free:
        placed = placed.hint("rebalance", *free)
    counted, seen = _counted(placed)
    if not fixed:
        _insert(counted, table, mode="dynamic")
    elif whole_prefix:
        given = [f"{text.column(key)} = {text.literal(value)}" for key, value in fixed.items()]
        _insert(counted, table, "static", f"PARTITION ({', '.join([*given, *map(text.column, free)])})")
    else:
        _insert(counted.withColumns({key: F.lit(value) for key, value in fixed.items()}), table, mode="dynamic")
    return seen.get["rows"]


def replace_rows(rows: DataFrame, table: str, where: str, params: Mapping[str, object] | None = None) -> int:
    """Delete the rows that satisfy a condition, then add the new ones. Returns the number of rows added.

    Rows for which the condition is null stay. An unpartitioned table is written anew and pointed to its new folder. In a partitioned
    table only those slices are rewritten which lose or gain rows; they take their new content together when the job
    commits, so a job that fails leaves the old rows. Slices that lose all of their rows are dropped after that, by one
    statement: should that one fail, running the whole again ends the work.
    """
    spark = rows.sparkSession
    keys = partition_columns(spark, table)
    target = StructType([*data_schema(spark, table), *[spark.table(table).schema[key] for key in keys]])
    old = spark.table(table).select(*map(text.column, target.fieldNames()))
    added, seen = _counted(conform(rows, target))
    kept = filter_with(old, f"NOT coalesce(({where}), false)", params)
    if not keys:
        _write_and_point(kept.unionByName(added), table)
        return seen.get["rows"]
    aside = scratch_name(spark, "added")
    try:
        # The new rows are written first: were they computed again later with other slices, those would lose what they had.
        added.write.format("parquet").saveAsTable(aside)
        new = spark.table(aside)
        # The catalog holds one entry per slice on the driver anyway, so these lists are no larger than what it has.
        gaining = _slices(new, keys)
        losing, emptied = _touched_slices(old, keys, where, params)
        rewritten = (losing - emptied) | gaining
        if rewritten:
            merged = kept.where(_in_slices(rewritten, keys)).unionByName(new)
            _insert(merged.hint("rebalance", *keys), table, mode="dynamic")
        _drop_slices(spark, table, emptied - gaining)
        return seen.get["rows"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {text.name(aside)}")


def _touched_slices(old: DataFrame, keys: Sequence[str], where: str, params: Mapping[str, object] | None) -> tuple[set[Row], set[Row]]:
    """The slices that lose rows by a condition, and those of them that lose all, from one pass over the table."""
    marked = marked_with(old, where, params, "row is doomed")
    found = marked.groupBy(*map(text.column, keys)).agg(
        F.bool_or("row is doomed").alias("slice loses rows"), F.bool_and("row is doomed").alias("slice loses all")
    )
    losing = found.filter(F.col("slice loses rows")).collect()
    slices = {Row(**{key: row[key] for key in keys}): row["slice loses all"] for row in losing}
    return set(slices), {slice_ for slice_, all_ in slices.items() if all_}


def _drop_slices(spark: SparkSession, table: str, slices: set[Row]) -> None:
    unnamed = [slice_ for slice_ in slices if None in slice_]
    if named := [_spec(slice_.asDict()) for slice_ in slices if None not in slice_]:
        spark.sql(f"ALTER TABLE {text.name(table)} DROP IF EXISTS {', '.join(named)}")
    for slice_ in unnamed:  # there is at most one for each value of the other keys
        _empty_slice(spark, table, slice_.asDict())


def _slices(rows: DataFrame, keys: Sequence[str]) -> set[Row]:
    return set(rows.select(*keys).distinct().collect())


def _in_slices(slices: set[Row], keys: Sequence[str]) -> Column:
    """A condition on partition columns only, so that Spark prunes the other slices at planning time."""
    leading, last = keys[:-1], keys[-1]
    groups: dict[tuple, list] = {}
    for row in slices:
        groups.setdefault(tuple(row[key] for key in leading), []).append(row[last])
    condition = F.lit(False)
    for prefix, values in groups.items():
        inside = F.col(last).isin([value for value in values if value is not None])
        if None in values:
            inside = F.coalesce(inside, F.lit(True))
        for key, value in zip(leading, prefix):
            inside &= F.col(key).eqNullSafe(F.lit(value))
        condition |= inside
    return condition
