"""Projections and predicates, all built-in expressions that stay in one stage with the scan."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    CharType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VarcharType,
)

# Types which land as text, and those which land as int; all others keep their type.
LANDS_AS_TEXT = (DateType, TimestampType, TimestampNTZType, CharType, VarcharType)
LANDS_AS_INT = (BooleanType, ByteType, ShortType)


def filter_with(rows: DataFrame, condition: str | None, params: Mapping[str, object] | None = None) -> DataFrame:
    """Keep rows that satisfy a Spark SQL condition with typed ``:name`` parameters. A blank one keeps all.

    Spark refuses a condition with a parameter that has no value.
    """
    if condition is None or not condition.strip():
        return rows
    if not params:
        return rows.where(condition)
    escaped = condition.replace("{", "{{").replace("}", "}}")
    return rows.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {escaped}", args=dict(params), rows=rows)


def marked_with(rows: DataFrame, condition: str, params: Mapping[str, object] | None, name: str) -> DataFrame:
    """Add whether a row satisfies such a condition; false where it is null."""
    escaped = condition.replace("{", "{{").replace("}", "}}") if params else condition
    flag = f"coalesce(({escaped}), false) AS `{name}`"
    if not params:
        return rows.selectExpr("*", flag)
    return rows.sparkSession.sql(f"SELECT *, {flag} FROM {{rows}}", args=dict(params), rows=rows)


def incremental(rows: DataFrame, column: str, day: datetime.date | str) -> DataFrame:
    """Rows of one day by a timestamp, date or ISO text column, as a half-open range that sources can evaluate."""
    start = datetime.date.fromisoformat(day) if isinstance(day, str) else day
    return between(rows, column, start, start + datetime.timedelta(days=1))


def look_back(rows: DataFrame, column: str, until: datetime.datetime | datetime.date, days: int) -> DataFrame:
    """Rows from midnight ``days`` days before ``until`` up to ``until``, which is not included."""
    day = until.date() if isinstance(until, datetime.datetime) else until
    return between(rows, column, day - datetime.timedelta(days=days), until)


def between(rows: DataFrame, column: str, start: object, end: object) -> DataFrame:
    """``start <= column < end``. The bounds take the column's type, so that no cast keeps them from the scan."""
    kind = rows.schema[column].dataType
    low, high = (F.lit(str(bound)).cast(kind) for bound in (start, end))
    return rows.where((F.col(column) >= low) & (F.col(column) < high))


def align_to(rows: DataFrame, target: StructType | Sequence[str]) -> DataFrame:
    """The target's columns in the target's order, by name without regard to case; a missing one is an error."""
    names = target.fieldNames() if isinstance(target, StructType) else list(target)
    have = {name.lower(): name for name in rows.columns}
    missing = [name for name in names if name.lower() not in have]
    if missing:
        raise ValueError(f"columns missing from the source: {missing}")
    return rows.select(*[_column(have[name.lower()]).alias(name) for name in names])


def map_columns(
    rows: DataFrame, mapping: Mapping[str, str | Column] | None, target: StructType | Sequence[str] | None = None
) -> DataFrame:
    """Fill target columns from other source columns or from expressions; unmapped ones come by their own name.

    Without ``target`` the mapped columns are added to, or replace, those of the source.
    """
    mapping = mapping or {}
    sources = {name: F.expr(value) if isinstance(value, str) else value for name, value in mapping.items()}
    if target is None:
        return rows.withColumns(sources)
    names = target.fieldNames() if isinstance(target, StructType) else list(target)
    have = {name.lower(): name for name in rows.columns}
    missing = [name for name in names if name not in sources and name.lower() not in have]
    if missing:
        raise ValueError(f"columns neither mapped nor in the source: {missing}")
    return rows.select(
        *[(sources[name] if name in sources else _column(have[name.lower()])).alias(name) for name in names]
    )


def mapped_sources(rows: DataFrame, mapping: Mapping[str, str | Column] | None) -> set[str]:
    """The source's columns, in lower case, that a mapping's expressions mention."""
    words = {word.lower() for value in (mapping or {}).values() for word in re.findall(r"\w+", str(value))}
    text = " ".join(str(value) for value in (mapping or {}).values()).lower()
    return {name.lower() for name in rows.columns if name.lower() in words or f"`{name.lower()}`" in text}


def refuse_extra(rows: DataFrame, target: StructType, mapping: Mapping[str, str | Column] | None, table: str) -> None:
    """An error if the source has columns that neither the target nor the mapping takes, as when a column was added to it."""
    if extra := extra_columns(rows, target, mapping):
        raise ValueError(f"{table} has no columns for {extra}; give extra='drop' to leave them out, or extra='add' to add them")


def extra_columns(rows: DataFrame, target: StructType, mapping: Mapping[str, str | Column] | None) -> list[str]:
    """The source's columns that neither the target nor the mapping takes."""
    taken = {name.lower() for name in target.fieldNames()} | mapped_sources(rows, mapping)
    return [name for name in rows.columns if name.lower() not in taken and name.lower() != "pt"]


def holds(target: DataType, source: DataType) -> bool:
    """Whether a column of one type can hold all values of another one without loss."""
    if source == target or isinstance(source, NullType):
        return True
    if isinstance(target, StringType):
        return not isinstance(source, (ArrayType, MapType, StructType))
    digits = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
    if own := digits.get(type(source)):
        if type(target) in digits:
            return digits[type(target)] > own
        return isinstance(target, DecimalType) and target.precision - target.scale >= own or isinstance(target, DoubleType) and own <= 10
    if isinstance(source, DecimalType):
        return isinstance(target, DecimalType) and target.scale >= source.scale and target.precision - target.scale >= source.precision - source.scale
    if isinstance(source, FloatType):
        return isinstance(target, DoubleType)
    return isinstance(source, DateType) and isinstance(target, (TimestampType, TimestampNTZType))


def conform(rows: DataFrame, target: StructType, mapping: Mapping[str, str | Column] | None = None) -> DataFrame:
    """The target's columns in its order and in its types, mapped where a mapping is given."""
    shaped = map_columns(rows, mapping, target)
    return shaped.select(
        *[
            _column(to.name) if field.dataType == to.dataType else _column(to.name).cast(to.dataType).alias(to.name)
            for field, to in zip(shaped.schema, target)
        ]
    )


#: The type of what is kept of values that do not fit.
ERRORS = "array<struct<column:string,value:string,type:string>>"


def conform_or_reject(
    rows: DataFrame, target: StructType, mapping: Mapping[str, str | Column] | None = None, errors: str = "errors", source: str = "source"
) -> DataFrame:
    """``conform``, but a value that does not fit its column's type is no error: it becomes null, and ``errors`` lists column, value and type.

    ``source`` has the whole source row as JSON where ``errors`` is not empty, else null. A null in the source fits any column.
    """
    names = [field.name for field in target]
    if clashing := {errors.lower(), source.lower()} & {name.lower() for name in names}:
        raise ValueError(f"the target has columns {sorted(clashing)}: give others for errors and source")
    raw, seen = "the source row", map_columns(rows, mapping, target)
    whole = F.to_json(F.struct(*map(_column, rows.columns)), {"ignoreNullFields": "false"})
    shaped = map_columns(rows.withColumn(raw, whole), {**(mapping or {}), raw: _column(raw)}, [*names, raw])
    tried = {to.name: _column(to.name) if seen.schema[to.name].dataType == to.dataType else _column(to.name).try_cast(to.dataType) for to in target}
    lost = [
        F.when(
            _column(to.name).isNotNull() & tried[to.name].isNull(),
            F.struct(F.lit(to.name).alias("column"), _column(to.name).cast("string").alias("value"), F.lit(to.dataType.simpleString()).alias("type")),
        )
        for to in target
        if seen.schema[to.name].dataType != to.dataType
    ]
    found = F.array_compact(F.array(*lost)) if lost else F.array().cast(ERRORS)
    kept = F.when(F.size(found) > 0, _column(raw))
    return shaped.select(*[tried[name].alias(name) for name in names], found.alias(errors), kept.alias(source))


def mapping_from_text(mapping: str | None) -> dict[str, str]:
    """``target:source|target:source`` as a dict. The source may hold colons, for instance in a time of day."""
    if not mapping or not mapping.strip():
        return {}
    pairs = (pair.split(":", 1) for pair in mapping.split("|") if pair.strip())
    return {target.strip(): source.strip() for target, source in pairs}


def guard_column(target: Sequence[str], available: Sequence[str], name: str = "data_date") -> list[str]:
    """The target's columns, with ``name`` only where the source offers it."""
    have = {column.lower() for column in available}
    return [column for column in target if column.lower() != name.lower() or name.lower() in have]


def empty_to_null(rows: DataFrame, target: StructType, strict: bool = False, also: Iterable[str] = ()) -> DataFrame:
    """Text columns whose target is no variable-length text: empty becomes null, the rest takes the target's type.

    Text that does not fit the type becomes null too; with ``strict`` it is an error. ``also`` names text columns
    whose empties become null although the target is text (fixed-length targets read from a database need no mention).
    """
    wanted = {field.name.lower(): field for field in target}
    also = {name.lower() for name in also}

    def cleansed(field: StructField) -> Column:
        column, to = _column(field.name), wanted.get(field.name.lower())
        if to is None or not isinstance(field.dataType, StringType):
            return column
        filled = F.nullif(column, F.lit(""))
        if isinstance(to.dataType, (StringType, VarcharType, CharType)):
            return filled.alias(field.name) if to.name.lower() in also or _is_fixed_length(to) else column
        return (filled.cast(to.dataType) if strict else filled.try_cast(to.dataType)).alias(field.name)

    return rows.select(*[cleansed(field) for field in rows.schema])


def _is_fixed_length(field: StructField) -> bool:
    # Spark reads char(n) and varchar(n) as plain text and notes the declared type in this metadata entry.
    declared = (field.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING", "")
    return isinstance(field.dataType, CharType) or declared.startswith("char(")


def stamp(rows: DataFrame, value: str, name: str = "data_date") -> DataFrame:
    """Add a constant text column, in place of one that has this name already."""
    return rows.withColumn(name, F.lit(value))


def complex_to_string(rows: DataFrame, columns: Iterable[str], lossless: bool = False) -> DataFrame:
    """Listed columns as text: Spark's display form, or JSON for arrays, maps and structs when ``lossless``."""

    def as_text(name: str) -> Column:
        nested = rows.schema[name].dataType.typeName() in ("array", "map", "struct")
        return F.to_json(_column(name)) if lossless and nested else _column(name).cast("string")

    return rows.withColumns({name: as_text(name) for name in columns})


def label_by_values(column: Column, labels: Mapping[object, Sequence[object]]) -> Column:
    """The label whose list holds the value; null where none does."""
    cases = [F.when(column.isin(list(values)), F.lit(label)) for label, values in labels.items()]
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def prefix_flag(column: Column, prefix: str) -> Column:
    """1 where the text begins with ``prefix``, else 0, also for null."""
    return F.when(column.startswith(prefix), F.lit(1)).otherwise(F.lit(0))


def compact_date(column: Column) -> Column:
    """A dashed date without its dashes."""
    return F.regexp_replace(column, "-", "")


def landing_schema(source: StructType) -> StructType:
    """The warehouse types for a relational schema: text, int, bigint, binary; decimals and floats as they are.

    Comments stay; what the driver noted about its own types does not.
    """

    def landed(field: StructField) -> StructField:
        kind = field.dataType
        if isinstance(kind, LANDS_AS_TEXT) or kind.typeName() == "time":
            kind = StringType()
        elif isinstance(kind, LANDS_AS_INT):
            kind = IntegerType()
        comment = {key: value for key, value in (field.metadata or {}).items() if key == "comment"}
        return StructField(field.name, kind, True, comment)

    return StructType([landed(field) for field in source])


def with_comments(schema: StructType, comments: Mapping[str, str]) -> StructType:
    """The schema with comments on the columns that are named, whatever their case."""
    notes = {name.lower(): note for name, note in comments.items()}

    def noted(field: StructField) -> StructField:
        note = notes.get(field.name.lower())
        metadata = {**field.metadata, "comment": note} if note else field.metadata
        return StructField(field.name, field.dataType, field.nullable, metadata)

    return StructType([noted(field) for field in schema])


def land(rows: DataFrame) -> DataFrame:
    """Cast every column to its landing type."""
    return conform(rows, landing_schema(rows.schema))


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
