"""Cleansing, mapping, landing, filters and the calendar on hand-made frames."""

import datetime

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from slicehouse.functions.calendar import batch_parameters, shift_days, with_batch_calendar
from slicehouse.functions.columns import (
    align_to,
    between,
    compact_date,
    complex_to_string,
    conform,
    empty_to_null,
    filter_with,
    guard_column,
    incremental,
    label_by_values,
    land,
    look_back,
    map_columns,
    mapping_from_text,
    prefix_flag,
    stamp,
)
from slicehouse.plans.statements import fill, param_sql, run_step


def rows_of(frame):
    return [tuple(row) for row in frame.collect()]


def test_empty_to_null(spark):
    frame = spark.createDataFrame(
        [("", "", "", ""), (" 12 ", "1.5", "2024-02-29", "x"), ("x", "y", "z", "y"), (None, None, None, None)],
        "a string, b string, c string, d string",
    )
    target = StructType.fromDDL("a int, b double, c date, d string")
    day = datetime.date(2024, 2, 29)
    kept = [(None, None, None, ""), (12, 1.5, day, "x"), (None, None, None, "y"), (None, None, None, None)]
    assert rows_of(empty_to_null(frame, target)) == kept
    assert rows_of(empty_to_null(frame, target, also=["d"])) == [(None,) * 4, *kept[1:]]
    with pytest.raises(PySparkException):
        empty_to_null(frame, target, strict=True).collect()
    assert rows_of(empty_to_null(frame.limit(2), target, strict=True)) == kept[:2]


def test_empty_to_null_for_fixed_length_targets(spark):
    frame = spark.createDataFrame([("", "")], "a string, b string")
    target = StructType()
    target.add("A", StringType(), True, {"__CHAR_VARCHAR_TYPE_STRING": "char(3)"})
    target.add("b", StringType(), True, {"__CHAR_VARCHAR_TYPE_STRING": "varchar(3)"})
    assert rows_of(empty_to_null(frame, target)) == [(None, "")]


def test_empty_to_null_leaves_other_types(spark):
    frame = spark.createDataFrame([(0, 1.0, True)], "a int, b double, c boolean")
    assert rows_of(empty_to_null(frame, StructType.fromDDL("a bigint, b double, c boolean"))) == [(0, 1.0, True)]


def test_mapping(spark):
    frame = spark.createDataFrame([(1, "x")], "id bigint, Name string")
    mapping = mapping_from_text("key:id|at:to_timestamp_ntz('2019-10-28 01:02:03')|")
    assert mapping_from_text(None) == {} and mapping_from_text(" ") == {}
    shaped = map_columns(frame, mapping, ["name", "key", "at"])
    assert rows_of(shaped) == [("x", 1, datetime.datetime(2019, 10, 28, 1, 2, 3))]
    assert shaped.columns == ["name", "key", "at"]
    with pytest.raises(ValueError, match="other"):
        map_columns(frame, mapping, ["key", "other"])


def test_alignment(spark):
    frame = spark.createDataFrame([(1, "x", 2.0)], "b bigint, A string, `c.d` double")
    assert align_to(frame, ["c.d", "a", "B"]).columns == ["c.d", "a", "B"]
    with pytest.raises(ValueError, match="z"):
        align_to(frame, ["a", "z"])
    typed = conform(frame, StructType.fromDDL("`c.d` string, b int"))
    assert rows_of(typed) == [("2.0", 1)]


def test_landing(spark):
    source = StructType.fromDDL(
        "a tinyint, b smallint, c int, d bigint, e boolean, f date, g timestamp, h timestamp_ntz, i binary, j decimal(8,2), k double, l string"
    )
    landed = land(spark.createDataFrame([], source)).schema
    kinds = ["int"] * 3 + ["bigint", "int"] + ["string"] * 3 + ["binary", "decimal(8,2)", "double", "string"]
    assert [field.dataType.simpleString() for field in landed] == kinds


def test_filters(spark):
    frame = spark.createDataFrame([(1, "{a}"), (2, "b")], "n int, s string")
    assert filter_with(frame, "  ") is frame and filter_with(frame, None) is frame
    assert rows_of(filter_with(frame, "s = '{a}' AND n < :n", {"n": 5})) == [(1, "{a}")]
    with pytest.raises(AnalysisException, match="UNBOUND_SQL_PARAMETER"):
        filter_with(frame, "n < :n AND s = :s", {"n": 5})


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_a_day_is_half_open(spark, kind):
    texts = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 23:59:59", "2024-01-03 00:00:00"]
    frame = spark.createDataFrame([(text,) for text in texts], "t string").select(F.col("t").cast(kind), F.col("t").alias("x"))
    assert [row.x for row in incremental(frame, "t", "2024-01-02").collect()] == texts[1:3]
    until = datetime.datetime(2024, 1, 2, 12)
    assert [row.x for row in look_back(frame, "t", until, 0).collect()] == texts[1:2]
    assert between(frame, "t", datetime.date(2024, 1, 2), datetime.date(2024, 1, 3)).count() == 2


def test_small_expressions(spark):
    frame = spark.createDataFrame([("ST1", "2024-01-02"), (None, None), ("xST", "a-b")], "s string, d string")
    got = frame.select(
        prefix_flag(F.col("s"), "ST"), compact_date(F.col("d")), label_by_values(F.col("s"), {5: ["ST1"], 6: ["xST", "y"]})
    )
    assert rows_of(got) == [(1, "20240102", 5), (0, None, None), (0, "ab", 6)]
    assert guard_column(["a", "data_date"], ["a"]) == ["a"]
    assert guard_column(["a", "data_date"], ["A", "DATA_DATE"]) == ["a", "data_date"]
    assert rows_of(stamp(frame.select("s").limit(1), "2024-01-01")) == [("ST1", "2024-01-01")]


def test_nested_values_as_text(spark):
    frame = spark.sql("SELECT array(1, 2) a, map('k', 'v') m, named_struct('x', 'y, z') s, 1.5D d")
    assert rows_of(complex_to_string(frame, ["a", "m", "s", "d"])) == [("[1, 2]", "{k -> v}", "{y, z}", "1.5")]
    assert rows_of(complex_to_string(frame, ["a", "m", "s", "d"], lossless=True)) == [("[1,2]", '{"k":"v"}', '{"x":"y, z"}', "1.5")]


def test_calendar_of_a_batch(spark):
    now = datetime.datetime(2024, 3, 1, 0, 0, 5)
    got = batch_parameters(spark, "20191126120000", now)
    expected = {
        "pt": "20191126",
        "pt_1_day_ago": "20191125",
        "data_date": "2019-11-26",
        "date_90min_later": "2019-11-26 13:30:00",
        "pt_min": "201911261200",
        "pt_hour": "2019112612",
        "pt_month": "201911",
        "pt_mon01": "20191101",
        "pt_mon31": "20191130",
        "data_date_lastmon31": "2019-10-31",
        "data_date_lastmonth": "2019-10",
        "data_date_lastmon01": "2019-10-01",
        "pt_lastmonth": "201910",
        "data_date_year0101": "2019-01-01",
        "data_date_90_day_ago": "2019-08-28",
        "data_date01_2month_ago": "2019-09-01",
        "data_date01_24month_ago": "2017-11-01",
        "pt_sys_1_day_ago": "20240229",
        "data_date_sys_mon01": "2024-03-01",
        "datetime_sys": "2024-03-01 00:00:05",
    }
    assert {name: got[name] for name in expected} == expected
    assert len(got) == 8 + 24 + 8 + 5 + 1 + 4
    assert "date_90min_later" not in batch_parameters(spark, "20191126")
    assert batch_parameters(spark, "20191126")["pt_min"] == "201911260000"
    with pytest.raises(ValueError):
        batch_parameters(spark, "2019-11-26")


def test_calendar_in_a_zone_that_skips_the_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame([(datetime.datetime(2024, 3, 10, 2, 30, 1),)], "at timestamp_ntz")
        got = with_batch_calendar(frame, "at", ["pt_min", "pt_hour", "pt", "date_90min_later"], with_time=True).first()
        assert tuple(got)[1:] == ("202403100230", "2024031002", "20240310", "2024-03-10 04:00:01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar_at_month_ends(spark):
    days = spark.sql("SELECT explode(sequence(date'2023-12-30', date'2024-03-31')) d")
    got = with_batch_calendar(days, "d", ["data_date_mon31", "data_date_lastmon31", "data_date01_3month_ago"])
    by_day = {row.d.isoformat(): tuple(row)[1:] for row in got.collect()}
    assert by_day["2024-03-31"] == ("2024-03-31", "2024-02-29", "2023-12-01")
    assert by_day["2023-12-31"] == ("2023-12-31", "2023-11-30", "2023-09-01")


def test_days_ago_keep_the_time(spark):
    frame = spark.createDataFrame([("202403010605",)], "pt string")
    got = frame.select(
        shift_days("pt", "yyyyMMddHHmm", 0, "yyyy-MM-dd HH:mm:00"),
        shift_days("pt", "yyyyMMddHHmm", 1, "yyyyMMddHHmm"),
        shift_days("pt", "yyyyMMddHHmm", 90, "yyyy-MM-dd"),
    )
    assert rows_of(got) == [("2024-03-01 06:05:00", "202402290605", "2023-12-02")]


def test_statements(spark):
    values = {"pt": "20240101", "data_date": "2024-01-01"}
    text = "select '${pt}x' a, #{pt} b, '$data_date' c, '$pt' d"
    assert fill(text, values) == "select '20240101x' a, 20240101 b, '2024-01-01' c, '20240101' d"
    assert rows_of(run_step(spark, text, values)) == [("20240101x", 20240101, "2024-01-01", "20240101")]
    with pytest.raises(ValueError, match="nothing"):
        fill("select ${nothing}", values)
    with pytest.raises(ValueError, match="batch value"):
        fill("select '${pt}'", {"pt": "' or '1'='1"})
    frame = spark.range(5)
    assert rows_of(param_sql(spark, "select count(*) from {numbers} where id < :top", {"top": 3}, numbers=frame)) == [(3,)]
