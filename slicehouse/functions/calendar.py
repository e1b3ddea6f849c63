"""The batch calendar: every date text that batch jobs are parameterised with, from one date or timestamp column."""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The offsets that have parameters of their own.
DAYS_AGO = (1, 2, 3, 4, 5, 6, 7, 8, 15, 30, 60, 90)
MONTHS_AGO = (2, 3, 5, 12, 24)

SLICE = "yyyyMMdd"
DASHED = "yyyy-MM-dd"


def shift_days(column: Column | str, read_as: str, days: int, write_as: str) -> Column:
    """Date text in one format, ``days`` days earlier, in another format. The time of day is kept, in every time zone.

    A format goes through the session's zone, which may skip the hour in question. So hours, minutes and seconds are taken from the
    text of the zone-less timestamp, and only the date is formatted. Quoted text in ``write_as`` may not contain HH, mm or ss.
    """
    moment = F.to_timestamp_ntz(F.col(column) if isinstance(column, str) else column, F.lit(read_as))
    earlier = moment - F.make_dt_interval(F.lit(days))
    # The text of a zone-less timestamp is the same in every zone.
    wall = earlier.cast("string")
    parts = {"HH": F.substring(wall, 12, 2), "mm": F.substring(wall, 15, 2), "ss": F.substring(wall, 18, 2)}
    pieces = [
        parts[piece] if piece in parts else F.date_format(earlier.cast("date"), piece)
        for piece in re.split(r"(HH|mm|ss)", write_as)
        if piece
    ]
    return F.concat(*pieces)


def calendar_columns(moment: Column, with_time: bool = False, now: datetime.datetime | None = None) -> dict[str, Column]:
    """Calendar texts by parameter name, from a date or timestamp column.

    ``with_time`` adds the parameter that exists only for batches given to the second. ``now`` adds those that
    speak of the time of the run.
    """
    day = moment.cast("date")
    wall = moment.cast("timestamp_ntz")
    # The text of a zone-less timestamp is the same in every time zone; a format would go through the session's zone.
    digits = F.translate(wall.cast("string"), "- :", "")
    month = F.trunc(day, "MM")
    before = F.date_sub(month, 1)
    last_month = F.add_months(month, -1)

    columns = {
        "pt_min": F.substring(digits, 1, 12),
        "pt_hour": F.substring(digits, 1, 10),
        "pt": F.date_format(day, SLICE),
        "pt_month": F.date_format(day, "yyyyMM"),
        "pt_mon01": F.date_format(month, SLICE),
        "data_date": F.date_format(day, DASHED),
        "data_date_mon01": F.date_format(month, DASHED),
        "data_date_year0101": F.date_format(F.trunc(day, "YEAR"), DASHED),
    }
    for days in DAYS_AGO:
        columns[f"pt_{days}_day_ago"] = F.date_format(F.date_sub(day, days), SLICE)
        columns[f"data_date_{days}_day_ago"] = F.date_format(F.date_sub(day, days), DASHED)
    columns |= {
        "pt_mon31": F.date_format(F.last_day(day), SLICE),
        "data_date_mon31": F.date_format(F.last_day(day), DASHED),
        "pt_lastmon31": F.date_format(before, SLICE),
        "data_date_lastmon31": F.date_format(before, DASHED),
        "pt_lastmon01": F.date_format(last_month, SLICE),
        "data_date_lastmon01": F.date_format(last_month, DASHED),
        "pt_lastmonth": F.date_format(last_month, "yyyyMM"),
        "data_date_lastmonth": F.date_format(last_month, "yyyy-MM"),
    }
    for months in MONTHS_AGO:
        columns[f"data_date01_{months}month_ago"] = F.date_format(F.add_months(month, -months), DASHED)
    if with_time:
        later = wall + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(90))
        columns["date_90min_later"] = F.substring(later.cast("string"), 1, 19)
    if now is not None:
        columns |= {
            "pt_sys": F.lit(f"{now:%Y%m%d}"),
            "datetime_sys": F.lit(f"{now:%Y-%m-%d %H:%M:%S}"),
            "pt_sys_1_day_ago": F.lit(f"{now - datetime.timedelta(days=1):%Y%m%d}"),
            "data_date_sys_mon01": F.lit(f"{now:%Y-%m}-01"),
        }
    return columns


def with_batch_calendar(
    rows: DataFrame,
    column: str,
    only: Sequence[str] | None = None,
    with_time: bool = False,
    now: datetime.datetime | None = None,
) -> DataFrame:
    """Add calendar columns, all or only the named ones."""
    columns = calendar_columns(F.col(column), with_time, now)
    return rows.withColumns({name: columns[name] for name in only} if only else columns)


def batch_parameters(spark: SparkSession, batch: str, now: datetime.datetime | None = None) -> dict[str, str]:
    """The same texts for one batch id of 8, 10, 12 or 14 digits, for use as statement parameters."""
    if not batch.isdigit() or len(batch) not in (8, 10, 12, 14):
        raise ValueError(f"a batch id has 8, 10, 12 or 14 digits: {batch!r}")
    moment = F.to_timestamp_ntz(F.lit(batch.ljust(14, "0")), F.lit("yyyyMMddHHmmss"))
    columns = calendar_columns(moment, with_time=len(batch) == 14, now=now)
    return spark.range(1).select(*[column.alias(name) for name, column in columns.items()]).first().asDict()
