"""Which rows differ between two tables that should be equal, without comparing those that are.

The rows of a range of keys have a digest: their number and the sums of two hashes of each, which do not depend on the order of the rows and count repeated
ones. Both sides are digested range by range, the differences taken by one aggregation, and only ranges that differ are divided further. Rows are
compared one by one only where what is left is small, or differs in too many places for ranges to help.
Each range goes to the scans as a condition on the key, so a database or a Parquet file is asked for the ranges that differ alone: equal ranges are read once.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from slicehouse.functions.columns import align_to

#: A range that differs is divided into so many.
FANOUT = 64
#: With so many ranges that differ, their rows are compared.
RANGES = 64
#: Ranges of so few rows, of both sides together, are not divided.
FEW = 1000
_EPOCH = datetime.datetime(1970, 1, 1)
_POSITION = "position in the order of keys"


def _position(rows: DataFrame, key: str) -> Column | None:
    """The key as a whole number in its own order; None for a key whose ranges no scan could use."""
    kind = rows.schema[key].dataType
    if isinstance(kind, IntegralType):
        return F.col(key).cast("bigint")
    if isinstance(kind, DateType):
        return F.unix_date(key).cast("bigint")
    if isinstance(kind, TimestampType):
        return F.unix_micros(key)
    if isinstance(kind, TimestampNTZType):  # as wall-clock time, whatever the session's zone
        own = F.col(key)
        second = (F.hour(own) * 3600 + F.minute(own) * 60).cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), own) * 1_000_000).cast("bigint")
        return F.unix_date(own.cast("date")).cast("bigint") * 86_400_000_000 + second
    return None


def _value(rows: DataFrame, key: str, position: int) -> Column:
    kind = rows.schema[key].dataType
    if isinstance(kind, DateType):
        return F.lit((_EPOCH + datetime.timedelta(days=position)).date())
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(position))
    if isinstance(kind, TimestampNTZType):
        return F.lit((_EPOCH + datetime.timedelta(microseconds=position)).isoformat(" ")).cast("timestamp_ntz")
    return F.lit(position).cast(kind)


def _inside(rows: DataFrame, key: str | None, place: Column, ranges: Sequence[tuple[int, int]] | None, nulls: bool) -> DataFrame:
    """Rows of ranges (first, last), and of null keys if told; ``key`` is null where ranges are of hashes."""
    if ranges is None:
        return rows
    condition = place.isNull() if nulls else F.lit(False)
    for first, last in ranges:
        if key is None:
            condition |= place.between(first, last)
        else:
            condition |= (F.col(key) >= _value(rows, key, first)) & (F.col(key) <= _value(rows, key, last))
    return rows.where(condition)


def differing_rows(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None, fanout: int = FANOUT, ranges: int = RANGES, few: int = FEW
) -> DataFrame:
    """The rows that one side has more often than the other: ``side`` (left or right), ``times`` (how many more), and the columns.

    Columns go by name, by default all of ``left``; the right side's values are cast to the left side's types. Two nulls are equal, as are two NaN, and 0.0 and -0.0.
    A key that is a number, date or time gives ranges that scans can use; of any other, ranges of its hash are taken. Null keys are a range of their own.
    The key need not be unique. Rows are compared as sets with repetition: how often each comes on either side.
    """
    names = list(columns or left.columns)
    own_key = next(name for name in names if name.lower() == key.lower())
    left = align_to(left, names)
    right = align_to(right, names)
    right = right.select(*[F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in left.schema])
    place = _position(left, own_key)
    scanned = own_key if place is not None else None
    if place is None:
        place = F.when(F.col(own_key).isNotNull(), F.shiftright(F.xxhash64(F.col(own_key).cast("string")), 1))
    found, nulls = _ranges(left, right, scanned, place, fanout, ranges, few)
    hashed = []
    for rows, sign in ((left, 1), (right, -1)):
        hashed.append(_inside(rows, scanned, place, found, nulls).select(F.lit(sign).alias("sign"), *[_plain(rows, name) for name in names]))
    each = hashed[0].union(hashed[1]).groupBy(*[f"`{name}`" for name in names]).agg(F.sum("sign").alias("sign")).where("sign != 0")
    side = F.when(F.col("sign") > 0, "left").otherwise("right").alias("side")
    return each.select(side, F.abs("sign").alias("times"), *[f"`{name}`" for name in names])


def _plain(rows: DataFrame, name: str) -> Column:
    """The column so that equal values are equal for grouping and hashing: no negative zero."""
    kind, column = dict(rows.dtypes)[name], F.col(f"`{name}`")
    return (F.when(column == 0, F.lit(0.0).cast(kind)).otherwise(column) if kind in ("float", "double") else column).alias(name)


def _ranges(left: DataFrame, right: DataFrame, key: str | None, place: Column, fanout: int, most: int, few: int) -> tuple[list[tuple[int, int]], bool]:
    """The ranges (first, last) that differ, and whether null keys do. The driver gets at most ``most`` ranges times ``fanout`` digests."""
    bounds = left.select(place.alias(_POSITION)).union(right.select(place.alias(_POSITION))).agg(F.min(_POSITION), F.max(_POSITION)).first()
    if bounds[0] is None:
        return [], True
    todo, small, nulls, first_round = [tuple(bounds)], [], True, True
    while todo:
        widths = [-(-(last - first + 1) // fanout) for first, last in todo]
        told = _differences(left, right, key, place, todo, widths, fanout, first_round)
        if first_round:
            nulls = any(row.bucket is None for row in told)
            first_round = False
        parts = []
        for row in told:
            if row.bucket is not None:
                number, step = divmod(row.bucket, fanout)
                first = todo[number][0] + step * widths[number]
                last = min(first + widths[number] - 1, todo[number][1])
                parts.append((first, last, row.rows <= few or first == last))
        if len(parts) + len(small) > most:
            return sorted(small + todo), nulls
        small += [(first, last) for first, last, done in parts if done]
        todo = [(first, last) for first, last, done in parts if not done]
    return sorted(small), nulls


def _differences(left: DataFrame, right: DataFrame, key: str | None, place: Column, todo: list, widths: list[int], fanout: int, nulls: bool) -> list:
    """(bucket, rows) of the parts of ranges whose digests differ."""
    bucket = F.lit(None).cast("bigint")
    for number, ((first, last), width) in enumerate(zip(todo, widths)):
        step = F.expr(f"(`{_POSITION}` - ({first}L)) div {width}L + {number * fanout}L")
        bucket = F.when(F.col(_POSITION).between(first, last), step).otherwise(bucket)
    sides = []
    for rows, sign in ((left, 1), (right, -1)):
        plain = [_plain(rows, name) for name in rows.columns]
        inside = _inside(rows, key, place, todo, nulls).select(place.alias(_POSITION), *[column for column in plain])
        values = [F.col(f"`{name}`") for name in rows.columns]
        # Which values are null is hashed too: a hash passes over nulls.
        shape = F.concat(*[F.when(value.isNull(), "0").otherwise("1") for value in values])
        hashes = [F.xxhash64(F.lit(seed), shape, *values).cast("decimal(38,0)").alias(f"h{seed}") for seed in (0, 1)]
        sides.append(inside.select(bucket.alias("bucket"), F.lit(sign).alias("sign"), *hashes))
    sums = [F.sum(F.col("sign") * F.col(name)).alias(name) for name in ("h0", "h1")]
    digests = sides[0].union(sides[1]).groupBy("bucket").agg(F.count("*").alias("rows"), F.sum("sign").alias("more"), *sums)
    return digests.where("more != 0 OR h0 != 0 OR h1 != 0").select("bucket", "rows").collect()
