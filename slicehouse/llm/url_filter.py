"""URL filter lists whose entries have dates: every capture is judged by the entries that were active when it was fetched.

An entry is valid from its time until the next entry of its key: validity intervals lie one after another. So captures and entries are put into one order
of (key, time), in which the entry that is valid for a capture is the last one before it. The order is dealt out by ranges of about as many rows each, whatever keys
and days they belong to, and each range carries in the last entry of the ranges before it. No capture is paired with an entry that does not decide about it, and
a key with a third of all captures and entries lies in a third of the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slicehouse.llm.common import parallelism, persisted, quoted, read_table

REMOVED = "remove"


def host_of(url: Column) -> Column:
    """The host in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))


def list_keys(url: Column) -> Column:
    """The host and each domain above it that has a dot, the longest first."""
    labels = F.split(host_of(url), r"\.")
    return F.when(
        F.size(labels) > 1,
        F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda at: F.array_join(F.slice(labels, at, F.size(labels)), ".")),
    ).otherwise(F.array().cast("array<string>"))


def as_of(asked: DataFrame, entries: DataFrame) -> DataFrame:
    """Each row of ``asked`` (key, at, row, depth) with ``entry``, the struct (entry_id, action) of the entry of its key that is valid at its time, or null.

    ``entries`` has key, at (timestamp without zone), entry_id and action. Entries without key or time are void; of entries of one key at
    one time the one with the largest id (then action) counts. An entry is valid from its very moment on.
    """
    kept = (
        entries.filter("key IS NOT NULL AND at IS NOT NULL").groupBy("key", "at").agg(F.max(F.struct("entry_id", "action")).alias("entry"))
    )
    none = F.lit(None).cast(dict(kept.dtypes)["entry"])
    events = kept.select("key", "at", F.lit(-1).cast("bigint").alias("row"), F.lit(0).alias("depth"), "entry").unionByName(
        asked.select("key", "at", "row", "depth", none.alias("entry"))
    )
    # Rows count from 0, so that an entry comes before the captures of its own moment. The ranges are written, as a second sample would cut them elsewhere.
    dealt = events.repartitionByRange(parallelism(asked), "key", "at", "row")
    dealt = persisted(dealt.withColumn("range", F.spark_partition_id()))
    last = dealt.filter("entry IS NOT NULL").groupBy("key", "range").agg(F.max_by("entry", "at").alias("last"))
    spread = dealt.select("key", "range").distinct().join(last, ["key", "range"], "left")
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = spread.select("key", "range", F.last("last", ignorenulls=True).over(before).alias("carried")).filter("carried IS NOT NULL")
    own = Window.partitionBy("range", "key").orderBy("at", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    judged = dealt.withColumn("entry", F.last("entry", ignorenulls=True).over(own)).filter("row >= 0")
    return judged.join(carried, ["range", "key"], "left").select("key", "at", "row", "depth", F.coalesce("entry", "carried").alias("entry"))


def filter_captures(captures: DataFrame, entries: DataFrame, id: str = "page_id", url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """One row per capture: page_id, host, fetched_at, list_key, entry_id, action, blocked.

    Of the host and the domains above it the longest with an active entry decides; an entry that removes its key from the
    list is not active. Nothing decides (nulls, not blocked) for a capture without url, host or time. Repeated captures are
    judged each, and a null id stays null. Without entries nothing is blocked.
    """
    rows = persisted(
        captures.select(
            F.monotonically_increasing_id().alias("row"),
            quoted(id).alias("page_id"),
            quoted(url).alias("url"),
            quoted(fetched).cast("timestamp_ntz").alias("fetched_at"),
        )
    )
    asked = rows.filter("fetched_at IS NOT NULL").select(
        "row", F.col("fetched_at").alias("at"), F.posexplode(list_keys(F.col("url"))).alias("depth", "key")
    )
    active = (
        as_of(asked, entries)
        .filter(F.col("entry.action") != REMOVED)
        .groupBy("row")
        .agg(F.min_by(F.struct("key", "entry.entry_id", "entry.action"), "depth").alias("found"))
    )
    return rows.join(active, "row", "left").select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        "fetched_at",
        F.col("found.key").alias("list_key"),
        F.col("found.entry_id").alias("entry_id"),
        F.col("found.action").alias("action"),
        F.coalesce(F.col("found.action") == "block", F.lit(False)).alias("blocked"),
    )


def _moment(step: int) -> Column:
    """A time within a year that follows from the page's number."""
    seconds = F.pmod(F.col("page_id") * step, F.lit(365 * 86400))
    return (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=seconds)).cast("timestamp_ntz")


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as captures, judged by a list that all pages together make: each adds or removes its host or domain at some time."""
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    host = host_of(F.col("url"))
    entries = pages.select(
        F.when(F.col("page_id") % 2 == 0, host).otherwise(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("key"),
        _moment(1_234_577).alias("at"),
        F.col("page_id").alias("entry_id"),
        F.element_at(F.array(F.lit("block"), F.lit("allow"), F.lit("remove")), (F.col("page_id") % 3 + 1).cast("int")).alias("action"),
    )
    return filter_captures(pages.withColumn("fetched_at", _moment(7_654_321)), entries)


QUERIES = {"op7_url_filter": op7_url_filter}

_HOST_SQL = "lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1))"
_MOMENT_SQL = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds((page_id * {step}) % 31536000)"

ORACLES = {
    "op7_url_filter": f"""
WITH c AS (
  SELECT page_id, {_HOST_SQL} AS host, {_MOMENT_SQL.format(step=7654321)} AS fetched_at FROM pages),
e AS (
  SELECT CASE WHEN page_id % 2 = 0 THEN {_HOST_SQL} ELSE regexp_extract({_HOST_SQL}, '([^.]+\\.[^.]+)$', 1) END AS key,
         {_MOMENT_SQL.format(step=1234577)} AS at_time, page_id AS entry_id,
         ['block', 'allow', 'remove'][page_id % 3 + 1] AS action FROM pages),
k AS (
  SELECT page_id, fetched_at, array_to_string(labels[i:], '.') AS key, i
  FROM (SELECT *, string_split(host, '.') AS labels FROM c), unnest(range(1, len(labels))) AS t(i)),
latest AS (
  SELECT k.page_id, k.key, k.i, arg_max({{'entry_id': e.entry_id, 'action': e.action}}, (e.at_time, e.entry_id)) AS found
  FROM k JOIN e ON e.key = k.key AND e.at_time <= k.fetched_at GROUP BY ALL),
best AS (
  SELECT page_id, arg_min({{'key': key, 'entry_id': found.entry_id, 'action': found.action}}, i) AS found
  FROM latest WHERE found.action <> 'remove' GROUP BY page_id)
SELECT page_id, host, fetched_at, found.key AS list_key, found.entry_id AS entry_id, found.action AS action,
       coalesce(found.action = 'block', false) AS blocked
FROM c LEFT JOIN best USING (page_id)"""
}
