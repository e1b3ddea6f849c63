"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries (Spark's ``freqItems`` merges one per task) name every digest that more than ``support`` of all rows
have. Their exact counts are taken by a map-side reduced aggregation; the verified winners are at most ``1 / support``
rows, so they are broadcast and decide about their copies without a shuffle. All other digests are shuffled as usual, and none
of their groups holds more than ``support`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slicehouse.llm.common import persisted, quoted, read_table, text_of

SUPPORT = 1 / 4096


def text_digest(text: str = "text"):
    """SHA-256 of the UTF-8 text in lowercase hex; null counts as empty."""
    return F.sha2(text_of(text), 256)


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; null counts as empty. The row with the largest id of a group stays. A null
    id is smaller than any other, so it stays only if no row of the group has an id. Of rows that share text and id exactly
    one stays. An empty table gives no rows. Further columns of ``docs`` are not looked at.
    """
    rows = persisted(
        docs.select(quoted(id).alias("doc_id"), text_digest(text).alias("text_sha256"), F.monotonically_increasing_id().alias("row_key"))
    )
    frequent = rows.stat.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    last = F.struct("doc_id", "row_key")
    winners = persisted(
        rows.join(F.broadcast(frequent), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.max(last).alias("last"))
        .filter(F.col("group_size") > support * rows.count())
    )
    hot = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    cold = rows.join(F.broadcast(winners), "text_sha256", "left_anti").select(
        "text_sha256", "doc_id", "row_key", F.count("*").over(group).alias("group_size"), F.max(last).over(group).alias("last")
    )
    return hot.select(*cold.columns).union(cold).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_key") == F.col("last.row_key")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay by ``exact_groups``, with all their columns.

    The rows meet the decisions by id and text together, so that null ids do not gather in one task. Of rows that share id
    and text, which may differ in other columns, any one is taken.
    """
    names = docs.columns
    decided = exact_groups(docs, id, text, support).filter("kept").select(
        F.xxhash64("doc_id", "text_sha256").alias("pair"), F.col("text_sha256").alias("kept_digest"), F.col("doc_id").alias("kept_id")
    )
    inner = docs.toDF(*[f"c{place}" for place in range(len(names))])
    own_id, own_text = f"c{names.index(id)}", f"c{names.index(text)}"
    inner = inner.withColumn("digest", text_digest(own_text))
    inner = inner.withColumn("pair", F.xxhash64(own_id, "digest"))
    met = inner.join(decided, "pair").filter((F.col("digest") == F.col("kept_digest")) & F.col(own_id).eqNullSafe(F.col("kept_id")))
    return met.dropDuplicates(["pair", "digest"]).select(*inner.columns[: len(names)]).toDF(*names)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(read_table(spark, folder, "documents"))


QUERIES = {"op3_exact_dedup": op3_exact_dedup}

ORACLES = {
    "op3_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""
}
