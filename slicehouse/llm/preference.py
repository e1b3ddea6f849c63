"""Preference examples from pairs of conversations: their common beginning once, then both continuations with masks.

The comparison works turn by turn: a turn is held against its counterpart, and the first one that differs ends the prefix. Only
the finished example is put together in one row, which is no larger than the two conversations it consists of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import quoted, read_table

LEARNT = "assistant"


def opening(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


CLOSING = "<|end|>\n"


def preference_turns(turns: DataFrame, pair: str = "pair_id", side: str = "side", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row (pair_id, part, turn, role, text) per turn to be rendered; part is prompt, chosen or rejected.

    ``side`` is chosen or rejected; rows with another side, or without a pair or turn, are void. The prompt has the turns
    before the first one in which the sides differ in role or text, or which only one of them has. Null role and text
    are empty; of several rows for one turn of a side the smallest by role and text counts.
    """
    both = (
        turns.select(
            quoted(pair).alias("pair_id"),
            quoted(side).alias("side"),
            quoted(turn).alias("turn"),
            F.struct(F.coalesce(quoted(role), F.lit("")).alias("role"), F.coalesce(quoted(text), F.lit("")).alias("text")).alias("said"),
        )
        .filter("pair_id IS NOT NULL AND turn IS NOT NULL AND side IN ('chosen', 'rejected')")
        .groupBy("pair_id", "turn")
        .agg(*[F.min(F.when(F.col("side") == own, F.col("said"))).alias(own) for own in ("chosen", "rejected")])
    )
    same = F.col("chosen").eqNullSafe(F.col("rejected"))
    parting = both.groupBy("pair_id").agg(F.min(F.when(~same, F.col("turn"))).alias("parting"))
    shared = F.col("parting").isNull() | (F.col("turn") < F.col("parting"))
    part = lambda name, said: F.struct(F.lit(name).alias("part"), said["role"].alias("role"), said["text"].alias("text"))
    parts = F.when(shared, F.array(part("prompt", F.col("chosen")))).otherwise(
        F.filter(
            F.array(*[F.when(F.col(own).isNotNull(), part(own, F.col(own))) for own in ("chosen", "rejected")]),
            lambda own: own.isNotNull(),
        )
    )
    return both.join(parting, "pair_id").select("pair_id", "turn", F.explode(parts).alias("own")).select("pair_id", "own.part", "turn", "own.role", "own.text")


def preference_examples(turns: DataFrame, learnt: str = LEARNT, **columns: str) -> DataFrame:
    """One row per pair: pair_id, prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask.

    The masks are arrays of (start, length) in characters: the texts and closing marks of turns by ``learnt``, which are the
    only characters of a completion that are learnt from. Sides that are equal throughout have empty completions.
    """
    rows = preference_turns(turns, **columns)
    rendered = F.concat(opening(F.col("role")), F.col("text"), F.lit(CLOSING))
    piece = F.struct("turn", rendered.alias("text"), F.length(opening(F.col("role"))).alias("skip"), (F.col("role") == learnt).alias("learn"))
    grouped = rows.groupBy("pair_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("part") == own, piece))).alias(own) for own in ("prompt", "chosen", "rejected")]
    )
    whole = lambda own: F.array_join(F.transform(own, lambda piece: piece["text"]), "")
    return grouped.select(
        "pair_id",
        F.size("prompt").alias("prompt_turns"),
        whole("prompt").alias("prompt"),
        whole("chosen").alias("chosen"),
        _mask("chosen").alias("chosen_mask"),
        whole("rejected").alias("rejected"),
        _mask("rejected").alias("rejected_mask"),
    )


def _mask(own: str) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans"))

    def add(state: Column, piece: Column) -> Column:
        size = F.length(piece["text"])
        span = F.struct((state["at"] + piece["skip"]).alias("start"), (size - piece["skip"]).alias("length"))
        spans = F.when(piece["learn"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + size).alias("at"), spans.alias("spans"))

    return F.aggregate(own, start, add, lambda state: state["spans"])


def shortened_answers(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: each is chosen over itself with its last answer cut to half and nothing after it."""
    last = conversations.filter(F.col("role") == LEARNT).groupBy("conv_id").agg(F.max("turn").alias("last"))
    rows = conversations.join(last, "conv_id", "left")
    half = F.substring("text", F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    chosen = rows.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    rejected = rows.filter("last IS NULL OR turn <= last").select(
        F.col("conv_id").alias("pair_id"),
        F.lit("rejected").alias("side"),
        "turn",
        "role",
        F.when(F.col("turn") == F.col("last"), half).otherwise(F.col("text")).alias("text"),
    )
    return chosen.union(rejected)


def op8_preference(spark: SparkSession, folder: str) -> DataFrame:
    examples = preference_examples(shortened_answers(read_table(spark, folder, "conversations")))
    plain = lambda mask: F.array_join(F.transform(mask, lambda span: F.concat_ws(":", span["start"], span["length"])), ",")
    return examples.withColumns({name: plain(name) for name in ("chosen_mask", "rejected_mask")}).withColumn(
        "prompt_turns", F.col("prompt_turns").cast("bigint")
    )


QUERIES = {"op8_preference": op8_preference}

ORACLES = {
    "op8_preference": """
WITH l AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS last FROM conversations GROUP BY conv_id),
s AS (
  SELECT conv_id, 'chosen' AS side, turn, role, text FROM conversations
  UNION ALL
  SELECT conv_id, 'rejected', turn, role, CASE WHEN turn = last THEN left(text, (length(text) // 2)::BIGINT) ELSE text END
  FROM conversations JOIN l USING (conv_id) WHERE last IS NULL OR turn <= last),
p AS (
  SELECT conv_id, min(turn) FILTER (WHERE n < 2) AS parting
  FROM (SELECT conv_id, turn, role, text, count(*) AS n FROM s GROUP BY ALL) GROUP BY conv_id),
r AS (
  SELECT conv_id, side, turn, role, coalesce(turn < parting, true) AS shared,
         '<|' || role || '|>' || chr(10) AS opening, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece
  FROM s JOIN p USING (conv_id)),
m AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, side, shared ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_char
  FROM r),
q AS (
  SELECT *, CASE WHEN role = 'assistant' THEN (at_char + length(opening))::BIGINT || ':' || (length(piece) - length(opening)) END AS span FROM m)
SELECT conv_id AS pair_id,
       count(*) FILTER (WHERE shared AND side = 'chosen') AS prompt_turns,
       coalesce(string_agg(piece, '' ORDER BY turn) FILTER (WHERE shared AND side = 'chosen'), '') AS prompt,
       coalesce(string_agg(piece, '' ORDER BY turn) FILTER (WHERE NOT shared AND side = 'chosen'), '') AS chosen,
       coalesce(string_agg(span, ',' ORDER BY turn) FILTER (WHERE NOT shared AND side = 'chosen'), '') AS chosen_mask,
       coalesce(string_agg(piece, '' ORDER BY turn) FILTER (WHERE NOT shared AND side = 'rejected'), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY turn) FILTER (WHERE NOT shared AND side = 'rejected'), '') AS rejected_mask
FROM q GROUP BY conv_id"""
}
