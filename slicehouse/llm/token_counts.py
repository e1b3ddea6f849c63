"""Token counts of documents in flat token files, which have no index: only identifiers that end documents.

A file is a sequence of blocks. Each block is searched on its own for the identifier, all ids at once; a prefix scan over what
blocks report (tokens, documents, last end) then tells where in the file a block starts and which document is open there.
The scan has two levels, so that no task needs more than ``SPAN`` blocks of a file, or one row for each ``SPAN`` blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slicehouse.llm.common import persisted, read_table, small_batches, text_of
from slicehouse.llm.tokens import CACHED_PARTS, VOCABULARY, worker_encoder

BLOCK_TOKENS = 1 << 16
SPAN = 1024
#: The end of a text in the default vocabulary.
END_OF_TEXT = 49407


def flat_files(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_OF_TEXT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The documents as flat token files: rows (file, block, tokens), tokens being 16-bit little-endian ids.

    A task writes one file: the ids of its documents, each followed by the end id, cut into blocks without regard to documents.
    Null text is an empty document. The vocabulary must have at most 65,536 ids; special tokens are never made from text.
    """

    def write(batches: Iterator[pa.RecordBatch]):
        encoder = worker_encoder(vocabulary, 2, CACHED_PARTS, True)
        end, size = end_id.to_bytes(2, "little"), 2 * block_tokens
        file, block, held = TaskContext.get().partitionId(), 0, bytearray()

        def cut(least: int):
            nonlocal block
            while len(held) >= least and held:
                yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int64()), "block": pa.array([block], pa.int64()), "tokens": [bytes(held[:size])]})
                del held[:size]
                block += 1

        for batch in small_batches(batches):
            for value in batch.column(0):
                for ids in encoder.pieces(value.as_py()):
                    held += ids
                    yield from cut(size)
                held += end
            yield from cut(size)
        yield from cut(0)

    return docs.select(text_of(text)).mapInArrow(write, "file bigint, block bigint, tokens binary")


def read_flat_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, width: int = 2) -> DataFrame:
    """Flat files of a folder as rows (file, block, tokens); file is the path.

    Spark reads a file as one row, so files may have two gigabytes at most; many files are read in parallel.
    """

    def cut(batches: Iterator[pa.RecordBatch]):
        size = block_tokens * width
        for batch in small_batches(batches, 1):
            name, data = batch.column(0)[0].as_py(), batch.column(1)[0].as_buffer()
            for block in range(-(-data.size // size)):
                piece = data.slice(block * size, min(size, data.size - block * size)).to_pybytes()
                yield pa.RecordBatch.from_pydict({"file": [name], "block": pa.array([block], pa.int64()), "tokens": [piece]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(cut, "file string, block bigint, tokens binary")


def separator_places(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """One row (file, block, n_tokens, ends) per block; ends are the places of the end id in it."""

    def search(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, 64):
            ids = [np.frombuffer(value.as_buffer() if value.is_valid else b"", f"<u{width}") for value in batch.column(2)]
            ends = [np.flatnonzero(block == end_id) for block in ids]
            arrays = [batch.column(0), batch.column(1), pa.array([len(block) for block in ids], pa.int64()), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "n_tokens", "ends"])

    rows = blocks.select("file", "block", "tokens")
    return rows.mapInArrow(search, f"file {rows.dtypes[0][1]}, block bigint, n_tokens bigint, ends array<bigint>")


def count_tokens(blocks: DataFrame, end_id: int = END_OF_TEXT, width: int = 2, span: int = SPAN) -> DataFrame:
    """One row per document: file, place (of the document in its file, from 0), start, n_tokens (without the end id), ended.

    ``blocks`` has file, block (the order within a file; gaps are allowed, repeats are not) and tokens (null: none). What
    follows a file's last end id is a document that has not ended; there is none if nothing follows. Consecutive end ids
    are empty documents. Columns with other names are not looked at; a table without rows gives none.
    """
    found = persisted(separator_places(blocks, end_id, width))
    parts = found.select(
        "file", "block", F.floor(F.col("block") / span).alias("part"), "n_tokens", F.size("ends").cast("bigint").alias("n_ends"),
        F.element_at("ends", F.when(F.size("ends") > 0, -1).otherwise(F.lit(None).cast("int"))).alias("last_end"),
    )
    inside = Window.partitionBy("file", "part").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumns({"base": _sum("n_tokens", before), "seen": _sum("n_ends", before)}).withColumn(
        "open", F.max(F.col("base") + F.col("last_end") + 1).over(before)
    )
    sums = placed.groupBy("file", "part").agg(
        F.sum("n_tokens").alias("part_tokens"), F.sum("n_ends").alias("part_ends"), F.max(F.col("base") + F.col("last_end") + 1).alias("part_open")
    )
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumns({"part_base": _sum("part_tokens", earlier), "part_seen": _sum("part_ends", earlier)}).withColumn(
        "part_start", F.max(F.col("part_base") + F.col("part_open")).over(earlier)
    ).withColumn("file_tokens", F.sum("part_tokens").over(Window.partitionBy("file")))
    carried = placed.join(starts.select("file", "part", "part_base", "part_seen", "part_start", "file_tokens"), ["file", "part"]).select(
        "file",
        "block",
        (F.col("part_base") + F.col("base")).alias("base"),
        (F.col("part_seen") + F.col("seen")).alias("seen"),
        F.coalesce(F.col("part_base") + F.col("open"), "part_start", F.lit(0)).alias("open"),
        "n_tokens",
        "file_tokens",
    )
    rows = found.select("file", "block", "ends").join(carried, ["file", "block"])
    ended = rows.select("file", "base", "seen", "open", "ends", F.posexplode("ends").alias("nth", "end")).select(
        "file",
        (F.col("seen") + F.col("nth")).alias("place"),
        F.when(F.col("nth") == 0, F.col("open")).otherwise(F.col("base") + F.element_at("ends", F.greatest("nth", F.lit(1))) + 1).alias("start"),
        (F.col("base") + F.col("end")).alias("stop"),
        F.lit(True).alias("ended"),
    )
    own_end = F.element_at("ends", F.when(F.size("ends") > 0, -1).otherwise(F.lit(None).cast("int")))
    tail = rows.filter(F.col("base") + F.col("n_tokens") == F.col("file_tokens")).filter("n_tokens > 0").select(
        "file",
        (F.col("seen") + F.size("ends")).alias("place"),
        F.coalesce(F.col("base") + own_end + 1, "open").alias("start"),
        F.col("file_tokens").alias("stop"),
        F.lit(False).alias("ended"),
    )
    return ended.union(tail.filter("start < stop")).select("file", "place", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "ended")


def _sum(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The token counts of all documents, from flat files that Spark writes first."""
    return count_tokens(persisted(flat_files(read_table(spark, folder, "documents"))))


QUERIES = {"op2_token_counts": op2_token_counts}
ORACLES: dict[str, str] = {}
