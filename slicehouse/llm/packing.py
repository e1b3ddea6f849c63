"""Packing pieces of documents into sequences: first-fit decreasing with a tournament tree, within random groups.

Pieces are dealt out and ordered by a hash of their document and place, so that no document, source or group of copies gathers
in one task. ``GROUP`` pieces in that order are a group, which bounds a task's memory; groups are packed apart from each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import parallelism, read_table, small_batches
from slicehouse.llm.tokens import END_ID, VOCABULARY, cut_documents, expected_pieces

LENGTH = 2048
GROUP = 4096


class TournamentTree:
    """Bins in order of opening. Each inner node knows the largest free room of the bins below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put an item into the first bin with enough room for it."""
        best, node = self.best, 1
        while node < self.leaves:
            node = 2 * node if best[2 * node] >= size else 2 * node + 1
        bin_, best[node] = node - self.leaves, best[node] - size
        while node := node // 2:
            larger = max(best[2 * node], best[2 * node + 1])
            if best[node] == larger:
                break
            best[node] = larger
        return bin_


def first_fit_decreasing(sizes: list[int], room: int) -> list[int]:
    """The bin of each item; items of equal size in the order given. No item may be larger than the room."""
    tree, bins = TournamentTree(len(sizes), room), [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda item: -sizes[item]):
        bins[item] = tree.place(sizes[item])
    return bins


def pack_pieces(pieces: DataFrame, partitions: int, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """The rows of ``cut_documents`` with sequence_id and offset: where in which sequence a piece stands.

    The order by hash makes the groups random and the same whenever a task is run again.
    """
    schema = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    mixed = pieces.withColumn("mix", F.xxhash64("doc_id", "start", F.crc32("ids")))
    dealt = mixed.repartition(partitions, "mix").sortWithinPartitions("mix", "doc_id", "start").drop("mix")
    return dealt.mapInArrow(_packer(length, group), schema)


def _packer(length: int, group: int):
    def work(batches: Iterator[pa.RecordBatch]):
        opened = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        for batch in small_batches(batches, group):
            held.append(batch)
            while sum(part.num_rows for part in held) >= group:
                table = pa.Table.from_batches(held)
                packed, opened = pack_group(table.slice(0, group), length, opened)
                yield from packed.to_batches()
                held = table.slice(group).to_batches()
        if held:
            yield from pack_group(pa.Table.from_batches(held), length, opened)[0].to_batches()

    return work


def pack_group(pieces: pa.Table, length: int, opened: int) -> tuple[pa.Table, int]:
    """The pieces with sequences numbered from ``opened``, and the next free number."""
    sizes = pieces.column("length").to_numpy()
    bins = np.array(first_fit_decreasing(sizes.tolist(), length), np.int64)
    within = np.argsort(bins, kind="stable")
    starts = np.cumsum(sizes[within]) - sizes[within]
    first = np.concatenate(([True], np.diff(bins[within]) > 0))
    offsets = np.empty(len(bins), np.int64)
    offsets[within] = starts - np.maximum.accumulate(np.where(first, starts, 0))
    packed = pieces.append_column("sequence_id", pa.array(bins + opened)).append_column("offset", pa.array(offsets))
    return packed, opened + int(bins.max()) + 1


def pack_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    group: int = GROUP,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """All documents as sequences of at most ``length`` ids: one row per piece, with its ids, its sequence and its offset there.

    Columns: doc_id, start, length, doc_tokens, ids, sequence_id, offset. Documents longer than a sequence are cut at multiples of
    its length. Null text is empty; an empty document is one piece of its end id; repeated rows are packed each;
    a null id stays null. An empty table gives no rows. Numbers of sequences are unique and have gaps.
    """
    pieces = cut_documents(docs, length, id, text, vocabulary, end_id)
    # A partition's last group is a part of one, so there are no more partitions than whole groups.
    expected = expected_pieces(docs, length, text)
    partitions = max(1, min(max(parallelism(docs), expected // (4 * group)), expected // group))
    return pack_pieces(pieces, partitions, length, group)


def piece_digests(packed: DataFrame) -> DataFrame:
    """The packed rows with the CRC-32 of their ids in place of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(pack_documents(read_table(spark, folder, "documents")))


QUERIES = {"op1_pack": op1_pack}
ORACLES: dict[str, str] = {}
