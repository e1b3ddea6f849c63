"""Removal of long byte strings that an earlier document has too, with suffix arrays sorted in external memory.

A string of ``LENGTH`` bytes can only occur in two texts if its anchor does: the 25-byte string with the least hash
in it. So all texts are reduced to the anchors of all their strings, and the strings whose anchor is in one text only
are done with. The others are cut out as segments (consecutive strings with one anchor), equal segments become one
with the smallest rank of their documents, and the segments of an anchor go to one shard. There a suffix array with common
prefixes is made by induced sorting; suffixes with ``LENGTH`` bytes in common follow each other, and the
smallest rank among them tells for each which strings are repeats.

Anchors that very many texts have are found first by counts in each task and need no shuffle; equal texts are one text from
the start. What any document needs is thus spread over the cluster, and no step depends on how often a passage occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import discard, free_shuffles, parallelism, persisted, quoted, read_table, small_batches, text_of
from slicehouse.llm.suffix_order import suffix_order

LENGTH = 50
GRAM = 25
#: Anchors that this share of all texts has count as frequent.
FREQUENT = 1 / 64
_BASE = 0x100000001B3
_PIECE = 1 << 20
_RUN = 1024
_SHARD = 2 << 20
_REMEMBERED = 500_000
_NO_ID = (1 << 63) - 1


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of each 25 consecutive bytes, from hashes of halves."""

    def joined(a: np.ndarray, size: int, b: np.ndarray, b_size: int) -> np.ndarray:
        count = len(codes) - size - b_size + 1
        return a[:count] * np.uint64(pow(_BASE, b_size, 1 << 64)) + b[size : size + count]

    one = codes.astype(np.uint64) + np.uint64(1)
    two = joined(one, 1, one, 1)
    four = joined(two, 2, two, 2)
    eight = joined(four, 4, four, 4)
    sixteen = joined(eight, 8, eight, 8)
    mixed = joined(joined(sixteen, 16, eight, 8), 24, one, 1)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def anchors(data: bytes) -> np.ndarray:
    """The anchor of the string at each place that starts one: the least hash of the grams in it."""
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64)
    least, size, grams = _gram_hashes(np.frombuffer(data, np.uint8)), 1, LENGTH - GRAM + 1
    while 2 * size <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[: len(least) - (grams - size)], least[grams - size :])


def anchored_pieces(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The anchors of a whole text in pieces: first place, anchors from there on."""
    for start in range(0, max(0, len(data) - LENGTH + 1), _PIECE):
        yield start, anchors(data[start : start + _PIECE + LENGTH - 1])


def anchor_set(data: bytes) -> np.ndarray:
    """The different anchors of a text, as signed numbers in order."""
    parts = [found[np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))] for _, found in anchored_pieces(data)]
    return np.unique(np.concatenate(parts).view(np.int64)) if parts else np.zeros(0, np.int64)


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes()


def anchor_sets(texts: DataFrame) -> DataFrame:
    """One row (row, anchors) for each text, with its different anchors in order. It is written, as two steps read it."""

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, 128):
            found = [anchor_set(_bytes(value)) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["row", "anchors"])

    return persisted(texts.select("row", "text").mapInArrow(work, "row bigint, anchors array<bigint>"))


def frequent_anchors(sets: DataFrame, share: float = FREQUENT) -> np.ndarray:
    """Anchors of at least two texts among which are all that ``share`` of all texts have.

    Every task reports what half of this share of its own texts have. What the reports sum up to half the share of
    all texts is taken, which is at most 2 / ``share`` times the anchors of an average text, however many texts there are.
    """

    def report(batches: Iterator[pa.RecordBatch]):
        held, rows = [], 0

        def flush():
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            common = counts >= max(2, share / 2 * rows)
            return pa.RecordBatch.from_arrays([pa.array(found[common]), pa.array(counts[common].astype(np.int64)), pa.array(np.zeros(common.sum(), np.int64))], ["anchor", "n", "texts"])

        for batch in small_batches(batches):
            for value in batch.column(0):
                held.append(value.values.to_numpy())
                rows += 1
                if sum(map(len, held[-64:])) > 1 << 20 or rows % 4096 == 0 and sum(map(len, held)) > 1 << 21:
                    yield flush()
                    yield pa.RecordBatch.from_pydict({"anchor": [0], "n": pa.array([0], pa.int64()), "texts": pa.array([rows], pa.int64())})
                    held, rows = [], 0
        if held:
            yield flush()
            yield pa.RecordBatch.from_pydict({"anchor": [0], "n": pa.array([0], pa.int64()), "texts": pa.array([rows], pa.int64())})

    sums = persisted(sets.select("anchors").mapInArrow(report, "anchor bigint, n bigint, texts bigint").groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")))
    total = sums.agg(F.sum("texts")).first()[0] or 0
    return np.sort(np.array([row.anchor for row in sums.filter(F.col("n") >= F.greatest(F.lit(2.0), F.lit(share / 2 * total))).select("anchor").collect()], np.int64))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known ones, which are in order."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def shared_anchors(sets: DataFrame, frequent) -> DataFrame:
    """One row (row, anchors) for each text with anchors that other texts have too, without the frequent ones."""

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches):
            found = [value.values.to_numpy() for value in batch.column(1)]
            found = [own[~_among(own, frequent.value)] for own in found]
            rows = np.repeat(batch.column(0).to_numpy(), [len(own) for own in found])
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.concatenate(found))], ["row", "anchor"])

    pairs = sets.mapInArrow(cut, "row bigint, anchor bigint")
    counted = pairs.select("row", "anchor", F.expr("count(*) OVER (PARTITION BY anchor)").alias("n")).filter("n > 1")
    return counted.groupBy("row").agg(F.sort_array(F.collect_list("anchor")).alias("anchors"))


def segments(texts: DataFrame, shared: DataFrame, frequent) -> DataFrame:
    """The strings whose anchors other texts have, as segments: anchor, segment (a digest), row, rank, start, bytes.

    A task gives the bytes of a segment that it has met before as null, as far as it remembers.
    """

    def cut(batches: Iterator[pa.RecordBatch]):
        names = ["anchor", "segment", "row", "rank", "start", "bytes"]
        met: set[bytes] = set()
        columns, digests, pieces = [], [], []

        def flush():
            numbers = np.concatenate(columns, axis=1) if columns else np.zeros((4, 0), np.int64)
            anchor, row, rank, start = (pa.array(column) for column in numbers)
            return pa.RecordBatch.from_arrays([anchor, pa.array(digests, pa.binary()), row, rank, start, pa.array(pieces, pa.binary())], names)

        for batch in small_batches(batches, 128):
            if len(met) > _REMEMBERED:
                met.clear()
            for row, rank, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                data, known = _bytes(text), own.values.to_numpy() if own.is_valid else np.zeros(0, np.int64)
                for base, found in anchored_pieces(data):
                    found = found.view(np.int64)
                    starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
                    stops = np.append(starts[1:], len(found))
                    heads = found[starts]
                    hit = _among(heads, known) | _among(heads, frequent.value)
                    starts, stops = starts[hit], stops[hit]
                    counts = -(-(stops - starts) // _RUN)
                    begins = np.repeat(starts, counts) + _RUN * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
                    ends = np.minimum(begins + _RUN, np.repeat(stops, counts)) + base + LENGTH - 1
                    begins += base
                    cuts = [data[begin:end] for begin, end in zip(begins.tolist(), ends.tolist())]
                    named = list(map(xxhash.xxh3_128_digest, cuts))
                    for piece, digest in zip(cuts, named):
                        if digest in met:
                            pieces.append(None)
                        else:
                            met.add(digest)
                            pieces.append(piece)
                    digests += named
                    columns.append(np.stack((np.repeat(heads[hit], counts), np.full(len(begins), row), np.full(len(begins), rank), begins)))
                if len(digests) > 50_000:
                    yield flush()
                    columns, digests, pieces = [], [], []
        yield flush()

    rows = texts.join(shared, "row", "left").select("row", "rank", "text", "anchors")
    return rows.mapInArrow(cut, "anchor bigint, segment binary, row bigint, rank bigint, start bigint, bytes binary")


def segment_runs(contents: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The answers of ``least_ranks`` as arrays: rows (start, stop, least), segment by segment, and the number of rows of each segment."""
    text = np.frombuffer(b"\x00" + b"\x00".join(contents), np.uint8).astype(np.uint16) + 1
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    begins = np.cumsum(sizes + 1) - sizes
    text[begins - 1] = 0  # what parts the segments is smaller than any byte
    order, common = suffix_order(text, LENGTH)
    counts = sizes - LENGTH + 1
    before = np.cumsum(counts) - counts
    segment = np.repeat(np.arange(len(contents)), counts)
    starts = np.arange(len(segment)) + (begins - before)[segment]
    owner = np.full(len(text), -1, np.int64)
    owner[starts] = segment
    own = owner[order] >= 0
    same = np.cumsum(common < LENGTH)[own]  # strings with one number are equal, for common prefixes stop at their length
    places = order[own]
    heads = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
    least = np.empty(len(text), np.int64)
    least[places] = np.repeat(np.minimum.reduceat(ranks[owner[places]], heads), np.diff(np.append(heads, len(places))))
    found = least[starts]
    cuts = np.flatnonzero(np.concatenate(([True], (found[1:] != found[:-1]) | (segment[1:] != segment[:-1]))))
    shift = before[segment[cuts]]
    runs = np.stack((cuts - shift, np.append(cuts[1:], len(found)) - shift, found[cuts]), 1)
    return runs, np.bincount(segment[cuts], minlength=len(contents))


def least_ranks(contents: list[bytes], ranks: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each segment the runs (start, stop, least) of its strings and the smallest rank of a segment of the shard with the same string."""
    runs, counts = segment_runs(contents, ranks)
    return [list(map(tuple, own.tolist())) for own in np.split(runs, np.cumsum(counts)[:-1])]


def distinct_segments(parts: DataFrame) -> DataFrame:
    """Each different segment once, with the smallest rank of its texts: anchor, segment, rank, bytes."""
    return parts.groupBy("anchor", "segment").agg(F.min("rank").alias("rank"), F.first("bytes", ignorenulls=True).alias("bytes"))


def solved(distinct: DataFrame) -> DataFrame:
    """One row (segment, runs) for each segment: see ``least_ranks``. Runs stay arrays, as most segments are short and very many."""
    dealt = distinct.repartition(parallelism(distinct), "anchor").sortWithinPartitions("anchor")
    runs = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("least", pa.int64())]))

    def shards(batches: Iterator[pa.RecordBatch]):
        held, size = [], 0
        for batch in small_batches(batches, 1024):
            anchor = batch.column(0).to_numpy()
            if held and size > _SHARD and (cut := int(np.searchsorted(anchor, held[-1].column(0)[-1].as_py(), "right"))) < len(anchor):
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.column(3).nbytes
        if held:
            yield pa.Table.from_batches(held)

    def work(batches: Iterator[pa.RecordBatch]):
        for shard in shards(batches):
            anchor, ranks, contents = shard.column("anchor").to_numpy(), shard.column("rank").to_numpy(), shard.column("bytes")
            same = anchor[1:] == anchor[:-1]
            several = np.concatenate((same, [False])) | np.concatenate(([False], same))
            # The strings of an anchor's only segment occur nowhere else: its own rank is the answer.
            sizes = pc.binary_length(contents).to_numpy().astype(np.int64)
            places = np.flatnonzero(several)
            counts = np.ones(len(anchor), np.int64)
            if len(places):
                found, counts[places] = segment_runs(contents.take(places).to_pylist(), ranks[places])
            whole = np.stack((np.zeros(len(anchor), np.int64), sizes - LENGTH + 1, ranks), 1)
            flat = np.repeat(whole, counts, axis=0)
            if len(places):
                flat[np.repeat(several, counts)] = found
            values = pa.StructArray.from_arrays([pa.array(column) for column in flat.T.copy()], fields=list(runs.value_type))
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            rows = pa.ListArray.from_arrays(offsets, values)
            yield from pa.table([shard.column("segment"), rows], ["segment", "runs"]).to_batches()

    return dealt.select("anchor", "segment", "rank", "bytes").mapInArrow(work, "segment binary, runs array<struct<start: bigint, stop: bigint, least: bigint>>")


def repeated_strings(texts: DataFrame) -> DataFrame:
    """One row (row, spans) per text with repeats: the places at which strings start that a text of smaller rank has too.

    ``texts`` has row (unique), rank (bigint) and text (binary).
    """
    spark = texts.sparkSession
    sets = anchor_sets(texts)
    frequent = spark.sparkContext.broadcast(frequent_anchors(sets))
    free_shuffles(spark)
    shared = persisted(shared_anchors(sets, frequent))
    discard(sets)
    free_shuffles(spark)
    parts = persisted(segments(texts, shared, frequent))
    free_shuffles(spark)
    distinct = persisted(distinct_segments(parts))
    free_shuffles(spark)
    answers = persisted(solved(distinct))
    free_shuffles(spark)
    later = F.filter("runs", lambda run: run["least"] < F.col("rank"))
    hits = parts.select("segment", "row", "rank", "start").join(answers, "segment").select("row", "start", F.explode(later).alias("run"))
    return hits.groupBy("row").agg(F.collect_list(F.struct((F.col("start") + F.col("run.start")).alias("start"), (F.col("start") + F.col("run.stop")).alias("stop"))).alias("spans"))


def covered(size: int, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of bytes that strings starting within start..stop cover."""
    order = np.argsort(starts)
    begins, ends = starts[order], np.minimum(stops[order] + LENGTH - 1, size)
    reach = np.maximum.accumulate(ends)
    first = np.concatenate(([True], begins[1:] > reach[:-1]))
    return begins[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(reach) - 1)]


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes that stay).

    Bytes covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id go; strings are compared in the
    input. Null text is empty. A null id is larger than any other, so such rows lose what documents with ids have and keep what
    only rows without an id share. Rows with the same id take nothing from each other. An empty table gives no rows.
    """
    rows = persisted(
        docs.select(
            quoted(id).alias("doc_id"),
            F.coalesce(quoted(id).cast("bigint"), F.lit(_NO_ID)).alias("rank"),
            F.octet_length(text_of(text)).cast("bigint").alias("n_bytes"),
            F.sha2(text_of(text), 256).alias("digest"),
        )
    )
    whole = docs.select(F.coalesce(quoted(id).cast("bigint"), F.lit(_NO_ID)).alias("rank"), text_of(text).cast("binary").alias("text"))
    long = whole.filter(F.octet_length("text") >= LENGTH).withColumn("digest", F.sha2("text", 256))
    texts = long.groupBy("digest").agg(F.min("rank").alias("rank"), F.first("text").alias("text"))
    texts = persisted(texts.withColumn("row", F.monotonically_increasing_id()))
    free_shuffles(docs.sparkSession)
    spans = persisted(repeated_strings(texts))
    free_shuffles(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, 128):
            removed, counts, digests, kept = [], [], [], []
            for value, own in zip(batch.column(2), batch.column(3)):
                data = _bytes(value)
                if own.is_valid and len(own):
                    flat = own.values
                    begins, ends = covered(len(data), flat.field("start").to_numpy(), flat.field("stop").to_numpy())
                    gaps = zip([0, *ends.tolist()], [*begins.tolist(), len(data)])
                    counts.append(len(begins))
                    rest = b"".join([data[a:b] for a, b in gaps])
                else:
                    counts.append(0)
                    rest = data
                removed.append(len(data) - len(rest))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_text else None)
            arrays = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["digest", "first", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = texts.join(spans, "row", "left").select("digest", "rank", "text", "spans")
    done = joined.mapInArrow(cut, "digest string, first bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    met = rows.join(done, "digest", "left")
    short, copy = F.col("first").isNull(), F.col("first") < F.col("rank")
    found = met.select(
        "doc_id",
        "n_bytes",
        F.when(short, 0).when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).cast("bigint").alias("n_removed"),
        F.when(short, 0).when(copy, 1).otherwise(F.col("n_spans")).cast("bigint").alias("n_spans"),
        F.when(short, F.col("digest")).when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"), "digest"] if with_text else []),
    )
    if not with_text:
        return found
    small = whole.filter(F.octet_length("text") < LENGTH).select(F.sha2("text", 256).alias("digest"), F.col("text").alias("small")).distinct()
    return found.join(small, "digest", "left").select(*found.columns[:5], F.coalesce("kept", "small").alias("kept"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents"), with_text=False)


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}

ORACLES = {
    "op9_suffix_dedup": f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (
  SELECT doc_id, j, substring(h, 2 * j + 1, 2 * {500 + LENGTH - 1}) AS p
  FROM d, unnest(range(0, length(h) // 2 - {LENGTH - 1}, 500)) AS t(j)),
s AS (
  SELECT doc_id, i + j AS i, substring(p, 2 * i + 1, {2 * LENGTH}) AS w
  FROM pieces, unnest(range(0, length(p) // 2 - {LENGTH - 1})) AS t(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS least FROM s) WHERE least < doc_id),
g AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER p > {LENGTH}, true) AS new FROM r WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
runs AS (
  SELECT doc_id, run, min(i) AS a, max(i) + {LENGTH} AS b
  FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER p, 0) AS a, a AS b FROM runs WINDOW p AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(b), 1000000000 FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""
}
