"""Quality by the vote of the nearest labelled documents in a latent-semantic space.

A document's terms are hashed bytes in threes, the shapes of its words, and repetitions of words and lines. Term weights come
from all documents. The space is fitted on at most ``MAX_LABELLED`` labelled rows, whose vectors are broadcast; each
document then takes exact cosines with all of them in blocks, and its nearest ones vote with their similarity as weight.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import quoted, read_table, small_batches, text_of

MAX_LABELLED = 4096
BUCKETS = 2048
SHAPES = 64
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 8
_PIECE = 1 << 20
_BLOCK = 256

_WORD = re.compile(rb"[^\x09-\x0d\x20]+")
_KINDS = np.full(256, 3, np.uint8)  # 0 lower case and beyond ASCII, 1 upper case, 2 digit, 3 sign, 4 space
_KINDS[0x61:0x7B] = 0
_KINDS[0x80:] = 0
_KINDS[0x41:0x5B] = 1
_KINDS[0x30:0x3A] = 2
_KINDS[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = 4


def term_counts(text: str | None) -> np.ndarray:
    """How often each term occurs in a whole text: hashed bytes in threes, then hashed shapes and repetitions.

    Sequences of three kinds of bytes (lower case, upper case, digit, sign, space) stand for shapes. A word that
    repeats the word before, one of the two before that, or a line that repeats an earlier one of its piece, is a term of its own.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.zeros(BUCKETS + SHAPES * 4, np.float32)
    for start in range(0, len(data), _PIECE):
        piece = data[start : start + _PIECE]
        codes = np.frombuffer(piece, np.uint8)
        if len(codes) >= 3:
            low = np.frombuffer(piece.lower(), np.uint8).astype(np.uint32)
            mixed = (low[:-2] * np.uint32(0x9E3779B1)) ^ (low[1:-1] * np.uint32(0x85EBCA77)) ^ (low[2:] * np.uint32(0xC2B2AE3D))
            counts[:BUCKETS] += np.bincount((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(21), minlength=BUCKETS)
            kinds = _KINDS[codes].astype(np.int64)
            counts[BUCKETS : BUCKETS + 125] += np.bincount(kinds[:-2] * 25 + kinds[1:-1] * 5 + kinds[2:], minlength=125)
        words = piece.split()
        same = sum(a == b for a, b in zip(words, words[1:]))
        near = sum(a == b for a, b in zip(words, words[2:]))
        lines = piece.split(b"\n")
        counts[BUCKETS + 128 : BUCKETS + 133] += (same, near, len(lines) - len(set(lines)), len(words), len(words) - len(set(words)))
    return counts


def weights_of(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts)


@dataclass
class Neighbours:
    """What a task needs to score documents."""

    weight: np.ndarray  # of each term
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled rows x dimensions, of length one
    labels: np.ndarray
    base: float  # the share of label 1
    neighbours: int
    sharpness: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        rows = unit_rows(weights_of(counts) * self.weight)
        return unit_rows(rows @ self.axes)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest rows, each with its cosine to the power of ``sharpness``.

        The base rate counts as one distant neighbour, which decides alone for texts without terms.
        """
        out = np.full(len(counts), self.base)
        if not len(self.vectors):
            return out
        for start in range(0, len(counts), _BLOCK):
            cosine = self.project(counts[start : start + _BLOCK]) @ self.vectors.T
            k = min(self.neighbours, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.clip(np.take_along_axis(cosine, near, axis=1), 0, 1).astype(np.float64) ** self.sharpness
            out[start : start + _BLOCK] = ((vote * self.labels[near]).sum(axis=1) + 1e-3 * self.base) / (vote.sum(axis=1) + 1e-3)
        return out


def unit_rows(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(length > 0, length, 1)).astype(np.float32)


def is_held_out(id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(quoted(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """The number of all documents, and in how many of them each term occurs."""
    size = BUCKETS + SHAPES * 4

    def count(batches: Iterator[pa.RecordBatch]):
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                total += term_counts(value.as_py()) > 0
            rows += batch.num_rows
        places = np.append(np.arange(size), -1)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(total, rows))], ["term", "n"])

    found = docs.select(text_of(text)).mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(size + 1, np.int64)
    for row in found:
        total[row.term] = row.n
    return int(total[-1]), total[:-1]


def labelled_weights(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, max_labelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Dampened term counts and labels of at most ``max_labelled`` labelled documents, the first in the order of a hash of id and text.

    Rows without a label or id do not teach. Of several labels for an id the largest is taken.
    """
    known = labels.filter(quoted(label).isNotNull() & quoted(id).isNotNull() & ~is_held_out(id)).groupBy(quoted(id).alias("known id")).agg(
        F.max(quoted(label)).alias("label")
    )
    rows = docs.select(quoted(id).alias("known id"), text_of(text).alias("text"))
    order = F.xxhash64(F.col("known id"), F.lit("teach"))
    picked = known.withColumn("order", order).orderBy("order", "known id").limit(max_labelled)
    taught = rows.join(F.broadcast(picked), "known id").orderBy("order", F.xxhash64("text")).limit(max_labelled)

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches):
            terms = [weights_of(term_counts(value.as_py())).astype(np.float16).tobytes() for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), batch.column(1).cast(pa.float64())], ["terms", "label"])

    rows = taught.select("text", "label").mapInArrow(count, "terms binary, label double").collect()
    weights = np.empty((len(rows), BUCKETS + SHAPES * 4), np.float32)
    for place, row in enumerate(rows):
        weights[place] = np.frombuffer(row.terms, np.float16)
    return weights, np.array([float(row.label > 0) for row in rows])


def main_axes(rows: np.ndarray, dimensions: int, rounds: int = 8) -> np.ndarray:
    """The axes along which the rows are largest (the leading right singular vectors), by subspace iteration."""
    start = np.random.default_rng(7).standard_normal((rows.shape[1], dimensions + 16), dtype=np.float32)
    axes = np.linalg.qr(start)[0]
    for _ in range(rounds if len(rows) else 0):
        axes = np.linalg.qr(rows.T @ (rows @ axes))[0]
    _, turn = np.linalg.eigh((rows @ axes).T @ (rows @ axes))
    return (axes @ turn[:, ::-1])[:, :dimensions].astype(np.float32)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
    sharpness: float = SHARPNESS,
) -> Neighbours:
    """Term weights from all documents, axes and vectors from a bounded number of labelled ones that are not held out."""
    total, having = document_frequencies(docs, text)
    rows, wanted = labelled_weights(docs, labels, id, text, label, max_labelled)
    weight = (np.log((1 + total) / (1 + having)) + 0.1).astype(np.float32)
    rows *= weight
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    axes = main_axes(rows, dimensions)
    base = float(wanted.mean()) if len(wanted) else 0.5
    return Neighbours(weight, axes, unit_rows(rows @ axes), wanted, base, neighbours, sharpness)


def quality_scores(docs: DataFrame, model: Neighbours, text: str = "text", score: str = "score") -> DataFrame:
    """The rows of ``docs`` with their scores between 0 and 1; higher: label 1 is likelier.

    Null text is empty; a text without terms gets the labelled rows' share of label 1 (one half if nothing is
    labelled). A column of ``docs`` with the name of the score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [
                shared.value.scores(np.stack([term_counts(value.as_py()) for value in batch.slice(start, _BLOCK)]))
                for start in range(0, len(batch), _BLOCK)
            ]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    return docs.withColumn(score, F.arrow_udf(work, "double")(text_of(text)))


def keep_good(docs: DataFrame, model: Neighbours, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents with a score of ``least`` or more, with their columns."""
    return quality_scores(docs, model, text, "score of quality").filter(F.col("score of quality") >= least).drop("score of quality")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, folder, "labels"))
    return quality_scores(docs, model).select(
        "doc_id", is_held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


QUERIES = {"op4_quality": op4_quality}
ORACLES: dict[str, str] = {}
