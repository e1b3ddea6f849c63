"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark's texts, one set for each length. A set has a table of shifts by block (the
last two words in view): a block that no pattern holds lets the search jump, and a block that ends a pattern
leads to the patterns with this ending, which are then compared word by word.

The windows are broadcast in parts of ``part_windows`` windows at most. More windows than that are searched for in
further passes of the same job over the texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import quoted, read_table, small_batches

WINDOW = 10
PART_WINDOWS = 200_000
_PIECE = 1 << 20

#: Bytes of words stay (digits, lower-case letters, all that is not ASCII), A-Z becomes lower case, others part words.
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)

FOUND = "struct<n_words: bigint, spans: array<struct<start: bigint, stop: bigint>>, items: array<bigint>>"
_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        ("items", pa.list_(pa.int64())),
    ]
)


def words_in_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about a megabyte, so that a very long text needs little memory."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    start = 0
    while start < len(data):
        stop = start + _PIECE
        stop = len(data) if stop >= len(data) or (cut := data.find(b" ", stop)) < 0 else cut
        yield data[start:stop].split()
        start = stop


def windows_of(text: str | None, size: int = WINDOW) -> set[tuple[bytes, ...]]:
    """The distinct windows of an item: ``size`` consecutive words, or all words of a shorter item, if it has any."""
    words = [word for piece in words_in_pieces(text) for word in piece]
    if not words:
        return set()
    return {tuple(words[at : at + size]) for at in range(max(1, len(words) - size + 1))}


class WuManber:
    """Patterns of one length with their shift table and their buckets by last block."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[int]]):
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.jump = self.length - self.block + 1
        self.shifts: dict = {}
        self.buckets: dict = {}
        for pattern, items in patterns.items():
            for stop in range(self.block, self.length + 1):
                block = pattern[stop - self.block : stop]
                self.shifts[block] = min(self.length - stop, self.shifts.get(block, self.jump))
            self.buckets.setdefault(pattern[-self.block :], []).append((pattern[0], list(pattern), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Start and items of each occurrence."""
        length, jump, shift_of, block = self.length, self.jump, self.shifts.get, self.block
        at, count = length - 1, len(words)
        while at < count:
            last = (words[at - 1], words[at]) if block == 2 else (words[at],)
            if shift := shift_of(last, jump):
                at += shift
                continue
            start = at - length + 1
            for first, pattern, items in self.buckets[last]:
                if first == words[start] and pattern == words[start : at + 1]:
                    yield start, items
            at += 1


def tables_of(rows: list[tuple[list[bytes], int | None]]) -> list[WuManber]:
    """One search table for each length of pattern. A null item is searched for without being named."""
    by_length: dict[int, dict[tuple[bytes, ...], list[int]]] = {}
    for words, item in rows:
        items = by_length.setdefault(len(words), {}).setdefault(tuple(words), [])
        if item is not None:
            items.append(item)
    return [WuManber(patterns) for _, patterns in sorted(by_length.items())]


def search_text(tables: list[WuManber], text: str | None) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, merged spans of words that are hit, and items found."""
    overlap = max((table.length for table in tables), default=1) - 1
    carried: list[bytes] = []
    seen, found, items = 0, [], set()
    for piece in words_in_pieces(text):
        words, base = carried + piece, seen - len(carried)
        for table in tables:
            for start, names in table.search(words):
                found.append((base + start, base + start + table.length))
                items.update(names)
        seen += len(piece)
        carried = words[-overlap:] if overlap else []
    return seen, merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(set(spans)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct (words, item) of all items: words array<binary>, item bigint."""

    def split(batches):
        for batch in small_batches(batches):
            words, items = [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = windows_of(value, size)
                words.extend(found)
                items.extend([name] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.binary())), pa.array(items, pa.int64())], ["words", "item"])

    rows = benchmark.select(quoted(item).cast("bigint").alias("item"), quoted(text).alias("text"))
    return rows.mapInArrow(split, "words array<binary>, item bigint").distinct()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    keep: list[str] | None = None,
    found: str = "found",
    part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """The columns ``keep`` of every document (all if None) and ``found``: its number of words, the spans of words that are
    hit, merged, and the ids of the items whose windows occur, in order.

    Null and empty texts have no words and no hits; items without words have no windows; a null item hits but is not
    listed; an item in several rows is one item. Repeated documents are repeated in the result. A column of ``docs`` with
    the name of ``found`` is replaced.
    """
    spark = docs.sparkSession
    keep = [name for name in (docs.columns if keep is None else keep) if name != found]
    windows = benchmark_windows(benchmark, item, item_text, size)
    parts = -(-windows.count() // part_windows) or 1
    kept = docs.select(*[quoted(name) for name in keep])
    out_schema = ", ".join([f"`{name}` {kind}" for name, kind in kept.dtypes] + [f"`{found}` {FOUND}"])
    text_schema = out_schema + ", `text for search` string"
    rows = docs.select(*[quoted(name) for name in keep], F.lit(None).cast(FOUND).alias(found), quoted(text).alias("text for search"))
    for part in range(parts):
        own = windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == part).collect()
        tables = spark.sparkContext.broadcast(tables_of([(list(map(bytes, row.words)), row.item) for row in own]))
        last = part == parts - 1
        rows = rows.mapInArrow(_pass(tables, last), out_schema if last else text_schema)
    return rows


def _pass(tables, last: bool):
    def work(batches):
        for batch in small_batches(batches):
            out = []
            before = batch.column(batch.num_columns - 2).to_pylist()
            for text, old in zip(batch.column(batch.num_columns - 1), before):
                n_words, spans, items = search_text(tables.value, text.as_py())
                if old:
                    spans = merged(spans + [(span["start"], span["stop"]) for span in old["spans"]])
                    items |= set(old["items"])
                out.append({"n_words": n_words, "spans": [{"start": a, "stop": b} for a, b in spans], "items": sorted(items)})
            arrays = batch.columns[:-2] + [pa.array(out, _FOUND)]
            yield pa.RecordBatch.from_arrays(arrays + ([] if last else [batch.columns[-1]]), batch.schema.names[: -1 if last else None])

    return work


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{place}" for place in range(len(names))])
    marked = find_leaks(plain, benchmark, text=f"c{names.index(text)}", **options)
    return marked.filter(F.size("found.spans") == 0).drop("found").toDF(*names)


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda total, span: total + span["stop"] - span["start"])
    names = F.array_join(F.array_sort(F.transform("found.items", lambda item: item.cast("string"))), ",")
    return find_leaks(docs, benchmark, keep=["doc_id"]).select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


QUERIES = {"op10_decontaminate": op10_decontaminate}

_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLES = {
    "op10_decontaminate": f"""
WITH bw AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
pat AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS p
  FROM bw, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM pat),
dw AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
occ AS (
  SELECT d.doc_id, d.i, d.m, pat.item_id
  FROM (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS p
        FROM dw, sizes, unnest(range(1, len(w) - m + 2)) AS t(i) WHERE len(w) >= m) d
  JOIN pat ON pat.m = d.m AND pat.p = d.p),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM occ, unnest(range(i, i + m)) AS t(place) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
}
