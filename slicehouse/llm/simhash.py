"""Near-duplicates by SimHash fingerprints, found with Gray-order hierarchical indexes.

Fingerprints within ``DISTANCE`` bits of each other agree on two of four blocks of 16 bits. Each distinct fingerprint is
dealt out by each pair of blocks, with these blocks moved to its front, so that every link lies within a key. The rows of a
key stand in Gray order, in which neighbours share many bits. Sixteen neighbours form a node that keeps the bits they all
share (mask and pattern); nodes form higher nodes in the same way, and a node keeps only what its parent does not have yet. A
search adds up the differences on its way down and leaves a group as soon as they exceed the distance.

A key with more than ``HOT_KEY`` fingerprints is divided again, by each of three parts of its remaining bits (two fingerprints of the
key agree on one of them), so at most 2**22 fingerprints share a key, whatever the corpus.

``near_pairs`` searches the same index within any distance, for operators that check the pairs themselves: with so many blocks that two
rows within the distance agree on some of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import parallelism, persisted, quoted, read_table, small_batches, text_of
from slicehouse.llm.components import connected_components

SHINGLE = 3
DISTANCE = 2
HOT_KEY = 200_000
FANOUT = 16
SEED = 42
#: Pairs of the four 16-bit blocks.
BLOCK_PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]
#: Keys of more rows are searched for rows around a common middle first.
_LARGE = 256
_PIECE = 1 << 20
_QUERIES = 2048
#: Which of the eight bits a byte value has, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 without words.

    A-Z is lower-cased, words are parted by ASCII white space, and each run of ``shingle`` words (all words of a shorter text)
    counts as often as it occurs. A bit is set if it is set in more than half of the XXH64 values.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    counts, total, carried, start = np.zeros(64, np.int64), 0, [], 0
    while start < len(data):
        stop = start + _PIECE
        while stop < len(data) and data[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        words = carried + data[start:stop].split()
        start = stop
        if len(words) < shingle and start < len(data):
            carried = words
            continue
        if not words:
            break
        if len(words) < shingle:
            if total:
                break  # the last shingle has been counted with the piece before
            words, size = [b" ".join(words)], 1
        else:
            size = shingle
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        first = np.concatenate(([0], ends[: len(words) - size])).tolist()
        last = (ends[size - 1 :] - 1).tolist()
        hashed = xxhash.xxh64_digest
        digests = b"".join([hashed(joined[a:b], SEED) for a, b in zip(first, last)])
        values = np.frombuffer(digests, np.uint8).reshape(-1, 8) + np.arange(8) * 256
        seen = np.bincount(values.ravel(), minlength=2048).reshape(8, 256)
        counts += (seen @ _BITS).reshape(64)
        total += len(first)
        carried = words[len(words) - shingle + 1 :] if size == shingle and shingle > 1 else []
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big") if total else 0


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row (doc_id, fp bigint) per document; fp has the bits of the fingerprint as a signed number."""
    rows = docs.select(quoted(id).alias("doc_id"), text_of(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches):
            values = np.array([simhash(value.as_py(), shingle) for value in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "fp"])

    return rows.mapInArrow(work, f"doc_id {rows.dtypes[0][1]}, fp bigint")


def _choices(front: int, blocks: int) -> Column:
    """One array with a struct for each choice of so many blocks to be moved to a fingerprint's front.

    ``f0``, ``f1``, ... are the masks of its blocks and ``s0``, ... by how much they move up; ``r0``, ``r1``, ... are the masks of the others, which
    move down past none, one, ... of them. Bits behind the last block stay there. It is one constant, so that plans stay small with any number of choices.
    """
    width = 64 // blocks
    masks = [((1 << width) - 1) << (64 - width * (block + 1)) for block in range(blocks)]
    structs = []
    for choice in itertools.combinations(range(blocks), front):
        rest = [0] * (front + 1)
        rest[0] = (1 << (64 - width * blocks)) - 1
        for block in range(blocks):
            if block not in choice:
                rest[sum(one > block for one in choice)] |= masks[block]
        named = {f"f{place}": masks[block] for place, block in enumerate(choice)} | {f"r{past}": mask for past, mask in enumerate(rest)}
        fields = [f"'{name}', bigint('{mask - (1 << 64) if mask >> 63 else mask}')" for name, mask in named.items()]
        fields += [f"'s{place}', {width * (block - place)}" for place, block in enumerate(choice)]
        structs.append(f"named_struct({', '.join(fields)})")
    return F.expr(f"array({', '.join(structs)})")


def _turned(fp: Column, move: Column, front: int, blocks: int) -> Column:
    """The fingerprint with the blocks of a choice moved to its front; see ``_choices``."""
    out = fp.bitwiseAND(move["r0"])
    for past in range(1, front + 1):
        out = out.bitwiseOR(F.shiftrightunsigned(fp.bitwiseAND(move[f"r{past}"]), 64 // blocks * past))
    for place in range(front):
        out = out.bitwiseOR(F.call_function("shiftleft", fp.bitwiseAND(move[f"f{place}"]), move[f"s{place}"]))
    return out


def _gray_ranked(rows: DataFrame) -> DataFrame:
    """The rows (bits, ...) with their place in the Gray sequence as ``rank``: each bit is the parity of the bits above it and itself."""
    rows = rows.withColumn("rank", F.col("bits"))
    for shift in (1, 2, 4, 8, 16, 32):  # one column after the other: each is used twice by the next one
        rows = rows.withColumn("rank", F.col("rank").bitwiseXOR(F.shiftrightunsigned("rank", shift)))
    return rows


def _rest_parts(bits: int, parts: int) -> list[tuple[int, int]]:
    """The parts of the bits behind a key: first bit, number of bits."""
    sizes = [bits // parts + (part < bits % parts) for part in range(parts)]
    return [(sum(sizes[:part]), min(size, 11)) for part, size in enumerate(sizes)]


def _dealt(rows: DataFrame, hot_key: int, distance: int, blocks: int) -> DataFrame:
    """Rows (fp, class, ...) by each choice of blocks that fingerprints within the distance may agree on, as (key, bits, ...) in Gray order.

    Rows meet within their class (0 to 127) only.
    """
    front = blocks - distance
    size = 64 // blocks * front
    moved = rows.select("*", F.posexplode(_choices(front, blocks)).alias("choice", "move"))
    turned = moved.select(*rows.columns, "choice", _turned(F.col("fp"), F.col("move"), front, blocks).alias("bits"))
    turned = turned.withColumn("key", F.shiftrightunsigned("bits", 64 - size))
    names = ["choice", "class", "key"]
    hot = turned.groupBy(*names).count().filter(F.col("count") > hot_key).select(*names, F.lit(True).alias("hot"))
    rest = [
        F.struct(
            F.lit(part).alias("part"),
            F.shiftrightunsigned("bits", 64 - size - first - width).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")).alias("sub"),
        )
        for part, (first, width) in enumerate(_rest_parts(64 - size, distance + 1))
    ]
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("bigint").alias("sub")))
    cut = F.explode(F.when(F.col("hot"), F.array(*rest)).otherwise(whole)).alias("cut")
    # The choice (6 bits), the class (7), the blocks' bits (32 at most), the part (4) and its bits (11 at most) as one number.
    packed = F.shiftleft(F.col("choice").cast("bigint"), 54) + F.shiftleft(F.col("class").cast("bigint"), 47) + F.shiftleft("key", 15)
    packed = packed + F.shiftleft(F.col("cut.part").cast("bigint") + 1, 11) + F.col("cut.sub")
    dealt = turned.join(hot, names, "left").select(*rows.columns, "bits", *names, cut).select(*rows.columns, "bits", packed.alias("key"))
    return _gray_ranked(dealt.repartition(parallelism(rows), "key")).sortWithinPartitions("key", "rank")


def near_links(distinct: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """Links (u, v) between the distinct fingerprints (fp) that are at most ``DISTANCE`` bits apart.

    Within each key the links are reduced to a star for each of its components, so the number of rows is at
    most six times (eighteen for hot keys) that of the fingerprints, and no component is lost.
    """

    def work(batches: Iterator[pa.RecordBatch]):
        for keys, fps, bits in whole_keys(batches):
            u, v = key_links(keys, bits)
            yield pa.RecordBatch.from_arrays([pa.array(fps[u]), pa.array(fps[v])], ["u", "v"])

    dealt = _dealt(distinct.select("fp", F.lit(0).alias("class")), hot_key, DISTANCE, 4)
    return dealt.select("key", "fp", "bits").mapInArrow(work, "u bigint, v bigint")


def near_pairs(rows: DataFrame, distance: int, blocks: int, hot_key: int = HOT_KEY) -> DataFrame:
    """Pairs (u, v), u < v, of nodes whose fingerprints are at most so many bits apart, by rows (node, fp, class, late); nodes differ.

    These are candidates for a check that follows, and not all pairs: of rows with equal fingerprints each comes with one of them, of the others each with
    its nearest ones in every key, or with one in the middle of many. So their number grows with the rows and not with the squares of groups.

    ``late`` marks rows that are in the class before, too. Two of them share their key there as well, and each comes with one at least as near from
    there; so they make no pair with each other once more.
    """
    distinct = persisted(rows.groupBy("fp", "class").agg(F.min("node").alias("node"), F.min("late").alias("late")))

    def work(batches: Iterator[pa.RecordBatch]):
        for keys, nodes, late, bits in whole_keys(batches):
            new = not_only_late(keys, late)
            keys, nodes, late, bits = keys[new], nodes[new], late[new].astype(bool), bits[new]
            u, v = key_pairs(keys, bits, nodes, distance)
            once = ~(late[u] & late[v])
            u, v = u[once], v[once]
            both = np.unique(np.sort(np.stack((nodes[u], nodes[v]), 1), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["u", "v"])

    found = _dealt(distinct, hot_key, distance, blocks).select("key", "node", "late", "bits").mapInArrow(work, "u bigint, v bigint")
    least = distinct.filter("not late").select("fp", "class", F.col("node").alias("least"))
    equal = rows.join(least, ["fp", "class"]).filter("node > least").select(F.col("least").alias("u"), F.col("node").alias("v"))
    return found.union(equal).distinct()


def not_only_late(keys: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Which rows have a row in their key that is not late; rows are sorted by key."""
    starts = np.flatnonzero(np.concatenate((np.full(min(1, len(keys)), True), keys[1:] != keys[:-1])))
    if not len(starts):
        return np.zeros(0, bool)
    return np.repeat(~np.logical_and.reduceat(late.astype(bool), starts), np.diff(np.append(starts, len(keys))))


def whole_keys(batches: Iterator[pa.RecordBatch], least: int = 1 << 16):
    """Arrays of rows in which every key is complete, from sorted batches."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        held.append([column.to_numpy(zero_copy_only=False) for column in batch.columns])
        if sum(len(part[0]) for part in held) < least:
            continue
        columns = [np.concatenate(parts) for parts in zip(*held)]
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        if cut:
            yield [column[:cut] for column in columns]
        held = [[column[cut:] for column in columns]]
        least = max(1 << 16, 2 * len(held[0][0]))
    if held:
        yield [np.concatenate(parts) for parts in zip(*held)]


class GrayIndex:
    """The nodes over rows in Gray order, level by level from the rows to one root for each key."""

    def __init__(self, keys: np.ndarray, bits: np.ndarray, fanout: int = FANOUT):
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(starts, len(keys)))
        self.bits, self.root_of = bits, np.repeat(np.arange(len(sizes)), sizes)
        low = high = bits
        self.levels = []
        while True:
            counts = -(-sizes // fanout)  # nodes of each key on the next level
            first = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])) * fanout, counts)
            begin = first + np.arange(counts.sum()) * fanout
            low, high = np.bitwise_and.reduceat(low, begin), np.bitwise_or.reduceat(high, begin)
            self.levels.append((begin, ~(low ^ high), low))
            starts, sizes = np.concatenate(([0], np.cumsum(counts)[:-1])), counts
            if counts.max() == 1:
                break

    def search(self, rows: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of one of these rows and a later row of its key that are at most ``distance`` bits apart."""
        ask, node = rows, self.root_of[rows]
        above = np.zeros(len(rows), np.uint64)
        spent = np.zeros(len(rows), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            begin, mask, pattern = self.levels[level]
            spent = spent + np.bitwise_count((self.bits[ask] ^ pattern[node]) & mask[node] & ~above)
            left = spent <= distance
            ask, node, spent = ask[left], node[left], spent[left]
            below = len(self.bits) if level == 0 else len(self.levels[level - 1][0])
            stop = np.append(begin[1:], below)
            counts = stop[node] - begin[node]
            above = np.repeat(mask[node], counts)
            ask, spent = np.repeat(ask, counts), np.repeat(spent, counts)
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            node = np.repeat(begin[node], counts) + offset
        later = node > ask
        ask, node, spent, above = ask[later], node[later], spent[later], above[later]
        near = spent + np.bitwise_count((self.bits[ask] ^ self.bits[node]) & ~above) <= distance
        return ask[near], node[near]


def key_links(keys: np.ndarray, bits: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Star links between places of rows with the same key that are linked, directly or through others of the key."""
    same = keys[1:] == keys[:-1]
    shared = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    if not len(shared):
        return shared, shared
    index = GrayIndex(keys[shared], bits[shared].view(np.uint64))
    root = np.arange(len(shared))
    for start in range(0, len(shared), _QUERIES):
        a, b = index.search(np.arange(start, min(start + _QUERIES, len(shared))), distance)
        root = joined_roots(root, a, b)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return shared[linked], shared[root[linked]]


def key_pairs(keys: np.ndarray, bits: np.ndarray, nodes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places of rows with the same key at most ``distance`` bits apart; rows are sorted by key and Gray rank. See ``near_pairs``."""
    same = keys[1:] == keys[:-1]
    shared = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    if not len(shared):
        return shared, shared
    keys, bits, order = keys[shared], bits[shared].view(np.uint64), nodes[shared].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    left, found = np.ones(len(keys), bool), []
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    for first, count in zip(starts, np.diff(np.append(starts, len(keys)))):
        rows = np.arange(first, first + count)
        while len(rows) > _LARGE:
            middle = np.packbits(2 * np.unpackbits(bits[rows].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64) > len(rows)).view(np.uint64)
            off = np.bitwise_count(bits[rows] ^ middle)
            # One of those around the middle that is the same in most keys.
            close = rows[off <= max(int(off.min()), distance // 2)]
            lead = close[order[close].argmin()]
            near = rows[np.bitwise_count(bits[rows] ^ bits[lead]) <= distance]
            if 8 * len(near) < len(rows):
                break
            others = near[near != lead]
            left[others] = False
            found.append((others, np.full(len(others), lead)))
            rows = rows[left[rows] & (rows != lead)]
    rest = np.flatnonzero(left)
    index = GrayIndex(keys[rest], bits[rest])
    # The nearest one of those before and of those behind each row: bits of distance, place.
    nearest = np.full((2, len(rest)), np.iinfo(np.int64).max)
    for start in range(0, len(rest), _QUERIES):
        a, b = index.search(np.arange(start, min(start + _QUERIES, len(rest))), distance)
        apart = np.bitwise_count(index.bits[a] ^ index.bits[b]).astype(np.int64) << 40
        np.minimum.at(nearest[0], a, apart | b)
        np.minimum.at(nearest[1], b, apart | a)
    for values in nearest:
        has = np.flatnonzero(values != np.iinfo(np.int64).max)
        found.append((rest[has], rest[values[has] & ((1 << 40) - 1)]))
    return shared[np.concatenate([a for a, _ in found])], shared[np.concatenate([b for _, b in found])]


def joined_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place of each component, when the links a-b are added to components known by their roots."""
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(deeper := root[root], root):
            root = deeper
    return root


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, hot_key: int = HOT_KEY) -> DataFrame:
    """One row (doc_id, fp, component_id) per document; component_id is the smallest id reachable over links.

    Documents without words have fingerprint zero and are linked like others; null text counts as empty. Rows with a null
    id are in their component without naming it (component_id is null if no row of it has an id). Repeated rows are
    repeated. An empty table gives no rows.
    """
    marked = persisted(fingerprints(docs, id, text, shingle))
    distinct = persisted(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(near_links(distinct.select("fp"), hot_key)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, of each component the one with the smallest id only, with all their columns.

    Rows without an id cannot be told apart from each other, so they all stay. Rows that repeat an id stay or go together.
    """
    grouped = near_groups(docs, id, text, **options)
    gone = grouped.filter(F.col("doc_id") > F.col("component_id")).select(F.col("doc_id").alias("id of copy")).distinct()
    return docs.join(gone, quoted(id) == F.col("id of copy"), "left_anti")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    grouped = near_groups(read_table(spark, folder, "documents"))
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash": op6_simhash}
ORACLES: dict[str, str] = {}
