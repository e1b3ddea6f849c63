"""Near-duplicates by the exact Jaccard similarity of word shingles, without a pair of the asked-for similarity missed.

Candidates come from SimHash fingerprints of the same shingles first, searched with the Gray-order index of ``simhash`` within ``DISTANCE`` bits and
among documents of similar length. They are confirmed by the exact similarity of the whole sets, in Spark joins.

No distance finds all pairs of the asked-for similarity. What the index has not connected therefore gets further candidates from prefix filtering: with the
shingles of every set in one global order, two sets of similarity ``4 / 5`` or more share one of the first ``n // 5 + 1`` shingles of each. The order only
decides how many candidates there are: shingles whose counter is high come last. The counters are counted over all documents, and there is a fixed number of
them. Sizes, places in the order and sketches of the sets sort out most candidates, and the rest is confirmed in the same way.

A shingle that very many documents share would give all their pairs. So each document is first compared with one leader of
each of its shingles that it is not connected with; in large groups those not connected yet are then compared with leaders of the largest component. Only what is still not
connected is compared with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicehouse.llm import simhash
from slicehouse.llm.common import discard, free_shuffles, parallelism, persisted, quoted, small_batches, text_of
from slicehouse.llm.components import connected_components
from slicehouse.llm.simhash import whole_keys

SHINGLE = 5
#: Fingerprints so many bits apart are candidates, which agree on two of so many blocks.
DISTANCE = 8
BLOCKS = 10
#: Keys with more fingerprints are divided again.
HOT_KEY = 20_000
#: So many counters tell how frequent shingles are, and so many of them are sent at once.
COUNTERS = 1 << 19
_BLOCK = 1 << 16
#: Leaders of a shingle's documents are chosen in so many ways, by the shingle.
LEADERS = 4
#: In so many ways leaders of the largest component are chosen for those in a large group that no leader has connected.
MORE_LEADERS = 16
#: Cells of a set's sketch. Two sets have no more in common than the sum of the lesser counts of their cells.
CELLS = 256
_FULL = 127
_ODD = ["odd_0", "odd_1", "odd_2", "odd_3"]
#: Groups of at most so many rows are compared all at once.
_SMALL = 256
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The different shingles of a text as sorted 64-bit hashes: A-Z lower-cased, words parted by ASCII white space.

    A text of fewer words has all of them as its only shingle; one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    hashed = xxhash.xxh3_64_intdigest
    values = np.fromiter(map(hashed, words), np.uint64, len(words))
    size = min(shingle, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for place in range(size):
        out = out * _PRIME + values[place : len(words) - size + 1 + place]
    return np.unique(_mixed(out).view(np.int64))


def _counter(values: np.ndarray, counters: int) -> np.ndarray:
    return (values.view(np.uint64) % np.uint64(counters)).astype(np.int64)


def _prefix(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles in the global order, which is by counter and then by hash."""
    order = np.lexsort((values, counts[_counter(values, len(counts))]))
    return values[order[: len(values) // 5 + 1]]


def parities(values: np.ndarray) -> np.ndarray:
    """256 bits, each of which tells whether an odd number of the set's elements falls to it. Two sets differ in no fewer elements than their bits do."""
    bits = np.bincount((_mixed(values.view(np.uint64)) >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _passes(size_a, place_a, size_b, place_b) -> np.ndarray:
    """Whether sets whose first common shingle stands at these places can have four fifths in common."""
    least, most = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    rest = np.minimum(size_a - place_a, size_b - place_b)
    return (5 * least >= 4 * most) & (9 * rest >= 4 * (size_a + size_b))


def _differ_little(odd_a, size_a, odd_b, size_b) -> np.ndarray:
    """Whether sets of these parities can have four fifths in common: then at most a ninth of their elements is in one of them alone."""
    differ = np.bitwise_count((odd_a ^ odd_b).view(np.uint64)).sum(axis=-1, dtype=np.int64)
    return 9 * differ <= size_a + size_b


def leader_pairs(keys, node, size, place) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the rows of a key with one row of it; rows are sorted by key."""
    start = np.concatenate(([True], keys[1:] != keys[:-1]))
    group = np.cumsum(start) - 1
    salt = _mixed(keys.view(np.uint64)) % np.uint64(LEADERS)
    order = np.lexsort((_mixed(node.view(np.uint64) + salt * _PRIME), group))
    lead = order[start][group]
    good = (node != node[lead]) & _passes(size, place, size[lead], place[lead])
    return np.flatnonzero(good), lead[good]


def joining_pairs(keys, node, size, place, odd, comp) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows outside the largest component of a large key with one row inside it; rows are sorted by key."""
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    for first, count in zip(start, np.diff(np.append(start, len(keys)))):
        own = comp[first : first + count]
        if count <= _SMALL or (own == own[0]).all():
            continue
        names, often = np.unique(own, return_counts=True)
        inside = own == names[often.argmax()]
        salt = np.uint64(LEADERS) + _mixed(keys[first : first + 1].view(np.uint64)) % np.uint64(MORE_LEADERS)
        members = first + np.flatnonzero(inside)
        lead = members[_mixed(node[members].view(np.uint64) + salt * _PRIME).argmin()]
        rows = first + np.flatnonzero(~inside)
        rows = rows[_passes(size[rows], place[rows], size[lead], place[lead])]
        rows = rows[_differ_little(odd[rows], size[rows], odd[lead], size[lead])]
        if len(rows):
            yield rows, np.full(len(rows), lead)


def open_pairs(keys, node, size, place, odd, comp) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a key in different components that may be near; rows are sorted by key and size."""
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(start, len(keys)))
    mixed = np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start)
    rows = np.flatnonzero(np.repeat(mixed & (counts <= _SMALL), counts))
    step = 1
    while len(rows):
        rows = rows[rows + step < len(keys)]
        other = rows + step
        near = (keys[rows] == keys[other]) & (4 * size[other] <= 5 * size[rows])
        rows, other = rows[near], other[near]
        good = (comp[rows] != comp[other]) & _passes(size[rows], place[rows], size[other], place[other])
        good[good] = _differ_little(odd[rows[good]], size[rows[good]], odd[other[good]], size[other[good]])
        if good.any():
            yield rows[good], other[good]
        step += 1
    for first, count in zip(start[mixed & (counts > _SMALL)], counts[mixed & (counts > _SMALL)]):
        own, sizes = comp[first : first + count], size[first : first + count]
        names, often = np.unique(own, return_counts=True)
        main = names[often.argmax()]
        # Rows outside the largest component with all rows; so each pair that is not connected comes up.
        for row in first + np.flatnonzero(own != main):
            low = first + np.searchsorted(sizes, -(-4 * size[row] // 5))
            high = first + np.searchsorted(sizes, 5 * size[row] // 4, "right")
            other = np.arange(low, high)
            other = other[(comp[other] != comp[row]) & ((comp[other] == main) | (other > row))]
            other = other[_passes(size[row], place[row], size[other], place[other])]
            other = other[_differ_little(odd[row], size[row], odd[other], size[other])]
            if len(other):
                yield np.full(len(other), row), other


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["u", "v"])


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of rows (node, text); of equal texts in a task only one."""

    def work(batches: Iterator[pa.RecordBatch]):
        seen = set()
        for batch in small_batches(batches, 256):
            nodes, sets = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(shingle_set(text.as_py(), shingle))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return rows.select("node", "text").mapInArrow(work, "node bigint, shingles array<bigint>")


def _counts(rows: DataFrame, shingle: int, counters: int) -> np.ndarray:
    """How often the shingles of each counter occur, in all rows. Each task sends its counters, and the driver gets their sums: a fixed number."""

    def work(batches: Iterator[pa.RecordBatch]):
        total, held, many = np.zeros(counters, np.int64), [], 0
        for batch in small_batches(batches, 256):
            held += [shingle_set(text.as_py(), shingle) for text in batch.column(0)]
            many += sum(map(len, held[-batch.num_rows :]))
            if many > 1 << 20:
                total += np.bincount(_counter(np.concatenate(held), counters), minlength=counters)
                held, many = [], 0
        if held:
            total += np.bincount(_counter(np.concatenate(held), counters), minlength=counters)
        for start in range(0, counters if total.any() else 0, _BLOCK):
            part = np.minimum(total[start : start + _BLOCK], (1 << 32) - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["start", "part"])

    def summed(batches: Iterator[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in small_batches(batches, 16):
            for start, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(part.as_buffer(), np.uint32).astype(np.int64)
                sums[start] = sums[start] + values if start in sums else values
        for start, part in sums.items():
            part = np.minimum(part, (1 << 32) - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["start", "part"])

    form = "start bigint, part binary"
    parts = rows.select("text").mapInArrow(work, form).repartition(parallelism(rows), "start").mapInArrow(summed, form)
    out = np.zeros(counters, np.uint32)
    for row in parts.toLocalIterator():
        part = np.frombuffer(row.part, np.uint32)
        out[row.start : row.start + len(part)] = part
    return out


def sketch(values: np.ndarray) -> np.ndarray:
    """How many elements of a set fall into each cell. A cell that holds more than the form can tell counts as full."""
    cells = (_mixed(values.view(np.uint64)) % np.uint64(CELLS)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=CELLS), _FULL).astype(np.int8)


def _sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """(node, size, full, sketch, parities); ``full`` tells that a cell is, so that its count is no bound."""

    def work(batches: Iterator[pa.RecordBatch]):
        seen = set()
        for batch in small_batches(batches, 256):
            nodes, sizes, full, cells, odd = [], [], [], [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node not in seen:
                    seen.add(node)
                    values = shingle_set(text.as_py(), shingle)
                    found = sketch(values)
                    nodes.append(node)
                    sizes.append(len(values))
                    full.append(bool(found.max(initial=0) == _FULL))
                    cells.append(found)
                    odd.append(parities(values))
            columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(full, pa.bool_()), pa.array(cells, pa.list_(pa.int8()))]
            columns += [pa.array(column) for column in np.array(odd, np.int64).reshape(-1, 4).T.copy()]
            yield pa.RecordBatch.from_arrays(columns, ["node", "size", "full", "sketch", *_ODD])

    return rows.select("node", "text").mapInArrow(work, "node bigint, size int, full boolean, sketch array<tinyint>, " + ", ".join(f"{name} bigint" for name in _ODD)).dropDuplicates(["node"])


def _possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sketches do not rule out a similarity of 4 / 5."""

    def side(name: str) -> DataFrame:
        return sketches.select(F.col("node").alias(name), *[F.col(own).alias(f"{own}_{name}") for own in ("size", "full", "sketch")])

    both = pairs.join(side("u"), "u").join(side("v"), "v")
    common = F.aggregate(F.zip_with("sketch_u", "sketch_v", lambda a, b: F.least(a, b)), F.lit(0), lambda total, count: total + count)
    return both.filter(F.col("full_u") | F.col("full_v") | (9 * common >= 4 * (F.col("size_u") + F.col("size_v")))).select("u", "v")


def _confirmed(pairs: DataFrame, rows: DataFrame, sketches: DataFrame, shingle: int) -> DataFrame:
    """The pairs (u, v) of nodes whose sets have a similarity of 4 / 5 or more.

    Sketches sort out most of the others, so that few whole sets are sent; each set is sent to the pairs of its node as often as these are.
    """
    spark = rows.sparkSession
    every = persisted(pairs.distinct())
    if every.isEmpty():
        return every
    left = persisted(_possible(every, sketches))
    discard(every)
    free_shuffles(spark)
    asked = left.select(F.col("u").alias("node")).union(left.select("v")).distinct()
    sets = persisted(_sets(rows.join(asked, "node", "left_semi"), shingle).dropDuplicates(["node"]))
    both = left.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    both = both.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    found = persisted(both.filter(9 * F.size(F.array_intersect("a", "b")) >= 4 * (F.size("a") + F.size("b"))).select("u", "v"))
    discard(left, sets)
    free_shuffles(spark)
    return found


def index_pairs(rows: DataFrame, sketches: DataFrame, shingle: int) -> DataFrame:
    """Candidates (u, v) from the index of ``simhash``: near nodes by their fingerprints, in classes of sizes of which near sets have the same or the next one."""
    prints = simhash.fingerprints(rows, "node", "text", shingle).withColumnRenamed("doc_id", "node").dropDuplicates(["node"])
    own = F.floor(F.log(F.greatest("size", F.lit(1)).cast("double")) / math.log(1.25)).cast("int")
    classed = prints.join(sketches.select("node", own.alias("own")), "node")
    both = persisted(classed.select("node", "fp", "own", F.explode(F.array("own", F.col("own") + 1)).alias("class")).withColumn("late", F.col("class") > F.col("own")).drop("own"))
    pairs = persisted(simhash.near_pairs(both, DISTANCE, BLOCKS, HOT_KEY))
    discard(both)
    free_shuffles(rows.sparkSession)
    return pairs


def near_links(rows: DataFrame, shingle: int = SHINGLE, counters: int = COUNTERS) -> DataFrame:
    """(node, root) of the nodes that have another one of similarity 4 / 5 or more, by rows (node, text); equal nodes have equal texts."""
    counts = rows.sparkSession.sparkContext.broadcast(_counts(rows, shingle, counters))
    names = ["key", "node", "size", "place"]

    def prefixes(batches: Iterator[pa.RecordBatch]):
        seen = set()
        for batch in small_batches(batches, 256):
            parts = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node in seen:
                    continue
                seen.add(node)
                found = shingle_set(text.as_py(), shingle)
                # Texts without words are near each other.
                keys = _prefix(found, counts.value) if len(found) else np.zeros(1, np.int64)
                parts.append((keys, np.full(len(keys), node), np.full(len(keys), len(found), np.int32), np.arange(len(keys), dtype=np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*parts)], names)

    def shared(batches: Iterator[pa.RecordBatch]):
        for columns in whole_keys(batches):
            same = columns[0][1:] == columns[0][:-1]
            often = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
            yield pa.RecordBatch.from_arrays([pa.array(column[often]) for column in columns], names)

    def leaders(batches: Iterator[pa.RecordBatch]):
        for keys, node, size, place in whole_keys(batches):
            if len(keys):
                a, b = leader_pairs(keys, node, size.astype(np.int64), place.astype(np.int64))
                yield _pair_batch(node[a], node[b])

    def among(pairs):
        """A pass over rows (key, node, size, place, parities, comp) sorted by key that gives the pairs of nodes that ``pairs`` finds."""

        def work(batches: Iterator[pa.RecordBatch]):
            for keys, node, size, place, *parts, comp in whole_keys(batches):
                odd, held, many = np.stack(parts, 1), [], 0
                for a, b in pairs(keys, node, size.astype(np.int64), place.astype(np.int64), odd, comp) if len(keys) else ():
                    held.append((node[a], node[b]))
                    many += len(a)
                    if many > 1 << 18:
                        yield _pair_batch(*map(np.concatenate, zip(*held)))
                        held, many = [], 0
                if held:
                    yield _pair_batch(*map(np.concatenate, zip(*held)))

        return work

    form = "key bigint, node bigint, size int, place int"
    dealt = rows.select("node", "text").mapInArrow(prefixes, form).repartition(parallelism(rows), "key").sortWithinPartitions("key", "size")
    keyed = persisted(dealt.mapInArrow(shared, form))
    free_shuffles(rows.sparkSession)
    # Only of texts that share a shingle with another one.
    met = keyed.select("node").distinct()
    sketches = persisted(_sketches(rows.join(met, "node", "left_semi"), shingle))

    def sorted_keys(frame: DataFrame) -> DataFrame:
        return frame.repartition(parallelism(rows), "key").sortWithinPartitions("key", "size")

    candidates = index_pairs(rows.join(met, "node", "left_semi"), sketches, shingle)
    links = _confirmed(candidates, rows, sketches, shingle)
    discard(candidates)
    comps = persisted(connected_components(links))
    led = sorted_keys(keyed).mapInArrow(leaders, "u bigint, v bigint").distinct()
    for name in ("u", "v"):
        led = led.join(comps.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}")), name, "left")
    apart = ~F.col("root_u").eqNullSafe(F.col("root_v")) | F.col("root_u").isNull()
    links = links.union(_confirmed(led.filter(apart).select("u", "v"), rows, sketches, shingle))
    discard(comps)
    for pairs in (joining_pairs, open_pairs):
        comps = persisted(connected_components(links))
        named = keyed.join(sketches.select("node", *_ODD), "node").join(comps, "node", "left").select(*names, *_ODD, F.coalesce("root", "node").alias("comp"))
        more = _confirmed(sorted_keys(named).mapInArrow(among(pairs), "u bigint, v bigint"), rows, sketches, shingle)
        discard(comps)
        links = links.union(more)
    discard(keyed, sketches)
    return persisted(connected_components(links))


def drop_near(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, counters: int = COUNTERS) -> DataFrame:
    """The documents, of each group linked by similarities of 4 / 5 or more one, with all their columns.

    The row with the smallest id stays; a null id is larger than any other. Of rows that share id and text, which may differ in
    other columns, any one stays; of different texts with the same id that of the smaller hash. Null text counts as empty. Texts are
    told apart by 64-bit hashes.
    """
    names = docs.columns
    inner = docs.toDF(*[f"c{place}" for place in range(len(names))])
    own_id, own_text = f"c{names.index(id)}", f"c{names.index(text)}"
    inner = inner.withColumn("node", F.xxhash64(text_of(own_text)))
    rows = inner.select("node", text_of(own_text).alias("text"))
    roots = near_links(rows, shingle, counters)
    marked = persisted(inner.groupBy("node", quoted(own_id).alias("own")).count())
    rooted = marked.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.col("own").isNull().alias("none"), "own", "node")
    best = rooted.groupBy("root").agg(F.min(order).alias("best"))
    judged = rooted.join(best, "root").select(
        "node", "own", "count", (F.col("own").eqNullSafe(F.col("best.own")) & (F.col("node") == F.col("best.node"))).alias("stays")
    )
    # Few rows are decided about here; all others pass without being shuffled.
    special = persisted(judged.filter("not stays or count > 1").select(F.col("node").alias("n"), F.col("own").alias("o"), "stays"))
    met = (F.col("node") == F.col("n")) & F.col(own_id).eqNullSafe(F.col("o"))
    single = inner.join(special, met, "left_anti")
    repeated = inner.join(special.filter("stays"), met, "left_semi").dropDuplicates(["node", own_id])
    return single.union(repeated).select(*inner.columns[: len(names)]).toDF(*names)
