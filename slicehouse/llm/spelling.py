"""Spelling variants: words one edit apart, found by composing the vocabulary's acceptor with a one-edit transducer and the acceptor again.

In the composition, what is read before the edit is equal on both sides. So its states without an edit are single states of the acceptor, and each
of them is an initial state whose accepted pairs can be enumerated on its own. The vocabulary is dealt out accordingly: words with an equal first
half meet in the partition of the state behind that half, and words with an equal second half in that of the reversed acceptor. Of two words one edit apart
one of the halves is equal, so no pair is missed; a pair whose halves both are counts in the first partition only. Within a partition
the minimised acceptor of what is left of the words is built, composed and enumerated.

A partition of more than ``GROUP`` words is divided by half of what is left again and again, by the same argument. What cannot be divided
further differs in a single code point, so the number of letters bounds it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import map_arrow, parallelism, persisted, quoted, read_table, small_batches

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as its variant.
RATIO = 10
#: In the query, every so many-th run of a document loses a letter.
DAMAGED = 31
#: The most words of one acceptor.
GROUP = 20_000
#: Words that a task counts before it hands them on.
HELD = 400_000
#: Frequencies grow by RATIO along a chain and fit into 63 bits, so a chain has fewer than 19 links.
ROUNDS = 5
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", damaged: int | None = DAMAGED) -> DataFrame:
    """(word, n) of the words of at least seven code points that occur twice or more.

    Words are runs of Latin letters, with A-Z lower-cased. With ``damaged``, a run loses the code point that the CRC of document and run tells
    if ``damaged`` divides it. Null texts have no words; a null id is written as nothing. Repeated rows count as often as they are there.
    """

    def work(batches: Iterator[pa.RecordBatch]):
        counts: Counter = Counter()
        known: dict = {}
        for batch in small_batches(batches, 256):
            for own, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{own}:".encode())
                for run, often in Counter(_RUN.findall(value.as_py())).items():
                    found = known.get(run)
                    if found is None:
                        if len(known) > HELD:
                            known.clear()
                        word = run.translate(_LOWER)
                        found = known[run] = word, word.encode()
                    word, data = found
                    if damaged and (crc := zlib.crc32(data, start)) % damaged == 0:
                        place = crc % len(word)
                        word = word[:place] + word[place + 1 :]
                        if len(word) < LEAST_LENGTH:
                            continue
                    counts[word] += often
                if len(counts) > HELD:
                    yield _count_batch(counts)
                    counts.clear()
        yield _count_batch(counts)

    rows = docs.select(F.coalesce(quoted(id).cast("string"), F.lit("")), quoted(text)).filter(quoted(text).isNotNull())
    return map_arrow(rows, work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _count_batch(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


class Acceptor:
    """The minimal acyclic acceptor of sorted, different words. A state is a number; states come after those they lead to."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []
        self._known: dict = {}
        path: list[tuple[bool, list]] = [(False, [])]  # the states of the last word that may still get arcs
        last = ""
        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
            self._settle(path, last, same)
            path.extend((False, []) for _ in range(len(word) - same))
            path[-1] = (True, path[-1][1])
            last = word
        self._settle(path, last, 0)
        self.start = self._state(*path[0])
        self._known.clear()

    def _settle(self, path: list, word: str, depth: int) -> None:
        while len(path) > depth + 1:
            state = self._state(*path.pop())
            path[-1][1].append((word[len(path) - 1], state))

    def _state(self, final: bool, arcs: list) -> int:
        own = (final, tuple(arcs))
        if own not in self._known:
            self._known[own] = len(self.final)
            self.final.append(final)
            self.arcs.append(dict(arcs))
        return self._known[own]


class Composition:
    """Acceptor, one edit, acceptor: a state is one state without an edit, or a pair of states behind the edit.

    ``replacing`` tells the edit: one code point for another, or one code point more on the right side.
    """

    def __init__(self, acceptor: Acceptor, replacing: bool):
        self.final, self.arcs, self.start, self.replacing = acceptor.final, acceptor.arcs, acceptor.start, replacing
        self._alive: dict[tuple[int, int], bool] = {}
        self._edits: dict[int, list] = {}
        self._fruitful: dict[int, bool] = {}

    def alive(self, left: int, right: int) -> bool:
        """Whether some string leads from both states to final ones."""
        known, todo = self._alive, [(left, right)]
        while todo:
            a, b = both = todo[-1]
            if both in known:
                todo.pop()
            elif a == b or self.final[a] and self.final[b]:
                known[both] = True
            else:
                ahead = [(state, self.arcs[b][letter]) for letter, state in self.arcs[a].items() if letter in self.arcs[b]]
                if any(known.get(pair) for pair in ahead):
                    known[both] = True
                elif missing := [pair for pair in ahead if pair not in known]:
                    todo.append(missing[0])
                else:
                    known[both] = False
        return known[left, right]

    def edits(self, state: int) -> list[tuple[str, str, int, int]]:
        """What the transducer may do here: (letters read, letters written, state, state) with something common behind."""
        if state not in self._edits:
            arcs = list(self.arcs[state].items())
            if self.replacing:
                found = [(a, b, x, y) for i, (a, x) in enumerate(arcs) for b, y in arcs[i + 1 :] if self.alive(x, y)]
            else:
                found = [("", b, state, y) for b, y in arcs if self.alive(state, y)]
            self._edits[state] = found
        return self._edits[state]

    def _is_fruitful(self) -> None:
        for state, arcs in enumerate(self.arcs):  # states come after those they lead to
            self._fruitful[state] = bool(self.edits(state)) or any(self._fruitful[ahead] for ahead in arcs.values())

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All accepted pairs, each once: for a replacement the lesser letter comes first."""
        self._is_fruitful()
        todo = [(self.start, "")]
        while todo:
            state, read = todo.pop()
            for a, b, x, y in self.edits(state):
                for rest in self.common(x, y):
                    if a or rest[:1] != b:  # of equal letters in a row, the last counts as the inserted one
                        yield read + a + rest, read + b + rest
            todo.extend((ahead, read + letter) for letter, ahead in self.arcs[state].items() if self._fruitful[ahead])

    def common(self, left: int, right: int) -> Iterator[str]:
        """The strings that lead from both states to final ones."""
        todo = [(left, right, "")]
        while todo:
            a, b, read = todo.pop()
            if self.final[a] and self.final[b]:
                yield read
            for letter, x in self.arcs[a].items():
                y = self.arcs[b].get(letter)
                if y is not None and self.alive(x, y):
                    todo.append((x, y, read + letter))


def near_pairs(rest: dict[str, list[int]], replacing: bool, backwards: bool) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart of what is left of words, by their minimised acceptor or that of the reversed strings."""
    turn = (lambda value: value[::-1]) if backwards else (lambda value: value)
    for a, b in Composition(Acceptor(sorted(map(turn, rest))), replacing).pairs():
        yield turn(a), turn(b)


def _first_keys(words: DataFrame) -> DataFrame:
    """Each word three times: among those of its length, as the shorter and as the longer of two."""
    length = F.length("word")
    kinds = F.explode(F.array(*(
        F.struct(F.lit(kind).alias("kind"), size.cast("int").alias("short")) for kind, size in (("r", length), ("i", length), ("i", length - 1))
    )))
    return words.select("word", "n", kinds.alias("of")).select(
        "word", "n", "of.kind", "of.short", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(None).cast("int").alias("bar"), F.concat_ws("", "of.kind", "of.short").alias("key")
    )


def _halved(rows: DataFrame) -> DataFrame:
    """Each row under the first and under the second half of what is left of its word (of the shorter of two)."""
    left = F.col("short") - F.col("head") - F.col("tail")
    half = F.floor((left + F.when(F.col("kind") == "i", 1).otherwise(0)) / 2).cast("int")
    rows = rows.withColumn("half", half)
    front = F.substring(F.col("word"), F.col("head") + 1, F.col("half"))
    back = F.substring(F.col("word"), F.length("word") - F.col("tail") - F.col("half") + 1, F.col("half"))
    kept = ["word", "n", "kind", "short"]
    by_front = rows.select(*kept, (F.col("head") + F.col("half")).alias("head"), "tail", "bar", F.concat("key", F.lit("|"), front).alias("key"))
    bar = F.least("bar", F.col("head") + F.col("half")).alias("bar")
    by_back = rows.select(*kept, "head", (F.col("tail") + F.col("half")).alias("tail"), bar, F.concat("key", F.lit("<"), back).alias("key"))
    return by_front.union(by_back)


def _dealt(words: DataFrame, group: int) -> DataFrame:
    """Rows (key, word, n, kind, head, tail, bar), at most ``group`` of a key unless it cannot be divided."""
    ready, rows = None, persisted(_halved(_first_keys(words)))
    while True:
        left = F.col("short") - F.col("head") - F.col("tail")
        large = rows.groupBy("key").agg(F.count("*").alias("many"), F.min(left).alias("left"), F.first("kind").alias("sort"))
        large = persisted(large.filter((F.col("many") > group) & (F.col("left") > F.when(F.col("sort") == "r", 1).otherwise(0))).select("key"))
        if large.isEmpty():
            return rows if ready is None else ready.union(rows)
        small = rows.join(large, "key", "left_anti").select(*rows.columns)
        ready = small if ready is None else ready.union(small)
        rows = persisted(_halved(rows.join(large, "key", "left_semi").select(*rows.columns)))


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n_near, best): of each word with near ones their number and the most frequent, as (-n, word), by rows (word, n)."""

    def found(rows: list[tuple]) -> Iterator[tuple]:
        _, kind, head, tail, bar = rows[0][:5]
        number = {word: n for *_, word, n in rows}
        rest = {word[head : len(word) - tail]: word for word in number}
        near: dict = defaultdict(list)
        # Words of an equal end were dealt out by it last, so what differs lies at the front: the reversed acceptor reads the longer equal part.
        for a, b in near_pairs(rest, kind == "r", bar is not None):
            a, b = rest[a], rest[b]
            if bar is None or a[:bar] != b[:bar]:
                near[a].append((-number[b], b))
                near[b].append((-number[a], a))
        for word, others in near.items():
            yield word, len(others), *min(others)

    def work(batches: Iterator[pa.RecordBatch]):
        held, key = [], None
        for batch in batches:
            out = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[0] != key:
                    if len(held) > 1:
                        out += found(held)
                    held, key = [], row[0]
                held.append(row)
            if out:
                yield _near_batch(out)
        if len(held) > 1:
            yield _near_batch(list(found(held)))

    dealt = _dealt(words, group).select("key", "kind", "head", "tail", "bar", "word", "n").repartition(parallelism(words), "key").sortWithinPartitions("key")
    some = map_arrow(dealt, work, "word string, many bigint, low bigint, other string")
    return some.groupBy("word").agg(F.sum("many").alias("n_near"), F.min(F.struct("low", "other")).alias("best"))


def _near_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"word": pa.string(), "many": pa.int64(), "low": pa.int64(), "other": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds.values())] if rows else [pa.array([], kind) for kind in kinds.values()], list(kinds))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by rows (word, form): each round doubles the links a row has followed."""
    links = persisted(forms.select("word", F.col("form").alias("root")))
    for _ in range(ROUNDS):
        ahead = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        stepped = persisted(links.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            break
    return links


def spelling_variants(words: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """One row for each of the different words (word, n): word, n, n_near, form, form_n, root.

    Near words differ by one inserted, deleted or replaced code point. The form is the near word of largest n, of equal ones the smallest in
    code-point order, if it is ``ratio`` times as frequent or more; the root is where following forms ends. Words of any length from one code point on are taken; a
    task holds an acceptor of at most ``group`` words. A table without rows gives none.
    """
    words = words.filter("word is not null").select("word", "n")
    near = near_words(words, group)
    least = F.lit(ratio) * F.col("n") <= -F.col("best.low")
    judged = persisted(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(least, F.col("best.other")).alias("form"), F.when(least, -F.col("best.low")).alias("form_n"),
    ))
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(persisted(word_counts(read_table(spark, folder, "documents"))))


ORACLE = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i, 0 FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crcs AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS own, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
  SELECT own, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 7 GROUP BY 1, 2
), bytes AS (
  SELECT run, n, list_prepend(4294967295, flatten(list_transform(string_split(own || ':' || run, ''),
    lambda s: CASE WHEN ord(s) < 128 THEN [CAST(ord(s) AS BIGINT)] ELSE [CAST(192 + (ord(s) >> 6) AS BIGINT), CAST(128 + (ord(s) & 63) AS BIGINT)] END))) AS data FROM lowered
), hashed AS (
  SELECT run, n, xor(list_reduce(data, lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM bytes, crcs
), cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), gone AS (
  SELECT word, n, spot, substr(word, 1, CAST(spot AS INT)) || substr(word, CAST(spot AS INT) + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS spot FROM words)
), near AS (
  SELECT a.word AS word, b.word AS other, b.n AS m FROM gone a JOIN gone b ON a.spot = b.spot AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gone g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word, g.n FROM gone g JOIN words w ON g.rest = w.word
), counted AS (
  SELECT word, count(DISTINCT other) AS n_near, max(m) AS top FROM near GROUP BY word
), best AS (
  SELECT c.word, c.n_near, c.top, min(x.other) AS form FROM counted c JOIN near x ON x.word = c.word AND x.m = c.top GROUP BY ALL
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * w.n THEN form END AS form, CASE WHEN top >= 10 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain(word, last, depth) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL SELECT c.word, j.form, depth + 1 FROM chain c JOIN judged j ON j.word = c.last WHERE j.form IS NOT NULL
), roots AS (SELECT word, max_by(last, depth) AS root FROM chain GROUP BY word)
SELECT j.word, j.form, r.root, j.n, CAST(j.n_near AS BIGINT) AS n_near, j.form_n FROM judged j JOIN roots r ON r.word = j.word
"""

QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLES = {"op11_spelling_variants": ORACLE}
