"""Repair of the turn structure of conversations by weighted CYK parsing.

A repaired conversation has the role initials ``(s?(ua)+)?``. While it is written it is in one of four states: at the start, behind a
system turn, behind a user turn, behind an assistant turn. The repair grammar in Chomsky normal form has a nonterminal ``pq`` for each pair of states,
which stands for what takes the output from state p to state q:

- ``pq -> row``: the row is kept, given another role, or deleted;
- ``pq -> pr rq``: two neighbouring spans;
- the insertion closure: turns inserted before and after a row are part of the row's own cells.

The cell of a span and a nonterminal is the least (cost, audit), where the audit has one letter for each edit. Equal costs over the same rows never belong
to audits of which one begins with the other (more insertions cost more), so least cells of parts give the least cell of the whole.
And as every nonterminal may be cut at any place of its span, one cut for each span is enough: spans of 1, 2, 4, ... rows are combined bottom-up,
which takes ``n`` combinations for ``n`` rows and not their cube.

Rows are dealt out by ranges of (conversation, turn, role, text), so a conversation with a third of all rows lies in many tasks. A task parses
what it has of a conversation in fragments. Conversations that lie in one task whole are done then. Of the others, at most one for each boundary
between tasks and those of very many rows, the cells of fragments are combined sixteen at a time, level by level, and the states found at the top
go down the same levels.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from slicehouse.llm.common import parallelism, persisted, quoted, read_table

#: A fragment ends with so many rows, or so many characters.
FRAGMENT_ROWS = 1024
FRAGMENT_CHARS = 4 << 20
#: So many neighbouring cells are combined by one row of the next level.
FANOUT = 16
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"

_EDITED = "array<struct<edit:string,role:string,text:string>>"
_CELLS = "array<struct<p:int,q:int,cost:bigint,audit:string>>"
_COUNTS = "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, least bigint, first_turn bigint, last_turn bigint, first_initial string, last_initial string"
_COUNTED = [part.split()[0] for part in _COUNTS.split(", ")]

Cells = dict[tuple[int, int], tuple[int, str]]


def combined(left: Cells, right: Cells) -> Cells:
    """``pq -> pr rq`` with the least (cost, audit) for each pq."""
    best: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for (other, q), (more, rest) in right.items():
            if r == other:
                whole = (cost + more, audit + rest)
                if (p, q) not in best or whole < best[p, q]:
                    best[p, q] = whole
    return best


def _inserting() -> Cells:
    """What insertions alone do: nothing, or the steps by user and assistant turns."""
    once = {(p, q): (INSERT, "I") for (p, initial), q in STEPS.items() if initial in ROLES}
    closed: Cells = {(p, p): (0, "") for p in range(4)}
    for _ in range(4):
        longer = combined(closed, once)
        closed = {pq: min(found for found in (closed.get(pq), longer.get(pq)) if found) for pq in {*closed, *longer}}
    return closed


@functools.lru_cache(1024)
def row_cells(initial: str, must_go: bool, cut_short: bool) -> Cells:
    """The cells of one row, with insertions before and after it."""
    own: Cells = {(p, p): (DELETE, "D") for p in range(4)}
    if not must_go:
        more = CUT_SHORT if cut_short else 0
        for (p, step), q in STEPS.items():
            if step in ROLES:
                own[p, q] = min(own.get((p, q), (99, "")), (REROLE + more, "R"))
            if step == initial:
                own[p, q] = (more, "K")
    return combined(combined(_inserting(), own), _inserting())


@functools.lru_cache(1 << 14)
def _two(left: tuple, right: tuple) -> Cells:
    return combined(row_cells(*left), row_cells(*right))


def parsed(rows: list[tuple[str, bool, bool]]) -> Cells:
    """The cells of the span of all rows (initial, must go, cut short): spans of 1, 2, 4, ... rows, bottom-up."""
    spans = [_two(*rows[i : i + 2]) if i + 1 < len(rows) else row_cells(*rows[i]) for i in range(0, len(rows), 2)]
    while len(spans) > 1:
        spans = [combined(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def edited(rows: list[tuple[str, str]], state: int, audit: str) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit makes of (role, text), deleted ones included; ``state`` is the one before."""
    out, own = [], iter(rows)
    for letter in audit:
        if letter == "D":
            out.append(("D", *next(own)))
            continue
        role, text = ("", "") if letter == "I" else next(own)
        if letter == "K":
            state = STEPS[state, role[:1]]
        else:
            initial = next(initial for initial in ROLES if (state, initial) in STEPS)
            state, role = STEPS[state, initial], ROLES[initial]
        out.append((letter, role, text))
    return out


def best_whole(cells: Cells) -> tuple[int, int, str]:
    """The least (cost, audit) of a whole conversation, and the state it ends in."""
    cost, audit, state = min((*cells[START, q], q) for q in ENDS if (START, q) in cells)
    return state, cost, audit


def _counts(rows: list[tuple], faults: list[str]) -> tuple:
    """What a fragment adds to the counts of its conversation; rows are (turn, role, text)."""
    initials = [role[:1] for _, role, _ in rows]
    turns = [turn for turn, _, _ in rows if turn is not None]
    return (
        len(rows),
        *(faults.count(kind) for kind in ("blank", "duplicate", "truncated")),
        sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        len(set(turns)),
        turns[0] if turns else None,
        rows[0][0],
        rows[-1][0],
        initials[0],
        initials[-1],
    )


def joined_counts(parts: list[tuple]) -> tuple:
    """The counts of neighbouring parts as one."""
    total = list(parts[0])
    for part in parts[1:]:
        for place in range(6):
            total[place] += part[place]
        total[4] += total[10] + part[9] not in LEGAL
        total[5] -= total[8] is not None and total[8] == part[7]
        total[6] = part[6] if total[6] is None else total[6]
        total[8], total[10] = part[8], part[10]
    return tuple(total)


class _Fragments:
    """The rows of a task, in order, as fragments; a conversation between two others of the task is whole."""

    def __init__(self, part: int):
        self.part, self.seq, self.out = part, 0, []
        self.rows, self.faults, self.chars, self.held = [], [], 0, 0
        self.begun, self.edge, self.cut, self.last = False, True, False, None

    def add(self, name, turn, role: str, text: str, later: bool) -> None:
        if self.begun and name != self.name:
            self.close(whole=not self.edge and not self.cut)
            self.edge, self.cut, self.last = False, False, None
        elif len(self.rows) >= FRAGMENT_ROWS or self.chars > FRAGMENT_CHARS:
            self.close(whole=False)
            self.cut = True
        self.begun, self.name = True, name
        row, shown = (turn, role, text), text.rstrip(BLANKS)
        if not shown:
            fault = "blank"
        elif later or row == self.last:
            fault = "duplicate"
        else:
            fault = "" if shown[-1] in ".!?" else "truncated"
        self.last = row
        self.rows.append(row)
        self.faults.append(fault)
        self.chars += len(text)

    def close(self, whole: bool) -> None:
        rows, faults = self.rows, self.faults
        cells = parsed([(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for (_, role, _), fault in zip(rows, faults)])
        cost = audit = None
        if whole:
            _, cost, audit = best_whole(cells)
            made = edited([row[1:] for row in rows], START, audit)
        else:
            made = [("", role, text) for _, role, text in rows]
        self.out.append((
            self.name, self.part, self.seq, whole, *_counts(rows, faults), cost, audit,
            None if whole else _listed(cells),
            [{"edit": e, "role": r, "text": t} for e, r, t in made],
        ))
        self.held += self.chars
        self.rows, self.faults, self.chars, self.seq = [], [], 0, self.seq + 1


def fragments(rows: DataFrame) -> DataFrame:
    """Fragments of rows (conv_id, turn, role, text): counts, and cost, audit and edited turns, or cells and turns where not whole."""
    digest = F.sha2(F.concat_ws("\0", "role", "text"), 256)
    place = F.struct(F.col("turn").isNotNull().alias("told"), "turn")
    rows = rows.withColumn("digest", digest)
    repeated = rows.groupBy(F.col("conv_id").alias("own"), F.col("digest").alias("same")).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = persisted(repeated.filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last"))
    met = F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("same"))
    marked = rows.join(repeated, met, "left").select("conv_id", "turn", "role", "text", F.coalesce(place > F.col("first"), F.lit(False)).alias("later"))
    dealt = marked.repartitionByRange(parallelism(rows), "conv_id", "turn", "role", F.substring("text", 1, 64))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = dict(rows.dtypes)["conv_id"]
    form = f"conv_id {kind}, part int, seq int, whole boolean, {_COUNTS}, cost bigint, audit string, cells {_CELLS}, turns_made {_EDITED}"
    schema = _arrow_schema(form)

    def work(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        state = _Fragments(TaskContext.get().partitionId())
        for batch in batches:
            names, turns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, turn, role, text, later in zip(names, turns, batch.column(2), batch.column(3), batch.column(4).to_pylist()):
                state.add(name, turn, role.as_py(), text.as_py(), later)
                if len(state.out) >= 256 or state.held > FRAGMENT_CHARS:
                    yield from _batch(state, schema)
            yield from _batch(state, schema)
        if state.rows:
            state.close(whole=False)
        yield from _batch(state, schema)

    return persisted(ordered.mapInArrow(work, form))


def _batch(state: _Fragments, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if state.out:
        yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*state.out), schema)], schema=schema)
        state.out, state.held = [], 0


def _arrow_schema(form: str) -> pa.Schema:
    return pa.schema([(field.name, to_arrow_type(field.dataType)) for field in T.StructType.fromDDL(form)])


def _cells_of(found) -> Cells:
    return {(int(cell["p"]), int(cell["q"])): (int(cell["cost"]), cell["audit"]) for cell in found}


def _listed(cells: Cells) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in sorted(cells.items())]


def path(parts: list[Cells], start: int, end: int) -> list[int]:
    """The states between parts on the best way from ``start`` to ``end``, both included."""
    best = {start: ((0, ""), [start])}
    for part in parts:
        ahead: dict = {}
        for (p, q), (cost, audit) in part.items():
            if p in best:
                (spent, before), states = best[p]
                found = ((spent + cost, before + audit), [*states, q])
                if q not in ahead or found[0] < ahead[q][0]:
                    ahead[q] = found
        best = ahead
    return best[end][1]


def _climb(level: DataFrame) -> DataFrame:
    """Sixteen neighbours of a level as one row of the next."""
    form = f"item bigint, place bigint, {_COUNTS}, cells {_CELLS}"
    schema = _arrow_schema(form)

    def work(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda row: row["place"])
        cells = functools.reduce(combined, (_cells_of(row["cells"]) for row in rows))
        counts = joined_counts([tuple(row[name] for name in _COUNTED) for row in rows])
        out = {"item": rows[0]["item"], "place": rows[0]["place"] // FANOUT, **dict(zip(_COUNTED, counts)), "cells": _listed(cells)}
        return pa.Table.from_pylist([out], schema)

    return level.withColumn("above", F.floor(F.col("place") / FANOUT)).groupBy("item", "above").applyInArrow(work, form)


def _descend(level: DataFrame, above: DataFrame) -> DataFrame:
    """(item, place, p, q) of a level's rows by those of the level above."""
    form = "item bigint, place bigint, p int, q int"
    schema = _arrow_schema(form)

    def work(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda row: row["place"])
        states = path([_cells_of(row["cells"]) for row in rows], rows[0]["p"], rows[0]["q"])
        return pa.Table.from_pylist([{"item": row["item"], "place": row["place"], "p": p, "q": q} for row, p, q in zip(rows, states, states[1:])], schema)

    told = above.select("item", F.col("place").alias("above"), "p", "q")
    rows = level.select("item", "place", "cells", F.floor(F.col("place") / FANOUT).alias("above")).join(told, ["item", "above"])
    return rows.groupBy("item", "above").applyInArrow(work, form)


def _joined(open_parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of conversations in several fragments: their counts, cost and audit, and their turns by fragment.

    A window numbers the keys of fragments alone, of which there is one for a thousand rows.
    """
    keys = open_parts.select("conv_id", "part", "seq")
    order = Window.partitionBy("conv_id").orderBy("part", "seq")
    firsts = keys.withColumn("place", F.row_number().over(order) - 1)
    heads = firsts.filter("place = 0").select(F.col("conv_id").alias("own"), F.monotonically_increasing_id().alias("item"))
    placed = persisted(firsts.join(persisted(heads), F.col("conv_id").eqNullSafe(F.col("own"))).select("conv_id", "part", "seq", "item", F.col("place").cast("bigint")))
    levels = [persisted(open_parts.drop("conv_id").join(placed.drop("conv_id"), ["part", "seq"]).select("item", "place", *_COUNTED, "cells"))]
    while levels[-1].filter("place > 0").limit(1).count():
        levels.append(persisted(_climb(levels[-1])))
    top = levels[-1]
    ways = F.filter("cells", lambda cell: (cell["p"] == START) & cell["q"].isin(*ENDS))
    chosen = F.array_min(F.transform(ways, lambda cell: F.struct(cell["cost"].alias("cost"), cell["audit"].alias("audit"), cell["q"].alias("q"))))
    top = persisted(top.withColumn("chosen", chosen).select("*", F.lit(START).alias("p"), F.col("chosen.q").alias("q")))
    names = placed.filter("place = 0").select("item", "conv_id")
    summary = top.join(names, "item").select("conv_id", *_COUNTED, "chosen.cost", "chosen.audit")
    states = top.select("item", "place", "p", "q")
    for level in reversed(levels[:-1]):
        states = persisted(_descend(level, states))
    told = states.join(placed, ["item", "place"]).select("part", "seq", "place", "p", "q")
    parts = open_parts.join(told, ["part", "seq"]).select("conv_id", "place", "p", "q", "cells", "turns_made")

    @F.udf(_EDITED)
    def made(turns, cells, p, q):
        return edited([(turn["role"], turn["text"]) for turn in turns], p, _cells_of(cells)[p, q][1])

    return summary, parts.select("conv_id", "place", made("turns_made", "cells", "p", "q").alias("turns_made"))


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two frames: one row for each conversation, and its turns after the repair.

    The first has conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit. The second has conv_id, place and ``turns_made``, an array of
    (edit, role, text) in order, in which deleted turns are still there with edit ``D``; place counts the fragments of a conversation, which
    is one row unless it is large or lies between two tasks.

    A null role or text is one space; null turns come first, and rows of the same turn are ordered by role and text. Rows whose conversation is null
    are a conversation of their own. Repeated rows count as many times, and all but the first are duplicates. An empty text is blank. Any number and length
    of turns is taken. An empty table gives no rows; further columns are not looked at.
    """
    plain = rows.select(
        quoted(conversation).alias("conv_id"), quoted(turn).cast("bigint").alias("turn"), *(F.coalesce(quoted(name).cast("string"), F.lit(" ")).alias(own) for name, own in ((role, "role"), (text, "text")))
    )
    every = fragments(plain)
    whole = every.filter("whole")
    summary, parts = _joined(every.filter("not whole"))
    counted = whole.select("conv_id", *_COUNTED, "cost", "audit").union(summary)
    gaps = F.coalesce(F.col("last_turn") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    counted = counted.select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return counted, whole.select("conv_id", F.lit(0).cast("bigint").alias("place"), "turns_made").union(parts)


def lines(turns: Column) -> Column:
    """``role:text`` of the turns that are left, joined by line breaks."""
    kept = F.filter(turns, lambda turn: turn["edit"] != "D")
    return F.array_join(F.transform(kept, lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"])), "\n")


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines. A digest goes through its text from the first to the last byte, so a conversation of several fragments
    is one stream of rows through its task, which holds one of them at a time."""
    several = persisted(turns.filter("place > 0").select(F.col("conv_id").alias("own")).distinct())
    met = F.col("conv_id").eqNullSafe(F.col("own"))
    one = turns.join(several, met, "left_anti").select("conv_id", F.sha2(lines(F.col("turns_made")), 256).alias("repaired_sha256"))
    rows = turns.join(several, met, "left_semi").select("conv_id", "place", F.posexplode("turns_made").alias("row", "turn")).filter("turn.edit != 'D' or row = 0")
    line = F.when(F.col("turn.edit") != "D", F.concat("turn.role", F.lit(":"), "turn.text"))
    dealt = rows.select("conv_id", "place", "row", line.alias("line")).repartition(parallelism(turns), "conv_id").sortWithinPartitions("conv_id", "place", "row")
    kind = dict(turns.dtypes)["conv_id"]

    def work(batches: Iterator[pa.RecordBatch]):
        name, digest, empty = None, None, True
        for batch in batches:
            out = []
            for own, value in zip(batch.column(0).to_pylist(), batch.column(3)):
                if digest is None or own != name:
                    if digest is not None:
                        out.append((name, digest.hexdigest()))
                    name, digest, empty = own, hashlib.sha256(), True
                if (text := value.as_py()) is not None:
                    digest.update((text if empty else "\n" + text).encode())
                    empty = False
            if out:
                yield _digest_batch(out, batch.schema.field(0).type)
        if digest is not None:
            yield _digest_batch([(name, digest.hexdigest())], batch.schema.field(0).type)

    return one.union(dealt.mapInArrow(work, f"conv_id {kind}, repaired_sha256 string"))


def _digest_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names, values = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array(values)], ["conv_id", "repaired_sha256"])


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with the faults that the query repairs."""
    told = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *told).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.withColumn("fault", fault).filter("fault != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = read_table(spark, folder, "conversations")
    counted, turns = repair(damaged(given))
    hashed = digests(turns).withColumnRenamed("conv_id", "other")
    every = given.select(F.col("conv_id").alias("own")).distinct()
    found = counted.join(hashed, F.col("conv_id").eqNullSafe(F.col("other")))
    numbers = [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("own").alias("conv_id"),
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _add(key: str, cost: object, letter: str) -> str:
    """SQL: a state's key, which is its cost in nine digits and its audit, with one edit more. Keys sort as (cost, audit) do."""
    return f"lpad(CAST(CAST(substr({key}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({key}, 10) || '{letter}'"


def _oracle() -> str:
    insert = {state: _add(state, INSERT, "I") for state in ("n0", "n1", "n3", "c2")}
    keep = {(p, i): f"CASE WHEN free AND initial = '{i}' THEN {_add(p, 'short', 'K')} END" for p in ("k0", "k1", "k2", "k3") for i in "sua"}
    rerole = {p: f"CASE WHEN free THEN {_add(p, f'({REROLE} + short)', 'R')} END" for p in ("k0", "k1", "k2", "k3")}
    drop = {p: _add(p, DELETE, "D") for p in ("k0", "k1", "k2", "k3")}
    user = ", ".join(f"{keep[p, 'u']}, {rerole[p]}" for p in ("k0", "k1", "k3"))
    return f"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i, 0 FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crcs AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS told FROM conversations
), hashed AS (
  SELECT given.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(told, ''), lambda s: CAST(ord(s) AS BIGINT))),
    lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS harm FROM given, crcs
), harmed AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM hashed, (VALUES (1), (2)) AS v(copy) WHERE harm <> 0 AND (copy = 1 OR harm = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM harmed
), judged AS (
  SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed
), walk(conv_id, place, k0, k1, k2, k3) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), '000000002I', '000000004II' FROM judged
  UNION ALL SELECT conv_id, place, n0, n1, c2, least(n3, {insert['c2']}) FROM (
    SELECT *, least(n2, {insert['n0']}, {insert['n1']}, {insert['n3']}) AS c2 FROM (
      SELECT conv_id, place, {drop['k0']} AS n0, least({drop['k1']}, {keep['k0', 's']}) AS n1, least({drop['k2']}, {user}) AS n2,
        least({drop['k3']}, {keep['k2', 'a']}, {rerole['k2']}) AS n3
      FROM (SELECT w.*EXCLUDE (place), j.place, j.initial, j.fault NOT IN ('blank', 'duplicate') AS free, CASE j.fault WHEN 'truncated' THEN {CUT_SHORT} ELSE 0 END AS short
        FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1)))
), best AS (
  SELECT conv_id, CAST(substr(key, 1, 9) AS BIGINT) AS cost, substr(key, 10) AS audit FROM (SELECT conv_id, arg_max(least(k0, k3), place) AS key FROM walk GROUP BY conv_id)
), letters AS (
  SELECT conv_id, audit, spot, substr(audit, spot, 1) AS letter, length(replace(substr(audit, 1, spot), 'I', '')) AS row_,
    length(replace(substr(audit, 1, spot), 'D', '')) - length(replace(audit, 'D', '')) % 2 AS turn_
  FROM (SELECT conv_id, audit, CAST(unnest(range(1, length(audit) + 1)) AS INT) AS spot FROM best)
), lines AS (
  SELECT l.conv_id, spot, CASE WHEN letter = 'K' THEN role WHEN turn_ % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM letters l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.place = l.row_ WHERE letter <> 'D'
), hashes AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY spot)) AS hash FROM lines GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
"""


QUERIES = {"op13_turn_repair": op13_turn_repair}
ORACLES = {"op13_turn_repair": _oracle()}
