"""Turn repair against a plain left-to-right search, its cells against all derivations, and hot and awkward conversations."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from slicehouse.llm import turn_repair
from slicehouse.llm.turn_repair import best_whole, combined, damaged, digests, edited, parsed, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        told = ":".join(" " if value is None else str(value) for value in (conv, turn))
        fault = zlib.crc32(told.encode()) % 20
        role, text = (" " if value is None else value for value in (role, text))
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def plain_repair(rows):
    """The result for one conversation's rows, by a search over (row, state) for the least (cost, audit)."""
    rows = sorted(rows, key=lambda row: (row[1] is not None, row[1] or 0, row[2], row[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, row, state, made = heapq.heappop(heap)
        if (row, state) in done:
            continue
        done.add((row, state))
        if row == len(rows) and state in (0, 3):
            break
        for initial, role in (("u", "user"), ("a", "assistant")):
            if (state, initial) in steps:
                heapq.heappush(heap, (cost + 2, audit + "I", row, steps[state, initial], (*made, f"{role}:")))
                if row < len(rows) and faults[row] not in ("blank", "duplicate"):
                    add = 2 + (faults[row] == "truncated")
                    heapq.heappush(heap, (cost + add, audit + "R", row + 1, steps[state, initial], (*made, f"{role}:{rows[row][3]}")))
        if row < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", row + 1, state, made))
            own = rows[row][2]
            if faults[row] not in ("blank", "duplicate") and (state, own[:1]) in steps:
                heapq.heappush(heap, (cost + (faults[row] == "truncated"), audit + "K", row + 1, steps[state, own[:1]], (*made, f"{own}:{rows[row][3]}")))
    turns = sorted({turn for _, turn, _, _ in rows if turn is not None})
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, *(faults.count(kind) for kind in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()


def by_conversation(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return out


def got(spark, rows, tasks=5):
    counted, turns = repair(spark.createDataFrame(rows, SCHEMA).repartition(tasks))
    hashes = {row.conv_id: row.repaired_sha256 for row in digests(turns).collect()}
    found = {row.conv_id: (*row[1:], hashes[row.conv_id]) for row in counted.collect()}
    assert len(found) == len(hashes) == counted.count()
    return found


def made(rng, name, count):
    roles = ["user", "assistant", "system", "tool", "", "unknown"]
    texts = ["Yes.", "No", " ", "", "Why?", "And so on.  \n", "\x0b", "a " * 30 + "!", "\xa0"]
    return [(name, rng.choice([None, *range(max(3, count))]), rng.choice(roles[: rng.choice((2, 3, 6))]), rng.choice(texts) if rng.random() < 0.4 else f"t{rng.randrange(99)}.") for _ in range(count)]


def test_against_plain_search(spark):
    rng = random.Random(3)
    rows = [row for name in range(150) for row in made(rng, name, rng.randrange(1, 12))]
    rows += made(rng, None, 7)
    want = {name: plain_repair(own) for name, own in by_conversation(rows).items()}
    assert got(spark, rows) == want


@pytest.mark.parametrize("size", [2, 7])
def test_one_conversation_with_nearly_all_rows(spark, monkeypatch, size):
    monkeypatch.setattr(turn_repair, "FRAGMENT_ROWS", size)
    monkeypatch.setattr(turn_repair, "FANOUT", 3)
    rng = random.Random(size)
    rows = made(rng, 5, 300) + made(rng, 7, 40) + [row for name in range(10, 30) for row in made(rng, name, 5)] + [(2, None, "user", "Same.")] * 9
    want = {name: plain_repair(own) for name, own in by_conversation(rows).items()}
    assert got(spark, rows, 8) == want


def test_cells_are_the_least_of_all_derivations():
    rng = random.Random(4)
    for _ in range(200):
        rows = [(rng.choice("suat"), rng.random() < 0.3, rng.random() < 0.3) for _ in range(rng.randrange(1, 9))]
        cut = rng.randrange(len(rows) + 1)
        whole = parsed(rows)
        if 0 < cut < len(rows):
            assert combined(parsed(rows[:cut]), parsed(rows[cut:])) == whole
        _, cost, audit = best_whole(whole)
        assert sum(letter != "I" for letter in audit) == len(rows)
        turns = edited([({"s": "system", "u": "user", "a": "assistant", "t": "tool"}[initial], "x") for initial, _, _ in rows], 0, audit)
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for edit, role, _ in turns if edit != "D"))


def test_damage_and_query(spark, tmp_path):
    rng = random.Random(6)
    rows = [row for name in range(120) for row in made(rng, name, rng.randrange(1, 8))] + made(rng, None, 5) + [(999, 4, None, None)]
    frame = spark.createDataFrame([(*row, "clash", 1) for row in rows], SCHEMA + ", fault string, place int")
    assert sorted(map(repr, (tuple(row) for row in damaged(frame).collect()))) == sorted(map(repr, plain_damage(rows)))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    own = by_conversation(plain_damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {name: plain_repair(own[name]) if name in own else none for name in by_conversation(rows)}
    found = turn_repair.op13_turn_repair(spark, str(tmp_path))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {row[0]: tuple(row[1:]) for row in found.collect()} == want and found.count() == len(want)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", cells int, digest int")
    counted, turns = repair(empty)
    assert counted.count() == turns.count() == digests(turns).count() == 0
    named = spark.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "assistant", "Ho.")], "`c.d` string, n int, who string, said string")
    counted, turns = repair(named, "c.d", "n", "who", "said")
    assert [tuple(row) for row in counted.collect()] == [("x", 0, 0, 0, 0, 0, 0, "KK")]
    assert [tuple(turn) for row in turns.orderBy("place").collect() for turn in row.turns_made] == [("K", "user", "Hi."), ("K", "assistant", "Ho.")]
