"""Tokens, packing, token counts, quality, decontamination: brute force, round trips, held-out accuracy, awkward tables."""

import collections
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slicehouse.llm.decontaminate import WuManber, decontaminate, find_leaks, windows_of
from slicehouse.llm.packing import first_fit_decreasing, pack_documents
from slicehouse.llm.quality import fit, is_held_out, keep_good, quality_scores
from slicehouse.llm.token_counts import count_tokens, flat_files, read_flat_files
from slicehouse.llm.tokens import Encoder, cut_documents

DOCS = "doc_id bigint, text string, found string, score int, start int"


def docs(spark, rows):
    return spark.createDataFrame([(i, text, "f", 1, 2) for i, text in rows], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


TEXTS = [
    "", "One two, three.", "it's don't WE'LL 12a3", "a\tb\r\nc d  e\n\nf", "ÉÀ ß ẞ İI ΣΑΣ ﬁ é ́x", "!!! ### a!!! ...a.b... (x)", "<|endoftext|> <|STARTOFTEXT|>x",
    "日本語 テキスト 한국어 😀😀", "word" * 400, "a" * 3000 + " " + "b c " * 900, "\x1c\x1d \x85   x", "A.B,C;D: $5.00 50% Ünï-cödé",
]


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    import slicehouse.llm.tokens as module

    wanted = [tokenizer.encode(text, add_special_tokens=False).ids for text in TEXTS]
    for piece, cached in ((1 << 20, 600_000), (64, 40)):
        monkeypatch.setattr(module, "_PIECE", piece)
        encoder = Encoder(cached=cached)
        for _ in range(2):
            for text, ids in zip(TEXTS, wanted):
                data = b"".join(encoder.pieces(text))
                assert list(struct.unpack(f"<{len(data) // 4}I", data)) == ids, text


def test_packing_is_a_round_trip(spark, tokenizer):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(TEXTS) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(100, "one two three " * 4000), (101, None), (None, "no id"), (5, "again"), (5, "again")]
    got = pack_documents(docs(spark, rows), length=256, group=32).collect()
    wanted = collections.Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 256):
            part = ids[start : start + 256]
            wanted[i, start, len(part), len(ids), struct.pack(f"<{len(part)}I", *part)] += 1
    assert collections.Counter((row.doc_id, row.start, row.length, row.doc_tokens, bytes(row.ids)) for row in got) == wanted
    sequences = collections.defaultdict(list)
    for row in got:
        sequences[row.sequence_id].append((row.offset, row.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 256
    assert pack_documents(docs(spark, [])).count() == 0


def test_first_fit_decreasing_by_brute_force():
    rng = random.Random(6)
    for _ in range(30):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(1, 80))]
        free, wanted = [], [0] * len(sizes)
        for item in sorted(range(len(sizes)), key=lambda item: -sizes[item]):
            place = next((at for at, room in enumerate(free) if room >= sizes[item]), len(free))
            if place == len(free):
                free.append(50)
            free[place] -= sizes[item]
            wanted[item] = place
        assert first_fit_decreasing(sizes, 50) == wanted


def test_pieces_of_repeated_rows_and_sizes(spark):
    got = cut_documents(docs(spark, [(1, "a b c"), (1, "a b c"), (2, "")]), 2).collect()
    assert collections.Counter((row.doc_id, row.start, row.length, row.doc_tokens) for row in got) == collections.Counter(
        {(1, 0, 2, 4): 2, (1, 2, 2, 4): 2, (2, 0, 1, 1): 1}
    )


def test_token_counts_over_blocks_by_brute_force(spark):
    rng = random.Random(9)
    blocks, wanted = [], []
    for name in ("a", "b", "c"):
        ids = [rng.choice([7, 1, 2, 3, 4]) for _ in range(rng.randint(40, 90))]
        if name == "c":
            ids = [1] * 50 + [7]
        start, place = 0, 0
        for at, value in enumerate(ids):
            if value == 7:
                wanted.append((name, place, start, at - start, True))
                start, place = at + 1, place + 1
        if start < len(ids):
            wanted.append((name, place, start, len(ids) - start, False))
        for block, at in enumerate(range(0, len(ids), 5)):
            part = ids[at : at + 5]
            blocks.append((name, 3 * block, bytearray(struct.pack(f"<{len(part)}H", *part)), "extra"))
    blocks += [("empty", 0, None, "x"), ("only", 0, bytearray(struct.pack("<2H", 7, 7)), "x")]
    wanted += [("only", 0, 0, 0, True), ("only", 1, 1, 0, True)]
    frame = spark.createDataFrame(blocks, "file string, block bigint, tokens binary, start string")
    for span in (1024, 2, 6):
        assert sorted(map(tuple, count_tokens(frame, 7, span=span).collect())) == sorted(wanted)
    assert count_tokens(frame.limit(0), 7).count() == 0


def test_flat_files_hold_every_document(spark, tokenizer, tmp_path):
    rows = [(i, text) for i, text in enumerate(TEXTS * 3 + [None])]
    files = flat_files(docs(spark, rows).repartition(3), block_tokens=16)
    plain = __import__("tokenizers").Tokenizer.from_str(tokenizer.to_str())
    plain.encode_special_tokens = True
    wanted = collections.Counter(len(plain.encode(text or "", add_special_tokens=False).ids) for _, text in rows)
    assert collections.Counter(row.n_tokens for row in count_tokens(files).collect()) == wanted
    (tmp_path / "one.bin").write_bytes(struct.pack("<7H", 5, 6, 49407, 49407, 8, 49407, 9))
    read = count_tokens(read_flat_files(spark, str(tmp_path), block_tokens=2)).collect()
    assert sorted((row.place, row.start, row.n_tokens, row.ended) for row in read) == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, True), (3, 6, 1, False)]


def test_quality_on_held_out_rows(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", F.lit(0).alias("score"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality_scores(frame, fit(frame, labels)).join(labels, "doc_id").filter(is_held_out()).collect()
    assert all(0 <= row.score <= 1 for row in got)
    good = np.array([row.score for row in got if row.quality == 1])
    bad = np.array([row.score for row in got if row.quality == 0])
    assert len(good) > 30 and len(bad) > 5
    assert np.mean([(good > one).mean() + 0.5 * (good == one).mean() for one in bad]) > 0.97


def test_held_out_rows_do_not_teach(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    frame = docs(spark, [(i, f"text {i}") for i in ids])
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id bigint, quality int")
    model = fit(frame, labels)
    assert len(model.vectors) == 0
    assert {row.score for row in quality_scores(frame, model).collect()} == {0.5}
    assert fit(frame, labels.limit(0)).base == 0.5


def test_quality_of_awkward_rows(spark):
    rng = random.Random(1)
    good = [(i, " ".join(rng.choice(["river", "stone", "the", "of", "light"]) for _ in range(60))) for i in range(120)]
    bad = [(1000 + i, " ".join(rng.choice(["BUY", "NOW", "$$$", "!!!"]) for _ in range(60))) for i in range(120)]
    rows = good + bad + [(5000, None), (5001, ""), (None, good[0][1]), (5002, "river of light " * 80_000), (5, good[5][1])]
    frame = docs(spark, rows)
    labels = spark.createDataFrame([(i, 1, 9) for i, _ in good] + [(i, 0, 9) for i, _ in bad] + [(None, 1, 9), (3, None, 9)], "doc_id bigint, quality int, text int")
    model = fit(frame, labels, max_labelled=100)
    assert len(model.vectors) == 100
    scored = quality_scores(frame, model)
    assert scored.columns == frame.columns and dict(scored.dtypes)["score"] == "double"
    got = {row.doc_id: row.score for row in scored.collect()}
    assert got[5000] == got[5001] == pytest.approx(model.base)
    assert got[None] > 0.5 and got[5002] > 0.5
    kept = keep_good(frame, model)
    assert kept.columns == frame.columns
    assert {i for i, _ in good} <= {row.doc_id for row in kept.collect()} and not {i for i, _ in bad} & {row.doc_id for row in kept.collect()}
    assert keep_good(docs(spark, []), model).count() == 0 and len(fit(docs(spark, []), labels).vectors) == 0


def plain_words(text):
    found, word = [], ""
    for char in (text or "") + " ":
        low = char.lower() if char.isascii() else char
        if not char.isascii() or low.isalnum():
            word += low
        elif word:
            found.append(word)
            word = ""
    return found


def plain_leaks(rows, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        found = plain_words(text)
        for at in range(max(1, len(found) - 9) if found else 0):
            windows[tuple(found[at : at + 10])].add(item)
    out = collections.Counter()
    for i, text in rows:
        found, hit, named = plain_words(text), set(), set()
        for window, own in windows.items():
            for at in range(len(found) - len(window) + 1):
                if tuple(found[at : at + len(window)]) == window:
                    hit |= set(range(at, at + len(window)))
                    named |= own
        spans = tuple((a, b) for a, b in zip(sorted(h for h in hit if h - 1 not in hit), sorted(h + 1 for h in hit if h + 1 not in hit)))
        out[i, len(found), spans, tuple(sorted(name for name in named if name is not None))] += 1
    return out


@pytest.mark.parametrize("part_windows", [200_000, 7])
def test_leaks_by_brute_force(spark, monkeypatch, part_windows):
    import slicehouse.llm.decontaminate as module

    monkeypatch.setattr(module, "_PIECE", 40)
    rng = random.Random(3)
    pool = ["a", "b", "c", "É", "x1"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(8, 16)))) for i in range(12)]
    items += [(50, "lone"), (51, "two words"), (52, "Two, WORDS"), (53, None), (54, "  "), (None, "null item here"), (3, "a second text of three")]
    rows = [(i, ", ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(100, "A " + items[0][1].upper() + "!"), (101, None), (102, ""), (103, "lone LONE two\nwords null item here"), (None, items[1][1]), (7, "lone"), (7, "lone")]
    benchmark = spark.createDataFrame([(i, text, "k") for i, text in items], "item_id bigint, text string, doc_id string")
    got = find_leaks(docs(spark, rows), benchmark, keep=["doc_id"], part_windows=part_windows).collect()
    assert collections.Counter((row.doc_id, row.found.n_words, tuple(map(tuple, row.found.spans)), tuple(row.found["items"])) for row in got) == plain_leaks(rows, items)
    left = decontaminate(docs(spark, rows), benchmark, part_windows=part_windows)
    assert left.columns == DOCS.replace(" bigint", "").replace(" string", "").replace(" int", "").split(", ")
    assert collections.Counter(row.doc_id for row in left.collect()) == collections.Counter(
        {i: n for (i, _, spans, _), n in plain_leaks(rows, items).items() if not spans}
    )
    assert find_leaks(docs(spark, rows), benchmark.limit(0)).filter(F.size("found.spans") > 0).count() == 0
    assert find_leaks(docs(spark, []), benchmark).count() == 0


def test_wu_manber_jumps_over_blocks_without_patterns():
    table = WuManber({tuple(b"a b c d e f g h i j".split()): [1]})
    assert table.jump == 9 and table.shifts[(b"i", b"j")] == 0 and table.shifts[(b"a", b"b")] == 8
    assert windows_of("A b") == {(b"a", b"b")} and windows_of(None) == set()
