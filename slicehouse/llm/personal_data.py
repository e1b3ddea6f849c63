"""Personal data: what has the form of an e-mail address, an IP address, a card or a phone number, and what stands where such things stand.

The forms give the seeds. The words around a seed are its patterns: the two before it, the two behind it, and one on either side. Candidates
are strings that look like identifiers and are no seed, with their patterns. Values and patterns make a graph, in which Spark takes turns: a
pattern is trusted with a kind by the share of its different values that are known to be of this kind, and a value is taken for a
kind if the patterns trusted with it, which err independently of each other, leave too little doubt. Values taken are known in the next round.

Only different (pattern, value) pairs count, so copies of a document prove nothing. They are counted on the map side first, so frequent patterns are
no hot keys, and only trusted patterns meet the candidates again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import persisted, quoted, read_table, small_batches, text_of

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
#: A pattern is trusted with a kind if it has so many different known values of it, and such a share of all its values.
LEAST_VALUES = 5
TRUST = 0.8
#: The weight of values of which nothing is known, beside values known to be of another kind.
UNKNOWN = 0.5
#: A value is taken if the chance that all its trusted patterns err is less than the rest.
TAKEN = 0.9
#: Patterns look so many code points far.
WINDOW = 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]")
_LOOSE_NUMBER = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9][0-9()./ -]*[0-9](?![0-9A-Za-z])")
_LOOSE_WORD = re.compile(r"""[^\s,;<>"'()\[\]{}]+""")
_HEX_GROUPS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        else:
            end = at + 1  # no address reaches over this sign
        at = text.find("@", max(end, at + 1))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of each chain of numbers."""
    for chain in _DOTTED.finditer(text):
        start, parts = chain.start(), chain.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in four):
                yield start, start + length
            start += length + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _NUMBER.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and passes_luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(found.group())) <= 15:
            yield found.span()


_FINDERS = (_emails, _addresses, _cards, _phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the strings that have the form of a kind, in order; linear in the text."""
    if not re.search("[0-9@]", text):
        return []
    return sorted((start, kind, end) for kind, find in enumerate(_FINDERS) for start, end in find(text))


def candidates(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, kinds it could be of) of strings that look like identifiers and meet no base span."""
    taken, place = sorted((start, end) for start, _, end in spans), 0
    found = []
    for match in _LOOSE_NUMBER.finditer(text):
        digits = len(_DIGITS.findall(match.group()))
        kinds = [kind for kind, fits in ((1, match.group().count(".") > 2), (2, 12 <= digits <= 19), (3, 7 <= digits <= 15)) if fits]
        if kinds:
            found.append((*match.span(), kinds))
    if "@" in text:
        found += [(*match.span(), [0]) for match in _LOOSE_WORD.finditer(text) if "@" in match.group()[1:-1]]
    if text.count(":") > 1:
        found += [(*match.span(), [1]) for match in _HEX_GROUPS.finditer(text) if len(match.group()) > 4 and _DIGITS.search(match.group())]
    for start, end, kinds in sorted(found):
        while place < len(taken) and taken[place][1] <= start:
            place += 1
        if place == len(taken) or taken[place][0] >= end:
            yield start, end, kinds


def patterns(text: str, start: int, end: int) -> list[str]:
    """The words and signs around a string, in lower case."""
    before = _TOKEN.findall(text[max(0, start - WINDOW) : start].lower())[-2:]
    behind = _TOKEN.findall(text[end : end + WINDOW].lower())[:2]
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} *")
    if len(behind) == 2:
        out.append(f"* {behind[0]} {behind[1]}")
    if before and behind:
        out.append(f"{before[-1]} * {behind[0]}")
    return out


def value_name(text: str) -> bytes:
    """A value under whatever spacing and case it is written, as 128 bits."""
    return hashlib.md5(re.sub(r"[\s()-]", "", text).lower().encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()


_MENTION = "struct<start:bigint,end:bigint,value:binary,kind:int,kinds:array<int>,patterns:array<string>>"


def mentions(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_key, doc_id, mentions) of each row: seeds with their kind, candidates with the kinds they could be of, and the patterns of both."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_key"), quoted(id).alias("doc_id"), text_of(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, 256):
            out = []
            for value in batch.column(2):
                whole = value.as_py()
                spans = base_spans(whole)
                found = [(start, end, kind, [kind]) for start, kind, end in spans]
                found += [(start, end, None, kinds) for start, end, kinds in candidates(whole, spans)]
                out.append([
                    {"start": start, "end": end, "value": value_name(whole[start:end]), "kind": kind, "kinds": kinds, "patterns": patterns(whole, start, end)}
                    for start, end, kind, kinds in found
                ])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind_of)], ["row_key", "doc_id", "mentions"])

    kind_of = pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary()), ("kind", pa.int32()), ("kinds", pa.list_(pa.int32())), ("patterns", pa.list_(pa.string())),
    ]))
    own = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"row_key bigint, doc_id {own}, mentions array<{_MENTION}>")


def trusted(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, kind, share) by different edges (pattern, value) and known (value, kind)."""
    told = edges.join(known, "value", "left").groupBy("pattern", "kind").agg(F.count("*").alias("values"))
    each = [F.sum(F.when(F.col("kind") == kind, F.col("values")).otherwise(0)).alias(f"k{kind}") for kind in range(len(KINDS))]
    counts = told.groupBy("pattern").agg(F.sum("values").alias("all"), *each)
    known_values = sum(F.col(f"k{kind}") for kind in range(len(KINDS)))
    shares = F.explode(F.array(*(
        F.struct(
            F.lit(kind).alias("kind"), F.col(f"k{kind}").alias("values"),
            (F.col(f"k{kind}") / (known_values + UNKNOWN * (F.col("all") - known_values) + 1)).alias("share"),
        )
        for kind in range(len(KINDS))
    )))
    return counts.select("pattern", shares.alias("of")).select("pattern", "of.*").filter((F.col("values") >= LEAST_VALUES) & (F.col("share") >= TRUST)).drop("values")


def taken(edges: DataFrame, known: DataFrame, patterns: DataFrame) -> DataFrame:
    """(value, kind) of values not known yet that their trusted patterns leave too little doubt about; of equal doubts the first kind."""
    open_edges = edges.join(patterns, "pattern").filter(F.array_contains("kinds", F.col("kind"))).join(known.select("value"), "value", "left_anti")
    doubts = open_edges.groupBy("value", "kind").agg(F.sum(F.log(1 - F.col("share"))).alias("doubt"))
    best = doubts.groupBy("value").agg(F.min(F.struct("doubt", "kind")).alias("best")).filter(F.exp("best.doubt") <= 1 - TAKEN)
    return best.select("value", F.col("best.kind").alias("kind"))


def discovered(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind) of the candidates that patterns find, by the rows of ``mentions``."""
    each = found.select(F.explode("mentions").alias("m")).select("m.value", "m.kind", "m.kinds", "m.patterns")
    known = persisted(each.filter("kind is not null").groupBy("value").agg(F.min("kind").alias("kind")))
    seeds, edges = known, each.select("value", "kinds", F.explode("patterns").alias("pattern"))
    # A value that is a seed somewhere and a candidate elsewhere has two lists of kinds, but is one value of a pattern.
    edges = persisted(edges.groupBy("pattern", "value").agg(F.min("kinds").alias("kinds")))
    for _ in range(rounds):
        new = persisted(taken(edges, known, persisted(trusted(edges, known))))
        if new.isEmpty():
            break
        known = persisted(known.union(new))
    return known.join(seeds.select("value"), "value", "left_anti")


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base, added): for each row the base spans and those the patterns add, as arrays of (start, place of the kind, end) in order.

    Null text is empty. Rows are kept apart whatever their ids, null ones too; repeated rows have the same spans each. Texts of any length are searched
    whole, in linear time. A base span is never changed, and an added one never meets it. An empty table gives no rows; other columns are not looked at.
    """
    found = persisted(mentions(docs, id, text))
    values = persisted(discovered(found, rounds))
    loose = found.select("row_key", F.explode("mentions").alias("m")).filter("m.kind is null").select("row_key", "m.value", "m.start", "m.end")
    added = loose.join(values, "value").groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("added"))
    base = F.transform(F.filter("mentions", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return found.join(added, "row_key", "left").select("doc_id", base.alias("base"), F.coalesce("added", empty).alias("added"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest are of the base spans; ``spans`` has those that patterns add, too."""
    found = personal_data(read_table(spark, folder, "documents"))
    counts = [_count("base", kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(every).alias("spans"))


QUERIES = {"op12_personal_data": op12_personal_data}
ORACLES: dict[str, str] = {}
