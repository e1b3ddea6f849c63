"""Token ids of whole texts by a public tokenizer, with a bounded cache of parts of texts."""

from __future__ import annotations

import os
import sys
import unicodedata
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicehouse.llm.common import quoted, small_batches, text_of

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CACHED_PARTS = 600_000
SIGNS = ".,;:!?#$%&*()\""
_PIECE = 1 << 20


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Ids as little-endian bytes of ``width`` bytes each.

    Spaces and line breaks are never inside a token of this tokenizer and what stands on one side of them never changes the
    tokens of the other side. So a text is cut there and each part encoded by the tokenizer once, as long as the cache holds it.
    """

    def __init__(self, vocabulary: str = VOCABULARY, width: int = 4, cached: int = CACHED_PARTS, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials  # then the text never makes a special token
        self.width, self.cached, self.parts, self.before = width, cached, {}, {}

    def _learn(self, parts: list[str]) -> None:
        """Encode parts of texts. Signs behind a letter are tokens of their own, so a word with and without them is encoded once.

        What counts is the letter that the tokenizer sees: a capital I with a dot, for one, ends in a combining dot when lower-cased.
        """
        known, cut, need = self.parts, [], {}
        for part in parts:
            core = part.rstrip(SIGNS)
            if core == part or not unicodedata.normalize("NFC", core).lower()[-1:].isalpha():
                need[part] = None
                continue
            cut.append((part, core, signs := part[len(core) :]))
            for own in (core, signs):
                if own not in known:
                    need[own] = None
        self._encode(list(need))
        known.update((part, known[core] + known[signs]) for part, core, signs in cut)

    def _encode(self, parts: list[str]) -> None:
        """Encode parts as one text, which is much faster than one by one, and take the ids apart by their places."""
        found = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids = np.array(found.ids, {2: "<u2", 4: "<u4"}[self.width]).tobytes()
        starts = np.fromiter((start for start, _ in found.offsets), np.int64, len(found.ids))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        cuts = (np.searchsorted(starts, ends) * self.width).tolist()
        self.parts.update(zip(parts, [ids[a:b] for a, b in zip([0, *cuts], cuts)]))

    def pieces(self, text: str | None) -> Iterator[bytes]:
        """The ids of a text, in pieces for about a million characters each."""
        text, start = text or "", 0
        while start < len(text):
            stop = start + _PIECE
            if stop < len(text):
                space = text.find(" ", stop)
                stop = len(text) if space < 0 else space
            piece = text[start:stop]
            if "<|" not in piece and _is_latin(piece):
                piece = piece.lower()  # the tokenizer does so too, but here more words are found in the cache
            parts = piece.replace("\n", " ").split(" ")
            start = stop
            if missing := [part for part in set(parts) if part not in self.parts]:
                if len(self.parts) + len(missing) > self.cached // 2:
                    # What is not asked for while another half fills up is forgotten.
                    self.before, self.parts = self.parts, {}
                    missing = list(set(parts))
                self.parts.update((part, self.before[part]) for part in missing if part in self.before)
                if missing := [part for part in missing if part not in self.parts]:
                    self._learn(missing)
            yield b"".join(map(self.parts.__getitem__, parts))


def worker_encoder(*settings) -> Encoder:
    """The Python worker's own encoder of these settings, whose cache lasts from task to task."""
    kept = sys.modules.setdefault("encoders of this worker", ModuleType("encoders of this worker"))
    if getattr(kept, "settings", None) != settings:
        kept.settings, kept.encoder = settings, Encoder(*settings)
    return kept.encoder


def token_rows(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(quoted(id).alias("doc_id"), text_of(text).alias("text"))


def cut_documents(docs: DataFrame, size: int, id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Each document's ids, followed by ``end_id``, in pieces of at most ``size`` ids.

    Columns: doc_id, start and length (in ids), doc_tokens (all ids of the document), ids (little-endian unsigned 32-bit numbers).
    Null text is empty, and an empty text is the end id alone. Repeated rows are repeated. A document is held whole in
    its task as ids; its text comes whole from Spark in any case.
    """
    rows = token_rows(docs, id, text)

    def work(batches: Iterator[pa.RecordBatch]):
        encoder = worker_encoder(vocabulary)
        end, step = end_id.to_bytes(4, "little"), 4 * size
        for batch in small_batches(batches, 256):
            out: list[list] = [[], [], [], [], []]
            held = 0
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = b"".join(encoder.pieces(value.as_py())) + end
                for start in range(0, len(ids), step):
                    piece = ids[start : start + step]
                    for column, item in zip(out, (name, start // 4, len(piece) // 4, len(ids) // 4, piece)):
                        column.append(item)
                    held += len(piece)
                    if held > 16 << 20:
                        yield _pieces(out, batch.schema.field(0).type)
                        out, held = [[], [], [], [], []], 0
            yield _pieces(out, batch.schema.field(0).type)

    kind = rows.dtypes[0][1]
    return rows.mapInArrow(work, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary")


def _pieces(columns: list[list], kind: pa.DataType) -> pa.RecordBatch:
    types = (kind, pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(values, own) for values, own in zip(columns, types)], names)


def expected_pieces(docs: DataFrame, size: int, text: str = "text") -> int:
    """About how many pieces the documents make: a token has two bytes or more in most texts."""
    per_row = F.ceil((F.octet_length(text_of(text)) + 1) / F.lit(2.0 * size))
    return int(docs.agg(F.sum(per_row)).first()[0] or 0)
