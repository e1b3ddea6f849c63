"""The encoder against the tokenizer itself, on random texts of mixed scripts and signs."""

import random
import sys
import unicodedata

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from slicehouse.llm.tokens import SIGNS, VOCABULARY, Encoder

LETTERS = [
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àéîöüßñçÀÉÎÖÜ", "İıŞşĞğ", "ΑΒΓΔΣσς", "абвгдЖЩЯ", "אבגד", "ابتث", "漢字かなカナ",
    "ก็ข่ค้", "अआकखि्", "0123456789٣४", "̸̣́̇̈", "ǅǈǋﬁﬂ", "𝒜𝓑😀👍🏽",
]
OTHER = ["'", "'s", "'T", "'ll", "-", "_", "<|", "|>", "<|endoftext|>", "/", "@", "—", "…", "​", "­", "=", "<"]
SPACES = [" ", " ", " ", "\n", "\t", " ", "  "]


def test_random_texts_like_the_tokenizer():
    rng = random.Random(11)
    whole = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    encoder = Encoder()
    texts = []
    for _ in range(50_000):
        own = rng.sample(LETTERS, 2)
        parts = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            if kind < 0.55:
                parts.append("".join(rng.choice(rng.choice(own)) for _ in range(rng.randrange(1, 5))))
            elif kind < 0.75:
                parts.append("".join(rng.choice(SIGNS) for _ in range(rng.randrange(1, 4))))
            elif kind < 0.85:
                parts.append(rng.choice(OTHER))
            else:
                parts.append(rng.choice(SPACES))
        texts.append("".join(parts))
    texts += ["KALİ, VELİ.", "İ.", "i̇.", "Å!", "Σ.", "ΟΔΟΣ. ΟΔΟΣ", "ŉ.", "ǰ.", "ẖ!", "don't. DON'T.", ""]
    expected = whole.encode_batch(texts, add_special_tokens=False)
    for text, found in zip(texts, expected):
        got = np.frombuffer(b"".join(encoder.pieces(text)), "<u4").tolist()
        assert got == found.ids, text


def test_every_last_letter_before_a_sign():
    """Each code point that can end a word, with a sign behind it."""
    whole = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    encoder = Encoder()
    texts = [f"b{chr(c)}." for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LM" and not 0x3400 <= c < 0xD7B0 and c < 0x20000]
    for text, found in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(b"".join(encoder.pieces(text)), "<u4").tolist() == found.ids, (text, hex(ord(text[1])))
