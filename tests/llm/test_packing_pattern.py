"""The tokenizer's pattern, with its letters and numbers listed, against the pattern itself."""

import random
import re

import public_tokenizers
import regex

from tiermill.llm import packing

GIVEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def test_listed_pattern_finds_the_same():
    listed = packing.TokenIds(public_tokenizers.path("word_bpe_49k.json")).pattern
    assert isinstance(listed, re.Pattern)  # the faster module's
    plain = "".join(chr(c) for c in range(0x250) if packing.PLAIN.fullmatch(chr(c)))
    pick = random.Random(5)
    texts = [plain, *plain, *("".join(pick.choices(plain + "abc '' sdmtrvl" * 9, k=200)) for _ in range(200))]
    for text in map(str.lower, texts):
        assert listed.findall(text) == regex.findall(GIVEN, text)


def test_patterns_with_other_properties_are_left_alone():
    for pattern in (r"\p{L}+|\p{N}", r"[\p{Lu}]+", r"[\P{L}]"):
        assert isinstance(packing._on_plain(pattern), regex.Pattern)
