"""Packing: pieces against the tokenizer, sequences against their definition."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tiermill.llm import packing
from tiermill.llm.packing import pack, tokenized

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    got = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    return got + [(None, "null id"), (1, None), (1, ""), (9001, "word " * 9000), (9001, "word " * 9000), (9002, "<|endoftext|> A b c\x1cd")]


def test_pieces_are_the_tokenizers_ids(spark, docs):
    want, encoder = [], Tokenizer.from_file(FILE)
    for doc, text in docs:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(doc, i // 4096, i, len(ids[i : i + 4096]), zlib.crc32(np.array(ids[i : i + 4096], "<u4").tobytes())) for i in range(0, len(ids), 4096)]
    got = tokenized(spark.createDataFrame(docs, "doc_id long, text string"), FILE).collect()
    assert len(want) > len(docs)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("group_items", [50_000, 20])
def test_sequences_are_gapless_and_few(spark, docs, group_items):
    pieces = tokenized(spark.createDataFrame(docs, "doc_id long, text string"), FILE)
    packed = pack(pieces, group_items=group_items).collect()
    assert len(packed) == pieces.count()
    held = {}
    for r in packed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(r.length for r in packed) // 4096)
    assert len(held) <= least * 1.05 + 2


ODD = [
    "don't I'LL _x_ naïve ﬁ 🙂👍🏽 <s> x<|endoftext|>y", "İstanbul ſt ǅ ½ Ⅷ ٣ 日本語 ß ẞ Σς ΑΣ", "a\u0301 e\u0301x \u0301x q\u0307\u0323",
    "\x7f\x00 a\x1cb\x85c\xa0d\u2003e\u200bf", "Ünï “quoted” words " * 60, "A" * 500 + "1" * 50 + "-" * 40,
]


@pytest.mark.parametrize("plain", [True, False])
def test_ids_of_odd_texts(monkeypatch, plain):
    """Both ways give the ids of whole texts, with a cache that is emptied at its bound."""
    monkeypatch.setattr(packing, "WORD_CACHE", 50)
    ids, encoder = packing.TokenIds(FILE), Tokenizer.from_file(FILE)
    assert ids.pattern is not None
    ids.pattern = ids.pattern if plain else None
    every = [f"a{chr(i)}B {chr(i)}" for i in range(1, 0x800)] + [f"{chr(i)}\u0301\u0308" for i in range(33, 0x250)]
    for text in [*ODD, *every, "".join(ODD), " ".join(f"Wört{i}.x" for i in range(300))]:
        assert ids.of(text) == np.array(encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
        assert max(len(ids), len(ids.others)) <= 50


def test_empty_table(spark):
    assert pack(tokenized(spark.createDataFrame([], "doc_id long, text string"), FILE)).collect() == []
