"""Quality rules against plain loops over words, lines and windows."""

import re
from collections import Counter
from math import log

import numpy as np
from pyspark.sql import functions as F

from tiermill.llm import quality
from tiermill.llm.common import mix

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, _trusted string, bucket string, llr string"


def base(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>") if text else 0,
        len(lines) - len(set(lines)), len(repeated), failed,
    )


def buckets(text):
    """Buckets of all one- and two-word strings; the hash of a word is xxh3, as the operator's."""
    words = quality.WordHash().of(quality.words_of(text))
    shift = np.uint64(64 - 16)
    ones = [int(mix(words[i : i + 1])[0] >> shift) for i in range(len(words))]
    twos = [int(mix(words[i : i + 1] * np.uint64(3) + words[i + 1 : i + 2])[0] >> shift) for i in range(len(words) - 1)]
    return ones + twos


def documents():
    rng = np.random.default_rng(1)
    plain = lambda n, k: " ".join(f"w{i}" for i in rng.integers(0, k, n))
    texts = [plain(80, 400) for _ in range(40)] + [" ".join(f"junk{i}" for i in rng.integers(0, 30, 90)) for _ in range(15)]
    texts += [None, "", " \n\t ", "word", plain(49, 999), plain(50, 999), "a b c " * 40, "x\n\ny\nx\n x\n" + plain(60, 999)]
    texts += ["é\u00a0ü #1 |<>&$% " + plain(60, 999), "a b c " * 5 + plain(15, 10**6), plain(120_000, 50_000)]
    texts += ["a b c " * 10 + plain(30, 10**9), "a b c " * 10 + plain(29, 10**9), texts[0], texts[0]]  # half of the words, and more
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[1]), (None, None), (0, texts[2])]


def test_against_loops(spark):
    rows = documents()
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(20)] + [(3,), (None,), (10**6,)], "doc_id long")
    ratio = quality.fit(df, trusted)

    raw, target = Counter(), Counter()
    for i, text in rows:
        found = buckets(text) if text else []
        raw.update(found)
        if i is not None and i < 20:
            target.update(found)
    total = {k: sum(c.values()) + 0.5 * 65536 for k, c in (("raw", raw), ("target", target))}
    want = [log((target[b] + 0.5) / total["target"]) - log((raw[b] + 0.5) / total["raw"]) for b in range(65536)]
    assert np.allclose(ratio, want, atol=1e-12)

    def judged(text):
        at = buckets(text) if text else []
        llr = sum(want[b] for b in at) / max(2 * len(WORDS.findall(text or "")) - 1, 1)
        return llr, not base(text)[-1] and round(llr, 6) >= quality.THRESHOLD

    got = quality.score(df, ratio).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got), key=key) == sorted(
        ((i, *base(t), judged(t)[1]) for i, t in rows), key=key
    )
    for i, text in rows[:55]:
        assert any(abs(r.llr - judged(text)[0]) < 2e-6 for r in got if r.doc_id == i)
    kept = [r.kept for r in got if r.doc_id is not None and r.doc_id < 55]
    assert 0 < sum(kept) < len(kept)  # both verdicts occur


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    trusted = spark.createDataFrame([], "doc_id long")
    ratio = quality.fit(none, trusted)
    assert not ratio.any() and quality.score(none, ratio).collect() == []
    some = spark.createDataFrame([(1, "a b", "", "", "")], SCHEMA)
    assert not quality.fit(some, trusted).any()
    assert quality.score(some, ratio).select("kept", "llr", F.col("base_failed")).collect() == [(False, 0.0, True)]
