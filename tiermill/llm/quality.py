"""Quality rules: hashed n-gram log-likelihood ratio between a trusted-target and the raw-corpus multinomial."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, bounded_sample, mix, slices, words_of

BUCKETS = 1 << 16  # hashed unigrams and bigrams; bounds the model whatever the corpus holds
TRUSTED_ROWS = 50_000  # bound of the labelled rows the target multinomial is fitted on
SMOOTHING = 0.5  # pseudo-count of every bucket
THRESHOLD = -0.1  # nats per n-gram: a document this much likelier under the raw corpus is not kept
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def hashed(words: WordHash, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, in order, and the number of words of each text."""
    lists = [words_of(t) for t in texts]
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return words.of(list(chain.from_iterable(lists))), n


def grams(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the unigram and of the bigram starting at each word, and whether such a bigram exists."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    inner = np.ones(len(h), bool)
    inner[np.cumsum(n)[n > 0] - 1] = False  # no bigram starts at the last word of a text
    two = mix(h * np.uint64(3) + np.roll(h, -1)) >> shift
    return (mix(h) >> shift).astype(np.int64), two.astype(np.int64), inner


def fit(documents: DataFrame, trusted: DataFrame, rows: int = TRUSTED_ROWS) -> np.ndarray:
    """Log-likelihood ratio (target over raw) of each bucket.

    Raw counts cover every document.  ``trusted`` names trusted documents (``doc_id``); at most ``rows`` of them, chosen
    by hash, are the target.  Each task sends one row per bucket, so the shuffle and the model are bounded by BUCKETS.
    Without documents or without trusted ones every ratio is 0.
    """
    chosen = bounded_sample(trusted.select("doc_id").where("doc_id is not null").distinct(), "doc_id", rows)
    marked = documents.select("doc_id", "text").join(
        F.broadcast(chosen.withColumn("_trusted", F.lit(True))), "doc_id", "left"
    )

    def count(batches):
        words, counts = WordHash(), np.zeros((2, BUCKETS), np.int64)
        for text, target in slices(batches, 0):
            h, n = hashed(words, text)
            one, two, inner = grams(h, n)
            chosen = np.repeat(np.array([bool(x) for x in target]), n)
            for row, mask in enumerate((np.True_, chosen)):
                counts[row] += np.bincount(one[mask & np.ones(len(h), bool)], minlength=BUCKETS)
                counts[row] += np.bincount(two[mask & inner], minlength=BUCKETS)
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_pydict({"bucket": used, "raw": counts[0, used], "target": counts[1, used]})

    rows_ = (
        marked.select("text", "_trusted")
        .mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()  # at most BUCKETS rows
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows_:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.any():
        return np.zeros(BUCKETS)
    share = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS))
    return share(target) - share(raw)


def repeated_words(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per text, the words lying in three-word windows that occur in it twice or more."""
    doc = np.repeat(np.arange(len(n)), n)
    covered = np.zeros(len(h), bool)
    if len(h) > 3:
        whole = np.flatnonzero(doc[:-2] == doc[2:])  # windows within one text
        x = h * np.uint64(0x9E3779B97F4A7C15)
        three = mix(mix(x[:-2] * np.uint64(3) + h[1:-1]) * np.uint64(3) + h[2:])[whole]
        key = three + mix(doc[whole].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = whole[np.unique(np.concatenate([order[1:][same], order[:-1][same]]))]
        for k in range(3):
            covered[twice + k] = True
    return np.bincount(doc[covered], minlength=len(n))


def text_stats(text: str | None) -> tuple[int, int, int]:
    """(word_chars, n_symbols, n_dup_lines) of a whole text; a null text has none."""
    if not text:
        return 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
    )


def score(documents: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: text statistics, the base rules, ``llr`` (mean ratio per n-gram) and ``kept``.

    A document is kept when it passes the base rules (50 words or more, at most half of them in repeated three-word
    windows) and its mean ratio reaches ``threshold``.  Null and empty texts have no words, llr 0, and fail the base
    rules.  Rows are judged one by one, so repeated rows and null ids give one row each; other columns are ignored.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(ratio)  # BUCKETS numbers

    def judge(batches):
        words, values = WordHash(), shared.value
        for ids, texts in slices(batches):
            h, n = hashed(words, texts)
            one, two, inner = grams(h, n)
            of = np.repeat(np.arange(len(n)), n)
            total = np.bincount(of, weights=values[one] + values[two] * inner, minlength=len(n))
            llr = np.round(total / np.maximum(2 * n - 1, 1), 6)
            chars, symbols, dup = np.array([text_stats(t) for t in texts], np.int64).reshape(-1, 3).T
            repeat = repeated_words(h, n)
            failed = (n < 50) | (100 * repeat > 50 * n)
            columns = [pa.array(ids, pa.int64()), n, chars, symbols, dup, repeat, failed, ~failed & (llr >= threshold), llr]
            names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*names, "base_failed", "kept", "llr"])

    schema = f"doc_id long, {STATS}, base_failed boolean, kept boolean, llr double"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(judge, schema)
