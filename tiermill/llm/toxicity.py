"""Toxicity: maximum-scoring segments of token log-odds, aggregated by extreme-value calibration.

1. *Token log-odds.*  Each word stands for itself and for its first five and four letters (inflected forms share them).
   The numbers of toxic, clean and all documents with a feature give its log-odds under an informative Dirichlet prior:
   the corpus shares, weighing PRIOR documents.  A token scores its log-odds where a likelihood-ratio test finds it
   commoner in toxic documents, else a constant negative drift, so clean text has a negative expected score.
2. *Segments.*  One linear scan finds all disjoint maximal scoring segments of a document (Ruzzo and Tompa).
3. *Extreme values.*  Under clean text the best segment of n tokens exceeds S with probability 1 - exp(-n exp(-lambda S)),
   where lambda solves E[exp(lambda s)] = 1 over clean training tokens (Karlin and Altschul).  Segments below the
   significance level are dropped.
4. *Calibration.*  Two surprisals, of the best segment and of all significant ones together, feed a logistic fit.

Counts live in two hashed tables; a feature takes the smaller of its two scores, so an accidental collision must happen
twice.  The tables bound what tasks send and what the driver holds, whatever the corpus holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, slices, words_of

BUCKETS = 1 << 16  # of each of the two tables
TRAIN_ROWS = 40_000  # bound of the labelled rows the classifier is fitted on
PRIOR = 5.0  # documents the corpus-wide prior weighs
EVIDENCE = 4.0  # signed root of the likelihood ratio a token with a positive score must reach
DRIFT = -0.05  # score of every other token
TOP = 10.0  # largest score of a token
SIGNIFICANT = 0.5  # expected number of such segments in a clean document
EDGE = b".,;:!?|*%$&#<>\"'()[]{}"  # trimmed from words
LETTERS = (5, 4)
WORDS = 1 << 17  # distinct words a worker remembers; beyond it the memory is cleared and filled again


@dataclass(frozen=True)
class Model:
    scores: np.ndarray  # 2 x BUCKETS
    rate: float  # lambda
    weights: tuple[float, float, float]  # of the constant and of the two surprisals


def features(word: bytes) -> list[int]:
    """Hashes of the word without edge marks, lower-cased, and of its first letters."""
    text = word.decode("utf-8", "replace").lower().strip(EDGE.decode())
    found = [xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))]
    found += [xxhash.xxh3_64_intdigest(text[:k].encode("utf-8", "replace"), k) for k in LETTERS if len(text) > k]
    return found


class Cache(dict):
    """What ``make`` gives for a word, computed once per distinct word a worker meets."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= WORDS:
            self.clear()
        value = self[word] = self.make(word)
        return value


class Buckets(dict):
    """Where the features of a word are counted, computed once per distinct word a worker meets.

    A word stands for a row of ``found``, whose places after its last feature repeat the first one: remembering a word
    takes its bytes and a few small numbers, no Python object for each bucket.
    """

    def __init__(self):
        super().__init__()
        self.found = np.empty((1 << 10, 2 * (1 + len(LETTERS))), np.int32)

    def __missing__(self, word: bytes) -> int:
        if len(self) == len(self.found):
            self.found = np.concatenate([self.found, np.empty_like(self.found)])
        row, places = len(self), [b for h in features(word) for b in (h % BUCKETS, BUCKETS + (h >> 32) % BUCKETS)]
        self.found[row] = places[0]
        self.found[row, : len(places)] = places
        self[word] = row
        return row

    def of(self, text: str | None) -> np.ndarray:
        """The distinct buckets of a text's features."""
        words, out = list(set(words_of(text))), []
        for at in range(0, len(words), WORDS):
            some = words[at : at + WORDS]
            if len(self) + len(some) > WORDS:
                self.clear()
            rows = np.fromiter(map(self.__getitem__, some), np.int64, len(some))
            out.append(np.unique(self.found[rows]))
        return np.unique(np.concatenate(out)) if len(out) > 1 else out[0] if out else np.empty(0, np.int32)


def counted(batches):
    """For each bucket with a document among ``batches`` (text, toxic): every, toxic and clean documents with it."""
    where = Buckets()
    counts = np.zeros((3, 2 * BUCKETS + 1), np.int64)  # the last column counts documents
    for texts, toxic in slices(batches, 0):
        for text, label in zip(texts, toxic, strict=True):
            own = where.of(text)
            for row in (0,) if label is None else (0, 1 if label else 2):
                counts[row, own] += 1
                counts[row, -1] += 1
    used = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_pydict({"bucket": used, "every": counts[0, used], "toxic": counts[1, used], "clean": counts[2, used]})


def segments(places: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence, in linear time.

    ``places`` are the positions with a positive score, ``scores`` those scores; every other position scores ``drift``.
    The list holds candidate segments with the cumulative scores left of their start and at their end; each keeps the
    index of the nearest earlier candidate that starts lower, which the search follows instead of the whole list.
    """
    found: list[list] = []  # first, last, cumulative before, cumulative at end, earlier candidate with a lower start
    total, at = 0.0, 0
    for place, score in zip(places, scores, strict=True):
        total += drift * (place - at)
        piece = [place, place, total, total + score, None]
        total, at = total + score, place + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= piece[2]:
                j = found[j][4]
            piece[4] = j
            if j < 0 or found[j][3] >= piece[3]:
                found.append(piece)
                break
            piece = [found[j][0], piece[1], found[j][2], piece[3], None]
            del found[j:]
    return [(first, last, end - before) for first, last, before, end, _ in found]


def _places(texts, cache):
    """For each text: its number of words, the places of its positive words and their scores."""
    for text in texts:
        words = words_of(text)
        scores = np.fromiter(map(cache.__getitem__, words), np.float64, len(words))
        places = np.flatnonzero(scores > 0)
        yield len(words), places.tolist(), scores[places].tolist()


def _scorer(scores: np.ndarray) -> Cache:
    first, second = (x.tolist() for x in scores)

    def best(word: bytes) -> float:
        return max(min(first[h % BUCKETS], second[(h >> 32) % BUCKETS]) for h in features(word))

    return Cache(best)


def surprisals(n: int, found: list[float], rate: float) -> tuple[float, float]:
    """-ln of the probability, in n clean tokens, of the best segment and of all the given ones taken together."""
    if not found:
        return 0.0, 0.0
    each = [max(0.0, rate * s - math.log(max(n, 1))) for s in found]
    return max(each), sum(each)


def token_scores(documents: DataFrame, labelled: DataFrame) -> np.ndarray:
    """Scores of the features, by hashed table.  ``labelled``: a bounded set of (doc_id, toxic) rows."""
    marked = documents.select("doc_id", "text").join(F.broadcast(labelled), "doc_id", "left")

    rows = (
        marked.select("text", "toxic")
        .mapInArrow(counted, "bucket long, every long, toxic long, clean long")
        .groupBy("bucket")
        .agg(*(F.sum(c).alias(c) for c in ("every", "toxic", "clean")))
        .collect()  # at most 2 * BUCKETS + 1 rows
    )
    counts = np.zeros((3, 2 * BUCKETS + 1))
    for r in rows:
        counts[:, r.bucket] = r.every, r.toxic, r.clean
    documents_, counts = counts[:, -1], counts[:, :-1]
    if not documents_[1] or not documents_[2]:
        return np.full((2, BUCKETS), DRIFT)
    every, toxic, clean = counts
    prior = PRIOR * every / documents_[0] + 1e-6
    odds = lambda x, n: np.log((x + prior) / (n - x + PRIOR))
    gain = odds(toxic, documents_[1]) - odds(clean, documents_[2])
    share = documents_[1] / (documents_[1] + documents_[2])
    term = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)), 0)
    ratio = term(toxic, share * (toxic + clean)) + term(clean, (1 - share) * (toxic + clean))
    strong = (gain > 0) & (np.sqrt(2 * np.maximum(ratio, 0)) >= EVIDENCE)
    return np.where(strong, np.minimum(gain, TOP), DRIFT).reshape(2, BUCKETS)


def _rate(n: float, positive: dict[float, float]) -> float:
    """lambda of the score distribution of clean tokens: ``positive`` counts among ``n`` tokens, one added at the top."""
    positive = {**positive, TOP: positive.get(TOP, 0) + 1}
    rest = max(n, 1.0) + 1 - sum(positive.values())
    excess = lambda x: (rest * math.exp(DRIFT * x) + sum(c * math.exp(s * x) for s, c in positive.items())) / (n + 1) - 1
    low, high = 1e-3, 1e-3
    while excess(high) < 0 and high < 20:
        low, high = high, high * 1.5
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; x holds a constant column."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.array([1e-3] + [ridge] * (x.shape[1] - 1))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on ``labels`` (doc_id, toxic): at most ``rows`` of them, chosen by hash.

    Corpus counts cover every document.  Null labels and null ids are skipped; an id labelled twice counts as toxic if
    either label is.  Without labels of both kinds no token is positive and every document scores the same.
    """
    usable = labels.where("doc_id is not null and toxic is not null")
    chosen = bounded_sample(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", rows)
    texts = documents.select("doc_id", F.xxhash64("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    chosen = texts.groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic")  # copies once
    chosen = documents.sparkSession.createDataFrame(chosen.toPandas(), "doc_id long, toxic int")  # rows are bounded
    scores = token_scores(documents, chosen)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(scores)

    def look(batches):
        cache = _scorer(shared.value)
        for texts, toxic in slices(batches, 0):
            out = []
            for (n, places, values), label in zip(_places(texts, cache), toxic, strict=True):
                out.append((label, n, [s for _, _, s in segments(places, values)], [round(v, 1) for v in values]))
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["toxic", "n", "found", "positive"]
            )

    train = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    seen = train.mapInArrow(look, "toxic int, n long, found array<double>, positive array<double>").toPandas()  # bounded
    if seen.toxic.nunique() < 2:
        return Model(scores, 1.0, (-2.0, 0.0, 0.0))
    clean = seen[seen.toxic == 0]
    values, times = np.unique(np.concatenate([np.asarray(x) for x in clean.positive] or [np.empty(0)]), return_counts=True)
    rate = _rate(float(clean.n.sum()), dict(zip(values.tolist(), times.tolist(), strict=True)))
    x = np.array([(1.0, *surprisals(n, _significant(n, list(f), rate), rate)) for n, f in zip(seen.n, seen.found, strict=True)])
    return Model(scores, rate, tuple(_logistic(squashed(x), seen.toxic.to_numpy(float)).tolist()))


def squashed(x: np.ndarray) -> np.ndarray:
    """Surprisals on a logarithmic scale, so long documents with many passages do not dominate the fit."""
    return np.concatenate([x[:, :1], np.log1p(x[:, 1:])], axis=1)


def _significant(n: int, found: list[float], rate: float) -> list[float]:
    return [s for s in found if max(n, 1) * math.exp(-rate * s) <= SIGNIFICANT]


def _judge(model: tuple[np.ndarray, float, tuple[float, float, float]]):
    """A function from texts to their scores, evidence and significant passages."""
    scores, rate, weights = model
    cache = _scorer(scores)

    def judged(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
        passages, x = [], []
        for n, places, values in _places(texts, cache):
            found = [(a, b, s) for a, b, s in segments(places, values) if max(n, 1) * math.exp(-rate * s) <= SIGNIFICANT]
            passages.append([{"first": a, "last": b, "score": round(s, 4)} for a, b, s in found])
            x.append((1.0, *surprisals(n, [s for _, _, s in found], rate)))
        x = np.array(x).reshape(-1, 3)
        p = 1 / (1 + np.exp(-np.clip(squashed(x) @ np.array(weights), -30, 30)))
        return np.round(p, 9), np.round(x[:, 1], 6), passages

    return judged


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, ``score`` in 0..1, ``evidence`` (surprisal of the best passage) and ``passages``.

    ``passages`` lists every significant toxic passage as (first word, last word, score).  Null and empty texts have no
    passage and get the score of a document without any.  Rows are scored one by one from their text alone, so repeated
    rows and null ids give one row each; other columns are ignored.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((model.scores, model.rate, model.weights))  # a bounded model
    passage = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))

    def judge(batches):
        judged = _judge(shared.value)
        for ids, texts in slices(batches):
            p, evidence, passages = judged(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(p), pa.array(evidence), pa.array(passages, passage)],
                ["doc_id", "score", "evidence", "passages"],
            )

    schema = "doc_id long, score double, evidence double, passages array<struct<first: long, last: long, score: double>>"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(judge, schema)


def below(documents: DataFrame, model: Model, limit: float) -> DataFrame:
    """The rows of ``documents`` that score below ``limit``, with all their columns.

    Each row carries its own verdict, so null ids and ids that several rows share decide nothing.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.scores, model.rate, model.weights))  # a bounded model

    def keep(batches):
        judged = _judge(shared.value)
        for batch in batches:
            at = 0
            for (texts,) in slices([batch.select(["text"])], 0):
                yield batch.slice(at, len(texts)).filter(pa.array(judged(texts)[0] < limit))
                at += len(texts)

    return documents.mapInArrow(keep, documents.schema)
