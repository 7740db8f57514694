"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_CACHE = 400_000  # distinct words a worker remembers; beyond it the memory is cleared and filled again
SLICE_CHARS = 4_000_000  # characters handled at once inside a task; a longer text is handled alone
BLOCK_BYTES = 1 << 17  # bytes whose words are hashed at once, so the work stays in the processor's cache


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHash(dict):
    """64-bit hash of a word (bytes), computed once per distinct word a worker meets."""

    def __init__(self, normal=bytes):
        super().__init__()
        self.normal = normal

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(self.normal(word))
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (the murmur3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15 | 1
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
LOWER = np.concatenate([BYTES[:65], BYTES[97:123], BYTES[91:]])  # A to Z as a to z
GAP = np.isin(np.arange(256), [*range(9, 14), 32])


class Powers:
    """BASE**i and BASE**-i modulo 2**64, for as many i as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                values = np.full(max(n, 1 << 16), base, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))
        return self.up[:n], self.down[:n]


def hashed_words(texts: pa.Array, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (see ``words_of``) with A-Z lower-cased, and where each text's begin, and the
    last one's end, among them.  No word becomes a Python object; one longer than BLOCK_BYTES is hashed alone."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, places, held = texts.buffers()
    if not len(texts) or held is None:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    borders = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data, borders = np.frombuffer(held, np.uint8)[borders[0] : borders[-1]], borders - borders[0]
    edge = np.ones(len(data) + 1, bool)  # whether a word can begin here, and one before it end
    edge[1:-1] = GAP[data[:-1]] | GAP[data[1:]]
    edge[borders] = True
    inside = ~GAP[data]
    begins, ends = np.flatnonzero(inside & edge[:-1]), np.flatnonzero(inside & edge[1:]) + 1
    out = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        lo = begins[at]
        to = int(np.searchsorted(ends, lo + BLOCK_BYTES, "right"))
        if to <= at:
            out[at] = xxhash.xxh3_64_intdigest(data[lo : ends[at]].tobytes().lower())
            at += 1
            continue
        size = ends[to - 1] - lo
        up, down = powers(BLOCK_BYTES)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(LOWER[data[lo : lo + size]] * up[:size], out=total[1:])
        first = begins[at:to] - lo
        out[at:to] = (total[ends[at:to] - lo] - total[first]) * down[first]
        at = to
    return out, np.searchsorted(begins, borders)


def words_of(text: str | None) -> list[bytes]:
    """The maximal runs of characters other than space and \\t to \\r, as UTF-8 (``bytes.split`` splits at these six)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct k-word shingles of a sequence of word hashes; a shorter sequence is one shingle."""
    if not len(words):
        return words
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(words.tobytes())], np.uint64)
    return np.unique(rolled(words, k))


def rolled(words: np.ndarray, k: int) -> np.ndarray:
    """The shingles of every ``k`` consecutive words, repeats included."""
    n = max(len(words) - k + 1, 0)
    value = words[:n]
    for i in range(1, k):
        value = mix(value) + words[i : n + i]
    return mix(value)


def shingle_sets(texts: pa.Array, k: int, powers: Powers) -> list[np.ndarray]:
    """``shingles`` of the words of each text."""
    words, borders = hashed_words(texts, powers)
    every, out = rolled(words, k), []
    for first, end in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if end - first < k:
            out.append(shingles(words[first:end], k))
            continue
        found = np.sort(every[first : end - k + 1])
        fresh = np.ones(len(found), bool)
        np.not_equal(found[1:], found[:-1], out=fresh[1:])
        out.append(found[fresh])
    return out


def cuts(batches: Iterable[pa.RecordBatch], text: int = 1, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that no cut holds many more than ``chars`` characters of the column ``text``."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            begun = sizes[start - 1] if start else 0
            end = min(int(np.searchsorted(sizes, begun + chars)) + 1, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def slices(batches: Iterable[pa.RecordBatch], text: int = 1, chars: int = SLICE_CHARS) -> Iterator[list[list]]:
    """The columns of ``cuts`` as Python lists."""
    for cut in cuts(batches, text, chars):
        yield [c.to_pylist() for c in cut.columns]


def own_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has, so helper columns replace nobody's."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, the same ones on every run: those whose hashed key is smallest."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)
