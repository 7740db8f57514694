"""Documents counted by the features of their words: what a task holds, and the counts against plain sets."""

import tracemalloc
from collections import Counter

import pyarrow as pa

from tiermill.llm import toxicity

SCHEMA = pa.schema([("text", pa.string()), ("toxic", pa.int32())])


def batches(rows):
    return [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)]


def plain(rows):
    counts = [Counter(), Counter(), Counter()]
    n = toxicity.BUCKETS
    for text, toxic in rows:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        own = {b for w in words for h in toxicity.features(w) for b in (h % n, n + (h >> 32) % n)} | {2 * n}
        for row in (0,) if toxic is None else (0, 1 if toxic else 2):
            counts[row].update(own)
    return [(b, *(c[b] for c in counts)) for b in sorted(counts[0])]


def counted(rows):
    return [tuple(r.values()) for r in pa.Table.from_batches(list(toxicity.counted(batches(rows)))).to_pylist()]


ROWS = [(None, None), ("", 1), (" \n", 0), ("a a A, a", 1), ("shorter, longest longer!", 0), ("É ÉÉÉÉÉÉ x", None)]


def test_counts():
    assert counted(ROWS + ROWS[3:5]) == plain(ROWS + ROWS[3:5])


def test_counts_when_the_memory_is_cleared(monkeypatch):
    """Between texts, and within one that has more words than are remembered."""
    rows = [(" ".join(f"w{i * 7 + j} word{j}" for j in range(9)), i % 3 or None) for i in range(40)]
    rows.append((" ".join(f"v{i}" for i in range(100)), 1))
    want = plain(rows)
    monkeypatch.setattr(toxicity, "WORDS", 16)
    assert counted(rows) == want


def test_many_words_take_little_memory():
    """300,000 different words in 30 texts; before, remembering their buckets alone took over 100 MB of a worker."""
    held = batches([(" ".join(f"number{i * 10_000 + j}" for j in range(10_000)), i % 2) for i in range(30)])
    next(iter(toxicity.counted(batches(ROWS))))  # what is loaded once does not count
    tracemalloc.start()
    next(iter(toxicity.counted(held)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
