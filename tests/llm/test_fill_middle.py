"""Fill-in-the-middle against slices of plain lists, and rebuilt exactly."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiermill.llm.fill_middle import SkipList, fill_middle, restored

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc, text, seed=42):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc, n, "plain", None, None, text, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def run(df):
    out = fill_middle(df).withColumn("restored", restored(F.col("output"), F.col("form")))
    return sorted(map(tuple, out.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=700), st.data())
def test_skip_list_finds_every_rank(widths, data):
    units = SkipList(np.array(widths, np.int64))
    rank = data.draw(st.integers(0, len(widths)))
    assert len(units) == len(widths) if widths else True
    assert units.points_before(rank) == sum(widths[:rank])


def test_supplied_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    want = sorted((brute(*d) for d in docs), key=repr)
    assert run(df) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_edges(spark):
    """Nulls, empty, blank, marker-like, very long and astral texts; repeated rows; ids of many forms; clashing columns."""
    texts = [None, "", " ", "\n\n", "a", " a", "a ", "a<P>b c", "x <", "< S> <M", "<S", "é 😀 ü b c", "a\x0bb\x1cc", "one two three " * 9]
    docs = [(i, t) for i in range(12) for t in texts] + [(None, "a b c"), (-7, "a b c d"), (3, "one two"), (3, "one two")]
    docs += [(10**12 + i, "wörd " * 200_000 + "end") for i in range(3)]
    df = spark.createDataFrame([(d, t, 1, "z", "q", "w") for d, t in docs], "doc_id long, text string, n long, form string, output string, units string")
    assert run(df) == sorted((brute(*d) for d in docs), key=repr)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []
