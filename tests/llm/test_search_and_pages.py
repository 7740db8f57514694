"""Exact top-k against all products, and main text of pages against what they were made from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm.main_text import extract, fit
from tiermill.llm.top_k import top_k

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, every, k=5):
    good = {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in (i for i in good if i % every == 0):
        found = sorted((-int(good[q] @ x), i) for i, x in good.items() if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("n, wave", [(400, 20_000), (400, 4), (3, 10)])
def test_top_k_with_ties_and_bad_vectors(spark, n, wave):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(0, 0.02 + (i % 7) / 20, 24).tolist()) for i in range(n)]
    rows += [(n + i, rows[1][1]) for i in range(8)] + [(n + 8, [0.0] * 24), (n + 50, None), (n + 51, [float("nan")] * 24), (n + 52, [None] * 24)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 10 == 0, head=6, wave=wave).collect())) == brute(rows, 10)


def test_top_k_of_mixed_widths_and_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(1, 60)] + [(0, [1.0]), (10, [2.0]), (7, [3.0])]
    rows += [(20, [0.5] * 6), (21, rows[4][1]), (21, rows[4][1]), (None, [9.0] * 6), (60, []), (70, [1.0] * 9)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    ints = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v]
    want = []
    for q in range(0, 80, 10):
        pairs = [(-int(x @ y), j) for i, x in ints if i == q for j, y in ints if j != q and len(x) == len(y)]
        want += [(q, n + 1, j, -s) for n, (s, j) in enumerate(sorted(pairs)[:5])]
    for wave in (20_000, 2):
        assert sorted(map(tuple, top_k(df, F.col("vec_id") % 10 == 0, head=3, wave=wave).collect())) == sorted(want)


def test_top_k_refuses_scores_that_are_not_exact(spark):
    df = spark.createDataFrame([(0, [1e10, 1.0], "x"), (1, [1.0, 1.0], "x")], SCHEMA)
    with pytest.raises(ValueError, match="would not be exact"):
        top_k(df, F.col("vec_id") % 10 == 0)


def test_top_k_of_an_empty_table(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).collect() == []


HEAD = '<html><head><title>A title of words</title><script>var t="</p> more words";</script></head><body>'
NAV = '<nav><ul><li><a href="/a">one</a></li><li><a>two</a></li></ul></nav><div class="ad">buy these many good things now</div>'
FOOT = "<footer>&copy; some site and more words here</footer></body></html>"


def test_main_text(spark):
    plain = NAV + "<article><h1>Title &amp; x</h1><p><b>First\n  text<br><p>A <i>b</i>c &lt;d&gt; 1 < 2.</p><p>Of.</p></article>" + FOOT
    beside = HEAD + NAV + "<article><p>Kept words stay here.</p><aside>side words</aside><form>fill this</form><p>And these.</p></article>" + FOOT
    bare = HEAD + NAV + '<div id="content"><p>No mark but many more words than all that stands beside it here.</p><p>Two.</p></div>' + FOOT
    pages = [(i, "u", HEAD + plain, 1) for i in range(20)] + [(30, "v", beside, 1), (31, None, bare, 1), (32, "w", None, 1), (33, "w", "", 1), (None, "w", "<p>", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in extract(df, fit(df)).collect()}
    assert got[0] == "Title & x\nFirst text\nA bc <d> 1 < 2.\nOf."
    assert got[30] == "Kept words stay here.\nAnd these."
    assert got[31] == "No mark but many more words than all that stands beside it here.\nTwo."
    assert (got[32], got[33], got[None], len(got)) == ("", "", "", 25)


def test_pages_of_an_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(df, fit(df)).collect() == []
