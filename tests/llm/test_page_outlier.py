"""One odd labelled page does not change what tags cost on all pages."""

import pytest

from tiermill.llm.main_text import extract, fit

SIDE = "<div><p>one <a>link</a></p></div>"  # makes div and a slightly commoner outside than inside
PAGE = f"<html><body>{SIDE}{SIDE}<article><div><p>First words of a <a>text</a> here</p></div><p>and the other half of it follows.</p></article></body></html>"
TEXT = "First words of a text here\nand the other half of it follows."


@pytest.mark.parametrize("outlier", [5, 20_000])
def test_outlier(spark, outlier):
    odd = f"<html><body>{'word ' * outlier}<article><p>Short.</p></article></body></html>"
    rows = [(i, "u", PAGE) for i in range(20)]
    df = spark.createDataFrame([*rows, (99, "u", odd)], "page_id long, url string, html string")
    weights = fit(df)
    assert weights == fit(spark.createDataFrame([*rows, (99, "u", odd.replace("word ", ""))], df.schema))
    got = {r.page_id: r.text for r in extract(df, weights).collect()}
    assert all(TEXT in got[i] for i in range(20))
