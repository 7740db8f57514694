"""Raw elements that close themselves or never, custom elements, and wrappers around the article lose no text."""

import time

import pytest

from tiermill.llm.main_text import WORD, Weights, blocks, region, sequence

ARTICLE = "<article><h1>Head line</h1><p>All of these words must come back.</p></article>"
TEXT = "Head line\nAll of these words must come back."


def text_of(page):
    parts = sequence(page)
    first, end = region(parts, Weights({WORD: 1.0, "~" + WORD: -1.0}))
    return "\n".join(blocks(parts[first:end]))


@pytest.mark.parametrize(
    "before, after",
    [
        ("<svg/>", ""),
        ('<iframe src="x"/>', ""),
        ('<svg class="a>b" /><svg><title>gone</title><svg/></svg>', ""),
        ("<button>Menu", ""),
        ("<button>Menu", "<button>Share</button>"),
        ("<select><option>one<option>two", ""),
        ("<object><param>", ""),
        ("<title>A title<body>", "<svg><title>x</title></svg>"),
        ("<script>a < b", ""),
        ("<iframe src=http://x/>not shown</iframe>", ""),
        ("<textarea><p>not shown</textarea><style>p > a {}</style>", ""),
        ("<script>var a = '<!-- <svg> <article>';</script>", ""),
        ('<div class="layout has-sidebar">', "</div>"),
        ('<form id="page">', "</form>"),
        ('<form><div class="widget share"><main>', "</main></div></form>"),
        ('<main><div class="content-sidebar-wrap">', "</div></main>"),
        ("", '<section class="comments"><article class="comment">Not mine</article></section>'),
        ("<aside><article>A teaser</article></aside>", ""),
        ("<object><object>no</object>nor this</object>", ""),
    ],
)
def test_article_comes_back(before, after):
    assert text_of(f"<html>{before}{ARTICLE}{after}</html>") == TEXT


def test_custom_elements_are_not_raw():
    assert text_of("<p>One <button-group>two</button-group> three</p>") == "One two three"


def test_regions_within_the_article_stay_out():
    page = '<div class="has-sidebar"><article><p>Kept</p><aside>side</aside><div class="share">x</div><p>too</p></article></div>'
    assert text_of(page) == "Kept\ntoo"


def test_unclosed_raw_elements_take_linear_time():
    begin = time.monotonic()
    sequence("<button><title><script><svg>a" * 20_000)
    assert time.monotonic() - begin < 20
