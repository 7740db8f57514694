"""Main text of web pages: the maximum-scoring run of words and tags.

A page is a sequence of words and tags.  Their weights are log-odds of standing inside the main text, learned from pages
that label it themselves by a single ``<article>`` or ``<main>`` element; words are held at or below 1, tags below 0
and at their log-odds, whatever a single page or the size of the corpus.  One
linear scan finds the run of highest total, which is the content region; its text is returned block by block.  Features
are tag names (not classes), each with the kind of region it stands in, so the model is small whatever the pages hold.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

TAGS = 2000  # bound of the features the driver holds, the most frequent ones
FAINT = 0.01  # cost of a tag that is at home in main text
PRIOR = 0.5
# Fixed values of HTML: raw or hidden elements, elements that start a block, those without content, regions beside the text.
RAW = frozenset("script style noscript template iframe svg textarea title select button object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul head".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BESIDE = frozenset("nav footer aside form menu dialog".split())
BESIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "masthead menu nav navbar navigation newsletter notice notices popup promo promoted related share sharing sidebar social "
    "sponsor sponsored subscribe widget".split()
)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S | re.I,
)
CODE = ("script", "style")  # their text may hold anything but their end tag
TEXT = ("textarea", "title", "iframe")  # their text is no markup
END = {t: re.compile(rf"<(/?){t}(?=[\s/>])[^>]*>" if t in TEXT else rf"<(/){t}(?=[\s/>])[^>]*>", re.I) for t in (*CODE, *TEXT)}
UNQUOTED = re.compile(r"""=\s*[^\s"'=]*/$""")  # the slash belongs to an attribute's value
WORD = "#"


def _names(attributes: str) -> list[str]:
    """The words of an element's class, id and role."""
    names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)) if attributes else ""
    return re.split(r"[^a-z0-9]+", names.lower())


def _beside(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is a region beside the text; a header within the content holds its title."""
    if tag in BESIDE or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return not BESIDE_NAMES.isdisjoint(_names(attributes))


def tags(page: str) -> list[tuple[int, int, bool, str, str]]:
    """(start, end, whether it closes, name, attributes) of the tags in order; comments and the like have no name.  Text
    of CODE and TEXT elements holds no tags if the element is closed."""
    found, at, absent = [], 0, set()
    while m := PART.search(page, at):
        close, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        at, tag = m.end(), (tag or "").lower()
        found.append((m.start(), at, bool(close), tag, attributes or ""))
        if tag in END and not close and not _empty(attributes) and tag not in absent:
            end = END[tag].search(page, at)
            if not end:
                absent.add(tag)
            elif end[1]:
                found.append((end.start(), end.end(), True, tag, ""))
                at = end.end()
    return found


def _empty(attributes: str) -> bool:
    """Whether a tag closes itself."""
    return attributes.endswith("/") and not UNQUOTED.search(attributes)


def _raw_ends(marks: list[tuple[int, int, bool, str, str]], length: int) -> dict[int, int]:
    """Where each raw element ends, by the index of its tag: behind its end tag or, without one, at the next block tag."""
    ends, opened, block = {}, {}, length
    for i, (_, end, close, tag, attributes) in enumerate(marks):
        if tag in RAW:
            if not close and not _empty(attributes):
                opened.setdefault(tag, []).append(i)
            elif close and opened.get(tag):
                ends[opened[tag].pop()] = end
    before = length  # of block tags other than a select's own
    for i in range(len(marks) - 1, -1, -1):
        start, _, close, tag, attributes = marks[i]
        if tag in RAW and not close and not _empty(attributes) and i not in ends:
            ends[i] = before if tag == "select" else block
        if tag in BLOCK:
            block = start
            before = before if tag in ("option", "optgroup") else start
    return ends


def sequence(page: str) -> list[tuple[str, str]]:
    """(feature, text) of a page in order: text pieces have the feature WORD, tags theirs; ``~`` marks regions beside the
    content, ``^`` those within a content element.

    A ``main`` or ``article`` within a region beside the text ends that mark: the region is a wrapper.  Articles within
    articles, in HTML's own regions beside the text, and those named as comments do not.
    """
    marks = tags(page)
    raw = _raw_ends(marks, len(page))
    found, stack, at = [], [], 0
    beside = content = within = hard = 0  # open regions beside the text, content elements, articles, BESIDE elements but forms

    def kind() -> str:
        return "" if not beside else "^" if content else "~"

    def text(piece: str) -> None:
        if piece:
            found.append((kind() + WORD, html.unescape(piece)))

    for i, (start, end, close, tag, attributes) in enumerate(marks):
        if start < at:
            continue
        text(page[at:start])
        at = raw.get(i, end)
        if not tag or tag in RAW:
            continue
        if close:
            found.append((kind() + "/" + tag, ""))
            if any(entry[0] == tag for entry in stack):
                while stack:
                    name, *state = stack.pop()
                    beside, content, within, hard = state
                    if name == tag:
                        break
        else:
            if tag not in VOID:
                stack.append((tag, beside, content, within, hard))
                if tag in ("article", "main"):
                    if tag == "main" or not (within or hard or "comment" in _names(attributes)):
                        beside = hard = 0
                    content += 1
                    within += tag == "article"
                else:
                    beside += _beside(tag, attributes, content > 0)
                    hard += tag in BESIDE and tag != "form"
            found.append((kind() + tag, ""))
    text(page[at:])
    return found


def labelled(parts: list[tuple[str, str]]) -> tuple[int, int] | None:
    """The places of the only content element's tags, if the page has one."""
    for tag in ("article", "main"):
        opened = [i for i, (f, _) in enumerate(parts) if f == tag]
        if len(opened) == 1:
            closed = [i for i, (f, _) in enumerate(parts) if f == "/" + tag and i > opened[0]]
            return opened[0], closed[0] if closed else len(parts)
    return None


@dataclass(frozen=True)
class Weights:
    by_feature: dict[str, float]

    def of(self, feature: str) -> float:
        known = self.by_feature.get(feature)
        if known is not None:
            return known
        return -1.0 if feature.startswith("~") else 0.0 if feature.endswith(WORD) else -FAINT


def fit(pages: DataFrame, features: int = TAGS) -> Weights:
    """Weights from every page that labels its own content; at most ``features`` of them.  Without such pages: defaults."""

    def count(batches):
        total: dict[str, list[int]] = {}
        for (pages_,) in slices(batches, 0):
            for page in pages_:
                parts = sequence(page or "")
                if not (span := labelled(parts)):
                    continue
                for i, (feature, text) in enumerate(parts):
                    own = total.setdefault(feature, [0, 0])
                    inside = span[0] < i < span[1]
                    n = len(text.split()) if feature.endswith(WORD) else 1
                    own[0 if inside else 1] += n
        rows = [(k, a, b) for k, (a, b) in total.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["f", "a", "b"])

    counts = pages.select("html").mapInArrow(count, "f string, a long, b long").groupBy("f")
    counts = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rows = counts.orderBy(F.desc(F.col("a") + F.col("b")), "f").limit(features).collect()
    if not rows:
        return Weights({WORD: 1.0, "~" + WORD: -1.0})
    weights = {}
    for r in rows:
        odds = math.log((r.a + PRIOR) / (r.b + PRIOR))
        if r.f.endswith(WORD):
            weights[r.f] = max(-1.0, min(1.0, odds)) if r.f != WORD else 1.0
        else:
            weights[r.f] = -max(FAINT, -odds)
    return Weights(weights)


def region(parts: list[tuple[str, str]], weights: Weights) -> tuple[int, int]:
    """The contiguous parts of highest total (first, end), the earliest of equals; an empty one without words."""
    best, total, start, found = 0.0, 0.0, 0, (0, 0)
    for i, (feature, text) in enumerate(parts):
        value = weights.of(feature)
        total += value * len(text.split()) if feature.endswith(WORD) else value
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, found = total, (start, i + 1)
    return found


def blocks(parts: list[tuple[str, str]]) -> list[str]:
    """The text of the parts by block, white space as single spaces; regions beside the text are left out."""
    done, block = [], []
    for feature, text in [*parts, ("p", "")]:
        name = feature.lstrip("~^/")
        if feature == WORD:
            block.append(text)
        elif name == "br":
            block.append(" ")
        elif name in BLOCK:
            if words := "".join(block).split():
                done.append(" ".join(words))
            block = []
    return done


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """One row per page: page_id, url and ``text``, the blocks of its main text joined by newlines.

    Null and empty pages, and pages without words, have an empty text.  Pages are read one by one, so repeated rows and
    null ids give one row each; other columns are ignored.
    """

    def work(batches):
        for ids, urls, htmls in slices(batches, 2):
            texts = []
            for page in htmls:
                parts = sequence(page or "")
                first, end = region(parts, weights)
                texts.append("\n".join(blocks(parts[first:end])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(work, "page_id long, url string, text string")
