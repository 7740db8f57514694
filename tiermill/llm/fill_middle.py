"""Fill-in-the-middle transformation with cuts found in an indexable skip list.

A text's units (words with the white space before them) are the bottom lane of the list.  Every lane above keeps one link
for FAN links below it, and each link carries two widths: how many units and how many code points it spans.  Descending
from the top lane, a link is taken as long as the accumulated unit-width does not pass the wanted rank; the accumulated
code-point-width then is the exact place of the cut, in as many steps as there are lanes times FAN.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

FAN = 16  # links of a lane under one link of the lane above
UNITS = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKS = ("<P>", "<S>", "<M>")
PLAIN_FROM = 50  # third number of the hash modulo 100, from which a text stays plain
SPM_BELOW = 80  # fourth number modulo 100, below which a cut text takes the suffix-first form


class SkipList:
    """An indexable skip list over units of the given code-point widths."""

    def __init__(self, widths: np.ndarray):
        units, points = np.ones(len(widths), np.int64), widths.astype(np.int64)
        self.lanes = [(units, points)]  # bottom first
        while len(units) > FAN:
            starts = np.arange(0, len(units), FAN)
            units, points = np.add.reduceat(units, starts), np.add.reduceat(points, starts)
            self.lanes.append((units, points))

    def __len__(self) -> int:
        return int(self.lanes[-1][0].sum())

    def points_before(self, rank: int) -> int:
        """How many code points the first ``rank`` units have."""
        at = passed = points = 0  # link of the lane, units and code points left of it
        for units, widths in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed += int(units[at])
                points += int(widths[at])
                at += 1
            at *= FAN
        return points


def unit_widths(text: str) -> np.ndarray:
    return np.fromiter(map(len, UNITS.findall(text)), np.int64)


def numbers(key: str) -> list[int]:
    """The first four 8-digit groups of the hex sha256 of ``key``."""
    digest = hashlib.sha256(key.encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transform(text: str, key: str) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and middle, output) of one text."""
    widths = unit_widths(text)
    n = len(widths)
    one, two, plain, spm = numbers(key)
    if not n or plain % 100 >= PLAIN_FROM or any(mark in text for mark in MARKS):
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, second = (units.points_before(rank) for rank in sorted((one % (n + 1), two % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if spm % 100 < SPM_BELOW:
        return n, "spm", first, second - first, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", first, second - first, f"<P>{prefix}<S>{suffix}<M>{middle}"


def fill_middle(documents: DataFrame, seed: int = 42) -> DataFrame:
    """Per row: doc_id, n (units), form (plain, spm or psm), prefix_chars, middle_chars and output.

    The cuts and the form follow from sha256 of ``seed:doc_id``, so a row's result does not depend on other rows, and
    repeated ids get equal cuts; a null id counts as the empty string.  Null and empty texts are plain and empty, and so are
    texts that contain a marker plain, whatever the hash says.  Cuts are at units, prefix, middle and suffix may be empty,
    and texts of any length are handled whole.  Other columns are ignored; an empty table gives no rows.
    """
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def work(batches) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            keys = (f"{seed}:{'' if doc is None else doc}" for doc in ids)
            rows = [(doc, *transform(text or "", key)) for doc, text, key in zip(ids, texts, keys, strict=True)]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.  Its parts hold no marker, so every marker in it is one of the three."""
    parts = F.split(output, "<[PSM]>")
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def oracle(seed: int = 42) -> str:
    """DuckDB SQL for the digests of ``fill_middle`` over ``documents``."""
    word = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    marks = " OR ".join(f"contains(text, '{m}')" for m in MARKS)
    number = ", ".join(f"('0x' || h[{8 * i + 1}:{8 * i + 8}])::BIGINT AS h{i + 1}" for i in range(4))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS u,
                  sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (SELECT doc_id, text, u, len(u) AS n, {number} FROM d),
f AS (SELECT *, CASE WHEN n = 0 OR h3 % 100 >= {PLAIN_FROM} OR {marks} THEN 'plain'
                     WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form,
             least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM c),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:n], '') AS suffix FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""
