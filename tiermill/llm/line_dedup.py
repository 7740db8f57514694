"""Line dedup by a log-template tree of fixed depth.

A line's leaf is its number of words and its LEAD leading words; words with a digit stand as the wildcard.  Within a leaf
a word is a constant at its position when at least ``least`` different texts have it there, else a variable field.  The
words with variable fields as wildcards are the line's template.  A template that recurs in ``least`` different texts and
consists of constants for the most part is dropped everywhere but where it first occurs.  A line shorter than LEAD is a
leaf of its own; ``words=1`` takes every line that is not blank.

Texts count, not documents, so exact copies count once.  Leaves of fewer texts hold no such template and are left out
before any word is shuffled; every count is combined before its shuffle and no leaf is gathered in a task.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.plans.staging import stage

from .common import WORD_CACHE, own_name, slices

LEAST = 10  # different texts a template must recur in
LEAD = 3  # leading words a leaf is keyed by
CONSTANT = 0.7  # share of a template's words that must be constants
WORDS = 1  # lines of fewer words are kept; blank ones always are
WILD = 0  # stands for a variable field
VARIABLE = re.compile(rb"[0-9]")


def token(word: bytes) -> int:
    return WILD if VARIABLE.search(word) else xxhash.xxh3_64_intdigest(word) >> 33 or 1


class Tokens(dict):
    """``token`` of a word, computed once per distinct word a worker meets."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = token(word)
        return value


def parsed(documents: DataFrame, lead: int = LEAD, words: int = WORDS) -> DataFrame:
    """The lines of at least ``words`` words, blank ones never: row (of doc_id and text), doc_id, text hash, line number, leaf and tokens."""

    words = max(words, 1)

    def work(batches):
        known = Tokens()
        for ids, texts, wholes in slices(batches):
            rows = []
            for doc, text, whole in zip(ids, texts, wholes, strict=True):
                for at, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
                    tokens = [known[w] for w in line.split()]
                    if len(tokens) >= words:
                        leaf = xxhash.xxh3_64_intdigest(repr((len(tokens), tokens[:lead])).encode()) - (1 << 63)
                        rows.append((doc, whole, at, leaf, tokens))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "whole", "at", "leaf", "tokens"]
            )

    schema = "doc_id long, whole long, at int, leaf long, tokens array<int>"
    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(work, schema)


def recurring(documents: DataFrame, least: int = LEAST, lead: int = LEAD, constant: float = CONSTANT, words: int = WORDS) -> DataFrame:
    """The lines to drop: doc_id, whole (hash of the text), at (line number), template (hash) and texts (it recurs in)."""
    lines = stage(parsed(documents, lead, words), "lines")
    often = lines.select("leaf", "whole").distinct().groupBy("leaf").count().where(F.col("count") >= least)
    lines = stage(lines.join(often.select("leaf"), "leaf"), "often")
    kinds = lines.groupBy("leaf", "tokens", "whole").agg(F.lit(1).alias("one"))
    words_ = kinds.select("leaf", "whole", F.posexplode("tokens").alias("p", "t")).where(F.col("t") != WILD)
    fixed = words_.distinct().groupBy("leaf", "p", "t").count().where(F.col("count") >= least).select("leaf", "p", "t")
    # A distinct line's template: its words, wildcards where they are no constants.
    distinct = lines.select("leaf", "tokens").distinct().withColumn("line", F.xxhash64("leaf", "tokens"))
    places = distinct.select("leaf", "line", F.posexplode("tokens").alias("p", "t")).join(fixed, ["leaf", "p", "t"])
    made = places.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("p", "t"))).alias("parts"))  # a line's words at most
    made = distinct.join(made, "line").where(F.size("parts") >= F.size("tokens") * constant)
    made = made.select("leaf", "tokens", F.xxhash64("leaf", "parts").alias("template"))
    named = stage(lines.join(made, ["leaf", "tokens"]).select("doc_id", "whole", "at", "template"), "templates")
    place = F.struct("doc_id", "whole", "at")
    counts = named.groupBy("template", "whole").agg(F.min(place).alias("first")).groupBy("template")
    counts = counts.agg(F.count("*").alias("texts"), F.min("first").alias("first")).where(F.col("texts") >= least)
    return named.join(counts, "template").where(~place.eqNullSafe(F.col("first"))).drop("first")


def drop_lines(documents: DataFrame, **settings) -> DataFrame:
    """``documents`` without recurring lines, with ``n_dropped`` (and ``n_chars`` renewed, if there).

    The first occurrence of a template, by doc_id (null first), stays.  No document goes: one that loses all its lines has
    an empty text; null and empty texts stay as they are.  Repeated rows are treated alike.  ``settings``: see
    ``recurring``.  Other columns stay; an existing ``n_dropped`` is replaced.
    """
    id_, whole_, gone_, hash_ = (own_name(documents, c) for c in ("_id", "_whole", "_gone", "_hash"))
    gone = recurring(documents, **settings).groupBy("doc_id", "whole").agg(F.collect_set("at").alias(gone_))
    gone = stage(gone.select(F.col("doc_id").alias(id_), F.col("whole").alias(whole_), gone_), "gone")
    base = documents.drop("n_dropped").withColumn(hash_, F.xxhash64("text"))
    joined = base.join(gone, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(whole_)), "left")
    rest = F.expr(f"array_join(filter(split(text, '\\\\n', -1), (x, i) -> not array_contains(`{gone_}`, i)), '\\n')")
    changed = {"text": F.when(F.col(gone_).isNull(), F.col("text")).otherwise(rest)}
    changed["n_dropped"] = F.expr(f"if(`{gone_}` is null, 0, size(`{gone_}`))").cast("long")
    out = joined.withColumns(changed)
    if "n_chars" in documents.columns:
        renewed = F.when(F.col(gone_).isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", renewed.cast(documents.schema["n_chars"].dataType))
    return out.select(*[c for c in documents.columns if c != "n_dropped"], "n_dropped")
