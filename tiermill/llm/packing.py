"""Best-fit packing: local best fit, nearly full bins leave, underfull ones are dealt anew as items of the next round."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.plans.staging import stage

from .common import slices

CAPACITY = 4096
GROUP_ITEMS = 50_000  # items one task packs, about; the number of groups follows from the number of items
BIN_BITS = 24  # a bin's number is its round, its group and, in these bits, its place in the group
ROUND_BITS = 57  # bits below the round
SLACK = 16  # a bin with at most this many free tokens leaves at once
WORD_CACHE = 400_000  # distinct pieces of words, and distinct words that are not plain, a task remembers at most
RUN_CHARS = 500_000  # characters of texts handled at once; a longer text is handled alone
#: White space, printable ASCII and Latin letters, on whose kind, case and composition tables of any age agree.
PLAIN = re.compile(r"[\t-\r -~\u00a1-\u012f\u0131-\u024f]*")
#: What ``str.split`` cuts at although the tokenizer does not; such texts are cut by Unicode's White_Space instead.
SEPARATORS = re.compile(r"[\x1c-\x1f]")
NOT_SPACE = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def split_text(text: str) -> list[str]:
    return NOT_SPACE.findall(text) if SEPARATORS.search(text) else text.split()


class TokenIds(dict):
    """The ids of texts, as little-endian unsigned 32-bit bytes; the dictionary holds those of distinct pieces of words.

    Where the tokenizer's file says that it composes and lower-cases a text, keeps what one pattern matches and spells that in
    bytes, PLAIN text is treated so here, and only distinct pieces go through its merges.  Other words go to the tokenizer,
    which cuts at white space before anything else and drops it, and all do if the file says otherwise.  ``tests/llm``
    compare both ways with whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.encoder = Tokenizer.from_file(path)
        self.model = self.encoder.model
        self.spelling = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.added = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        self.pattern = self._pattern()
        self.others: dict[str, bytes] = {}

    def _pattern(self) -> re.Pattern | regex.Pattern | None:
        """What the tokenizer keeps of a text, if it works in the steps named above."""
        if self.encoder.normalizer is None or self.encoder.pre_tokenizer is None:
            return None
        before = json.loads(self.encoder.normalizer.__getstate__()).get("normalizers", [])
        steps = json.loads(self.encoder.pre_tokenizer.__getstate__()).get("pretokenizers", [])
        spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        if [x for x in before if x != spaces] != [{"type": "NFC"}, {"type": "Lowercase"}] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            return None
        split, spelling = steps
        kept = split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"]
        plain = not spelling["add_prefix_space"] and not spelling["use_regex"]
        return _on_plain(split["pattern"]["Regex"]) if kept and plain else None

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= WORD_CACHE:
            self.clear()
        spelled = piece if piece.isascii() else self.spelling.pre_tokenize_str(piece)[0][0]
        value = self[piece] = _bytes([t.id for t in self.model.tokenize(spelled)])
        return value

    def of(self, text: str) -> bytes:
        if self._is_plain(text):
            return self._plain(text)
        return b"".join([self._plain(w) if self._is_plain(w) else self._whole(w) for w in split_text(text)])

    def _is_plain(self, text: str) -> bool:
        return self.pattern is not None and PLAIN.fullmatch(text) is not None and not any(token in text for token in self.added)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(unicodedata.normalize("NFC", text).lower())))

    def _whole(self, word: str) -> bytes:
        if len(self.others) >= WORD_CACHE:
            self.others.clear()
        if word not in self.others:
            self.others[word] = _bytes(self.encoder.encode(word, add_special_tokens=False).ids)
        return self.others[word]


def _on_plain(pattern: str) -> re.Pattern | regex.Pattern:
    """``pattern`` for lower-cased PLAIN text: letters and numbers in brackets are listed, as the faster module knows no
    properties; a pattern that has others is left to the slower one."""
    found = sorted({chr(c).lower() for c in range(0x250) if PLAIN.fullmatch(chr(c))})
    outside, listed = re.sub(r"\[[^\[\]\\]*(?:\\.[^\[\]\\]*)*\]", "", pattern), pattern
    for kind in (r"\p{L}", r"\p{N}"):
        listed = listed.replace(kind, _ranges([ord(c) for c in found if regex.fullmatch(kind, c)]))
    return regex.compile(pattern) if r"\p" in listed.lower() or "[" in outside or r"\p" in outside else re.compile(listed)


def _ranges(codes: list[int]) -> str:
    """What stands for the ascending ``codes`` in brackets."""
    cuts = [i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1]
    return "".join(f"\\U{codes[a]:08x}-\\U{codes[b - 1]:08x}" for a, b in zip([0, *cuts], [*cuts, len(codes)], strict=True))


def _bytes(ids: Iterable[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def tokenized(documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32.

    A document is its text's ids followed by ``end_id`` (a null or empty text is ``end_id`` alone).  One longer than
    ``capacity`` is cut into pieces of that many ids; the last may be shorter.  ``tokenizer`` is a file every executor
    reaches.  Repeated rows and null ids give pieces of their own; other columns are ignored.  A task holds RUN_CHARS
    characters of texts, or one longer text, and WORD_CACHE words of either kind besides.
    """

    def cut(batches):
        ids_of, end = TokenIds(tokenizer), np.array([end_id], "<u4").tobytes()
        for ids, texts in slices(batches, chars=RUN_CHARS):
            rows = []
            for doc, text in zip(ids, texts, strict=True):
                data = ids_of.of(text or "") + end
                for start in range(0, len(data) // 4, capacity):
                    part = data[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start // capacity, start, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def best_fit(lengths: Iterable[int], capacity: int = CAPACITY) -> tuple[list[int], list[int], list[int]]:
    """Best fit, longest first: (bin of each item, offset of each item, fill of each bin).

    Open bins are kept by free space; an item goes to the bin it leaves least space in, the latest of equals.
    """
    lengths = list(lengths)
    bins, offsets, fills = [0] * len(lengths), [0] * len(lengths), []
    free: list[int] = []  # the distinct amounts of free space, ascending
    open_bins: dict[int, list[int]] = {}
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        at = bisect_left(free, size)
        if at == len(free):
            chosen, left = len(fills), capacity
            fills.append(0)
        else:
            left = free[at]
            chosen = open_bins[left].pop()
            if not open_bins[left]:
                del open_bins[left], free[at]
        bins[item], offsets[item] = chosen, fills[chosen]
        fills[chosen] += size
        if left := left - size:
            if left not in open_bins:
                open_bins[left] = []
                insort(free, left)
            open_bins[left].append(chosen)
    return bins, offsets, fills


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, slack: int = SLACK) -> DataFrame:
    """``pieces`` (any columns with ``length``, at most ``capacity``) with ``sequence_id`` and ``offset``.

    Items are dealt into groups of about ``group_items`` by a hash of their row numbers, so no value gathers in one task.
    Each group packs best fit.  Bins with at most ``slack`` free tokens are done, and so are those that have no room for
    the smallest one left; the others are items of the next round, dealt anew into groups of that size.  Rounds go on until
    one is of a single group or saves no bin.  Only lengths and numbers are moved, each round's rows are written to the
    shared folder, and every round carries only the bins that are not yet full.  A sequence's id is the number of its last
    bin, so ids are unique; offsets in a sequence are gapless from 0.  Existing columns of these two names are replaced,
    other columns stay, whatever they are called.  An empty table gives no rows.
    """
    kept = [F.col(f"row.`{c.replace('`', '``')}`") for c in pieces.columns if c not in ("sequence_id", "offset")]
    whole = pieces.select(F.struct("*").alias("row"), F.col("length"), F.monotonically_increasing_id().alias("item"))
    rows = stage(whole, "pieces")  # written once, so row numbers stay as they are
    n = rows.count()
    groups, level, before = max(1, -(-n // group_items)), 0, None
    moved = rows.select("item", "length")
    links = []

    def fit(key, table):
        table = table.sort_by("item")
        bins, offsets, fills = best_fit(table["length"].to_pylist(), capacity)
        first = (key[1].as_py() << ROUND_BITS) + (key[0].as_py() << BIN_BITS)
        return pa.table(
            {
                "item": table["item"],
                "bin": pa.array(np.array(bins, np.int64) + first),
                "at": pa.array(offsets, pa.int64()),
                "fill": pa.array(np.array(fills, np.int64)[bins]),
            }
        )

    while True:
        dealt = moved.withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(groups))).withColumn("level", F.lit(level).cast("long"))
        packed = stage(dealt.groupBy("grp", "level").applyInArrow(fit, "item long, bin long, at long, fill long"), f"bins-{level}")
        links.append(packed)
        if groups == 1 or (before is not None and packed.select("bin").distinct().count() == before):
            break
        under = packed.where(F.col("fill") < capacity - slack).groupBy("bin").agg(F.first("fill").alias("length"))
        least = under.agg(F.min("length")).first()[0]
        if least is None:
            break
        under = under.where(F.col("length") <= capacity - least)
        before = under.count()
        if before < 2:
            break
        groups, level = -(-before // group_items), level + 1
        moved = under.select(F.col("bin").alias("item"), "length")
    placed = rows.select("row", "item").join(links[0].select("item", F.col("bin").alias("last"), F.col("at").alias("offset")), "item")
    for link in links[1:]:  # follow merged bins upwards
        up = link.select(F.col("item").alias("last"), F.col("bin").alias("up"), F.col("at").alias("more"))
        placed = placed.join(up, "last", "left").select(
            "row", F.coalesce("up", "last").alias("last"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset")
        )
    return placed.select(*kept, F.col("last").alias("sequence_id"), "offset")
