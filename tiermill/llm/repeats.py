"""Removal of byte strings of a given length that occur more than once, exactly and over all documents.

Every window of WIDTH bytes names an anchor inside it: the leftmost of its GRAM-byte strings with the smallest hash.  Equal
windows name equal anchors at equal places, so only windows around an anchor that occurs twice can repeat.

1. Anchors (one per 75 bytes or so) are counted with a hash of the bytes that windows around them can reach.  Anchors that
   occur once are settled; where the whole surroundings occur twice, all of them are covered.  Anchors are shuffled once,
   and only those that occur again are stored; surroundings that one slice of texts holds several times go as one.
2. For the rest, the surroundings of equal anchors meet and their windows are compared.  Anchors with more than HOT
   different surroundings are not gathered: their windows are counted by hash over the whole cluster.
3. Each document's covered runs are merged and cut out.  The texts that steps 2 and 3 read are shuffled once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiermill.plans.staging import stage

from .common import BYTES, Powers, mix, slices

WIDTH = 200
GRAM = 50
HOT = 1000  # different surroundings up to which one task compares an anchor's windows
TASK_ROWS = 20_000  # surroundings a task gets, about


def window_hashes(data: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of every ``width`` bytes, along the last axis."""
    n = data.shape[-1]
    up, down = powers(n)
    total = np.zeros((*data.shape[:-1], n + 1), np.uint64)
    np.cumsum(BYTES[data] * up, axis=-1, out=total[..., 1:])
    return mix((total[..., width:] - total[..., :-width]) * down[: n - width + 1])


def anchors(hashes: np.ndarray, span: int) -> np.ndarray:
    """The places of the leftmost smallest hash in every ``span`` consecutive ones, each once."""
    n = len(hashes)
    value = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = value
    blocks = blocks.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    lowest = np.minimum(behind[: n - span + 1], ahead[span - 1 : n])
    return np.unique(lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _met(keys: np.ndarray, at: np.ndarray, anchor: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors, renamed, and how often their surroundings were met.  Of equal surroundings the first row stands for all;
    the others are settled, being repeated, and get names of their own so that they burden nobody's group."""
    _, first, back, times = np.unique(mix(mix(anchor) + around), return_index=True, return_inverse=True, return_counts=True)
    other = np.ones(len(at), bool)
    other[first] = False
    named = np.where(other, mix(mix(keys.view(np.uint64)) + at.astype(np.uint64)), anchor)
    return named, times[back]


def _anchors(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """(key, at, anchor, around, n): every anchor, the hash of its surroundings, and how many rows it stands for."""
    reach = width - gram

    def work(batches):
        powers = Powers()
        for keys, texts in slices(batches):
            out = [[], [], [], []]
            for key, text in zip(keys, texts, strict=True):
                data = _encoded(text)
                if len(data) < width:
                    continue
                found = window_hashes(np.frombuffer(data, np.uint8), gram, powers)
                at = anchors(found, reach + 1)
                out[0].append(np.full(len(at), key, np.int64))
                out[1].append(at)
                out[2].append(found[at])
                around = (xxhash.xxh3_64_intdigest(data[max(0, a - reach) : a + width], min(a, reach)) for a in at.tolist())
                out[3].append(np.fromiter(around, np.uint64, len(at)))
            if out[0]:
                key, at, anchor, around = (np.concatenate(x) for x in out)
                anchor, n = _met(key, at, anchor, around)
                yield pa.RecordBatch.from_pydict({"key": key, "at": at, "anchor": anchor.view(np.int64), "around": around.view(np.int64), "n": n})

    return docs.select("key", "text").mapInArrow(work, "key long, at long, anchor long, around long, n long")


def _surroundings(docs: DataFrame, wanted: DataFrame, width: int, gram: int) -> DataFrame:
    """(key, at, anchor, warm, left, data): the bytes around each wanted anchor and how many of them lie left of it."""
    reach = width - gram
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("at", "anchor", "warm")).alias("wanted"))  # of one text

    def work(batches):
        for _, texts, keys, lists in slices(batches):
            rows = []
            for key, text, places in zip(keys, texts, lists, strict=True):
                data = _encoded(text)
                for p in places:
                    a = p["at"]
                    rows.append((key, a, p["anchor"], p["warm"], min(a, reach), data[max(0, a - reach) : a + width]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "at", "anchor", "warm", "left", "data"]
            )

    # all columns of docs, as in remove_repeats, so that Spark can use one shuffle of the texts for both joins
    joined = docs.join(lists, "key").select(*docs.columns, "wanted")
    return joined.mapInArrow(work, "key long, at long, anchor long, warm boolean, left long, data binary")


def _windows(table: dict, width: int, reach: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of anchor, place and bytes (rows x windows, aligned at the anchor) and which of them exist."""
    m = len(table["data"])
    matrix = np.zeros((m, reach + width), np.uint8)
    start, size = np.empty(m, np.int64), np.empty(m, np.int64)
    for i, (left, data) in enumerate(zip(table["left"], table["data"], strict=True)):
        start[i], size[i] = reach - left, len(data)
        matrix[i, start[i] : start[i] + len(data)] = np.frombuffer(data, np.uint8)
    where = np.arange(reach + 1)
    real = (where >= start[:, None]) & (where + width <= (start + size)[:, None])
    hashes, salt = window_hashes(matrix, width, powers), mix(np.array(table["anchor"], np.int64).view(np.uint64))
    return mix(hashes + salt[:, None] + where.astype(np.uint64)), real


def _runs(keys, ats, flags: np.ndarray, width: int, reach: int) -> pa.RecordBatch:
    """Rows (key, lo, hi) of the bytes that the flagged windows cover."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    base = np.asarray(ats, np.int64)[row] - reach
    return pa.RecordBatch.from_pydict({"key": np.asarray(keys, np.int64)[row], "lo": base + first, "hi": base + last + width})


def covered(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Runs of bytes (key, lo, hi) covered by repeated windows; ``docs`` has doc_id, text and key (equal for equal rows only)."""
    reach = width - gram
    found = _anchors(docs, width, gram).repartition("anchor")
    alike = Window.partitionBy("anchor", "around")
    found = found.withColumn("nth", F.row_number().over(alike.orderBy("key", "at"))).withColumn("n", F.sum("n").over(alike))
    found = found.withColumn("kinds", F.sum(F.when(F.col("nth") == 1, 1)).over(Window.partitionBy("anchor")))
    lone = (F.col("nth") > 1) | (F.col("kinds") == 1)  # its surroundings are compared with no others
    again = found.where("n > 1 or kinds > 1").select(
        "key", "at", (F.col("n") > 1).alias("whole"), *(F.when(~lone, F.col(c)).alias(c) for c in ("anchor", "kinds"))
    )
    again = stage(again, "again")
    whole = again.where("whole").select("key", F.greatest(F.col("at") - reach, F.lit(0)).alias("lo"), (F.col("at") + width).alias("hi"))
    open_ = again.where("anchor is not null").withColumn("warm", F.col("kinds") > hot)
    n_open, n_warm = open_.agg(F.count("*"), F.count(F.when(F.col("warm"), 1))).first()
    # one shuffle that every reader below reads whole: each keeps its own rows, since a filter in Spark would make another
    around = _surroundings(docs, open_, width, gram).withColumn("dealt", F.when(F.col("warm"), F.xxhash64("key", "at")).otherwise(F.col("anchor")))
    around = around.repartition(max(1, -(-n_open // TASK_ROWS)), "dealt")

    def compare(batches):
        powers = Powers()
        found = [b.filter(pc.invert(b.column("warm"))) for b in batches]  # about TASK_ROWS
        table = pa.Table.from_batches(found).to_pydict() if found else {"anchor": []}
        for rows in _cuts(table["anchor"]):
            part = {k: [v[i] for i in rows] for k, v in table.items()}
            named, real = _windows(part, width, reach, powers)
            _, back, times = np.unique(named[real], return_inverse=True, return_counts=True)
            flags = np.zeros(real.shape, bool)
            flags[real] = times[back] > 1
            yield _runs(part["key"], part["at"], flags, width, reach)

    def _cuts(names):
        """Row numbers by anchor, several anchors together up to some thousand rows."""
        order = np.argsort(np.array(names), kind="stable")
        sorted_ = np.array(names)[order]
        ends = [] if not names else [*np.flatnonzero(np.diff(sorted_)) + 1, len(order)]
        start = 0
        for i, end in enumerate(ends):
            if i + 1 == len(ends) or ends[i + 1] - start > 4 * hot:
                yield order[start:end].tolist()
                start = end

    met = around.mapInArrow(compare, "key long, lo long, hi long")
    if not n_warm:
        return whole.union(met)

    def spell(batches):
        powers = Powers()
        for batch in batches:
            rows = batch.filter(batch.column("warm"))
            for at in range(0, rows.num_rows, 1000):
                part = rows.slice(at, 1000).to_pydict()
                named, real = _windows(part, width, reach, powers)
                row, place = np.nonzero(real)
                start = np.array(part["at"], np.int64)[row] - reach + place
                yield pa.RecordBatch.from_pydict({"key": np.array(part["key"], np.int64)[row], "lo": start, "name": named[real].view(np.int64)})

    spelt = around.mapInArrow(spell, "key long, lo long, name long")
    twice = spelt.groupBy("name").count().where("count > 1").select("name")
    spread = spelt.join(twice, "name").select("key", "lo", (F.col("lo") + width).alias("hi"))
    return whole.union(met).union(spread)


def remove_repeats(documents: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (removed runs of bytes) and rest (the remaining bytes).

    A byte goes if a ``width``-byte string that covers it also starts anywhere else, in this or another row; strings are
    judged on the input.  Null and empty texts have no bytes.  Repeated rows are copies of each other.  Other columns are
    ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    runs = covered(docs, width, gram, hot).groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))  # of one text
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def cut(batches):
        for ids, texts, lists in slices(batches):
            out = []
            for doc, text, found in zip(ids, texts, lists, strict=True):
                data, spans, rest, at = _encoded(text), [], [], 0
                for lo, hi in sorted((r["lo"], min(r["hi"], len(data))) for r in found or ()):
                    if spans and lo <= spans[-1]["hi"]:
                        spans[-1]["hi"] = max(hi, spans[-1]["hi"])
                    else:
                        spans.append({"lo": lo, "hi": hi})
                for s in spans:
                    rest.append(data[at : s["lo"]])
                    at = s["hi"]
                out.append((doc, len(data), spans, b"".join([*rest, data[at:]])))
            kinds = (pa.int64(), pa.int64(), kind, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "spans", "rest"]
            )

    joined = docs.join(runs, "key", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<lo: long, hi: long>>, rest binary")
