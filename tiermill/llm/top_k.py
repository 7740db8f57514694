"""Exact top-k inner products: vectors by descending length, rotated partial sums and Cauchy-Schwarz bounds.

All vectors give one Gram matrix, whose eigenvectors (the right singular vectors of the data) are the rotation: leading
components hold most of the length.  A task takes its vectors longest first.  Against a block of queries it stops where
length times length cannot reach a query's k-th best score; before that, the first HEAD rotated components plus the
product of the residual lengths bound every score, and only pairs whose bound reaches the k-th best are scored exactly.

Queries are sent in waves of at most WAVE rows, so what is broadcast has a fixed size, and the number of waves grows with
the queries.  A wave starts from the k-th best scores among the LONGEST vectors of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiermill.plans.staging import stage

WAVE = 20_000  # queries broadcast at once
LONGEST = 2_000  # vectors that give the first thresholds
HEAD = 16  # rotated components of the partial sums
BLOCK = 2_048  # vectors and queries compared at once
SLACK = 1e-6  # relative room for rounding in bounds
EXACT = 2.0**53  # squared length below which every product, and every part of its sum, is an exact double


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v, length2, width) with v = floor(scale * x); rows with a null or non-finite component or null id do not count."""
    usable = F.expr(
        "vec_id is not null and embedding is not null and size(embedding) > 0 and "
        "forall(embedding, x -> x is not null and not isnan(x) and abs(double(x)) < double('infinity'))"
    )
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long"), F.expr(f"transform(embedding, x -> double(floor(double(x) * {scale})))").alias("v")
    )
    return rows.withColumns({"length2": F.expr("aggregate(v, 0D, (t, x) -> t + x * x)"), "width": F.size("v")})


def gram(rows: DataFrame, width: int) -> np.ndarray:
    """The sum of outer products, combined in tasks: width squared numbers each."""

    def work(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = np.array(batch.column(0).flatten()).reshape(-1, width)
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"i": np.arange(width, dtype=np.int32), "row": pa.array(list(total), pa.list_(pa.float64()))})

    sums = rows.select("v").mapInArrow(work, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    found = sums.groupBy("i", "j").agg(F.sum("x").alias("x")).collect()  # width squared rows
    out = np.zeros((width, width))
    for r in found:
        out[r.i, r.j] = r.x
    return out


class Best:
    """The k best (score, id) of every query; ties go to smaller ids."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.scores, self.ids = np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max)
        self.k, self.floor = k, floor

    def least(self, part: slice) -> np.ndarray:
        return np.maximum(self.scores[part, -1], self.floor[part])

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        for q in np.unique(query):
            own = query == q
            s = np.concatenate([self.scores[q], score[own]])
            i = np.concatenate([self.ids[q], ids[own]])
            top = np.lexsort((i, -s))[: self.k]
            self.scores[q], self.ids[q] = s[top], i[top]


def search(x, ids, queries, query_ids, turn, head: int, k: int, floor) -> Best:
    """The best of ``x`` (any order) for the queries, by the bounds of the module's text."""
    length = np.sqrt((x * x).sum(1))
    order = np.lexsort((ids, -length))
    x, ids, length = x[order], ids[order], length[order]
    q_length = np.sqrt((queries * queries).sum(1))
    front, q_front = x @ turn[:, :head], queries @ turn[:, :head]
    rest = np.sqrt(np.maximum(length**2 - (front**2).sum(1), 0))
    q_rest = np.sqrt(np.maximum(q_length**2 - (q_front**2).sum(1), 0))
    best = Best(len(queries), k, floor)
    for at in range(0, len(queries), BLOCK):
        part = slice(at, min(at + BLOCK, len(queries)))
        for lo in range(0, len(x), BLOCK):
            hi = min(lo + BLOCK, len(x))
            least = best.least(part)
            room = SLACK * (1 + q_length[part] * length[lo])
            alive = np.flatnonzero(q_length[part] * length[lo] + room >= least)
            if not len(alive):
                break  # all later vectors are shorter
            rows = at + alive
            bound = q_front[rows] @ front[lo:hi].T + q_rest[rows, None] * rest[None, lo:hi]
            a, b = np.nonzero(bound + room[alive, None] >= least[alive, None])
            for cut in range(0, len(a), 1 << 16):
                u, v = rows[a[cut : cut + (1 << 16)]], lo + b[cut : cut + (1 << 16)]
                score = np.einsum("ij,ij->i", queries[u], x[v])
                keep = (query_ids[u] != ids[v]) & (score >= best.least(slice(None))[u])
                best.add(u[keep], score[keep], ids[v][keep])
    return best


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, head: int = HEAD, wave: int = WAVE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query with other rows.

    ``is_query`` is a condition on vec_id.  A query's own id is no candidate; fewer candidates give fewer rows, ties go to
    smaller ids.  Repeated rows of one id are candidates each, and queries whose results share one ranking.  Vectors have
    products with those of their own width only: each width is searched by itself, so a query without others of its width
    has no rows.  Scores are exact; vectors so long that they might not be raise ValueError.  An empty table gives no rows.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stage(integers(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    found = rows.groupBy("width").agg(F.max("length2").alias("most")).orderBy("width").collect()  # a number per width
    if any(not r.most < EXACT for r in found):
        raise ValueError(f"squared lengths reach {max(r.most for r in found)}: scores beyond {EXACT:.0f} would not be exact")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    parts = []
    for r in found:
        for best in _waves(rows.where(F.col("width") == r.width), is_query, k, head, wave, r.width):
            ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            parts.append(stage(ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score"), "top"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if len(parts) == 1:
        return parts[0]
    # Rows of one query id may have been in several waves, or have several widths.
    again = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return again.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _waves(rows: DataFrame, is_query, k: int, head: int, wave: int, width: int) -> Iterator[DataFrame]:
    """(query_id, vec_id, score) of every wave of queries: the best of each part of ``rows``, all of one width."""
    spark = rows.sparkSession
    turn = np.linalg.eigh(gram(rows, width))[1][:, ::-1].copy()
    head = min(head, width)

    def unpacked(found) -> tuple[np.ndarray, np.ndarray]:
        return np.array([r.vec_id for r in found], np.int64), np.array([r.v for r in found], float).reshape(-1, width)

    long_ids, long_x = unpacked(rows.orderBy(F.desc("length2"), "vec_id").limit(LONGEST).collect())  # bounded
    queries = rows.where(is_query)
    waves = max(1, -(-queries.count() // (wave // 2)))  # half, as hashing deals them unevenly
    for w in range(waves):
        q_ids, q = unpacked(queries.where(F.pmod(F.xxhash64("row"), F.lit(waves)) == w).collect())  # about wave / 2 rows
        if not len(q_ids):
            continue
        floor = search(long_x, long_ids, q, q_ids, turn, head, k, np.full(len(q), -np.inf)).scores[:, -1]
        sent = spark.sparkContext.broadcast((q_ids, q, floor, turn))

        def scan(batches, sent=sent):
            q_ids, q, floor, turn = sent.value
            ids, parts, size = [], [], 0

            def flush():
                best = search(np.concatenate(parts), np.concatenate(ids), q, q_ids, turn, head, k, floor)
                query, place = np.nonzero(np.isfinite(best.scores))
                return pa.RecordBatch.from_pydict(
                    {"query_id": q_ids[query], "vec_id": best.ids[query, place], "score": best.scores[query, place].astype(np.int64)}
                )

            for batch in batches:
                ids.append(batch.column(0).to_numpy())
                parts.append(np.array(batch.column(1).flatten()).reshape(-1, width))
                size += batch.num_rows
                if size >= 100_000:
                    yield flush()
                    ids, parts, size = [], [], 0
            if size:
                yield flush()

        yield rows.select("vec_id", "v").mapInArrow(scan, "query_id long, vec_id long, score long")
