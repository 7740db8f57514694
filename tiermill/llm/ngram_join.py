"""Jaccard self-join of word n-gram sets by filters under several global token orders.

Under any order of all tokens, two sets of similarity t have a token in common among the first ``n - ceil(t n) + 1`` of each.
So the join takes several orders, and a pair is a candidate only if it shares a prefix token under every one of them:

1. *Orders.*  All put rare tokens first, by counts of hashed tokens over the whole corpus, and break ties by different
   hashes.  Passages that many texts share so come last, and are in no prefix of a text with enough tokens of its own.
2. *Index.*  The prefixes under the first order are an inverted index; texts with equal sets are one class.
3. *Filters.*  Pairs of a posting list are cut by set sizes and by where their prefixes meet, under the first order at once
   and then under the others: what stands before the first common token bounds the intersection.
4. *Verification* on full sets, which are computed for the classes of surviving pairs only.

What is wanted are components, so not all pairs of a group are made: classes are first compared with two pivots of their
posting lists, and then only pairs between components of a list that still holds several.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiermill.plans.staging import discard, stage

from .common import Powers, cuts, hashed_words, mix, rolled, shingle_sets
from .links import components

ORDERS = 3
COUNTERS = 1 << 20  # counters of hashed tokens, so what is sent to tasks has a fixed size
SEEDS = mix(np.arange(1, ORDERS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _sets(batches, k: int):
    """Cuts of batches whose second column is the text, with the shingle sets of their rows."""
    powers = Powers()
    for cut in cuts(batches):
        yield cut, shingle_sets(cut.column(1), k, powers)


def _standing_out(total: np.ndarray) -> pa.RecordBatch:
    """The counters that stand out of their mean."""
    mean = total.mean()
    high = np.flatnonzero(total > mean + 4 * math.sqrt(mean) + 2)
    return pa.RecordBatch.from_pydict({"counter": high.astype(np.int32), "n": total[high]})


def _powers_of_two(counted: DataFrame) -> np.ndarray:
    """For each of COUNTERS hashed tokens, how often it occurs as a power of two; 0 for those that do not stand out.

    A task reports the counters that stand out of its mean, so what reaches the driver is at most one row per counter.
    The counts only order tokens: results do not depend on them, the number of candidates does.
    """
    out = np.zeros(COUNTERS, np.uint64)
    for row in counted.groupBy("counter").agg(F.floor(F.log2(F.sum("n"))).cast("int").alias("power")).collect():
        out[row.counter] = row.power
    return out


def commonness(documents: DataFrame, k: int) -> np.ndarray:
    """How common the tokens of ``documents`` are, by hashed token (see ``_powers_of_two``).

    Texts of a cut are run together, whose few shingles across two texts do no harm.
    """

    def work(batches):
        total, powers = np.zeros(COUNTERS, np.int64), Powers()
        for cut in cuts(batches):
            found = rolled(hashed_words(cut.column(1), powers)[0], k)
            total += np.bincount(found.view(np.int64) & (COUNTERS - 1), minlength=COUNTERS)
        yield _standing_out(total)

    return _powers_of_two(documents.select(F.lit(0).alias("none"), "text").mapInArrow(work, "counter int, n long"))


def commonness_in(sets: DataFrame) -> np.ndarray:
    """``commonness`` of the tokens of ``sets`` (class, tokens)."""

    def work(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            found = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(found & (COUNTERS - 1), minlength=COUNTERS)
        yield _standing_out(total)

    return _powers_of_two(sets.select("tokens").mapInArrow(work, "counter int, n long"))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefixes(found: np.ndarray, common: np.ndarray, percent: int, orders: int) -> list[np.ndarray]:
    """The prefix of a set under every order: rare tokens first, ties by the order's own hash."""
    size = prefix_size(len(found), percent)
    rank = common[(found & np.uint64(COUNTERS - 1)).astype(np.int64)] << np.uint64(58)
    return [found[np.argsort(rank | mix(found ^ seed) >> np.uint64(6), kind="stable")[:size]] for seed in SEEDS[:orders]]


def sketches(documents: DataFrame, common: np.ndarray, k: int, percent: int, orders: int) -> DataFrame:
    """Per row: doc_id, whole (hash of the text), digest of the set (null: empty), n, the prefix under the first order,
    and those under the others as lists of 32-bit hashes, which may agree by chance but never miss."""
    sent = documents.sparkSession.sparkContext.broadcast(common)

    def work(batches):
        for cut_, sets in _sets(batches, k):
            ids, _, wholes = cut_.columns
            cut = [prefixes(s, sent.value, percent, orders) if len(s) else [s] * orders for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    wholes,
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([c[0].view(np.int64) for c in cut], pa.list_(pa.int64())),
                    pa.array([[p.astype(np.uint32).view(np.int32) for p in c[1:]] for c in cut], pa.list_(pa.list_(pa.int32()))),
                ],
                ["doc_id", "whole", "digest", "n", "prefix", "others"],
            )

    schema = "doc_id long, whole long, digest binary, n long, prefix array<long>, others array<array<int>>"
    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(work, schema)


def full_sets(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(class, tokens) of the wanted classes (class, digest, doc_id, whole), from the texts that represent them."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), "text", F.xxhash64("text").alias("hash"))
    wanted = wanted.select("class", F.col("digest"), F.col("doc_id").alias("id"), "whole")
    texts = texts.join(wanted, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("whole")))

    def work(batches):
        for cut, sets in _sets(batches, k):
            classes, digests = cut.column(0).to_pylist(), cut.column(2).to_pylist()
            rows = [(c, s.view(np.int64)) for c, d, s in zip(classes, digests, sets, strict=True) if xxhash.xxh3_128_digest(s.tobytes()) == d]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.list_(pa.int64()))], ["class", "tokens"]
            )

    found = texts.select("class", "text", "digest").mapInArrow(work, "class long, tokens array<long>")
    return found.groupBy("class").agg(F.first("tokens").alias("tokens"))  # repeated rows have equal sets


def sizes_fit(n: str, m: str, percent: int) -> Column:
    return F.expr(f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})")


def may_fit(percent: int) -> Column:
    """Whether two members (n, at; n_b, at_b) of a posting list can be similar if its token is their first common one."""
    bound = F.expr(f"{100 + percent} * least(n - at, n_b - at_b) >= {percent} * (n + n_b)")
    return sizes_fit("n", "n_b", percent) & bound


def filtered(pairs: DataFrame, classes: DataFrame, percent: int, orders: int) -> DataFrame:
    """The distinct pairs (a, b) whose sizes fit and whose prefixes meet early enough under all orders after the first.

    Each side is bounded by itself, so 32-bit hashes that agree by chance only weaken the bound.
    """
    for key in "ab":
        side = classes.select(F.col("class").alias(key), F.col("n").alias(f"n_{key}"), F.col("others").alias(f"others_{key}"))
        pairs = pairs.join(side, key)
    pairs = pairs.where(sizes_fit("n_a", "n_b", percent))
    for i in range(orders - 1):
        left, right = F.col("others_a")[i], F.col("others_b")[i]
        meets = F.arrays_overlap(left, right)
        for own, other, n in ((left, right, "n_a"), (right, left, "n_b")):
            at = F.array_position(own, F.array_intersect(own, other)[0])  # from 1
            meets &= (100 + percent) * (F.col(n) + 1 - at) >= percent * (F.col("n_a") + F.col("n_b"))
        pairs = pairs.where(meets)
    return pairs.select("a", "b", "n_a", "n_b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough, without their sizes."""
    kept = [c for c in pairs.columns if c not in ("n_a", "n_b")]
    for key in "ab":
        pairs = pairs.join(sets.select(F.col("class").alias(key), F.col("tokens").alias(f"tokens_{key}")), key)
    pairs = pairs.withColumn("common", F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long"))
    return pairs.where(f"100 * common >= {percent} * (n_a + n_b - common)").select(kept)


def ngram_components(documents: DataFrame, k: int = 4, percent: int = 85, orders: int = ORDERS) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles (size of its set) and component_id, the smallest doc_id reachable.

    A set holds the distinct ``k``-word shingles of a text with A-Z lower-cased; fewer words are one shingle.  Sets with at
    least ``percent`` hundredths of their union in common are linked, ties at the threshold included.  Null, empty and blank
    texts have empty sets and are linked with nothing.  Repeated rows are linked with each other; rows with a null id take
    part, and a component of such rows only has a null component_id.  Texts of any length are taken whole.  Other columns are
    ignored, whatever they are called; an empty table gives no rows.
    """
    documents = documents.select("doc_id", "text")
    rows = stage(sketches(documents, commonness(documents, k), k, percent, orders), "sketches")
    some = rows.where("digest is not null")
    grouped = some.groupBy("digest").agg(
        F.min(F.struct("doc_id", "whole")).alias("one"), F.min("doc_id").alias("lowest"), *(F.first(c).alias(c) for c in ("n", "prefix", "others"))
    )
    classes = stage(grouped.select(F.monotonically_increasing_id().alias("class"), "*").select("*", "one.*").drop("one"), "classes")
    named = rows.join(classes.select("digest", "class"), "digest", "left").select("doc_id", "n", "class")
    named = stage(named, "named")
    discard(rows)

    token = Window.partitionBy("token")
    index = classes.select("class", "n", F.posexplode("prefix").alias("at", "token"))
    shared = index.select(
        "*",
        F.count("*").over(token).alias("members"),
        F.min(F.struct("at", "class", "n")).over(token).alias("p"),  # fewest rarer tokens: amid its copies
        F.max(F.struct("n", "class", "at")).over(token).alias("q"),
    )
    shared = stage(shared.where("members > 1"), "shared")
    links: list[DataFrame] = []

    def link(pairs: DataFrame, name: str) -> bool:
        """Verify candidate pairs; whether any is linked."""
        pairs = stage(filtered(pairs, classes, percent, orders), f"{name}-candidates")
        if pairs.isEmpty():
            return False
        members = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        sets = stage(full_sets(documents, classes.join(members, "class"), k), f"{name}-sets")
        links.append(stage(verified(pairs, sets, percent), f"{name}-links"))
        discard(sets, pairs)
        return not links[-1].isEmpty()

    def labels() -> DataFrame:
        """(class, component) of linked classes."""
        edges = documents.sparkSession.createDataFrame([], "a long, b long")
        for found in links:
            edges = edges.union(found)
        return components(edges).withColumnRenamed("node", "class")

    def unsettled(label: DataFrame) -> DataFrame:
        """The members, with their components, of the posting lists that hold several components."""
        members = shared.join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
        lists = members.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        return stage(members.join(lists.where("lo <> hi").select("token"), "token"), "unsettled")

    pivots = F.explode(F.array(*(F.struct(f"{x}.class", f"{x}.n", f"{x}.at") for x in "pq"))).alias("pivot")
    pairs = shared.select("class", "n", "at", pivots).select("class", "n", "at", *(F.col(f"pivot.{c}").alias(f"{c}_b") for c in ("class", "n", "at")))
    pairs = pairs.where("class <> class_b").where(may_fit(percent))
    link(pairs.select(F.greatest("class", "class_b").alias("a"), F.least("class", "class_b").alias("b")).distinct(), "pivots")
    label = labels()
    left = unsettled(label).where("members > 2 and class not in (p.class, q.class)")  # pivots have met all of their lists
    before = F.lag("token").over(Window.partitionBy("class").orderBy("at"))
    left = left.select("class", "n", "at", "token", "component", before.alias("before"))
    other = left.select("token", *(F.col(c).alias(f"{c}_b") for c in ("class", "n", "at", "component", "before")))
    rest = left.join(other, "token").where("class > class_b and component <> component_b").where(may_fit(percent))
    rest = rest.where("before <> before_b or before is null or before_b is null")  # a pair's first common token has no common one before
    if link(rest.select(F.col("class").alias("a"), F.col("class_b").alias("b")).distinct(), "rest"):
        label = labels()

    lowest = classes.select("class", "lowest").join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
    first = lowest.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_class = lowest.join(first, "component").select("class", "component_id")
    out = named.join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
