"""Near-duplicate documents by HyperMinHash.

1. *Registers.*  A bucket keeps, of the smallest value its hash function gives any shingle, only the number of leading
   zeros and MANTISSA bits behind the leading one: 16 bits.  Every bucket has a hash function of its own, so sets smaller
   than the number of buckets fill all registers too.
2. *Bands.*  Four registers fit one long.  Documents that agree in one of BANDS longs are candidates; a pair of Jaccard
   similarity 0.8 misses all bands with probability 5e-8.
3. *Estimate.*  The share of equal registers, corrected for registers that agree by collision, must come within MARGIN of
   the threshold.
4. *Verification* on the full shingle sets, made again from the texts of surviving pairs only; then connected components.

Documents with equal sets form a class and are represented once.  A bucket's centre is the member that shares the most
buckets with others: amid near copies, the one with the fewest changes.  Each class is first compared with two pivots, one
of them the greatest centre of its buckets; then, only in buckets that still hold several components, with those buckets'
centres.  Members of a bucket that these do not join meet in pairs only where they share a shingle among their rarest, early
enough for the threshold, and miss few enough of each other's rarest: pages of one template, each with words of its own,
fill a bucket and make no pairs.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiermill.plans.staging import discard, stage

from .common import Powers, cuts, mix, own_name, shingle_sets
from .links import components
from .ngram_join import commonness_in, full_sets, may_fit, prefixes, sizes_fit, verified

BANDS = 32
MANTISSA = 10  # bits kept behind the leading one; 6 bits hold the count of leading zeros
MARGIN = 0.2  # over five standard errors of the estimate at the threshold
MARKS = 4  # longs with a bit for each rare shingle of a set
BLOCK = 256  # shingles hashed at once, so the work stays in the processor's cache
LANES = " + ".join(f"cast((x ^ y) & {0xFFFF << s if s < 48 else -(1 << 48)}L = 0 as int)" for s in (0, 16, 32, 48))


@cache
def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of n hash functions."""
    seeds = np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(seeds[:n]) | np.uint64(1), mix(seeds[n:])


def registers(found: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """The compressed registers of a non-empty set, four to a long."""
    factors, addends = _constants(4 * bands)
    lowest = np.full(4 * bands, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        values = found[at : at + BLOCK, None] * factors
        values += addends
        np.minimum(lowest, values.min(0), out=lowest)
    length = np.array([int(v).bit_length() for v in lowest], np.int64)
    # bits behind the leading one, left-aligned
    shift = np.maximum(length - 1 - MANTISSA, 0).astype(np.uint64)
    kept = (lowest >> shift) & np.uint64((1 << MANTISSA) - 1)
    packed = ((np.minimum(64 - length, 63).astype(np.uint64) << np.uint64(MANTISSA)) | kept).astype("<u2")
    return packed.view("<i8")


def sketches(documents: DataFrame, k: int, bands: int = BANDS) -> DataFrame:
    """Per row: row (doc_id and text hash), digest of the set (null: empty set), n and bands; sets are not kept."""

    def work(batches):
        powers = Powers()
        for cut in cuts(batches):
            ids, texts, wholes = cut.columns
            digest, size, sig = [], [], []
            for found in shingle_sets(texts, k, powers):
                digest.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                size.append(len(found))
                sig.append(registers(found, bands) if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    wholes,
                    pa.array(digest, pa.binary()),
                    pa.array(size, pa.int64()),
                    pa.array(sig, pa.list_(pa.int64())),
                ],
                ["doc_id", "whole", "digest", "n", "bands"],
            )

    schema = "doc_id long, whole long, digest binary, n long, bands array<long>"
    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(work, schema)


def estimated(pairs: DataFrame, classes: DataFrame, percent: int, bands: int) -> DataFrame:
    """The pairs (a, b, more columns), with sizes, whose collision-corrected estimate comes within MARGIN of the threshold."""
    for key in "ab":
        pairs = pairs.join(classes.select(F.col("class").alias(key), F.col("n").alias(f"n_{key}"), F.col("bands").alias(f"bands_{key}")), key)
    pairs = pairs.where(sizes_fit("n_a", "n_b", percent))
    equal = F.expr(f"aggregate(zip_with(bands_a, bands_b, (x, y) -> {LANES}), 0, (t, v) -> t + v)") / (4.0 * bands)
    # Two different minima of n and m values agree in zeros and mantissa with this probability.
    collide = F.expr(f"{0.5 / math.log(2) / (1 << MANTISSA)!r}D * n_a * n_b / ((n_a + n_b) * double(n_a + n_b))")
    return pairs.where((equal - collide) / (1 - collide) >= percent / 100 - MARGIN).drop("bands_a", "bands_b")


def marks(tokens: np.ndarray) -> np.ndarray:
    """Bits named by the tokens; a bit that only one of two sets has stands for a token that only this one has."""
    out = np.zeros(MARKS, np.uint64)
    place = (tokens >> np.uint64(32)) % np.uint64(64 * MARKS)
    np.bitwise_or.at(out, (place // np.uint64(64)).astype(np.int64), np.uint64(1) << place % np.uint64(64))
    return out.view(np.int64)


def marks_fit(percent: int) -> Column:
    """Whether two sets (n, rare, marks; n_b, rare_b, marks_b) can be similar by the marks of their rare-first prefixes.

    Similar sets have ``least`` tokens in common, so either lacks at most n - least of the other's.  The prefix that ends
    first under the common order lies, as far as it is in common, in the other prefix too; so ``both`` is the least number
    of tokens both prefixes have, and each has at most rare - both others.
    """
    least = f"({percent} * (n + n_b) + {99 + percent}) div {100 + percent}"
    both = f"({least} + least(rare - n, rare_b - n_b))"
    lacks = " + ".join("bit_count(marks{0}[%d] & ~marks{1}[%d])" % (i, i) for i in range(MARKS))
    sides = ((("", "_b"), "rare"), (("_b", ""), "rare_b"))
    return F.expr(" and ".join(f"{lacks.format(*names)} + {both} <= {rare}" for names, rare in sides))


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(class, n, rare, marks, at, token): the rare-first prefix of every set (class, tokens), its size and marks.  Similar
    sets have a token of it in common."""
    sent = sets.sparkSession.sparkContext.broadcast(commonness_in(sets))

    def work(batches):
        for batch in batches:
            found, sets = batch.column(0).to_pylist(), batch.column(1)
            cut = [prefixes(s.values.to_numpy().view(np.uint64), sent.value, percent, 1)[0].view(np.int64) for s in sets]
            sizes, rare = [len(s) for s in sets], [len(c) for c in cut]
            marked = [marks(c.view(np.uint64)) for c in cut]
            long, longs = pa.int64(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in ((found, long), (sizes, long), (rare, long), (marked, longs), (cut, longs))],
                ["class", "n", "rare", "marks", "prefix"],
            )

    cut = sets.select("class", "tokens").mapInArrow(work, "class long, n long, rare long, marks array<long>, prefix array<long>")
    return cut.select("class", "n", "rare", "marks", F.posexplode("prefix").alias("at", "token"))


def linked(documents: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS) -> DataFrame:
    """Per row of ``documents``: doc_id, whole (hash of the text), n, component (null: no shingles) and component_id, the
    smallest doc_id of the component."""
    documents = documents.select("doc_id", "text")
    rows = stage(sketches(documents, k, bands), "sketches")
    grouped = rows.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "whole")).alias("one"), F.min("doc_id").alias("lowest"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = stage(grouped.select(F.monotonically_increasing_id().alias("class"), "*").select("*", "one.*").drop("one"), "classes")
    named = stage(rows.select("doc_id", "whole", "n", "digest"), "named")
    discard(rows)

    spread = classes.select("class", "n", F.posexplode("bands").alias("i", "band"))
    buckets = spread.select(F.xxhash64("i", "band").alias("bucket"), "class", "n")
    crowds = buckets.groupBy("bucket").agg(F.count("*").alias("members"), F.min("class").alias("p")).where("members > 1")
    crowded = stage(buckets.join(crowds, "bucket"), "crowded")
    weights = crowded.groupBy("class").agg(F.sum("members").alias("weight"))
    centres = crowded.join(weights, "class").groupBy("bucket").agg(F.max(F.struct("weight", "class", "n")).alias("q"))
    shared = stage(crowded.drop("members").join(centres, "bucket"), "shared")
    discard(crowded)
    label = classes.select("class", F.col("class").alias("component")).where("false")  # of linked classes, later

    def paired(pairs: DataFrame, one: str, two: str) -> DataFrame:
        """(a, b, hi, lo): the distinct pairs of class and other, and the components ``one`` and ``two`` of these."""
        sides = F.greatest("class", "other").alias("a"), F.least("class", "other").alias("b")
        return pairs.select(*sides, F.greatest(one, two).alias("hi"), F.least(one, two).alias("lo")).distinct()

    def link(pairs: DataFrame, name: str, known: DataFrame | None = None) -> bool:
        """Estimate and verify candidate pairs (a, b, hi, lo), on sets already made if ``known``, and join the components of
        similar ones in ``label``; whether there are any."""
        nonlocal label
        likely = stage(estimated(pairs, classes, percent, bands), f"{name}-likely")
        if likely.isEmpty():
            return False
        members = likely.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        sets = stage(full_sets(documents, classes.join(members, "class"), k), f"{name}-sets") if known is None else known
        links = stage(verified(likely, sets, percent), f"{name}-links")
        discard(sets, likely)
        if links.isEmpty():
            return False
        label = components(label.union(links.select("hi", "lo")).toDF("a", "b")).toDF("class", "component")
        return True

    def mixed() -> DataFrame:
        """The members, with their components, of the buckets that hold several components; also the component of the
        bucket's centre, and how many other members there are."""
        members = shared.join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
        centre = F.col("class") == F.col("q.class")
        still = members.groupBy("bucket").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.max(F.when(centre, F.col("component"))).alias("centre"), F.count_if(~centre).alias("rest")
        )
        return stage(members.join(still.where("lo <> hi").drop("lo", "hi"), "bucket"), "mixed")

    # Each class with the lowest member and the greatest centre of all its buckets: two pairs a class at most.
    ends = shared.groupBy("class").agg(F.min("p").alias("p"), F.max("q").getField("class").alias("q"))
    ends = ends.select("class", F.explode(F.array("p", "q")).alias("other")).where("class <> other")
    ends = stage(paired(ends, "class", "other"), "ends")
    link(ends, "ends")

    # In buckets that still hold several components: each class with the bucket's centre.
    left = mixed()
    pairs = left.where("class <> q.class and component <> centre").where(sizes_fit("n", "q.n", percent))
    pairs = paired(pairs.select("class", F.col("q.class").alias("other"), "component", "centre"), "component", "centre")
    if link(pairs.join(ends, ["a", "b"], "left_anti"), "centres"):
        left = mixed()

    # What is left: members of such buckets, none of them the centre, that share rare shingles early enough.
    rest = stage(left.where("class <> q.class and rest > 1").select("class", "component").distinct(), "rest")
    if not rest.isEmpty():
        sets = stage(full_sets(documents, classes.join(rest, "class"), k), "rest-sets")
        index = stage(rare_shingles(sets, percent).join(rest, "class"), "rare-shingles")
        lists = index.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
        index = index.join(lists.select("token"), "token")
        before = F.lag("token").over(Window.partitionBy("class").orderBy("at"))
        index = stage(index.select("class", "n", "rare", "marks", "at", "token", "component", before.alias("before")), "lists")
        other = index.select("token", *(F.col(c).alias(f"{c}_b") for c in index.columns if c != "token"))
        met = index.join(other, "token").where("class > class_b and component <> component_b").where(may_fit(percent) & marks_fit(percent))
        met = met.where("before <> before_b or before is null or before_b is null")  # a pair's first common token has no common one before
        met = met.select("class", F.col("class_b").alias("other"), "component", "component_b")
        link(paired(met, "component", "component_b"), "rest", sets)

    lowest = classes.select("class", "digest", "lowest").join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
    first = lowest.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_class = lowest.join(first, "component").select("digest", "component", "component_id")
    return named.join(of_class, "digest", "left").drop("digest")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id and kept.

    Two documents are linked when their sets of distinct k-word shingles (A-Z lower-cased) have at least ``percent``
    hundredths of their union in common.  ``component_id`` is the smallest doc_id reachable.  Null, empty and blank texts
    have no shingles and are linked with nothing.  Repeated rows are linked with each other; rows with a null id take
    part, and a component of such rows only has a null component_id and is kept.  Other columns are ignored.
    """
    out = linked(documents, k, percent, bands)
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(documents: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS) -> DataFrame:
    """``documents`` with one row of each component: the one with the smallest doc_id (null last), then text hash.

    Rows are told apart by doc_id and text, so null ids and ids that several texts share reject nothing but the copies
    themselves.  Rows without shingles stay.
    """
    found = linked(documents, k, percent, bands).where("component is not null")
    kinds = stage(found.groupBy("component", "doc_id", "whole").agg(F.count("*").alias("rows")), "kinds")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "whole")
    first = stage(kinds.groupBy("component").agg(F.min(place).alias("first")), "first")
    placed = kinds.join(first, "component").withColumn("stays", place.eqNullSafe(F.col("first")))
    id_, whole_, stays_, rows_ = (own_name(documents, c) for c in ("_id", "_whole", "_stays", "_rows"))
    placed = placed.select(F.col("doc_id").alias(id_), F.col("whole").alias(whole_), F.col("rows").alias(rows_), F.col("stays").alias(stays_))
    placed = stage(placed, "placed")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(whole_))
    rest = documents.join(placed.where(~F.col(stays_)), same, "left_anti")
    repeated = placed.where(F.col(stays_) & (F.col(rows_) > 1))
    if repeated.isEmpty():
        return rest
    return rest.join(repeated, same, "left_anti").union(rest.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
