"""Snapshot change data capture.

``classify_changes`` compares two snapshots with one null-safe full outer join instead of one join per class.
Classes: ``N`` new, ``C`` changed, ``U`` unchanged and, when asked for, ``D`` deleted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .conforming import spread
from .dedup import keep_latest


def row_fingerprint(cols: Sequence[str]) -> Column:
    """256-bit hash of a row that keeps null positions apart."""
    row = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    return F.sha2(row, 256)


def _same_key(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def classify_changes(
    prev: DataFrame | None,
    curr: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | None = None,
    deletes: bool = False,
    unique_keys: bool = True,
) -> DataFrame:
    """``curr`` (plus deleted ``prev`` rows when asked) with a ``change`` column.

    ``cols`` are the compared columns, by default every non-key column.  With ``unique_keys`` each key holds one
    row per snapshot, which is what :func:`keep_latest` guarantees.  Without it a row is unchanged when an equal
    row exists in ``prev`` and changed when only its key does; duplicates of a key never form pairs.
    """
    keys = list(keys)
    cols = [c for c in curr.columns if c not in keys] if cols is None else list(cols)
    if prev is None:
        return curr.withColumn("change", F.lit("N"))
    if not unique_keys:
        return _classify_multiset(prev, curr, keys, cols, deletes)
    out = curr.columns
    c = curr.withColumn("__in", F.lit(True)).alias("c")
    p = prev.select(*keys, *[x for x in out if x not in keys and x in prev.columns]).withColumn("__in", F.lit(True))
    p = p.alias("p")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"c.{x}").eqNullSafe(F.col(f"p.{x}")) for x in cols],
        F.lit(True),
    )
    change = (
        F.when(F.col("p.__in").isNull(), F.lit("N"))
        .when(F.col("c.__in").isNull(), F.lit("D"))
        .when(same, F.lit("U"))
        .otherwise(F.lit("C"))
    )
    joined = c.join(p, _same_key(keys, "c", "p"), "full_outer" if deletes else "left_outer")
    gone = F.col("c.__in").isNull()
    pick = []
    for x in out:
        col = F.col(f"c.{x}")
        if deletes and x in p.columns:
            col = F.when(gone, F.col(f"p.{x}")).otherwise(col)
        pick.append(col.alias(x))
    return joined.select(*pick, change.alias("change"))


def _mark(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add a boolean: does the null-safe key occur in ``other``?  Rows of ``df`` are neither lost nor multiplied."""
    left = spread(df, keys).alias("c")
    right = spread(other.select(*keys).distinct().withColumn("__hit", F.lit(True)), keys).alias("p")
    joined = left.join(right, _same_key([*keys, "__salt"], "c", "p"), "left_outer")
    return joined.select(*[F.col(f"c.{x}") for x in df.columns], F.coalesce("p.__hit", F.lit(False)).alias(name))


COPIES = 10_000  # copies of a row made from one entry


def _compared(prev: DataFrame, curr: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each distinct row of the two snapshots, which have the same columns: ``__now`` and ``__then``, how often it occurs in
    either, and ``__known`` and ``__still``, whether its key does.

    Rows are counted in one grouped pass over the tagged union, nulls equal to nulls, before anything is compared, so copies
    never meet.  What a key needs to know is combined from those counts, and comes back in a join whose hot keys adaptive
    execution splits: a window would save its shuffle but hold all rows of a key in one task.
    """
    cols = curr.columns
    both = curr.withColumn("__c", F.lit(1)).unionByName(prev.select(*cols).withColumn("__c", F.lit(0)))
    counted = both.groupBy(*cols).agg(F.sum("__c").alias("__now"), F.sum(1 - F.col("__c")).alias("__then"))
    # One column needs both counts, so Spark finds the same shuffle of counts under it and reuses it.
    where = F.bit_or((F.col("__then") > 0).cast("int") + (F.col("__now") > 0).cast("int") * 2)
    of_key = counted.groupBy(*keys).agg(where.alias("__in")).alias("p")
    joined = counted.alias("c").join(of_key, _same_key(keys, "c", "p"))
    flags = (F.col("p.__in").bitwiseAND(bit) > 0 for bit in (1, 2))
    out = joined.select(*[F.col(f"c.{x}") for x in [*cols, "__now", "__then"]], *(v.alias(n) for v, n in zip(flags, ("__known", "__still"), strict=True)))
    return out.select(*[F.col(x).cast(curr.schema[x].dataType).alias(x) for x in cols], "__now", "__then", "__known", "__still")


def _copies(df: DataFrame, n: str) -> DataFrame:
    """Each row ``n`` times, by two steps, so that no array holds more than COPIES entries for a billion copies' worth."""
    parts = F.explode(F.sequence(F.lit(0), F.expr(f"({n} - 1) div {COPIES}"))).alias("__part")
    split = df.where(F.col(n) > 0).select("*", parts)
    many = F.least(F.lit(COPIES).cast("long"), F.col(n) - F.col("__part") * COPIES)
    return split.select("*", F.explode(F.sequence(F.lit(1).cast("long"), many)).alias("__copy")).drop("__part", "__copy")


def _classify_multiset(prev, curr, keys, cols, deletes) -> DataFrame:
    """Existence of the whole row and of the key in ``prev``."""
    if set(curr.columns) != {*keys, *cols}:  # columns that are carried along but not compared
        marked = _mark(_mark(curr, prev, [*keys, *cols], "__same"), prev, keys, "__known")
        change = F.when(F.col("__same"), "U").when(F.col("__known"), "C").otherwise("N")
        out = marked.select(*curr.columns, change.alias("change"))
        if deletes:
            gone = prev.alias("c").join(curr.alias("p"), _same_key(keys, "c", "p"), "left_anti")
            out = out.unionByName(gone.select(*curr.columns).withColumn("change", F.lit("D")))
        return out
    rows = _compared(prev, curr, keys)
    gone = F.col("__now") == 0
    if deletes:
        rows = rows.where(~gone | ~F.col("__still")).withColumn("__now", F.when(gone, F.col("__then")).otherwise(F.col("__now")))
        change = F.when(~F.col("__still"), "D").when(F.col("__then") > 0, "U")
    else:
        rows, change = rows.where(~gone), F.when(F.col("__then") > 0, "U")
    change = change.when(F.col("__known"), "C").otherwise("N")
    return _copies(rows, "__now").select(*curr.columns, change.alias("change"))


def change_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("change").agg(F.count(F.lit(1)).alias("n_rows"))


def delta(
    prev: DataFrame | None,
    curr: DataFrame,
    keys: Sequence[str],
    method: str = "fingerprint",
    deletes: bool = False,
    flag: str = "cdc_ind_cd",
) -> DataFrame:
    """Rows to deliver with an I/C (or D) flag; a first load delivers everything as I.

    ``fingerprint`` compares row by row on the key.  ``except`` is a set difference of whole rows, which also
    removes duplicates of the delivered rows, followed by a lookup of the key in ``prev``.
    """
    if prev is None:
        return curr.withColumn(flag, F.lit("I"))
    if method == "except":
        if deletes:
            raise ValueError("deletes need method='fingerprint'")
        new = _compared(prev, curr, list(keys)).where("__now > 0 and __then = 0")
        return new.select(*curr.columns, F.when(F.col("__known"), "C").otherwise("I").alias(flag))
    if method != "fingerprint":
        raise ValueError(f"method must be 'fingerprint' or 'except', not {method!r}")
    changes = classify_changes(prev, curr, keys, deletes=deletes).filter(F.col("change") != "U")
    mark = F.when(F.col("change") == "N", F.lit("I")).otherwise(F.col("change"))
    return changes.withColumn(flag, mark).drop("change")


def upsert(
    prev: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    prev_unique: bool = True,
) -> DataFrame:
    """Full history after an incremental feed: the newest row per key wins.

    A history written by earlier runs holds one row per key, so rows whose key is not in the feed pass through: with
    a small feed its keys are broadcast and the history is not shuffled.  ``prev_unique=False`` ranks all rows.
    """
    if prev is None:
        return keep_latest(incoming, keys, order_by)
    if not prev_unique:
        return keep_latest(prev.unionByName(incoming, allowMissingColumns=True), keys, order_by)
    p, i = prev.alias("c"), incoming.select(*keys).alias("p")
    equal_key = _same_key(list(keys), "c", "p")
    touched = p.join(i, equal_key, "left_semi").unionByName(incoming, allowMissingColumns=True)
    untouched = p.join(i, equal_key, "left_anti")
    return untouched.unionByName(keep_latest(touched, keys, order_by), allowMissingColumns=True)
