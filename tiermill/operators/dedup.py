"""Keep-latest and duplicate removal.

``row_number() = 1`` is planned by Spark with a map-side WindowGroupLimit: every task keeps one row per
key before the shuffle, so a key that owns a large share of the table sends at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNORDERABLE = ("map", "variant")


def _newest_first(c: Column | str) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    ties: str = "one",
) -> DataFrame:
    """Newest row per key.

    ``order_by`` names sort descending (nulls last); Columns are used as given.  ``ties="one"`` breaks ties
    by the remaining columns, so the survivor does not depend on partitioning.  ``ties="all"`` keeps every
    row that shares the maximum of a single order column.
    """
    if ties == "all":
        (order,) = order_by
        if not isinstance(order, str):
            raise TypeError("ties='all' takes the name of one order column")
        top = df.groupBy(*keys).agg(F.max(order).alias("__top"))
        top = top.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__top")
        cond = F.col(order).eqNullSafe(F.col("__top"))
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return df.join(top, cond, "left_semi")
    if ties != "one":
        raise ValueError(f"ties must be 'one' or 'all', not {ties!r}")
    used = set(keys) | {c for c in order_by if isinstance(c, str)}
    rest = [
        F.col(n).asc_nulls_last() for n, t in df.dtypes if n not in used and not t.startswith(UNORDERABLE)
    ]
    window = Window.partitionBy(*keys).orderBy(*[_newest_first(c) for c in order_by], *rest)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") == 1).drop("__rn")


def drop_key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One deterministic row per key: the smallest by the remaining columns."""
    return keep_latest(df, keys, [])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
