"""Fixed-depth level hierarchies and their manager ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .conforming import role_lookup

SEPARATOR = "|"


@dataclass(frozen=True)
class LevelSource:
    df: DataFrame
    name: str
    levels: Sequence[str]


def hierarchy_id(levels: Sequence[str], sep: str = SEPARATOR) -> Column:
    """Composite id of the level values; null when any level is missing, so ids never collide across levels."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in levels])
    return F.when(complete, F.concat_ws(sep, *[F.col(c) for c in levels]))


def with_hierarchy_id(df: DataFrame, levels: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, hierarchy_id(levels))


def level_hierarchy(sources: Sequence[LevelSource], depth: int = 6) -> DataFrame:
    """Distinct level paths of all sources as ``hier_id, hier_nm, lvl_<i>_cd, lvl_<i>_nm``; unused levels are ''.

    There are ``depth`` pairs of level columns, or more when a source has more levels.  The narrow level tuples are de-duplicated first (map-side combine), the wide rows are built afterwards.
    """
    depth = max(depth, *(len(s.levels) for s in sources))
    narrow = []
    for s in sources:
        filled = reduce(lambda a, b: a & b, [F.coalesce(F.col(c) != "", F.lit(False)) for c in s.levels])
        cols = [F.col(c).cast("string") for c in s.levels] + [F.lit("")] * (depth - len(s.levels))
        narrow.append(
            s.df.filter(filled).select(
                hierarchy_id(s.levels).alias("hier_id"),
                F.lit(s.name).alias("hier_nm"),
                *[c.alias(f"__l{i}") for i, c in enumerate(cols, 1)],
            )
        )
    rows = reduce(DataFrame.unionByName, narrow).distinct()
    levels = [F.col(f"__l{i}").alias(f"lvl_{i}_{k}") for i in range(1, depth + 1) for k in ("cd", "nm")]
    return rows.select("hier_id", "hier_nm", *levels)


def manager_hierarchy(
    df: DataFrame,
    levels: Sequence[str],
    roles: Sequence[str],
    employees: DataFrame,
    external_id: str = "workdayid",
    internal_id: str = "sourceemployeeid",
    depth: int = 6,
) -> DataFrame:
    """Hierarchy id and the internal id of the manager of each level.

    ``roles`` are the columns of ``df`` with external manager ids, in level order.
    """
    out: Mapping[str, str] = {r: f"lvl_{i}_src_mgr_id" for i, r in enumerate(roles, 1)}
    paths = df.select(hierarchy_id(levels).alias("hier_id"), *roles).filter(F.col("hier_id").isNotNull()).distinct()
    known = employees.filter(F.col(external_id) != "").select(external_id, internal_id)
    named = role_lookup(paths, known, out, external_id, internal_id)
    blanks = [F.lit("").alias(f"lvl_{i}_src_mgr_id") for i in range(len(roles) + 1, depth + 1)]
    return named.select("hier_id", *out.values(), *blanks).distinct()
