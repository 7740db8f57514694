"""Conforming joins: lookups, bridges, roles, fallbacks, special members and source unions.

No broadcast hint is given anywhere: Spark broadcasts a side only below its own size limit, at planning time
from file statistics or at run time from shuffle sizes.  Beyond that limit both sides are shuffled, and every join
here keeps the shape adaptive skew join can split (see :func:`spread`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import as_col
from .dedup import drop_key_duplicates


@dataclass(frozen=True)
class Lookup:
    """A right side: ``on`` maps base columns to lookup columns, ``columns`` maps lookup columns to output names."""

    df: DataFrame
    on: Mapping[str, str]
    columns: Mapping[str, str]
    unique: bool = False


def _aliased(base: DataFrame, on: Mapping[str, str], right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [base[l] == right[f"__k_{r}"] for l, r in on.items()])


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    columns: Mapping[str, str] | Sequence[str],
    how: str = "left",
    unique: bool = True,
    salt: int = 1,
) -> DataFrame:
    """Add columns of ``dim`` to ``fact``.

    ``unique=False`` first keeps one deterministic row per key of ``dim``.  ``salt`` replicates a ``dim`` that is too
    large to broadcast and spreads every key of the fact over that many tasks; without it adaptive skew join splits
    hot keys.
    """
    on = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    columns = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    taken = sorted(set(fact.columns) & set(columns.values()))
    if taken:
        raise ValueError(f"the fact already has columns {taken}")
    keys = list(dict.fromkeys(on.values()))
    right = dim if unique else drop_key_duplicates(dim.select(*dict.fromkeys([*keys, *columns])), keys)
    right = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(c).alias(n) for c, n in columns.items()])
    out = [*fact.columns, *columns.values()]
    if salt > 1:
        fact = fact.withColumn("__salt", F.pmod(F.xxhash64(*[as_col(c) for c in fact.columns]), F.lit(salt)))
        right = right.withColumn("__k___salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salt)])))
        on["__salt"] = "__salt"
    elif not unique:
        fact, right = spread(fact, list(on)), spread(right, [f"__k_{k}" for k in keys], "__k___salt")
        on["__salt"] = "__salt"
    return fact.join(right, _aliased(fact, on, right), how).select(*[as_col(c) for c in out])


def spread(df: DataFrame, keys: Sequence[str], name: str = "__salt") -> DataFrame:
    """A constant join key that the optimiser cannot see through.

    A side that was just aggregated or de-duplicated by the join keys would be joined without a shuffle of its own,
    and adaptive skew join only splits joins with a shuffle on both sides.  With this extra key the (smaller)
    computed side is shuffled again and a hot key of the other side can be split.  A broadcast join is unaffected.
    """
    return df.withColumn(name, F.pmod(F.xxhash64(*[as_col(k) for k in keys]), F.lit(1)))


def conform(base: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join every source list to the base; each lookup contributes at most one row per base row."""
    return reduce(lambda df, l: enrich(df, l.df, l.on, l.columns, "left", l.unique), lookups, base)


def bridge_lookup(
    fact: DataFrame,
    bridge: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    bridge_columns: Mapping[str, str] | Sequence[str],
    active: Column | None = None,
    dim: DataFrame | None = None,
    dim_on: Mapping[str, str] | Sequence[str] | None = None,
    dim_columns: Mapping[str, str] | Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Reach ``dim`` through an association table.

    ``active`` filters the bridge before the join: with ``how="left"`` unmatched facts stay, with ``"inner"``
    they are dropped, which are the two readings a filter in ON or in WHERE has.
    """
    out = enrich(fact, bridge if active is None else bridge.filter(active), on, bridge_columns, how)
    return out if dim is None else enrich(out, dim, dim_on, dim_columns, how)


def active_bridge(bridge: DataFrame, kind: str = "Retail", status: str = "Active") -> DataFrame:
    return bridge.filter((F.col("AssociationType") == kind) & (F.col("AssociationStatus") == status))


def role_lookup(df: DataFrame, dim: DataFrame, roles: Mapping[str, str], key: str, value: str) -> DataFrame:
    """Join the same dimension once per role: ``roles`` maps id columns of ``df`` to output names."""
    return reduce(lambda d, r: enrich(d, dim, {r[0]: key}, {value: r[1]}, "left"), roles.items(), df)


def flag_present(df: DataFrame, other: DataFrame, on: Mapping[str, str] | Sequence[str], name: str) -> DataFrame:
    """1 when the key occurs in ``other``, else 0; row counts never change."""
    on = on if isinstance(on, Mapping) else {k: k for k in on}
    known = other.select(*dict.fromkeys(on.values())).distinct().withColumn("__hit", F.lit(1))
    right = known.select(*[F.col(c).alias(f"__k_{c}") for c in dict.fromkeys(on.values())], "__hit")
    left = spread(df, list(on))
    right = spread(right, [f"__k_{c}" for c in dict.fromkeys(on.values())], "__k___salt")
    joined = left.join(right, _aliased(left, {**on, "__salt": "__salt"}, right), "left")
    return joined.select(*[as_col(c) for c in df.columns], F.coalesce("__hit", F.lit(0)).alias(name))


def union_sources(*frames: DataFrame, distinct: bool = False) -> DataFrame:
    """Union by name; columns a source lacks become null."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.distinct() if distinct else out


def special_members(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Literal rows in the schema of ``df``; unnamed columns are null."""
    unknown = {k for r in rows for k in r} - set(df.columns)
    if unknown:
        raise ValueError(f"columns not in the dimension: {sorted(unknown)}")
    entries = [
        F.struct(*[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema]) for r in rows
    ]
    return df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def with_special_members(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    return df.unionByName(special_members(df, rows))


def split_sensitive(df: DataFrame, keys: Sequence[str], sensitive: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(profile, contact): the same rows, personal columns only in the second table."""
    profile = df.select(*[c for c in df.columns if c in keys or c not in sensitive])
    return profile, df.select(*keys, *[c for c in sensitive if c not in keys])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def project(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """Select into new names: output name to source column or expression."""
    return df.select(*[as_col(c).alias(n) for n, c in spec.items()])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


def sales_measures(
    df: DataFrame,
    quantity: str = "quantity",
    price: str = "price",
    cost: str = "cost",
    amount: str = "saleamount",
    profit: str = "rawgrossprofit",
) -> DataFrame:
    q, p, c = F.col(quantity), F.col(price), F.col(cost)
    return df.withColumns({amount: q * p, profit: q * p - q * c})
