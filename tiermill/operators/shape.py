"""Reshaping: wide to long, delimited lists to rows, one row to several role rows.  No step here shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import as_col, recode


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str] | None = None,
    *,
    name_col: str = "measure",
    value_col: str = "value",
    value_type: str | None = None,
    null_value: object | None = None,
    name_parts: Sequence[str] | None = None,
    sep: str = "_",
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Wide to long.

    ``measures`` defaults to every non-id column, cast to ``value_type`` (text when their types differ).
    ``null_value`` replaces missing values, ``names`` maps cleaned column names back to display names and
    ``name_parts`` splits the measure name on ``sep`` into columns that replace ``name_col``.
    """
    if measures is None:
        measures = [c for c in df.columns if c not in ids]
    types = dict(df.dtypes)
    if value_type is None:
        kinds = {types[m] for m in measures}
        value_type = kinds.pop() if len(kinds) == 1 else "string"
    wide = df.select(*[as_col(i) for i in ids], *[as_col(m).cast(value_type).alias(m) for m in measures])
    long = wide.unpivot([as_col(i) for i in ids], [as_col(m) for m in measures], name_col, value_col)
    if null_value is not None:
        long = long.withColumn(value_col, F.coalesce(as_col(value_col), F.lit(null_value).cast(value_type)))
    if names:
        long = long.withColumn(name_col, recode(name_col, names))
    if name_parts:
        parts = {p: F.split_part(as_col(name_col), F.lit(sep), F.lit(i)) for i, p in enumerate(name_parts, 1)}
        long = long.withColumns(parts)
        if name_col not in name_parts:
            long = long.drop(name_col)
    return long


def explode_list(
    df: DataFrame,
    col: str,
    *,
    sep: str = ",",
    primary: str | None = None,
    unknown: int | None = None,
    key_pattern: str = r"-?\d+",
    out: str = "element",
    flag: str = "is_primary",
) -> DataFrame:
    """Delimited list of ``"<number> <name>"`` items to one row per number.

    ``primary`` names a column with one more item, which joins the list and is flagged 1.  A row without a
    primary item yields the single element ``unknown``, flagged 1.  Repeated numbers of a row appear once.  A number
    that does not fit an int fails the job; :func:`list_fits` finds such rows before.
    """

    def key(item: Column) -> Column:
        token = _number(item, key_pattern)
        too_large = F.raise_error(F.concat(F.lit("list item does not fit an int: "), token)).cast("int")
        return F.when(token != "", F.coalesce(token.try_cast("int"), too_large))

    empty = F.array().cast("array<string>")
    items = F.coalesce(F.split(as_col(col), r"\Q" + sep + r"\E"), empty)
    if primary is None:
        numbers = F.array_compact(F.array_distinct(F.transform(items, key)))
        return df.withColumn(out, F.explode(numbers))
    items = F.concat(items, F.array(as_col(primary)))
    numbers = F.array_compact(F.array_distinct(F.transform(items, key)))
    if unknown is not None:
        numbers = F.when(as_col(primary).isNull(), F.array(F.lit(unknown))).otherwise(numbers)
    is_primary = F.coalesce(F.col(out) == key(as_col(primary)), F.lit(False))
    if unknown is not None:
        is_primary = is_primary | (F.col(out) == F.lit(unknown))
    return df.withColumn(out, F.explode(numbers)).withColumn(flag, is_primary.cast("int"))


def _number(item: Column, key_pattern: str) -> Column:
    return F.regexp_extract(F.get(F.split(F.trim(item), " "), F.lit(0)), key_pattern, 0)


def list_fits(col: str, *, sep: str = ",", key_pattern: str = r"-?\d+") -> Column:
    """Rule that every number of a delimited list fits an int; empty lists and items without a number do."""
    fits = F.forall(
        F.split(as_col(col), r"\Q" + sep + r"\E"),
        lambda item: (_number(item, key_pattern) == "") | _number(item, key_pattern).try_cast("int").isNotNull(),
    )
    return F.coalesce(fits, F.lit(True))


def expand_roles(df: DataFrame, keep: Sequence[str], roles: Sequence[tuple[Column, Mapping[str, Column]]]) -> DataFrame:
    """One output row per role whose condition holds; a single pass over the input."""
    structs = [
        F.when(cond, F.struct(*[c.alias(n) for n, c in values.items()])) for cond, values in roles
    ]
    exploded = df.select(*[as_col(k) for k in keep], F.explode(F.array_compact(F.array(*structs))).alias("__r"))
    return exploded.select(*[as_col(k) for k in keep], "__r.*")
