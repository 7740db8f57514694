"""Row rules, the good/quarantine split and the error summary.

A rule is a boolean Column that is true for a valid row.  All rules of a dataset are evaluated in the
same projection, so validation never shuffles and never drops duplicate good rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import as_col
from ..staging import stage

US_FORMAT = "M/d/yyyy"
DATE_FORMATS = (US_FORMAT, "M-d-yyyy", "yyyy-M-d", "yyyy/M/d", "M/d/yy", "M-d-yy")  # of report text, before any time of day
YEARS = (1900, 2099)  # dates outside are typing errors


def numeric(c: Column | str) -> Column:
    """Digits only.  Null passes: absence is the business of :func:`required`."""
    return F.coalesce(~as_col(c).cast("string").rlike("[^0-9]"), F.lit(True))


def us_date(c: Column | str, optional: bool = False) -> Column:
    """``MM/dd/yyyy`` text of a real day, leading zeros optional; null fails unless ``optional``."""
    text = as_col(c).cast("string")
    return F.when(text.isNull(), F.lit(optional)).otherwise(_real_day(text, [US_FORMAT]))


def date_like(c: Column | str) -> Column:
    """Text that begins with a date in one of DATE_FORMATS, a time of day behind it or not; null fails."""
    return _real_day(F.split_part(F.replace(F.trim(as_col(c).cast("string")), F.lit("T"), F.lit(" ")), F.lit(" "), F.lit(1)), DATE_FORMATS)


def _real_day(text: Column, formats: Sequence[str]) -> Column:
    day = F.coalesce(*[F.try_to_date(text, f) for f in formats])
    return F.coalesce(F.year(day).between(*YEARS), F.lit(False))


def required(*cols: Column | str) -> Column:
    return reduce(lambda a, b: a & b, [as_col(c).isNotNull() for c in cols])


def not_blank(c: Column | str) -> Column:
    return F.coalesce(F.trim(as_col(c).cast("string")) != "", F.lit(False))


def not_like(c: Column | str, patterns: Sequence[str], keep_nulls: bool = False) -> Column:
    """None of the LIKE patterns match.  A null value is rejected unless ``keep_nulls``."""
    hit = reduce(lambda a, b: a | b, [as_col(c).like(p) for p in patterns])
    return F.coalesce(~hit, F.lit(keep_nulls))


def drop_noise(df: DataFrame, c: Column | str, patterns: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """Remove report titles, instructions, footers and repeated headers."""
    return df.filter(not_like(c, patterns, keep_nulls))


def _passes(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def tag_failures(df: DataFrame, rules: Mapping[str, Column], name: str = "failed_rules") -> DataFrame:
    """Add the array of names of the rules a row breaks (empty for a good row)."""
    return df.withColumn(
        name, F.array_compact(F.array(*[F.when(~_passes(r), F.lit(n)) for n, r in rules.items()]))
    )


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): good rows keep their schema and duplicates, bad rows carry ``failed_rules``."""
    good = df.filter(reduce(lambda a, b: a & b, [_passes(r) for r in rules.values()]))
    bad = tag_failures(df, rules).filter(F.size("failed_rules") > 0)
    return good, bad


def split_stored(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad) as ``split_valid`` gives them, from one scan: rows are tagged once and written by verdict into folders of
    the shared store, and each side reads its own."""
    tagged = tag_failures(df, rules).withColumn("__ok", F.size("failed_rules") == 0)
    stored = stage(tagged, "split", partition_by="__ok")
    good = stored.where(F.col("__ok")).drop("__ok", "failed_rules")
    return good, stored.where(~F.col("__ok")).drop("__ok")


def quarantine(bad: DataFrame, root: str, dataset: str, run_id: str) -> None:
    """Write rejected rows as header CSV to ``root/<dataset>/run=<id>``; rule names are joined by ``|``.

    A run that is started again replaces its own rows and leaves those of other runs.
    """
    rows = bad.withColumns({"failed_rules": F.concat_ws("|", "failed_rules"), "run_id": F.lit(run_id)})
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{root.rstrip('/')}/{dataset}/run={run_id}")


def quarantine_files(verdicts: DataFrame, root: str, dataset: str, run_id: str) -> None:
    """Write the rejected files of a verdict table (``path, file_name, reasons, ok``) as JSON below ``root``, by run."""
    rejected = verdicts.filter(~F.col("ok")).drop("ok").withColumn("run_id", F.lit(run_id))
    rejected.write.mode("overwrite").json(f"{root.rstrip('/')}/{dataset}_files/run={run_id}")


def error_summary(errors: DataFrame) -> DataFrame:
    """Rows per dataset and rule plus the newest run.

    Expects ``dataset``, ``failed_rules`` (array) and ``run_id``; partial aggregation keeps hot rules cheap.
    """
    return (
        errors.select("dataset", F.explode("failed_rules").alias("rule"), "run_id")
        .groupBy("dataset", "rule")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("run_id").alias("last_run_id"))
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Null defaults by column; the column keeps its type."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()})
