"""Deliveries, SQL registration and other outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.conforming import project
from ..staging import stage


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", quote_all: bool = False, single_file: bool = False
) -> None:
    """Header CSV.  Every part file repeats the header; ``single_file`` is for small deltas only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


def deliver(
    df: DataFrame,
    path: str,
    columns: Mapping[str, str | Column] | None = None,
    *,
    quote_all: bool = False,
    single_file: bool = False,
    keep_log: bool = True,
    run_id: str | None = None,
) -> None:
    """Overwrite ``path/Current`` and add the same rows to the log below ``path/Previous``.

    With ``run_id`` the rows are the log's folder of that run, which a repeated run replaces; without, they are appended.

    ``columns`` maps delivery names to source columns.  The delta is computed once and staged; without rows the
    current delivery is a header only and the log stays as it is.
    """
    out = df if columns is None else project(df, columns)
    if not keep_log:
        return write_csv(out, f"{path}/Current", "overwrite", quote_all, single_file)
    staged = stage(out, "delivery")
    write_csv(staged, f"{path}/Current", "overwrite", quote_all, single_file)
    if run_id is not None:
        write_csv(staged, f"{path}/Previous/run_id={run_id}", "overwrite", quote_all, single_file)
    elif not staged.isEmpty():
        write_csv(staged, f"{path}/Previous", "append", quote_all, single_file)


def read_delivery(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(path)


def register_tables(spark: SparkSession, datasets: Mapping[str, str], database: str | None = None) -> None:
    """Make parquet folders available to SQL; the schema is read from the files."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in datasets.items():
        table = f"`{database}`.`{name}`" if database else f"`{name}`"
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{location}'")
        spark.sql(f"REFRESH TABLE {table}")
