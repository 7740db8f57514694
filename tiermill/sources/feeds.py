"""Reading messy report files with the built-in CSV source.

Header lines are metadata: at most a handful of lines of each file reach the driver.  Rows never do.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import as_col
from ..operators.quality import drop_noise
from .files import file_heads

# Reader options every feed starts from.
CSV_OPTIONS = {
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "quote": '"',
    "escape": '"',
}


@dataclass(frozen=True)
class FeedSpec:
    """How one feed is read.

    ``schema`` declares types (DDL or StructType); without it all columns are text unless ``infer`` is set.
    ``columns`` renames source columns, ``noise`` lists LIKE patterns to drop per (source) column,
    ``not_blank`` names columns that must be filled.  ``file_date`` is (pattern with one group, date format)
    for a report date carried by the file name.  ``landed_at`` adds the modification time of each row's file.
    """

    name: str
    schema: str | T.StructType | None = None
    header: bool = True
    multiline: bool = False
    infer: bool = False
    columns: Mapping[str, str] = field(default_factory=dict)
    noise: Mapping[str, Sequence[str]] = field(default_factory=dict)
    keep_null_noise: bool = False
    not_blank: Sequence[str] = ()
    file_date: tuple[str, ...] | None = None
    landed_at: bool = False
    options: Mapping[str, str] = field(default_factory=dict)


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_csv(spark: SparkSession, paths: str | Sequence[str], spec: FeedSpec) -> DataFrame:
    """One scan over all files of a feed: read, drop noise rows, date from the file name, rename."""
    reader = spark.read.options(**CSV_OPTIONS).option("header", spec.header).option("multiLine", spec.multiline)
    if spec.schema is not None:
        # Columns are bound by position: report headers drift (month names) while their order does not.
        reader = reader.schema(spec.schema).option("enforceSchema", "true")
    elif spec.infer:
        reader = reader.option("inferSchema", "true")
    df = reader.options(**spec.options).csv(paths)
    if spec.file_date is not None:
        df = with_file_date(df, *spec.file_date)
    if spec.landed_at:
        df = df.withColumn("landed_at", F.col("_metadata.file_modification_time"))
    return tidy(df, spec)


def tidy(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """The row and column clean-up of a feed, shared by batch and stream."""
    for column, patterns in spec.noise.items():
        df = drop_noise(df, column, patterns, spec.keep_null_noise)
    for column in spec.not_blank:
        df = df.filter(F.trim(as_col(column)) != "")
    return df.withColumnsRenamed(dict(spec.columns))


def with_file_date(
    df: DataFrame, pattern: str, date_format: str, name: str = "reportdate", source: str = "file_name"
) -> DataFrame:
    """Date found in the name (or ``file_path``) of the file a row came from; null when it carries none."""
    text = F.regexp_extract(f"_metadata.{source}", pattern, 1)
    return df.withColumn(name, F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit(date_format)).cast("date"))


def with_run_date(df: DataFrame, run_date: str, name: str = "reportdate") -> DataFrame:
    return df.withColumn(name, F.lit(run_date).cast("date"))


def first_lines(spark: SparkSession, path: str, n: int) -> list[list[str]]:
    """The first ``n`` lines of one file, split into cells."""
    rows = spark.read.text(path).limit(n).collect()
    return list(csv.reader([r[0] for r in rows]))


def header_at(spark: SparkSession, path: str, line: int = 0) -> list[str]:
    """Cells of header line ``line`` (0-based) of one file."""
    lines = first_lines(spark, path, line + 1)
    if len(lines) <= line:
        raise ValueError(f"{path} has no line {line}")
    return lines[line]


def merged_header(
    spark: SparkSession, path: str, sep: str = "|", bottom_only: Sequence[int] = (0,)
) -> list[str]:
    """The two header lines of one file, joined by :func:`merged_cells`."""
    top, bottom = first_lines(spark, path, 2)
    return merged_cells(top, bottom, sep, bottom_only)


def merged_cells(
    top: Sequence[str], bottom: Sequence[str], sep: str = "|", bottom_only: Sequence[int] = (0,)
) -> list[str]:
    """Two header lines joined per column as ``top|bottom``; columns without a top cell keep the bottom cell."""
    width = max(len(top), len(bottom))
    pad = lambda cells: [c.strip() for c in cells] + [""] * (width - len(cells))
    return [
        b if i in bottom_only else sep.join((t, b)).lstrip(sep)
        for i, (t, b) in enumerate(zip(pad(top), pad(bottom), strict=True))
    ]


def clean_names(
    names: Sequence[str],
    replace: Mapping[str, str] | None = None,
    lower: bool = False,
    ascii_only: bool = True,
    drop_empty: bool = True,
) -> list[str]:
    """Strip header cells, apply literal replacements, drop non-ASCII characters and empty cells."""
    out = []
    for name in names:
        name = name.strip().strip("\r")
        if ascii_only:
            name = name.encode("ascii", "ignore").decode()
        for old, new in (replace or {}).items():
            name = name.replace(old, new)
        name = name.lower() if lower else name
        if name or not drop_empty:
            out.append(name)
    return out


def read_report(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str],
    head: Sequence[Sequence[str]],
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A report whose header is not in the first line; all cells are text.

    ``head`` are the title and header lines (:func:`first_lines`).  They are dropped wherever they occur, so repeated
    headers disappear too, and so do blank lines.  The match is on content and works on split files.
    """
    reader = spark.read.options(**CSV_OPTIONS).options(**(options or {})).schema(text_schema(names))
    df = reader.option("header", False).csv(path)
    mark, width = "\u0001", len(names)
    joined = F.concat_ws(mark, *[F.coalesce(F.trim(as_col(n)), F.lit("")) for n in names])
    drop = {mark * (width - 1)} | {
        mark.join([c.strip() for c in [*cells, *[""] * width][:width]]) for cells in head
    }
    return df.filter(~joined.isin(sorted(drop)))


def read_reports(
    spark: SparkSession,
    paths: Sequence[str],
    lines: int,
    names: Callable[[list[list[str]]], Sequence[str]],
    *,
    file_date: tuple[str, ...] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Reports of which every file has a header of its own: columns are bound by name, never by place.

    ``names`` gives the column names for the cells of a file's first ``lines`` lines.  Files with the same names are one
    scan; the scans are united by name, and a column a layout lacks is null in its rows.  ``file_date`` is that of
    :class:`FeedSpec`.  A file with fewer lines raises ValueError; ``validate_files`` finds such files before.
    """
    if not paths:
        raise ValueError("no files to read")
    groups: dict[tuple[str, ...], tuple[list[str], set[tuple[str, ...]]]] = {}
    for r in file_heads(spark, paths, lines).orderBy("path").toLocalIterator():
        head = list(csv.reader(r.lines))
        if len(head) < lines:
            raise ValueError(f"{r.path} has no line {lines - 1}")
        of_layout, heads = groups.setdefault(tuple(names(head)), ([], set()))
        of_layout.append(r.path)
        heads.update(map(tuple, head))
    parts = []
    for layout, (of_layout, heads) in groups.items():
        part = read_report(spark, of_layout, layout, sorted(heads), options)
        parts.append(part if file_date is None else with_file_date(part, *file_date))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def is_empty_feed(df: DataFrame, minimum: int = 1) -> bool:
    """True when the feed holds fewer than ``minimum`` rows; looks at ``minimum`` rows only."""
    return df.limit(minimum).count() < minimum


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return literal_table(spark, [], schema)


def literal_table(spark: SparkSession, rows: Sequence[Sequence[object]], schema: str | T.StructType) -> DataFrame:
    """A small configuration table as literals of the plan: one task, nothing shipped from Python."""
    fields = _struct(schema).fields

    def entry(row: Sequence[object]) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)])

    if not rows:
        return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*[entry(r) for r in rows])))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text to typed columns; what does not parse becomes null."""
    return df.withColumns({c: as_col(c).try_cast(t) for c, t in types.items()})


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return as_col(name) if name in df.columns else F.lit(None).cast(dtype)
