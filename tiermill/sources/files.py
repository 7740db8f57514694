"""File-level checks, inventory and routing of landed files.

Listings use the binaryFile source without its content column, so no file body is read.  Header checks read the first
block of each file.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import stage

HEAD_BYTES = 1 << 16  # read at once from the start of a file
# A comma outside double quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, file_name, size, modified`` of every file below ``path``; Spark's file sources skip empty files."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return df.select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def folder_exists(spark: SparkSession, path: str) -> bool:
    """False for a feed that nothing has landed for."""
    try:
        list_files(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def header_cells(line: Column) -> Column:
    """Cells of a CSV header line as an array."""
    return F.transform(F.split(line, _COMMA), lambda c: F.trim(F.regexp_replace(F.trim(c), '^"|"$', "")))


def _open(path: str):
    """A stream of the decompressed bytes of one file."""
    scheme, colon, rest = path.partition(":/")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_stream(("/" + rest.lstrip("/")) if colon else path)
    system, name = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}:/{quote(rest)}")
    return system.open_input_stream(name)


def _first_lines(path: str, n: int) -> list[str] | None:
    """The first ``n`` lines, or None where this process has no access to the store."""
    try:
        with _open(path) as stream:
            found = b""
            # One line more than asked for: a line is complete when the next one has begun.
            while len(found.splitlines()) <= n and (block := stream.read(HEAD_BYTES)):
                found += block
    except (OSError, ValueError, NotImplementedError, pa.ArrowException):
        return None
    return [line.decode("utf-8", "replace") for line in found.removeprefix(b"\xef\xbb\xbf").splitlines()[:n]]


def _scanned_lines(spark: SparkSession, paths: Sequence[str], n: int) -> DataFrame:
    """``path, lines`` by Spark's own text scan, which reads whole files.

    Lines of a file's first split arrive in file order; the row limit per file is applied map-side.
    """
    lines = (
        spark.read.text(list(paths))
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
        .filter(F.col("at") == 0)
        .withColumn("n", F.monotonically_increasing_id())
    )
    rank = F.row_number().over(Window.partitionBy("path").orderBy("n"))
    head = lines.withColumn("rn", rank).filter(F.col("rn") <= n).groupBy("path")
    kept = head.agg(F.array_sort(F.collect_list(F.struct("rn", "value"))).alias("lines"))
    return kept.select("path", F.col("lines.value").alias("lines"))


def file_heads(spark: SparkSession, path: str | Sequence[str] | DataFrame, n: int = 1) -> DataFrame:
    """``path, lines``: the first ``n`` lines (fewer in a shorter file) of every file, without reading the rest.

    ``path`` is a folder, several, or a listing as ``list_files`` gives it.  Tasks open their files at the start and stop
    after the last line wanted, so bytes read do not grow with the files.  Files in a store that only Spark can open are
    scanned by Spark.
    """
    listed = path if isinstance(path, DataFrame) else list_files(spark, path)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                lines = pa.array([_first_lines(name, n)], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array([name]), lines], ["path", "lines"])

    # A fixed number of tasks: a listing is a few bytes a file, which adaptive execution would put into one.
    spread = listed.select("path").repartition(spark.sparkContext.defaultParallelism, "path")
    heads = stage(spread.mapInArrow(work, "path string, lines array<string>"), "heads")
    unread = [r.path for r in heads.filter(F.col("lines").isNull()).select("path").toLocalIterator()]
    if not unread:
        return heads
    named = heads.select("path", "lines", path_key(F.col("path")).alias("__key"))
    scanned = _scanned_lines(spark, unread, n).select(path_key(F.col("path")).alias("__key"), F.col("lines").alias("__lines"))
    joined = named.join(scanned, "__key", "left")
    return joined.select("path", F.coalesce("lines", "__lines", F.array().cast("array<string>")).alias("lines"))


def file_headers(spark: SparkSession, path: str | Sequence[str] | DataFrame, line: int = 0) -> DataFrame:
    """``path, columns``: the cells of header line ``line`` of each file that has one."""
    heads = file_heads(spark, path, line + 1).filter(F.size("lines") > line)
    return heads.select("path", header_cells(F.col("lines")[line]).alias("columns"))


def file_inventory(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Size, modification time and header columns of each file."""
    files = list_files(spark, path).withColumn("__key", path_key(F.col("path")))
    heads = file_headers(spark, files).select(path_key(F.col("path")).alias("__key"), "columns")
    return files.join(heads, "__key", "left").drop("__key")


def path_key(path: Column) -> Column:
    """Path without scheme, so that file:/x, file:///x and escaped blanks compare equal."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^[a-z0-9]+:/+", "/")


def validate_files(
    spark: SparkSession,
    path: str | Sequence[str] | DataFrame,
    *,
    extension: str | None = None,
    required: Sequence[str] = (),
    min_columns: int | None = None,
    date_pattern: tuple[str, str] | None = None,
    header_line: int = 0,
) -> DataFrame:
    """Verdict per file: ``path, file_name, size, modified, reasons, ok``.

    ``path`` is a folder, several, or a listing as ``list_files`` gives it.  ``date_pattern`` is (pattern with one group,
    date format) for the date in the file name.
    """
    listed = path if isinstance(path, DataFrame) else list_files(spark, path)
    files = listed.withColumn("__key", path_key(F.col("path")))
    empty = F.array().cast("array<string>")
    if required or min_columns is not None:
        heads = file_headers(spark, listed, header_line).select(path_key(F.col("path")).alias("__key"), "columns")
        files = files.join(heads, "__key", "left").withColumn("columns", F.coalesce("columns", empty))
    reasons = []
    if extension is not None:
        reasons.append(F.when(~F.lower("file_name").endswith(extension.lower()), F.lit("extension")))
    if required:
        missing = F.array_except(F.array(*[F.lit(c) for c in required]), F.col("columns"))
        reasons.append(
            F.when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", ")))
        )
    if min_columns is not None:
        reasons.append(F.when(F.size("columns") < min_columns, F.lit("too few columns")))
    if date_pattern is not None:
        pattern, date_format = date_pattern
        text = F.nullif(F.regexp_extract("file_name", pattern, 1), F.lit(""))
        bad = F.try_to_timestamp(text, F.lit(date_format)).isNull()
        reasons.append(F.when(bad, F.lit("file date")))
    found = F.array_compact(F.array(*reasons)) if reasons else empty
    return files.select("path", "file_name", "size", "modified", found.alias("reasons")).withColumn("ok", F.size("reasons") == 0)


def accepted_paths(verdicts: DataFrame) -> list[str]:
    """Paths to read; a list of file names, never file content."""
    return [r.path for r in verdicts.filter("ok").select("path").toLocalIterator()]


def route_files(
    files: DataFrame,
    datasets: Mapping[str, str],
    sensitivity: Mapping[str, str] | None = None,
    default_sensitivity: str = "regular",
) -> DataFrame:
    """Dataset and sensitivity class of each file from the prefix of its name; the longest prefix wins.

    Rules are configuration, so they compile into one CASE expression: no join, no shuffle.
    Files no rule matches get a null dataset.
    """

    def match(rules: Mapping[str, str], default: Column) -> Column:
        case = None
        for prefix in sorted(rules, key=len, reverse=True):
            hit = F.col("file_name").startswith(prefix)
            case = F.when(hit, rules[prefix]) if case is None else case.when(hit, rules[prefix])
        return default if case is None else case.otherwise(default)

    return files.withColumns(
        {
            "dataset": match(datasets, F.lit(None).cast("string")),
            "sensitivity": match(sensitivity or {}, F.lit(default_sensitivity)),
        }
    )


def layer_path(root: str, layer: str, dataset: str, sensitivity: str = "regular") -> str:
    return f"{root.rstrip('/')}/{layer}/{sensitivity}/{dataset}"
