"""Table-driven metric engine.

A metric is a row of SQL fragments: expression, source, filter, grouping, and earlier metrics it builds on.
The engine turns a catalogue into one long table ``(dimensions..., kpiname, kpivalue, companycd)``.

Scale decisions, all made above Catalyst:

* metrics that read the same source with the same grouping share one scan and one aggregation; differing row
  filters become ``FILTER`` clauses (``fuse=True``);
* results that later metrics build on are written once to the shared folder and read back, so the fact tables
  are not scanned again per dependent metric;
* only definitions live on the driver, never data.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import as_col, quoted
from ..staging import stage

# Output columns of the long table.
DIMENSIONS = {"sourceemployeeid": "int", "storenumber": "string", "report_date": "date"}

# Catalogue columns and the fields they fill.
CATALOG_COLUMNS = {
    "KPIName": "name",
    "Companycd": "company_cd",
    "Classification": "classification",
    "Description": "description",
    "Expression": "expression",
    "FilterCondition": "filter",
    "FromClause": "from_clause",
    "GroupByColumns": "group_by",
    "CalculationLevel": "level",
    "CalculationIndicator": "calculation_indicator",
    "PublishIndicator": "publish_indicator",
    "PrimaryIndicator": "primary_indicator",
    "LveTableName": "depends",
}

# Published catalogue columns in order; None marks a constant added below.
PUBLISHED_CATALOG = {
    "KPI_NM": "KPIName",
    "CO_CD": "Companycd",
    "KPI_CLSIFCATION": "Classification",
    "KPI_DESC": "Description",
    "KPI_XPRSN": "Expression",
    "KPI_FLTR_COND": "FilterCondition",
    "KPI_FROM_CLAS": "FromClause",
    "KPI_GRPBYCOLLIINVC": "GroupByColumns",
    "KPI_CALC_LVL": "CalculationLevel",
    "KPI_ACTV_IND": None,
    "KPI_CALC_IND": "CalculationIndicator",
    "KPI_PBLSH_IND": "PublishIndicator",
    "PRI_KPI_IND": "PrimaryIndicator",
    "KPI_INTRADAY_IND": None,
    "CDC_IND_CD": None,
}
PUBLISHED_CONSTANTS = {"KPI_ACTV_IND": "1", "KPI_INTRADAY_IND": "", "CDC_IND_CD": "I"}

_AGGREGATE_CALL = re.compile(
    r"(sum|count|avg|mean|min|max|count_if|any_value|first|last|stddev|stddev_pop|stddev_samp|variance|var_pop|"
    r"var_samp|approx_count_distinct|bool_and|bool_or)\s*\(",
    re.IGNORECASE,
)
# Distinct counts of one value, and calls whose results over parts combine to that over the whole.
_ROLLS_UP = re.compile(r"count\s*\(\s*distinct\s+(?P<value>.*)\)|(?P<kind>sum|count|min|max)\s*\((?!\s*distinct\b).*\)", re.I | re.S)


@dataclass(frozen=True)
class Metric:
    name: str
    expression: str
    from_clause: str
    group_by: str = ""
    filter: str = ""
    level: int = 0
    depends: tuple[tuple[str, str], ...] = ()
    company_cd: int = 4
    classification: str = ""
    description: str = ""
    calculation_indicator: str = ""
    publish_indicator: str = ""
    primary_indicator: str = ""

    @property
    def condition(self) -> str | None:
        """The row condition of a plain WHERE clause, ``""`` without a filter, None for any other clause."""
        text = _squeeze(self.filter)
        if not text:
            return ""
        return text[6:] if text[:6].lower() == "where " else None

    @property
    def single_call(self) -> bool:
        """True when the expression is one aggregate call, to which a FILTER clause can be attached."""
        text = self.expression.strip()
        if not _AGGREGATE_CALL.match(text) or "'" in text or '"' in text:
            return False
        depth = 0
        for i, ch in enumerate(text):
            depth += (ch == "(") - (ch == ")")
            if ch == ")" and depth == 0:
                return i == len(text) - 1
        return False


def _squeeze(text: str | None) -> str:
    return " ".join((text or "").split())


def parse_depends(text: str | None) -> tuple[tuple[str, str], ...]:
    """``name=alias[,name=alias]`` to pairs."""
    pairs = [p.split("=", 1) for p in (text or "").split(",") if p.strip()]
    return tuple((a.strip(), b.strip()) for a, b in pairs)


def read_catalog(source: DataFrame) -> list[Metric]:
    """Metric definitions from a catalogue table (CSV, JSON or parquet, one row per metric).

    Definitions are configuration of known shape; they are the only thing that reaches the driver.
    """
    metrics = []
    for row in source.select(*CATALOG_COLUMNS).toLocalIterator():
        values = {f: row[c] for c, f in CATALOG_COLUMNS.items()}
        values["depends"] = parse_depends(values["depends"])
        values["level"], values["company_cd"] = int(values["level"]), int(values["company_cd"])
        metrics.append(Metric(**{k: "" if v is None else v for k, v in values.items()}))
    return metrics


def publish_catalog(source: DataFrame) -> DataFrame:
    return source.select(
        *[
            (F.lit(PUBLISHED_CONSTANTS[n]) if c is None else F.col(c)).alias(n)
            for n, c in PUBLISHED_CATALOG.items()
        ]
    )


def publish_values(values: DataFrame, source_system: str = "RQ4") -> DataFrame:
    return values.select(
        F.date_format("report_date", "yyyy/MM/dd").alias("RPT_DT"),
        F.col("storenumber").alias("STORE_NUM"),
        F.col("sourceemployeeid").alias("SRC_EMP_ID"),
        F.col("kpiname").alias("KPI_NM"),
        F.col("companycd").alias("CO_CD"),
        F.lit(source_system).alias("SRC_SYS_NM"),
        F.col("kpivalue").alias("KPI_VAL_ACTL"),
    )


def _as_dimension(col: Column, source_type: str, target_type: str) -> Column:
    if target_type == "date" and source_type == "string":
        return F.coalesce(
            F.try_to_date(col, "MM-dd-yyyy"), F.try_to_date(col, "MM/dd/yyyy"), col.try_cast("date")
        )
    return col if source_type == target_type else col.try_cast(target_type)


class MetricEngine:
    """Compute every metric of a catalogue over named source tables."""

    def __init__(
        self,
        spark: SparkSession,
        catalog: Iterable[Metric],
        sources: Mapping[str, DataFrame],
        dimensions: Mapping[str, str] = DIMENSIONS,
        fuse: bool = True,
        max_metrics: int = 64,
        max_distinct: int = 4,
    ):
        self.spark = spark
        self.max_metrics, self.max_distinct = max_metrics, max_distinct
        self.catalog = list(catalog)
        self.sources = dict(sources)
        self.dimensions = dict(dimensions)
        self.fuse = fuse
        self.waves = self._order()

    def _order(self) -> list[list[Metric]]:
        """Metrics in dependency order; duplicates, unknown dependencies and cycles are errors."""
        by_name = {m.name: m for m in self.catalog}
        if len(by_name) < len(self.catalog):
            seen: set[str] = set()
            twice = sorted({m.name for m in self.catalog if m.name in seen or seen.add(m.name)})
            raise ValueError(f"duplicate metric names: {twice}")
        for m in self.catalog:
            missing = [d for d, _ in m.depends if d not in by_name]
            if missing:
                raise ValueError(f"metric {m.name!r} depends on unknown metrics {missing}")
        waves: list[list[Metric]] = []
        done: set[str] = set()
        left = self.catalog
        while left:
            ready = [m for m in left if all(d in done for d, _ in m.depends)]
            if not ready:
                raise ValueError(f"metrics depend on each other: {sorted(m.name for m in left)}")
            waves.append(ready)
            done |= {m.name for m in ready}
            left = [m for m in left if m.name not in done]
        return waves

    def run(self) -> DataFrame:
        """The long metric table; null values are dropped."""
        with _temp_views(self.spark, [*self.sources, *{a for m in self.catalog for _, a in m.depends}]):
            return self._run()

    def _run(self) -> DataFrame:
        needed = {d for m in self.catalog for d, _ in m.depends}
        results: dict[str, DataFrame] = {}
        frames = []
        for name, df in self.sources.items():
            df.createOrReplaceTempView(name)
        for i, wave in enumerate(self.waves):
            long = reduce(DataFrame.unionByName, [self._query(g, results) for g in self._groups(wave)])
            used = [m.name for m in wave if m.name in needed]
            if used:
                long = stage(long, f"wave{i}", "kpiname")
            for name in used:
                results[name] = long.filter(F.col("kpiname") == name)
            frames.append(long)
        return reduce(DataFrame.unionByName, frames).filter(F.col("kpivalue").isNotNull())

    def _groups(self, wave: Sequence[Metric]) -> list[list[Metric]]:
        """Metrics that one aggregation can compute together."""
        if not self.fuse:
            return [[m] for m in wave]
        shared: dict[tuple, list[Metric]] = {}
        groups: list[list[Metric]] = []
        for m in wave:
            if m.condition is None:
                groups.append([m])
            else:
                shared.setdefault((_squeeze(m.from_clause), _squeeze(m.group_by), m.depends), []).append(m)
        for metrics in shared.values():
            # An expression of several calls needs its condition in WHERE; single calls can follow it there.
            fixed = {m.condition for m in metrics if m.condition and not m.single_call}
            for cond in sorted(fixed):
                groups += self._scans([m for m in metrics if m.condition == cond])
            groups += self._scans([m for m in metrics if m.condition not in fixed])
        return groups

    def _scans(self, metrics: Sequence[Metric]) -> list[list[Metric]]:
        """Bound one scan: generated code grows with the metrics, rows multiply with the distinct aggregates."""
        scans: list[list[Metric]] = []
        distinct: set[str] = set()
        for m in metrics:
            own = {_squeeze(m.expression)} if "distinct" in m.expression.lower() else set()
            if not scans or len(scans[-1]) == self.max_metrics or len(distinct | own) > self.max_distinct:
                scans.append([])
                distinct = set()
            scans[-1].append(m)
            distinct |= own
        return scans

    def _query(self, metrics: Sequence[Metric], results: Mapping[str, DataFrame]) -> DataFrame:
        first = metrics[0]
        group_by = _squeeze(first.group_by)
        conditions = list(dict.fromkeys(m.condition for m in metrics))
        one_where = len(conditions) == 1
        items, present = [], {}
        for i, m in enumerate(metrics):
            if one_where or not m.condition:
                items.append(f"{m.expression} AS __m{i}")
            else:
                items.append(f"{m.expression} FILTER (WHERE {m.condition}) AS __m{i}")
                if group_by and m.condition not in present:
                    present[m.condition] = f"__n{i}"
                    items.append(f"count(*) FILTER (WHERE {m.condition}) AS __n{i}")
        if one_where:
            where = _squeeze(first.filter)
        else:
            where = "WHERE " + " OR ".join(f"({c})" for c in conditions) if all(conditions) else ""
        source = f"FROM {first.from_clause} {where}"
        for name, alias in first.depends:
            results[name].createOrReplaceTempView(alias)
        try:
            wide = self._two_level(metrics, group_by, source, "" if one_where else None, present)
            if wide is None:
                head = f"{group_by}, " if group_by else ""
                tail = f" GROUP BY {group_by}" if group_by else ""
                wide = self.spark.sql(f"SELECT {head}{', '.join(items)} {source}{tail}")
        except PySparkException as e:
            raise ValueError(f"metrics {[m.name for m in metrics]}: {e}") from e
        for _, alias in first.depends:
            if alias in self.sources:  # the alias hid a source for this query only
                self.sources[alias].createOrReplaceTempView(alias)
        return self._to_long(wide, metrics, present)

    def _two_level(
        self, metrics: Sequence[Metric], group_by: str, source: str, only: str | None, present: Mapping[str, str]
    ) -> DataFrame | None:
        """Distinct counts of one expression, under any filters and next to sums, counts and extremes, without Expand.

        First a row per group and distinct value, with partial results and one flag per filter; then counts of the flags.
        Both levels combine before their shuffle, and input rows are not multiplied.  None where the shape does not fit.
        """
        calls = [_ROLLS_UP.fullmatch(m.expression.strip()) if m.single_call else None for m in metrics]
        values = {_squeeze(c["value"]) for c in calls if c and c["value"]}
        if None in calls or len(values) != 1 or "," in (value := values.pop()) or not group_by:
            return None
        parts, outer = [f"{value} AS __d"], []
        for i, (m, call) in enumerate(zip(metrics, calls, strict=True)):
            condition = m.condition if only is None else None
            if call["value"]:
                parts.append(f"{f'bool_or({condition})' if condition else 'true'} AS __m{i}")
                outer.append(F.count_if(F.col(f"__m{i}") & F.col("__d").isNotNull()).alias(f"__m{i}"))
            else:
                tail = f" FILTER (WHERE {condition})" if condition else ""
                parts.append(f"{call[0]}{tail} AS __m{i}")
                roll = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[call["kind"].lower()]
                outer.append(roll(f"__m{i}").alias(f"__m{i}"))
        for condition, name in present.items():
            parts.append(f"count(*) FILTER (WHERE {condition}) AS {name}")
            outer.append(F.sum(name).alias(name))
        inner = self.spark.sql(f"SELECT {group_by}, {', '.join(parts)} {source} GROUP BY {group_by}, {value}")
        groups = [c for c in inner.columns if not c.startswith("__")]
        if len(set(groups)) < len(groups):
            return None
        return inner.groupBy(*[F.col(quoted(c)) for c in groups]).agg(*outer)

    def _to_long(self, wide: DataFrame, metrics: Sequence[Metric], present: Mapping[str, str]) -> DataFrame:
        types = dict(wide.dtypes)
        grouped = [c for c in wide.columns if not c.startswith("__")]
        known = {d.lower(): d for d in self.dimensions}
        source_of = {known[c.lower()]: c for c in grouped if c.lower() in known}
        extra = [c for c in grouped if c.lower() not in known]
        missing = [d for d in self.dimensions if d not in source_of]
        if len(extra) == 1 and len(missing) == 1:
            source_of[missing[0]] = extra[0]
        elif extra:
            raise ValueError(f"metrics {[m.name for m in metrics]}: group columns {extra} are not dimensions")
        dims = [
            _as_dimension(F.col(quoted(source_of[d])), types[source_of[d]], t).alias(d)
            if d in source_of
            else F.lit(None).cast(t).alias(d)
            for d, t in self.dimensions.items()
        ]

        def value(i: int, m: Metric) -> Column:
            entry = F.struct(
                F.lit(m.name).alias("kpiname"),
                F.col(f"__m{i}").cast("double").alias("kpivalue"),
                F.lit(m.company_cd).alias("companycd"),
            )
            count = present.get(m.condition)
            return entry if count is None else F.when(F.col(count) > 0, entry)

        entries = [value(i, m) for i, m in enumerate(metrics)]
        if len(entries) == 1 and not present:
            return wide.select(*dims, entries[0].alias("__e")).select(*self.dimensions, "__e.*")
        long = wide.select(*dims, F.explode(F.array_compact(F.array(*entries))).alias("__e"))
        return long.select(*[as_col(d) for d in self.dimensions], "__e.*")


@contextmanager
def _temp_views(spark: SparkSession, names: Iterable[str]):
    """Give these view names back afterwards as they were before: the earlier view or none."""
    names = list(names)
    taken = {v.viewName.lower() for v in spark.sql("SHOW VIEWS").toLocalIterator() if v.isTemporary}
    before = {n: spark.table(n) for n in names if n.lower() in taken}
    try:
        yield
    finally:
        for name in names:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
