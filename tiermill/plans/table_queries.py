"""Every operator as a query over the supplied tables, next to the SQL that gives the expected rows.

Feed-shaped inputs (report text, id paths, delimited lists, snapshots) are derived from the tables by Spark, so the
work of each query grows with them.  ``SQL`` states the expected result independently of how the text was built.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from .. import sources as src
from ..streaming import ingest_stream
from .metrics import Metric, MetricEngine, publish_catalog, read_catalog
from ..staging import shared_folder

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fun: Callable[[SparkSession, Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fun(spark, lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__, run.__doc__ = fun.__name__, fun.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fun

    return add


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tiermill-queries/{uuid.uuid4().hex}"


def day(name: str) -> Column:
    return F.col(name).cast("date")


def exact(value: Column, scale: int = 2) -> Column:
    """Sum of money as a decimal, then a double: the same value in any engine and any order of rows."""
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


# --------------------------------------------------------------------------------------------- metrics

LINES = (
    "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
    "JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"
)
REVENUE = "sum(CAST(l.l_extendedprice * (1 - l.l_discount) AS DECIMAL(18,4)))"
GROUPS = "n.n_name, year(o.o_orderdate)"
METRIC_DIMS = {"n_name": "string", "report_year": "int"}
PAIR = "A a JOIN B b ON a.n_name = b.n_name AND a.report_year = b.report_year"

METRICS = [
    Metric("Revenue", REVENUE, LINES, GROUPS),
    Metric("Returned Revenue", REVENUE, LINES, GROUPS, filter="WHERE l.l_returnflag = 'R'"),
    Metric("Units", "sum(CAST(l.l_quantity AS DECIMAL(18,2)))", LINES, GROUPS),
    Metric("Orders", "count(DISTINCT o.o_orderkey)", LINES, GROUPS),
    Metric("Urgent Orders", "count(DISTINCT o.o_orderkey)", LINES, GROUPS, filter="WHERE o.o_orderpriority = '1-URGENT'"),
    Metric(
        "Return Rate",
        "max(a.kpivalue / b.kpivalue)",
        PAIR,
        "a.n_name, a.report_year",
        level=1,
        depends=(("Returned Revenue", "A"), ("Revenue", "B")),
    ),
    Metric(
        "Units per Order",
        "max(a.kpivalue / b.kpivalue)",
        PAIR,
        "a.n_name, a.report_year",
        level=1,
        depends=(("Units", "A"), ("Orders", "B")),
    ),
    Metric(
        "Best Return Rate",
        "min(r.kpivalue)",
        "RATE r",
        "r.n_name",
        filter="WHERE r.kpivalue > 0",
        level=2,
        depends=(("Return Rate", "RATE"),),
    ),
]

METRIC_CTES = f"""
WITH f AS (SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS report_year, l.*, o.* FROM {LINES}),
rev AS (SELECT n_name, report_year, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS v
        FROM f GROUP BY 1, 2),
ret AS (SELECT n_name, report_year, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS v
        FROM f WHERE l_returnflag = 'R' GROUP BY 1, 2),
uni AS (SELECT n_name, report_year, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS v FROM f GROUP BY 1, 2),
ord AS (SELECT n_name, report_year, CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS v FROM f GROUP BY 1, 2),
urg AS (SELECT n_name, report_year, CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS v
        FROM f WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
rate AS (SELECT ret.n_name, ret.report_year, ret.v / rev.v AS v FROM ret JOIN rev USING (n_name, report_year)),
upo AS (SELECT uni.n_name, uni.report_year, uni.v / ord.v AS v FROM uni JOIN ord USING (n_name, report_year)),
best AS (SELECT n_name, CAST(NULL AS INTEGER) AS report_year, min(v) AS v FROM rate WHERE v > 0 GROUP BY 1)
"""


def metric_sources(t: Tables) -> dict[str, DataFrame]:
    return {name: t(name) for name in ("lineitem", "orders", "customer", "nation")}


@query(
    "metric_long_table",
    METRIC_CTES
    + " UNION ALL ".join(
        ("" if i else "")
        + f"SELECT n_name, report_year, '{name}' AS kpiname, v AS kpivalue, 4 AS companycd FROM {cte} WHERE v IS NOT NULL"
        for i, (name, cte) in enumerate(
            [
                ("Revenue", "rev"),
                ("Returned Revenue", "ret"),
                ("Units", "uni"),
                ("Orders", "ord"),
                ("Urgent Orders", "urg"),
                ("Return Rate", "rate"),
                ("Units per Order", "upo"),
                ("Best Return Rate", "best"),
            ]
        )
    ),
)
def metric_long_table(spark, t):
    """Flagship: three dependency levels over the joined sales tables in one long table."""
    return MetricEngine(spark, METRICS, metric_sources(t), METRIC_DIMS).run()


FLAG_METRICS = [
    Metric("Lines", "count(*)", "lineitem", "l_returnflag"),
    Metric("Late Lines", "count(*)", "lineitem", "l_returnflag", filter="WHERE l_shipdate >= TIMESTAMP_NTZ '2001-01-01'"),
    Metric("Large Lines", "count(*)", "lineitem", "l_returnflag", filter="WHERE l_quantity > 45"),
    Metric("Parts", "count(DISTINCT l_partkey)", "lineitem", "l_returnflag"),
    Metric("Top Price", "max(l_extendedprice)", "lineitem", "l_returnflag", filter="WHERE l_quantity > 45"),
]
FLAG_SQL = """
SELECT l_returnflag, 'Lines' AS kpiname, CAST(count(*) AS DOUBLE) AS kpivalue, 4 AS companycd FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'Late Lines', CAST(count(*) AS DOUBLE), 4 FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY 1
UNION ALL SELECT l_returnflag, 'Large Lines', CAST(count(*) AS DOUBLE), 4 FROM lineitem WHERE l_quantity > 45 GROUP BY 1
UNION ALL SELECT l_returnflag, 'Parts', CAST(count(DISTINCT l_partkey) AS DOUBLE), 4 FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'Top Price', max(l_extendedprice), 4 FROM lineitem WHERE l_quantity > 45 GROUP BY 1
"""


@query("metric_fused", FLAG_SQL)
def metric_fused(spark, t):
    """Five metrics, three filters, one scan."""
    return MetricEngine(spark, FLAG_METRICS, {"lineitem": t("lineitem")}, {"l_returnflag": "string"}).run()


@query("metric_one_scan_each", FLAG_SQL)
def metric_one_scan_each(spark, t):
    """The same metrics without fusion."""
    engine = MetricEngine(spark, FLAG_METRICS, {"lineitem": t("lineitem")}, {"l_returnflag": "string"}, fuse=False)
    return engine.run()


@query(
    "metric_with_filter_level2",
    """
WITH n AS (SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY 1, 2),
big AS (SELECT o_orderstatus, max(v) AS v FROM n GROUP BY 1)
SELECT o_orderstatus, o_orderpriority, 'Orders' AS kpiname, v AS kpivalue, 7 AS companycd FROM n
UNION ALL SELECT o_orderstatus, NULL, 'Largest', v, 7 FROM big
UNION ALL SELECT n.o_orderstatus, n.o_orderpriority, 'Share of Largest', max(n.v / big.v), 9
  FROM n JOIN big USING (o_orderstatus) WHERE n.o_orderpriority <> '5-LOW' GROUP BY 1, 2
""",
)
def metric_with_filter_level2(spark, t):
    by = "o_orderstatus, o_orderpriority"
    metrics = [
        Metric("Orders", "count(*)", "orders", by, company_cd=7),
        Metric(
            "Largest", "max(kpivalue)", "N", "o_orderstatus", level=1, company_cd=7, depends=(("Orders", "N"),)
        ),
        Metric(
            "Share of Largest",
            "max(n.kpivalue / b.kpivalue)",
            "N n JOIN B b ON n.o_orderstatus = b.o_orderstatus",
            "n.o_orderstatus, n.o_orderpriority",
            filter="WHERE n.o_orderpriority <> '5-LOW'",
            level=2,
            company_cd=9,
            depends=(("Orders", "N"), ("Largest", "B")),
        ),
    ]
    dims = {"o_orderstatus": "string", "o_orderpriority": "string"}
    return MetricEngine(spark, metrics, {"orders": t("orders")}, dims).run()


@query(
    "metric_global",
    """
SELECT 'Customers' AS kpiname, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS kpivalue, 4 AS companycd FROM orders
UNION ALL SELECT 'Order Value', CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 4 FROM orders
UNION ALL SELECT 'Urgent Value', CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 4 FROM orders
  WHERE o_orderpriority = '1-URGENT'
""",
)
def metric_global(spark, t):
    """Metrics without grouping columns."""
    value = "sum(CAST(o_totalprice AS DECIMAL(18,2)))"
    metrics = [
        Metric("Customers", "count(DISTINCT o_custkey)", "orders"),
        Metric("Order Value", value, "orders"),
        Metric("Urgent Value", value, "orders", filter="WHERE o_orderpriority = '1-URGENT'"),
    ]
    return MetricEngine(spark, metrics, {"orders": t("orders")}, {}).run()


@query(
    "metric_sql_functions",
    """
SELECT CAST(o_custkey AS INTEGER) AS sourceemployeeid, CAST(NULL AS VARCHAR) AS storenumber,
  CAST(o_orderdate AS DATE) AS report_date, 'Orders' AS kpiname, CAST(count(*) AS DOUBLE) AS kpivalue, 4 AS companycd
FROM orders GROUP BY 1, 3
""",
)
def metric_sql_functions(spark, t):
    """Definitions may group by the registered SQL functions; the odd column becomes the report date."""
    fn.register_sql_functions(spark)
    sales = t("orders").select(
        F.col("o_custkey").alias("sourceemployeeid"),
        F.lit(None).cast("string").alias("storenumber"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("invoicedate"),
    )
    metrics = [Metric("Orders", "count(*)", "sales", "sourceemployeeid, storenumber, getOnlyDate(invoicedate)")]
    return MetricEngine(spark, metrics, {"sales": sales}).run()



def region_catalog(t: Tables) -> DataFrame:
    """One metric definition per nation: a catalogue table derived from the data."""
    return t("nation").select(
        F.concat(F.lit("Orders "), "n_name").alias("KPIName"),
        F.lit(4).alias("Companycd"),
        F.lit("Sales").alias("Classification"),
        F.col("n_name").alias("Description"),
        F.lit("count(*)").alias("Expression"),
        F.concat(F.lit("WHERE c_nationkey = "), "n_nationkey").alias("FilterCondition"),
        F.lit("orders JOIN customer ON o_custkey = c_custkey").alias("FromClause"),
        F.lit("o_orderstatus").alias("GroupByColumns"),
        F.lit(0).alias("CalculationLevel"),
        F.lit("Y").alias("CalculationIndicator"),
        F.lit("Y").alias("PublishIndicator"),
        F.lit("N").alias("PrimaryIndicator"),
        F.lit(None).cast("string").alias("LveTableName"),
    )


@query(
    "metric_catalog_run",
    """
SELECT o_orderstatus, 'Orders ' || n_name AS kpiname, CAST(count(*) AS DOUBLE) AS kpivalue, 4 AS companycd
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
""",
)
def metric_catalog_run(spark, t):
    """A stored catalogue of 25 filtered metrics; fusion turns it into one scan of the sales tables."""
    path = f"{scratch(spark)}/catalog"
    region_catalog(t).write.mode("overwrite").parquet(path)
    metrics = read_catalog(spark.read.parquet(path))
    sources = {"orders": t("orders"), "customer": t("customer")}
    return MetricEngine(spark, metrics, sources, {"o_orderstatus": "string"}).run()


@query(
    "metric_catalog_publish",
    """
SELECT 'Lines of ' || p_partkey AS "KPI_NM", 4 AS "CO_CD", p_brand AS "KPI_CLSIFCATION", p_name AS "KPI_DESC",
  'count(*)' AS "KPI_XPRSN", 'WHERE l_partkey = ' || p_partkey AS "KPI_FLTR_COND", 'lineitem' AS "KPI_FROM_CLAS",
  'l_returnflag' AS "KPI_GRPBYCOLLIINVC", 0 AS "KPI_CALC_LVL", '1' AS "KPI_ACTV_IND", 'Y' AS "KPI_CALC_IND",
  'Y' AS "KPI_PBLSH_IND", 'N' AS "PRI_KPI_IND", '' AS "KPI_INTRADAY_IND", 'I' AS "CDC_IND_CD"
FROM part
""",
)
def metric_catalog_publish(spark, t):
    """A definition per part under its published names."""
    return publish_catalog(
        t("part").select(
            F.concat(F.lit("Lines of "), "p_partkey").alias("KPIName"),
            F.lit(4).alias("Companycd"),
            F.col("p_brand").alias("Classification"),
            F.col("p_name").alias("Description"),
            F.lit("count(*)").alias("Expression"),
            F.concat(F.lit("WHERE l_partkey = "), "p_partkey").alias("FilterCondition"),
            F.lit("lineitem").alias("FromClause"),
            F.lit("l_returnflag").alias("GroupByColumns"),
            F.lit(0).alias("CalculationLevel"),
            F.lit("Y").alias("CalculationIndicator"),
            F.lit("Y").alias("PublishIndicator"),
            F.lit("N").alias("PrimaryIndicator"),
        )
    )


# ------------------------------------------------------------------------------- change capture, history

CUT = "2001-01-01"


def order_book(orders: DataFrame, start: str = "1990-01-01", end: str = "2100-01-01") -> DataFrame:
    """Snapshot of the order book as seen in a period: one row per customer and priority."""
    seen = orders.filter((day("o_orderdate") >= F.lit(start).cast("date")) & (day("o_orderdate") < F.lit(end).cast("date")))
    return seen.groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"),
        exact(F.col("o_totalprice")).alias("total"),
        F.max(day("o_orderdate")).alias("last_date"),
        F.max(F.when(F.col("o_orderstatus") == "F", day("o_orderdate"))).alias("last_filled"),
    )


BOOK = """
{name} AS (SELECT o_custkey, o_orderpriority, count(*) AS n_orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(max(o_orderdate) AS DATE) AS last_date,
  CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS last_filled
  FROM orders WHERE o_orderdate >= DATE '{start}' AND o_orderdate < DATE '{end}' GROUP BY 1, 2)"""


def book_sql(prev: tuple[str, str], curr: tuple[str, str]) -> str:
    return (
        "WITH "
        + BOOK.format(name="prev", start=prev[0], end=prev[1])
        + ","
        + BOOK.format(name="curr", start=curr[0], end=curr[1])
    )


ALL_TIME = ("1990-01-01", "2100-01-01")
BEFORE_CUT = ("1990-01-01", CUT)
OLD_PERIOD = ("1990-01-01", "1999-01-01")
NEW_PERIOD = ("1996-01-01", "2100-01-01")
BOOK_KEYS = ["o_custkey", "o_orderpriority"]
BOOK_COLS = "c.o_custkey, c.o_orderpriority, c.n_orders, c.total, c.last_date, c.last_filled"
SAME = (
    "c.n_orders IS NOT DISTINCT FROM p.n_orders AND c.total IS NOT DISTINCT FROM p.total AND "
    "c.last_date IS NOT DISTINCT FROM p.last_date AND c.last_filled IS NOT DISTINCT FROM p.last_filled"
)
MATCH = "c.o_custkey = p.o_custkey AND c.o_orderpriority = p.o_orderpriority"
CLASS_SQL = f"CASE WHEN p.o_custkey IS NULL THEN 'N' WHEN {SAME} THEN 'U' ELSE 'C' END"


@query(
    "cdc_classify",
    f"{book_sql(BEFORE_CUT, ALL_TIME)} SELECT {BOOK_COLS}, {CLASS_SQL} AS change FROM curr c LEFT JOIN prev p ON {MATCH}",
)
def cdc_classify(spark, t):
    orders = t("orders")
    return op.classify_changes(order_book(orders, *BEFORE_CUT), order_book(orders), BOOK_KEYS)


@query(
    "cdc_change_counts",
    f"""{book_sql(OLD_PERIOD, NEW_PERIOD)}
SELECT CASE WHEN c.o_custkey IS NULL THEN 'D' ELSE {CLASS_SQL} END AS change, count(*) AS n_rows
FROM curr c FULL JOIN prev p ON {MATCH} GROUP BY 1""",
)
def cdc_change_counts(spark, t):
    orders = t("orders")
    prev, curr = order_book(orders, *OLD_PERIOD), order_book(orders, *NEW_PERIOD)
    return op.change_counts(op.classify_changes(prev, curr, BOOK_KEYS, deletes=True))


@query(
    "cdc_with_deletes",
    f"""{book_sql(OLD_PERIOD, NEW_PERIOD)}
SELECT {BOOK_COLS}, CASE WHEN p.o_custkey IS NULL THEN 'I' ELSE 'C' END AS cdc_ind_cd
FROM curr c LEFT JOIN prev p ON {MATCH} WHERE p.o_custkey IS NULL OR NOT ({SAME})
UNION ALL SELECT {BOOK_COLS}, 'D' FROM prev c LEFT JOIN curr p ON {MATCH} WHERE p.o_custkey IS NULL""",
)
def cdc_with_deletes(spark, t):
    orders = t("orders")
    return op.delta(order_book(orders, *OLD_PERIOD), order_book(orders, *NEW_PERIOD), BOOK_KEYS, deletes=True)


@query(
    "cdc_delta_fingerprint",
    f"""{book_sql(BEFORE_CUT, ALL_TIME)}
SELECT {BOOK_COLS}, CASE WHEN p.o_custkey IS NULL THEN 'I' ELSE 'C' END AS cdc_ind_cd
FROM curr c LEFT JOIN prev p ON {MATCH} WHERE p.o_custkey IS NULL OR NOT ({SAME})""",
)
def cdc_delta_fingerprint(spark, t):
    orders = t("orders")
    return op.delta(order_book(orders, *BEFORE_CUT), order_book(orders), BOOK_KEYS)


@query(
    "cdc_delta_except",
    """
WITH prev AS (SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem WHERE l_shipdate < DATE '2000-01-01'),
curr AS (SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem),
d AS (SELECT * FROM curr EXCEPT SELECT * FROM prev)
SELECT d.*, CASE WHEN EXISTS (SELECT 1 FROM prev p WHERE p.l_partkey = d.l_partkey AND p.l_suppkey = d.l_suppkey)
  THEN 'C' ELSE 'I' END AS cdc_ind_cd FROM d
""",
)
def cdc_delta_except(spark, t):
    """Set difference of an association that holds several rows per key."""
    curr = t("lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    prev = curr.filter(day("l_shipdate") < F.lit("2000-01-01").cast("date")).drop("l_shipdate")
    return op.delta(prev, curr.drop("l_shipdate"), ["l_partkey", "l_suppkey"], method="except")


@query(
    "cdc_classify_multiset",
    """
WITH prev AS (SELECT l_partkey, l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_shipdate < DATE '1998-06-01'),
curr AS (SELECT l_partkey, l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_shipdate >= DATE '1998-06-01'),
u AS (SELECT DISTINCT * FROM prev), k AS (SELECT DISTINCT l_partkey, l_returnflag FROM prev)
SELECT c.*, CASE WHEN u.l_partkey IS NOT NULL THEN 'U' WHEN k.l_partkey IS NOT NULL THEN 'C' ELSE 'N' END AS change
FROM curr c LEFT JOIN u USING (l_partkey, l_returnflag, l_linestatus, l_quantity) LEFT JOIN k USING (l_partkey, l_returnflag)
""",
)
def cdc_classify_multiset(spark, t):
    """Snapshots with many rows per key."""
    lines = t("lineitem")
    cols = ["l_partkey", "l_returnflag", "l_linestatus", "l_quantity"]
    late = day("l_shipdate") >= F.lit("1998-06-01").cast("date")
    prev, curr = lines.filter(~late).select(*cols), lines.filter(late).select(*cols)
    return op.classify_changes(prev, curr, ["l_partkey", "l_returnflag"], unique_keys=False)


@query("cdc_first_load", "SELECT c.*, 'I' AS cdc_ind_cd FROM customer c")
def cdc_first_load(spark, t):
    return op.delta(None, t("customer"), ["c_custkey"])


@query(
    "cdc_fingerprint_groups",
    """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT (l_returnflag, l_linestatus, l_quantity, l_discount)) AS BIGINT)
  AS n_fingerprints FROM lineitem
""",
)
def cdc_fingerprint_groups(spark, t):
    """Fingerprints separate exactly the distinct rows."""
    cols = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    prints = t("lineitem").select(op.row_fingerprint(cols).alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    return prints.agg(F.sum("n").alias("n_rows"), F.count("f").alias("n_fingerprints"))


@query(
    "upsert_latest",
    """
WITH r AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM r WHERE rn = 1
""",
)
def upsert_latest(spark, t):
    """Merge the orders since the cut into the history before it."""
    orders = t("orders").select("o_custkey", "o_orderkey", day("o_orderdate").alias("o_orderdate"), "o_orderstatus")
    old = F.col("o_orderdate") < F.lit(CUT).cast("date")
    history = op.keep_latest(orders.filter(old), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return op.upsert(history, orders.filter(~old), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "keep_latest_ties",
    """
SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT l_orderkey, l_partkey, l_quantity,
  rank() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r = 1
""",
)
def keep_latest_ties(spark, t):
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return op.keep_latest(lines, ["l_partkey"], ["l_quantity"], ties="all")


@query(
    "dedup_key_subset",
    """
SELECT user_id, event_type, event_id FROM (SELECT user_id, event_type, event_id,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM events) WHERE r = 1
""",
)
def dedup_key_subset(spark, t):
    return op.drop_key_duplicates(t("events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"])


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, t):
    return op.distinct_rows(t("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@query(
    "event_flag",
    """
SELECT event_id, CASE event_type WHEN 'signup' THEN 'I' WHEN 'purchase' THEN 'C' END AS cdc_ind_cd FROM events
""",
)
def event_flag(spark, t):
    event = fn.recode("event_type", {"signup": "Inserted", "purchase": "Updated"})
    return t("events").select("event_id", fn.event_flag(event).alias("cdc_ind_cd"))


# ------------------------------------------------------------------------------------- validation


def order_report(orders: DataFrame) -> DataFrame:
    """Orders as report text with the usual defects: letters in keys, ISO dates, missing and blank cells."""
    low, partial = F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") == "P"
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.select(
        "o_orderkey",
        F.concat(F.col("o_custkey").cast("string"), F.when(low, "x").otherwise("")).alias("store"),
        F.when(partial, F.date_format("o_orderdate", "yyyy.MM.dd"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
        .alias("opened"),
        F.when(urgent & partial, F.lit(" ")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(urgent & ~partial, F.lit(None)).otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
    )


def report_rules() -> dict[str, Column]:
    return {
        "store_number": op.numeric("store"),
        "open_date": op.us_date("opened"),
        "any_date": op.date_like(F.translate("opened", ".", "-")),
        "priority": op.not_blank("priority"),
        "amount": op.required("amount"),
    }


RULES_SQL = """
WITH r AS (SELECT o_orderkey, o_custkey || CASE WHEN o_orderpriority = '5-LOW' THEN 'x' ELSE '' END AS store,
  o_orderpriority = '5-LOW' AS low, o_orderstatus = 'P' AS part, o_orderpriority = '1-URGENT' AS urg FROM orders)"""


@query("split_valid_good", RULES_SQL + " SELECT o_orderkey, store FROM r WHERE NOT low AND NOT part AND NOT urg")
def split_valid_good(spark, t):
    good, _ = op.split_valid(order_report(t("orders")), report_rules())
    return good.select("o_orderkey", "store")


@query(
    "split_valid_bad",
    RULES_SQL
    + """ SELECT o_orderkey, store, concat_ws('|', CASE WHEN low THEN 'store_number' END, CASE WHEN part THEN 'open_date' END,
  CASE WHEN urg AND part THEN 'priority' END, CASE WHEN urg AND NOT part THEN 'amount' END) AS failed_rules
FROM r WHERE low OR part OR urg""",
)
def split_valid_bad(spark, t):
    _, bad = op.split_valid(order_report(t("orders")), report_rules())
    return bad.select("o_orderkey", "store", F.concat_ws("|", "failed_rules").alias("failed_rules"))


@query(
    "error_summary",
    RULES_SQL
    + """, e AS (SELECT 'store_number' AS rule FROM r WHERE low UNION ALL SELECT 'open_date' FROM r WHERE part
  UNION ALL SELECT 'priority' FROM r WHERE urg AND part UNION ALL SELECT 'amount' FROM r WHERE urg AND NOT part)
SELECT 'orders' AS dataset, rule, count(*) AS n_rows, 'run1' AS last_run_id FROM e GROUP BY rule""",
)
def error_summary(spark, t):
    """Quarantine to CSV and summarise what was stored."""
    _, bad = op.split_valid(order_report(t("orders")), report_rules())
    root = scratch(spark)
    op.quarantine(bad, root, "orders", "run1")
    schema = "o_orderkey long, store string, opened string, priority string, amount string, failed_rules string, run_id string"
    stored = src.read_delivery(spark, f"{root}/orders", schema)
    stored = stored.select(F.lit("orders").alias("dataset"), F.split("failed_rules", r"\|").alias("failed_rules"), "run_id")
    return op.error_summary(stored)


@query(
    "with_defaults",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN -1.0 ELSE value END AS value,
  CASE WHEN event_type = 'view' THEN 'NA' ELSE event_type END AS event_type FROM events
""",
)
def with_defaults(spark, t):
    events = t("events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.nullif("event_type", F.lit("view")).alias("event_type"),
    )
    return op.with_defaults(events, {"value": -1.0, "event_type": "NA"})


@query("drop_null_values", "SELECT event_id, value FROM events WHERE event_type <> 'error' AND value IS NOT NULL")
def drop_null_values(spark, t):
    value = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    good, _ = op.split_valid(t("events").select("event_id", value), {"value": op.required("value")})
    return good


@query(
    "noise_rows",
    """
SELECT doc_id, lang FROM documents WHERE text NOT LIKE '%the %' AND text NOT LIKE 'Th%' AND text NOT LIKE '%@%'
""",
)
def noise_rows(spark, t):
    return op.drop_noise(t("documents"), "text", ["%the %", "Th%", "%@%"]).select("doc_id", "lang")


# --------------------------------------------------------------------------------------- reshaping


@query(
    "unpivot_measures",
    """
SELECT l_orderkey, l_linenumber, 'Quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'Extended Price', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'Discount', CASE WHEN l_discount > 0 THEN l_discount ELSE 0.0 END FROM lineitem
""",
)
def unpivot_measures(spark, t):
    lines = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extended_price"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount"),
    )
    names = {"quantity": "Quantity", "extended_price": "Extended Price", "discount": "Discount"}
    return op.unpivot_measures(lines, ["l_orderkey", "l_linenumber"], null_value=0.0, names=names)


@query(
    "unpivot_name_parts",
    """
SELECT l_orderkey, 'net' AS adjustmenttype, 'price' AS adjustmentcategory, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
FROM lineitem
UNION ALL SELECT l_orderkey, 'net', 'quantity', CAST(l_quantity AS DECIMAL(18,2)) FROM lineitem
UNION ALL SELECT l_orderkey, 'gross', 'tax', CAST(l_tax AS DECIMAL(18,2)) FROM lineitem
""",
)
def unpivot_name_parts(spark, t):
    lines = t("lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").alias("net|price"),
        F.col("l_quantity").cast("int").alias("net|quantity"),
        F.col("l_tax").alias("gross|tax"),
    )
    return op.unpivot_measures(
        lines,
        ["l_orderkey"],
        value_col="amount",
        value_type="decimal(18,2)",
        name_parts=["adjustmenttype", "adjustmentcategory"],
        sep="|",
    )


@query(
    "explode_list_primary",
    """
WITH a AS (SELECT DISTINCT o_custkey, CAST(date_part('year', o_orderdate) AS INTEGER) AS store FROM orders),
p AS (SELECT o_custkey, CASE WHEN max(o_orderpriority) = '5-LOW' THEN CAST(date_part('year', max(o_orderdate)) AS INTEGER) END
  AS first_store FROM orders GROUP BY 1)
SELECT a.o_custkey, a.store, CASE WHEN a.store = p.first_store THEN 1 ELSE 0 END AS is_primary
FROM a JOIN p USING (o_custkey) WHERE p.first_store IS NOT NULL
UNION ALL SELECT o_custkey, -2, 1 FROM p WHERE first_store IS NULL
""",
)
def explode_list_primary(spark, t):
    """Assigned locations as ``"1998 Site, 1999 Site"`` text plus a primary location that may be missing."""
    year = F.year(day("o_orderdate"))
    people = (
        t("orders")
        .groupBy("o_custkey")
        .agg(
            F.array_join(F.transform(F.collect_set(year), lambda y: F.concat(y.cast("string"), F.lit(" Site"))), ", ").alias(
                "assigned"
            ),
            F.when(F.max("o_orderpriority") == "5-LOW", F.concat(F.year(F.max(day("o_orderdate"))), F.lit(" Site"))).alias(
                "primary"
            ),
        )
    )
    rows = op.explode_list(people, "assigned", primary="primary", unknown=-2, out="store")
    return rows.select("o_custkey", "store", "is_primary")


@query(
    "id_levels",
    """
SELECT o_orderkey, substr(s, 1, 2) AS level_1, CASE WHEN length(s) > 2 THEN substr(s, 1, 4) END AS level_2,
  CASE WHEN length(s) > 4 THEN substr(s, 1, 6) END AS level_3
FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS s FROM orders)
""",
)
def id_levels(spark, t):
    levels = fn.id_levels("o_orderkey", 2, 3)
    return t("orders").select("o_orderkey", *[c.alias(f"level_{i}") for i, c in enumerate(levels, 1)])


@query(
    "path_levels",
    """
SELECT p_partkey, p_brand AS level_1, p_type AS level_2, CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END AS level_3,
  CAST(NULL AS VARCHAR) AS level_4 FROM part
""",
)
def path_levels(spark, t):
    parts = [F.col("p_brand"), F.col("p_type"), F.when(F.col("p_size") > 10, F.col("p_size").cast("string"))]
    path = F.concat_ws(" >> ", *parts)
    levels = fn.path_levels(path, ">>", 4)
    return t("part").select("p_partkey", *[c.alias(f"level_{i}") for i, c in enumerate(levels, 1)])


@query(
    "expand_roles",
    """
SELECT p_partkey, 'Retail' AS kind, CASE WHEN p_type = 'PROMO' THEN 'Closed' ELSE 'Active' END AS status FROM part
  WHERE p_type <> 'LARGE'
UNION ALL SELECT p_partkey, 'Mapped', 'Active' FROM part
""",
)
def expand_roles(spark, t):
    """Two association rows per part unless its type allows only the mapped one."""
    kind = F.col("p_type")
    status = F.when(kind == "PROMO", "Closed").otherwise("Active")
    roles = [
        (kind != "LARGE", {"kind": F.lit("Retail"), "status": status}),
        (F.lit(True), {"kind": F.lit("Mapped"), "status": F.lit("Active")}),
    ]
    return op.expand_roles(t("part"), ["p_partkey"], roles)


@query(
    "split_key_label",
    """
SELECT p_partkey, split_part(p_name, ' ', 1) AS key, substr(p_name, length(split_part(p_name, ' ', 1)) + 2) AS label FROM part
""",
)
def split_key_label(spark, t):
    key, label = fn.split_key_label("p_name")
    return t("part").select("p_partkey", key.alias("key"), label.alias("label"))


@query(
    "last_token",
    "SELECT p_partkey, split_part(p_name, ' ', -1) AS token FROM part",
)
def last_token(spark, t):
    return t("part").select("p_partkey", fn.last_token("p_name").alias("token"))


@query(
    "split_on_marker",
    """
SELECT c_custkey, 'Customer' AS before, substr(c_name, 10) AS after FROM customer
""",
)
def split_on_marker(spark, t):
    before, after = fn.split_on_marker("c_name", "#")
    return t("customer").select("c_custkey", before.alias("before"), after.alias("after"))


@query(
    "parse_hours",
    """
WITH h AS (SELECT o_orderkey, CAST(o_orderkey % 12 + 1 AS VARCHAR) AS h, o_orderstatus AS s FROM orders)
SELECT o_orderkey, h || ':00 AM' AS "MondayOpenTime", h || ':30 PM' AS "MondayCloseTime",
  CASE s WHEN 'F' THEN '00:00 AM' WHEN 'O' THEN '09:15 Am' END AS "SundayOpenTime",
  CASE s WHEN 'F' THEN '00:00 AM' WHEN 'O' THEN '5:45 Pm' END AS "SundayCloseTime" FROM h
""",
)
def parse_hours(spark, t):
    """Opening hours written per order: Monday open, Sunday closed, open or missing."""
    hour = (F.col("o_orderkey") % 12 + 1).cast("string")
    sunday = F.when(F.col("o_orderstatus") == "F", "; U: Closed").when(F.col("o_orderstatus") == "O", "; U: 09:15 Am-5:45 Pm")
    text = F.concat(F.lit("Hours M: "), hour, F.lit(":00 AM-"), hour, F.lit(":30 PM"), F.coalesce(sunday, F.lit("")))
    hours = fn.parse_hours(text, {d: fn.DAY_CODES[d] for d in ("Monday", "Sunday")})
    return t("orders").select("o_orderkey", *[c.alias(n) for n, c in hours.items()])


# ---------------------------------------------------------------------------------- cleaning functions


@query(
    "to_flag",
    """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS flag,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 END AS marked FROM orders
""",
)
def to_flag(spark, t):
    answer = fn.recode("o_orderstatus", {"F": " Yes", "O": "OFF", "P": "maybe"})
    mark = F.when(F.col("o_orderpriority") == "1-URGENT", "X")
    return t("orders").select(
        "o_orderkey",
        fn.to_flag(answer, ["true", "yes"], ["false", "no", "off"], F.lit(-1)).alias("flag"),
        fn.to_flag(mark, ["x", "yes", "true"]).alias("marked"),
    )


@query(
    "recode",
    """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN '' ELSE c_mktsegment END
  AS segment FROM customer
""",
)
def recode(spark, t):
    segment = fn.recode("c_mktsegment", {"BUILDING": "Construction", "MACHINERY": ""})
    return t("customer").select("c_custkey", segment.alias("segment"))


@query(
    "conditional_date",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate > o_orderdate + INTERVAL 60 DAY THEN CAST(l_shipdate AS DATE) END
  AS late_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
)
def conditional_date(spark, t):
    joined = op.enrich(t("lineitem"), t("orders"), {"l_orderkey": "o_orderkey"}, ["o_orderdate"], "inner")
    late = fn.later_date(day("l_shipdate"), F.date_add(day("o_orderdate"), 60))
    return joined.select("l_orderkey", "l_linenumber", late.alias("late_date"))


@query(
    "parse_money",
    """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(15,2)) AS loss,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(15,2)) AS signed_loss,
  CAST(NULL AS DECIMAL(15,2)) AS unreadable FROM lineitem
""",
)
def parse_money(spark, t):
    """Prices as ``$1,234.50`` or ``($1,234.50)`` text."""
    plain = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    text = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("("), plain, F.lit(") "))).otherwise(plain)
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.parse_money(text).alias("loss"),
        fn.parse_money(text, negative_parens=True).alias("signed_loss"),
        fn.parse_money(F.concat(text, F.lit(" n/a"))).alias("unreadable"),
    )


@query(
    "parse_percent",
    """
SELECT l_orderkey, l_linenumber, CAST(l_discount AS DECIMAL(8,4)) AS discount, CAST(l_quantity AS DECIMAL(8,4)) AS quantity,
  CAST(l_tax AS DECIMAL(20,8)) AS tax FROM lineitem
""",
)
def parse_percent(spark, t):
    percent = F.concat(F.format_number(F.col("l_discount") * 100, 1), F.lit("%"))
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.parse_percent(percent).alias("discount"),
        fn.parse_percent(F.format_number("l_quantity", 2)).alias("quantity"),
        fn.parse_percent(F.format_number(F.col("l_tax") * 100, 0), "decimal(20,8)", always=True).alias("tax"),
    )


@query(
    "scrub_text",
    r"""
SELECT doc_id, md5(regexp_replace(text, '[\r\n]', ' ', 'g')) AS digest, CAST(length(text) AS INTEGER) AS n FROM documents
""",
)
def scrub_text(spark, t):
    clean = fn.scrub_text(t("documents"), ["text"])
    return clean.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("n"))


@query(
    "ascii_only",
    r"""
SELECT doc_id, md5(regexp_replace(replace(text, '"', ' '), '[^\x00-\x7F]', '', 'g')) AS digest FROM documents
""",
)
def ascii_only(spark, t):
    return t("documents").select("doc_id", F.md5(fn.ascii_only("text")).alias("digest"))


@query(
    "unquote",
    """
SELECT page_id, md5(replace(html, '"', ' ')) AS digest FROM pages
""",
)
def unquote(spark, t):
    return t("pages").select("page_id", F.md5(fn.unquote("html")).alias("digest"))


@query(
    "date_text_formats",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date_s, CAST(o_orderdate AS DATE) AS date_h,
  strftime(o_orderdate, '%m-%d-%Y') AS only_date, strftime(o_orderdate, '%m/%d/%Y') AS correct_date,
  strftime(o_orderdate, '%m/%d/%Y') AS only_date2, CAST(trunc(o_totalprice) AS INTEGER) AS whole,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_text FROM orders
""",
)
def date_text_formats(spark, t):
    """The SQL functions metric definitions call, on text in each of their formats."""
    fn.register_sql_functions(spark)
    d = F.col("o_orderdate")
    text = t("orders").select(
        "o_orderkey",
        F.date_format(d, "M/d/yyyy").alias("s"),
        F.date_format(d, "MM-dd-yy").alias("h"),
        F.date_format(d, "yyyy-MM-dd HH:mm:ss.SSS").alias("o"),
        F.date_format(d, "MM/dd/yyyy HH:mm").alias("c"),
        F.date_format(d, "M/d/yy H:mm").alias("o2"),
        "o_totalprice",
        fn.iso_to_timestamp_text(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("ts_text"),
    )
    return text.selectExpr(
        "o_orderkey",
        "getDateS(s) AS date_s",
        "getDateH(h) AS date_h",
        "getOnlyDate(o) AS only_date",
        "correctFormatDate(c) AS correct_date",
        "getOnlyDate2(o2) AS only_date2",
        "doubleToInt(o_totalprice) AS whole",
        "ts_text",
    )


# ------------------------------------------------------------------------------------ conforming joins


@query(
    "conform_dimension",
    """
WITH best AS (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY 1)
SELECT c_custkey, c_name, n_name, r_name, s_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN best ON c_nationkey = best.s_nationkey
LEFT JOIN supplier ON s_suppkey = best.k
""",
)
def conform_dimension(spark, t):
    """Customers with nation, region and one supplier of their nation; repeated lookup keys do not multiply rows."""
    suppliers = t("supplier").select("s_nationkey", "s_suppkey", "s_name")
    out = op.conform(
        t("customer"),
        [
            op.Lookup(t("nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "n_regionkey": "n_regionkey"}),
            op.Lookup(t("region"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}),
            op.Lookup(suppliers, {"c_nationkey": "s_nationkey"}, {"s_suppkey": "s_suppkey", "s_name": "s_name"}),
        ],
    )
    return out.select("c_custkey", "c_name", "n_name", "r_name", "s_name")


@query(
    "first_filled",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority WHEN o_orderstatus = 'O' THEN c_mktsegment
  ELSE c_name END AS label FROM orders JOIN customer ON o_custkey = c_custkey
""",
)
def first_filled(spark, t):
    joined = op.enrich(t("orders"), t("customer"), {"o_custkey": "c_custkey"}, ["c_mktsegment", "c_name"], "inner")
    first = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(F.lit("  "))
    second = F.when(F.col("o_orderstatus") == "O", F.col("c_mktsegment"))
    return joined.select("o_orderkey", fn.first_filled(first, second, F.col("c_name")).alias("label"))


BRIDGE_SQL = """
WITH b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50)
SELECT p_partkey, s_suppkey, s_name FROM part {0} JOIN b ON p_partkey = l_partkey {0} JOIN supplier ON l_suppkey = s_suppkey
"""


def part_bridge(t: Tables, how: str) -> DataFrame:
    bridge = t("lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    active = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)
    bridge = bridge.filter(active).select("l_partkey", "l_suppkey").distinct()
    out = op.bridge_lookup(
        t("part").select("p_partkey"),
        bridge,
        {"p_partkey": "l_partkey"},
        ["l_suppkey"],
        dim=t("supplier"),
        dim_on={"l_suppkey": "s_suppkey"},
        dim_columns=["s_suppkey", "s_name"],
        how=how,
    )
    return out.select("p_partkey", "s_suppkey", "s_name")


@query("bridge_lookup_left", BRIDGE_SQL.format("LEFT"))
def bridge_lookup_left(spark, t):
    return part_bridge(t, "left")


@query("bridge_lookup_inner", BRIDGE_SQL.format("INNER"))
def bridge_lookup_inner(spark, t):
    return part_bridge(t, "inner")


@query(
    "enrich_inner",
    """
SELECT l_orderkey, l_partkey, p_brand, s_name FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey WHERE p_type = 'ECONOMY'
""",
)
def enrich_inner(spark, t):
    parts = t("part").filter(F.col("p_type") == "ECONOMY")
    lines = op.enrich(t("lineitem"), parts, {"l_partkey": "p_partkey"}, ["p_brand"], "inner")
    lines = op.enrich(lines, t("supplier"), {"l_suppkey": "s_suppkey"}, ["s_name"], "inner")
    return lines.select("l_orderkey", "l_partkey", "p_brand", "s_name")


@query(
    "enrich_left",
    """
SELECT l_orderkey, l_partkey, p_brand FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type = 'ECONOMY')
  ON l_partkey = p_partkey
""",
)
def enrich_left(spark, t):
    parts = t("part").filter(F.col("p_type") == "ECONOMY")
    lines = op.enrich(t("lineitem"), parts, {"l_partkey": "p_partkey"}, ["p_brand"])
    return lines.select("l_orderkey", "l_partkey", "p_brand")


@query(
    "enrich_salted",
    """
WITH d AS (SELECT l_suppkey AS k, max(l_shipdate) AS last FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(d.last AS DATE) AS last FROM lineitem JOIN d ON l_suppkey = d.k
""",
)
def enrich_salted(spark, t):
    """A skewed fact against a computed dimension: every key is spread over eight tasks."""
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", day("l_shipdate").alias("d"))
    last = lines.groupBy("l_suppkey").agg(F.max("d").alias("last"))
    return op.enrich(lines, last, ["l_suppkey"], ["last"], "inner", salt=8).drop("d")


@query(
    "role_lookup",
    """
SELECT o_orderkey, a.n_name AS customer_nation, b.n_name AS supplier_nation
FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey
""",
)
def role_lookup(spark, t):
    lines = op.enrich(t("lineitem"), t("orders"), {"l_orderkey": "o_orderkey"}, ["o_orderkey", "o_custkey"], "inner")
    lines = op.enrich(lines, t("customer"), {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    lines = op.enrich(lines, t("supplier"), {"l_suppkey": "s_suppkey"}, ["s_nationkey"], "inner")
    roles = {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"}
    named = op.role_lookup(lines, t("nation"), roles, "n_nationkey", "n_name")
    return named.select("o_orderkey", "customer_nation", "supplier_nation")


@query(
    "flag_present",
    """
SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 1 ELSE 0 END
  AS currentkpiindicator FROM orders
""",
)
def flag_present(spark, t):
    returned = t("lineitem").filter(F.col("l_returnflag") == "R")
    orders = t("orders").select("o_orderkey")
    return op.flag_present(orders, returned, {"o_orderkey": "l_orderkey"}, "currentkpiindicator")


@query(
    "allocate_goals",
    """
WITH goal AS (SELECT c_nationkey AS storenumber, CASE o_orderpriority WHEN '1-URGENT' THEN 'Gross Profit' WHEN '2-HIGH' THEN 'WTR'
    ELSE o_orderpriority END AS kpiname, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS goalvalue,
    CAST(max(o_orderdate) AS DATE) AS report_date
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
heads AS (SELECT c_nationkey AS storenumber, count(*) AS approved_headcount FROM customer GROUP BY 1)
SELECT g.report_date, c_custkey AS sourceemployeeid, g.kpiname, 4 AS companycd, c_name AS employeename,
  CAST(round(CAST(CASE WHEN kpiname = 'Gross Profit' THEN CASE WHEN c_acctbal < 0 THEN 7000.0 ELSE 10000.0 END
    WHEN kpiname = 'WTR' THEN goalvalue WHEN c_acctbal < 0 THEN goalvalue / approved_headcount * 0.75
    ELSE goalvalue / approved_headcount END AS DECIMAL(28,8)), 2) AS DOUBLE) AS goalvalue
FROM customer JOIN goal g ON c_nationkey = g.storenumber JOIN heads h ON c_nationkey = h.storenumber
""",
)
def allocate_goals(spark, t):
    """Nation goals to their customers: 'part-time' are those in debt.

    Goals are rounded half up in decimal (646669.205 is 646669.21); the SQL says so, its binary rounding would not.
    """
    customers = t("customer")
    orders = op.enrich(t("orders"), customers, {"o_custkey": "c_custkey"}, {"c_nationkey": "storenumber"}, "inner")
    kpi = fn.recode("o_orderpriority", {"1-URGENT": "Gross Profit", "2-HIGH": "WTR"})
    goals = (
        orders.withColumn("kpiname", kpi)
        .groupBy("storenumber", "kpiname")
        .agg(exact(F.col("o_totalprice")).alias("goalvalue"), F.max(day("o_orderdate")).alias("report_date"))
    )
    bridge = customers.select(
        F.col("c_nationkey").alias("storenumber"), F.col("c_custkey").alias("sourceemployeeid"), F.lit(4).alias("companycd")
    )
    employees = customers.select(
        F.col("c_custkey").alias("sourceemployeeid"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") < 0).cast("int").alias("parttimeindicator"),
    )
    heads = customers.groupBy(F.col("c_nationkey").alias("storenumber")).agg(F.count(F.lit(1)).alias("approved_headcount"))
    return op.allocate_goals(goals, bridge, employees, heads)


@query(
    "union_sources",
    """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""",
)
def union_sources(spark, t):
    """A source that lacks columns is padded with nulls."""
    customers = op.project(t("customer"), {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"})
    return op.union_sources(customers, op.project(t("supplier"), {"id": "s_suppkey", "name": "s_name", "balance": "s_acctbal"}))


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, t):
    customers = op.project(t("customer"), {"nation": "c_nationkey"})
    return op.union_sources(customers, op.project(t("supplier"), {"nation": "s_nationkey"}), distinct=True)


@query(
    "special_members",
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT 0, 'General Location', NULL, NULL, NULL UNION ALL SELECT -2, 'Unknown', NULL, NULL, NULL
""",
)
def special_members(spark, t):
    rows = [{"c_custkey": 0, "c_name": "General Location"}, {"c_custkey": -2, "c_name": "Unknown"}]
    return op.with_special_members(t("customer"), rows)


@query(
    "unknown_reference",
    """
SELECT l_orderkey, l_linenumber, coalesce(p_size, -2) AS size FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40)
  ON l_partkey = p_partkey
""",
)
def unknown_reference(spark, t):
    parts = t("part").filter(F.col("p_size") < 40)
    lines = op.enrich(t("lineitem"), parts, {"l_partkey": "p_partkey"}, ["p_size"])
    return lines.select("l_orderkey", "l_linenumber", fn.unknown_if_null("p_size").alias("size"))


HIER_BLANKS = ", ".join(f"'' AS lvl_{i}_cd, '' AS lvl_{i}_nm" for i in range(4, 7))


@query(
    "level_hierarchy",
    f"""
SELECT DISTINCT r_name || '|' || n_name AS hier_id, 'Geography' AS hier_nm, r_name AS lvl_1_cd, r_name AS lvl_1_nm,
  n_name AS lvl_2_cd, n_name AS lvl_2_nm, '' AS lvl_3_cd, '' AS lvl_3_nm, {HIER_BLANKS}
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT DISTINCT p_brand || '|' || p_type || '|' || p_size, 'Product', p_brand, p_brand, p_type, p_type,
  CAST(p_size AS VARCHAR), CAST(p_size AS VARCHAR), {HIER_BLANKS} FROM part WHERE p_type <> 'SMALL'
""",
)
def level_hierarchy(spark, t):
    """Two hierarchies of different depth from dimension rows; rows with a blank level are left out."""
    places = op.enrich(t("customer"), t("nation"), {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    places = op.enrich(places, t("region"), {"n_regionkey": "r_regionkey"}, ["r_name"])
    kind = F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_type"))
    parts = t("part").withColumns({"kind": kind, "size": F.col("p_size").cast("string")})
    return op.level_hierarchy(
        [
            op.LevelSource(places, "Geography", ["r_name", "n_name"]),
            op.LevelSource(parts, "Product", ["p_brand", "kind", "size"]),
        ]
    )


@query(
    "manager_hierarchy",
    """
WITH d AS (SELECT DISTINCT r_name || '|' || n_name AS hier_id, 'W' || r_regionkey AS m1, 'W' || n_nationkey AS m2
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
e AS (SELECT 'W' || s_suppkey AS workdayid, s_name AS id FROM supplier WHERE s_acctbal > 0)
SELECT hier_id, a.id AS lvl_1_src_mgr_id, b.id AS lvl_2_src_mgr_id, '' AS lvl_3_src_mgr_id, '' AS lvl_4_src_mgr_id,
  '' AS lvl_5_src_mgr_id, '' AS lvl_6_src_mgr_id
FROM d LEFT JOIN e a ON m1 = a.workdayid LEFT JOIN e b ON m2 = b.workdayid
""",
)
def manager_hierarchy(spark, t):
    places = op.enrich(t("customer"), t("nation"), {"c_nationkey": "n_nationkey"}, ["n_name", "n_nationkey", "n_regionkey"])
    places = op.enrich(places, t("region"), {"n_regionkey": "r_regionkey"}, ["r_name", "r_regionkey"])
    places = places.withColumns({"m1": F.concat(F.lit("W"), "r_regionkey"), "m2": F.concat(F.lit("W"), "n_nationkey")})
    employees = t("supplier").select(
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("W"), "s_suppkey")).otherwise(F.lit("")).alias("workdayid"),
        F.col("s_name").alias("sourceemployeeid"),
    )
    return op.manager_hierarchy(places, ["r_name", "n_name"], ["m1", "m2"], employees)


@query(
    "with_hierarchy_id",
    "SELECT p_partkey, p_brand || '|' || p_type || '|' || p_size AS store_hier_id FROM part",
)
def with_hierarchy_id(spark, t):
    return op.with_hierarchy_id(t("part"), ["p_brand", "p_type", "p_size"], "store_hier_id").select("p_partkey", "store_hier_id")


@query(
    "sales_measures",
    """
SELECT l_orderkey, l_linenumber, CAST(l_quantity * p_retailprice AS DECIMAL(18,2)) AS saleamount,
  CAST(l_quantity * p_retailprice - l_quantity * l_extendedprice AS DECIMAL(18,2)) AS rawgrossprofit
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
)
def sales_measures(spark, t):
    lines = op.enrich(t("lineitem"), t("part"), {"l_partkey": "p_partkey"}, ["p_retailprice"], "inner")
    out = op.sales_measures(lines, "l_quantity", "p_retailprice", "l_extendedprice")
    money = [F.col(c).cast("decimal(18,2)").alias(c) for c in ("saleamount", "rawgrossprofit")]
    return out.select("l_orderkey", "l_linenumber", *money)


@query("split_sensitive_profile", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def split_sensitive_profile(spark, t):
    return op.split_sensitive(t("customer"), ["c_custkey"], ["c_name", "c_acctbal"])[0]


@query("split_sensitive_contact", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def split_sensitive_contact(spark, t):
    return op.split_sensitive(t("customer"), ["c_custkey"], ["c_name", "c_acctbal"])[1]


@query(
    "project_delivery_names",
    """
SELECT o_orderkey AS "ORD_ID", CAST(o_orderdate AS DATE) AS "ORD_DT", 4 AS "CO_CD", 'RQ4' AS "SRC_SYS_NM" FROM orders
""",
)
def project_delivery_names(spark, t):
    orders = op.rename(t("orders"), {"o_orderkey": "order_id"}).drop("o_totalprice")
    orders = op.with_constants(orders, {"companycd": 4, "source": "RQ4"})
    return op.project(
        orders, {"ORD_ID": "order_id", "ORD_DT": day("o_orderdate"), "CO_CD": "companycd", "SRC_SYS_NM": "source"}
    )


# ---------------------------------------------------------------------------- files, snapshots, streams


def text_file(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)


@query(
    "read_csv_typed",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'",
)
def read_csv_typed(spark, t):
    """Declared schema, renamed columns and noise rows in one scan over many files."""
    path = f"{scratch(spark)}/orders"
    text_file(t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), path)
    spec = src.FeedSpec(
        "orders",
        schema="`Order Id` long, Customer long, State string, Total double, Priority string",
        columns={
            "Order Id": "o_orderkey",
            "Customer": "o_custkey",
            "State": "o_orderstatus",
            "Total": "o_totalprice",
            "Priority": "o_orderpriority",
        },
        noise={"Priority": ["5-%"]},
    )
    return src.read_csv(spark, path, spec)


@query("read_csv_text", "SELECT doc_id, md5(text) AS digest, lang FROM documents")
def read_csv_text(spark, t):
    """Whole documents through quoted, multi-line CSV."""
    path = f"{scratch(spark)}/documents"
    quoted = t("documents").select("doc_id", "text", "lang")
    quoted.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    plain = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    spec = src.FeedSpec("documents", schema="doc_id long, text string, lang string", multiline=True, options=plain)
    return src.read_csv(spark, path, spec).select("doc_id", F.md5("text").alias("digest"), "lang")


@query(
    "read_report_roundtrip",
    "SELECT CAST(c_custkey AS VARCHAR) AS \"Store\", c_name AS \"Store_Name\", c_mktsegment AS \"ATT_Region\" FROM customer",
)
def read_report_roundtrip(spark, t):
    """Title lines before the header and a header line repeated in every part file."""
    path = f"{scratch(spark)}/report"
    rows = t("customer").select(
        F.col("c_custkey").alias("Store #"), F.col("c_name").alias("Store Name"), F.col("c_mktsegment").alias("AT&T Region")
    )
    titles = spark.createDataFrame([("Weekly Tracker,,",), (",,",), ("Store #,Store Name,AT&T Region",)], "value string")
    titles.coalesce(1).write.mode("overwrite").text(f"{path}/titles")
    text_file(rows, f"{path}/rows")
    head = src.first_lines(spark, f"{path}/titles", 3)
    names = src.clean_names(head[2], {" #": "", " ": "_", "AT&T": "ATT"})
    return src.read_report(spark, [f"{path}/titles", f"{path}/rows"], names, head)


@query(
    "two_row_header",
    """
SELECT CAST(p_partkey AS VARCHAR) AS "Store", 'Price' AS adjustmenttype, 'Retail' AS adjustmentcategory,
  CAST(p_retailprice AS DECIMAL(18,2)) AS amount FROM part
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'Stock', 'Size', CAST(p_size AS DECIMAL(18,2)) FROM part
""",
)
def two_row_header(spark, t):
    """Type over category in two header lines, melted to rows."""
    root = scratch(spark)
    head = spark.createDataFrame([("18-Jan,Price,Stock",), ("Store, Retail,Size ",)], "value string")
    head.coalesce(1).write.mode("overwrite").text(f"{root}/head")
    rows = t("part").select(F.concat_ws(",", F.col("p_partkey"), F.col("p_retailprice"), F.col("p_size")).alias("value"))
    names = src.merged_header(spark, f"{root}/head")
    rows.write.mode("overwrite").text(f"{root}/rows")
    report = spark.read.schema(src.text_schema(names)).csv(f"{root}/rows")
    return op.unpivot_measures(
        report,
        ["Store"],
        value_col="amount",
        value_type="decimal(18,2)",
        name_parts=["adjustmenttype", "adjustmentcategory"],
        sep="|",
    )


@query(
    "with_file_date",
    """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y%m') || '01', '%Y%m%d')::DATE AS reportdate FROM orders
""",
)
def with_file_date(spark, t):
    """The report date is part of the path; here one folder per month."""
    path = f"{scratch(spark)}/dated"
    orders = t("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("m"))
    orders.write.mode("overwrite").partitionBy("m").option("header", True).csv(path)
    rows = spark.read.option("header", True).schema("o_orderkey long, m string").csv(path)
    dated = src.with_file_date(rows, r"m=(\d{6})", "yyyyMM", source="file_path")
    return dated.select("o_orderkey", "reportdate")


@query(
    "route_files",
    """
SELECT url, CASE WHEN url LIKE 'https://m.%' THEN 'mobile' WHEN url LIKE 'https://%' THEN 'secure' WHEN url LIKE 'http://%'
  THEN 'plain' END AS dataset, CASE WHEN url LIKE 'https://%' THEN 'restricted' ELSE 'regular' END AS sensitivity FROM pages
""",
)
def route_files(spark, t):
    """Longest matching prefix decides; page addresses stand for file names."""
    files = t("pages").select(F.col("url").alias("file_name"))
    rules = {"http://": "plain", "https://": "secure", "https://m.": "mobile"}
    return src.route_files(files, rules, {"https://": "restricted"}).withColumnRenamed("file_name", "url")


@query(
    "file_inventory",
    """
SELECT l_returnflag AS part, 'l_orderkey|l_linenumber|l_quantity' AS header FROM lineitem GROUP BY 1
""",
)
def file_inventory(spark, t):
    """Header columns of every landed file, one folder per return flag."""
    path = f"{scratch(spark)}/landing"
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    lines.write.mode("overwrite").partitionBy("l_returnflag").option("header", True).csv(path)
    found = src.file_inventory(spark, path).filter(F.col("file_name").endswith(".csv") & (F.col("size") > 0))
    part = F.regexp_extract("path", r"l_returnflag=(\w)", 1)
    return found.select(part.alias("part"), F.array_join("columns", "|").alias("header")).distinct()


@query(
    "validate_files",
    """
SELECT l_linestatus AS part, CASE l_linestatus WHEN 'F' THEN 'missing columns: l_tax' ELSE '' END AS reasons,
  l_linestatus <> 'F' AS ok FROM lineitem GROUP BY 1
""",
)
def validate_files(spark, t):
    root = scratch(spark)
    for flag, cols in (("F", ["l_orderkey", "l_quantity"]), ("O", ["l_orderkey", "l_quantity", "l_tax"])):
        rows = t("lineitem").filter(F.col("l_linestatus") == flag).select(*cols)
        text_file(rows, f"{root}/status={flag}")
    verdicts = src.validate_files(spark, root, extension=".csv", required=["l_orderkey", "l_tax"], min_columns=2)
    part = F.regexp_extract("path", r"status=(\w)", 1).alias("part")
    return verdicts.select(part, F.array_join("reasons", "; ").alias("reasons"), "ok").distinct()


def report_files(rows: DataFrame, head: list[str], path: str, name: str = "part") -> None:
    """CSV lines of ``rows``, each file beginning with the lines of ``head``; ``name`` begins the names of the files."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # of its partition, which becomes one file
    value = F.when(first, F.concat(F.lit("\n".join(head) + "\n"), line)).otherwise(line)
    rows.select(value.alias("value")).write.option("mapreduce.output.basename", name).text(path)


@query(
    "mixed_layout_reports",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS priority,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS customer,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN DATE '2018-01-07' ELSE DATE '2018-02-11' END AS reportdate FROM orders
""",
)
def mixed_layout_reports(spark, t):
    """Reports of two layouts (order and set of columns, title lines) in one folder; each file's header, in line 3, binds it."""
    root = scratch(spark)
    orders = t("orders")
    report_files(
        orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", "o_orderpriority"),
        ["Orders of January,,", ",,", "Order Id,Customer,Priority"],
        f"{root}/a",
        "orders.20180107",
    )
    report_files(
        orders.filter("o_orderkey % 2 = 1").select("o_orderpriority", "o_orderstatus", "o_orderkey"),
        ["Orders of February,,", "draft,,", "Priority,Status,Order Id"],
        f"{root}/b",
        "orders.20180211",
    )
    names = lambda head: src.clean_names(head[2], {" ": "_"}, lower=True)
    paths = src.accepted_paths(src.validate_files(spark, root, required=["Order Id"], header_line=2))
    rows = src.read_reports(spark, paths, 3, names, file_date=(r"\.(\d{8})", "yyyyMMdd"))
    return rows.select("order_id", "priority", "customer", "status", "reportdate")


@query(
    "rejected_files",
    """
SELECT CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'too few columns' WHEN 2 THEN 'file date'
    ELSE 'extension; missing columns: o_custkey; too few columns; file date' END AS reasons,
  count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1
""",
)
def rejected_files(spark, t):
    """Files that fail on extension, columns or date; the rows of every file counted under its file's verdict."""
    root = scratch(spark)
    orders = t("orders")
    kinds = [
        (["o_orderkey", "o_custkey", "o_orderdate"], "orders.20180107", "csv"),
        (["o_orderkey", "o_custkey"], "orders.20180107", "csv"),
        (["o_orderkey", "o_custkey", "o_orderdate"], "orders.soon", "csv"),
        (["o_orderkey"], "orders.notes", "text"),
    ]
    for i, (columns, name, kind) in enumerate(kinds):
        rows = orders.filter(F.col("o_orderkey") % 4 == i).select(*columns)
        if kind == "csv":
            rows.write.option("mapreduce.output.basename", name).option("header", True).csv(f"{root}/{i}")
        else:
            report_files(rows, columns, f"{root}/{i}", name)
    verdicts = src.validate_files(
        spark, root, extension=".csv", required=["o_orderkey", "o_custkey"], min_columns=3,
        date_pattern=(r"\.(\d{8})", "yyyyMMdd"),
    ).select(src.path_key(F.col("path")).alias("file"), F.array_join("reasons", "; ").alias("reasons"))
    lines = spark.read.option("recursiveFileLookup", "true").text(root).select(
        src.path_key(F.col("_metadata.file_path")).alias("file"),
        F.split_part("value", F.lit(","), F.lit(1)).try_cast("long").alias("key"),
    )
    per_file = lines.filter(F.col("key").isNotNull()).groupBy("file").agg(F.count("*").alias("n"), F.sum("key").alias("k"))
    found = per_file.join(verdicts, "file", "left").groupBy("reasons")
    return found.agg(F.sum("n").alias("n_rows"), F.sum("k").alias("keys"))


@query(
    "snapshot_history",
    f"""{book_sql(BEFORE_CUT, ALL_TIME)}
SELECT o_custkey, o_orderpriority, n_orders, '2000' AS snapshot_id FROM prev
UNION ALL SELECT o_custkey, o_orderpriority, n_orders, '2001' FROM curr""",
)
def snapshot_history(spark, t):
    store = src.Snapshots(spark, f"{scratch(spark)}/book")
    store.write(order_book(t("orders"), *BEFORE_CUT), "2000", date(2000, 12, 31))
    store.write(order_book(t("orders")), "2001", date(2001, 12, 31))
    return store.history().select("o_custkey", "o_orderpriority", "n_orders", "snapshot_id")


@query(
    "write_if_changed",
    f"""{book_sql(BEFORE_CUT, ALL_TIME)}
SELECT {BOOK_COLS}, CASE WHEN p.o_custkey IS NULL THEN 'I' ELSE 'C' END AS cdc_ind_cd
FROM curr c LEFT JOIN prev p ON {MATCH} WHERE p.o_custkey IS NULL OR NOT ({SAME})""",
)
def write_if_changed(spark, t):
    """An unchanged run stores nothing; the delta is taken from the two newest stored snapshots."""
    store = src.Snapshots(spark, f"{scratch(spark)}/book")
    old, new = order_book(t("orders"), *BEFORE_CUT), order_book(t("orders"))
    store.write_if_changed(old, BOOK_KEYS, "1", date(2000, 12, 31))
    store.write_if_changed(old, BOOK_KEYS, "2", date(2001, 1, 31))
    store.write_if_changed(new, BOOK_KEYS, "3", date(2001, 12, 31))
    store.write_if_changed(new, BOOK_KEYS, "4", date(2002, 1, 31))
    current, previous = store.latest_two()
    return op.delta(previous, current, BOOK_KEYS)


@query(
    "deliver_roundtrip",
    """
SELECT c_custkey AS "SRC_CUST_ID", c_name AS "NM", c_acctbal AS "BAL" FROM customer
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer
""",
)
def deliver_roundtrip(spark, t):
    """Two quoted deliveries: the log holds both."""
    path = scratch(spark)
    columns = {"SRC_CUST_ID": "c_custkey", "NM": "c_name", "BAL": "c_acctbal"}
    for _ in range(2):
        src.deliver(t("customer"), path, columns, quote_all=True)
    return src.read_delivery(spark, f"{path}/Previous", "SRC_CUST_ID long, NM string, BAL double")


@query(
    "ingest_stream",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'",
)
def ingest_stream_events(spark, t):
    """Event files through the file stream, several micro-batches, each row exactly once."""
    root = scratch(spark)
    text_file(t("events").select("event_id", "user_id", "event_type", "value").repartition(4), f"{root}/landing")
    spec = src.FeedSpec(
        "events",
        schema="event_id long, user_id long, event_type string, value double",
        noise={"event_type": ["error"]},
    )
    stream = ingest_stream(spark, f"{root}/landing", spec, f"{root}/raw", f"{root}/checkpoint", max_files=2)
    stream.awaitTermination()
    return spark.read.parquet(f"{root}/raw").drop("batch_id")


# ------------------------------------------------------------------- stores that survive runs and re-runs

ORDER_COLUMNS = ["o_custkey", "o_orderkey", "o_orderstatus"]
NEWEST_ORDER = "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1"


@query("merge_by_buckets", NEWEST_ORDER)
def merge_by_buckets(spark, t):
    """The newest order per customer: a first load, a merge of what followed, and the same merge started again."""
    orders = t("orders").select(*ORDER_COLUMNS, day("o_orderdate").alias("o_orderdate"))
    old = F.col("o_orderdate") < F.lit(CUT).cast("date")
    table = src.BucketedTable(spark, scratch(spark), ["o_custkey"], 16)
    newest = ["o_orderdate", "o_orderkey"]
    table.merge(orders.filter(old), newest, "run1")
    for _ in range(2):
        table.merge(orders.filter(~old), newest, "run2")
    return table.read().select(*ORDER_COLUMNS)


@query(
    "manifest_runs",
    """
SELECT l_returnflag AS part, CASE WHEN l_returnflag = 'N' THEN 'run2' ELSE 'run1' END AS run_id, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2 UNION ALL SELECT 'A', 'run2', count(*) FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 25
""",
)
def manifest_runs(spark, t):
    """Rows each run takes in: the second sees a new file and one that was landed again with other content."""
    root = scratch(spark)
    lines = t("lineitem").select("l_returnflag", "l_orderkey", "l_quantity")
    manifest, taken = src.Manifest(spark, f"{root}/manifest"), []

    def land(flag: str, rows: DataFrame) -> None:
        rows.where(F.col("l_returnflag") == flag).drop("l_returnflag").write.mode("overwrite").csv(f"{root}/raw/{flag}", header=True)

    def run(run_id: str) -> None:
        new = manifest.pending(src.list_files(spark, f"{root}/raw"), run_id)
        paths = [r.path for r in new.select("path").toLocalIterator()]
        rows = spark.read.csv(paths, header=True, schema="l_orderkey long, l_quantity double")
        rows = rows.select(F.regexp_extract("_metadata.file_path", "/raw/([A-Z])/", 1).alias("part"), F.lit(run_id).alias("run_id"))
        rows.write.parquet(f"{root}/rows/{run_id}")
        manifest.record(new.withColumn("ok", F.lit(True)), run_id)
        taken.append(spark.read.parquet(f"{root}/rows/{run_id}"))

    for flag in "AR":
        land(flag, lines)
    run("run1")
    land("N", lines)
    land("A", lines.where("l_quantity > 25"))
    run("run2")
    return taken[0].union(taken[1]).groupBy("part", "run_id").agg(F.count("*").alias("n_rows"))


@query(
    "split_stored_sides",
    RULES_SQL
    + """ SELECT o_orderkey, NOT (low OR part OR urg) AS good, concat_ws('|', CASE WHEN low THEN 'store_number' END,
  CASE WHEN part THEN 'open_date' END, CASE WHEN urg AND part THEN 'priority' END, CASE WHEN urg AND NOT part THEN 'amount' END) AS failed_rules
FROM r""",
)
def split_stored_sides(spark, t):
    """Both sides of a split that scans its input once."""
    good, bad = op.split_stored(order_report(t("orders")), report_rules())
    bad = bad.select("o_orderkey", F.lit(False).alias("good"), F.concat_ws("|", "failed_rules").alias("failed_rules"))
    return good.select("o_orderkey", F.lit(True).alias("good"), F.lit("").alias("failed_rules")).unionByName(bad)


@query(
    "deliver_rerun",
    "SELECT r_regionkey, r_name, run_id FROM region, (SELECT 'run1' AS run_id UNION ALL SELECT 'run2') WHERE run_id = 'run1' OR r_regionkey > 2",
)
def deliver_rerun(spark, t):
    """The log of two deliveries, the first of which was made twice."""
    root, regions = scratch(spark), t("region").select("r_regionkey", "r_name")
    for run_id, rows in (("run1", regions), ("run1", regions), ("run2", regions.where("r_regionkey > 2"))):
        src.deliver(rows, root, run_id=run_id)
    kind = dict(regions.dtypes)["r_regionkey"]
    return src.read_delivery(spark, f"{root}/Previous", f"r_regionkey {kind}, r_name string, run_id string")
