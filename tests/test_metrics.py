from datetime import date

import pytest
from conftest import rows

from tiermill.functions import register_sql_functions
from tiermill.plans import Metric, MetricEngine, parse_depends, publish_catalog, publish_values, read_catalog

DIMS = {"store": "string", "emp": "int"}


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [("1", 11, 2, 10.0, "A"), ("1", 11, 1, 5.0, "B"), ("1", 12, 4, 1.0, "A"), ("2", 13, 1, None, "B")],
        "store string, emp int, qty int, amount double, kind string",
    )


def run(spark, metrics, sales, dims=DIMS, **kw):
    return MetricEngine(spark, metrics, {"sales": sales}, dims, **kw).run()


def test_fused_groups_equal_separate_queries(spark, sales):
    by = "store, emp"
    metrics = [
        Metric("Amount", "sum(amount)", "sales", by),
        Metric("Lines", "count(*)", "sales", by),
        Metric("A Lines", "count(*)", "sales", by, filter="WHERE kind = 'A'"),
        Metric("A Amount", "sum(amount)", "sales", by, filter="where  kind = 'A'"),
        Metric("B Price", "sum(amount) / sum(qty)", "sales", by, filter="WHERE kind = 'B'"),
        Metric("B Lines", "count(*)", "sales", by, filter="WHERE kind = 'B'"),
    ]
    fused, apart = run(spark, metrics, sales), run(spark, metrics, sales, fuse=False)
    assert rows(fused) == rows(apart)
    # A group without a matching row has no count of zero, and null values are dropped.
    assert rows(fused.filter("kpiname = 'A Lines'"), "emp", "kpivalue") == [(11, 1.0), (12, 1.0)]
    assert rows(fused.filter("kpiname = 'Amount'"), "emp") == [(11,), (12,)]
    assert fused.groupBy("store", "emp", "kpiname").count().filter("count > 1").isEmpty()


def test_scans_per_group(spark, sales, tmp_path):
    sales.write.parquet(f"{tmp_path}/sales")
    stored = spark.read.parquet(f"{tmp_path}/sales")
    metrics = [
        Metric(f"m{i}", "sum(amount)", "sales", "store", filter=f"WHERE qty > {i}" if i else "") for i in range(6)
    ]
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    dims = {"store": "string"}
    assert count(run(spark, metrics, stored, dims)) == 1
    assert count(run(spark, metrics, stored, dims, fuse=False)) == 6


def test_scans_are_bounded(spark, sales):
    metrics = [Metric(f"d{i}", f"count(DISTINCT emp + {i})", "sales", "store") for i in range(9)]
    engine = MetricEngine(spark, metrics, {"sales": sales}, {"store": "string"})
    assert [len(g) for g in engine._groups(metrics)] == [4, 4, 1]
    many = [Metric(f"m{i}", f"sum(qty + {i})", "sales", "store") for i in range(130)]
    wide = MetricEngine(spark, many, {"sales": sales}, {"store": "string"})
    assert [len(g) for g in wide._groups(many)] == [64, 64, 2]
    assert wide.run().count() == 260


def test_levels_with_own_company_and_filter(spark, sales):
    metrics = [
        Metric("Amount", "sum(amount)", "sales", "store, emp"),
        Metric("Qty", "sum(qty)", "sales", "store, emp", company_cd=5),
        Metric("Price", "max(a.kpivalue / q.kpivalue)", "A a JOIN Q q ON a.emp = q.emp", "a.store, a.emp", level=1,
               company_cd=6, depends=(("Amount", "A"), ("Qty", "Q"))),
        Metric("High", "max(p.kpivalue)", "P p", "p.store", filter="WHERE p.kpivalue > 1", level=2, company_cd=7,
               depends=(("Price", "P"),)),
    ]
    out = run(spark, metrics, sales)
    assert rows(out.filter("kpiname = 'Price'"), "store", "emp", "kpivalue", "companycd") == [("1", 11, 5.0, 6), ("1", 12, 0.25, 6)]
    assert rows(out.filter("kpiname = 'High'"), "store", "emp", "kpivalue", "companycd") == [("1", None, 5.0, 7)]


def test_column_order_does_not_matter(spark, sales):
    metrics = [Metric("A", "sum(qty)", "sales", "emp, store"), Metric("B", "sum(qty)", "sales", "store, emp")]
    out = run(spark, metrics, sales)
    assert rows(out.filter("kpiname = 'A'"), "store", "emp", "kpivalue") == rows(
        out.filter("kpiname = 'B'"), "store", "emp", "kpivalue"
    )


def test_global_and_distinct(spark, sales):
    out = run(spark, [Metric("N", "count(distinct emp)", "sales"), Metric("None", "count(*)", "sales", filter="WHERE qty > 99")], sales)
    assert rows(out) == [(None, None, "N", 3.0, 4), (None, None, "None", 0.0, 4)]


def test_catalogue_errors(spark, sales):
    def build(*metrics):
        return MetricEngine(spark, metrics, {"sales": sales}, DIMS)

    with pytest.raises(ValueError, match="duplicate"):
        build(Metric("A", "1", "sales"), Metric("A", "1", "sales"))
    with pytest.raises(ValueError, match="unknown"):
        build(Metric("A", "1", "X", depends=(("B", "X"),)))
    with pytest.raises(ValueError, match="each other"):
        build(Metric("A", "1", "B", depends=(("B", "B"),)), Metric("B", "1", "A", depends=(("A", "A"),)))
    with pytest.raises(ValueError, match="A"):
        build(Metric("A", "sum(nothing)", "sales", "store")).run()
    with pytest.raises(ValueError, match="not dimensions"):
        build(Metric("A", "sum(qty)", "sales", "kind, qty")).run()


def test_views_do_not_leak(spark, sales):
    spark.range(3).createOrReplaceTempView("sales")
    run(spark, [Metric("N", "count(*)", "sales")], sales).collect()
    assert spark.table("sales").count() == 3
    spark.catalog.dropTempView("sales")
    run(spark, [Metric("N", "count(*)", "sales")], sales).collect()
    assert not spark.catalog.tableExists("sales")


def test_single_call():
    def single(e):
        return Metric("m", e, "t").single_call

    assert single("sum(a * (b - c))") and single("count(DISTINCT x)")
    assert not single("sum(a) / count(*)") and not single("(sum(a))") and not single("round(sum(a), 2)")
    assert not single("sum(case when k = ')' then 1 end)")


CATALOG = """KPIName,Companycd,Classification,Description,Expression,FilterCondition,FromClause,GroupByColumns,CalculationLevel,CalculationIndicator,PublishIndicator,PrimaryIndicator,LveTableName
Amount,4,Sales,All,sum(saleamount),,SalesDetails,"storenumber,sourceemployeeid,getOnlyDate(invoicedate)",0,Y,Y,Y,
Units,4,Sales,All,sum(quantity),WHERE quantity > 0,SalesDetails,"storenumber,sourceemployeeid,getOnlyDate(invoicedate)",0,Y,Y,Y,
Price,4,Sales,Ratio,max(a.kpivalue/b.kpivalue),,AA a inner join BB b on a.storenumber=b.storenumber and a.report_date=b.report_date,"a.storenumber,a.sourceemployeeid,a.report_date",1,Y,Y,Y,"Amount=AA,Units=BB"
"""


def test_stored_catalogue(spark, write):
    register_sql_functions(spark)
    table = spark.read.option("header", True).csv(write("kpi.csv", CATALOG))
    metrics = read_catalog(table)
    assert metrics[2].depends == parse_depends("Amount=AA,Units=BB") == (("Amount", "AA"), ("Units", "BB"))
    details = spark.createDataFrame(
        [(101, 11, "2018-01-07 10:00:00", 20.0, 2), (101, 11, "2018-01-07 12:00:00", -5.0, -1)],
        "storenumber int, sourceemployeeid int, invoicedate string, saleamount double, quantity int",
    )
    out = MetricEngine(spark, metrics, {"SalesDetails": details}).run()
    day = date(2018, 1, 7)
    assert rows(out, "kpiname", "storenumber", "sourceemployeeid", "report_date", "kpivalue") == [
        ("Amount", "101", 11, day, 15.0), ("Price", "101", 11, day, 7.5), ("Units", "101", 11, day, 2.0),
    ]
    assert len(publish_catalog(table).columns) == 15
    assert publish_values(out).first().RPT_DT == "2018/01/07"
