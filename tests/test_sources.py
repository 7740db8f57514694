import csv
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiermill import operators as op
from tiermill import sources as src
from tiermill.sources import files
from tiermill.streaming import ingest_stream


def test_csv_options(spark, write):
    path = write("a.csv", 'Store,Note\n 101 ,"two\nlines, ""quoted"""\n205,\n')
    df = src.read_csv(spark, path, src.FeedSpec("a", multiline=True, columns={"Store": "store"}))
    assert df.dtypes == [("store", "string"), ("Note", "string")]
    assert rows(df) == [("101", 'two\nlines, "quoted"'), ("205", None)]
    inferred = src.read_csv(spark, path, src.FeedSpec("a", multiline=True, infer=True))
    assert inferred.dtypes[0] == ("Store", "int")


def test_declared_schema_is_positional(spark, write):
    path = write("actuals_Dec.csv", "Location,Dec 2017 Actual\nOak,12\nbad,x\n")
    df = src.read_csv(spark, path, src.FeedSpec("a", schema="place string, actual int"))
    assert rows(df) == [("Oak", 12), ("bad", None)]


def test_headerless(spark, write):
    path = write("t.csv", '7,"Oak, Mall",101\n8,Main,x\n')
    df = src.read_csv(spark, path, src.FeedSpec("t", schema="id string, name string, store string", header=False))
    typed = src.cast_columns(df, {"id": "int", "store": "int"})
    assert rows(typed) == [(7, "Oak, Mall", 101), (8, "Main", None)]


def test_many_files_with_file_dates_and_noise(spark, write, tmp_path):
    write("in/report.20180107.csv", "Location,V\nGenerated by X,\nOak,1\n")
    write("in/report.20180108.csv", "Location,V\nOak,2\n,9\n")
    write("in/report.soon.csv", "Location,V\nMain,3\n")
    spec = src.FeedSpec("r", noise={"Location": ["Generated%"]}, file_date=(r"\.(\d{8})", "yyyyMMdd"))
    df = src.read_csv(spark, f"{tmp_path}/in", spec)
    assert rows(df) == [("Main", "3", None), ("Oak", "1", date(2018, 1, 7)), ("Oak", "2", date(2018, 1, 8))]


def test_headers(spark, write):
    path = write("g.csv", 'Column1,,\nDate, Store ,"GP / Unit",\n1/7/2018,101,5,\n')
    assert src.header_at(spark, path, 1) == ["Date", " Store ", "GP / Unit", ""]
    assert src.clean_names(src.header_at(spark, path, 1), {" ": "_", "/": "1"}) == ["Date", "Store", "GP_1_Unit"]
    assert src.clean_names(["Café #\r", "A&T"], {"&": "_"}, lower=True) == ["caf #", "a_t"]
    with pytest.raises(ValueError):
        src.header_at(spark, path, 9)
    two = write("two.csv", "18-Jan,,GP,GP\nMarket, Loc ,Rebate,New % \nM,101,5,12%\n")
    assert src.merged_header(spark, two) == ["Market", "Loc", "GP|Rebate", "GP|New %"]


def test_report_with_preamble(spark, write):
    path = write("m.csv", 'Title,,\n,,\nLoc,Name,"City, State"\n101,Main,"A, B"\n,,\nLoc,Name,"City, State"\n205,Oak,\n')
    head = src.first_lines(spark, path, 3)
    names = src.clean_names(head[2], {" ": "", ",": ""})
    df = src.read_report(spark, path, names, head)
    assert df.columns == ["Loc", "Name", "CityState"]
    assert rows(df) == [("101", "Main", "A, B"), ("205", "Oak", None)]


def test_heads_read_the_first_block_only(write, monkeypatch):
    path = write("big.csv", "a,b\r\nc,d\n" + "1,2\n" * 500_000)
    asked = []
    real = files._open

    class Counted:
        def __init__(self, stream):
            self.stream = stream

        def read(self, n):
            asked.append(n)
            return self.stream.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *error):
            self.stream.close()

    monkeypatch.setattr(files, "_open", lambda p: Counted(real(p)))
    assert files._first_lines(path, 2) == ["a,b", "c,d"] and sum(asked) == files.HEAD_BYTES
    long = write("long.csv", "x" * 200_000 + "\n2\n")
    assert [len(line) for line in files._first_lines(long, 5)] == [200_000, 1]
    assert files._first_lines("unknown-store://bucket/x.csv", 1) is None


def test_heads_of_files_only_spark_can_open(spark, write, tmp_path):
    write("u/a b+c.csv", "\ufeffx,y\n1,2\n")
    write("u/one.csv", "z")
    listed = src.list_files(spark, f"{tmp_path}/u")
    assert rows(src.file_heads(spark, listed, 2).select("lines")) == [(["x,y", "1,2"],), (["z"],)]
    scanned = files._scanned_lines(spark, [r.path for r in listed.collect()], 1)
    assert len(rows(scanned)) == 2 and ["z"] in [r.lines for r in scanned.collect()]
    hidden = listed.withColumn("path", F.replace("path", F.lit("file:/"), F.lit("file:///"))).limit(0)
    assert rows(src.file_heads(spark, hidden)) == [] and rows(src.file_headers(spark, hidden)) == []


def test_every_file_has_its_own_header(spark, write, tmp_path):
    write("r/a.20180107.csv", "Week 1,,\nLoc,Name,Amount\n101,Main,5\n")
    write("r/b.20180108.csv", 'Week 2,,\nAmount,Loc,"City, State"\n7,205,"A, B"\nAmount,Loc,"City, State"\n')
    write("r/c.20180109.csv", "Week 3,,\nLoc,Name,Amount\n9,Week 1,\n")
    paths = src.accepted_paths(src.validate_files(spark, f"{tmp_path}/r", min_columns=3, header_line=1))
    names = lambda head: src.clean_names(head[1], {" ": "", ",": ""})
    got = src.read_reports(spark, paths, 2, names, file_date=(r"\.(\d{8})", "yyyyMMdd"))
    assert rows(got, "Loc", "Name", "Amount", "CityState", "reportdate") == [
        ("101", "Main", "5", None, date(2018, 1, 7)),
        ("205", None, "7", "A, B", date(2018, 1, 8)),
        ("9", "Week 1", None, None, date(2018, 1, 9)),
    ]
    short = write("short.csv", "Week 4,,\n")
    with pytest.raises(ValueError, match="has no line 1"):
        src.read_reports(spark, [short], 2, names)
    with pytest.raises(ValueError, match="no files"):
        src.read_reports(spark, [], 2, names)


def test_empty_feed(spark, write):
    df = src.read_csv(spark, write("e.csv", "a,b\n1,2\n"), src.FeedSpec("e"))
    assert not src.is_empty_feed(df) and src.is_empty_feed(df, 2)
    assert src.is_empty_feed(src.empty_frame(spark, "a int"))
    assert rows(src.literal_table(spark, [[0, 10000], [1, 7000]], "pte int, goal int")) == [(0, 10000), (1, 7000)]
    assert rows(src.with_run_date(df, "2018-01-07")) == [("1", "2", date(2018, 1, 7))]


def test_validate_files(spark, write, tmp_path):
    write("v/CustExp_201801071200.csv", '"Dealer Code","Location, full",Score\n1,2,3\n')
    write("v/CustExp_soon.csv", "Dealer Code,Location\n1,2\n")
    write("v/CustExp_201801081200.xlsx", "Dealer Code,Score\n")
    verdicts = src.validate_files(
        spark, f"{tmp_path}/v", extension=".csv", required=["Dealer Code", "Score"], min_columns=3,
        date_pattern=(r"_(\d{12})\.", "yyyyMMddHHmm"),
    )
    assert rows(verdicts, "file_name", "ok", F.concat_ws("; ", "reasons")) == [
        ("CustExp_201801071200.csv", True, ""),
        ("CustExp_201801081200.xlsx", False, "extension; too few columns"),
        ("CustExp_soon.csv", False, "missing columns: Score; too few columns; file date"),
    ]
    assert [p.rsplit("/", 1)[1] for p in src.accepted_paths(verdicts)] == ["CustExp_201801071200.csv"]


def test_inventory_and_routing(spark, write, tmp_path):
    write("l/ProductIdentifier_1.csv", "ID,Category\n1,2\n")
    write("l/Product file_1.csv", "SKU\n1\n")
    write("l/PII_Customer_1.csv", "ID\n")
    write("l/Empty.csv", "")
    write("l/Other.csv", "x\n")
    inventory = src.file_inventory(spark, f"{tmp_path}/l")
    got = {r.file_name: r for r in inventory.collect()}
    assert got["ProductIdentifier_1.csv"].columns == ["ID", "Category"] and got["Product file_1.csv"].columns == ["SKU"]
    assert got["PII_Customer_1.csv"].size == 3 and "Empty.csv" not in got
    routed = src.route_files(
        inventory, {"Product": "Product", "ProductIdentifier": "ProductIdentifier", "PII_Customer": "Customer"},
        {"PII_": "pii", "HR_Employee": "hr"},
    )
    assert rows(routed, "file_name", "dataset", "sensitivity") == [
        ("Other.csv", None, "regular"), ("PII_Customer_1.csv", "Customer", "pii"),
        ("Product file_1.csv", "Product", "regular"), ("ProductIdentifier_1.csv", "ProductIdentifier", "regular"),
    ]
    assert src.layer_path("/lake/", "raw", "Customer", "pii") == "/lake/raw/pii/Customer"


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def test_snapshots(spark, tmp_path):
    store = src.Snapshots(spark, str(tmp_path / "dim"))
    assert store.latest() is None and store.latest_two() == (None, None)
    first, second = frame(spark, (1, "a"), (2, "b")), frame(spark, (1, "a"), (2, "c"), (3, "d"))
    assert store.write_if_changed(first, ["k"], "20171231", date(2017, 12, 31))
    assert not store.write_if_changed(first, ["k"], "20180101", date(2018, 1, 1))
    assert store.ids() == ["20171231"]
    assert store.write_if_changed(second, ["k"], "20180102", date(2018, 1, 2))
    current, previous = store.latest_two()  # across a year boundary
    assert rows(current) == rows(second) and rows(previous) == rows(first)
    assert rows(spark.read.parquet(store.current_path)) == rows(second)
    history = store.history()
    assert rows(history.groupBy("year", "month", "snapshot_id").count()) == [(2017, 12, "20171231", 2), (2018, 1, "20180102", 3)]
    assert rows(op.delta(previous, current, ["k"]), "k", "cdc_ind_cd") == [(2, "C"), (3, "I")]


def test_snapshot_rerun_and_removed_rows(spark, tmp_path):
    store = src.Snapshots(spark, str(tmp_path / "dim"))
    store.write(frame(spark, (1, "a"), (2, "b")), "1", date(2018, 1, 1))
    assert store.write_if_changed(frame(spark, (1, "a")), ["k"], "2", date(2018, 1, 2))  # a removed row is a change
    assert store.write_if_changed(frame(spark, (1, "z")), ["k"], "2", date(2018, 1, 2))  # the same run again
    assert store.ids() == ["2", "1"] and rows(store.latest()) == [(1, "z")]
    with pytest.raises(ValueError):
        store.write(frame(spark, (1, "a")), "1", date(2018, 1, 1))
    with pytest.raises(ValueError):
        store.write(frame(spark, (1, "a")), "../3", date(2018, 1, 1))


def part_files(path):
    return sorted(path.glob("part-*.csv"))


def test_delivery(spark, tmp_path):
    df = frame(spark, (1, 'say "hi"'), (2, None))
    src.deliver(df, str(tmp_path / "d"), {"ID": "k", "NM": "v"}, quote_all=True, single_file=True)
    (part,) = part_files(tmp_path / "d/Current")
    assert part.read_text().splitlines()[0] == '"ID","NM"'
    assert list(csv.reader(part.open())) == [["ID", "NM"], ["1", 'say "hi"'], ["2", ""]]
    src.deliver(df.limit(0), str(tmp_path / "d"), {"ID": "k", "NM": "v"}, single_file=True)
    assert [p.read_text().strip() for p in part_files(tmp_path / "d/Current")] == ["ID,NM"]  # header only
    log = src.read_delivery(spark, str(tmp_path / "d/Previous"), "ID int, NM string")
    assert rows(log) == [(1, 'say "hi"'), (2, None)]


def test_register_tables(spark, tmp_path):
    frame(spark, (1, "a")).write.parquet(f"{tmp_path}/t")
    src.register_tables(spark, {"tiermill_test_table": f"{tmp_path}/t"})
    try:
        assert rows(spark.table("tiermill_test_table")) == [(1, "a")]
    finally:
        spark.sql("DROP TABLE tiermill_test_table")


def test_stream_takes_new_files_once(spark, write, tmp_path):
    spec = src.FeedSpec(
        "s", schema="Store string, V int", columns={"Store": "store"}, noise={"Store": ["Total%"]},
        file_date=(r"_(\d{8})", "yyyyMMdd"),
    )
    args = (spark, f"{tmp_path}/in", spec, f"{tmp_path}/out", f"{tmp_path}/ck")
    write("in/a_20180107.csv", "Store,V\n101,1\nTotal,1\n")
    for _ in range(2):
        ingest_stream(*args).awaitTermination()
    write("in/b_20180108.csv", "Store,V\n205,2\n")
    ingest_stream(*args, transform=lambda df: df.withColumn("V", F.col("V") * 10)).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out, "store", "V", "reportdate") == [("101", 1, date(2018, 1, 7)), ("205", 20, date(2018, 1, 8))]
    with pytest.raises(ValueError):
        ingest_stream(spark, "x", src.FeedSpec("s"), "y", "z")


def test_a_rerun_builds_on_the_snapshot_before_it(spark, tmp_path):
    from datetime import date

    from tiermill.sources.snapshots import Snapshots

    store = Snapshots(spark, str(tmp_path / "again"))
    store.write(spark.createDataFrame([(1, "a")], "id int, v string"), "r1", date(2026, 1, 1))
    for _ in range(2):
        merged = store.latest(before="r2").union(spark.createDataFrame([(2, "b")], "id int, v string"))
        store.write(merged, "r2", date(2026, 1, 2))
    store.write(store.latest(), "r2", date(2026, 1, 2))  # reads what it replaces
    assert sorted(map(tuple, store.latest().collect())) == [(1, "a"), (2, "b")]
    assert store.ids() == ["r2", "r1"] and store.history().count() == 3


def test_quarantined_text_can_be_read_back(spark, tmp_path):
    from pyspark.sql import functions as F

    from tiermill.operators.quality import quarantine

    text = 'say "hi", ok'
    bad = spark.createDataFrame([(text, ["r"])], "t string, failed_rules array<string>")
    quarantine(bad, str(tmp_path), "d", "run")
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{tmp_path}/d")
    assert back.select("t", "failed_rules", "run_id").where(F.col("t") == text).collect() == [(text, "r", "run")]
