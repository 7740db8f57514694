from datetime import date
from decimal import Decimal as D

from conftest import rows
from pyspark.sql import functions as F

from tiermill import functions as fn
from tiermill import operators as op


def one(spark, values, *cols):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [tuple(r) for r in df.orderBy("i").select(*cols).collect()]


def test_money(spark):
    text = ["$1,234.50", "(1,234.50) ", "12%", "abc", None, ""]
    got = one(spark, text, fn.parse_money("x"), fn.parse_money("x", negative_parens=True))
    assert got == [
        (D("1234.50"), D("1234.50")),
        (D("1234.50"), D("-1234.50")),
        (D("12.00"), D("12.00")),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_percent_keeps_fractions(spark):
    got = one(spark, ["12.5%", "35%", "7", "1,200.5%", "n/a", None], fn.parse_percent("x"), fn.parse_percent("x", always=True))
    assert got == [
        (D("0.1250"), D("0.1250")),
        (D("0.3500"), D("0.3500")),
        (D("7.0000"), D("0.0700")),
        (D("12.0050"), D("12.0050")),
        (None, None),
        (None, None),
    ]


def test_key_and_label(spark):
    key, label = fn.split_key_label("x")
    assert one(spark, ["101 Main Street", "205", None, " 7 North"], key, label) == [
        ("101", "Main Street"),
        ("205", ""),
        (None, None),
        ("7", "North"),
    ]
    assert one(spark, ["Oak Mall A1B2", "A1B2", None], fn.last_token("x")) == [("A1B2",), ("A1B2",), (None,)]


def test_marker_is_literal(spark):
    before, after = fn.split_on_marker("x", "License #")
    assert one(spark, ["Thanks License #77", "Thanks", "License #"], before, after) == [
        ("Thanks ", "77"),
        ("Thanks", None),
        ("", ""),
    ]


def test_hours(spark):
    hours = fn.parse_hours("x")
    assert len(hours) == 14
    picked = [hours[n] for n in ("MondayOpenTime", "MondayCloseTime", "SundayOpenTime", "TuesdayOpenTime")]
    text = "M: 10:00 AM-8:00 PM\nU: Closed T: 9:30 Am-7:00 Pm"
    assert one(spark, [text, None, "by appointment"], *picked) == [
        ("10:00 AM", "8:00 PM", "00:00 AM", "9:30 Am"),
        (None, None, None, None),
        (None, None, None, None),
    ]


def test_levels(spark):
    assert one(spark, ["101020", "10", "101", None], *fn.id_levels("x", 2, 3)) == [
        ("10", "1010", "101020"),
        ("10", None, None),
        ("10", "101", None),
        (None, None, None),
    ]
    assert one(spark, ["A >> B >> C", "A", None], *fn.path_levels("x", ">>", 3)) == [
        ("A", "B", "C"),
        ("A", None, None),
        (None, None, None),
    ]


def test_flags_and_recode(spark):
    flag = fn.to_flag("x", ["true", "yes", "1"], ["false"])
    got = one(spark, ["TRUE", " yes", "1", "False", "x", None], flag, fn.to_flag("x", ["true"], other=F.lit(0)))
    assert [g[0] for g in got] == [1, 1, 1, 0, None, None]
    assert [g[1] for g in got] == [1, 0, 0, 0, 0, 0]
    assert one(spark, ["en-us", "fr", None], fn.recode("x", {"en-us": "English"})) == [("English",), ("fr",), (None,)]


def test_text_cleaning(spark):
    assert one(spark, ['12" café', None], fn.ascii_only("x"), fn.unquote("x")) == [("12  caf", "12  café"), (None, "")]
    df = spark.createDataFrame([("a\r\nb", "c\nd")], "x string, y string")
    assert rows(fn.scrub_text(df, ["x"])) == [("a  b", "c\nd")]
    assert one(spark, ["2018-01-07T10:11:12.345"], fn.iso_to_timestamp_text("x")) == [("2018-01-07 10:11:12",)]


def test_first_filled_reaches_every_branch(spark):
    df = spark.createDataFrame([("", None, "c"), (" ", "b", "c"), ("a", "b", "c"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(fn.first_filled("a", "b", "c")).collect()] == ["c", "b", "a", None]


def test_sql_functions(spark):
    fn.register_sql_functions(spark)
    row = spark.sql(
        "SELECT getDateS('1/7/2018'), getDateH('12-31-99'), getDateH('01-07-18'), getOnlyDate('2018-01-07 10:11:12.5'), "
        "correctFormatDate('01/07/2018 10:00'), getOnlyDate2('1/7/18 9:05'), doubleToInt(3.7D), getDateS('bad')"
    ).first()
    assert tuple(row) == (
        date(2018, 1, 7), date(1999, 12, 31), date(2018, 1, 7), "01-07-2018", "01/07/2018", "01/07/2018", 3, None,
    )


def test_rules_and_split(spark):
    df = spark.createDataFrame(
        [("12", "01/07/2018"), ("1x", "01/07/2018"), ("12", "2018-01-07"), (None, None), ("12", "01/07/2018")],
        "store string, opened string",
    )
    rules = {"store": op.numeric("store"), "opened": op.us_date("opened")}
    good, bad = op.split_valid(df, rules)
    assert good.count() == 2  # duplicates of good rows survive
    assert rows(bad, F.concat_ws("|", "failed_rules")) == [("opened",), ("opened",), ("store",)]
    assert good.count() + bad.count() == df.count()
    optional, _ = op.split_valid(df, {"opened": op.us_date("opened", optional=True), "store": op.required("store")})
    assert optional.count() == 3


def test_null_keys_need_the_required_rule(spark):
    df = spark.createDataFrame([(None,), ("5",)], "store string")
    assert op.split_valid(df, {"n": op.numeric("store")})[0].count() == 2
    assert op.split_valid(df, {"n": op.numeric("store") & op.required("store")})[0].count() == 1


def test_date_like(spark):
    text = ["2018-01-07", "1/7/2018", "01-07-18", "soon", None]
    assert [g[0] for g in one(spark, text, op.date_like("x"))] == [True, True, True, False, False]


def test_noise_drops_nulls_unless_kept(spark):
    df = spark.createDataFrame([("Generated on",), ("Store 1",), (None,)], "x string")
    assert rows(op.drop_noise(df, "x", ["Generated%"])) == [("Store 1",)]
    assert op.drop_noise(df, "x", ["Generated%"], keep_nulls=True).count() == 2


def test_quarantine_and_summary(spark, tmp_path):
    df = spark.createDataFrame([("1x", "a,b"), ("2", None)], "store string, note string")
    _, bad = op.split_valid(df, {"store": op.numeric("store"), "note": op.required("note")})
    for run in ("r1", "r2"):
        op.quarantine(bad, str(tmp_path), "stores", run)
    stored = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/stores")
    assert stored.count() == 4
    errors = stored.select(F.lit("stores").alias("dataset"), F.split("failed_rules", r"\|").alias("failed_rules"), "run_id")
    assert rows(op.error_summary(errors)) == [("stores", "note", 2, "r2"), ("stores", "store", 2, "r2")]
