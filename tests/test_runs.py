"""What runs leave behind: manifests, buckets, logs, one-scan splits, and the plans of the one-pass operators."""

import re
import time
from datetime import date

from conftest import rows
from pyspark.sql import functions as F

import tiermill.operators as op
import tiermill.sources as src
from tiermill.plans import Metric, MetricEngine
from tiermill.plans import lake as lk
from tiermill.plans.datasets import dealer
from tiermill.sources import manifest as mf


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def listing(spark, *files):
    df = spark.createDataFrame([(p, n, "2024-01-01") for p, n in files], "path string, size long, day string")
    return df.select("path", "size", F.col("day").cast("timestamp").alias("modified"), F.lit(True).alias("ok"))


def test_manifest_takes_each_file_once(spark, tmp_path):
    m = mf.Manifest(spark, str(tmp_path / "m"))
    first = listing(spark, ("file:///a/x 1.csv", 1), ("file:///a/y.csv", 2))
    assert m.pending(first, "r1").count() == 2
    m.record(first, "r1")
    assert m.pending(first, "r1").count() == 2  # started again
    m.record(first, "r1")
    assert m.entries().count() == 2
    later = listing(spark, ("file:/a/x%201.csv", 1), ("file:/a/y.csv", 3), ("file:/a/z.csv", 1))
    assert rows(m.pending(later, "r2"), "path") == [("file:/a/y.csv",), ("file:/a/z.csv",)]
    assert m.pending(listing(spark), "r2").count() == 0


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    table = src.BucketedTable(spark, str(tmp_path / "t"), ["k"], 32)
    assert table.read() is None
    history = spark.range(2000).selectExpr("id AS k", "0 AS v", "'old' AS note").union(spark.sql("SELECT NULL, 0, 'null key'"))
    assert table.merge(history, ["v"], "r1").count() == 32
    feed = spark.createDataFrame([(5, 1, "new"), (5, 2, "newest"), (9999, 1, "added"), (None, 3, "null again")], "k long, v int, note string")
    touched = table.merge(feed, ["v"], "r2").collect()
    assert 1 <= len(touched) <= 3  # of 32
    got = {r.k: r.note for r in table.read().collect()}
    assert len(got) == 2002 and (got[5], got[9999], got[None], got[6]) == ("newest", "added", "null again", "old")
    again = table.merge(feed.where("k = 5"), ["v"], "r2").collect()  # the run starts again, with less: it builds on r1
    assert len(again) == 1
    assert {r.k: r.note for r in table.read().collect()} == {**{k: "old" for k in range(2000)}, None: "null key", 5: "newest"}
    folders = {p.name for p in (tmp_path / "t/data/run_id=r2").glob("attempt=*/bucket=*")}
    assert folders == {f"bucket={r.bucket}" for r in touched}
    assert table.merge(feed.limit(0), ["v"], "r3").count() == 0


def test_a_broken_merge_is_invisible(spark, tmp_path):
    table = src.BucketedTable(spark, str(tmp_path / "t"), ["k"], 4)
    table.merge(spark.range(10).selectExpr("id AS k", "0 AS v"), ["v"], "r1")
    spark.range(10).selectExpr("id AS k", "7 AS v", "0 AS bucket").write.partitionBy("bucket").parquet(str(tmp_path / "t/data/run_id=r2/attempt=broken"))
    assert rows(table.read().groupBy("v").count()) == [(0, 10)]


def test_split_scans_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(i, None if i % 3 else "x") for i in range(30)], "i int, v string").mapInArrow(count, "i int, v string")
    good, bad = op.split_stored(df, {"v": op.required("v"), "low": F.col("i") < 20})
    assert (good.count(), bad.count()) == (7, 23)
    assert seen.value == 30
    assert good.columns == ["i", "v"] and dict(bad.dtypes)["failed_rules"] == "array<string>"
    nothing = op.split_stored(df.limit(0), {"v": op.required("v")})
    assert [x.count() for x in nothing] == [0, 0]


def test_quarantine_twice_leaves_rows_once(spark, tmp_path):
    bad = spark.createDataFrame([(1, ["a"])], "i int, failed_rules array<string>")
    for run in ("r1", "r1", "r2"):
        op.quarantine(bad, str(tmp_path), "d", run)
    stored = src.read_delivery(spark, str(tmp_path / "d"), "i int, failed_rules string, run_id string")
    assert rows(stored, "i", "failed_rules", "run_id") == [(1, "a", "r1"), (1, "a", "r2")]


def test_multisets_are_compared_in_one_pass(spark):
    prev = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (None, "n"), (4, "d"), (4, "d")], "k int, v string")
    curr = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (1, "c"), (2, None), (2, "x"), (3, "q"), (None, "n"), (None, "m")], "k int, v string")
    got = op.classify_changes(prev, curr, ["k"], unique_keys=False, deletes=True)
    assert rows(got) == rows(
        spark.createDataFrame(
            [(1, "a", "U")] * 3 + [(1, "c", "C"), (2, None, "U"), (2, "x", "C"), (3, "q", "N"), (None, "n", "U"), (None, "m", "C"), (4, "d", "D"), (4, "d", "D")],
            "k int, v string, change string",
        )
    )
    many = op.classify_changes(prev, spark.range(25_001).selectExpr("7 AS k", "'m' AS v"), ["k"], unique_keys=False)
    assert rows(many.groupBy("k", "v", "change").count()) == [(7, "m", "N", 25_001)]


def test_multiset_plan_has_two_scans(spark, tmp_path):
    for name in "pc":
        spark.range(100).selectExpr("id % 10 AS k", f"id % {7 if name == 'p' else 9} AS v").write.parquet(str(tmp_path / name))
    prev, curr = (spark.read.parquet(str(tmp_path / n)) for n in "pc")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (op.delta(prev, curr, ["k"], method="except"), op.classify_changes(prev, curr, ["k"], unique_keys=False)):
            df.collect()
            final = plan(df).split("== Initial Plan ==")[0]
            assert len(re.findall(r"FileScan parquet", final)) == 2  # the second use of the counts reuses their exchange
            made = [line for line in final.splitlines() if re.search(r"[- ]Exchange hashpartitioning", line) and "ReusedExchange" not in line]
            assert len(made) <= 4, final  # rows by content, rows by key, and twice the few flags of keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_distinct_counts_do_not_expand(spark):
    df = spark.createDataFrame([("s", i % 5, float(i), "x" if i % 3 else None) for i in range(60)] + [("t", None, None, "y")], "g string, o int, a double, f string")
    metrics = [
        Metric("Sum", "sum(a)", "T t", "t.g"),
        Metric("Orders", "count(DISTINCT t.o)", "T t", "t.g"),
        Metric("Some", "count( distinct t.o )", "T t", "t.g", filter="WHERE t.f = 'x' AND t.o > 1"),
        Metric("Rows", "count(*)", "T t", "t.g", filter="WHERE t.f IS NULL"),
        Metric("Most", "max(a)", "T t", "t.g"),
    ]
    dims = {"g": "string"}
    fused = MetricEngine(spark, metrics, {"T": df}, dimensions=dims).run()
    single = MetricEngine(spark, metrics, {"T": df}, dimensions=dims, fuse=False).run()
    assert rows(fused, "g", "kpiname", "kpivalue") == rows(single, "g", "kpiname", "kpivalue")
    assert "Expand" not in plan(fused)


def test_newest_dealer_report_wins(spark):
    schema = "dealercode string, rankdescription string, reportdate date, landed_at timestamp"
    raw = spark.sql("SELECT * FROM VALUES ('A','old',DATE'2024-01-01',TIMESTAMP'2024-05-01'), ('A','new',DATE'2024-02-01',TIMESTAMP'2024-02-01'), ('B','undated',NULL,TIMESTAMP'2024-01-01'), ('B','undated later',NULL,TIMESTAMP'2024-01-02') t(a,b,c,d)")
    raw = raw.toDF(*[f.split()[0] for f in schema.split(", ")])
    assert rows(dealer.newest_report(raw), "dealercode", "rankdescription") == [("A", "new"), ("B", "undated later")]


def test_lake_takes_in_new_files_only(spark, tmp_path):
    from test_datasets import SITE

    header = ",".join(f'"{c}"' for c in dealer.dealer_required(SITE))
    names = dealer.dealer_required(SITE)
    at = names.index("Dealer Code")

    def land(name, code):
        folder = tmp_path / "raw/regular/dealer_codes"
        folder.mkdir(parents=True, exist_ok=True)
        cells = [""] * len(dealer.dealer_required(SITE))
        cells[at] = code
        cells[names.index("Company")], cells[names.index("Rank Description")] = "Own Mobile", "Bulk"
        (folder / name).write_text(header + "\n" + ",".join(cells) + "\n")

    def run(run_id):
        lake = lk.Lake(spark, str(tmp_path), run_id, date(2024, 1, 1), SITE)
        lk.ingest_dealer(lake)
        return rows(lake.found("dealer_codes"), "dealercode")

    land("DealerCodes_20240101.csv", "A")
    land("DealerCodes.txt", "rejected")
    assert run("r1") == [("A",)]
    assert run("r1") == [("A",)]
    time.sleep(1.1)
    land("DealerCodes_20240201.csv", "B")
    assert run("r2") == [("B",)]
    assert run("r3") == [("B",)]  # nothing landed: the snapshot before stays
    assert spark.read.json(str(tmp_path / "errors/dealer_codes_files")).count() == 1


def test_dates_that_cannot_be_parsed_are_rejected(spark):
    df = spark.createDataFrame([(x,) for x in ("1/2/2018", "01/02/2018", "0/2/2018", "2/30/2018", "1/2/18", "2018-01-07T10:11:12", "1-7-2018 9:00", "soon", "", None)], "d string")
    got = df.select("d", op.us_date("d").alias("us"), op.date_like("d").alias("any"), op.us_date("d", optional=True).alias("opt"))
    assert {r.d: (r.us, r.any, r.opt) for r in got.collect()} == {
        "1/2/2018": (True, True, True), "01/02/2018": (True, True, True), "0/2/2018": (False, False, False),
        "2/30/2018": (False, False, False), "1/2/18": (False, True, False), "2018-01-07T10:11:12": (False, True, False),
        "1-7-2018 9:00": (False, True, False), "soon": (False, False, False), "": (False, False, False), None: (False, False, True),
    }


def test_headcount_feed_of_one_row_is_kept(spark, tmp_path):
    from tiermill.plans.datasets import reports

    folder = tmp_path / "raw/regular/headcount"
    folder.mkdir(parents=True)
    header = ",".join(f'"{c}"' for c in reports.HEADCOUNT_NAMES)
    (folder / "h.csv").write_text(header + "\n" + ",".join(["101 Main"] * len(reports.HEADCOUNT_NAMES)) + "\n")
    lake = lk.Lake(spark, str(tmp_path), "r1", date(2024, 1, 1))
    lk.ingest_headcount(lake)
    assert lake.found("headcount").count() == 1
