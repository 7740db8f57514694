from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiermill import operators as op

SNAP = "k int, d string, a string, b string"


@pytest.fixture
def snapshots(spark):
    prev = spark.createDataFrame(
        [(1, "x", "same", "v"), (2, "x", "old", "v"), (3, "x", None, "v"), (4, "x", "v", None), (5, "x", "n", None),
         (6, "x", "gone", "v"), (7, "x", "v", "v"), (7, "y", "w", "w")],
        SNAP,
    )
    curr = spark.createDataFrame(
        [(1, "x", "same", "v"), (2, "x", "new", "v"), (3, "x", "v", "v"), (4, "x", None, None), (5, "x", None, "n"),
         (8, "x", "fresh", "v"), (7, "x", "v", "v"), (7, "y", "w2", "w")],
        SNAP,
    )
    return prev, curr


EXPECTED = [(1, "x", "U"), (2, "x", "C"), (3, "x", "C"), (4, "x", "C"), (5, "x", "C"), (7, "x", "U"), (7, "y", "C"), (8, "x", "N")]


@pytest.mark.parametrize("unique", [True, False])
def test_classify_is_null_safe_and_uses_the_full_key(snapshots, unique):
    prev, curr = snapshots
    got = op.classify_changes(prev, curr, ["k", "d"], unique_keys=unique)
    assert rows(got, "k", "d", "change") == EXPECTED
    assert got.columns == [*curr.columns, "change"]
    with_deletes = op.classify_changes(prev, curr, ["k", "d"], deletes=True, unique_keys=unique)
    assert rows(with_deletes, "k", "d", "change") == sorted([*EXPECTED, (6, "x", "D")], key=repr)
    assert [r.a for r in with_deletes.filter("change = 'D'").collect()] == ["gone"]


def test_classified_rows_cover_current(snapshots):
    prev, curr = snapshots
    counts = dict(rows(op.change_counts(op.classify_changes(prev, curr, ["k", "d"]))))
    assert counts["N"] + counts["C"] + counts["U"] == curr.count()


def test_null_keys_match(spark):
    prev = spark.createDataFrame([(None, "a")], "k int, v string")
    curr = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    assert rows(op.classify_changes(prev, curr, ["k"]), "k", "change") == [(1, "N"), (None, "U")]


@pytest.mark.parametrize("method", ["fingerprint", "except"])
def test_delta(snapshots, method):
    prev, curr = snapshots
    got = rows(op.delta(prev, curr, ["k", "d"], method=method), "k", "d", "cdc_ind_cd")
    assert got == [(k, d, {"N": "I"}.get(c, c)) for k, d, c in EXPECTED if c != "U"]


def test_first_load_and_identical_snapshots(snapshots):
    prev, curr = snapshots
    assert {r.cdc_ind_cd for r in op.delta(None, curr, ["k", "d"]).collect()} == {"I"}
    for method in ("fingerprint", "except"):
        assert op.delta(curr, curr, ["k", "d"], method=method).count() == 0


def test_delta_on_previous_gives_current_keys(snapshots):
    prev, curr = snapshots
    delta = op.delta(prev, curr, ["k", "d"], deletes=True)
    kept = prev.join(delta, ["k", "d"], "left_anti").unionByName(delta.filter("cdc_ind_cd <> 'D'").drop("cdc_ind_cd"))
    assert rows(kept) == rows(curr)


def test_fingerprint_sees_null_positions(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "b")], "x string, y string")
    assert df.select(op.row_fingerprint(["x", "y"])).distinct().count() == 3


def test_multiset_classification_of_a_hot_key(spark):
    """One key holds most rows of both snapshots; nothing is lost and no pairs appear."""
    prev = spark.range(30000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("v"))
    curr = spark.range(40000).select(F.when(F.col("id") < 39999, 1).otherwise(2).alias("k"), (F.col("id") % 4).alias("v"))
    got = dict(rows(op.change_counts(op.classify_changes(prev, curr, ["k"], unique_keys=False))))
    assert got == {"U": 30000, "C": 9999, "N": 1}


def test_upsert_newest_wins(spark):
    schema = "id int, changed string, status int"
    prev = spark.createDataFrame([(1, "2018-01-01", 0), (2, "2018-01-01", 1)], schema)
    new = spark.createDataFrame([(1, "2018-02-01", 1), (3, "2018-02-01", 1), (3, "2018-01-15", 0)], schema)
    assert rows(op.upsert(prev, new, ["id"], ["changed"])) == [
        (1, "2018-02-01", 1), (2, "2018-01-01", 1), (3, "2018-02-01", 1),
    ]
    assert op.upsert(None, new, ["id"], ["changed"]).count() == 2
    nulls = prev.unionByName(spark.createDataFrame([(None, "2017-01-01", 0)], schema))
    assert rows(op.upsert(nulls, new, ["id"], ["changed"])) == rows(op.upsert(nulls, new, ["id"], ["changed"], prev_unique=False))


def test_upsert_does_not_shuffle_an_untouched_history(spark, tmp_path):
    spark.range(1000).select("id", F.lit("2018").alias("d")).write.parquet(f"{tmp_path}/h")
    history = spark.read.parquet(f"{tmp_path}/h")
    feed = spark.range(5).select("id", F.lit("2019").alias("d"))
    out = op.upsert(history, feed, ["id"], ["d"])
    first, second = plan(out).split("Union", 1)[1].split("LeftAnti", 1)[1], plan(out)
    assert "Exchange hashpartitioning" not in first.split("LeftSemi", 1)[0].split("Window", 1)[0]
    assert second.count("LeftAnti") == 1 and out.count() == 1000 and out.filter("d = '2019'").count() == 5


def test_keep_latest_ties(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "c"), (2, None, "d"), (None, 1, "e")], "k int, o int, v string")
    assert rows(op.keep_latest(df, ["k"], ["o"]), "k", "v") == [(1, "a"), (2, "d"), (None, "e")]
    assert rows(op.keep_latest(df, ["k"], ["o"], ties="all"), "k", "v") == [(1, "a"), (1, "b"), (2, "d"), (None, "e")]
    assert rows(op.drop_key_duplicates(df, ["k"]), "k", "v") == [(1, "c"), (2, "d"), (None, "e")]
    with pytest.raises(ValueError):
        op.keep_latest(df, ["k"], ["o"], ties="some")


@pytest.fixture
def skewed(spark, tmp_path):
    """A fact whose key 7 holds a third of the rows, and settings small enough for it to count as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000)
    spark.range(0, 200000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).write.parquet(
        f"{tmp_path}/fact"
    )
    spark.range(0, 1000, 1, 1).select(F.col("id").alias("k"), (F.col("id") * 2).alias("m")).write.parquet(f"{tmp_path}/dim")
    yield spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/dim")
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skew_split(df):
    """Run the plan and report whether adaptive execution split a skewed join."""
    counted = df.groupBy().agg(F.count(F.lit(1)).alias("n"), *[F.max(c) for c in df.columns])
    n = counted.collect()[0].n
    return n, "skew=true" in plan(counted)


def test_hot_keys_are_split(skewed):
    fact, dim = skewed
    assert skew_split(op.enrich(fact, dim, ["k"], ["m"])) == (200000, True)
    assert skew_split(op.enrich(fact, dim.unionByName(dim), ["k"], ["m"], unique=False)) == (200000, True)
    assert skew_split(op.flag_present(fact, dim, ["k"], "f")) == (200000, True)
    prev = fact.filter(F.substring("v", 1, 1) < "8")
    assert skew_split(op.classify_changes(prev, fact, ["k"], unique_keys=False)) == (200000, True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(op.keep_latest(df, ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_split_and_unpivot_do_not_shuffle(spark):
    df = spark.createDataFrame([("1", 2.0, 3.0)], "s string, a double, b double")
    good, bad = op.split_valid(df, {"s": op.numeric("s")})
    long = op.unpivot_measures(df, ["s"])
    roles = op.expand_roles(df, ["s"], [(F.lit(True), {"r": F.lit("x")})])
    for out in (good, bad, long, roles):
        assert "Exchange" not in plan(out) and "Python" not in plan(out)


def test_unpivot(spark):
    df = spark.createDataFrame([(1, "1,234", None), (2, "35%", "7")], "store int, `WTR` string, `New/Upgrade` string")
    long = op.unpivot_measures(df, ["store"], name_col="kpi", null_value="0.00")
    assert rows(long) == [
        (1, "New/Upgrade", "0.00"), (1, "WTR", "1,234"), (2, "New/Upgrade", "7"), (2, "WTR", "35%"),
    ]
    assert long.count() == df.count() * 2
    mixed = spark.createDataFrame([(1, 2, 2.5)], "id int, `gp|misc` int, `cru|misc` double")
    parts = op.unpivot_measures(mixed, ["id"], value_type="double", name_parts=["category", "type"], sep="|")
    assert rows(parts, "category", "type", "value") == [("cru", "misc", 2.5), ("gp", "misc", 2.0)]


def test_explode_list(spark):
    df = spark.createDataFrame(
        [(1, "101 Main, 205 Oak Mall", "205 Oak Mall"), (2, None, "7 North"), (3, "101 Main", None), (4, "x, 9 A, 9 A", "9 A")],
        "e int, assigned string, prim string",
    )
    got = op.explode_list(df, "assigned", primary="prim", unknown=-2, out="s", flag="f")
    assert rows(got, "e", "s", "f") == [(1, 101, 0), (1, 205, 1), (2, 7, 1), (3, -2, 1), (4, 9, 1)]
    assert rows(op.explode_list(df.filter("e = 1"), "assigned", out="s"), "s") == [(101,), (205,)]
    big = spark.createDataFrame([(1, "7 A, 99999999999 B"), (2, "2147483647 C"), (3, None), (4, "x, ")], "e int, l string")
    assert rows(big.filter(op.list_fits("l")), "e") == [(2,), (3,), (4,)]
    assert rows(op.explode_list(big.filter(op.list_fits("l")), "l", out="s"), "s") == [(2147483647,)]
    with pytest.raises(Exception, match="list item does not fit an int: 99999999999"):
        op.explode_list(big, "l").collect()


def test_bridge_filter_placement(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,)], "store int")
    bridge = spark.createDataFrame(
        [(1, "A", "Retail", "Active"), (2, "B", "Retail", "Closed")],
        "StoreNumber int, DealerCode string, AssociationType string, AssociationStatus string",
    )
    dim = spark.createDataFrame([("A", "North")], "code string, region string")
    args = dict(
        on={"store": "StoreNumber"}, bridge_columns=["DealerCode"], active=F.col("AssociationStatus") == "Active",
        dim=dim, dim_on={"DealerCode": "code"}, dim_columns=["region"],
    )
    assert rows(op.bridge_lookup(fact, bridge, **args), "store", "region") == [(1, "North"), (2, None), (3, None)]
    assert rows(op.bridge_lookup(fact, bridge, how="inner", **args), "store", "region") == [(1, "North")]
    assert rows(op.active_bridge(bridge), "DealerCode") == [("A",)]


def test_conform_never_multiplies_rows(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    repeated = spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string")
    out = op.conform(base, [op.Lookup(repeated, {"k": "k"}, {"v": "name"})])
    assert rows(out) == [(1, "a"), (2, None)]


def test_enrich_names_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="v"):
        op.enrich(df, df, ["k"], ["v"])


def test_salted_enrich_equals_plain(spark):
    fact = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = op.enrich(fact, dim, ["k"], ["v"], "inner")
    assert rows(op.enrich(fact, dim, ["k"], ["v"], "inner", salt=5)) == rows(plain)


def test_flag_and_roles(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(op.flag_present(df, other, ["k"], "f")) == [(1, 0), (2, 1), (2, 1), (None, 0)]
    people = spark.createDataFrame([("w1", 11), ("w2", 12)], "w string, id int")
    mgr = spark.createDataFrame([("w1", "w2"), ("w9", None)], "rvp string, dm string")
    assert rows(op.role_lookup(mgr, people, {"rvp": "r", "dm": "d"}, "w", "id"), "r", "d") == [(11, 12), (None, None)]


def test_special_members_and_union(spark):
    dim = spark.createDataFrame([(5, "Main", True)], "n int, name string, flag boolean")
    out = op.with_special_members(dim, [{"n": -2, "name": "Unknown"}])
    assert rows(out) == [(-2, "Unknown", None), (5, "Main", True)] and out.schema["flag"].dataType == dim.schema["flag"].dataType
    with pytest.raises(ValueError):
        op.special_members(dim, [{"x": 1}])
    narrow = spark.createDataFrame([(9,)], "n int")
    assert rows(op.union_sources(dim, narrow)) == [(5, "Main", True), (9, None, None)]


def test_hierarchy(spark):
    stores = spark.createDataFrame([("AB", "C", "D"), ("A", "BC", "D"), ("A", "", "D"), ("A", None, "D")], "m string, r string, d string")
    carrier = spark.createDataFrame([("N", "E"), ("N", "E")], "region string, market string")
    out = op.level_hierarchy([op.LevelSource(carrier, "Carrier", ["region", "market"]), op.LevelSource(stores, "Own", ["m", "r", "d"])])
    assert rows(out, "hier_id", "hier_nm", "lvl_3_cd", "lvl_6_nm") == [
        ("AB|C|D", "Own", "D", ""), ("A|BC|D", "Own", "D", ""), ("N|E", "Carrier", "", ""),
    ]
    assert len(out.columns) == 14
    shallow = op.level_hierarchy([op.LevelSource(stores, "Own", ["m", "r", "d"]), op.LevelSource(carrier, "C", ["region"])], depth=2)
    assert rows(shallow, "hier_id", "lvl_3_cd") == [("AB|C|D", "D"), ("A|BC|D", "D"), ("N", "")]
    ids = op.with_hierarchy_id(stores, ["m", "r", "d"], "h")
    assert rows(ids.filter("r is null"), "h") == [(None,)]


def test_manager_hierarchy(spark):
    df = spark.createDataFrame([("M", "R", "D", "w1", "w2"), ("M", "R", "D", "w1", "w2"), ("M", None, "D", "w1", "w2")], "m string, r string, d string, a string, b string")
    people = spark.createDataFrame([("w1", 11), ("w2", 12), ("", 13)], "workdayid string, sourceemployeeid int")
    out = op.manager_hierarchy(df, ["m", "r", "d"], ["a", "b"], people)
    assert rows(out) == [("M|R|D", 11, 12, "", "", "", "")]


def test_goal_allocation(spark):
    day = date(2018, 1, 7)
    goals = spark.createDataFrame(
        [(1, "Units", 100.0, day), (1, "WTR", 0.5, day), (1, "Gross Profit", 9.0, day), (2, "Units", 10.0, day)],
        "storenumber int, kpiname string, goalvalue double, report_date date",
    )
    bridge = spark.createDataFrame([(1, 11, 4), (1, 12, 4), (2, 13, 4)], "storenumber int, sourceemployeeid int, companycd int")
    staff = spark.createDataFrame([(11, "Full", 0), (12, "Part", 1), (13, "Odd", None)], "sourceemployeeid int, name string, parttimeindicator int")
    heads = spark.createDataFrame([(1, 3.0), (2, 0.0)], "storenumber int, approved_headcount double")
    got = rows(op.allocate_goals(goals, bridge, staff, heads), "sourceemployeeid", "kpiname", "goalvalue")
    assert got == [
        (11, "Gross Profit", 10000.0), (11, "Units", 33.33), (11, "WTR", 0.5),
        (12, "Gross Profit", 7000.0), (12, "Units", 25.0), (12, "WTR", 0.5),
    ]


def test_sensitive_split_and_measures(spark):
    df = spark.createDataFrame([(1, "Ann", "555", 2, 10.0, 6.0)], "id int, name string, phone string, quantity int, price double, cost double")
    profile, contact = op.split_sensitive(df, ["id"], ["name", "phone"])
    assert profile.columns == ["id", "quantity", "price", "cost"] and contact.columns == ["id", "name", "phone"]
    assert rows(op.sales_measures(df), "saleamount", "rawgrossprofit") == [(20.0, 8.0)]
    assert rows(op.with_defaults(df.select(F.lit(None).cast("int").alias("x")), {"x": -1})) == [(-1,)]
