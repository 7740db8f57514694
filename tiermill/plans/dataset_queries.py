"""Dataset refine steps over feeds derived from the supplied tables.

Suppliers stand for stores and dealers, order lines for sales, customers and suppliers for staff, parts for products,
documents for free text.  Importing this module adds its entries to ``QUERIES`` and ``SQL``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import conforming as conform
from ..sources import feeds
from .datasets import Site, dealer, goals, people, product, reports, sales, squash, store
from .metrics import Metric, MetricEngine, publish_values
from .lake import Lake, deliver_dealer, ingest_dealer, refine_dealer
from .table_queries import Tables, day, query, scratch

SITE = Site()


def text(c: str) -> Column:
    return F.col(c).cast("string")


def padded(df: DataFrame, columns: list[str], filled: dict[str, Column]) -> DataFrame:
    """A feed frame: the named columns filled, all others null text."""
    return df.select(*[filled.get(c, F.lit(None).cast("string")).alias(c) for c in columns])


def places(t: Tables) -> DataFrame:
    rows = conform.enrich(t("supplier"), t("nation"), {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    return conform.enrich(rows, t("region"), {"n_regionkey": "r_regionkey"}, ["r_name"])


def stores(t: Tables) -> DataFrame:
    """Refined stores: suppliers with a positive balance."""
    return (
        places(t)
        .filter(F.col("s_acctbal") > 0)
        .select(
            F.col("s_suppkey").cast("int").alias("StoreNumber"),
            F.col("s_name").alias("LocationName"),
            F.col("r_name").alias("OwnMarket"),
            F.col("n_name").alias("OwnRegion"),
            text("s_nationkey").alias("OwnDistrict"),
        )
    )


def bridge(t: Tables) -> DataFrame:
    return t("supplier").select(
        F.col("s_suppkey").cast("int").alias("StoreNumber"),
        F.concat(F.lit("D"), "s_suppkey").alias("DealerCode"),
        F.lit("Retail").alias("AssociationType"),
        F.when(F.col("s_acctbal") > 2000, "Active").otherwise("Closed").alias("AssociationStatus"),
    )


def dealers(t: Tables) -> DataFrame:
    return places(t).select(
        F.concat(F.lit("D"), "s_suppkey").alias("dealercode"),
        text("s_nationkey").alias("attlocationid"),
        F.col("s_name").alias("attlocationname"),
        F.col("n_name").alias("attmarket"),
        F.col("r_name").alias("attregion"),
    )


STORE_CTE = """
WITH st AS (SELECT CAST(s_suppkey AS INTEGER) AS num, s_name AS loc, r_name AS m, n_name AS r, CAST(s_nationkey AS VARCHAR) AS d
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal > 0),
br AS (SELECT CAST(s_suppkey AS INTEGER) AS num, 'D' || s_suppkey AS code FROM supplier WHERE s_acctbal > 2000),
dl AS (SELECT 'D' || s_suppkey AS code, CAST(s_nationkey AS VARCHAR) AS id, s_name AS name, n_name AS market, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


@query(
    "dataset_sales_details",
    STORE_CTE
    + """
SELECT l_linenumber AS "LINE_ID", strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS "RPT_DT", num AS "STORE_NUM",
  CAST(l_partkey AS VARCHAR) AS "PROD_SKU", CAST(l_orderkey AS VARCHAR) AS "INVOICE_NBR", 'RQ4' AS "SRC_SYS_NM",
  CAST(l_quantity AS INTEGER) AS "QTY", l_quantity * l_extendedprice AS "SALE_AMT",
  l_quantity * l_extendedprice - l_quantity * (l_tax * 1000) AS "RAW_GRS_PRFT",
  coalesce(nullif(l_returnflag, 'N'), 'NA') AS ownmarket, r AS ownregion, loc AS locationname
FROM lineitem JOIN st ON l_suppkey = num
""",
)
def dataset_sales_details(spark, t):
    lines = t("lineitem")
    names = [c.split()[0] for c in sales.SALES_SCHEMA.split(", ")]
    feed = padded(
        lines,
        names,
        {
            "channelname": F.nullif("l_returnflag", F.lit("N")),
            "storename": F.concat("l_suppkey", F.lit(" Store")),
            "datecreated": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"),
            "invoicenumber": text("l_orderkey"),
            "lineid": F.col("l_linenumber"),
            "productsku": text("l_partkey"),
            "price": F.col("l_extendedprice"),
            "cost": F.col("l_tax") * 1000,
            "quantity": F.col("l_quantity").cast("int"),
            "employeename": F.lit("E"),
        },
    )
    rows = sales.refine_sales(sales.ingest_sales(feed), stores(t), SITE)
    shown = ["LINE_ID", "RPT_DT", "STORE_NUM", "PROD_SKU", "INVOICE_NBR", "SRC_SYS_NM", "QTY", "SALE_AMT", "RAW_GRS_PRFT"]
    spec = {n: sales.SALES_DELIVERY[n] for n in shown}
    return conform.project(rows, {**spec, **{c: c for c in ("ownmarket", "ownregion", "locationname")}})


@query(
    "dataset_store_traffic",
    STORE_CTE
    + """
SELECT DISTINCT num AS storenumber, strftime(ts, '%m/%d/%Y') AS trafficdate, strftime(ts, '%H:00') AS traffictime,
  event_type AS traffictype, CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR) AS trafficcount, d AS owndistrict, 'SFTP' AS sourcesystemname
FROM events JOIN st ON user_id = num
""",
)
def dataset_store_traffic(spark, t):
    feed = t("events").select(
        F.lit("7").alias("shoppertraklocationid"),
        F.col("event_type").alias("storename"),
        text("user_id").alias("storenumber"),
        F.date_format("ts", "MM/dd/yyyy").alias("trafficdate"),
        F.date_format("ts", "HH:00").alias("traffictime"),
        F.col("value").cast("int").cast("string").alias("traffic"),
        F.col("event_type").alias("traffictype"),
    )
    rows = sales.refine_traffic(sales.ingest_traffic(feed), stores(t), SITE)
    return rows.select(
        "storenumber", "trafficdate", "traffictime", "traffictype", "trafficcount", "owndistrict", "sourcesystemname"
    )


@query(
    "dataset_sales_leads",
    STORE_CTE
    + r"""
SELECT DISTINCT br.code AS dealercode, br.num AS storenumber, source AS customeraccountname, st.loc AS locationname,
  dl.name AS attlocationname, md5(regexp_replace(text, '[\r\n\\/"]', ' ', 'g')) AS digest, DATE '2018-01-08' AS reportdate
FROM documents JOIN br ON br.code = 'D' || replace(source, 'src', '') LEFT JOIN st ON st.num = br.num JOIN dl ON dl.code = br.code
WHERE lang <> 'de'
""",
)
def dataset_sales_leads(spark, t):
    """Whole documents as lead descriptions; German ones carry an unreadable date."""
    columns = [squash(c) for c in sales.LEAD_COLUMNS] + ["ownmarket", "ownregion", "owndistrict", "bae"]
    feed = padded(
        t("documents"),
        columns,
        {
            "masterdealer": F.lit("MD"),
            "account": F.col("source"),
            "description": F.col("text"),
            "enterdate": F.when(F.col("lang") == "de", "soon").otherwise("1/7/2018"),
            "dealercode": F.concat(F.lit("D"), F.replace("source", F.lit("src"), F.lit(""))),
        },
    )
    good, _ = sales.split_leads(sales.ingest_leads(feed, "2018-01-08"))
    rows = sales.refine_leads(good, stores(t), bridge(t), dealers(t), SITE)
    shown = ["dealercode", "storenumber", "customeraccountname", "locationname", "attlocationname"]
    return rows.select(*shown, F.md5("description").alias("digest"), "reportdate")


@query(
    "dataset_carrier_actuals",
    STORE_CTE
    + """
, h AS (SELECT 'D' || l_suppkey AS code, l_returnflag AS kpi, CAST(date_trunc('year', l_shipdate) AS DATE) AS day,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS v, max(l_linestatus) AS top FROM lineitem GROUP BY 1, 2, 3)
SELECT h.day AS "RPT_DT", br.num AS "STORE_NUM", h.code AS "DLR_CD", 4 AS "CO_CD", h.kpi AS "KPI_NM", h.v AS "ACTL_VAL",
  CAST(h.v / 100 AS DECIMAL(18,4)) AS "PROJ_VAL", CASE WHEN h.day >= DATE '2001-01-01' THEN 1 ELSE 0 END AS "CRNT_KPI_IND"
FROM h JOIN br ON br.code = h.code JOIN st ON st.num = br.num
""",
)
def dataset_carrier_actuals(spark, t):
    """Yearly quantities as report text; the newest year is in the current report."""
    amount = F.sum(F.col("l_quantity").cast("decimal(18,2)"))
    history = (
        t("lineitem")
        .groupBy(
            F.concat(F.lit("D"), "l_suppkey").alias("dealercode"),
            F.col("l_returnflag").alias("kpiname"),
            F.trunc(day("l_shipdate"), "year").alias("reportdate"),
        )
        .agg(amount.alias("v"))
        .select(
            F.lit("x").alias("attlocationname"),
            F.lit("L").alias("locid"),
            "dealercode",
            "kpiname",
            F.lit("1").alias("kpiid"),
            F.concat(F.lit("$"), F.format_number("v", 2)).alias("actual_value"),
            F.concat(F.format_number("v", 2), F.lit("%")).alias("projected_value"),
            F.lit(None).cast("string").alias("target_value"),
            "reportdate",
        )
    )
    history = dealer.actual_values(history)
    report = history.filter(F.col("reportdate") >= F.lit("2001-01-01").cast("date"))
    return dealer.deliver_actuals(dealer.refine_actuals(history, report, stores(t), bridge(t), dealers(t), SITE))


@query(
    "dataset_dealer_association",
    """
WITH s AS (SELECT CAST(s_suppkey AS INTEGER) AS k, 'D' || s_suppkey AS code, CASE WHEN s_nationkey < 5 THEN 'Open Standard'
  WHEN s_nationkey < 10 THEN 'SMF Only' WHEN s_nationkey < 15 THEN 'Bulk' WHEN s_nationkey < 20 THEN 'Closed 2016' ELSE 'Other' END AS rank
  FROM supplier WHERE s_acctbal >= 0)
SELECT k AS "STORE_NUM", code AS "DLR_CD", 4 AS "CO_CD", 'Retail' AS "ASSOC_TYP",
  CASE WHEN rank LIKE 'Closed%' THEN 'Closed' ELSE 'Active' END AS "ASSOC_STAT", 'I' AS cdc_ind_cd
FROM s WHERE rank NOT IN ('Other', 'SMF Only')
UNION ALL SELECT k + 100000, code, 4, 'SMF', 'Active', 'I' FROM s WHERE rank <> 'Other'
""",
)
def dataset_dealer_association(spark, t):
    nation = F.col("s_nationkey")
    rank = F.when(nation < 5, "Open Standard").when(nation < 10, "SMF Only").when(nation < 15, "Bulk")
    raw = t("supplier").select(
        F.concat(F.lit("D"), "s_suppkey").alias("dealercode"),
        text("s_suppkey").alias("ownloc"),
        (F.col("s_suppkey") + 100000).cast("string").alias("smfmapping"),
        rank.when(nation < 20, "Closed 2016").otherwise("Other").alias("rankdescription"),
        F.when(F.col("s_acctbal") < 0, "Foreign").otherwise("Own Mobile").alias("company"),
    )
    return dealer.association_delta(None, dealer.refine_association(raw, SITE))


@query(
    "dataset_employee_store",
    """
WITH a AS (SELECT c_custkey AS id, c_nationkey AS p, c_mktsegment = 'BUILDING' AS lost FROM customer)
SELECT DISTINCT CAST(id AS INTEGER) AS "SRC_EMP_ID", s AS "STORE_NUM", CASE WHEN s = p THEN 1 ELSE 0 END AS "PRI_LOC_IN",
  CASE WHEN id > 100 THEN 'C' ELSE 'I' END AS "CDC_IND_CD"
FROM (SELECT id, p, lost, unnest([p, p + 1, 30]) AS s FROM a) WHERE NOT lost
UNION ALL SELECT CAST(id AS INTEGER), -2, 1, CASE WHEN id > 100 THEN 'C' ELSE 'I' END FROM a WHERE lost
""",
)
def dataset_employee_store(spark, t):
    """Customers as employees with three assigned locations and, but for one segment, a primary one."""
    columns = sorted({*people.EMPLOYEE_RENAMES.values(), "disabled", "parttime", "language", "startdate", "terminationdate", "rowevent"})
    site = F.concat("c_nationkey", F.lit(" Site"))
    feed = padded(
        t("customer"),
        columns,
        {
            "employeeid": text("c_custkey"),
            "employeename": F.col("c_name"),
            "primarylocation": F.when(F.col("c_mktsegment") != "BUILDING", site),
            "assignedlocations": F.concat(site, F.lit(", "), F.col("c_nationkey") + 1, F.lit(" Next, 30 Depot")),
            "rowupdated": F.lit("2018-01-01"),
            "rowevent": F.when(F.col("c_custkey") > 100, "Updated").otherwise("Inserted"),
        },
    )
    staff = people.refine_employee(None, people.standardise_employee(feed, SITE))
    shown = ("SRC_EMP_ID", "STORE_NUM", "PRI_LOC_IN", "CDC_IND_CD")
    links = people.refine_employee_store(staff, SITE)
    return conform.project(links, {n: people.EMPLOYEE_STORE_DELIVERY[n] for n in shown})


@query(
    "dataset_customer_contact",
    """
SELECT CAST(c_custkey AS VARCHAR) AS "SRC_CUST_ID", 4 AS "CO_CD", c_name AS "EMAIL", 'NA' AS "PHN2",
  CASE c_mktsegment WHEN 'BUILDING' THEN 'I' WHEN 'MACHINERY' THEN 'C' END AS "CDC_IND_CD" FROM customer WHERE c_acctbal > 0
""",
)
def dataset_customer_contact(spark, t):
    columns = sorted(
        {*people.CUSTOMER_SHARED.values(), "sourcecustomerid", "phone", "email", "address", "address2", "postalcode", "employeenameassignedto", "rowevent"}
    )
    segment = F.col("c_mktsegment")
    feed = padded(
        t("customer"),
        columns,
        {
            "sourcecustomerid": F.when(F.col("c_acctbal") > 0, text("c_custkey")),
            "email": F.col("c_name"),
            "rowevent": F.when(segment == "BUILDING", "Inserted").when(segment == "MACHINERY", "Updated"),
        },
    )
    rows = people.refine_customer_contact(feed, SITE)
    shown = ("SRC_CUST_ID", "CO_CD", "EMAIL", "PHN2", "CDC_IND_CD")
    return conform.project(rows, {n: people.CONTACT_DELIVERY[n] for n in shown})


@query(
    "dataset_product_delta",
    """
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name || '  ' AS name, CASE WHEN p_type = 'PROMO' THEN CAST(p_size AS VARCHAR) END AS cat,
  CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS active, p_size, p_retailprice FROM part)
SELECT sku AS "PROD_SKU", name AS "PROD_NME", cat AS "CAT_ID", p_retailprice AS "DFLT_RTL_PRC", active AS "PROD_ACT_IND",
  CASE WHEN p_size > 45 THEN 'I' ELSE 'C' END AS "CDC_IND_CD" FROM p WHERE p_size > 45 OR p_retailprice > 1000
UNION ALL SELECT 'C' || s_suppkey, s_name, '20', NULL, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END, 'I' FROM supplier
""",
)
def dataset_product_delta(spark, t):
    """Parts as products and suppliers as coupons; the earlier snapshot lacks large parts and has capped prices."""
    back = {v: k for k, v in product.PRODUCT_NAMES.items()}
    header = [back.get(c, c) for c in product.PRODUCT_COLUMNS if c not in ("companycd", "categoryid")]

    def snapshot(parts: DataFrame, price: Column, coupons: DataFrame) -> DataFrame:
        feed = padded(
            parts,
            header,
            {
                "productsku": text("p_partkey"),
                "productname": F.concat("p_name", F.lit('é" ')),
                "enabled": F.when(F.col("p_size") > 25, "TRUE").otherwise("FALSE"),
                "defaultretailprice": price,
            },
        )
        ids = parts.filter(F.col("p_type") == "PROMO").select(text("p_partkey").alias("ID"), F.col("p_size").alias("CategoryNumber"))
        good, _ = product.split_products(feed, ids, coupons)
        return product.refine_product(good, SITE)

    coupons = t("supplier").select(
        F.concat(F.lit("C"), "s_suppkey").alias("CouponSKU"),
        F.col("s_name").alias("CouponName"),
        F.col("s_name").alias("CouponLabel"),
        F.when(F.col("s_acctbal") > 0, "Enabled").otherwise("Off").alias("EnabledStatus"),
    )
    parts, price = t("part"), F.col("p_retailprice")
    curr = snapshot(parts, price, coupons)
    prev = snapshot(parts.filter(F.col("p_size") <= 45), F.least(price, F.lit(1000.0)), coupons.limit(0))
    shown = ("PROD_SKU", "PROD_NME", "CAT_ID", "DFLT_RTL_PRC", "PROD_ACT_IND", "CDC_IND_CD")
    return product.product_delta(prev, curr).select(*shown)


@query(
    "dataset_product_category",
    """
SELECT DISTINCT lpad(substr(p_brand, 7), 2, '0') || lpad(CAST(p_size AS VARCHAR), 2, '0') AS "category_Id", 'Products' AS level_two_name,
  lpad(substr(p_brand, 7), 2, '0') AS level_one_id, p_brand AS level_three_name, CAST(p_size AS VARCHAR) AS level_four_name, 1 AS active_indicator
FROM part UNION ALL SELECT '20', 'Coupons', '20', NULL, NULL, 0
""",
)
def dataset_product_category(spark, t):
    brand = F.lpad(F.substring("p_brand", 7, 2), 2, "0")
    feed = t("part").select(
        F.concat(brand, F.lpad(text("p_size"), 2, "0")).alias("id"),
        F.col("p_brand").alias("description"),
        F.concat_ws(" >> ", F.lit(" Products"), "p_brand", text("p_size")).alias("categorypath"),
        brand.alias("parentid"),
        F.lit("TRUE").alias("enabled"),
    )
    rows = product.refine_category(product.ingest_category(feed), SITE)
    shown = ["category_Id", "level_two_name", "level_one_id", "level_three_name", "level_four_name", "active_indicator"]
    return rows.select(*shown)


@query(
    "dataset_store_goals",
    STORE_CTE
    + """
, g AS (SELECT l_suppkey AS k, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS q,
  max(l_discount) AS top FROM lineitem GROUP BY 1)
SELECT num AS "STORE_NUM", 'Attach %' AS "KPI_NM", CAST(n / 100.0 AS DECIMAL(18,4)) AS "GOAL_VAL", 4 AS "CO_CD", DATE '2018-01-08' AS "RPT_DT"
FROM g JOIN st ON k = num
UNION ALL SELECT num, 'New/Upgrade 1', q, 4, DATE '2018-01-08' FROM g JOIN st ON k = num
UNION ALL SELECT num, 'Empty', CAST(0 AS DECIMAL(18,4)), 4, DATE '2018-01-08' FROM g JOIN st ON k = num
""",
)
def dataset_store_goals(spark, t):
    lines = t("lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q")
    )
    report = lines.select(
        F.lit("1/7/2018").alias("Date"),
        F.concat("l_suppkey", F.lit(" Store")).alias("Store"),
        F.concat("n", F.lit("%")).alias("Attach %"),
        F.format_number("q", 2).alias("New/Upgrade 1"),
        F.lit(None).cast("string").alias("Empty"),
    )
    return goals.deliver_goals(goals.refine_goals(report, stores(t), "2018-01-08", SITE))


@query(
    "dataset_store_adjustments",
    """
WITH g AS (SELECT CAST(l_suppkey AS VARCHAR) AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(20,8)) AS v, count(*) AS n
  FROM lineitem GROUP BY 1)
SELECT k AS storenumber, 'GP' AS adjustmenttype, 'Rebate' AS adjustmentcategory, v AS adjustmentamount FROM g
UNION ALL SELECT k, 'GP', 'New%', CAST(n / 100.0 AS DECIMAL(20,8)) FROM g
UNION ALL SELECT k, 'Miscellaneous', c, CASE c WHEN 'gpadjustments' THEN CAST(s_acctbal AS DECIMAL(20,8)) END
  FROM g JOIN supplier ON k = CAST(s_suppkey AS VARCHAR),
  (VALUES ('gpadjustments'), ('cruadjustments'), ('acceligoppsadjustment'), ('totaloppsadjustment')) x(c)
""",
)
def dataset_store_adjustments(spark, t):
    lines = t("lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v")
    )
    main = lines.select(
        *[F.lit("x").alias(c) for c in ("Market", "Region", "District", "Location")],
        text("l_suppkey").alias("Loc"),
        F.concat(F.lit("$"), F.format_number("v", 2)).alias("GP|Rebate"),
        F.concat("n", F.lit("%")).alias("GP|New%"),
    )
    misc = padded(
        t("supplier"),
        ["Location", *reports.MISC_NAMES],
        {
            "Location": F.concat("s_suppkey", F.lit(" "), "s_name"),
            "GP Adjustment": F.concat(F.lit("$"), F.format_number("s_acctbal", 2)),
        },
    )
    rows = reports.refine_store_adjustments(feeds.with_run_date(main, "2018-01-08"), misc, SITE)
    return rows.select("storenumber", "adjustmenttype", "adjustmentcategory", "adjustmentamount")


@query(
    "dataset_employee_adjustments",
    """
WITH g AS (SELECT l_suppkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v, CAST(count(*) AS DOUBLE) AS n
  FROM lineitem GROUP BY 1)
SELECT CAST(k AS INTEGER) AS "SRC_EMP_ID", 'BillCredit' AS "ADJMNT_TYP", v AS "ADJMNT_AMT" FROM g JOIN supplier ON k = s_suppkey WHERE s_acctbal > 0
UNION ALL SELECT CAST(k AS INTEGER), 'Chargeback', n FROM g JOIN supplier ON k = s_suppkey WHERE s_acctbal > 0
""",
)
def dataset_employee_adjustments(spark, t):
    lines = t("lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v")
    )
    filled = {
        "SalesPersonID": F.concat(F.lit("W"), "l_suppkey"),
        "Bill Credit": F.format_number("v", 2),
        "Chargeback": text("n"),
    }
    feed = padded(lines, [*reports.EMPLOYEE_ADJUSTMENT_IDS, "Bill Credit", "Chargeback"], filled)
    staff = t("supplier").filter(F.col("s_acctbal") > 0)
    staff = staff.select(
        F.col("s_suppkey").cast("int").alias("sourceemployeeid"), F.concat(F.lit("W"), "s_suppkey").alias("workdayid")
    )
    rows = reports.refine_employee_adjustments(feeds.with_run_date(feed, "2018-01-08"), staff, SITE)
    shown = ("SRC_EMP_ID", "ADJMNT_TYP", "ADJMNT_AMT")
    return conform.project(rows, {n: reports.EMPLOYEE_ADJUSTMENT_DELIVERY[n] for n in shown})


@query(
    "dataset_store",
    """
SELECT CAST(s_suppkey AS INTEGER) AS "StoreNumber", CAST(s_suppkey + 100000 AS INTEGER) AS "SourceStoreIdentifier", s_name AS "LocationName",
  CASE WHEN s_acctbal > 0 THEN r_name ELSE n_name END AS "OwnMarket", CAST(abs(s_acctbal) AS DECIMAL(15,2)) AS "Rent",
  CASE WHEN s_nationkey < 10 THEN DATE '2015-01-02' END AS "StoreOpenDate", CASE WHEN s_nationkey < 10 THEN true END AS "BaseStoreIndicator"
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey > 0
UNION ALL SELECT 0, 100000, s_name, CASE WHEN s_acctbal > 0 THEN r_name ELSE n_name END, CAST(abs(s_acctbal) AS DECIMAL(15,2)),
  CASE WHEN s_nationkey < 10 THEN DATE '2015-01-02' END, CASE WHEN s_nationkey < 10 THEN true END
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey = 0
UNION ALL SELECT -2, -2, 'Unknown', NULL, NULL, NULL, NULL
""",
)
def dataset_store(spark, t):
    """Suppliers as stores: two ids each, values from the location master with fallbacks from the other lists."""
    rows = places(t)
    number = text("s_suppkey")
    old, new = (
        padded(
            rows,
            store.LOCATION_REQUIRED,
            {
                "StoreID": (F.col("s_suppkey") + add).cast("string"),
                "StoreName": F.concat("s_suppkey", F.lit(" "), "s_name"),
                "RegionName": F.when(F.col("s_acctbal") > 0, F.col("r_name")),
            },
        )
        for add in (0, 100000)
    )
    expert = padded(rows, ["StoreNumber", "BAEWorkdayID", "BSISWorkdayID"], {"StoreNumber": number})
    names = feeds.clean_names(store.real_estate_required(SITE), store.HEADER_REPLACE)
    rent = F.concat(F.lit("$"), F.format_number(F.abs("s_acctbal"), 2))
    estate = padded(rows, names, {"Loc": number, "OwnMarket": F.col("n_name"), "TotalMonthlyRent": rent})
    listed = padded(
        rows.filter(F.col("s_nationkey") < 10),
        list(store.store_list_feed().columns.values()),
        {"Store": number, "OpenDate": F.lit("01/02/2015"), "Base": F.lit("X")},
    )
    tv = padded(rows, ["Location", "DTVNowLocation"], {"Location": F.concat("s_suppkey", F.lit(" "), "s_name")})
    good, _ = store.split_sources(old.unionByName(new), expert, estate, listed, tv)
    shown = ["StoreNumber", "SourceStoreIdentifier", "LocationName", "OwnMarket", "Rent", "StoreOpenDate", "BaseStoreIndicator"]
    return store.refine_store(good, SITE).select(*shown)


@query(
    "dataset_kpi_delivery",
    """
SELECT strftime(o_orderdate, '%Y/%m/%d') AS "RPT_DT", CAST(c_nationkey AS VARCHAR) AS "STORE_NUM", CAST(NULL AS INTEGER) AS "SRC_EMP_ID",
  'Order Value' AS "KPI_NM", 4 AS "CO_CD", 'RQ4' AS "SRC_SYS_NM", CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS "KPI_VAL_ACTL"
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""",
)
def dataset_kpi_delivery(spark, t):
    """A metric by store and day under delivery names."""
    orders = conform.enrich(t("orders"), t("customer"), {"o_custkey": "c_custkey"}, {"c_nationkey": "storenumber"}, "inner")
    orders = orders.withColumn("report_date", day("o_orderdate"))
    metric = Metric("Order Value", "sum(CAST(o_totalprice AS DECIMAL(18,2)))", "orders", "storenumber, report_date")
    return publish_values(MetricEngine(spark, [metric], {"orders": orders}).run())


# ------------------------------------------------------------------------------ a feed over two runs

def dealer_report(t: Tables, rank: Column, keep: Column) -> DataFrame:
    """A dealer report in the feed's own header: suppliers stand for dealers."""
    filled = {
        "Dealer Code": F.concat(F.lit("D"), "s_suppkey"),
        "Company": F.lit("Own Mobile"),
        "Rank Description": rank,
        "Open Date": F.lit("1/1/2024"),
        "DF": F.when(F.col("s_nationkey") < 12, "Yes").otherwise("no"),
        "WS": F.lit(None).cast("string"),
        "ATT Location Name": F.col("s_name"),
        "ATT Location ID": text("s_nationkey"),
    }
    return padded(t("supplier").filter(keep), dealer.dealer_required(SITE), filled)


#: What the query below delivers; other columns are empty.
DEALER_SQL = {
    "DLR_CD": "'D' || s_suppkey",
    "CO_CD": "'4'",
    "DF_IND": "CASE WHEN s_nationkey < 12 THEN '1' ELSE '0' END",
    "OPEN_DT": "'1/1/2024'",
    "RNK_DESC": "CASE WHEN s_acctbal > 5000 THEN 'Bulk' ELSE 'Closed' END",
    "ATT_LOC_NM": "s_name",
    "ATT_LOC_ID": "s_nationkey::VARCHAR",
    "cdc_ind_cd": "CASE WHEN s_suppkey % 2 = 0 THEN 'C' ELSE 'I' END",
}


@query(
    "dataset_dealer_code_runs",
    f"""SELECT {", ".join(f"{DEALER_SQL.get(c, 'NULL')} AS {c}" for c in dealer.DEALER_DELIVERY)}
FROM supplier WHERE s_suppkey % 2 = 1 OR s_acctbal > 5000""",
)
def dataset_dealer_code_runs(spark, t):
    """D4 over two runs: the second takes in a new report and an older one that landed late, and delivers what changed."""
    root = scratch(spark)
    even = F.col("s_suppkey") % 2 == 0
    now = F.when(F.col("s_acctbal") > 5000, "Bulk").otherwise("Closed")
    runs = {
        "run1": {"20240101": (F.lit("Closed"), even)},
        "run2": {"20240301": (now, F.lit(True)), "20231201": (F.lit("Stale"), even)},
    }
    for run_id, reports_ in runs.items():
        lake = Lake(spark, root, run_id, date(2024, 3, 1), SITE)
        for day_, (rank, keep) in reports_.items():
            dealer_report(t, rank, keep).write.csv(f"{lake.raw('dealer_codes')}/DealerCodes_{day_}.csv", header=True)
        ingest_dealer(lake)
        refine_dealer(lake)
        deliver_dealer(lake)
    return spark.read.option("header", True).csv(f"{root}/delivery/dealer_code/Current")


HEADCOUNTS = [c for c in reports.HEADCOUNT_DELIVERY.values() if c.endswith(("_count", "headcount"))]
HEADCOUNT_SQL = {
    "report_date": "'1/7/2018'",
    "store_number": "num",
    "companycd": f"{SITE.company_cd}",
    "dealer_code": "code",
    **{c: f"CAST(CAST(d AS INTEGER) + {i} AS VARCHAR)" for i, c in enumerate(HEADCOUNTS)},
}


@query(
    "dataset_headcount",
    STORE_CTE
    + f"""SELECT {", ".join(f'{HEADCOUNT_SQL[c]} AS "{n}"' for n, c in reports.HEADCOUNT_DELIVERY.items())}
FROM st JOIN br USING (num) WHERE num % 5 <> 0""",
)
def dataset_headcount(spark, t):
    """D18, all delivered columns; every fifth store is reported without a name, which is quarantined."""
    feed = padded(
        t("supplier"),
        list(reports.HEADCOUNT_NAMES.values()),
        {
            "store_name": F.when(F.col("s_suppkey") % 5 != 0, F.concat_ws(" ", text("s_suppkey"), "s_name")),
            "report_date": F.lit("1/7/2018"),
            **{c: (F.col("s_nationkey") + i).cast("int").cast("string") for i, c in enumerate(HEADCOUNTS)},
        },
    )
    good, _ = reports.split_headcount(feed)
    return conform.project(reports.refine_headcount(good, stores(t), bridge(t), SITE), reports.HEADCOUNT_DELIVERY)


@query(
    "dataset_goal_points",
    f"""
SELECT DISTINCT DATE '2018-01-08' AS "RPT_DT", cls AS "CLS", p_brand || ' ' || p_type AS "KPI_NM", {SITE.company_cd} AS "CO_CD",
  CAST(length(p_type) * k AS VARCHAR) AS "GOAL_PT", CAST(k AS VARCHAR) AS "BNS_PT", NULL AS "DECELERATOR_PT"
FROM part, (VALUES ('Store', 1), ('Employee', 2)) x(cls, k)
""",
)
def dataset_goal_points(spark, t):
    """D16, all delivered columns: brands and types as metrics, many rows of a metric."""

    def sheet(factor: int) -> DataFrame:
        rows = t("part").select(
            F.concat_ws(" ", "p_brand", "p_type").alias("kpiname"),
            (F.length("p_type") * factor).cast("string").alias("goalpoints"),
            F.lit(str(factor)).alias("bonuspoints"),
        )
        return rows.withColumn("deceleratorpoints", F.lit(None).cast("string"))

    return conform.project(goals.refine_points(sheet(1), sheet(2), "2018-01-08", SITE), goals.POINTS_DELIVERY)


@query(
    "dataset_daily_forecast",
    """
SELECT strftime(o_orderdate, '%m/%d/%Y') AS "RPT_DT", CAST(round(o_orderkey % 1000 / 1000.0, 3) AS DECIMAL(18,4)) AS "DAY_PCT_FCST"
FROM orders WHERE o_orderkey % 7 <> 0
""",
)
def dataset_daily_forecast(spark, t):
    """D17, all delivered columns; every seventh row is a total, which is quarantined for its date."""
    percent = (F.col("o_orderkey") % 1000).cast("decimal(18,1)") / 10
    feed = t("orders").select(
        F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise("Total").alias("date"),
        F.concat(percent.cast("decimal(18,1)").cast("string"), F.lit("%")).alias("daypercenttoforecast"),
    )
    good, _ = goals.split_forecast(feed)
    rows = good.withColumn("daypercenttoforecast", F.col("daypercenttoforecast").cast("decimal(18,4)"))
    return conform.project(rows, goals.FORECAST_DELIVERY)


def level_sql(names: list[str]) -> str:
    names = [*names, *["''"] * (6 - len(names))]
    return ", ".join(f"{n} AS lvl_{i}_cd, {n} AS lvl_{i}_nm" for i, n in enumerate(names, 1))


@query(
    "dataset_store_hierarchy",
    STORE_CTE
    + f"""SELECT DISTINCT m || '|' || r || '|' || d AS hier_id, '{SITE.hierarchy}' AS hier_nm, {level_sql(["m", "r", "d"])}, 'I' AS cdc_ind_cd
FROM st WHERE CAST(d AS INTEGER) >= 12
UNION ALL SELECT DISTINCT region || '|' || market, 'ATT Hierarchy', {level_sql(["region", "market"])}, 'I' FROM dl WHERE CAST(id AS INTEGER) >= 12""",
)
def dataset_store_hierarchy(spark, t):
    """D2, all columns: the paths that came in with the later half of the nations."""
    curr = (stores(t), dealers(t))
    prev = (curr[0].filter(F.col("OwnDistrict").cast("int") < 12), curr[1].filter(F.col("attlocationid").cast("int") < 12))
    return store.store_hierarchy_delta(curr, prev, SITE)


@query(
    "dataset_management_hierarchy",
    STORE_CTE
    + """
, li AS (SELECT CAST(s_suppkey AS INTEGER) AS num, CAST(s_nationkey AS INTEGER) AS a, CAST(s_nationkey + 50 AS INTEGER) AS b,
  CAST(s_suppkey % 5 AS INTEGER) AS c FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 4 <> 0),
em AS (SELECT CAST(c_custkey AS INTEGER) AS w FROM customer)
SELECT DISTINCT m || '|' || r || '|' || d AS hier_id, CAST(x.w + 1000 AS INTEGER) AS lvl_1_src_mgr_id, CAST(y.w + 1000 AS INTEGER) AS lvl_2_src_mgr_id,
  CAST(z.w + 1000 AS INTEGER) AS lvl_3_src_mgr_id, '' AS lvl_4_src_mgr_id, '' AS lvl_5_src_mgr_id, '' AS lvl_6_src_mgr_id
FROM st LEFT JOIN li USING (num) LEFT JOIN em x ON x.w = a LEFT JOIN em y ON y.w = b LEFT JOIN em z ON z.w = c
""",
)
def dataset_management_hierarchy(spark, t):
    """D3, all columns; every third store is closed, and every fourth has a manager id that is no number."""
    listed = t("supplier").select(
        text("s_suppkey").alias("Store"),
        F.when(F.col("s_suppkey") % 3 == 0, "Closed").otherwise("Open").alias("Status"),
        F.when(F.col("s_suppkey") % 4 == 0, "n/a").otherwise(text("s_nationkey")).alias("RVPID"),
        (F.col("s_nationkey") + 50).cast("string").alias("MDIRID"),
        (F.col("s_suppkey") % 5).cast("string").alias("DMID"),
    )
    staff = t("customer").select(
        text("c_custkey").alias("workdayid"), (F.col("c_custkey") + 1000).cast("int").alias("sourceemployeeid")
    )
    good, _ = store.management_sources(listed)
    return store.management_hierarchy(stores(t), good, staff, SITE)
