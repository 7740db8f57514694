"""All datasets through raw, discovery, refined and delivery layers, two runs."""

import csv
import io
from datetime import date

import pytest
from conftest import rows
from test_datasets import CUSTOMER, EMPLOYEE, SITE, product_header

from tiermill.plans import lake as lk
from tiermill.plans.datasets import dealer, goals, reports, sales, store
from tiermill.sources import read_delivery


pytestmark = pytest.mark.usefixtures("interpreted")


def text(header, *records, before=()):
    out = io.StringIO()
    writer = csv.writer(out)
    for line in before:
        writer.writerow(line)
    writer.writerow(header)
    for r in records:
        writer.writerow([r.get(c, "") for c in header])
    return out.getvalue()


def land(root, feed, name, content):
    folder = root / "raw" / lk.SENSITIVITY.get(feed, "regular") / feed
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content, encoding="utf-8")


def land_all(root):
    def put(feed, content, name=None):
        land(root, feed, name or f"{feed}.csv", content)

    put("location", text(store.LOCATION_REQUIRED, {"StoreID": "1", "StoreName": "101 Main Street", "RegionName": "M1", "ChannelName": "R1", "DistrictName": "D1"}, {"StoreID": "2", "StoreName": "HQ Office"}))
    put("expert", text(store.EXPERT_REQUIRED, {"Store Number": "101", "BAEWorkdayID": "b1"}))
    put("store_list", text(store.STORE_LIST_REQUIRED, {"Store #": "101", "Open Date": "01/02/2015", "Status": "Open", "RVP ID": "1", "MDIR ID": "2", "DM ID": "2"}))
    put("tv", text(store.TV_REQUIRED, {"Location": "101 Main Street", "DTV Now Location": "x"}))
    put("real_estate", text(store.real_estate_required(SITE), {"Loc": "101", "Square Feet": "1,500"}, before=[["", "", "Own Multi-Tracker"], [""]]))
    put("dealer_codes", text(dealer.dealer_required(SITE), {"Dealer Code": "AA1", "OWN Loc": "101", "SMF Mapping": "900", "Rank Description": "Open Standard", "Company": "Own Mobile", "ATT Region": "NE", "ATT Market Name": "East"}))
    put("employee", text([c.strip() for c in EMPLOYEE], {"EmployeeID": "11", "SpecialIdentifier": "1", "EmployeeName": "Ann", "PrimaryLocation": "101 Main Street", "RowUpdated": "2018-01-02", "RowEvent": "Updated"}, {"EmployeeID": "12", "SpecialIdentifier": "2", "EmployeeName": "Bo", "PartTime": "yes", "RowUpdated": "2018-01-02", "RowEvent": "Inserted"}))
    put("customer", text(CUSTOMER, {"CustomerID": "5", "PrimaryName": "Cy", "Phone": "555", "RowEvent": "Inserted"}))
    padded = product_header() + [f"Extra{i}" for i in range(10)]
    put("product", text(padded, {"Productsku": "S1", "Productname": "Case"}, {"Productname": "lost"}))
    put("coupons", text(["CouponSKU", "CouponName", "CouponLabel", "EnabledStatus", "X"], {"CouponSKU": "C1", "EnabledStatus": "Enabled"}))
    put("product_identifier", text(["ID", "CategoryNumber", "X", "Y"], {"ID": "S1", "CategoryNumber": "1010"}))
    put("product_category", text(["ID", "Description", "CategoryPath", "ParentID", "Enabled"], {"ID": "1010", "Description": "Cases", "CategoryPath": "Products >> Cases", "ParentID": "10", "Enabled": "TRUE"}))
    columns = "ChannelName StoreID StoreName CustomerID CustomerName EmployeeID DateCreated InvoiceNumber LineID ProductSKU Price Cost RQPriority Quantity EmployeeName SerialNumber SpecialProductID".split()
    put("sales_details", text(columns, {"ChannelName": "M1", "StoreName": "101 Main Street", "EmployeeID": "11", "DateCreated": "2018-01-07T10:11:12", "LineID": "1", "ProductSKU": "S1", "Price": "10", "Cost": "4", "Quantity": "2"}))
    actuals = ["Location", "Loc Id", "Dlr1 Code", "KPI", "KPI ID", "A", "P", "T"]
    put("carrier_actuals", text(actuals, {"Location": "One", "Dlr1 Code": "AA1", "KPI": "Opps", "A": "$5"}), "ATT_x.20180107.csv")
    put("carrier_actuals_report", text(actuals, {"Location": "One", "Dlr1 Code": "AA1", "KPI": "Opps", "A": "$5"}), "RPT_x.20180107.csv")
    put("store_goals", text(["Date", "Store", "WTR", "Units"], {"Date": "1/7/2018", "Store": "101 Main", "WTR": "35%", "Units": "10"}, before=[["", "Column1", "", ""]]))
    put("headcount", text(list(reports.HEADCOUNT_NAMES), {"Store Name": "101 Main", "Approved HC": "4", "Date": "1/7/2018"}, {"Store Name": "999 Gone", "Approved HC": "4"}))
    for feed in ("goal_points_store", "goal_points_employee"):
        put(feed, text(["Category", "Points", "Bonus", "Decelerator"], {"Category": "WTR", "Points": "5"}))
    put("daily_forecast", text(goals.FORECAST_REQUIRED, {"Date": "01/07/2018", "Day % to Forecast": "5%"}, {"Date": "soon"}))
    put("store_traffic", "7,Main,101,01/07/2018,10:00,5,In\n")
    put("experience", text(reports.EXPERIENCE_REQUIRED, {"Location": "Main AA1", "5 Key Behaviors": "90%"}), "CustExp_201801071200.csv")
    put("experience", text(reports.EXPERIENCE_REQUIRED, {"Location": "Main AA1"}), "CustExp_soon.csv")
    leads = [*sales.LEAD_COLUMNS, "Own Market", "Own Region", "Own District", "BAE"]
    put("sales_leads", text(leads, {"Master_Dealer": "MD", "Account": "Acme", "Enter_Date": "1/7/2018", "Dealer Code": "AA1"}))
    put("operational_efficiency", text(reports.EFFICIENCY_COLUMNS, {"Market": "M1", "Region": "R1", "District": "D1", "Location": "101 Main", "WorkDay ID": "1", "Total Loss": "($12.50)", "Date": "1/7/2018"}))
    put("employee_adjustments", text([*reports.EMPLOYEE_ADJUSTMENT_IDS, "Bill Credit"], {"SalesPersonID": "1", "Bill Credit": "5"}), "x_TransAdjEMP20180107.csv")
    put("misc_adjustments", text(["Location", "GP Adjustment", "CRU Adjustment", "Acc Elig Opps Adjustment", "Total Opps Adjustment"], {"Location": "101 Main", "GP Adjustment": "$5.00"}))
    put("store_adjustments", text(["Market", "Region", "District", "Location", "Loc", "Rebate"], {"Market": "M1", "Loc": "101", "Rebate": "7"}, before=[["18-Jan", "", "", "", "", "GP"]]), "x_TransAdjStore20180107.csv")
    catalog = "KPIName Companycd Classification Description Expression FilterCondition FromClause GroupByColumns CalculationLevel CalculationIndicator PublishIndicator PrimaryIndicator LveTableName".split()
    put(
        "metric_catalog",
        text(
            catalog,
            {"KPIName": "Gross", "Companycd": "4", "Expression": "sum(rawgrossprofit)", "FromClause": "SalesDetails s", "GroupByColumns": "s.sourceemployeeid, s.storenumber, getOnlyDate(s.invoicedate)", "CalculationLevel": "0"},
            {"KPIName": "Share", "Companycd": "4", "Expression": "max(g.kpivalue / h.approved_headcount)", "FromClause": "G g JOIN StoreRecruitingHeadcount h ON g.storenumber = h.store_number", "GroupByColumns": "g.storenumber", "CalculationLevel": "1", "LveTableName": "Gross=G"},
        ),
    )


@pytest.fixture(scope="module")
def lake_root(spark, interpreted, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    land_all(root)
    lk.run(lk.Lake(spark, str(root), "20180107", date(2018, 1, 7), SITE))
    return root


def delivered(spark, root, dataset, kind="Current"):
    return spark.read.option("header", True).option("escape", '"').csv(f"{root}/delivery/{dataset}/{kind}")


def test_first_run_delivers_every_dataset(spark, lake_root):
    counts = {name: delivered(spark, lake_root, name).count() for name in lk.JOBS}
    assert counts == {
        "dealer_code": 1, "store_dealer_association": 2, "store": 3, "store_hierarchy": 2, "employee": 2,
        "store_management_hierarchy": 1, "employee_store_association": 2, "customer": 1, "customer_contact": 1,
        "product": 2, "product_category": 2, "sales_details": 1, "carrier_actuals": 1, "store_goals": 2, "headcount": 1,
        "employee_goals": 2, "goal_points": 2, "daily_forecast": 1, "store_traffic": 1, "customer_experience": 1,
        "sales_leads": 1, "operational_efficiency": 1, "employee_adjustments": 1, "store_adjustments": 5,
        "metric_catalog": 2, "sales_kpis": 2,
    }
    kpis = delivered(spark, lake_root, "sales_kpis")
    assert rows(kpis, "KPI_NM", "STORE_NUM", "KPI_VAL_ACTL", "RPT_DT") == [
        ("Gross", "101", "12.0", "2018/01/07"), ("Share", "101", "3.0", None),
    ]
    assert rows(delivered(spark, lake_root, "store"), "store_num", "att_hier_id", "sq_ft") == [
        ("-2", None, None), ("0", None, None), ("101", "NE|East", "1500"),
    ]


def test_rejects_are_kept(spark, lake_root):
    files = spark.read.json(f"{lake_root}/errors/experience_files")
    assert rows(files, "file_name", "reasons", "run_id") == [("CustExp_soon.csv", ["file date"], "20180107")]
    assert delivered(spark, lake_root, "daily_forecast").count() == 1
    for feed in ("location", "product", "daily_forecast"):
        assert spark.read.option("header", True).csv(f"{lake_root}/errors/{feed}").count() == 1


def test_second_run_delivers_changes_only(spark, lake_root):
    header = dealer.dealer_required(SITE)
    old = {"Dealer Code": "AA1", "OWN Loc": "101", "SMF Mapping": "900", "Rank Description": "Open Standard", "Company": "Own Mobile", "ATT Region": "NE", "ATT Market Name": "East", "Notes": "moved"}
    new = {**old, "Dealer Code": "BB2", "ATT Market Name": "West"}
    land(lake_root, "dealer_codes", "dealer_codes.csv", text(header, old, new))
    second = lk.Lake(spark, str(lake_root), "20180108", date(2018, 1, 8), SITE)
    lk.run(second, ["dealer_code", "store_dealer_association", "store", "store_hierarchy"])
    assert rows(delivered(spark, lake_root, "dealer_code"), "DLR_CD", "cdc_ind_cd") == [("AA1", "C"), ("BB2", "I")]
    assert rows(delivered(spark, lake_root, "store_dealer_association"), "DLR_CD", "ASSOC_TYP", "cdc_ind_cd") == [
        ("BB2", "Retail", "I"), ("BB2", "SMF", "I"),
    ]
    assert rows(delivered(spark, lake_root, "store_hierarchy"), "hier_id", "cdc_ind_cd") == [("NE|West", "I")]
    # The store dimension did not change: nothing stored, a header-only delivery, and the log keeps the first run.
    assert second.refined("store").ids() == ["20180107"]
    assert delivered(spark, lake_root, "store").count() == 0
    assert delivered(spark, lake_root, "store", "Previous").count() == 3
    assert delivered(spark, lake_root, "dealer_code", "Previous").count() == 3


def test_routing(spark, tmp_path):
    lake = lk.Lake(spark, "/lake", "1", date(2018, 1, 7), SITE)
    for name in ("ProductIdentifier_1.csv", "PII_Customer_1.csv", "HR_Employee.csv", "OwnMobileStoreList.csv", "x.csv"):
        (tmp_path / name).write_text("a\n")
    assert rows(lk.landing_targets(lake, str(tmp_path)), "file_name", "target") == [
        ("HR_Employee.csv", "/lake/raw/hr/employee"), ("OwnMobileStoreList.csv", "/lake/raw/regular/store_list"),
        ("PII_Customer_1.csv", "/lake/raw/pii/customer"), ("ProductIdentifier_1.csv", "/lake/raw/regular/product_identifier"),
        ("x.csv", None),
    ]
    known = {lake.raw(f) for f in set(lk.routes(SITE).values())}
    assert {"/lake/raw/pii/sales_leads", "/lake/raw/hr/employee", "/lake/raw/regular/store_list"} <= known


def test_registered_tables(spark, lake_root):
    lk.register_lake(lk.Lake(spark, str(lake_root), "x", date(2018, 1, 9), SITE), "tiermill_lake_test")
    try:
        assert spark.table("tiermill_lake_test.sales_details").count() == 1
    finally:
        spark.sql("DROP DATABASE tiermill_lake_test CASCADE")


def test_missing_input_is_named(spark, tmp_path):
    lake = lk.Lake(spark, str(tmp_path), "1", date(2018, 1, 7), SITE)
    lk.ingest_traffic(lake)  # nothing landed: nothing stored
    with pytest.raises(LookupError, match="store_traffic"):
        lk.refine_traffic(lake)


def test_delivery_types(spark, lake_root):
    df = read_delivery(spark, f"{lake_root}/delivery/sales_details/Current", "RPT_DT string, STORE_NUM int")
    assert df.first().RPT_DT == "2018-01-07 10:11:12"
