"""Each dataset end to end on small fixtures that contain the known traps of its feed."""

from datetime import date
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiermill import sources as src
from tiermill.operators import conforming as conform
from tiermill.plans.datasets import DATASETS, Site, dealer, goals, kpi, people, product, reports, sales, store

pytestmark = pytest.mark.usefixtures("interpreted")
SITE = Site(own="Own", code="OWN", report_area="OWN", excluded_companies=("Sister%",))


def text_frame(spark, columns, *records):
    """All-text frame; each record names the filled columns only."""
    values = [tuple(r.get(c) for c in columns) for r in records]
    return spark.createDataFrame(values, src.text_schema(columns))


@pytest.fixture(scope="module")
def stores(spark):
    return spark.createDataFrame(
        [(101, "Main Street", "M1", "R1", "D1"), (205, "Oak Mall", "M1", "R1", "D2"), (-2, "Unknown", None, None, None)],
        "StoreNumber int, LocationName string, OwnMarket string, OwnRegion string, OwnDistrict string",
    )


@pytest.fixture(scope="module")
def bridge(spark):
    return spark.createDataFrame(
        [(101, "AA1", 4, "Retail", "Active"), (205, "BB2", 4, "Retail", "Closed"), (101, "CC3", 4, "SMF", "Active")],
        "StoreNumber int, DealerCode string, CompanyCode int, AssociationType string, AssociationStatus string",
    )


@pytest.fixture(scope="module")
def dealers(spark):
    return spark.createDataFrame(
        [("AA1", "L1", "Loc One", "East", "NE"), ("BB2", "L2", "Loc Two", "West", "SW")],
        "dealercode string, attlocationid string, attlocationname string, attmarket string, attregion string",
    )


@pytest.fixture(scope="module")
def employees(spark):
    return spark.createDataFrame(
        [(11, "w1", "Ann", 0), (12, "w2", "Bo", 1), (13, "", "Cy", 0)],
        "sourceemployeeid int, workdayid string, name string, parttimeindicator int",
    )


def test_all_datasets_present():
    assert len(DATASETS) == 26


# ------------------------------------------------------------------------------------------- store


@pytest.fixture(scope="module")
def store_sources(spark):
    location = text_frame(
        spark, store.LOCATION_REQUIRED,
        {"StoreID": "1", "StoreName": "101 Main Street", "Disabled": "1", "Address": "", "City": "", "AdjustDST": "TRUE",
         "GeneralLocationNotes": "M: 10:00 AM-8:00 PM\nU: Closed", "SaleInvoiceComment": "Thanks\nLicense #77",
         "RegionName": "M1", "ChannelName": None, "DistrictName": "D1", "Latitude": "41.5", "Rent": "100",
         "ManagerEmployeeID": "11", "Serial_on_OE": "False"},
        {"StoreID": "9", "StoreName": "101 Main Street", "Disabled": "0", "Address": "New 1", "RegionName": "M1"},
        {"StoreID": "2", "StoreName": "205 Oak Mall", "Address": "Oak 5", "RegionName": None},
        {"StoreID": "3", "StoreName": "HQ Office"},
    )
    expert = text_frame(
        spark, ["StoreNumber", "BAEWorkdayID", "BSISWorkdayID"], {"StoreNumber": "101", "BAEWorkdayID": "b1"}, {"StoreNumber": "x1"}
    )
    names = src.clean_names(store.real_estate_required(SITE), store.HEADER_REPLACE)
    estate = text_frame(
        spark, names,
        {"Loc": "101", "StreetAddress": "Estate 1", "SquareFeet": "1,500", "TotalMonthlyRent": "$2,000.50",
         "RemodelorOpenDate": "05/01/2017", "OwnRegion": "R9", "OwnMarket": "M9", "TIOKiosk": "true"},
        {"Loc": "205", "RemodelorOpenDate": "05/01/2010", "OwnMarket": "M9", "OwnRegion": "R9", "OwnDistrict": "D9"},
        {"Loc": "Total"},
    )
    listed = text_frame(
        spark, [c.replace(" ", "").replace("#", "").replace("/", "") for c in store.STORE_LIST_REQUIRED],
        {"Store": "101", "OpenDate": "01/02/2015", "City": "Rome", "Base": "X", "Status": "Open", "RVPID": "1", "MDIRID": "2", "DMID": "3"},
        {"Store": "205", "OpenDate": "01/02/2015", "ClosedDate": "02/03/2018", "Status": "Closed", "RVPID": "1", "MDIRID": "2", "DMID": "3"},
        {"Store": "206", "OpenDate": "2015-01-02", "Status": "Open", "RVPID": "vacant"},
    )
    tv = text_frame(spark, ["Location", "DTVNowLocation"], {"Location": "101 Main Street", "DTVNowLocation": "yes"}, {"Location": ""})
    return store.split_sources(location, expert, estate, listed, tv)


def test_store_refine(store_sources):
    good, bad = store_sources
    assert {n: df.count() for n, df in bad.items()} == {
        "location": 1, "expert": 1, "real_estate": 1, "store_list": 1, "tv": 0,
    }
    refined = store.refine_store(good, SITE)
    assert len(refined.columns) == 98
    assert rows(refined, "StoreNumber", "SourceStoreIdentifier", "LocationName") == [
        (-2, -2, "Unknown"), (0, 0, "General Location"), (101, 9, "Main Street"), (205, 2, "Oak Mall"),
    ]
    by_id = {r.StoreNumber: r for r in refined.collect()}
    a, b = by_id[101], by_id[205]
    assert (a.Address, a.City, a.SquareFoot, a.Rent, a.StoreStatus) == ("New 1", "Rome", 1500, D("2000.50"), 1)
    assert (a.BaseStoreIndicator, a.DTVNowIndicator, a.TIOKioskIndicator, a.BAEWorkDayId) == (True, True, True, "b1")
    assert (a.RemodelDate, a.StoreOpenDate, b.RemodelDate, b.StoreCloseDate) == (
        date(2017, 5, 1), date(2015, 1, 2), None, date(2018, 2, 3),
    )
    assert (a.OwnMarket, a.OwnRegion, b.OwnMarket, b.OwnDistrict) == ("M1", "R9", "M9", "D9")


def test_store_first_row_details(store_sources):
    good, _ = store_sources
    only_old = {**good, "location": good["location"].filter("StoreID = '1'")}
    a = store.refine_store(only_old, SITE).filter("StoreNumber = 101").first()
    assert (a.Address, a.StoreStatus, a.AdjustDST, a.SerialOnOEIndicator) == ("Estate 1", 0, True, False)
    assert (a.MondayOpenTime, a.SundayCloseTime, a.ConsumerLicenseNumber, a.SaleInvoiceComment) == (
        "10:00 AM", "00:00 AM", "77", "Thanks ",
    )
    assert a.Lattitude == D("41.5000000000")


def test_store_delivery(spark, store_sources, bridge, dealers):
    curr = store.refine_store(store_sources[0], SITE)
    first = store.store_delta(None, curr, bridge, dealers, SITE)
    assert first.columns == list(store.STORE_DELIVERY) and {r.cdc_ind_cd for r in first.collect()} == {"I"}
    prev = curr.withColumn("OwnMarket", F.when(F.col("StoreNumber") == 101, "M0").otherwise(F.col("OwnMarket")))
    prev = prev.filter("StoreNumber <> 205")
    delta = store.store_delta(prev, curr, bridge, dealers, SITE)
    assert rows(delta, "store_num", "att_hier_id", "cdc_ind_cd") == [(101, "NE|East", "C"), (205, None, "I")]
    assert store.store_delta(curr, curr, bridge, dealers, SITE).isEmpty()


def test_hierarchies(spark, stores, dealers, employees, store_sources):
    out = store.store_hierarchy_delta((stores, dealers), None, SITE)
    assert rows(out, "hier_id", "hier_nm", "cdc_ind_cd") == [
        ("M1|R1|D1", "Own Hierarchy", "I"), ("M1|R1|D2", "Own Hierarchy", "I"),
        ("NE|East", "ATT Hierarchy", "I"), ("SW|West", "ATT Hierarchy", "I"),
    ]
    fewer = stores.filter("StoreNumber = 101")
    assert rows(store.store_hierarchy_delta((stores, dealers), (fewer, dealers), SITE), "hier_id", "cdc_ind_cd") == [("M1|R1|D2", "I")]
    listed, bad = store.management_sources(store_sources[0]["store_list"])
    assert rows(listed, "Store") == [("101",)] and bad.isEmpty()
    numbered = employees.withColumn("workdayid", F.regexp_replace("workdayid", "w", ""))
    curr = store.management_hierarchy(stores, listed, numbered, SITE)
    assert rows(curr, "hier_id", "lvl_1_src_mgr_id", "lvl_2_src_mgr_id", "lvl_3_src_mgr_id", "lvl_4_src_mgr_id") == [
        ("M1|R1|D1", 11, 12, None, ""), ("M1|R1|D2", None, None, None, ""),
    ]
    moved = listed.withColumn("RVPID", F.lit("2"))
    delta = store.management_hierarchy_delta(curr, store.management_hierarchy(stores, moved, numbered, SITE))
    assert rows(delta, "hier_id", "lvl_1_src_mgr_id", "cdc_ind_cd") == [("M1|R1|D1", 12, "C")]


# ------------------------------------------------------------------------------------------ dealer


@pytest.fixture(scope="module")
def dealer_raw(spark, tmp_path_factory):
    header = dealer.dealer_required(SITE)
    records = [
        {"Dealer Code": "AA1", "DF": "DF", "WS": "No", "OWN Loc": "101", "SMF Mapping": "900", "Rank Description": "Open Standard", "Company": "Own Mobile", "ATT Region": "NE", "ATT Market Name": "East", "C&C": "y"},
        {"Dealer Code": "AA1", "DF": "Off", "OWN Loc": "101", "SMF Mapping": "900", "Rank Description": "Open Standard", "Company": "Own Mobile"},
        {"Dealer Code": "BB2", "OWN Loc": "205", "SMF Mapping": "", "Rank Description": "Closed 2016", "Company": "Own Mobile"},
        {"Dealer Code": "CC3", "OWN Loc": "", "SMF Mapping": "300", "Rank Description": "SMF Only", "Company": "Own Mobile"},
        {"Dealer Code": " ", "OWN Loc": "7", "Rank Description": "Bulk", "Company": "Other"},
        {"Dealer Code": "DD4", "Rank Description": "Pending move", "Company": "Own Mobile"},
        {"Dealer Code": "EE5", "Rank Description": "Bulk", "Company": "SisterCo"},
    ]
    path = tmp_path_factory.mktemp("dealer") / "DealerCodes.csv"
    lines = [",".join(header)] + [",".join(r.get(c, "") for c in header) for r in records]
    path.write_text("\n".join(lines) + "\n")
    return src.read_csv(spark, str(path), dealer.dealer_feed(SITE))


def test_dealer(spark, dealer_raw):
    assert dealer_raw.count() == 5
    curr = dealer.refine_dealer(dealer_raw, SITE)
    assert len(curr.columns) == 28
    got = rows(curr, "dealercode", "companycode", "attmarket")
    assert [g[0] for g in got] == ["AA1", "BB2", "CC3"] and {g[1] for g in got} == {4}
    flags = {r.candc: (r.dfindicator, r.whitestoreindicator) for r in dealer.refine_dealer(dealer_raw.filter("candc = 'y'"), SITE).collect()}
    assert flags == {"y": (1, 0)}
    prev = curr.filter("dealercode <> 'CC3'").withColumn("notes", F.when(F.col("dealercode") == "BB2", "old"))
    delta = dealer.dealer_delta(prev, curr)
    assert rows(delta, "DLR_CD", "cdc_ind_cd") == [("BB2", "C"), ("CC3", "I")]
    assert delta.columns == list(dealer.DEALER_DELIVERY)


def test_association(spark, dealer_raw):
    curr = dealer.refine_association(dealer_raw, SITE)
    assert rows(curr) == [
        (101, "AA1", 4, "Retail", "Active"), (205, "BB2", 4, "Retail", "Closed"), (300, "CC3", 4, "SMF", "Active"),
        (900, "AA1", 4, "SMF", "Active"), (None, "BB2", 4, "SMF", "Active"),
    ]
    strict = dealer.refine_association(dealer_raw, SITE, open_only=True)
    assert strict.filter("DealerCode = 'BB2' and AssociationType = 'SMF'").isEmpty()
    prev = curr.filter("DealerCode <> 'CC3'").withColumn(
        "AssociationStatus", F.when(F.col("StoreNumber") == 205, "Active").otherwise(F.col("AssociationStatus"))
    )
    assert rows(dealer.association_delta(prev, curr), "STORE_NUM", "DLR_CD", "cdc_ind_cd") == [(205, "BB2", "C"), (300, "CC3", "I")]


def test_actuals(spark, write, tmp_path, stores, bridge, dealers):
    text = "Location,Loc Id,Dlr1 Code,KPI,KPI ID,Jan 2018 Actual,Jan 2018 Projected,Jan 2018 Target\n"
    body = 'One,L1,AA1,Opps,1,"$1,234.50",12.5%,7\nOne,L1,AA1,Rate,2,12.5%,30,\nTwo,L2,BB2,Opps,1,5,5,5\n,,,,,,,\nGenerated today,,,,,,,\n'
    write("h/ATT_x_y_z.20180107.csv", text + body)
    write("h/ATT_x_y_z.20180108.csv", text + "AT&T MyResults,,,,,,,\nAR : OWN X,,,,,,,\nOne,L1,AA1,Opps,1,9,9,9\n")
    write("r/ATT_x_y_z.20180107.csv", text + "One,L1,AA1,Rate,2,12.5%,30,\n")
    history, report = (
        dealer.actual_values(src.read_csv(spark, f"{tmp_path}/{d}", dealer.actuals_feed(SITE))) for d in "hr"
    )
    assert history.count() == 4
    out = dealer.refine_actuals(history, report, stores, bridge, dealers, SITE)
    assert rows(out, "kpiname", "reportdate", "actualvalue", "projectedvalue", "currentkpiindicator", "storenumber", "ownmarket") == [
        ("Opps", date(2018, 1, 7), D("1234.5000"), D("0.1250"), 0, 101, "M1"),
        ("Opps", date(2018, 1, 8), D("9.0000"), D("9.0000"), 0, 101, "M1"),
        ("Rate", date(2018, 1, 7), D("0.1250"), D("30.0000"), 1, 101, "M1"),
    ]
    assert dealer.deliver_actuals(out).columns == list(dealer.ACTUALS_DELIVERY)


# ------------------------------------------------------------------------------------------ people

EMPLOYEE = [
    "EmployeeID", "SpecialIdentifier", "EmployeeName", "Disabled", "PartTime", "PrimaryLocation", "AssignedLocations",
    "StartDate", "TerminationDate", "RowUpdated", "RowInserted", "RowEvent\r", "Gender", "Email", "Email.Personal",
    "Title", "SecurityRole", "City", "StateProvince", "Country", "UserManagerEmployeeID", "Supervisor",
    "Commission Group", "Compensation Type", "Username", "Phone", "Phone.Cellular", "Language",
]


def test_employee(spark):
    raw = text_frame(
        spark, EMPLOYEE,
        {"EmployeeID": "11", "EmployeeName": "Ann", "Disabled": "FALSE", "PartTime": "yes", "Language": "en-us", "Email.Personal": "a@x",
         "StartDate": "2017-05-01", "TerminationDate": "TODAY", "RowUpdated": "2018-01-02", "RowEvent\r": "Updated",
         "PrimaryLocation": "205 Oak Mall", "AssignedLocations": "101 Main, 205 Oak Mall"},
        {"EmployeeID": "12", "Disabled": "true", "RowUpdated": "2018-01-02", "RowEvent\r": "Inserted", "AssignedLocations": "101 Main"},
        {"EmployeeID": "12", "Disabled": "true", "RowUpdated": "2018-01-02", "RowEvent\r": "Inserted", "AssignedLocations": "101 Main"},
        {"EmployeeID": None, "RowUpdated": "2018-01-02"},
    )
    new = people.standardise_employee(raw, SITE)
    first = people.refine_employee(None, new)
    assert rows(first, "sourceemployeeid", "statusindicator", "parttimeindicator", "language", "startdate", "terminationdate", "CDC_IND_CD") == [
        (11, 1, 1, "English", date(2017, 5, 1), None, "C"), (12, 0, 0, None, None, None, "I"),
    ]
    again = people.refine_employee(first, people.standardise_employee(raw.filter("EmployeeID = '11'").withColumn("RowUpdated", F.lit("2018-02-01")), SITE))
    # Stored rows keep their status; only incoming rows are recoded.
    assert rows(again, "sourceemployeeid", "statusindicator", "employeelastmodifieddate") == [(11, 1, "2018-02-01"), (12, 0, "2018-01-02")]
    assert people.employee_delta(new).count() == 2
    assert conform.project(first, people.EMPLOYEE_DELIVERY).columns == list(people.EMPLOYEE_DELIVERY)
    links = people.refine_employee_store(first, SITE)
    assert rows(links, "sourceemployeeid", "storenumber", "primarylocationindicator") == [(11, 101, 0), (11, 205, 1), (12, -2, 1)]
    assert conform.project(links, people.EMPLOYEE_STORE_DELIVERY).count() == 3


CUSTOMER = [
    "CustomerID", "PrimaryName", "FamilyName", "CompanyName", "CompanyContact", "Title", "CustomerType", "Phone", "Email",
    "Address", "Address2", "City", "StateProvince", "PostalCode", "Country", "StoreID", "EmployeeID", "EmployeeName",
    "EmployeeIDAssignedTo", "EmployeeNameAssignedTo", "MultiLevelPriceID", "BillingAccountNumber", "NumberOfActivations",
    "VIPCustomer", "TracPointMemberNumber", "RowInserted", "RowUpdated", "RowEvent",
]


def test_customer(spark):
    raw = text_frame(
        spark, CUSTOMER,
        {"CustomerID": "1", "PrimaryName": "Ann", "Phone": "555", "Email": "a@x", "Address": "Main 1", "RowEvent": "Inserted"},
        {"CustomerID": "2", "PrimaryName": "Bo", "RowEvent": "Updated"}, {"CustomerID": "3", "RowEvent": "Touched"}, {"PrimaryName": "X"},
    )
    df = people.ingest_customer(raw)
    profile, contact = people.refine_customer(df, SITE), people.refine_customer_contact(df, SITE)
    assert rows(profile, "sourcecustomerid", "firstname", "CDC_IND_CD", "phone2type") == [
        ("1", "Ann", "I", "NA"), ("2", "Bo", "C", "NA"), ("3", None, None, "NA"),
    ]
    assert not {"phone", "email", "address", "address1"} & set(profile.columns)
    delivered = conform.project(contact, people.CONTACT_DELIVERY)
    assert rows(delivered.filter("SRC_CUST_ID = '1'"), "PH", "EMAIL", "ADDR1", "PHN5") == [("555", "a@x", "Main 1", "NA")]
    assert conform.project(profile, people.CUSTOMER_DELIVERY).count() == 3


# ------------------------------------------------------------------------------------------ product


def product_header():
    back = {v: k for k, v in product.PRODUCT_NAMES.items()}
    made = {"companycd", "categoryid"}
    return [back.get(c, c).capitalize() for c in product.PRODUCT_COLUMNS if c not in made]


def test_product(spark):
    raw = text_frame(
        spark, product_header(),
        {"Productsku": "S1", "Productname": 'Case 5" café', "Enabled": "TRUE", "Refundable": "FALSE", "Primaryvendorsku": 'v"1'},
        {"Productsku": "S2", "Productname": "Plug"}, {"Productname": "lost"}, {"Productsku": "C1", "Productname": "clash"},
    )
    ids = spark.createDataFrame([("S1", 101020), ("S1", 101030), (None, 5)], "ID string, CategoryNumber int")
    coupons = spark.createDataFrame(
        [("C1", "Coupon", "c", "Enabled"), ("C2", "Other", "o", "Off"), (None, "x", "x", "x")],
        "CouponSKU string, CouponName string, CouponLabel string, EnabledStatus string",
    )
    good, bad = product.split_products(raw, ids, coupons)
    assert {n: df.count() for n, df in bad.items()} == {"product": 1, "identifier": 1, "coupons": 1}
    curr = product.refine_product(good, SITE)
    assert curr.columns == product.PRODUCT_COLUMNS and len(curr.columns) == 56
    assert rows(curr, "productsku", "productname", "categoryid", "productactiveindicator", "refundable", "primaryvendorsku") == [
        ("C1", "clash", None, 0, 0, ""), ("C2", "Other", "20", 0, None, None),
        ("S1", "Case 5  caf", "101020", 1, 0, "v 1"), ("S2", "Plug", None, 0, 0, ""),
    ]
    prev = curr.filter("productsku <> 'C2'").withColumn("productlabel", F.when(F.col("productsku") == "S2", "old"))
    assert rows(product.product_delta(prev, curr), "PROD_SKU", "CDC_IND_CD") == [("C2", "I"), ("S2", "C")]
    assert product.product_delta(None, curr).count() == 4


def test_category(spark, write):
    path = write(
        "CategoryNumber.csv",
        "ID,Description,CategoryPath,ParentID,Enabled\n10,Root,Products,,TRUE\n101020,Cases, Products >> Accessories >> Cases ,1010,TRUE\n"
        "101020,Cases, Products >> Accessories >> Cases ,1010,TRUE\n,None,x,1,FALSE\n1010203040506070,Deep,A >> B >> C >> D >> E >> F >> G,10102030405060,FALSE\n",
    )
    raw = src.read_csv(spark, path, product.CATEGORY_FEED)
    curr = product.refine_category(product.ingest_category(raw), SITE)
    assert len(curr.columns) == 26
    assert rows(curr, "category_Id", "active_indicator", "level_two_name", "level_three_id", "level_three_name", "level_four_name") == [
        ("10", 1, "", None, None, None), ("101020", 1, "Products", "101020", "Accessories", "Cases"),
        ("1010203040506070", 0, "Products", "101020", "B", "C"), ("20", 0, "Coupons", None, None, None),
    ]
    deep = curr.filter("level_eight_id is not null").first()
    assert (deep.level_eight_id, deep.level_eight_name, deep.level_nine_id) == ("1010203040506070", "G", "")
    ten, eleven = "10" * 10, "10" * 11
    path = " >> ".join("ABCDEFGHI")
    deeper = spark.createDataFrame(
        [(ten, "d", path, "1", "TRUE"), (eleven, "d", "A", "1", "TRUE"), ("30", "d", path + ">>J", "1", "TRUE"), ("40", "d", None, None, None)],
        "id string, description string, categorypath string, parentid string, enabled string",
    )
    good, bad = product.split_category(deeper)
    assert rows(bad, "id", F.col("failed_rules")[0]) == [(eleven, "id of more than 10 levels"), ("30", "path of more than 9 names")]
    kept = product.refine_category(good, SITE).filter("category_Id <> '20'")
    assert rows(kept, "category_Id", "level_nine_id", "level_nine_name", "level_ten_id", "level_ten_name") == [
        (ten, "10" * 9, "H", ten, "I"), ("40", "", " ", "", " "),
    ]
    delta = product.category_delta(curr.filter("category_Id <> '20'"), curr)
    assert rows(delta, "CAT_ID", "CAT_PATH", "PARNT_CAT_ID", "CDC_IND_CD") == [("20", "NA", "NA", "I")]


# -------------------------------------------------------------------------------------------- sales


def test_sales(spark, write, stores):
    head = "ChannelName,StoreID,StoreName,CustomerID,CustomerName,EmployeeID,DateCreated,InvoiceNumber,LineID,ProductSKU,Price,Cost,RQPriority,Quantity,EmployeeName,SerialNumber,SpecialProductID\n"
    body = "M1,1,101 Main Street,,,11,2018-01-07T10:11:12.345,I1,1,S1,10.5,4,1,2,Ann,,\n,1,101 Main Street,5,Bo,11,2018-01-07T10:11:12,,2,S1,10.5,4,1,-1,Ann,,\nM1,9,999 Gone,5,Bo,11,2018-01-07T10:11:12,I2,1,S1,1,1,1,1,Ann,,\n"
    df = sales.ingest_sales(src.read_csv(spark, write("s.csv", head + body), sales.SALES_FEED))
    out = sales.refine_sales(df, stores, SITE)
    assert rows(out, "lineid", "reportdate", "storenumber", "saleamount", "rawgrossprofit", "invoicenumber", "ownmarket", "locationname", "sourcecustomerid") == [
        (1, "2018-01-07 10:11:12", 101, 21.0, 13.0, "I1", "M1", "Main Street", None),
        (2, "2018-01-07 10:11:12", 101, -10.5, -6.5, "NA", "NA", "Main Street", 5),
    ]
    assert len(out.columns) == 24 and conform.project(out, sales.SALES_DELIVERY).columns == list(sales.SALES_DELIVERY)


def test_traffic(spark, write, stores):
    path = write("t.csv", '7,"Main, Street",101,01/07/2018,10:00,5,In\n7,"Main, Street",101,01/07/2018,10:00,5,In\n8,X,999,01/07/2018,10:00,5,In\n')
    out = sales.refine_traffic(sales.ingest_traffic(src.read_csv(spark, path, sales.TRAFFIC_FEED)), stores, SITE)
    assert rows(out, "storenumber", "locationname", "trafficcount", "owndistrict", "sourcesystemname") == [(101, "Main, Street", "5", "D1", "SFTP")]
    assert conform.project(out, sales.TRAFFIC_DELIVERY).count() == 1


def test_leads(spark, write, stores, bridge, dealers):
    names = [*sales.LEAD_COLUMNS, "Own Market", "Own Region", "Own District", "BAE"]

    def line(**kw):
        return ",".join('"' + kw.get(n.replace(" ", "_"), "").replace('"', '""') + '"' for n in names)

    lead = dict(Master_Dealer="MD", Account="Acme\n\"Inc\"", Gross_Adds="3", Enter_Date="1/7/2018", Dealer_Code="AA1", Description="a/b\nc", Market="East", Own_Market="M1", Store_ID="x")
    text = [
        line(Account="Navigation help"), line(Account="Account", Master_Dealer="Master_Dealer"), line(**lead), line(**lead),
        line(**{**lead, "Dealer_Code": "#N/A"}), line(**{**lead, "Enter_Date": "soon"}), line(**{**lead, "Dealer_Code": "BB2"}),
        line(**{**lead, "Master_Dealer": ""}),
    ]
    raw = src.read_csv(spark, write("l.csv", ",".join(names) + "\n" + "\n".join(text) + "\n"), sales.lead_feed(SITE))
    df = sales.ingest_leads(raw, "2018-01-08")
    assert df.count() == 4 and df.first().storeid is None
    good, bad = sales.split_leads(df)
    assert bad.count() == 1
    out = sales.refine_leads(good, stores, bridge, dealers, SITE)
    assert rows(out, "reportdate", "storenumber", "customeraccountname", "description", "grossactivations", "attlocationname", "locationname", "ownmarket", "attmarket") == [
        (date(2018, 1, 8), 101, "Acme  Inc ", "a b c", 3, "Loc One", "Main Street", "M1", "East"),
    ]
    assert conform.project(out, sales.LEAD_DELIVERY).count() == 1


# -------------------------------------------------------------------------------------------- goals


def test_goals(spark, write, stores, employees):
    path = write("g.csv", 'Column1,,,,\nDate,Store,WTR,New/Upgrade 1,Units\n1/7/2018,101 Main,35%,"1,234",\n1/7/2018, ,1,1,1\n1/7/2018,999,1,1,1\nDate,Store,WTR,New/Upgrade 1,Units\n')
    head = src.first_lines(spark, path, goals.GOAL_HEADER_LINE + 1)
    report = src.read_report(spark, path, src.clean_names(head[1]), head)
    out = goals.refine_goals(report, stores, "2018-01-08", SITE)
    assert rows(out, "KPIName", "StoreNumber", "GoalValue", "OwnDistrict", "ReportDate") == [
        ("New/Upgrade 1", 101, D("1234.0000"), "D1", date(2018, 1, 8)), ("Units", 101, D("0.0000"), "D1", date(2018, 1, 8)),
        ("WTR", 101, D("0.3500"), "D1", date(2018, 1, 8)),
    ]
    assert goals.deliver_goals(out.unionByName(out)).count() == 3
    links = spark.createDataFrame([(101, 11, 4, 1), (101, 12, 4, 1), (101, 13, 4, 0)], "storenumber int, sourceemployeeid int, companycd int, primarylocationindicator int")
    heads = spark.createDataFrame([(101, "4")], "store_number int, approved_headcount string")
    shared = goals.refine_employee_goals(out, links, employees, heads, SITE)
    assert rows(shared, "sourceemployeeid", "kpiname", "goalvalue") == [
        (11, "New/Upgrade 1", 308.5), (11, "Units", 0.0), (11, "WTR", 0.35),
        (12, "New/Upgrade 1", 231.38), (12, "Units", 0.0), (12, "WTR", 0.35),
    ]
    assert conform.project(shared, goals.EMPLOYEE_GOAL_DELIVERY).count() == 6


def test_points_and_forecast(spark, write):
    points = src.read_csv(spark, write("p.csv", "Category,Points,Bonus,Decelerator\nWTR,5,1,0\nWTR,5,2,0\n"), goals.POINTS_FEED)
    out = goals.refine_points(points, points.limit(1), "2018-01-08", SITE)
    assert rows(out, "classification", "kpiname", "bonuspoints") == [("Employee", "WTR", "1"), ("Store", "WTR", "1")]
    assert conform.project(out, goals.POINTS_DELIVERY).columns == list(goals.POINTS_DELIVERY)
    raw = src.read_csv(spark, write("f.csv", "Date,Day % to Forecast,Gross Profit\n01/07/2018,3.5%,1\n1/8/2018,0.04,1\n2018-01-09,5%,1\n"), goals.FORECAST_FEED)
    good, bad = goals.split_forecast(raw)
    assert rows(conform.project(good, goals.FORECAST_DELIVERY)) == [("01/07/2018", D("0.0350")), ("1/8/2018", D("0.0400"))]
    assert rows(bad, "date") == [("2018-01-09",)]


# ------------------------------------------------------------------------------------------ reports


def test_headcount(spark, write, stores, bridge):
    head = ",".join(f'"{c}"' for c in reports.HEADCOUNT_NAMES)
    df = src.read_csv(spark, write("h.csv", head + "\n1,101 Main,5,1,1,2,1,0,0,0,0,6,1/7/2018\n2,205 Oak,5,1,1,2,1,0,0,0,0,6,1/7/2018\n3,,5,1,1,2,1,0,0,0,0,6,1/7/2018\n"), reports.HEADCOUNT_FEED)
    assert not src.is_empty_feed(df, reports.HEADCOUNT_MIN_ROWS)
    good, bad = reports.split_headcount(df)
    assert bad.count() == 1
    out = reports.refine_headcount(good, stores, bridge, SITE)
    assert rows(out, "store_number", "dealer_code", "approved_headcount", "location_name", "own_market") == [(101, "AA1", "6", "Main Street", "M1")]
    assert conform.project(out, reports.HEADCOUNT_DELIVERY).count() == 1


def test_experience(spark, write, stores, bridge, dealers):
    path = write("CustExp_201801071200.csv", "Dealer Code,Location,5 Key Behaviors,Effective Solutioning,Integrated Experience\n1,Main Street AA1,95.5%,80%,\n2,Oak Mall BB2,1%,1%,1%\n")
    out, bad = reports.refine_experience(src.read_csv(spark, path, reports.EXPERIENCE_FEED), stores, bridge, dealers, SITE)
    assert rows(out, "report_date", "store_number", "dealer_code", "att_market", "five_key_behaviors", "integrated_experience", "own_region") == [
        (date(2018, 1, 7), 101, "AA1", "East", D("0.9550"), None, "R1"),
    ]
    assert bad.isEmpty() and conform.project(out, reports.EXPERIENCE_DELIVERY).count() == 1


def test_efficiency(spark, write, employees):
    cols = reports.EFFICIENCY_COLUMNS

    def line(**kw):
        return ",".join('"' + kw.get(c.replace(" ", "_"), "") + '"' for c in cols)

    ok = dict(Market="M1", Region="R1", District="D1", Location="101 Main Street", Sales_Person="Ann", WorkDay_ID="w1", Total_Loss="($1,234.50)", NEXT_Trades="$1,000.00", Total_Issues="3", HR_Consulted_Before_Termination="Yes", Date="1/7/2018")
    text = [line(Market="Operational Efficiency"), ",".join(f'"{c}"' for c in cols), line(**ok), line(**{**ok, "WorkDay_ID": ""}), line(**{**ok, "Date": "soon"}), line(**{**ok, "WorkDay_ID": "w9"}), line(Market="M1")]
    path = write("e.csv", "x\n" + "\n".join(text) + "\n")
    raw = src.read_csv(spark, path, reports.EFFICIENCY_FEED)
    df = reports.ingest_efficiency(raw)
    assert df.count() == 4
    good, bad = reports.split_efficiency(df)
    assert bad.count() == 2
    out = reports.refine_efficiency(good, employees, SITE)
    assert rows(out, "sourceemployeeid", "storenumber", "locationname", "totallossamount", "nexttradesamount", "totalissuescount", "hrconsultationindicator") == [
        (11, 101, "Main Street", D("1234.50"), D("1000.00"), 3, 1),
    ]
    assert rows(reports.ingest_efficiency(raw, negative_parens=True).select("totalloss").distinct()) == [(D("-1234.50"),)]
    assert reports.deliver_efficiency(out).columns == list(reports.EFFICIENCY_DELIVERY)


def test_employee_adjustments(spark, write, employees):
    path = write("x_TransAdjEMP20180107.csv", 'Market,Region,District,Location,Loc,SalesPerson,SalesPersonID,Bill Credit,Chargeback\nM1,R1,D1,Main,101,Ann,w1,"1,234.50",0\nM1,R1,D1,Main,101,Zed,w9,1,1\n')
    out = reports.refine_employee_adjustments(src.read_csv(spark, path, reports.EMPLOYEE_ADJUSTMENT_FEED), employees, SITE)
    assert rows(out, "sourceemployeeid", "adjustmenttype", "adjustmentamount", "reportdate", "ownmarket") == [
        (11, "BillCredit", 1234.5, date(2018, 1, 7), "M1"), (11, "Chargeback", 0.0, date(2018, 1, 7), "M1"),
    ]
    assert conform.project(out, reports.EMPLOYEE_ADJUSTMENT_DELIVERY).count() == 2


def test_store_adjustments(spark, write):
    path = write("x_TransAdjStore20180107.csv", '18-Jan,,,,,GP,GP\nMarket,Region,District,Location,Loc,Rebate & Co,New %\nM1,R1,D1,Main,101,"$1,234.50",12.5%\n,,,,,,\nM1,R1,D1,None,,1,1%\n')
    head = src.first_lines(spark, path, 2)
    names = src.clean_names(src.merged_header(spark, path), reports.STORE_ADJUSTMENT_REPLACE)
    assert names[-2:] == ["GP|RebateCo", "GP|New%"]
    main = src.with_run_date(src.read_report(spark, path, names, head), "2018-01-07")
    misc = src.read_csv(spark, write("misc.csv", "Location,GP Adjustment,CRU Adjustment,Acc Elig Opps Adjustment,Total Opps Adjustment\n101 Main,$5.00,0E-8,,2\n999 Gone,1,1,1,1\n"), reports.MISC_FEED)
    out = reports.refine_store_adjustments(main, misc, SITE)
    assert rows(out.filter("adjustmentamount is not null"), "storenumber", "adjustmenttype", "adjustmentcategory", "adjustmentamount") == [
        ("101", "GP", "New%", D("0.12500000")), ("101", "GP", "RebateCo", D("1234.50000000")),
        ("101", "Miscellaneous", "cruadjustments", D("0E-8")), ("101", "Miscellaneous", "gpadjustments", D("5.00000000")),
        ("101", "Miscellaneous", "totaloppsadjustment", D("2.00000000")),
    ]
    assert out.count() == 6 and conform.project(out, reports.STORE_ADJUSTMENT_DELIVERY).count() == 6


# --------------------------------------------------------------------------------------------- KPIs


def test_sales_kpis(spark, write, tmp_path):
    catalog = spark.read.option("header", True).csv(
        write(
            "kpi.csv",
            "KPIName,Companycd,Classification,Description,Expression,FilterCondition,FromClause,GroupByColumns,CalculationLevel,CalculationIndicator,PublishIndicator,PrimaryIndicator,LveTableName\n"
            'Gross,4,,,sum(rawgrossprofit),,SalesDetails s,"s.sourceemployeeid,s.storenumber,getOnlyDate(s.invoicedate)",0,,,,\n'
            'Doors,4,,,sum(traffic),where traffictype = \'In\',StoreTraffic,storenumber,0,,,,\n',
        )
    )
    views = {
        "SalesDetails": spark.createDataFrame([(11, 101, "2018-01-07 10:00:00", 5.0)], "sourceemployeeid int, storenumber int, invoicedate string, rawgrossprofit double"),
        "StoreTraffic": spark.createDataFrame([(101, 4, "In"), (101, 9, "Out")], "storenumber int, traffic int, traffictype string"),
    }
    values = kpi.sales_kpis(spark, catalog, views)
    stored = kpi.store_kpis(values, src.Snapshots(spark, f"{tmp_path}/kpi"), "20180107", date(2018, 1, 7))
    assert rows(stored) == [(11, "101", date(2018, 1, 7), "Gross", 5.0, 4), (None, "101", None, "Doors", 4.0, 4)]
    with pytest.raises(ValueError):
        kpi.sales_kpis(spark, catalog, {"Other": views["StoreTraffic"]})
