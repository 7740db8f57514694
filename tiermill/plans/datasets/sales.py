"""Sales lines, store traffic and sales leads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import clean as fn
from ...operators import dedup, quality
from ...operators import conforming as conform
from ...sources.feeds import FeedSpec, cast_columns, with_run_date
from .site import Site, squash

# Declared schema of the sales feed.
SALES_SCHEMA = (
    "channelname string, storeid int, storename string, customerid int, customername string, employeeid int, "
    "datecreated string, invoicenumber string, lineid int, productsku string, price double, cost double, "
    "rqpriority int, quantity int, employeename string, serialnumber string, specialproductid int"
)
SALES_FEED = FeedSpec("sales_details", schema=SALES_SCHEMA)
SALES_MIN_COLUMNS = 17

# Defaults of key and label columns of a sales line.
NOT_AVAILABLE, NO_NUMBER = "NA", -1


def ingest_sales(raw: DataFrame) -> DataFrame:
    return raw.withColumn("datecreated", fn.iso_to_timestamp_text("datecreated"))


def refine_sales(df: DataFrame, stores: DataFrame, site: Site = Site()) -> DataFrame:
    """Sales lines of known stores with amount and gross profit."""
    own = site.own
    low = site.geography()
    rows = conform.sales_measures(df).withColumn(
        "storenumber", fn.split_key_label("storename")[0].try_cast("int")
    )
    rows = conform.enrich(
        rows,
        stores,
        {"storenumber": "StoreNumber"},
        {
            f"{own}Region": low[f"{own}Region"],
            f"{own}District": low[f"{own}District"],
            "LocationName": "locationname",
        },
        how="inner",
    )
    spec = {
        "reportdate": "datecreated",
        "storenumber": "storenumber",
        "productsku": "productsku",
        "invoicenumber": "invoicenumber",
        "lineid": "lineid",
        "sourceemployeeid": "employeeid",
        "companycd": F.lit(site.company_cd),
        "sourcesystemname": F.lit(site.pos_system),
        "invoicedate": "datecreated",
        "sourcecustomerid": "customerid",
        "productserialnumber": "serialnumber",
        "customername": "customername",
        "employeename": "employeename",
        "price": "price",
        "cost": "cost",
        "rqpriority": "rqpriority",
        "quantity": "quantity",
        "specialproductid": "specialproductid",
        "rawgrossprofit": "rawgrossprofit",
        "saleamount": "saleamount",
        low[f"{own}Market"]: "channelname",
        low[f"{own}Region"]: low[f"{own}Region"],
        low[f"{own}District"]: low[f"{own}District"],
        "locationname": "locationname",
    }
    text = ["reportdate", "productsku", "invoicenumber", "employeename", *low.values(), "locationname"]
    return quality.with_defaults(
        conform.project(rows, spec), {**dict.fromkeys(text, NOT_AVAILABLE), "lineid": NO_NUMBER}
    )


# Delivery names of sales lines.
SALES_DELIVERY = {
    "RPT_DT": "reportdate",
    "STORE_NUM": "storenumber",
    "PROD_SKU": "productsku",
    "INVOICE_NBR": "invoicenumber",
    "LINE_ID": "lineid",
    "SRC_EMP_ID": "sourceemployeeid",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystemname",
    "INVOICE_DT": "invoicedate",
    "SRC_CUST_ID": "sourcecustomerid",
    "PROD_SN": "productserialnumber",
    "PRC": "price",
    "CST": "cost",
    "RQ_PRITY": "rqpriority",
    "QTY": "quantity",
    "SPCL_PROD_ID": "specialproductid",
    "RAW_GRS_PRFT": "rawgrossprofit",
    "SALE_AMT": "saleamount",
}

# Columns of the headerless traffic feed.
TRAFFIC_SCHEMA = (
    "shoppertraklocationid string, storename string, storenumber string, trafficdate string, traffictime string, "
    "traffic string, traffictype string"
)
TRAFFIC_FEED = FeedSpec("store_traffic", schema=TRAFFIC_SCHEMA, header=False)


def ingest_traffic(raw: DataFrame) -> DataFrame:
    return cast_columns(raw, {"shoppertraklocationid": "int", "storenumber": "int"})


def refine_traffic(df: DataFrame, stores: DataFrame, site: Site = Site()) -> DataFrame:
    rows = conform.enrich(df, stores, {"storenumber": "StoreNumber"}, site.geography(), how="inner")
    spec = {
        "reportdate": "trafficdate",
        "storenumber": "storenumber",
        "trafficdate": "trafficdate",
        "traffictime": "traffictime",
        "companycd": F.lit(site.company_cd),
        "locationname": "storename",
        "sourcesystemlocationid": "shoppertraklocationid",
        "sourcesystemname": F.lit(site.transfer_system),
        "traffictype": "traffictype",
        "trafficcount": "traffic",
        **{c: c for c in site.geography().values()},
    }
    return conform.project(rows, spec).distinct()


# Delivery names of store traffic (quoted).
TRAFFIC_DELIVERY = {
    "RPT_DT": "reportdate",
    "STORE_NUM": "storenumber",
    "TRAFFIC_DT": "trafficdate",
    "TRAFFIC_TM": "traffictime",
    "CO_CD": "companycd",
    "SRC_SYS_LOC_ID": "sourcesystemlocationid",
    "SRC_SYS_NM": "sourcesystemname",
    "TRAFFIC_TYP": "traffictype",
    "TRAFFIC_CNT": "trafficcount",
}

# Leading columns of the leads feed; the site's geography and the expert follow.
LEAD_COLUMNS = [
    "Master_Dealer", "Region", "Market", "DOS", "ARSM", "Store_Name", "Store_ID", "Account", "Description",
    "Contact_Info", "Win_The_Neighborhood", "Customer_ZIP", "Existing_Customer", "FAN", "Rep_Name",
    "Rep_Dealer_Code", "Status", "Gross_Adds", "SB_Assistance_Requested", "Enter_Date", "Close_Date",
    "Follow_Up_Notes", "FirstNet", "Last_Update", "Dealer Code",
]
LEAD_HEADER_LINE = 9

# Instruction rows and the repeated header of the leads report.
LEAD_NOISE = [
    "Navigat%",
    "1. Click on buttons to drill down %",
    "2. To Click on multiple%",
    "Click on 1st button%",
    "3. To clear your %",
    "Account",
]
MISSING_DEALER = "#N/A"
TEXT_NOISE = r'[\r\n\\/"]'


def lead_feed(site: Site = Site()) -> FeedSpec:
    names = [*LEAD_COLUMNS, *[f"{site.own} {x}" for x in ("Market", "Region", "District")], "BAE"]
    return FeedSpec(
        "sales_leads",
        schema=", ".join(f"`{n}` string" for n in names),
        multiline=True,
        columns={n: squash(n) for n in names},
        noise={"Account": LEAD_NOISE, "Dealer Code": [MISSING_DEALER]},
        not_blank=["Master_Dealer"],
    )


def ingest_leads(raw: DataFrame, run_date: str) -> DataFrame:
    """Scrubbed text, typed counts and the run date as report date."""
    plain = [c for c in raw.columns if c != "description"]
    rows = fn.scrub_text(fn.scrub_text(raw, plain), ["description"], TEXT_NOISE)
    rows = cast_columns(
        rows, {"storeid": "int", "firstnet": "int", "grossadds": "int", "sbassistancerequested": "int"}
    )
    return with_run_date(rows, run_date)


def split_leads(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quality.split_stored(df, {"enter_date": quality.date_like("enterdate")})


def refine_leads(
    good: DataFrame, stores: DataFrame, bridge: DataFrame, dealers: DataFrame, site: Site = Site()
) -> DataFrame:
    """Leads of dealers with an active retail association."""
    rows = fn.scrub_text(good, ["account", "repname"], TEXT_NOISE)
    rows = conform.bridge_lookup(
        rows,
        conform.active_bridge(bridge),
        {"dealercode": "DealerCode"},
        {"StoreNumber": "storenumber"},
        how="inner",
    )
    rows = conform.enrich(rows, stores, {"storenumber": "StoreNumber"}, {"LocationName": "locationname"})
    rows = conform.enrich(rows, dealers, ["dealercode"], ["attlocationid", "attlocationname"])
    own = site.own.lower()
    spec = {
        "reportdate": "reportdate",
        "storenumber": "storenumber",
        "dealercode": "dealercode",
        "companycd": F.lit(site.company_cd),
        **{f"{own}{x}": f"{own}{x}" for x in ("market", "region", "district")},
        "attdirectorofsales": "dos",
        "attregionsalesmanager": "arsm",
        "customeraccountname": "account",
        "currencustomerindicator": "existingcustomer",
        "salesrepresentativename": "repname",
        "leadstatus": "status",
        "grossactivations": "grossadds",
        "sbassistancerequestindicator": "sbassistancerequested",
        "entereddate": "enterdate",
        "closeddate": "closedate",
        "lastupdatedate": "lastupdate",
        "baeemployeename": "bae",
        "description": "description",
        "contactinfo": "contactinfo",
        "fan": "fan",
        "attlocationid": "attlocationid",
        "attlocationname": "attlocationname",
        "attmarket": "market",
        "attregion": "region",
        "locationname": "locationname",
        "sourcesystemname": F.lit(site.file_system),
    }
    return dedup.distinct_rows(conform.project(rows, spec))


# Delivery names of sales leads (quoted).
LEAD_DELIVERY = {
    "RPT_DT": "reportdate",
    "STORE_NUM": "storenumber",
    "DLR_CD": "dealercode",
    "CO_CD": "companycd",
    "BAE_NME": "baeemployeename",
    "SRC_SYS_NM": "sourcesystemname",
    "CUST_ACCT_NM": "customeraccountname",
    "ATT_DIR_OF_SALES": "attdirectorofsales",
    "ATT_RGN_SALES_MGR": "attregionsalesmanager",
    "CRNT_CUST_IND": "currencustomerindicator",
    "SALES_REP_NME": "salesrepresentativename",
    "GRS_ACTVNGS": "grossactivations",
    "LEAD_STAT": "leadstatus",
    "SB_ASST_RQST_IND": "sbassistancerequestindicator",
    "ENTR_DT": "entereddate",
    "CLOS_DT": "closeddate",
    "LST_UPDT_DT": "lastupdatedate",
    "DESCRIPTION": "description",
    "CNTCT_INFO": "contactinfo",
    "FAN": "fan",
}
