"""Headcount, customer experience, operational efficiency and transaction adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import clean as fn
from ...operators import dedup, quality, shape
from ...operators import conforming as conform
from ...sources.feeds import FeedSpec, cast_columns
from .site import Site, squash

# Headcount feed columns and their refined names.
HEADCOUNT_NAMES = {
    "Store Number": "store_number",
    "Store Name": "store_name",
    "Headcount": "actual_headcount",
    "Store Manager": "store_managers_count",
    "BAM 1 & 2": "business_assistant_manager_count",
    "FTEC": "fulltime_equivalent_count",
    "PTEC": "parttime_equivalent_count",
    "Other": "fulltime_floater_count",
    "DLSC": "district_lead_sales_consultant_count",
    "MIT": "mit_count",
    "Seasonal": "seasonal_count",
    "Approved HC": "approved_headcount",
    "Date": "report_date",
}
HEADCOUNT_FEED = FeedSpec(
    "headcount", schema=", ".join(f"`{c}` string" for c in HEADCOUNT_NAMES), columns=HEADCOUNT_NAMES
)
HEADCOUNT_MIN_ROWS = 1


def split_headcount(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quality.split_stored(df, {"store_name": quality.required("store_name")})


def refine_headcount(good: DataFrame, stores: DataFrame, bridge: DataFrame, site: Site = Site()) -> DataFrame:
    """Headcount of stores with an active retail dealer."""
    number = fn.split_key_label("store_name")[0].try_cast("int")
    rows = good.withColumns({"store_number": number, "companycd": F.lit(site.company_cd)})
    rows = conform.enrich(
        rows, stores, {"store_number": "StoreNumber"}, {"LocationName": "location_name", **site.geography("_")}
    )
    rows = conform.bridge_lookup(
        rows,
        conform.active_bridge(bridge),
        {"store_number": "StoreNumber"},
        {"DealerCode": "dealer_code"},
        how="inner",
    )
    return rows.drop("store_name")


# Delivery names of headcount.
HEADCOUNT_DELIVERY = {
    "RPT_DT": "report_date",
    "STORE_NUM": "store_number",
    "CO_CD": "companycd",
    "APRV_HEAD_CNT": "approved_headcount",
    "SMS_CNT": "store_managers_count",
    "BUS_ASST_MGR_CNT": "business_assistant_manager_count",
    "FTM_EQUIV_CNT": "fulltime_equivalent_count",
    "PRTTM_EQUIV_CNT": "parttime_equivalent_count",
    "FTM_FLOATER_CNT": "fulltime_floater_count",
    "DSTRC_LEAD_SALES_CNSLT_CNT": "district_lead_sales_consultant_count",
    "MIT_CNT": "mit_count",
    "SEAS_CNT": "seasonal_count",
    "ACTL_HDCT": "actual_headcount",
    "DLR_CD": "dealer_code",
}

EXPERIENCE_REQUIRED = [
    "Dealer Code",
    "Location",
    "5 Key Behaviors",
    "Effective Solutioning",
    "Integrated Experience",
]
EXPERIENCE_SCORES = ["five_key_behaviors", "effective_solutioning", "integrated_experience"]
EXPERIENCE_FILE_DATE = (r"_(\d{12})\.", "yyyyMMddHHmm")
EXPERIENCE_FEED = FeedSpec(
    "experience",
    columns={
        **{c: c.lower().replace(" ", "_").replace("5", "five") for c in EXPERIENCE_REQUIRED},
        "reportdate": "report_date",
    },
    multiline=True,
    file_date=EXPERIENCE_FILE_DATE,
)


def refine_experience(
    df: DataFrame, stores: DataFrame, bridge: DataFrame, dealers: DataFrame, site: Site = Site()
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) experience scores as fractions, placed by the dealer code that ends the location text."""
    rows = df.withColumns(
        {
            "dealer_code": fn.last_token("location"),
            "companycd": F.lit(site.company_cd),
            **{c: fn.parse_percent(c, always=True) for c in EXPERIENCE_SCORES},
        }
    )
    rows = conform.enrich(
        rows,
        dealers,
        {"dealer_code": "dealercode"},
        {"attmarket": "att_market", "attlocationname": "att_location_name", "attregion": "att_region"},
    )
    rows = conform.bridge_lookup(
        rows,
        conform.active_bridge(bridge),
        {"dealer_code": "DealerCode"},
        {"StoreNumber": "store_number"},
        how="inner",
    )
    good, bad = quality.split_stored(rows, {"store_number": quality.numeric("store_number")})
    out = conform.enrich(
        good, stores, {"store_number": "StoreNumber"}, {"LocationName": "location_name", **site.geography("_")}
    )
    low = site.own.lower()
    return (
        out.select(
            "report_date",
            "store_number",
            "companycd",
            "location_name",
            *[f"{low}_{x}" for x in ("district", "region", "market")],
            "dealer_code",
            "att_location_name",
            "att_region",
            "att_market",
            *EXPERIENCE_SCORES,
        ).distinct(),
        bad,
    )


# Delivery names of experience scores.
EXPERIENCE_DELIVERY = {
    "RPT_DT": "report_date",
    "STORE_NUM": "store_number",
    "CO_CD": "companycd",
    "FIVE_KEY_BHVS": "five_key_behaviors",
    "EFC_SLTNING": "effective_solutioning",
    "NTGRTD_EXPRC": "integrated_experience",
    "DLR_CD": "dealer_code",
}

# Columns of the operational efficiency report; the number tells repeated device counts apart.
EFFICIENCY_COLUMNS = [
    "Market", "Region", "District", "Location", "Sales Person", "WorkDay ID", "Total Loss", "Total Issues",
    "Action Taken", "HR Consulted Before Termination", "Transaction Errors", "Total Errors", "NEXT Trades",
    "Total Devices12", "Hyla Loss", "Total Devices14", "Denied RMA Devices", "Total Devices16", "Cash Deposits",
    "Total Missing Deposits", "Total Short Deposits", "Shrinkage", "Comments", "Date",
]
EFFICIENCY_HEADER_LINE = 1
EFFICIENCY_NOISE = ["%Marke%", "%Operational%", " Regio%"]
EFFICIENCY_MONEY = [
    "totalloss", "transactionerrors", "nexttrades", "hylaloss", "deniedrmadevices", "cashdeposits", "shrinkage",
]
EFFICIENCY_COUNTS = [
    "totalissues", "totalerrors", "totaldevices12", "totaldevices14", "totaldevices16", "totalmissingdeposits",
    "totalshortdeposits",
]
EFFICIENCY_FEED = FeedSpec(
    "operational_efficiency",
    schema=", ".join(f"`{c}` string" for c in EFFICIENCY_COLUMNS),
    multiline=True,
    columns={**{c: squash(c) for c in EFFICIENCY_COLUMNS}, "Date": "reportdate"},
    noise={"Market": EFFICIENCY_NOISE},
    not_blank=["Market", "Region", "District"],
)


def ingest_efficiency(raw: DataFrame, negative_parens: bool = False) -> DataFrame:
    """Typed amounts and counts; a parenthesised loss stays positive unless ``negative_parens``."""
    money = {c: fn.parse_money(c, negative_parens=negative_parens) for c in EFFICIENCY_MONEY}
    return cast_columns(raw.withColumns(money), dict.fromkeys(EFFICIENCY_COUNTS, "int"))


def split_efficiency(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quality.split_stored(
        df, {"workday_id": quality.not_blank("workdayid"), "report_date": quality.date_like("reportdate")}
    )


def refine_efficiency(good: DataFrame, employees: DataFrame, site: Site = Site()) -> DataFrame:
    store, location = fn.split_key_label("location")
    known = employees.filter(quality.not_blank("workdayid"))
    rows = conform.enrich(good, known, ["workdayid"], ["sourceemployeeid"], how="inner")
    low = site.own.lower()
    spec = {
        "reportdate": "reportdate",
        "sourceemployeeid": "sourceemployeeid",
        "companycd": F.lit(site.company_cd),
        "sourcesystemname": F.lit(site.sheet_system),
        "employeename": "salesperson",
        "totallossamount": "totalloss",
        "totalissuescount": "totalissues",
        "actiontaken": "actiontaken",
        "hrconsultationindicator": fn.to_flag("hrconsultedbeforetermination", ("yes", "true"), ("no", "false")),
        "transactionerrorsamount": "transactionerrors",
        "transactionerrorscount": "totalerrors",
        "nexttradesamount": "nexttrades",
        "nexttradesdevicecount": "totaldevices12",
        "hylalossamount": "hylaloss",
        "hyladevicecount": "totaldevices14",
        "deniedrmadevicesamount": "deniedrmadevices",
        "deniedrmadevicescount": "totaldevices16",
        "cashdepositsamount": "cashdeposits",
        "totalmissingdepositscount": "totalmissingdeposits",
        "totalshortdepositscount": "totalshortdeposits",
        "shrinkageamount": "shrinkage",
        "losscomments": "comments",
        "storenumber": store.try_cast("int"),
        "locationname": location,
        f"{low}market": "market",
        f"{low}region": "region",
        f"{low}district": "district",
    }
    keys = ["reportdate", "sourceemployeeid", "companycd", "sourcesystemname"]
    return dedup.drop_key_duplicates(conform.project(rows, spec), keys)


# Delivery names of operational efficiency.
EFFICIENCY_DELIVERY = {
    "RPT_DT": "reportdate",
    "SRC_EMP_ID": "sourceemployeeid",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystemname",
    "TTL_LOSS_AMT": "totallossamount",
    "TTL_ISUS_CNT": "totalissuescount",
    "ACTN_TAKN": "actiontaken",
    "HR_CNSLTATION_IND": "hrconsultationindicator",
    "TRANS_ERRS_AMT": "transactionerrorsamount",
    "TRANS_ERRS_CNT": "transactionerrorscount",
    "NXT_TRDS_AMT": "nexttradesamount",
    "NXT_TRDS_DVC_CNT": "nexttradesdevicecount",
    "HYLA_LOSS_AMT": "hylalossamount",
    "HYLA_DVC_CNT": "hyladevicecount",
    "DNY_RMA_DVC_AMT": "deniedrmadevicesamount",
    "DNY_RMA_DVC_CNT": "deniedrmadevicescount",
    "CSH_DPSTS_AMT": "cashdepositsamount",
    "TTL_MISSING_DPSTS_CNT": "totalmissingdepositscount",
    "TTL_SHRT_DPSTS_CNT": "totalshortdepositscount",
    "SHRNKAGE_AMT": "shrinkageamount",
    "LOSS_CMNT": "losscomments",
    "STORE_NUM": "storenumber",
}


def deliver_efficiency(rows: DataFrame) -> DataFrame:
    return conform.project(rows, EFFICIENCY_DELIVERY).distinct()


# Id columns of the employee adjustment report; every other column is an adjustment type.
EMPLOYEE_ADJUSTMENT_IDS = ["Market", "Region", "District", "Location", "Loc", "SalesPerson", "SalesPersonID"]
EMPLOYEE_ADJUSTMENT_FILE_DATE = (r"TransAdjEMP_?(\d{8})", "yyyyMMdd")
EMPLOYEE_ADJUSTMENT_FEED = FeedSpec("employee_adjustments", file_date=EMPLOYEE_ADJUSTMENT_FILE_DATE)


def refine_employee_adjustments(df: DataFrame, employees: DataFrame, site: Site = Site()) -> DataFrame:
    """One row per known sales person and adjustment type."""
    rows = df.toDF(*[c.replace(" ", "") for c in df.columns])
    long = shape.unpivot_measures(
        rows,
        [*EMPLOYEE_ADJUSTMENT_IDS, "reportdate"],
        name_col="adjustmenttype",
        value_col="adjustmentamount",
        value_type="string",
    )
    long = long.withColumn("adjustmentamount", fn.parse_money("adjustmentamount", "decimal(20,8)").cast("double"))
    known = employees.filter(quality.required("sourceemployeeid"))
    long = conform.enrich(long, known, {"SalesPersonID": "workdayid"}, ["sourceemployeeid"], how="inner")
    low = site.own.lower()
    spec = {
        f"{low}market": "Market",
        f"{low}region": "Region",
        f"{low}district": "District",
        "employeename": "SalesPerson",
        "reportdate": "reportdate",
        "adjustmenttype": "adjustmenttype",
        "adjustmentamount": "adjustmentamount",
        "sourceemployeeid": "sourceemployeeid",
        "sourcesystemname": F.lit(site.transfer_system),
        "companycd": F.lit(site.company_cd),
    }
    return conform.project(long, spec)


# Delivery names of employee adjustments.
EMPLOYEE_ADJUSTMENT_DELIVERY = {
    "RPT_DT": "reportdate",
    "SRC_EMP_ID": "sourceemployeeid",
    "ADJMNT_TYP": "adjustmenttype",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystemname",
    "ADJMNT_AMT": "adjustmentamount",
}

# The store adjustment report has two header lines; these columns carry one cell only.
STORE_ADJUSTMENT_IDS = ["Market", "Region", "District", "Location", "Loc"]
STORE_ADJUSTMENT_REPLACE = {" ": "", "&": "", "/": "OR"}
STORE_ADJUSTMENT_FILE_DATE = (r"TransAdjStore_?(\d{8})", "yyyyMMdd")
MISC_NAMES = {
    "GP Adjustment": "Miscellaneous|gpadjustments",
    "CRU Adjustment": "Miscellaneous|cruadjustments",
    "Acc Elig Opps Adjustment": "Miscellaneous|acceligoppsadjustment",
    "Total Opps Adjustment": "Miscellaneous|totaloppsadjustment",
}
MISC_FEED = FeedSpec("misc_adjustments", multiline=True)


def refine_store_adjustments(main: DataFrame, misc: DataFrame, site: Site = Site()) -> DataFrame:
    """Main report (``type|category`` columns) and side report in one long table.

    A column named with a percent sign holds percentages.  Side rows need a store of the main report.
    """
    geography = ["Market", "Region", "District", "Location", "reportdate"]
    kinds = ["adjustmenttype", "adjustmentcategory"]

    def melt(df: DataFrame) -> DataFrame:
        ids = [*geography, "Loc"]
        percents = [c for c in df.columns if c not in ids and "%" in c]
        df = df.withColumns({c: fn.parse_percent(c, "decimal(20,8)", always=True).cast("string") for c in percents})
        return shape.unpivot_measures(
            df, ids, value_col="adjustmentamount", value_type="string", name_parts=kinds, sep="|"
        )

    rows = main.filter(quality.not_blank("Loc"))
    side = conform.rename(misc, MISC_NAMES).withColumn("__store", fn.split_key_label("Location")[0])
    side = conform.enrich(
        rows.select(*geography, "Loc"), side, {"Loc": "__store"}, list(MISC_NAMES.values()), how="inner", unique=False
    )
    long = conform.union_sources(melt(rows), melt(side))
    low = site.own.lower()
    spec = {
        f"{low}market": "Market",
        "reportdate": "reportdate",
        f"{low}region": "Region",
        f"{low}district": "District",
        "locationname": "Location",
        "storenumber": "Loc",
        "adjustmenttype": "adjustmenttype",
        "adjustmentcategory": "adjustmentcategory",
        "adjustmentamount": fn.parse_money("adjustmentamount", "decimal(20,8)"),
        "companycd": F.lit(site.company_cd),
    }
    return conform.project(long, spec)


# Delivery names of store adjustments.
STORE_ADJUSTMENT_DELIVERY = {
    "RPT_DT": "reportdate",
    "STORE_NUM": "storenumber",
    "ADJMNT_CAT": "adjustmentcategory",
    "ADJMNT_TYP": "adjustmenttype",
    "CO_CD": "companycd",
    "ADJMNT_AMT": "adjustmentamount",
}
