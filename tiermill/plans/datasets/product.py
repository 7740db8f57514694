"""Products with coupons and identifiers, and the product category tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import clean as fn
from ...operators import cdc, dedup, quality
from ...operators import conforming as conform
from ...sources.feeds import FeedSpec
from .site import Site

PRODUCT_FEED = FeedSpec("product", multiline=True)
COUPON_FEED = FeedSpec("coupons", multiline=True)
IDENTIFIER_FEED = FeedSpec("product_identifier", multiline=True)
CATEGORY_FEED = FeedSpec(
    "product_category",
    columns={
        "ID": "id",
        "Description": "description",
        "CategoryPath": "categorypath",
        "ParentID": "parentid",
        "Enabled": "enabled",
    },
)

# Minimum column counts of the files.
MIN_COLUMNS = {"product": 61, "coupons": 5, "product_identifier": 4, "product_category": 5}

# Product columns whose refined name is not the lower-case header.
PRODUCT_NAMES = {
    "averagecos": "averagecost",
    "defaultminqty": "defaultminimumquantity",
    "defaultmaxqty": "defaultmaximumquantity",
    "nosale": "nosaleflag",
    "invoicecomments": "defaultinvoicecomments",
    "datecreated": "datecreatedatsource",
    "costofgoodssoldaccount": "costaccount",
    "salesrevenueaccount": "revenueaccount",
    "inventoryaccount": "inventoryaccount",
    "serialized": "serializedproductindicator",
    "enabled": "productactiveindicator",
}

# Refined product columns in order.
PRODUCT_COLUMNS = [
    "productsku", "companycd", "productname", "productlabel", "categoryid", "defaultcost", "averagecost", "unitcost",
    "mostrecentcost", "manufacturer", "manufacturerpartnumber", "pricingtype", "defaultretailprice", "defaultmargin",
    "floorprice", "pawfloorprice", "defaultminimumquantity", "defaultmaximumquantity", "lockminmax", "nosaleflag",
    "rmadays", "defaultinvoicecomments", "serializedproductindicator", "serialnumberlength", "discountable",
    "defaultdiscontinueddate", "datecreatedatsource", "productactiveindicator", "ecommerceitem", "warehouselocation",
    "defaultvendorname", "primaryvendorsku", "costaccount", "revenueaccount", "inventoryaccount",
    "inventorycorrectionsaccount", "warrantydescription", "rmanumberrequired", "warrantylengthunits",
    "warrantylengthvalue", "commissiondetailslocked", "showoninvoice", "refundable", "refundperiodlength",
    "refundtoused", "triggerservicerequestonsale", "servicerequesttype", "multilevelpricedetailslocked",
    "backorderdate", "storeinstoresku", "storeinstoreprice", "defaultdonotorder", "defaultspecialorder",
    "defaultdateeol", "defaultwriteoff", "noautotaxes",
]
PRODUCT_FLAGS = [
    "lockminmax", "nosaleflag", "serializedproductindicator", "discountable", "productactiveindicator",
    "ecommerceitem", "rmanumberrequired", "commissiondetailslocked", "showoninvoice", "refundable", "refundtoused",
    "triggerservicerequestonsale", "multilevelpricedetailslocked", "defaultdonotorder", "defaultspecialorder",
    "defaultwriteoff", "noautotaxes",
]
COUPON_CATEGORY = "20"


def lower_headers(raw: DataFrame) -> DataFrame:
    names = [c.lower() for c in raw.columns]
    return raw.toDF(*[PRODUCT_NAMES.get(n, n) for n in names])


def split_products(
    product: DataFrame, identifier: DataFrame, coupons: DataFrame
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(good, bad) per file by required key."""
    rules = {
        "product": (lower_headers(product), "productsku"),
        "identifier": (identifier, "ID"),
        "coupons": (coupons, "CouponSKU"),
    }
    split = {n: quality.split_stored(df, {f"{k} missing": quality.required(k)}) for n, (df, k) in rules.items()}
    return {n: s[0] for n, s in split.items()}, {n: s[1] for n, s in split.items()}


def refine_product(good: dict[str, DataFrame], site: Site = Site()) -> DataFrame:
    """Products with their category plus coupons padded to the same columns; one row per SKU, products first."""
    product = conform.enrich(
        good["product"], good["identifier"], {"productsku": "ID"}, {"CategoryNumber": "categoryid"}, unique=False
    )
    made = {
        "companycd": F.lit(site.company_cd),
        "productname": fn.ascii_only("productname"),
        "productlabel": fn.ascii_only("productlabel"),
        "primaryvendorsku": fn.unquote("primaryvendorsku"),
        "categoryid": F.col("categoryid").cast("string"),
        **{c: fn.to_flag(c, ("true",), other=F.lit(0)) for c in PRODUCT_FLAGS},
    }
    products = conform.project(product, {c: made.get(c, c) for c in PRODUCT_COLUMNS})
    coupons = good["coupons"].select(
        F.col("CouponSKU").alias("productsku"),
        F.lit(site.company_cd).alias("companycd"),
        F.col("CouponName").alias("productname"),
        F.col("CouponLabel").alias("productlabel"),
        F.lit(COUPON_CATEGORY).alias("categoryid"),
        fn.to_flag("EnabledStatus", ("Enabled",), other=F.lit(0)).alias("productactiveindicator"),
    )
    both = conform.union_sources(
        products.withColumn("__coupon", F.lit(0)), coupons.withColumn("__coupon", F.lit(1))
    )
    return dedup.keep_latest(both, ["productsku"], [F.col("__coupon").asc()]).drop("__coupon")


# Delivery names of the product table.
PRODUCT_DELIVERY = {
    "PROD_SKU": "productsku",
    "CO_CD": "companycd",
    "PROD_NME": "productname",
    "PROD_LBL": "productlabel",
    "CAT_ID": "categoryid",
    "DFLT_COST": "defaultcost",
    "AVERAGE_CST": "averagecost",
    "UNT_CST": "unitcost",
    "MST_RCNT_CST": "mostrecentcost",
    "MFR": "manufacturer",
    "MFR_PRT_NBR": "manufacturerpartnumber",
    "PRC_TYP": "pricingtype",
    "DFLT_RTL_PRC": "defaultretailprice",
    "DFLT_MRGN": "defaultmargin",
    "FLOOR_PRC": "floorprice",
    "DFLT_MIN_QTY": "defaultminimumquantity",
    "DFLT_MAX_QTY": "defaultmaximumquantity",
    "NO_SALE_IND": "nosaleflag",
    "RMA_DAY": "rmadays",
    "DFLT_INV_CMNT": "defaultinvoicecomments",
    "DSCNT_IND": "discountable",
    "DFLT_DSCNT_DT": "defaultdiscontinueddate",
    "DT_CRT_AT_SRC": "datecreatedatsource",
    "PROD_ACT_IND": "productactiveindicator",
    "ECOM_ITM_IND": "ecommerceitem",
    "WHSE_LOC": "warehouselocation",
    "DFLT_VNDR_NME": "defaultvendorname",
    "PRI_VNDR_SKU": "primaryvendorsku",
    "CST_ACCT": "costaccount",
    "RVNU_ACCT": "revenueaccount",
    "INV_ACCT": "inventoryaccount",
    "INV_CRCT_ACCT": "inventorycorrectionsaccount",
    "RMA_NBR_RQMT_IND": "rmanumberrequired",
    "WRNTY_LEN_UNTS": "warrantylengthunits",
    "WRNTY_LEN_VAL": "warrantylengthvalue",
    "CMSN_DTL_LCK_IND": "commissiondetailslocked",
    "SHOW_ON_INV_IND": "showoninvoice",
    "SRIALIZED_PROD_IND": "serializedproductindicator",
    "REFND_IND": "refundable",
    "REFND_PRD_LEN": "refundperiodlength",
    "REFND_TO_USED_IND": "refundtoused",
    "SRVC_RQST_TYP": "servicerequesttype",
    "MLTI_LVL_PRC_DTL_LCK_IND": "multilevelpricedetailslocked",
    "BAK_ORD_DT": "backorderdate",
    "STORE_INSTORE_SKU": "storeinstoresku",
    "STORE_INSTORE_PRC": "storeinstoreprice",
    "DFLT_DO_NOT_ORD_IND": "defaultdonotorder",
    "DFLT_SPCL_ORD_IND": "defaultspecialorder",
    "DFLT_DT_EOL": "defaultdateeol",
    "DFLT_WRT_OFF_IND": "defaultwriteoff",
    "NO_AUTO_TAXES_IND": "noautotaxes",
}


def product_delta(prev: DataFrame | None, curr: DataFrame) -> DataFrame:
    """Changes among the delivered columns only."""
    before = None if prev is None else conform.project(prev, PRODUCT_DELIVERY)
    return cdc.delta(before, conform.project(curr, PRODUCT_DELIVERY), ["PROD_SKU"], flag="CDC_IND_CD")


# Level names of the category tree.
LEVEL_WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"]
ROOT_NAME, SECOND_NAME = "Inventory Tree", "Products"
ID_WIDTH, PATH_SEPARATOR = 2, ">>"
# What the levels that few trees reach hold where there is no such level.
RARE_LEVELS = {"nine": ("", " "), "ten": ("", " ")}


def ingest_category(raw: DataFrame) -> DataFrame:
    rows = raw.select(F.col("id").cast("string").alias("id"), "description", "categorypath", "parentid", "enabled")
    return dedup.drop_key_duplicates(rows.filter(quality.required("id")), ["id"])


def split_category(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) categories; the table has no columns for ids and paths of more levels than ``LEVEL_WORDS``."""
    depth = len(LEVEL_WORDS)
    elements = F.size(F.split("categorypath", r"\Q" + PATH_SEPARATOR + r"\E"))
    rules = {
        f"id of more than {depth} levels": F.length("id") <= depth * ID_WIDTH,
        f"path of more than {depth - 1} names": F.coalesce(elements <= depth - 1, F.lit(True)),
    }
    return quality.split_stored(df, rules)


def refine_category(df: DataFrame, site: Site = Site()) -> DataFrame:
    """Level ids from the id prefixes and level names from the path, plus the coupon category."""
    rows = dedup.drop_key_duplicates(df, ["id"])
    ids = fn.id_levels("id", ID_WIDTH, len(LEVEL_WORDS))
    path = fn.path_levels("categorypath", PATH_SEPARATOR, len(LEVEL_WORDS) - 1)
    second = F.when(F.col("parentid").isNull(), "").otherwise(SECOND_NAME)
    names = [F.lit(ROOT_NAME), second, *path[1:]]
    levels = {}
    for word, level_id, name in zip(LEVEL_WORDS, ids, names, strict=True):
        no_id, no_name = RARE_LEVELS.get(word, (None, None))
        levels[f"level_{word}_id"] = F.coalesce(level_id, F.lit(no_id))
        levels[f"level_{word}_name"] = F.coalesce(name, F.lit(no_name))
    spec = {
        "category_Id": "id",
        "category_name": "description",
        "category_path": "categorypath",
        "parent_category_id": F.col("parentid").cast("string"),
        "active_indicator": fn.to_flag("enabled", ("true",), other=F.lit(0)),
        "company_cd": F.lit(site.company_cd),
        **levels,
    }
    coupon = {
        "category_Id": COUPON_CATEGORY,
        "category_name": "Coupons",
        "active_indicator": 0,
        "company_cd": site.company_cd,
        "level_one_id": COUPON_CATEGORY,
        "level_one_name": ROOT_NAME,
        "level_two_id": COUPON_CATEGORY,
        "level_two_name": "Coupons",
        **{f"level_{w}_{k}": "" for w in RARE_LEVELS for k in ("id", "name")},
    }
    return conform.with_special_members(conform.project(rows, spec), [coupon])


# Delivery names of the category table and the defaults of its required columns.
CATEGORY_DELIVERY = {
    "CAT_ID": "category_Id",
    "CO_CD": "company_cd",
    "CAT_NME": "category_name",
    "CAT_PATH": "category_path",
    "PARNT_CAT_ID": "parent_category_id",
    **{
        f"LVL_{i}_{short}": f"level_{word}_{long}"
        for i, word in enumerate(LEVEL_WORDS, 1)
        for short, long in (("ID", "id"), ("NME", "name"))
    },
    "PROD_CAT_ACT_IND": "active_indicator",
}
CATEGORY_DEFAULTS = {
    "CAT_ID": "NA",
    "CO_CD": -1,
    "CAT_NME": "NA",
    "CAT_PATH": "NA",
    "PARNT_CAT_ID": "NA",
    "LVL_1_ID": "NA",
    "LVL_1_NME": "NA",
}


def category_delta(prev: DataFrame | None, curr: DataFrame) -> DataFrame:
    def delivered(df: DataFrame) -> DataFrame:
        return quality.with_defaults(conform.project(df, CATEGORY_DELIVERY), CATEGORY_DEFAULTS)

    before = None if prev is None else delivered(prev)
    return cdc.delta(before, delivered(curr), ["CAT_ID"], flag="CDC_IND_CD")
