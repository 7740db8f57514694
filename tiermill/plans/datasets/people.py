"""Employees, their store associations, customers and customer contact data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import clean as fn
from ...operators import cdc, dedup, quality, shape
from ...operators import conforming as conform
from ...sources.feeds import FeedSpec
from .site import Site, squash

EMPLOYEE_FEED = FeedSpec("employee", multiline=True)
CUSTOMER_FEED = FeedSpec("customer", multiline=True)

# Words and codes of the employee feed.
YES_WORDS = ("true", "yes", "1")
LANGUAGES = {"en-us": "English"}
OPEN_END = "TODAY"

# Refined employee columns that are plain renames of feed columns.
EMPLOYEE_RENAMES = {
    "sourceemployeeid": "employeeid",
    "workdayid": "specialidentifier",
    "name": "employeename",
    "gender": "gender",
    "workemail": "emailpersonal",
    "title": "title",
    "jobrole": "securityrole",
    "city": "city",
    "stateprovince": "stateprovince",
    "country": "country",
    "employeemanagerid": "usermanageremployeeid",
    "employeemanagername": "supervisor",
    "commissiongroup": "commissiongroup",
    "compensationtype": "compensationtype",
    "username": "username",
    "worknumber": "phone",
    "email": "email",
    "datecreatedatsource": "rowinserted",
    "employeelastmodifieddate": "rowupdated",
    "primarylocation": "primarylocation",
    "assignedlocations": "assignedlocations",
}


def tidy_headers(raw: DataFrame) -> DataFrame:
    """Header cells to lower-case letters and digits (``Phone.Cellular``, ``RowEvent`` with a line end)."""
    return raw.toDF(*[squash(c) for c in raw.columns])


def standardise_employee(raw: DataFrame, site: Site = Site()) -> DataFrame:
    """Incoming employee rows in refined columns; only feed rows are recoded, never stored ones."""
    df = tidy_headers(raw)
    as_date = {
        c: F.coalesce(F.col(c).try_cast("date"), F.try_to_date(F.col(c), "M/d/yyyy"))
        for c in ("startdate", "terminationdate")
    }
    spec = {
        **EMPLOYEE_RENAMES,
        "sourceemployeeid": F.col("employeeid").try_cast("int"),
        "companycd": F.lit(site.company_cd),
        "sourcesystemname": F.lit(site.pos_system),
        "statusindicator": F.lit(1) - fn.to_flag("disabled", YES_WORDS, other=F.lit(0)),
        "parttimeindicator": fn.to_flag("parttime", YES_WORDS, other=F.lit(0)),
        "language": fn.recode("language", LANGUAGES),
        "startdate": as_date["startdate"],
        "terminationdate": F.when(F.col("terminationdate") != OPEN_END, as_date["terminationdate"]),
        "CDC_IND_CD": F.when(F.col("rowevent") == "Updated", "C").otherwise("I"),
    }
    rows = conform.project(df, spec)
    return rows.filter(quality.required("sourceemployeeid"))


def refine_employee(prev: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Full history: the row modified last wins per company and employee."""
    return cdc.upsert(prev, incoming, ["companycd", "sourceemployeeid"], ["employeelastmodifieddate"])


def employee_delta(incoming: DataFrame) -> DataFrame:
    return dedup.keep_latest(incoming, ["companycd", "sourceemployeeid"], ["employeelastmodifieddate"])


# Delivery names of the employee table.
EMPLOYEE_DELIVERY = {
    "SRC_EMP_ID": "sourceemployeeid",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystemname",
    "WRKDAY_ID": "workdayid",
    "NME": "name",
    "GNDR": "gender",
    "WRK_EMAIL": "workemail",
    "STAT_IND": "statusindicator",
    "PTTM_IND": "parttimeindicator",
    "JOB_TITLE": "title",
    "LANG": "language",
    "JOB_ROLE": "jobrole",
    "CTY": "city",
    "ST_PROVN": "stateprovince",
    "CNTRY": "country",
    "START_DT": "startdate",
    "TRMNTN_DT": "terminationdate",
    "CMSN_GRP": "commissiongroup",
    "COMP_TYP": "compensationtype",
    "EMP_MGR_ID": "employeemanagerid",
    "USRNM": "username",
    "WRKNBR": "worknumber",
    "EMAIL": "email",
    "CDC_IND_CD": "CDC_IND_CD",
    "DT_CRT_AT_SRC": "datecreatedatsource",
    "EMP_LST_MOD_DT": "employeelastmodifieddate",
}


UNKNOWN_STORE = -2


def split_employee_store(employees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) employees by whether the numbers of their stores can be stored."""
    rules = {f"{c} out of range": shape.list_fits(c) for c in ("assignedlocations", "primarylocation")}
    return quality.split_stored(employees, rules)


def refine_employee_store(employees: DataFrame, site: Site = Site()) -> DataFrame:
    """One row per employee and assigned store; without a primary location the unknown store."""
    rows = shape.explode_list(
        employees.filter(quality.required("sourceemployeeid")),
        "assignedlocations",
        primary="primarylocation",
        unknown=UNKNOWN_STORE,
        out="storenumber",
        flag="primarylocationindicator",
    )
    rows = rows.select(
        "storenumber",
        "primarylocation",
        F.lit(site.company_cd).alias("companycd"),
        "sourceemployeeid",
        F.lit(site.pos_system).alias("sourcesystenname"),
        "CDC_IND_CD",
        "primarylocationindicator",
    )
    return dedup.drop_key_duplicates(rows, ["storenumber", "sourceemployeeid", "companycd", "sourcesystenname"])


# Delivery names of the employee-store association.
EMPLOYEE_STORE_DELIVERY = {
    "STORE_NUM": "storenumber",
    "SRC_EMP_ID": "sourceemployeeid",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystenname",
    "PRI_LOC_IN": "primarylocationindicator",
    "CDC_IND_CD": "CDC_IND_CD",
}

# Feed columns whose refined names differ.
CUSTOMER_NAMES = {"customerid": "sourcecustomerid", "primaryname": "firstname", "familyname": "lastname"}

# Refined customer columns that are plain renames.
CUSTOMER_SHARED = {
    "firstname": "firstname",
    "lastname": "lastname",
    "companyname": "companyname",
    "customertype": "customertype",
    "city": "city",
    "stateprovince": "stateprovince",
    "country": "country",
    "multilevelpriceidentifier": "multilevelpriceid",
    "billingaccountnumber": "billingaccountnumber",
    "totalactivations": "numberofactivations",
    "datecreatedatsource": "rowinserted",
    "vipcustomerindicator": "vipcustomer",
    "tracpointmembernumber": "tracpointmembernumber",
    "employeename": "employeename",
    "sourceemployeeid": "employeeid",
    "sourceemployeeidassignedto": "employeeidassignedto",
    "customerlastmodifieddate": "rowupdated",
    "companycontact": "companycontact",
    "storelastservicedat": "storeid",
}
NOT_AVAILABLE = "NA"


def ingest_customer(raw: DataFrame) -> DataFrame:
    return conform.rename(tidy_headers(raw), CUSTOMER_NAMES)


def _customer_base(df: DataFrame, site: Site) -> dict:
    return {
        "companycd": F.lit(site.company_cd),
        "sourcesystemname": F.lit(site.pos_system),
        **CUSTOMER_SHARED,
        **{f"phone{i}type": F.lit(NOT_AVAILABLE) for i in range(2, 6)},
        "CDC_IND_CD": fn.event_flag("rowevent"),
    }


def refine_customer(df: DataFrame, site: Site = Site()) -> DataFrame:
    """Profile table: no phone, e-mail or street address."""
    spec = {
        "sourcecustomerid": "sourcecustomerid",
        **_customer_base(df, site),
        "postalcode": "postalcode",
        "employeenameassignedto": "employeenameassignedto",
        "title": "title",
    }
    return conform.project(df.filter(quality.required("sourcecustomerid")), spec)


def refine_customer_contact(df: DataFrame, site: Site = Site()) -> DataFrame:
    """Contact table of the same customers, kept in the restricted layer."""
    spec = {
        "sourceidentifier": "sourcecustomerid",
        **_customer_base(df, site),
        "phone": "phone",
        "email": "email",
        "address1": "address",
        "address2": "address2",
        "zippostalcode": "postalcode",
        "employeeassignedto": "employeenameassignedto",
        **{f"phone{i}": F.lit(NOT_AVAILABLE) for i in range(2, 6)},
    }
    return conform.project(df.filter(quality.required("sourcecustomerid")), spec)


# Delivery names of the customer table.
CUSTOMER_DELIVERY = {
    "SRC_CUST_ID": "sourcecustomerid",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystemname",
    "FIRST_NM": "firstname",
    "LAST_NM": "lastname",
    "COMP_NM": "companyname",
    "CUST_TYP": "customertype",
    "CTY": "city",
    "ST_PRV": "stateprovince",
    "PSTL_CD": "postalcode",
    "CNTRY": "country",
    "MULTI_PRC_ID": "multilevelpriceidentifier",
    "BILL_ACCTNG_NUM": "billingaccountnumber",
    "TOT_ACTVNG": "totalactivations",
    "DT_CRT_AT_SRC": "datecreatedatsource",
    "VIP_CUST_IND": "vipcustomerindicator",
    "TRKPTMBRNBR": "tracpointmembernumber",
    "SRC_EMP_ID": "sourceemployeeid",
    "SRC_EMP_ID_ASSIGNED_TO": "sourceemployeeidassignedto",
    "CUST_LST_MOD_DT": "customerlastmodifieddate",
    "PHN2_TYP": "phone2type",
    "PHN3_TYP": "phone3type",
    "PHN4_TYP": "phone4type",
    "PHN5_TYP": "phone5type",
    "CO_CNTCT": "companycontact",
    "STORE_LST_SRVCD_AT": "storelastservicedat",
    "CDC_IND_CD": "CDC_IND_CD",
    "Title": "title",
}

# Delivery names of the customer contact table.
CONTACT_DELIVERY = {
    "SRC_CUST_ID": "sourceidentifier",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystemname",
    "PH": "phone",
    "EMAIL": "email",
    "ADDR1": "address1",
    "ADDR2": "address2",
    "PHN2_TYP": "phone2type",
    "PHN3_TYP": "phone3type",
    "PHN4_TYP": "phone4type",
    "PHN5_TYP": "phone5type",
    "PHN2": "phone2",
    "PHN3": "phone3",
    "PHN4": "phone4",
    "PHN5": "phone5",
    "CDC_IND_CD": "CDC_IND_CD",
}
