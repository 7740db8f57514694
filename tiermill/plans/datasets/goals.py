"""Store goals, employee goals, goal points and the daily goal forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import clean as fn
from ...operators import dedup, quality, shape
from ...operators import conforming as conform
from ...operators import goals as allocation
from ...sources.feeds import FeedSpec, with_run_date
from .site import Site

GOAL_HEADER_LINE = 1
# Report lines that are not goals, by their second cell.
GOAL_NOISE = ["Column1", "Store"]


def refine_goals(report: DataFrame, stores: DataFrame, run_date: str, site: Site = Site()) -> DataFrame:
    """Wide goals (one column per metric, original header names) to one row per store and metric.

    A missing goal counts as 0.00; percentages become fractions; unknown stores are dropped.
    """
    rows = report.filter(quality.not_blank("Store"))
    rows = rows.withColumn("StoreNumber", F.regexp_replace("Store", r"\D", "").try_cast("int")).drop("Store", "Date")
    rows = with_run_date(rows, run_date, "ReportDate")
    long = shape.unpivot_measures(
        rows, ["StoreNumber", "ReportDate"], name_col="KPIName", value_col="GoalValue", value_type="string"
    )
    long = long.withColumn("GoalValue", F.coalesce(F.nullif(F.trim("GoalValue"), F.lit("")), F.lit("0.00")))
    long = conform.enrich(
        long, stores, ["StoreNumber"], ["LocationName", *site.levels], how="inner"
    )
    spec = {
        "ReportDate": "ReportDate",
        "KPIName": "KPIName",
        "StoreNumber": "StoreNumber",
        "CompanyCd": F.lit(site.company_cd),
        "GoalValue": fn.parse_percent("GoalValue", "decimal(18,4)"),
        "LocationName": "LocationName",
        **{c: c for c in site.levels},
    }
    return conform.project(long, spec).distinct()


# Delivery names of store goals.
GOAL_DELIVERY = {
    "RPT_DT": "ReportDate",
    "KPI_NM": "KPIName",
    "STORE_NUM": "StoreNumber",
    "CO_CD": "CompanyCd",
    "GOAL_VAL": "GoalValue",
}


def deliver_goals(rows: DataFrame) -> DataFrame:
    one = dedup.drop_key_duplicates(rows, ["ReportDate", "KPIName", "StoreNumber", "CompanyCd"])
    return conform.project(one, GOAL_DELIVERY)


def refine_employee_goals(
    goals: DataFrame, bridge: DataFrame, employees: DataFrame, headcount: DataFrame, site: Site = Site()
) -> DataFrame:
    """Goals of each employee at their primary store."""
    store_goals = goals.select(
        F.col("StoreNumber").alias("storenumber"),
        F.col("KPIName").alias("kpiname"),
        F.col("GoalValue").cast("double").alias("goalvalue"),
        F.col("ReportDate").alias("report_date"),
    )
    primary = bridge.filter(F.col("primarylocationindicator") == 1)
    primary = primary.select("storenumber", "sourceemployeeid", "companycd")
    heads = headcount.select(
        F.col("store_number").alias("storenumber"), F.col("approved_headcount").try_cast("double").alias("approved_headcount")
    )
    staff = employees.select("sourceemployeeid", "name", "parttimeindicator")
    rows = allocation.allocate_goals(store_goals, primary, staff, heads)
    rows = rows.withColumn("sourcesystemname", F.lit(site.sheet_system))
    keys = ["report_date", "sourceemployeeid", "companycd", "kpiname", "sourcesystemname"]
    return dedup.drop_key_duplicates(rows.filter(quality.required(*keys)), keys)


# Delivery names of employee goals.
EMPLOYEE_GOAL_DELIVERY = {
    "RPT_DT": "report_date",
    "SRC_EMP_ID": "sourceemployeeid",
    "KPI_NM": "kpiname",
    "CO_CD": "companycd",
    "SRC_SYS_NM": "sourcesystemname",
    "GOAL_VAL": "goalvalue",
}

POINTS_FEED = FeedSpec(
    "goal_points",
    columns={"Category": "kpiname", "Points": "goalpoints", "Bonus": "bonuspoints", "Decelerator": "deceleratorpoints"},
)


def refine_points(store: DataFrame, employee: DataFrame, run_date: str, site: Site = Site()) -> DataFrame:
    """Goal points of both classes, one row per metric."""

    def one(df: DataFrame, kind: str) -> DataFrame:
        rows = with_run_date(df.select("kpiname", "goalpoints", "bonuspoints", "deceleratorpoints"), run_date)
        return conform.with_constants(rows, {"classification": kind, "companycd": site.company_cd})

    rows = conform.union_sources(one(employee, "Employee"), one(store, "Store"))
    return dedup.drop_key_duplicates(rows, ["reportdate", "classification", "kpiname", "companycd"])


# Delivery names of goal points (quoted).
POINTS_DELIVERY = {
    "RPT_DT": "reportdate",
    "CLS": "classification",
    "KPI_NM": "kpiname",
    "CO_CD": "companycd",
    "GOAL_PT": "goalpoints",
    "BNS_PT": "bonuspoints",
    "DECELERATOR_PT": "deceleratorpoints",
}

FORECAST_REQUIRED = ["Date", "Day % to Forecast", "Gross Profit"]
FORECAST_REPLACE = {" ": "", "%": "percent"}
FORECAST_FEED = FeedSpec(
    "daily_forecast",
    columns={c: c.replace(" ", "").replace("%", "percent").lower() for c in FORECAST_REQUIRED},
    multiline=True,
)


def split_forecast(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = df.select("date", fn.parse_percent("daypercenttoforecast").alias("daypercenttoforecast"))
    return quality.split_stored(rows, {"date": quality.us_date("date")})


# Delivery names of the daily forecast.
FORECAST_DELIVERY = {"RPT_DT": "date", "DAY_PCT_FCST": "daypercenttoforecast"}
