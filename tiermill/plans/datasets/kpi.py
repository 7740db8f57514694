"""Sales KPIs: the source views metric definitions read and the run over a stored catalogue."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ...functions.sqlfuncs import register_sql_functions
from ...sources.snapshots import Snapshots
from ..metrics import MetricEngine, read_catalog

# View names metric definitions use.
SOURCE_VIEWS = [
    "SalesDetails",
    "Product",
    "ProductCategories",
    "StoreTransactionAdjustments",
    "Store",
    "ATTSalesActuals",
    "StoreTraffic",
    "StoreRecruitingHeadcount",
    "Employee",
    "EmployeeStoreAssociation",
    "SalesLeads",
    "StoreCustomerExperience",
    "EmployeeGoal",
]


def sales_kpis(spark: SparkSession, catalog: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """The long metric table of a stored catalogue; ``sources`` maps view names to refined tables."""
    unknown = sorted(set(sources) - set(SOURCE_VIEWS))
    if unknown:
        raise ValueError(f"unknown source views: {unknown}")
    register_sql_functions(spark)
    return MetricEngine(spark, read_catalog(catalog), sources).run()


def store_kpis(values: DataFrame, store: Snapshots, snapshot_id: str, run_date: date) -> DataFrame:
    return store.write(values, snapshot_id, run_date)
