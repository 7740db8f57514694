"""Running the datasets over a layered folder tree.

::

    root/raw/<sensitivity>/<feed>        landed files, put there by routing
    root/discovery/<feed>                typed snapshots of each feed
    root/refined/<dataset>               conformed snapshots
    root/delivery/<dataset>              Current and Previous CSV
    root/errors/<dataset>                rejected rows and files

A job is a plain function of a :class:`Lake`.  Only this module and the stores touch storage; the steps it calls are
DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..sources import feeds, files
from ..sources.manifest import Manifest
from ..sources.sinks import deliver, register_tables
from ..sources.snapshots import Snapshots
from ..staging import stage
from .datasets import dealer, goals, kpi, people, product, reports, sales, store
from .datasets.site import Site
from .metrics import publish_catalog, publish_values

# Feeds that hold personal data and their layer class.
SENSITIVITY = {"customer": "pii", "sales_leads": "pii", "employee": "hr"}


@dataclass
class Lake:
    """One run over the tree.  ``run_id`` names the snapshots of the run and must grow from run to run."""

    spark: SparkSession
    root: str
    run_id: str
    run_date: date
    site: Site = field(default_factory=Site)
    _taken: dict[str, DataFrame] = field(default_factory=dict, init=False, repr=False)

    # --- places

    def raw(self, feed: str) -> str:
        return files.layer_path(self.root, "raw", feed, SENSITIVITY.get(feed, "regular"))

    def discovery(self, feed: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/discovery/{feed}")

    def refined(self, dataset: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/refined/{dataset}")

    def found(self, feed: str) -> DataFrame:
        return self._latest(self.discovery(feed))

    def current(self, dataset: str) -> DataFrame:
        return self._latest(self.refined(dataset))

    @staticmethod
    def _latest(store_: Snapshots) -> DataFrame:
        df = store_.latest()
        if df is None:
            raise LookupError(f"no snapshot in {store_.root}")
        return df

    @property
    def errors(self) -> str:
        return f"{self.root}/errors"

    # --- steps

    def manifest(self, feed: str) -> Manifest:
        return Manifest(self.spark, f"{self.root}/manifest/{feed}")

    def accepted(self, feed: str, **checks) -> list[str]:
        """Paths of the files landed since the runs before that pass the file checks; the others go to the errors folder.

        The files count as taken once their rows are kept; where none passes there is nothing to keep, and they are at once.
        """
        if not files.folder_exists(self.spark, self.raw(feed)):
            return []
        new = self.manifest(feed).pending(files.list_files(self.spark, self.raw(feed)), self.run_id)
        verdicts = stage(files.validate_files(self.spark, stage(new, "landed"), extension=".csv", **checks), "verdicts")
        quality.quarantine_files(verdicts, self.errors, feed, self.run_id)
        paths = files.accepted_paths(verdicts)
        self._taken[feed] = verdicts
        if not paths:
            self._record(feed)
        return paths

    def keep(self, feed: str, df: DataFrame) -> None:
        self.discovery(feed).write(df, self.run_id, self.run_date)
        self._record(feed)

    def _record(self, feed: str) -> None:
        if feed in self._taken:
            self.manifest(feed).record(self._taken.pop(feed), self.run_id)

    def ingest(
        self,
        spec: feeds.FeedSpec,
        feed: str | None = None,
        transform: Callable[[DataFrame], DataFrame] = lambda df: df,
        minimum_rows: int = 0,
        **checks,
    ) -> bool:
        """Check, read and store one feed; False when no file passed or the feed is empty."""
        feed = feed or spec.name
        paths = self.accepted(feed, **checks)
        if not paths:
            return False
        df = feeds.read_csv(self.spark, paths, spec)
        if minimum_rows and feeds.is_empty_feed(df, minimum_rows):
            self._record(feed)
            return False
        self.keep(feed, transform(df))
        return True

    def split(self, parts: tuple[DataFrame, DataFrame], dataset: str) -> DataFrame:
        """Good rows; the bad ones are appended to the errors folder."""
        good, bad = parts
        quality.quarantine(bad, self.errors, dataset, self.run_id)
        return good

    def refine(self, dataset: str, df: DataFrame, keys: Sequence[str] | None = None) -> bool:
        """Store a refined dataset; with ``keys`` only when something changed."""
        if keys is None:
            self.refined(dataset).write(df, self.run_id, self.run_date)
            return True
        return self.refined(dataset).write_if_changed(df, keys, self.run_id, self.run_date)

    def deliver(
        self,
        dataset: str,
        df: DataFrame,
        columns: Mapping[str, str | Column] | None = None,
        quote_all: bool = False,
        keep_log: bool = True,
    ) -> None:
        deliver(df, f"{self.root}/delivery/{dataset}", columns, quote_all=quote_all, keep_log=keep_log, run_id=self.run_id)

    def changes(self, dataset: str) -> tuple[DataFrame | None, DataFrame]:
        """(previous, current) for a delta delivery.

        When this run stored nothing, nothing changed, and the previous snapshot is the current one.
        """
        store_ = self.refined(dataset)
        current, previous = store_.latest_two()
        if current is None:
            raise LookupError(f"no snapshot in {store_.root}")
        return (previous if store_.ids(1) == [self.run_id] else current), current


# --------------------------------------------------------------------------------------- routing

# Prefixes of landed file names and the feed they belong to.
ROUTES = {
    "RPT_ATTHistorical_Grid_RPT_ATTHistorical_RPT_ATTMyResultsHistoricalAnalysis": "carrier_actuals_report",
    "ATTHistorical_Grid_ATTHistorical_ATTMyResultsHistoricalAnalysis": "carrier_actuals",
    "CategoryNumber": "product_category",
    "SalesTransactions": "sales_details",
    "StoreTraffic": "store_traffic",
    "HR_Employee": "employee",
    "Inventory": "inventory",
    "Location": "location",
    "PII_Customer": "customer",
    "BAELocation": "expert",
    "DTVNow": "tv",
    "MultiTracker": "real_estate",
    "OperationalEFC_TotalLoss": "operational_efficiency",
    "ScoreCardGoals_GoalsforSQL": "store_goals",
    "DealerCodes": "dealer_codes",
    "PII_Report202020_202020Details": "sales_leads",
    "ProductIdentifier": "product_identifier",
    "Product": "product",
    "PurchaseOrder": "purchase_order",
    "TransAdjStore": "store_adjustments",
    "MiscAdjustments": "misc_adjustments",
    "ReceivingInvoiceHistory": "receiving_invoice_history",
    "GoalPoints_EmployeeScorecard": "goal_points_employee",
    "GoalPoints_StoreScorecard": "goal_points_store",
    "Coupons": "coupons",
    "ReportingDefinitions": "daily_forecast",
    "EmpGpGoal": "employee_gross_profit_goal",
    "TransAdjEMP": "employee_adjustments",
    "CustExp": "experience",
    "ApprovedFTE_CurrentHeadcount": "headcount",
    "CompanyCode": "company",
}
SENSITIVE_PREFIXES = {"PII_": "pii", "HR_Employee": "hr"}


def routes(site: Site) -> dict[str, str]:
    """The prefix table with the entries that carry the site's own names."""
    return {**ROUTES, f"{site.own}MobileStoreList": "store_list", f"{site.code}_KPI": "metric_catalog"}


def landing_targets(lake: Lake, landing: str) -> DataFrame:
    """Feed, sensitivity and raw folder of every landed file; unknown files have no feed."""
    listed = files.route_files(files.list_files(lake.spark, landing), routes(lake.site), SENSITIVE_PREFIXES)
    folder = F.concat_ws("/", F.lit(f"{lake.root}/raw"), "sensitivity", "dataset")
    return listed.withColumn("target", F.when(F.col("dataset").isNotNull(), folder))


def register_lake(lake: Lake, database: str | None = None) -> None:
    """Every refined dataset that has a current copy becomes a SQL table."""
    stored = {d: lake.refined(d) for d in JOBS}
    tables = {d: s.current_path for d, s in stored.items() if s.ids(1)}
    register_tables(lake.spark, tables, database)


# ------------------------------------------------------------------------------------------ jobs


def ingest_store(lake: Lake) -> None:
    lake.ingest(store.location_feed(), required=store.LOCATION_REQUIRED)
    lake.ingest(store.expert_feed(), required=store.EXPERT_REQUIRED)
    lake.ingest(store.store_list_feed(), required=store.STORE_LIST_REQUIRED)
    lake.ingest(store.tv_feed(), required=store.TV_REQUIRED)
    line = store.REAL_ESTATE_HEADER_LINE
    paths = lake.accepted("real_estate", required=store.real_estate_required(lake.site), header_line=line)
    if paths:

        def names(head: list[list[str]]) -> list[str]:
            cells = feeds.clean_names(head[line], store.HEADER_REPLACE, drop_empty=False)
            return [n or f"_c{i}" for i, n in enumerate(cells)]

        lake.keep("real_estate", feeds.read_reports(lake.spark, paths, line + 1, names))


STORE_FEEDS = ("location", "expert", "real_estate", "store_list", "tv")


def refine_store(lake: Lake) -> None:
    good, bad = store.split_sources(*[lake.found(f) for f in STORE_FEEDS])
    for feed, df in bad.items():
        quality.quarantine(df, lake.errors, feed, lake.run_id)
    lake.refine("store", store.refine_store(good, lake.site), ["StoreNumber"])


def deliver_store(lake: Lake) -> None:
    prev, curr = lake.changes("store")
    bridge, dealers = lake.current("store_dealer_association"), lake.current("dealer_code")
    lake.deliver("store", store.store_delta(prev, curr, bridge, dealers, lake.site))


def deliver_store_hierarchy(lake: Lake) -> None:
    stores, dealers = lake.changes("store"), lake.changes("dealer_code")
    before = None if stores[0] is None or dealers[0] is None else (stores[0], dealers[0])
    lake.deliver("store_hierarchy", store.store_hierarchy_delta((stores[1], dealers[1]), before, lake.site))


def refine_management_hierarchy(lake: Lake) -> None:
    listed = lake.split(store.management_sources(lake.found("store_list")), "store_management_hierarchy")
    out = store.management_hierarchy(lake.current("store"), listed, lake.current("employee"), lake.site)
    lake.refine("store_management_hierarchy", out, out.columns)


def deliver_management_hierarchy(lake: Lake) -> None:
    prev, curr = lake.changes("store_management_hierarchy")
    lake.deliver("store_management_hierarchy", store.management_hierarchy_delta(prev, curr))


def ingest_dealer(lake: Lake) -> None:
    lake.ingest(dealer.dealer_feed(lake.site), required=dealer.dealer_required(lake.site))


def refine_dealer(lake: Lake) -> None:
    lake.refine("dealer_code", dealer.refine_dealer(lake.found("dealer_codes"), lake.site), ["dealercode"])


def deliver_dealer(lake: Lake) -> None:
    lake.deliver("dealer_code", dealer.dealer_delta(*lake.changes("dealer_code")))


def refine_association(lake: Lake) -> None:
    out = dealer.refine_association(lake.found("dealer_codes"), lake.site)
    lake.refine("store_dealer_association", out, out.columns)


def deliver_association(lake: Lake) -> None:
    lake.deliver("store_dealer_association", dealer.association_delta(*lake.changes("store_dealer_association")))


def ingest_employee(lake: Lake) -> None:
    lake.ingest(people.EMPLOYEE_FEED, transform=people.tidy_headers)


def refine_employee(lake: Lake) -> None:
    new = people.standardise_employee(lake.found("employee"), lake.site)
    lake.refine("employee_delta", people.employee_delta(new))
    lake.refine("employee", people.refine_employee(lake.refined("employee").latest(before=lake.run_id), new))


def deliver_employee(lake: Lake) -> None:
    lake.deliver("employee", lake.current("employee_delta"), people.EMPLOYEE_DELIVERY)


def refine_employee_store(lake: Lake) -> None:
    good = lake.split(people.split_employee_store(lake.current("employee")), "employee_store_association")
    lake.refine("employee_store_association", people.refine_employee_store(good, lake.site))


def deliver_employee_store(lake: Lake) -> None:
    rows = lake.current("employee_store_association")
    lake.deliver("employee_store_association", rows, people.EMPLOYEE_STORE_DELIVERY)


def ingest_customer(lake: Lake) -> None:
    lake.ingest(people.CUSTOMER_FEED, transform=people.ingest_customer)


def refine_customer(lake: Lake) -> None:
    lake.refine("customer", people.refine_customer(lake.found("customer"), lake.site))


def deliver_customer(lake: Lake) -> None:
    lake.deliver("customer", lake.current("customer"), people.CUSTOMER_DELIVERY)


def refine_customer_contact(lake: Lake) -> None:
    lake.refine("customer_contact", people.refine_customer_contact(lake.found("customer"), lake.site))


def deliver_customer_contact(lake: Lake) -> None:
    lake.deliver("customer_contact", lake.current("customer_contact"), people.CONTACT_DELIVERY)


def ingest_product(lake: Lake) -> None:
    for spec in (product.PRODUCT_FEED, product.COUPON_FEED, product.IDENTIFIER_FEED):
        lake.ingest(spec, min_columns=product.MIN_COLUMNS[spec.name])


def refine_product(lake: Lake) -> None:
    good, bad = product.split_products(*[lake.found(f) for f in ("product", "product_identifier", "coupons")])
    for feed, df in bad.items():
        quality.quarantine(df, lake.errors, feed, lake.run_id)
    lake.refine("product", product.refine_product(good, lake.site), ["productsku"])


def deliver_product(lake: Lake) -> None:
    lake.deliver("product", product.product_delta(*lake.changes("product")))


def ingest_category(lake: Lake) -> None:
    spec = product.CATEGORY_FEED
    lake.ingest(spec, transform=product.ingest_category, min_columns=product.MIN_COLUMNS[spec.name])


def refine_category(lake: Lake) -> None:
    good = lake.split(product.split_category(lake.found("product_category")), "product_category")
    out = product.refine_category(good, lake.site)
    lake.refine("product_category", out, ["category_Id"])


def deliver_category(lake: Lake) -> None:
    lake.deliver("product_category", product.category_delta(*lake.changes("product_category")))


def ingest_sales(lake: Lake) -> None:
    lake.ingest(sales.SALES_FEED, transform=sales.ingest_sales, min_columns=sales.SALES_MIN_COLUMNS)


def refine_sales(lake: Lake) -> None:
    lake.refine("sales_details", sales.refine_sales(lake.found("sales_details"), lake.current("store"), lake.site))


def deliver_sales(lake: Lake) -> None:
    lake.deliver("sales_details", lake.current("sales_details"), sales.SALES_DELIVERY)


def ingest_actuals(lake: Lake) -> None:
    spec = dealer.actuals_feed(lake.site)
    lake.ingest(spec, transform=dealer.actual_values)
    lake.ingest(spec, "carrier_actuals_report", transform=dealer.actual_values)


def refine_actuals(lake: Lake) -> None:
    out = dealer.refine_actuals(
        lake.found("carrier_actuals"),
        lake.found("carrier_actuals_report"),
        lake.current("store"),
        lake.current("store_dealer_association"),
        lake.current("dealer_code"),
        lake.site,
    )
    lake.refine("carrier_actuals", out)


def deliver_actuals(lake: Lake) -> None:
    lake.deliver("carrier_actuals", dealer.deliver_actuals(lake.current("carrier_actuals")))


def ingest_goals(lake: Lake) -> None:
    line = goals.GOAL_HEADER_LINE
    paths = lake.accepted("store_goals", min_columns=1, header_line=line)
    if paths:
        rows = feeds.read_reports(lake.spark, paths, line + 1, lambda head: feeds.clean_names(head[line]))
        lake.keep("store_goals", rows)


def refine_goals(lake: Lake) -> None:
    out = goals.refine_goals(lake.found("store_goals"), lake.current("store"), f"{lake.run_date}", lake.site)
    lake.refine("store_goals", out)


def deliver_goals(lake: Lake) -> None:
    lake.deliver("store_goals", goals.deliver_goals(lake.current("store_goals")))


def refine_employee_goals(lake: Lake) -> None:
    out = goals.refine_employee_goals(
        lake.current("store_goals"),
        lake.current("employee_store_association"),
        lake.current("employee"),
        lake.current("headcount"),
        lake.site,
    )
    lake.refine("employee_goals", out)


def deliver_employee_goals(lake: Lake) -> None:
    lake.deliver("employee_goals", lake.current("employee_goals"), goals.EMPLOYEE_GOAL_DELIVERY)


def ingest_points(lake: Lake) -> None:
    for feed in ("goal_points_store", "goal_points_employee"):
        lake.ingest(goals.POINTS_FEED, feed)


def refine_points(lake: Lake) -> None:
    by_class = [lake.found(f) for f in ("goal_points_store", "goal_points_employee")]
    lake.refine("goal_points", goals.refine_points(*by_class, f"{lake.run_date}", lake.site))


def deliver_points(lake: Lake) -> None:
    lake.deliver("goal_points", lake.current("goal_points"), goals.POINTS_DELIVERY, quote_all=True)


def ingest_forecast(lake: Lake) -> None:
    lake.ingest(goals.FORECAST_FEED, required=goals.FORECAST_REQUIRED)


def refine_forecast(lake: Lake) -> None:
    lake.refine("daily_forecast", lake.split(goals.split_forecast(lake.found("daily_forecast")), "daily_forecast"))


def deliver_forecast(lake: Lake) -> None:
    lake.deliver("daily_forecast", lake.current("daily_forecast"), goals.FORECAST_DELIVERY)


def ingest_headcount(lake: Lake) -> None:
    lake.ingest(reports.HEADCOUNT_FEED, minimum_rows=reports.HEADCOUNT_MIN_ROWS)


def refine_headcount(lake: Lake) -> None:
    good = lake.split(reports.split_headcount(lake.found("headcount")), "headcount")
    out = reports.refine_headcount(good, lake.current("store"), lake.current("store_dealer_association"), lake.site)
    lake.refine("headcount", out)


def deliver_headcount(lake: Lake) -> None:
    lake.deliver("headcount", lake.current("headcount"), reports.HEADCOUNT_DELIVERY)


def ingest_traffic(lake: Lake) -> None:
    lake.ingest(sales.TRAFFIC_FEED, transform=sales.ingest_traffic)


def refine_traffic(lake: Lake) -> None:
    lake.refine("store_traffic", sales.refine_traffic(lake.found("store_traffic"), lake.current("store"), lake.site))


def deliver_traffic(lake: Lake) -> None:
    lake.deliver("store_traffic", lake.current("store_traffic"), sales.TRAFFIC_DELIVERY, quote_all=True)


def ingest_experience(lake: Lake) -> None:
    lake.ingest(
        reports.EXPERIENCE_FEED, required=reports.EXPERIENCE_REQUIRED, date_pattern=reports.EXPERIENCE_FILE_DATE
    )


def refine_experience(lake: Lake) -> None:
    parts = reports.refine_experience(
        lake.found("experience"),
        lake.current("store"),
        lake.current("store_dealer_association"),
        lake.current("dealer_code"),
        lake.site,
    )
    lake.refine("customer_experience", lake.split(parts, "experience"))


def deliver_experience(lake: Lake) -> None:
    lake.deliver("customer_experience", lake.current("customer_experience"), reports.EXPERIENCE_DELIVERY)


def ingest_leads(lake: Lake) -> None:
    lake.ingest(sales.lead_feed(lake.site), transform=lambda df: sales.ingest_leads(df, f"{lake.run_date}"))


def refine_leads(lake: Lake) -> None:
    good = lake.split(sales.split_leads(lake.found("sales_leads")), "sales_leads")
    out = sales.refine_leads(
        good,
        lake.current("store"),
        lake.current("store_dealer_association"),
        lake.current("dealer_code"),
        lake.site,
    )
    lake.refine("sales_leads", out)


def deliver_leads(lake: Lake) -> None:
    lake.deliver("sales_leads", lake.current("sales_leads"), sales.LEAD_DELIVERY, quote_all=True)


def ingest_efficiency(lake: Lake) -> None:
    lake.ingest(reports.EFFICIENCY_FEED, transform=reports.ingest_efficiency)


def refine_efficiency(lake: Lake) -> None:
    good = lake.split(reports.split_efficiency(lake.found("operational_efficiency")), "operational_efficiency")
    lake.refine("operational_efficiency", reports.refine_efficiency(good, lake.current("employee"), lake.site))


def deliver_efficiency(lake: Lake) -> None:
    lake.deliver("operational_efficiency", reports.deliver_efficiency(lake.current("operational_efficiency")))


def ingest_employee_adjustments(lake: Lake) -> None:
    lake.ingest(reports.EMPLOYEE_ADJUSTMENT_FEED, minimum_rows=1)


def refine_employee_adjustments(lake: Lake) -> None:
    out = reports.refine_employee_adjustments(
        lake.found("employee_adjustments"), lake.current("employee"), lake.site
    )
    lake.refine("employee_adjustments", out)


def deliver_employee_adjustments(lake: Lake) -> None:
    rows = lake.current("employee_adjustments")
    lake.deliver("employee_adjustments", rows, reports.EMPLOYEE_ADJUSTMENT_DELIVERY)


def ingest_store_adjustments(lake: Lake) -> None:
    lake.ingest(reports.MISC_FEED)
    paths = lake.accepted("store_adjustments", min_columns=1, header_line=1)
    if paths:

        def names(head: list[list[str]]) -> list[str]:
            return feeds.clean_names(feeds.merged_cells(*head), reports.STORE_ADJUSTMENT_REPLACE)

        rows = feeds.read_reports(lake.spark, paths, 2, names, file_date=reports.STORE_ADJUSTMENT_FILE_DATE)
        lake.keep("store_adjustments", rows)


def refine_store_adjustments(lake: Lake) -> None:
    main, misc = lake.found("store_adjustments"), lake.found("misc_adjustments")
    lake.refine("store_adjustments", reports.refine_store_adjustments(main, misc, lake.site))


def deliver_store_adjustments(lake: Lake) -> None:
    lake.deliver("store_adjustments", lake.current("store_adjustments"), reports.STORE_ADJUSTMENT_DELIVERY)


def ingest_catalog(lake: Lake) -> None:
    lake.ingest(feeds.FeedSpec("metric_catalog", multiline=True))


def deliver_catalog(lake: Lake) -> None:
    lake.deliver("metric_catalog", publish_catalog(lake.found("metric_catalog")), keep_log=False)


# Refined dataset behind each view metric definitions use.
KPI_SOURCES = {
    "SalesDetails": "sales_details",
    "Product": "product",
    "ProductCategories": "product_category",
    "StoreTransactionAdjustments": "store_adjustments",
    "Store": "store",
    "ATTSalesActuals": "carrier_actuals",
    "StoreTraffic": "store_traffic",
    "StoreRecruitingHeadcount": "headcount",
    "Employee": "employee",
    "EmployeeStoreAssociation": "employee_store_association",
    "SalesLeads": "sales_leads",
    "StoreCustomerExperience": "customer_experience",
    "EmployeeGoal": "employee_goals",
}


def refine_kpis(lake: Lake) -> None:
    """Metrics over every refined table that exists; a definition that needs a missing one fails by name."""
    found = {view: lake.refined(dataset).latest() for view, dataset in KPI_SOURCES.items()}
    sources = {view: df for view, df in found.items() if df is not None}
    values = kpi.sales_kpis(lake.spark, lake.found("metric_catalog"), sources)
    kpi.store_kpis(values, lake.refined("sales_kpis"), lake.run_id, lake.run_date)


def deliver_kpis(lake: Lake) -> None:
    lake.deliver("sales_kpis", publish_values(lake.current("sales_kpis"), lake.site.pos_system))


Step = Callable[[Lake], None]

# Dataset -> (ingest, refine, deliver), in an order that has every input ready.
JOBS: dict[str, tuple[Step | None, Step | None, Step | None]] = {
    "dealer_code": (ingest_dealer, refine_dealer, deliver_dealer),
    "store_dealer_association": (None, refine_association, deliver_association),
    "store": (ingest_store, refine_store, deliver_store),
    "store_hierarchy": (None, None, deliver_store_hierarchy),
    "employee": (ingest_employee, refine_employee, deliver_employee),
    "store_management_hierarchy": (None, refine_management_hierarchy, deliver_management_hierarchy),
    "employee_store_association": (None, refine_employee_store, deliver_employee_store),
    "customer": (ingest_customer, refine_customer, deliver_customer),
    "customer_contact": (None, refine_customer_contact, deliver_customer_contact),
    "product": (ingest_product, refine_product, deliver_product),
    "product_category": (ingest_category, refine_category, deliver_category),
    "sales_details": (ingest_sales, refine_sales, deliver_sales),
    "carrier_actuals": (ingest_actuals, refine_actuals, deliver_actuals),
    "store_goals": (ingest_goals, refine_goals, deliver_goals),
    "headcount": (ingest_headcount, refine_headcount, deliver_headcount),
    "employee_goals": (None, refine_employee_goals, deliver_employee_goals),
    "goal_points": (ingest_points, refine_points, deliver_points),
    "daily_forecast": (ingest_forecast, refine_forecast, deliver_forecast),
    "store_traffic": (ingest_traffic, refine_traffic, deliver_traffic),
    "customer_experience": (ingest_experience, refine_experience, deliver_experience),
    "sales_leads": (ingest_leads, refine_leads, deliver_leads),
    "operational_efficiency": (ingest_efficiency, refine_efficiency, deliver_efficiency),
    "employee_adjustments": (ingest_employee_adjustments, refine_employee_adjustments, deliver_employee_adjustments),
    "store_adjustments": (ingest_store_adjustments, refine_store_adjustments, deliver_store_adjustments),
    "metric_catalog": (ingest_catalog, None, deliver_catalog),
    "sales_kpis": (None, refine_kpis, deliver_kpis),
}


def run(lake: Lake, datasets: Sequence[str] | None = None) -> None:
    """Run all steps of the given datasets (all by default) in order."""
    for name in JOBS if datasets is None else datasets:
        for step in JOBS[name]:
            if step is not None:
                step(lake)
