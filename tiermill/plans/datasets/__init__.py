"""The 26 datasets: feed specifications, refine steps and delivery columns, composed from the operators."""

from . import dealer, goals, kpi, people, product, reports, sales, store
from ..metrics import publish_catalog
from .site import Site, squash

# Dataset -> (ingest, refine, deliver); None where the dataset has no such step.
DATASETS = {
    "store": (store.location_feed, store.refine_store, store.store_delta),
    "store_hierarchy": (None, None, store.store_hierarchy_delta),
    "store_management_hierarchy": (None, None, store.management_hierarchy_delta),
    "dealer_code": (dealer.dealer_feed, dealer.refine_dealer, dealer.dealer_delta),
    "store_dealer_association": (None, dealer.refine_association, dealer.association_delta),
    "employee": (people.EMPLOYEE_FEED, people.refine_employee, people.EMPLOYEE_DELIVERY),
    "employee_store_association": (None, people.refine_employee_store, people.EMPLOYEE_STORE_DELIVERY),
    "customer": (people.CUSTOMER_FEED, people.refine_customer, people.CUSTOMER_DELIVERY),
    "customer_contact": (people.CUSTOMER_FEED, people.refine_customer_contact, people.CONTACT_DELIVERY),
    "product": (product.PRODUCT_FEED, product.refine_product, product.product_delta),
    "product_category": (product.CATEGORY_FEED, product.refine_category, product.category_delta),
    "sales_details": (sales.SALES_FEED, sales.refine_sales, sales.SALES_DELIVERY),
    "carrier_actuals": (dealer.actuals_feed, dealer.refine_actuals, dealer.deliver_actuals),
    "store_goals": (None, goals.refine_goals, goals.deliver_goals),
    "employee_goals": (None, goals.refine_employee_goals, goals.EMPLOYEE_GOAL_DELIVERY),
    "goal_points": (goals.POINTS_FEED, goals.refine_points, goals.POINTS_DELIVERY),
    "daily_forecast": (goals.FORECAST_FEED, goals.split_forecast, goals.FORECAST_DELIVERY),
    "headcount": (reports.HEADCOUNT_FEED, reports.refine_headcount, reports.HEADCOUNT_DELIVERY),
    "store_traffic": (sales.TRAFFIC_FEED, sales.refine_traffic, sales.TRAFFIC_DELIVERY),
    "customer_experience": (reports.EXPERIENCE_FEED, reports.refine_experience, reports.EXPERIENCE_DELIVERY),
    "sales_leads": (sales.lead_feed, sales.refine_leads, sales.LEAD_DELIVERY),
    "operational_efficiency": (reports.EFFICIENCY_FEED, reports.refine_efficiency, reports.deliver_efficiency),
    "employee_adjustments": (
        reports.EMPLOYEE_ADJUSTMENT_FEED,
        reports.refine_employee_adjustments,
        reports.EMPLOYEE_ADJUSTMENT_DELIVERY,
    ),
    "store_adjustments": (reports.MISC_FEED, reports.refine_store_adjustments, reports.STORE_ADJUSTMENT_DELIVERY),
    "metric_catalog": (None, None, publish_catalog),
    "sales_kpis": (None, kpi.sales_kpis, kpi.store_kpis),
}

__all__ = ["DATASETS", "Site", "dealer", "goals", "kpi", "people", "product", "reports", "sales", "squash", "store"]
