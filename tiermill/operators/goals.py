"""Allocation of store goals to employees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metrics that are not divided, the metric with a flat goal, its amounts and the part-time share.
PASS_THROUGH_METRICS = ("WTR", "Accessory Attach Rate", "GoPhone Auto Enrollment %")
FLAT_GOAL_METRIC = "Gross Profit"
FLAT_GOALS = {0: 10000, 1: 7000}
PART_TIME_SHARE = 0.75


def allocate_goals(
    goals: DataFrame,
    bridge: DataFrame,
    employees: DataFrame,
    headcount: DataFrame,
    fixed: Mapping[int, float] = FLAT_GOALS,
    pass_through: Sequence[str] = PASS_THROUGH_METRICS,
    flat_metric: str = FLAT_GOAL_METRIC,
    part_time_share: float = PART_TIME_SHARE,
) -> DataFrame:
    """Employee goals from store goals.

    Inputs: ``goals(storenumber, kpiname, goalvalue, report_date)``, ``bridge(storenumber, sourceemployeeid,
    companycd)`` with primary locations only, ``employees(sourceemployeeid, name, parttimeindicator)`` and
    ``headcount(storenumber, approved_headcount)``.  Ordinary goals are shared per head, part-timers get a share
    of that; listed metrics pass through; the flat metric depends only on part time.
    """
    part_time = F.col("parttimeindicator")
    flat = None
    for indicator, amount in fixed.items():
        value = F.lit(float(amount))
        flat = F.when(part_time == indicator, value) if flat is None else flat.when(part_time == indicator, value)
    per_head = F.try_divide(F.col("goalvalue"), F.col("approved_headcount"))
    value = (
        F.when(F.col("kpiname") == flat_metric, flat)
        .when(F.col("kpiname").isin(*pass_through), F.col("goalvalue"))
        .when(part_time == 1, per_head * F.lit(part_time_share))
        .otherwise(per_head)
    )
    staff = bridge.join(employees, "sourceemployeeid").join(headcount, "storenumber")
    staff = staff.filter(part_time.isin(*fixed))
    return goals.join(staff, "storenumber").select(
        "report_date",
        "sourceemployeeid",
        "kpiname",
        "companycd",
        F.col("name").alias("employeename"),
        F.round(value, 2).alias("goalvalue"),
    )
