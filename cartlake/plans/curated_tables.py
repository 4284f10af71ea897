"""Curated tables from processed orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.operators import curated
from cartlake.sinks import writers


def refresh(orders: DataFrame, root: str, metric_date: str) -> None:
    """Churn of the day, cohorts, and subscription orders of the day under ``root``.

    ``orders`` has the columns of the processed table with ``created_at`` and
    ``customer_created_at`` as clocks.
    """
    day = F.lit(metric_date).cast("date")
    writers.write_partitioned(curated.churn_metrics(orders, day), f"{root}/churn_metrics", ["metric_date"])
    cohorts = curated.customer_cohorts(orders).withColumn("cohort_month", F.date_format("cohort_month", "yyyy-MM"))
    writers.write_partitioned(cohorts, f"{root}/customer_cohorts", ["cohort_month"])
    writers.write_subscription_orders(orders, f"{root}/subscription_orders", metric_date)
