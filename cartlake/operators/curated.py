"""Cohort, churn, attribution and geography over enriched orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.operators.ranking import split_row_number, time_levels
from cartlake.operators.skew import HOT_ROWS, salted_join


def cohort_month(created: Column) -> Column:
    """Month in which the customer came in."""
    return F.to_date(F.date_trunc("month", created))


def days_since_acquisition(orders: DataFrame) -> DataFrame:
    """Customer tenure in days at the time of the order."""
    return orders.withColumn(
        "days_since_acquisition", F.datediff("created_at", "customer_created_at")
    )


def with_rebill_number(orders: DataFrame, hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Which cycle of the customer's subscription an order is, by (created_at, order_id)."""
    return split_row_number(
        orders.filter("is_subscription"),
        ["customer_id"],
        time_levels(F.col("created_at"), F.col("order_id")),
        ["created_at", F.col("order_id").cast("bigint")],
        "rebill_number",
        hot_rows,
        hot,
    )


def acquisition(orders: DataFrame) -> DataFrame:
    """First order date per customer: the cohort table's grain."""
    return orders.groupBy("customer_id").agg(F.min("created_at").alias("customer_created_at"))


def with_acquisition(orders: DataFrame, hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Orders with the first order date of their customer, for sources that do not carry it."""
    return salted_join(orders, acquisition(orders), ["customer_id"], hot_rows=hot_rows, hot=hot)


def churn_by_cohort(orders: DataFrame) -> DataFrame:
    """Share of a cohort's subscribers with a cancelled order."""
    cancelled = F.when(F.col("cancelled_at").isNotNull(), F.col("customer_id"))
    per_customer = (
        orders.filter("is_subscription")
        .groupBy(cohort_month(F.col("customer_created_at")).alias("cohort_month"), "customer_id")
        .agg(F.max(cancelled.isNotNull()).alias("_cancelled"))
    )
    known = F.when(F.col("customer_id").isNotNull(), F.lit(1))
    return per_customer.groupBy("cohort_month").agg(
        F.try_divide(
            F.count(F.when(F.col("_cancelled"), known)).cast("double"), F.count(known).cast("double")
        ).alias("churn_rate"),
        F.count(known).alias("subscribers"),
    )


def revenue_by_source(orders: DataFrame) -> DataFrame:
    """Orders, revenue and mean value per acquisition source."""
    return orders.groupBy("source_name").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("total_price").alias("revenue"),
        F.try_divide(F.sum("total_price").cast("double"), F.count("total_price").cast("double")).alias(
            "avg_order_value"
        ),
    )


def discount_impact(orders: DataFrame) -> DataFrame:
    """Discounted against full-price orders."""
    kind = F.when(F.col("total_discounts") > 0, "Discounted").otherwise("Full Price")
    return orders.groupBy(kind.alias("order_type")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.try_divide(F.sum("total_price").cast("double"), F.count("total_price").cast("double")).alias(
            "avg_revenue"
        ),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def retention_curve(subscription_orders: DataFrame) -> DataFrame:
    """Active customers and revenue per cohort and cycle."""
    return subscription_orders.groupBy("cohort_month", "rebill_number").agg(
        F.count_distinct("customer_id").alias("active_customers"),
        F.sum("total_price").alias("revenue"),
    )


def orders_by_state(orders: DataFrame, country: str) -> DataFrame:
    """Orders per state of one country."""
    return (
        orders.filter(F.col("shipping_country") == country)
        .groupBy("shipping_state")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total_price").alias("total_revenue"),
            F.try_divide(F.sum("total_price").cast("double"), F.count("total_price").cast("double")).alias(
                "avg_order_value"
            ),
        )
    )


def customer_cohorts(orders: DataFrame) -> DataFrame:
    """Customers and first-order facts per cohort month."""
    return (
        acquisition(orders)
        .groupBy(cohort_month(F.col("customer_created_at")).alias("cohort_month"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.min("customer_created_at").alias("first_order"),
            F.max("customer_created_at").alias("last_first_order"),
        )
    )


def churn_metrics(orders: DataFrame, metric_date: Column) -> DataFrame:
    """Cohort churn stamped with the day it was measured, ready for its table."""
    return churn_by_cohort(orders).withColumn("metric_date", metric_date)


def subscription_orders(orders: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Subscription orders with their cohort and cycle, the input of the retention curve."""
    return with_rebill_number(orders, hot=hot).withColumn(
        "cohort_month", cohort_month(F.col("customer_created_at"))
    )
