"""Cohort, churn and attribution queries over the driver's orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlake.catalog.registry import plain, query, table
from cartlake.operators import curated
from cartlake.operators.skew import hot_keys, salted_join

SUBSCRIBERS = ["BUILDING", "HOUSEHOLD"]


def hot_customers(spark, sf):
    """Counted on the key column alone, once for every step that needs it."""
    return hot_keys(table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id")), ["customer_id"])


def orders(spark, sf, discounts: bool = False, acquired: bool = True):
    """Orders under the names of the enriched table, with the first order date if ``acquired``."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("cancelled_at"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_price"),
        F.col("o_orderpriority").alias("source_name"),
    )
    if acquired:
        o = curated.with_acquisition(o, hot=hot_customers(spark, sf))
    if discounts:
        lines = (
            table(spark, sf, "lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(
                F.expr(
                    "sum(cast(l_extendedprice AS decimal(18,2)) * cast(l_discount AS decimal(4,2)))"
                ).alias("total_discounts")
            )
        )
        o = o.join(lines, "order_id", "left")
    return o


def with_customer(spark, sf, o):
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("shipping_state"), F.col("r_name").alias("shipping_country")
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_nationkey", F.col("c_mktsegment").isin(SUBSCRIBERS).alias("is_subscription")
    )
    joined = salted_join(o, customers, ["customer_id"], hot=hot_customers(spark, sf))
    return joined.join(places, F.col("c_nationkey") == F.col("n_nationkey"))


_O = """o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS created_at, o_orderstatus, o_orderpriority,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total_price, c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS is_subscription,
    n_name, r_name, min(o_orderdate) OVER (PARTITION BY o_custkey) AS customer_created_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
_REBILL = """s AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_at, order_id) AS rebill_number
  FROM o WHERE is_subscription)"""
_MONTH = "strftime(date_trunc('month', customer_created_at), '%Y-%m-%d')"


@query(
    "cohort_churn",
    f"""WITH {_O}
SELECT {_MONTH} AS cohort_month,
  CAST(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN customer_id END) AS DOUBLE) / count(DISTINCT customer_id) AS churn_rate,
  count(DISTINCT customer_id) AS subscribers
FROM o WHERE is_subscription GROUP BY 1""",
)
def cohort_churn(spark, sf):
    return plain(curated.churn_by_cohort(with_customer(spark, sf, orders(spark, sf))))


@query(
    "churn_metrics",
    f"""WITH {_O}
SELECT {_MONTH} AS cohort_month, '2024-01-31' AS metric_date,
  CAST(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN customer_id END) AS DOUBLE) / count(DISTINCT customer_id) AS churn_rate,
  count(DISTINCT customer_id) AS subscribers
FROM o WHERE is_subscription GROUP BY 1""",
)
def churn_metrics(spark, sf):
    rows = with_customer(spark, sf, orders(spark, sf))
    return plain(curated.churn_metrics(rows, F.lit("2024-01-31").cast("date")))


@query(
    "customer_cohorts",
    f"""WITH f AS (SELECT o_custkey, min(o_orderdate) AS customer_created_at FROM orders GROUP BY 1)
SELECT {_MONTH} AS cohort_month, count(*) AS customers,
  strftime(min(customer_created_at), '%Y-%m-%d %H:%M:%S') AS first_order,
  strftime(max(customer_created_at), '%Y-%m-%d %H:%M:%S') AS last_first_order
FROM f GROUP BY 1""",
)
def customer_cohorts(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("created_at")
    )
    return plain(curated.customer_cohorts(o))


_AVG = "CAST(sum(total_price) AS DOUBLE) / count(total_price)"


@query(
    "revenue_by_source",
    f"""WITH {_O}
SELECT o_orderpriority AS source_name, count(DISTINCT order_id) AS orders, CAST(sum(total_price) AS DOUBLE) AS revenue,
  {_AVG} AS avg_order_value
FROM o GROUP BY 1""",
)
def revenue_by_source(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_price"),
        F.col("o_orderpriority").alias("source_name"),
    )
    return plain(curated.revenue_by_source(o))


@query(
    "discount_impact",
    f"""WITH {_O},
d AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount
  FROM lineitem GROUP BY 1)
SELECT CASE WHEN discount > 0 THEN 'Discounted' ELSE 'Full Price' END AS order_type, count(*) AS order_count,
  {_AVG} AS avg_revenue, count(DISTINCT customer_id) AS unique_customers
FROM o LEFT JOIN d ON order_id = l_orderkey GROUP BY 1""",
)
def discount_impact(spark, sf):
    return plain(curated.discount_impact(orders(spark, sf, discounts=True, acquired=False)))


@query(
    "rebill_number",
    f"""WITH {_O}, {_REBILL}
SELECT order_id, customer_id, rebill_number FROM s""",
)
def rebill_number(spark, sf):
    rows = curated.with_rebill_number(with_customer(spark, sf, orders(spark, sf)), hot=hot_customers(spark, sf))
    return rows.select("order_id", "customer_id", "rebill_number")


@query(
    "retention_curve",
    f"""WITH {_O}, {_REBILL}
SELECT {_MONTH} AS cohort_month, rebill_number, count(DISTINCT customer_id) AS active_customers,
  CAST(sum(total_price) AS DOUBLE) AS revenue
FROM s GROUP BY 1, 2""",
)
def retention_curve(spark, sf):
    rows = curated.subscription_orders(with_customer(spark, sf, orders(spark, sf)), hot_customers(spark, sf))
    return plain(curated.retention_curve(rows))


@query(
    "days_since_acquisition",
    f"""WITH {_O}
SELECT order_id, CAST(date_diff('day', customer_created_at, created_at) AS BIGINT) AS days_since_acquisition,
  {_MONTH} AS cohort_month
FROM o""",
)
def days_since_acquisition(spark, sf):
    rows = curated.days_since_acquisition(orders(spark, sf))
    return plain(
        rows.select(
            "order_id",
            "days_since_acquisition",
            curated.cohort_month(F.col("customer_created_at")).alias("cohort_month"),
        )
    )


@query(
    "orders_by_state",
    f"""WITH {_O}
SELECT n_name AS shipping_state, count(*) AS order_count, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
  {_AVG} AS avg_order_value
FROM o WHERE r_name = 'AMERICA' GROUP BY 1 ORDER BY total_revenue DESC""",
)
def orders_by_state(spark, sf):
    """Revenue per state of one country, greatest first."""
    rows = curated.orders_by_state(with_customer(spark, sf, orders(spark, sf, acquired=False)), "AMERICA")
    return plain(rows).orderBy(F.desc("total_revenue"))
