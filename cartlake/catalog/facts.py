"""The driver's events as warehouse facts, in DataFrame form and as SQL.

Purchases and errors are orders and refunds, clicks and views are ad rows. A customer's region
gives the country, so events meet customer, nation and region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.catalog.registry import props_k, table
from cartlake.operators import kpi

STORE_ZONE = "America/Chicago"
ACCOUNTS = {"acct_3": "UK", "acct_5": "AU"}


def with_region_name(spark: SparkSession, sf: str, events: DataFrame) -> DataFrame:
    """Events with the name of their customer's region.

    No join is hinted: Spark broadcasts a side it has measured to be small, else both sides of
    the customer join come out of a shuffle and AQE splits a hot user.
    """
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf, "region").select("r_regionkey", "r_name")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        events
        .join(customers, F.col("user_id") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def orders_fact(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").filter(F.col("event_type").isin("purchase", "error"))
    e = with_region_name(spark, sf, events).withColumn("k", props_k())
    bought = lambda value: f"if(event_type = 'purchase', {value}, 0D)"
    part = lambda share: bought(f"floor(value * {share}) / 100D")
    return e.selectExpr(
        "ts AS created_at",
        "CASE r_name WHEN 'AMERICA' THEN 'US' WHEN 'AFRICA' THEN 'CA' WHEN 'EUROPE' THEN if(k % 2 = 0, 'GB', 'UK') "
        "WHEN 'ASIA' THEN 'AU' ELSE 'AE' END AS shipping_country_code",
        "CASE WHEN k % 10 = 0 THEN NULL WHEN k % 3 = 0 THEN 'USD' WHEN k % 3 = 1 THEN 'CAD' ELSE 'GBP' END AS currency",
        f"CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'Europe/London' ELSE '{STORE_ZONE}' END AS shop_timezone",
        bought("value") + " AS order_revenue",
        bought("1D") + " AS orders_quantity",
        "k < 50 AS is_new_customer",
        bought("value") + " AS gross_sales",
        bought("if(k % 2 = 0, value, 0D)") + " AS gross_product_sales",
        "if(event_type = 'error', value, 0D) AS refund_money",
        bought("k / 100D") + " AS discount_amount",
        part(40) + " AS cost_of_goods",
        part(5) + " AS shipping_costs",
        part(6) + " AS estimated_shipping_costs",
        part(1) + " AS handling_fees",
        part(3) + " AS payment_gateway_costs",
    )


SHARE_DIVISORS = [500.0, 1000.0, 2000.0, 1250.0, 2500.0, 625.0, 5000.0]


def ads_fact(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").filter(F.col("event_type").isin("click", "view"))
    e = with_region_name(spark, sf, events).withColumn("k", props_k())
    click = lambda value: f"if(event_type = 'click', {value}, 0D)"
    view = lambda when: f"if(event_type = 'view' AND {when}, cast(k AS double), 0D)"
    return e.selectExpr(
        "to_date(ts) AS event_date",
        "hour(ts) AS event_hour",
        "if(event_id % 2 = 0, 'facebook-ads', 'Google-Ads') AS channel",
        "concat('acct_', user_id % 7) AS account_id",
        "concat('spring offer (', CASE r_name WHEN 'AMERICA' THEN 'USA' WHEN 'AFRICA' THEN 'can' "
        "WHEN 'EUROPE' THEN 'GB' WHEN 'ASIA' THEN 'AUS' ELSE 'ZZ' END, ') film 7') AS campaign_name",
        "concat('set_', k % 4) AS adset_name",
        "if(k % 3 = 0, 'USD', 'CAD') AS currency",
        "'ACTIVE' AS campaign_status",
        "if(k % 23 = 0, 'DELETED', 'ACTIVE') AS adset_status",
        "if(k % 17 = 0, 'PAUSED', 'ACTIVE') AS ad_status",
        click("value") + " AS spend",
        click("if(k % 5 = 0, value, 0D)") + " AS non_tracked_spend",
        view("true") + " AS impressions",
        click("1D") + " AS clicks",
        click("if(k % 7 = 0, 1D, 0D)") + " AS onsite_purchases",
        click("if(k % 7 = 0, value, 0D)") + " AS onsite_conversion_value",
        click("if(k % 9 = 0, 1D, 0D)") + " AS meta_purchases",
        *[view(f"k % {n + 2} = 0") + f" AS {c}" for n, c in enumerate(schemas.SEARCH_IMPRESSIONS)],
        *[f"if(k % 11 <> 0, value / {d}D, NULL) AS {c}" for c, d in zip(schemas.SEARCH_SHARES, SHARE_DIVISORS)],
        "if(k < 30, props, NULL) AS campaign_ai_recommendation",
        "concat('pace-', k % 3) AS campaign_ai_roas_pacing",
        "if(k % 2 = 0, 'scale', NULL) AS adset_ai_recommendation",
        "concat('p', k % 5) AS adset_ai_roas_pacing",
        "event_type AS ad_ai_recommendation",
        "cast(NULL AS string) AS ad_ai_roas_pacing",
        "if(event_id % 2 = 0, 'hold', 'grow') AS channel_ai_recommendation",
        "'' AS channel_ai_roas_pacing",
    )


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.metrics_from_facts(orders_fact(spark, sf), ads_fact(spark, sf), STORE_ZONE, ACCOUNTS)


# ------------------------------------------------------------------ the same in SQL

_M = "DECIMAL(38,12)"


def added(value: str) -> str:
    """A value as a decimal to add up, by its shortest text as other engines read it."""
    return f"CAST(CAST({value} AS VARCHAR) AS {_M})"


def _lines(parts) -> str:
    return ",\n    ".join(parts)


EVENTS_SQL = """events_k AS (
  SELECT e.*, r_name, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events e JOIN customer ON user_id = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_PART = lambda share: f"CASE WHEN event_type = 'purchase' THEN floor(value * {share}) / 100.0 ELSE 0 END"

ORDERS_FACT_SQL = f"""orders_fact AS (
  SELECT ts AS created_at,
    CASE r_name WHEN 'AMERICA' THEN 'US' WHEN 'AFRICA' THEN 'CA'
      WHEN 'EUROPE' THEN CASE WHEN k % 2 = 0 THEN 'GB' ELSE 'UK' END WHEN 'ASIA' THEN 'AU' ELSE 'AE' END
      AS shipping_country_code,
    CASE WHEN k % 10 = 0 THEN NULL WHEN k % 3 = 0 THEN 'USD' WHEN k % 3 = 1 THEN 'CAD' ELSE 'GBP' END AS currency,
    CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'Europe/London' ELSE '{STORE_ZONE}' END AS shop_timezone,
    CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS order_revenue,
    CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS orders_quantity,
    k < 50 AS is_new_customer,
    CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS gross_sales,
    CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN value ELSE 0 END AS gross_product_sales,
    CASE WHEN event_type = 'error' THEN value ELSE 0 END AS refund_money,
    CASE WHEN event_type = 'purchase' THEN k / 100.0 ELSE 0 END AS discount_amount,
    {_PART(40)} AS cost_of_goods, {_PART(5)} AS shipping_costs, {_PART(6)} AS estimated_shipping_costs,
    {_PART(1)} AS handling_fees, {_PART(3)} AS payment_gateway_costs
  FROM events_k WHERE event_type IN ('purchase', 'error'))"""

_ORDER_VALUE = {c: c for c in schemas.ORDER_METRICS[4:]} | {
    "total_sales": "order_revenue",
    "total_orders": "orders_quantity",
    "new_customer_sales": "CASE WHEN is_new_customer THEN order_revenue ELSE 0 END",
    "new_customer_orders": "CASE WHEN is_new_customer THEN orders_quantity ELSE 0 END",
}


def orders_hourly_sql(where: str = "TRUE") -> str:
    sums = _lines(f"sum({added(_ORDER_VALUE[c])}) AS {c}" for c in schemas.ORDER_METRICS)
    return f"""order_sums AS (
  SELECT date_trunc('hour', created_at) AS order_hour, shipping_country_code,
    {sums}
  FROM orders_fact
  WHERE shipping_country_code IN ('US','CA','GB','UK','AU') AND {where}
  GROUP BY 1, 2),
order_votes AS (
  SELECT date_trunc('hour', created_at) AS order_hour, shipping_country_code, currency,
    row_number() OVER (PARTITION BY date_trunc('hour', created_at), shipping_country_code
                       ORDER BY count(*) DESC, currency) AS rn
  FROM orders_fact
  WHERE shipping_country_code IN ('US','CA','GB','UK','AU') AND currency IS NOT NULL AND {where}
  GROUP BY 1, 2, 3),
orders_hourly AS (
  SELECT s.*, v.currency FROM order_sums s
  LEFT JOIN order_votes v ON s.order_hour = v.order_hour
    AND s.shipping_country_code = v.shipping_country_code AND v.rn = 1)"""


_TEXT_SQL = {
    "campaign_ai_recommendation": "CASE WHEN k < 30 THEN props END",
    "campaign_ai_roas_pacing": "'pace-' || (k % 3)",
    "adset_ai_recommendation": "CASE WHEN k % 2 = 0 THEN 'scale' END",
    "adset_ai_roas_pacing": "'p' || (k % 5)",
    "ad_ai_recommendation": "event_type",
    "ad_ai_roas_pacing": "CAST(NULL AS VARCHAR)",
    "channel_ai_recommendation": "CASE WHEN event_id % 2 = 0 THEN 'hold' ELSE 'grow' END",
    "channel_ai_roas_pacing": "''",
}
_SHARE_SQL = {
    n: f"CASE WHEN k % 11 <> 0 THEN value / {d} END" for n, d in zip(schemas.SEARCH_SHARES, SHARE_DIVISORS)
}
_COUNT_SQL = {
    n: f"CASE WHEN event_type = 'view' AND k % {i + 2} = 0 THEN k ELSE 0 END"
    for i, n in enumerate(schemas.SEARCH_IMPRESSIONS)
}

ADS_FACT_SQL = f"""ads_fact AS (
  SELECT date_trunc('hour', ts) AS spend_hour,
    CASE WHEN event_id % 2 = 0 THEN 'facebook-ads' ELSE 'google-ads' END AS channel,
    'acct_' || (user_id % 7) AS account_id,
    'spring offer (' || CASE r_name WHEN 'AMERICA' THEN 'USA' WHEN 'AFRICA' THEN 'can'
      WHEN 'EUROPE' THEN 'GB' WHEN 'ASIA' THEN 'AUS' ELSE 'ZZ' END || ') film 7' AS campaign_name,
    'set_' || (k % 4) AS adset_name,
    CASE WHEN k % 3 = 0 THEN 'USD' ELSE 'CAD' END AS currency,
    CASE WHEN event_type = 'click' THEN value ELSE 0 END AS spend,
    CASE WHEN event_type = 'click' AND k % 5 = 0 THEN value ELSE 0 END AS non_tracked_spend,
    CASE WHEN event_type = 'view' THEN k ELSE 0 END AS impressions,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks,
    CASE WHEN event_type = 'click' AND k % 7 = 0 THEN 1 ELSE 0 END AS onsite_purchases,
    CASE WHEN event_type = 'click' AND k % 7 = 0 THEN value ELSE 0 END AS onsite_conversion_value,
    CASE WHEN event_type = 'click' AND k % 9 = 0 THEN 1 ELSE 0 END AS meta_purchases,
    {_lines(f"{e} AS {n}" for n, e in (_COUNT_SQL | _SHARE_SQL | _TEXT_SQL).items())}
  FROM events_k
  WHERE event_type IN ('click', 'view') AND k % 23 <> 0 AND k % 17 <> 0)"""

_KEYS = "spend_hour, channel, account_id, campaign_name, adset_name"


def ads_hourly_sql(where: str = "TRUE") -> str:
    texts = ["currency", *schemas.ADVISORY_TEXTS]
    votes = "\n  UNION ALL ".join(
        f"SELECT {_KEYS}, '{t}' AS field, {t} AS value FROM ads_rows WHERE {t} IS NOT NULL" for t in texts
    )
    match = " AND ".join(f"s.{k.strip()} = v.{k.strip()}" for k in _KEYS.split(","))
    return f"""ads_rows AS (SELECT * FROM ads_fact WHERE {where}),
ad_sums AS (
  SELECT {_KEYS},
    {_lines(f"sum({added(c)}) AS {c}" for c in schemas.AD_SUMS)},
    {_lines(f"CAST(sum({added(c)}) AS DOUBLE) / nullif(count({c}), 0) AS {c}" for c in schemas.SEARCH_SHARES)}
  FROM ads_rows GROUP BY {_KEYS}),
ad_votes AS (
  SELECT {_KEYS}, field, value,
    row_number() OVER (PARTITION BY {_KEYS}, field ORDER BY count(*) DESC, value) AS rn
  FROM ({votes}) GROUP BY {_KEYS}, field, value),
ad_texts AS (
  SELECT {_KEYS},
    {_lines(f"max(CASE WHEN field = '{t}' THEN value END) AS {t}" for t in texts)}
  FROM ad_votes WHERE rn = 1 GROUP BY {_KEYS}),
ads_hourly AS (
  SELECT s.*, {", ".join(f"v.{t}" for t in texts)}
  FROM ad_sums s LEFT JOIN ad_texts v ON {match})"""


_UTC = lambda col: f"timezone('UTC', timezone('{STORE_ZONE}', {col}))"
_LOCAL = (
    "timezone(CASE region WHEN 'US' THEN 'America/Chicago' WHEN 'CA' THEN 'America/Regina' "
    "WHEN 'UK' THEN 'Europe/London' WHEN 'AU' THEN 'Australia/Sydney' END, timezone('UTC', timestamp_utc))"
)


def _weight(share: str) -> str:
    """Share times impressions."""
    return added(f"coalesce({share}, 0) * CAST(impressions AS DOUBLE)")


def six_digits(col: str) -> str:
    return f"floor({col} * 1e6 + 0.5) / 1e6"


def _metrics_sql() -> str:
    ad_side = ["meta_spend", "google_spend", *schemas.AD_COUNTS, *schemas.SEARCH_IMPRESSIONS]
    ad_expr = {
        "meta_spend": "CASE WHEN channel = 'facebook-ads' THEN spend END",
        "google_spend": "CASE WHEN channel = 'google-ads' THEN spend END",
    }
    weighted = [
        f"{_weight(c)} AS {c}" for c in schemas.SEARCH_SHARES
    ]
    texts = schemas.ADVISORY_TEXTS
    rank = "{'a': channel, 'b': account_id, 'c': campaign_name, 'd': adset_name}"
    return f"""fact_union AS (
  SELECT CASE shipping_country_code WHEN 'GB' THEN 'UK' ELSE shipping_country_code END AS region,
    {_UTC("order_hour")} AS timestamp_utc, currency, shipping_country_code AS currency_rank,
    {_lines(schemas.ORDER_METRICS)},
    {_lines(f"CAST(NULL AS {_M}) AS {c}" for c in ad_side)},
    {_lines(f"CAST(NULL AS {_M}) AS {c}" for c in schemas.SEARCH_SHARES)},
    NULL AS text_rank, {_lines(f"CAST(NULL AS VARCHAR) AS {c}" for c in texts)}
  FROM orders_hourly
  UNION ALL
  SELECT CASE account_id WHEN 'acct_3' THEN 'UK' WHEN 'acct_5' THEN 'AU' ELSE
      CASE split_part(split_part(campaign_name, '(', 2), ')', 1) WHEN 'AUS' THEN 'AU' WHEN 'GB' THEN 'UK' WHEN 'can' THEN 'CA'
        ELSE 'US' END END,
    {_UTC("spend_hour")}, NULL, NULL,
    {_lines("NULL" for c in schemas.ORDER_METRICS)},
    {_lines(ad_expr.get(c, c) for c in ad_side)},
    {_lines(weighted)},
    {rank}, {_lines(f"nullif({c}, '')" for c in texts)}
  FROM ads_hourly),
metric_sums AS (
  SELECT region, timestamp_utc,
    coalesce(arg_max(currency, currency_rank) FILTER (WHERE currency IS NOT NULL), 'USD') AS currency,
    {_lines(f"coalesce(CAST(sum({c}) AS DOUBLE), 0) AS {c}" for c in schemas.HOURLY_SUMS if c != "new_customer_orders")},
    CAST(coalesce(sum(new_customer_orders), 0) AS BIGINT) AS new_customer_orders,
    {_lines(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in schemas.SEARCH_SHARES)},
    {_lines(f"coalesce(arg_min({c}, text_rank) FILTER (WHERE {c} IS NOT NULL), '') AS {c}" for c in texts)}
  FROM fact_union GROUP BY 1, 2),
metrics AS (
  SELECT * REPLACE (
    {_lines(f"CASE WHEN impressions > 0 THEN coalesce({c}, 0) / impressions ELSE 0.0 END AS {c}" for c in schemas.SEARCH_SHARES)})
  FROM metric_sums)"""


FACTS_SQL = f"{EVENTS_SQL},\n{ORDERS_FACT_SQL},\n{ADS_FACT_SQL}"
METRICS_SQL = f"{FACTS_SQL},\n{orders_hourly_sql()},\n{ads_hourly_sql()},\n{_metrics_sql()}"


def metrics_sql_between(low: str, high: str) -> str:
    """Metrics from facts between two store-local bounds."""
    return (
        f"{FACTS_SQL},\n"
        + orders_hourly_sql(f"date_trunc('second', created_at) BETWEEN TIMESTAMP '{low}' AND TIMESTAMP '{high}'")
        + ",\n"
        + ads_hourly_sql(f"spend_hour BETWEEN TIMESTAMP '{low}' AND TIMESTAMP '{high}'")
        + ",\n"
        + _metrics_sql()
    )


_SPEND = "(meta_spend + google_spend)"
_PROFIT = "(total_sales - cost_of_goods - shipping_costs - payment_gateway_costs - handling_fees)"
DERIVED_SQL = {
    "total_spend": _SPEND,
    "new_customer_cpp": f"{_SPEND} / nullif(new_customer_orders, 0)",
    "new_customer_aov": "new_customer_sales / nullif(new_customer_orders, 0)",
    "new_customer_roas": f"new_customer_sales / nullif({_SPEND}, 0)",
    "blended_roas": f"total_sales / nullif({_SPEND}, 0)",
    "returning_orders": "greatest(total_orders - new_customer_orders, 0.0)",
    "returning_sales": "total_sales - new_customer_sales",
    "net_sales": "total_sales - refund_money",
    "gross_profit": _PROFIT,
    "gross_margin": f"{_PROFIT} / nullif(total_sales, 0)",
    "discount_rate": "discount_amount / nullif(total_sales, 0)",
    "refund_rate": "refund_money / nullif(total_sales, 0)",
    "ctr": "clicks / nullif(impressions, 0)",
    "cpc": f"{_SPEND} / nullif(clicks, 0)",
    "cpm": f"{_SPEND} * 1000 / nullif(impressions, 0)",
    "onsite_roas": f"onsite_conversion_value / nullif({_SPEND}, 0)",
}


def daily_sql(source: str = "metrics") -> str:
    """CTE ``daily``: rollup of ``source`` by local date, shares still weighted sums."""
    sums = [c for c in schemas.HOURLY_SUMS if c != "new_customer_orders"]
    return f"""daily_sums AS (
  SELECT region, CAST({_LOCAL} AS DATE) AS local_date,
    {_lines(f"CAST(sum({added(c)}) AS DOUBLE) AS {c}" for c in sums)},
    CAST(sum(new_customer_orders) AS BIGINT) AS new_customer_orders,
    {_lines(f"CAST(sum({_weight(c)}) AS DOUBLE) AS {c}" for c in schemas.SEARCH_SHARES)},
    {_lines(f"arg_min({c}, timestamp_utc) AS {c}" for c in ["currency", *schemas.ADVISORY_TEXTS])}
  FROM {source} GROUP BY 1, 2),
daily AS (
  SELECT * REPLACE ({_lines(f"{c} / nullif(impressions, 0) AS {c}" for c in schemas.SEARCH_SHARES)}),
    {_lines(f"{e} AS {n}" for n, e in DERIVED_SQL.items())}
  FROM daily_sums)"""


def shown_sql(columns: list[str], extra: dict[str, str] | None = None) -> str:
    """Select list with shares to 6 digits and clocks as text."""
    special = {c: six_digits(c) for c in schemas.SEARCH_SHARES}
    special |= {"local_date": "strftime(local_date, '%Y-%m-%d')"}
    special |= extra or {}
    return _lines(f"{special[c]} AS {c}" if c in special else c for c in columns)


HOURLY_SHOWN = {
    "timestamp_utc": "strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S')",
    "local_datetime": "strftime(local_datetime, '%Y-%m-%d %H:%M:%S')",
    "central_datetime": "strftime(central_datetime, '%Y-%m-%d %H:%M:%S')",
    "local_hour": "strftime(local_datetime, '%Y-%m-%d %H:00')",
    "central_hour": "strftime(central_datetime, '%Y-%m-%d %H:00')",
}


def hourly_sql(source: str = "metrics") -> str:
    """CTE ``hourly``: ``source`` with the derived columns and local clocks."""
    return f"""hourly AS (
  SELECT *, CAST(local_datetime AS DATE) AS local_date FROM (
    SELECT *, {_LOCAL} AS local_datetime,
      timezone('America/Chicago', timezone('UTC', timestamp_utc)) AS central_datetime,
      {_lines(f"{e} AS {n}" for n, e in DERIVED_SQL.items())}
    FROM {source}))"""
