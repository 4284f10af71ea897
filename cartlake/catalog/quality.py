"""Quality check queries over the driver's events, one series per event type."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlake.catalog import facts
from cartlake.catalog.registry import plain, props_k, query, table
from cartlake.operators import quality
from cartlake.operators.state import upsert

AS_OF = "2024-01-30 12:34:00"
_HOUR = "TIMESTAMP '2024-01-30 12:00:00'"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def gaps(spark, sf):
    return quality.hourly_gaps(table(spark, sf, "events"), as_of(), by="event_type")


_GAPS = f"""g AS (
  SELECT event_type AS series, list(strftime(h, '%Y-%m-%d %H:00Z') ORDER BY h) FILTER (WHERE n IS NULL) AS missing
  FROM (SELECT DISTINCT event_type FROM events)
  CROSS JOIN (SELECT unnest(generate_series({_HOUR} - INTERVAL 23 HOUR, {_HOUR}, INTERVAL 1 HOUR)) AS h)
  LEFT JOIN (SELECT event_type AS t, date_trunc('hour', ts) AS seen, count(*) AS n FROM events GROUP BY 1, 2)
    ON t = event_type AND seen = h
  GROUP BY 1)"""


@query(
    "dq_hourly_gaps",
    f"""WITH {_GAPS}
SELECT series, 'hourly_data_gaps' AS "check", CASE WHEN coalesce(len(missing), 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  'Missing ' || coalesce(len(missing), 0) || ' hourly partitions' AS message,
  coalesce(array_to_string(missing, ','), '') AS missing_hours
FROM g""",
)
def dq_hourly_gaps(spark, sf):
    return gaps(spark, sf).withColumn("missing_hours", F.array_join("missing_hours", ","))


def _anomaly_sql(anchor: str) -> str:
    return f"""WITH c AS (
  SELECT event_type AS series,
    count(*) FILTER (WHERE date_trunc('hour', ts) = {_HOUR} - INTERVAL 1 HOUR) AS current_count,
    count(*) FILTER (WHERE date_trunc('hour', ts) IN ({", ".join(f"{anchor} - INTERVAL {d} DAY" for d in range(1, 8))}))
      / 7.0 AS average
  FROM events GROUP BY 1)
SELECT series, 'order_count_anomaly' AS "check",
  CASE WHEN average = 0 OR current_count >= average * 0.5 THEN 'PASS' ELSE 'FAIL' END AS status,
  printf('Current %d vs avg %.2f', current_count, average) AS message, current_count,
  CAST(printf('%.2f', average) AS DOUBLE) AS average_count, CAST(printf('%.2f', average * 0.5) AS DOUBLE) AS threshold
FROM c"""


@query("dq_count_anomaly", _anomaly_sql(f"({_HOUR} - INTERVAL 1 HOUR)"))
def dq_count_anomaly(spark, sf):
    return quality.count_anomaly(table(spark, sf, "events"), as_of(), by="event_type")


@query("dq_count_anomaly_unaligned", _anomaly_sql(_HOUR))
def dq_count_anomaly_unaligned(spark, sf):
    """Earlier days use the hour after the one under test."""
    return quality.count_anomaly(table(spark, sf, "events"), as_of(), by="event_type", align_hours=False)


def health(spark, sf):
    latest = upsert(table(spark, sf, "events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    return quality.state_health(latest, ["user_id"], "ts", as_of())


@query(
    "dq_state_health",
    """WITH s AS (SELECT count(DISTINCT user_id) AS n, max(ts) AS u FROM events)
SELECT 'state_table_health' AS "check",
  CASE WHEN n > 0 AND u >= TIMESTAMP '2024-01-29 12:34:00' THEN 'PASS' ELSE 'FAIL' END AS status,
  'Table ' || CASE WHEN n = 0 THEN 'EMPTY' WHEN u < TIMESTAMP '2024-01-29 12:34:00' THEN 'STALE' ELSE 'ACTIVE' END
    || ' ~' || n || ' items' AS message,
  n AS item_count,
  CASE WHEN n = 0 THEN 'EMPTY' WHEN u < TIMESTAMP '2024-01-29 12:34:00' THEN 'STALE' ELSE 'ACTIVE' END AS table_status,
  CAST(0 AS BIGINT) AS duplicate_keys, strftime(u, '%Y-%m-%d %H:%M:%S') AS last_update
FROM s""",
)
def dq_state_health(spark, sf):
    return plain(health(spark, sf))


@query(
    "dq_version_health",
    """WITH k AS (SELECT user_id, count(*) AS n, max(ts) AS u FROM events GROUP BY 1),
s AS (SELECT CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (WHERE n > 1) AS d, max(u) AS u FROM k),
t AS (SELECT *, CASE WHEN n = 0 THEN 'EMPTY' WHEN d > 0 THEN 'DUPLICATES' WHEN u < TIMESTAMP '2024-01-29 12:34:00' THEN 'STALE'
  ELSE 'ACTIVE' END AS state FROM s)
SELECT 'state_table_health' AS "check", CASE WHEN state = 'ACTIVE' THEN 'PASS' ELSE 'FAIL' END AS status,
  'Table ' || state || ' ~' || n || ' items' AS message, n AS item_count, state AS table_status, d AS duplicate_keys,
  strftime(u, '%Y-%m-%d %H:%M:%S') AS last_update
FROM t""",
)
def dq_version_health(spark, sf):
    """The health check over all versions, where a key has as many rows as it had events."""
    return plain(quality.state_health(table(spark, sf, "events"), ["user_id"], "ts", as_of()))


def all_checks(spark, sf):
    events = table(spark, sf, "events")
    return quality.as_checks(
        quality.hourly_gaps(events, as_of()), quality.count_anomaly(events, as_of()), health(spark, sf)
    )


CHECKS_SQL = f"""hours AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1),
grid AS (SELECT unnest(generate_series({_HOUR} - INTERVAL 23 HOUR, {_HOUR}, INTERVAL 1 HOUR)) AS g),
gap AS (SELECT list(strftime(g, '%Y-%m-%d %H:00Z') ORDER BY g) FILTER (WHERE n IS NULL) AS missing
  FROM grid LEFT JOIN hours ON g = h),
vol AS (SELECT coalesce(sum(n) FILTER (WHERE h = {_HOUR} - INTERVAL 1 HOUR), 0) AS cur,
  coalesce(sum(n) FILTER (WHERE h IN ({", ".join(f"{_HOUR} - INTERVAL 1 HOUR - INTERVAL {d} DAY" for d in range(1, 8))})), 0)
    / 7.0 AS average FROM hours),
st AS (SELECT count(DISTINCT user_id) AS n, max(ts) AS u FROM events),
checks AS (
  SELECT 'hourly_data_gaps' AS name, coalesce(len(missing), 0) = 0 AS ok,
    'Missing ' || coalesce(len(missing), 0) || ' hourly partitions' AS message,
    coalesce(list_slice(missing, 1, 5), []) AS shown FROM gap
  UNION ALL SELECT 'order_count_anomaly', average = 0 OR cur >= average * 0.5,
    printf('Current %d vs avg %.2f', CAST(cur AS BIGINT), CAST(average AS DOUBLE)), [] FROM vol
  UNION ALL SELECT 'state_table_health', n > 0 AND u >= TIMESTAMP '2024-01-29 12:34:00',
    'Table ' || CASE WHEN n = 0 THEN 'EMPTY' WHEN u < TIMESTAMP '2024-01-29 12:34:00' THEN 'STALE' ELSE 'ACTIVE' END
      || ' ~' || n || ' items', [] FROM st)"""


@query(
    "dq_metrics",
    f"""WITH {CHECKS_SQL}
SELECT 'DataQuality_' || name AS metric_name, CAST(ok AS BIGINT) AS value, 'Count' AS unit,
  '2024-01-30 12:34:00' AS timestamp FROM checks""",
)
def dq_metrics(spark, sf):
    return plain(quality.status_metrics(all_checks(spark, sf), as_of()))


@query(
    "dq_result_document",
    f"""WITH {CHECKS_SQL}
SELECT '2024-01-30 12:34:00' AS timestamp, CAST(count(*) AS BIGINT) AS checks,
  string_agg(name || '=' || CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END || ':' || message, ';' ORDER BY name) AS summary
FROM checks""",
)
def dq_result_document(spark, sf):
    """The stored document of a run, read for its checks."""
    doc = quality.quality_result(all_checks(spark, sf), F.lit(AS_OF))
    line = lambda c: F.concat(c["check"], F.lit("="), c["status"], F.lit(":"), c["message"])
    return doc.select(
        "timestamp",
        F.size("checks").cast("bigint").alias("checks"),
        F.array_join(F.transform("checks", line), ";").alias("summary"),
    )


@query(
    "dq_validate_hourly",
    f"""WITH {facts.METRICS_SQL},
v AS (SELECT count(*) FILTER (WHERE region IS NULL OR timestamp_utc IS NULL) AS missing_key,
  count(*) FILTER (WHERE region NOT IN ('US', 'CA', 'UK', 'AU')) AS unknown_region,
  count(*) FILTER (WHERE total_sales < 0 OR meta_spend < 0 OR impressions < 0) AS negative_metric,
  count(*) FILTER (WHERE new_customer_orders > total_orders) AS more_new_than_total,
  count(*) FILTER (WHERE date_trunc('hour', timestamp_utc) <> timestamp_utc) AS off_the_hour,
  count(*) - count(DISTINCT region || timestamp_utc) AS duplicate_key FROM metrics)
UNPIVOT v ON COLUMNS(*) INTO NAME rule VALUE violations""",
)
def dq_validate_hourly(spark, sf):
    return quality.validate_hourly(facts.metrics(spark, sf))


@query(
    "dq_validate_orders",
    """WITH d AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount
  FROM lineitem GROUP BY 1),
v AS (SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS missing_id,
  count(*) FILTER (WHERE o_custkey IS NULL) AS missing_customer, CAST(0 AS BIGINT) AS unreadable_created_at,
  count(*) FILTER (WHERE o_totalprice < 0) AS negative_total,
  count(*) FILTER (WHERE discount > CAST(o_totalprice AS DECIMAL(18,2))) AS discount_above_price,
  count(*) - count(DISTINCT o_orderkey) AS duplicate_id FROM orders LEFT JOIN d ON o_orderkey = l_orderkey)
UNPIVOT v ON COLUMNS(*) INTO NAME rule VALUE violations""",
)
def dq_validate_orders(spark, sf):
    from cartlake.catalog.curated import orders

    return quality.validate_orders(orders(spark, sf, discounts=True, acquired=False))


@query(
    "dq_reconcile",
    f"""WITH {facts.METRICS_SQL},
m AS (SELECT CAST(sum(CAST(total_sales AS DECIMAL(38,12))) AS DOUBLE) AS total_sales,
  CAST(sum(CAST(refund_money AS DECIMAL(38,12))) AS DOUBLE) AS refund_money FROM metrics),
f AS (SELECT CAST(sum(CAST(order_revenue AS DECIMAL(38,12))) AS DOUBLE) AS total_sales,
  CAST(sum(CAST(refund_money AS DECIMAL(38,12))) AS DOUBLE) AS refund_money FROM orders_fact),
b AS (SELECT 'total_sales' AS metric, m.total_sales AS hourly_total, f.total_sales AS fact_total FROM m, f
  UNION ALL SELECT 'refund_money', m.refund_money, f.refund_money FROM m, f)
SELECT *, CAST(printf('%.4f', hourly_total - fact_total) AS DOUBLE) AS difference FROM b""",
)
def dq_reconcile(spark, sf):
    """Hourly totals against fact totals; facts of unmapped countries are the difference."""
    pairs = {"total_sales": "order_revenue", "refund_money": "refund_money"}
    return quality.reconcile(facts.metrics(spark, sf), facts.orders_fact(spark, sf), pairs)


@query(
    "event_lag",
    """WITH e AS (SELECT event_type, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) * (event_id % 7) AS lag,
  event_type = 'signup' AND event_id % 5 = 0 AS bad FROM events)
SELECT event_type, count(*) AS events, quantile_cont(lag, 0.5) AS lag_p50_seconds,
  floor(quantile_cont(lag, 0.95) * 1000 + 0.5) / 1000 AS lag_p95_seconds, max(lag) AS lag_max_seconds,
  count(*) FILTER (WHERE bad) AS quarantined,
  CAST(count(*) FILTER (WHERE lag <= 60) AS DOUBLE) / count(*) AS on_time_share
FROM e GROUP BY 1""",
)
def event_lag(spark, sf):
    """Arrival lag per event type; arrival is made up from the event's own number."""
    lag = props_k().cast("bigint") * (F.col("event_id") % 7)
    events = table(spark, sf, "events").select(
        "event_type",
        F.col("ts").cast("timestamp").alias("event_time"),
        (F.date_trunc("second", F.col("ts").cast("timestamp")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), lag)).alias(
            "ingested_at"
        ),
        ((F.col("event_type") == "signup") & (F.col("event_id") % 5 == 0)).alias("bad"),
    )
    out = quality.event_lag(events, "event_time", "ingested_at", ["event_type"], F.col("bad"), 60)
    return out.withColumn("lag_p95_seconds", F.expr("floor(lag_p95_seconds * 1000D + 0.5D) / 1000D"))

