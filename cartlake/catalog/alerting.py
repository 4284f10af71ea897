"""Alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlake.catalog import enrichment, quality
from cartlake.catalog.registry import plain, query, table
from cartlake.operators import alerts, enrich

_K = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"
_TS = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_MONEY = "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)"


@query(
    "alerts_cancellations",
    f"""SELECT 'subscription_cancelled' AS rule, CAST(event_id AS VARCHAR) AS record_id, 'Subscription Cancelled' AS subject,
  'Subscription Cancelled' || chr(10) || 'Subscription ID: ' || event_id || chr(10) || 'Customer ID: ' || user_id || chr(10)
  || 'Product: Monthly Box' || chr(10) || 'Reason: ' || CASE WHEN {_K} % 3 = 0 THEN 'too expensive' ELSE 'None' END
  || chr(10) || 'Comments: None' || chr(10) || 'Cancelled At: ' || {_TS} || chr(10) AS message
FROM events WHERE event_type = 'error'""",
)
def alerts_cancellations(spark, sf):
    return alerts.cancellations(enrich.project_subscriptions(enrichment.subscription_envelopes(spark, sf)))


@query(
    "alerts_repeat_failure",
    f"""SELECT 'repeat_charge_failure' AS rule, CAST(event_id AS VARCHAR) AS record_id,
  'Subscription Payment Failure - Attempt ' || {_K} % 4 AS subject,
  'Subscription Charge Failed' || chr(10) || 'Charge ID: ' || event_id || chr(10) || 'Subscription ID: ' || event_id % 100
  || chr(10) || 'Customer ID: ' || user_id || chr(10) || 'Attempts: ' || {_K} % 4 || chr(10)
  || 'Error: ' || CASE WHEN {_K} % 3 <> 0 THEN 'declined' ELSE 'None' END || ' (CARD)' || chr(10)
  || 'Retry Date: None' || chr(10) || 'Total Price: ' || {_MONEY} || chr(10) AS message
FROM events WHERE event_type = 'error' AND {_K} % 4 >= 2""",
)
def alerts_repeat_failure(spark, sf):
    return alerts.repeat_failures(enrich.project_subscription_charges(enrichment.charge_envelopes(spark, sf)))


@query(
    "alerts_high_value",
    f"""SELECT 'high_value_payment_failure' AS rule, 'ch_' || event_id AS record_id,
  'High-Value Payment Failure $' || {_MONEY} AS subject,
  'High-Value Payment Failure' || chr(10) || 'Charge ID: ch_' || event_id || chr(10) || 'Amount: $' || {_MONEY} || ' USD'
  || chr(10) || 'Customer: cus_' || user_id || chr(10) || 'Failure: card_declined - '
  || CASE WHEN {_K} % 2 = 0 THEN 'no funds' ELSE 'None' END || chr(10) AS message
FROM events WHERE event_type = 'error' AND CAST(value AS DECIMAL(18,2)) > 100""",
)
def alerts_high_value(spark, sf):
    return alerts.high_value_failures(enrich.project_payment_charges(enrichment.payment_envelopes(spark, sf)))


@query(
    "alerts_disputes",
    f"""SELECT 'dispute' AS rule, 'dp_' || event_id AS record_id, 'Payment Dispute $' || {_MONEY} AS subject,
  'Payment Dispute Alert' || chr(10) || 'Dispute ID: dp_' || event_id || chr(10) || 'Charge ID: ch_' || user_id || chr(10)
  || 'Amount: $' || {_MONEY} || ' GBP' || chr(10) || 'Reason: ' || CASE WHEN {_K} % 2 = 0 THEN 'fraudulent' ELSE 'None' END
  || chr(10) || 'Status: needs_response' || chr(10) || 'Event: charge.dispute.created' || chr(10) AS message
FROM events""",
)
def alerts_disputes(spark, sf):
    return alerts.disputes(enrich.project_disputes(enrichment.dispute_envelopes(spark, sf)))


@query(
    "alerts_quality",
    """WITH g AS (
  SELECT event_type AS series, list(strftime(h, '%Y-%m-%d %H:00Z') ORDER BY h) FILTER (WHERE n IS NULL) AS missing
  FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN (SELECT unnest(generate_series(
    TIMESTAMP '2024-01-29 13:00:00', TIMESTAMP '2024-01-30 12:00:00', INTERVAL 1 HOUR)) AS h)
  LEFT JOIN (SELECT event_type AS t, date_trunc('hour', ts) AS seen, count(*) AS n FROM events GROUP BY 1, 2)
    ON t = event_type AND seen = h GROUP BY 1)
SELECT 'data_quality' AS rule, 'quality_run' AS record_id, 'Data Quality Alert (' || count(*) || ' checks)' AS subject,
  'Data Quality Failures Detected:' || chr(10) || string_agg('- hourly_data_gaps/' || series || ': Missing ' || len(missing)
    || ' hourly partitions' || chr(10) || '  Missing hours: ' || array_to_string(list_slice(missing, 1, 5), ', '),
    chr(10) ORDER BY series) AS message
FROM g WHERE len(missing) > 0 HAVING count(*) > 0""",
)
def alerts_quality(spark, sf):
    """One alert over the gap check of every event type."""
    checks = quality.gaps(spark, sf).withColumn("check", F.concat_ws("/", "check", "series"))
    return alerts.quality_alert(checks)


@query(
    "alarm_5min",
    """SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  'source-' || user_id % 3 AS metric, CAST(count(*) AS BIGINT) AS value
FROM events WHERE event_type = 'error' GROUP BY 1, 2, 3""",
)
def alarm_5min(spark, sf):
    """Error sums per 5 minutes and source above zero."""
    return plain(alerts.alarm_windows(alarm_samples(spark, sf), "ts", "source", F.col("errors")))


def alarm_samples(spark, sf):
    return with_samples(table(spark, sf, "events"))


def with_samples(events):
    source = F.concat(F.lit("source-"), (F.col("user_id") % 3).cast("string"))
    errors = F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint")
    return events.select("ts", source.alias("source"), errors.alias("errors"))


@query(
    "alarm_queue_depth",
    f"""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  event_type AS metric, max({_K}) AS value
FROM events GROUP BY 1, 2, 3 HAVING max({_K}) > 50""",
)
def alarm_queue_depth(spark, sf):
    """Greatest depth per 5 minutes and queue above a threshold."""
    from cartlake.catalog.registry import props_k

    samples = table(spark, sf, "events").select("ts", "event_type", props_k().cast("bigint").alias("depth"))
    return plain(alerts.alarm_windows(samples, "ts", "event_type", F.col("depth"), "max", 50))
