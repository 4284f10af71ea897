"""Alert rows and alarm windows (AL1-AL5, A22, F21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions import numeric as num

# --- fixed values: thresholds and wording of the alerts ---
REPEAT_FAILURE_ATTEMPTS = 2
HIGH_VALUE_CENTS = 10000
LISTED_HOURS = 5
# --- end of fixed values ---

ALARM_WINDOW = "5 minutes"


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit("None")))


def _message(title: str, *lines: Column) -> Column:
    return F.concat(F.concat_ws("\n", F.lit(title), *lines), F.lit("\n"))


def _alert(df: DataFrame, rule: str, key: Column, subject: Column, message: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), key.alias("record_id"), subject.alias("subject"), message.alias("message")
    )


def cancellations(subscriptions: DataFrame) -> DataFrame:
    """Every cancelled subscription event (AL1)."""
    c = F.col
    title = "Subscription Cancelled"
    return _alert(
        subscriptions.filter(c("event_type") == "subscription/cancelled"),
        "subscription_cancelled",
        c("subscription_id"),
        F.lit(title),
        _message(
            title,
            _line("Subscription ID", c("subscription_id")),
            _line("Customer ID", c("customer_id")),
            _line("Product", c("product_title")),
            _line("Reason", c("cancellation_reason")),
            _line("Comments", c("cancellation_reason_comments")),
            _line("Cancelled At", c("cancelled_at")),
        ),
    )


def repeat_failures(charges: DataFrame) -> DataFrame:
    """Failed subscription charges from the second attempt on (AL2)."""
    c = F.col
    hit = (c("event_type") == "charge/failed") & (c("billing_attempt_count") >= REPEAT_FAILURE_ATTEMPTS)
    error = F.concat(
        F.coalesce(c("error"), F.lit("None")), F.lit(" ("), F.coalesce(c("error_type"), F.lit("None")), F.lit(")")
    )
    return _alert(
        charges.filter(hit),
        "repeat_charge_failure",
        c("charge_id"),
        F.format_string("Subscription Payment Failure - Attempt %d", c("billing_attempt_count")),
        _message(
            "Subscription Charge Failed",
            _line("Charge ID", c("charge_id")),
            _line("Subscription ID", c("subscription_id")),
            _line("Customer ID", c("customer_id")),
            _line("Attempts", c("billing_attempt_count")),
            _line("Error", error),
            _line("Retry Date", c("retry_date")),
            _line("Total Price", c("total_price")),
        ),
    )


def _dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), amount.cast("decimal(18,2)").cast("string"))


def high_value_failures(payments: DataFrame) -> DataFrame:
    """Failed payments strictly above the limit (AL3)."""
    c = F.col
    hit = (c("event_type") == "charge.failed") & (c("amount") > num.cents(F.lit(HIGH_VALUE_CENTS)))
    failure = F.concat(
        F.coalesce(c("failure_code"), F.lit("None")),
        F.lit(" - "),
        F.coalesce(c("failure_message"), F.lit("None")),
    )
    return _alert(
        payments.filter(hit),
        "high_value_payment_failure",
        c("charge_id"),
        F.concat(F.lit("High-Value Payment Failure "), _dollars(c("amount"))),
        _message(
            "High-Value Payment Failure",
            _line("Charge ID", c("charge_id")),
            _line("Amount", F.concat_ws(" ", _dollars(c("amount")), c("currency"))),
            _line("Customer", c("customer_id")),
            _line("Failure", failure),
        ),
    )


def disputes(rows: DataFrame) -> DataFrame:
    """Every dispute event (AL4)."""
    c = F.col
    return _alert(
        rows,
        "dispute",
        c("dispute_id"),
        F.concat(F.lit("Payment Dispute "), _dollars(c("amount"))),
        _message(
            "Payment Dispute Alert",
            _line("Dispute ID", c("dispute_id")),
            _line("Charge ID", c("charge_id")),
            _line("Amount", F.concat_ws(" ", _dollars(c("amount")), c("currency"))),
            _line("Reason", c("reason")),
            _line("Status", c("status")),
            _line("Event", c("event_type")),
        ),
    )


def quality_alert(checks: DataFrame) -> DataFrame:
    """One row for all failed checks of a run, none when all passed (AL5, O5).

    The input has one row per check of a run.
    """
    hours = F.slice(F.sort_array("missing_hours"), 1, LISTED_HOURS)
    listed = F.when(
        F.size("missing_hours") > 0, F.concat(F.lit("\n  Missing hours: "), F.array_join(hours, ", "))
    ).otherwise("")
    line = F.concat(F.lit("- "), F.col("check"), F.lit(": "), F.col("message"), listed)
    failed = checks.filter(F.col("status") == "FAIL").agg(
        F.sort_array(F.collect_list(F.struct(F.col("check"), line.alias("line")))).alias("_l")
    )
    return _alert(
        failed.filter(F.size("_l") > 0),
        "data_quality",
        F.lit("quality_run"),
        F.format_string("Data Quality Alert (%d checks)", F.size("_l")),
        F.concat_ws("\n", F.lit("Data Quality Failures Detected:"), F.col("_l.line")),
    )


def alarm_windows(
    samples: DataFrame, time: str, name: str, value: Column, statistic: str = "sum", threshold: float = 0
) -> DataFrame:
    """Tumbling 5-minute statistic above its threshold, per metric name.

    The same expression runs on a table and, after ``withWatermark``, on a stream.
    """
    agg = {"sum": F.sum, "max": F.max}[statistic]
    return (
        samples.groupBy(F.window(time, ALARM_WINDOW), F.col(name).alias("metric"))
        .agg(agg(value).alias("value"))
        .filter(F.col("value") > threshold)
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "metric", "value"
        )
    )
