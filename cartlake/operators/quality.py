"""Hourly gaps, volume anomalies, table health and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.functions import numeric as num
from cartlake.functions import timeutil as tu

HOUR_MARK = "yyyy-MM-dd HH:00'Z'"
WINDOW_HOURS = 24
ANOMALY_DAYS = 7
ANOMALY_RATIO = 0.5
ANOMALY_CHECK = "order_count_anomaly"
GAP_CHECK = "hourly_data_gaps"
HEALTH_CHECK = "state_table_health"


def hourly_counts(events: DataFrame, time: str = "ts", by: list[str] | None = None) -> DataFrame:
    """Events per hour."""
    return events.groupBy(*(by or []), tu.hour_of(F.col(time)).alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


def expected_hours(keys: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """The last ``hours`` hours, the running one included, for each row of ``keys``."""
    newest = tu.hour_of(as_of)
    oldest = newest - F.make_dt_interval(F.lit(0), F.lit(hours - 1))
    grid = F.explode(F.sequence(oldest, newest, F.expr("interval 1 hour")))
    return keys.withColumn("hour", grid)


def series_of(events: DataFrame, by: str | None, expected: DataFrame | None = None) -> DataFrame:
    """The series a check reports on: ``expected(series)`` if given, else all that ever had an event."""
    if not by:
        return events.sparkSession.range(1).select(F.lit("all").alias("series"))
    return (expected if expected is not None else events.select(F.col(by).alias("series"))).select("series").distinct()


def hourly_gaps(
    events: DataFrame,
    as_of: Column,
    hours: int = WINDOW_HOURS,
    time: str = "ts",
    by: str | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """FAIL with the list of empty hours, else PASS.

    The events are reduced to the hours seen in the window before they meet the grid, which has
    ``hours`` rows per series; the bound is on the raw time, so older data is not read for it.
    Every series of ``expected(series)`` is reported, however long it has been silent. Without
    that list it is every series of the events, which reads one column of all of them.
    """
    start = tu.hour_of(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours - 1))
    series = series_of(events, by, expected)
    key = F.col(by) if by else F.lit("all")
    seen = (
        events.filter(F.col(time) >= start)
        .select(key.alias("series"), tu.hour_of(F.col(time)).alias("hour"))
        .distinct()
        .withColumn("_seen", F.lit(True))
    )
    marked = expected_hours(series, as_of, hours).join(seen, ["series", "hour"], "left")
    missing = F.sort_array(
        F.collect_list(F.when(F.col("_seen").isNull(), F.date_format("hour", HOUR_MARK)))
    )
    return marked.groupBy("series").agg(missing.alias("missing_hours")).select(
        "series",
        F.lit(GAP_CHECK).alias("check"),
        F.when(F.size("missing_hours") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.format_string("Missing %d hourly partitions", F.size("missing_hours")).alias("message"),
        "missing_hours",
    )


def count_anomaly(
    events: DataFrame,
    as_of: Column,
    time: str = "ts",
    by: str | None = None,
    align_hours: bool = True,
    days: int = ANOMALY_DAYS,
    ratio: float = ANOMALY_RATIO,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Last full hour against the mean of an hour over the days before.

    ``align_hours`` compares like with like; without it the earlier days use the hour after the
    one under test. Days without events count as 0, and so does a series without any event in
    them; ``expected`` is that of ``hourly_gaps``. Counts read only the days in question.
    """
    tested = tu.hour_of(as_of) - F.expr("interval 1 hour")
    anchor = tested if align_hours else tu.hour_of(as_of)
    hour = tu.hour_of(F.col(time))
    back = [anchor - F.make_dt_interval(F.lit(d)) for d in range(1, days + 1)]
    low, high = back[-1], tu.hour_of(as_of) + F.expr("interval 1 hour")
    read = events.filter((F.col(time) >= low) & (F.col(time) < high))
    wanted = [
        F.count(F.when(hour == tested, 1)).alias("current_count"),
        F.count(F.when(hour.isin(*back), 1)).alias("_earlier"),
    ]
    if by:
        counted = read.groupBy(F.col(by).alias("series")).agg(*wanted)
        counts = series_of(events, by, expected).join(counted, "series", "left").na.fill(0, ["current_count", "_earlier"])
    else:
        counts = read.agg(*wanted).withColumn("series", F.lit("all"))
    average = F.col("_earlier") / F.lit(float(days))
    threshold = average * F.lit(ratio)
    ok = (average == 0) | (F.col("current_count") >= threshold)
    shown = num.round_exact(average, 2)
    return counts.select(
        "series",
        F.lit(ANOMALY_CHECK).alias("check"),
        F.when(ok, "PASS").otherwise("FAIL").alias("status"),
        F.format_string("Current %d vs avg %.2f", F.col("current_count"), shown).alias("message"),
        "current_count",
        shown.alias("average_count"),
        num.round_exact(threshold, 2).alias("threshold"),
    )


def state_health(
    state: DataFrame, keys: list[str], updated: str, as_of: Column, max_age_hours: int = 24
) -> DataFrame:
    """Exact rows, newest update and duplicate keys of a state table (D3).

    Rows are counted per key first, which leaves one small partial result per task.
    """
    per_key = state.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(updated).alias("_u"))
    total = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("item_count"),
        F.max("_u").alias("last_update"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_keys"),
    )
    age = F.make_dt_interval(F.lit(0), F.lit(max_age_hours))
    status = (
        F.when(F.col("item_count") == 0, "EMPTY")
        .when(F.col("duplicate_keys") > 0, "DUPLICATES")
        .when(F.col("last_update") < as_of - age, "STALE")
        .otherwise("ACTIVE")
    )
    return total.withColumn("table_status", status).select(
        F.lit(HEALTH_CHECK).alias("check"),
        F.when(F.col("table_status") == "ACTIVE", "PASS").otherwise("FAIL").alias("status"),
        F.format_string("Table %s ~%d items", "table_status", "item_count").alias("message"),
        "item_count",
        "table_status",
        "duplicate_keys",
        "last_update",
    )


def as_checks(*results: DataFrame) -> DataFrame:
    """Results of any checks under the one quality schema, one row per check."""
    wanted = {f.split()[0]: f for f in QUALITY_FIELDS}
    out = None
    for df in results:
        have = set(df.columns)
        cols = [
            (F.col(n) if n in have else F.lit(None)).cast(ddl.split(" ", 1)[1]).alias(n)
            for n, ddl in wanted.items()
        ]
        rows = df.select(*cols)
        out = rows if out is None else out.unionByName(rows)
    return out


QUALITY_FIELDS = [
    "check string",
    "status string",
    "message string",
    "missing_hours array<string>",
    "current_count bigint",
    "average_count double",
    "threshold double",
    "item_count bigint",
    "table_status string",
]


def quality_result(checks: DataFrame, stamp: Column) -> DataFrame:
    """One quality document: a timestamp and all checks of the run, a handful of rows."""
    names = [f.split()[0] for f in QUALITY_FIELDS]
    return checks.agg(F.sort_array(F.collect_list(F.struct(*names))).cast(f"array<{schemas.QUALITY_CHECK}>").alias("checks")).select(
        stamp.alias("timestamp"), "checks"
    )


def status_metrics(checks: DataFrame, stamp: Column) -> DataFrame:
    """1 for a passed check, 0 for a failed one."""
    return checks.select(
        F.concat(F.lit("DataQuality_"), F.col("check")).alias("metric_name"),
        F.when(F.col("status") == "PASS", 1).otherwise(0).alias("value"),
        F.lit("Count").alias("unit"),
        stamp.alias("timestamp"),
    )


def _violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, all rules in one pass."""
    counts = df.agg(*[F.count(F.when(F.coalesce(bad, F.lit(False)), 1)).alias(n) for n, bad in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def validate_hourly(hourly: DataFrame) -> DataFrame:
    """Violations per rule in the hourly dataset."""
    negative = F.lit(False)
    for c in schemas.HOURLY_SUMS:
        if c in hourly.columns and c not in ("refund_money", "discount_amount"):
            negative = negative | (F.col(c) < 0)
    rules = {
        "missing_key": F.col("region").isNull() | F.col("timestamp_utc").isNull(),
        "unknown_region": ~F.col("region").isin(list(tu.REGION_ZONES)),
        "negative_metric": negative,
        "more_new_than_total": F.col("new_customer_orders") > F.col("total_orders"),
        "off_the_hour": tu.hour_of(F.col("timestamp_utc")) != F.col("timestamp_utc"),
    }
    keys = hourly.groupBy("region", "timestamp_utc").agg(F.count(F.lit(1)).alias("_n"))
    return _violations(hourly, rules).unionByName(_violations(keys, {"duplicate_key": F.col("_n") > 1}))


def reconcile(hourly: DataFrame, facts: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Totals of the hourly dataset against totals of its facts."""
    left = hourly.agg(*[F.expr(f"{num.exact_total(a)} AS {a}") for a in pairs])
    right = facts.agg(*[F.expr(f"{num.exact_total(b)} AS {a}") for a, b in pairs.items()])
    sides = left.unpivot([], list(pairs), "metric", "hourly_total").join(
        right.unpivot([], list(pairs), "metric", "fact_total"), "metric"
    )
    return sides.withColumn("difference", num.round_exact(F.col("hourly_total") - F.col("fact_total"), 4))


def validate_orders(orders: DataFrame) -> DataFrame:
    """Violations per rule in enriched orders."""
    rules = {
        "missing_id": F.col("order_id").isNull(),
        "missing_customer": F.col("customer_id").isNull(),
        "unreadable_created_at": F.col("created_at").isNotNull()
        & F.col("created_at").try_cast("timestamp").isNull(),
        "negative_total": F.col("total_price") < 0,
        "discount_above_price": F.col("total_discounts") > F.col("total_price"),
    }
    keys = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    return _violations(orders, rules).unionByName(_violations(keys, {"duplicate_id": F.col("_n") > 1}))


def weighted_percentiles(
    counted: DataFrame, by: list[str], value: str, weight: str, wanted: dict[str, float]
) -> DataFrame:
    """Exact interpolated percentiles of counted values per group.

    The values of a group are walked in order by a window, which spills to disk; the built-in
    percentile would hold all distinct values of a group in memory.
    """
    totals = counted.groupBy(*by).agg(F.sum(weight).alias("_total"))
    running = F.sum(weight).over(W.partitionBy(*by).orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    walked = counted.withColumn("_upto", running).join(totals, by)
    cuts, out = [], []
    for name, share in wanted.items():
        at = F.lit(share) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            cuts.append(F.min(F.when(F.col("_upto") > rank, F.col(value))).alias(f"_{name}_{side}"))
        cuts.append(F.max(at - F.floor(at)).alias(f"_{name}_part"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low + (high - low) * F.col(f"_{name}_part")).cast("double").alias(name))
    return walked.groupBy(*by).agg(*cuts).select(*by, *out)


def event_lag(
    events: DataFrame, event_time: str, ingested: str, by: list[str], quarantined: Column, sla_seconds: int
) -> DataFrame:
    """Arrival lag, quarantined events and share within the agreed time.

    Lag is taken in whole seconds and counted per value first, so everything after the first
    aggregate works on distinct lags and not on events.
    """
    lag = F.unix_timestamp(F.col(ingested)) - F.unix_timestamp(F.col(event_time))
    counted = (
        events.select(*by, lag.alias("_lag"), F.coalesce(quarantined, F.lit(False)).alias("_bad"))
        .groupBy(*by, "_lag")
        .agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("_bad"), 1)).alias("_rejected"))
    )
    on_time = F.coalesce(F.sum(F.when(F.col("_lag") <= sla_seconds, F.col("_n"))), F.lit(0))
    totals = counted.groupBy(*by).agg(
        F.sum("_n").alias("events"),
        F.max("_lag").alias("lag_max_seconds"),
        F.sum("_rejected").alias("quarantined"),
        F.try_divide(on_time.cast("double"), F.sum("_n").cast("double")).alias("on_time_share"),
    )
    known = counted.filter(F.col("_lag").isNotNull())
    shares = {"lag_p50_seconds": 0.5, "lag_p95_seconds": 0.95}
    return totals.join(weighted_percentiles(known, by, "_lag", "_n", shares), by, "left")
