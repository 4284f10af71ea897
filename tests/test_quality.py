"""Quality checks, alerts and percentiles."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from cartlake.operators import alerts, quality
from cartlake.plans import quality_run

AS_OF = datetime(2024, 1, 10, 12, 34)


def now():
    return F.lit(str(AS_OF)).cast("timestamp_ntz")


def events(spark, moments):
    return spark.createDataFrame([(m, i, i % 3) for i, m in enumerate(moments)], "ts timestamp_ntz, id bigint, k bigint")


def hours_back(n):
    return AS_OF.replace(minute=0) - timedelta(hours=n)


def test_silent_series_are_reported(spark):
    moments = [hours_back(24 * 60), hours_back(1), hours_back(25)]
    mixed = events(spark, moments)
    gaps = {r.series: r.status for r in quality.hourly_gaps(mixed, now(), by="k").collect()}
    assert gaps == {0: "FAIL", 1: "FAIL", 2: "FAIL"}
    counts = {r.series: (r.current_count, r.status) for r in quality.count_anomaly(mixed, now(), by="k").collect()}
    assert counts == {0: (0, "PASS"), 1: (1, "PASS"), 2: (0, "FAIL")}
    listed = spark.createDataFrame([(7,), (1,)], "series bigint")
    assert {r.series for r in quality.hourly_gaps(mixed, now(), by="k", expected=listed).collect()} == {1, 7}
    assert {r.series for r in quality.count_anomaly(mixed, now(), by="k", expected=listed).collect()} == {1, 7}


def test_gaps_include_the_running_hour(spark):
    full = events(spark, [hours_back(h) + timedelta(minutes=5) for h in range(24)])
    assert quality.hourly_gaps(full, now()).first().status == "PASS"
    partial = events(spark, [hours_back(h) for h in range(1, 24) if h != 5])
    r = quality.hourly_gaps(partial, now()).first()
    assert r.status == "FAIL" and r.missing_hours == ["2024-01-10 07:00Z", "2024-01-10 12:00Z"]
    assert r.message == "Missing 2 hourly partitions"
    nothing = events(spark, [hours_back(500)])
    assert len(quality.hourly_gaps(nothing, now()).first().missing_hours) == 24


def test_count_anomaly(spark):
    def run(current, earlier, align=True):
        base = hours_back(1)
        moments = [base + timedelta(seconds=i) for i in range(current)]
        for day in range(1, 8):
            at = (base if align else hours_back(0)) - timedelta(days=day)
            moments += [at + timedelta(seconds=i) for i in range(earlier)]
        return quality.count_anomaly(events(spark, moments or [hours_back(900)]), now(), align_hours=align).first()

    assert run(4, 10).status == "FAIL" and run(5, 10).status == "PASS" and run(0, 0).status == "PASS"
    r = run(4, 10, align=False)
    assert (r.status, r.current_count, r.average_count, r.threshold) == ("FAIL", 4, 10.0, 5.0)
    assert r.message == "Current 4 vs avg 10.00"


def test_run_writes_document_and_alert(spark, folder):
    rows = events(spark, [hours_back(h) for h in range(1, 24)])
    metrics, alert = quality_run.run(rows, rows, ["id"], "ts", now(), folder + "/dq")
    assert {r.metric_name: r.value for r in metrics.collect()} == {
        "DataQuality_hourly_data_gaps": 0,
        "DataQuality_order_count_anomaly": 1,
        "DataQuality_state_table_health": 1,
    }
    (a,) = alert.collect()
    assert a.subject == "Data Quality Alert (1 checks)" and "Missing hours: 2024-01-10 12:00Z" in a.message
    assert spark.read.json(folder + "/dq").first().date is not None
    good = events(spark, [hours_back(h) for h in range(24)])
    checks = quality_run.run_checks(good, good, ["id"], "ts", now())
    assert alerts.quality_alert(checks).count() == 0


def test_state_health_kinds(spark):
    fresh = events(spark, [AS_OF, AS_OF])
    assert quality.state_health(fresh, ["id"], "ts", now()).first().table_status == "ACTIVE"
    assert quality.state_health(fresh.unionByName(fresh), ["id"], "ts", now()).first().table_status == "DUPLICATES"
    assert quality.state_health(events(spark, [hours_back(30)]), ["id"], "ts", now()).first().table_status == "STALE"
    assert quality.state_health(fresh.filter("false"), ["id"], "ts", now()).first().table_status == "EMPTY"


def test_weighted_percentiles_are_exact(spark):
    rng = random.Random(4)
    rows = [("a", rng.randint(0, 50), rng.randint(1, 9)) for _ in range(60)] + [("b", 7, 1)]
    counted = spark.createDataFrame(rows, "g string, v bigint, n bigint").groupBy("g", "v").agg(F.sum("n").alias("n"))
    shares = {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}
    got = {r.g: r for r in quality.weighted_percentiles(counted, ["g"], "v", "n", shares).collect()}
    for g in "ab":
        values = [v for k, v, n in rows if k == g for _ in range(n)]
        for name, share in shares.items():
            assert abs(got[g][name] - np.percentile(values, share * 100)) < 1e-9


def test_alarm_threshold_is_strict(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 1), "a", 0), (datetime(2024, 1, 1, 0, 4, 59), "a", 2), (datetime(2024, 1, 1, 0, 5), "a", 0)],
        "ts timestamp_ntz, name string, n bigint",
    )
    (r,) = alerts.alarm_windows(df, "ts", "name", F.col("n")).collect()
    assert (r.window_start, r.value) == (datetime(2024, 1, 1), 2)
