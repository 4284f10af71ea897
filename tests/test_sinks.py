"""Writers: layout, overwrite scope, errors on empty input, tables."""

from __future__ import annotations

import glob
import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from test_events import envelopes, order
from test_kpi import ads_fact, orders_fact, random_ads, random_orders

from cartlake.operators import envelope
from cartlake.plans import bulk_load, kpi_refresh, orders_day
from cartlake.sinks import writers
from cartlake.sources import readers


def test_hourly_landing_layout(spark, folder):
    rows = envelopes(spark, [{"id": 1}, {"id": 2}])
    path = folder + "/raw"
    writers.land_raw(rows, path, envelope.route_entity(F.col("event_type")))
    assert glob.glob(path + "/entity=orders/date=2025-10-03/hour=16/*.json")
    back = readers.read_landed(spark, path, date="2025-10-03", entity="orders")
    assert back.count() == 2 and json.loads(back.first().data)["id"] in (1, 2)
    writers.land_raw(rows, path, F.lit("orders"))
    assert readers.read_landed(spark, path).count() == 4


def facts(spark):
    return orders_fact(spark, random_orders()), ads_fact(spark, random_ads())


def test_refresh_by_hour_replaces_only_its_dates(spark, folder):
    orders, ads = facts(spark)
    path = folder + "/kpi"
    args = dict(output_format="parquet", by_hour=True, manifest_path=folder + "/manifests")
    kpi_refresh.refresh(orders, ads, date(2024, 3, 9), date(2024, 3, 11), "UTC", path, **args, table="kpi_by_hour")
    full = spark.table("kpi_by_hour").collect()
    assert glob.glob(path + "/year=2024/month=03/day=10/hour=0*/region=*/*.parquet")
    want = kpi_refresh.hourly_between(orders, ads, date(2024, 3, 9), date(2024, 3, 11), "UTC").count()
    assert len(full) == want and spark.sql("SHOW PARTITIONS kpi_by_hour").count() > 3
    # the same day without ads: its partitions change, the others stay
    info = kpi_refresh.refresh(orders, ads.filter("false"), date(2024, 3, 10), date(2024, 3, 10), "UTC", path, **args)
    after = writers.read_kpi(spark, path, "parquet", by_hour=True)
    spend = after.groupBy("local_date").agg(F.sum("total_spend").alias("s")).collect()
    by_day = {r.local_date: r.s for r in spend}
    assert by_day[date(2024, 3, 9)] > 0 and by_day[date(2024, 3, 11)] > 0
    manifest = spark.read.json(folder + "/manifests").collect()
    assert len(manifest) == 2 and info["row_count"] == min(m.row_count for m in manifest)


def test_a_smaller_refresh_leaves_only_its_own_partitions(spark, folder):
    orders, ads = facts(spark)
    days = (date(2024, 3, 9), date(2024, 3, 11))
    path = folder + "/k"
    kpi_refresh.refresh(orders, ads, *days, "UTC", path)
    regions = {r.region for r in writers.read_kpi(spark, path, "parquet").collect()}
    keep = sorted(regions)[0]
    hourly = kpi_refresh.hourly_between(orders, ads, *days, "UTC").filter(F.col("region") == keep)
    info = writers.write_kpi(hourly, path, "2024-03-10", "2024-03-11", "parquet")
    left = {(r.region, str(r.local_date)) for r in writers.read_kpi(spark, path, "parquet").collect()}
    assert len(regions) > 1 and {r for r, d in left if d > "2024-03-09"} == {keep} and {r for r, d in left if d == "2024-03-09"} >= {keep}
    assert all(p.endswith(f"region={keep}") for p in info["manifest"].first().partitions)


def test_csv_keeps_empty_text_and_null_apart(spark, folder):
    orders, ads = facts(spark)
    path = folder + "/csv"
    days = (date(2024, 3, 9), date(2024, 3, 11))
    kpi_refresh.refresh(orders, ads, *days, "UTC", path, output_format="csv")
    (first, *_) = glob.glob(path + "/year=2024/month=03/day=10/region=*/*.csv.gz")
    assert gzip.open(first, "rt").readline().startswith("timestamp_utc,currency,")
    want = {(r.region, r.timestamp_utc): r for r in kpi_refresh.hourly_between(orders, ads, *days, "UTC").collect()}
    got = writers.read_kpi(spark, path, "csv").collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.region, r.timestamp_utc]
        for name in ("ad_ai_recommendation", "currency", "ctr", "cpc", "local_datetime", "total_sales", "new_customer_aov"):
            assert r[name] == w[name], name


def test_empty_writes_are_errors(spark, folder):
    orders, ads = facts(spark)
    with pytest.raises(ValueError, match="nothing to write"):
        kpi_refresh.refresh(orders, ads, date(2020, 1, 1), date(2020, 1, 1), "UTC", folder + "/none")
    (spark.range(0).selectExpr("cast(id AS string) AS value")).write.text(folder + "/export")
    with pytest.raises(ValueError, match="nothing to write"):
        bulk_load.load_export(spark, folder + "/export", folder + "/snap", "2024-01-01")


def test_export_skips_blank_and_malformed_lines(spark, folder):
    good = json.dumps({"id": "gid://store/Order/1", "name": "#1", "fulfillments": [{"id": "f"}]})
    with gzip.open(folder + "/x.jsonl.gz", "wt") as f:
        f.write(f"{good}\n\n   \n{{bad\n{good}\n")
    assert readers.read_export(spark, folder + "/x.jsonl.gz").count() == 2
    kept = readers.read_export(spark, folder + "/x.jsonl.gz", keep_malformed=True)
    assert [r[0] for r in kept.select("_corrupt_record", "id").filter("_corrupt_record IS NOT NULL").collect()] == ["{bad"]
    info = bulk_load.load_export(spark, folder + "/x.jsonl.gz", folder + "/snap", "2024-01-01", folder + "/bad")
    assert info == {"rows": 2, "malformed": 1}
    assert [(r.raw, r.reason) for r in spark.read.json(folder + "/bad").collect()] == [("{bad", "malformed line")]
    assert readers.read_snapshots(spark, folder + "/snap", "2024-01-01").count() == 2
    assert readers.read_snapshots(spark, folder + "/snap", "2024-01-02") is None


def test_order_day(spark, folder):
    raw, snaps = folder + "/raw", folder + "/snaps"
    rows = envelopes(
        spark,
        [order(id=1, updated_at="2025-10-03T10:00:00Z"), order(id=1, updated_at="2025-10-03T11:00:00Z", total_price="5"), order(id=2, tags="")],
    )
    writers.land_raw(rows, raw, F.lit("orders"))
    line = {"id": "gid://store/Order/3", "updatedAt": "2025-10-03T00:00:00Z", "createdAt": "2025-10-02T00:00:00Z", "tags": "subscription"}
    stale = {"id": "gid://store/Order/1", "updatedAt": "2025-10-01T00:00:00Z", "tags": ""}
    with open(folder + "/x.jsonl", "w") as f:
        f.write(json.dumps(line) + "\n" + json.dumps(stale) + "\n")
    bulk_load.load_export(spark, folder + "/x.jsonl", snaps, "2025-10-03")
    events_root = raw + "/entity=orders"
    orders_day.run(spark, events_root, snaps, folder + "/done", folder + "/curated", "2025-10-03", ["plan_monthly"], "demo")
    done = {r.order_id: r for r in spark.read.parquet(folder + "/done").collect()}
    assert set(done) == {"1", "2", "3"} and float(done["1"].total_price) == 5.0
    assert (done["3"].order_year, done["3"].order_month, done["3"].order_day) == (2025, 10, 2)
    curated = spark.read.parquet(folder + "/curated")
    assert {(r.order_id, r.subscription_type) for r in curated.collect()} == {("1", "monthly"), ("2", "monthly"), ("3", "monthly")}


def test_plain_nightly_job(spark, folder):
    writers.land_raw(envelopes(spark, [order()]), folder + "/raw", F.lit("orders"))
    orders_day.flatten_landed(spark, folder + "/raw", folder + "/flat", "demo", "2025-10-03")
    before = spark.read.parquet(folder + "/flat").collect()
    writers.land_raw(envelopes(spark, [order(id=9, updated_at="2025-10-04T10:00:00Z")]), folder + "/raw", F.lit("orders"))
    orders_day.flatten_landed(spark, folder + "/raw", folder + "/flat", "demo", "2025-10-04")
    after = spark.read.option("recursiveFileLookup", False).parquet(folder + "/flat").collect()
    assert len(before) == 1 and len(after) >= 1 and any(str(r.date) == "2025-10-03" for r in after)
    r = before[0]
    assert r.brand == "demo" and r.customer.email == "a@example.com" and json.loads(r.line_items)[0]["quantity"] == 1


def test_clock_columns_have_no_zone(spark, folder):
    orders, ads = facts(spark)
    kpi_refresh.refresh(orders, ads, date(2024, 3, 9), date(2024, 3, 9), "UTC", folder + "/k")
    assert isinstance(spark.read.parquet(folder + "/k").first().timestamp_utc, datetime)
    assert dict(spark.read.parquet(folder + "/k").dtypes)["timestamp_utc"] == "timestamp_ntz"


def test_lake_tables_and_purge(spark, folder):
    assert writers.define_lake_tables(spark, folder) == []
    rows = envelopes(spark, [{"id": 1}, {"id": 2}])
    writers.land_raw(rows, folder + "/raw", F.lit("orders"))
    orders = spark.createDataFrame([(1,), (2,)], "order_id int")
    for day in ("2024-01-01", "2024-01-02"):
        writers.write_orders(orders, folder + "/processed/orders_enriched", day)
    assert writers.define_lake_tables(spark, folder) == ["raw_order_events", "processed_orders"]
    assert spark.table("raw_order_events").filter("date = '2025-10-03' AND hour = '16'").count() == 2
    assert spark.table("processed_orders").count() == 4
    path = folder + "/processed/orders_enriched"
    assert writers.purge_expired(spark, path, "2024-01-02") == ["date=2024-01-01"]
    assert spark.read.parquet(path).count() == 4
    writers.purge_expired(spark, path, "2024-01-02", dry_run=False)
    assert spark.read.parquet(path).count() == 2


def test_bucketed_state_joins_without_shuffling_it(spark, folder):
    state = spark.range(1000).selectExpr("cast(id AS string) AS customer_id", "id * 2 AS v")
    writers.write_state_table(state, "customer_state_table", ["customer_id"], 4, folder + "/state")
    assert len(glob.glob(folder + "/state/*.parquet")) == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = spark.range(100).selectExpr("cast(id AS string) AS customer_id").repartition(4, "customer_id")
        joined = spark.table("customer_state_table").join(wanted, "customer_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100 and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE customer_state_table")


def test_curated_tables(spark, folder):
    from cartlake.plans import curated_tables

    start = datetime(2024, 1, 5)
    rows = [
        ("1", "a", start, start, None, True, "monthly"),
        ("2", "a", datetime(2024, 2, 5), start, datetime(2024, 2, 6), True, "monthly"),
        ("3", "b", start, start, None, True, "quarterly"),
        ("4", "c", datetime(2024, 2, 1), datetime(2024, 2, 1), None, False, None),
    ]
    orders = spark.createDataFrame(
        rows,
        "order_id string, customer_id string, created_at timestamp_ntz, customer_created_at timestamp_ntz, "
        "cancelled_at timestamp_ntz, is_subscription boolean, subscription_type string",
    )
    curated_tables.refresh(orders, folder, "2024-03-01")
    (churn,) = spark.read.parquet(folder + "/churn_metrics").collect()
    assert (churn.churn_rate, churn.subscribers, str(churn.metric_date)) == (0.5, 2, "2024-03-01")
    cohorts = {r.cohort_month: r.customers for r in spark.read.parquet(folder + "/customer_cohorts").collect()}
    assert cohorts == {"2024-01": 2, "2024-02": 1}
    assert spark.read.parquet(folder + "/subscription_orders").count() == 3
