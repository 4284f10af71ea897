"""Golden daily and hourly rows, brute-force checks of the fact aggregates, row order independence."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.operators import kpi
from cartlake.plans import kpi_refresh

TEXTS = {c: "" for c in schemas.ADVISORY_TEXTS}


def metrics(spark, rows):
    zero = {c: 0.0 for c in [*schemas.HOURLY_SUMS, *schemas.SEARCH_SHARES]}
    full = [{**zero, **TEXTS, "currency": "USD", **r} for r in rows]
    names = schemas.HOURLY_METRICS.names
    whole = lambda n, v: int(v) if n == "new_customer_orders" else v
    return spark.createDataFrame([tuple(whole(n, r[n]) for n in names) for r in full], schemas.HOURLY_METRICS)


# golden values of the daily case
DAY = [
    dict(
        region="UK", timestamp_utc=datetime(2024, 10, 13, 10), meta_spend=100.0, google_spend=50.0,
        new_customer_orders=10, total_orders=12.0, new_customer_sales=1200.0, total_sales=2000.0, gross_sales=2050.0,
        gross_product_sales=1500.0, refund_money=100.0, discount_amount=50.0, cost_of_goods=500.0, shipping_costs=100.0,
        estimated_shipping_costs=90.0, handling_fees=10.0, payment_gateway_costs=20.0, non_tracked_spend=15.0,
        impressions=1000.0, clicks=100.0, onsite_purchases=5.0, onsite_conversion_value=500.0, meta_purchases=3.0,
        search_impression_share=0.5, search_top_impression_share=0.3, search_top_impressions=200.0,
        search_rank_lost_impressions=3.0, campaign_ai_recommendation='{"summary": "scale budget"}',
    ),
    dict(
        region="UK", timestamp_utc=datetime(2024, 10, 13, 20), meta_spend=30.0, google_spend=20.0,
        new_customer_orders=5, total_orders=7.0, new_customer_sales=600.0, total_sales=900.0, gross_sales=950.0,
        gross_product_sales=1000.0, refund_money=20.0, discount_amount=15.0, cost_of_goods=200.0, shipping_costs=50.0,
        estimated_shipping_costs=30.0, handling_fees=5.0, payment_gateway_costs=8.0, non_tracked_spend=5.0,
        impressions=400.0, clicks=40.0, onsite_purchases=2.0, onsite_conversion_value=150.0, meta_purchases=1.0,
        search_impression_share=0.25, search_top_impression_share=0.2, search_top_impressions=80.0,
        search_rank_lost_impressions=1.0,
    ),
]


def test_daily_golden(spark):
    (row,) = kpi.daily_report(metrics(spark, DAY)).collect()
    assert list(row.asDict()) == schemas.DAILY_COLUMNS and len(row) == 61
    want = dict(
        local_date=date(2024, 10, 13), meta_spend=130, google_spend=70, total_spend=200, new_customer_orders=15,
        new_customer_sales=1800, total_sales=2900, new_customer_aov=120, new_customer_roas=9, blended_roas=14.5,
        new_customer_cpp=200 / 15, returning_orders=4, returning_sales=1100, net_sales=2780, gross_profit=2007,
        gross_margin=2007 / 2900, discount_rate=65 / 2900, refund_rate=120 / 2900, non_tracked_spend=20,
        impressions=1400, clicks=140, ctr=0.1, cpc=200 / 140, cpm=200000 / 1400, onsite_roas=650 / 200, currency="USD",
        search_impression_share=(0.5 * 1000 + 0.25 * 400) / 1400,
        search_top_impression_share=(0.3 * 1000 + 0.2 * 400) / 1400, search_top_impressions=280,
        search_rank_lost_impressions=4, campaign_ai_recommendation='{"summary": "scale budget"}',
    )
    for name, value in want.items():
        assert row[name] == pytest.approx(value) if isinstance(value, float) else row[name] == value, name
    (rounded,) = kpi.rounded_report(kpi.daily_report(metrics(spark, DAY))).collect()
    assert (rounded.new_customer_cpp, rounded.gross_margin, rounded.cpc) == (13.33, 0.692, 1.4286)
    assert rounded.local_date == "2024-10-13"


def test_hourly_golden(spark):
    hour = dict(
        region="AU", timestamp_utc=datetime(2024, 10, 13, 10), meta_spend=10.0, google_spend=5.0, new_customer_orders=1,
        total_orders=2.0, new_customer_sales=100.0, total_sales=150.0, refund_money=10.0, discount_amount=5.0,
        cost_of_goods=40.0, shipping_costs=8.0, handling_fees=2.0, payment_gateway_costs=3.0, impressions=200.0,
        clicks=20.0, onsite_conversion_value=60.0, onsite_purchases=2.0,
    )
    (row,) = kpi.hourly_table(metrics(spark, [hour])).collect()
    want = dict(
        local_date=date(2024, 10, 13), local_hour="2024-10-13 21:00", central_hour="2024-10-13 05:00", total_spend=15,
        new_customer_cpp=15, new_customer_aov=100, new_customer_roas=100 / 15, blended_roas=10, returning_orders=1,
        returning_sales=50, net_sales=140, gross_profit=97, gross_margin=97 / 150, discount_rate=5 / 150,
        refund_rate=10 / 150, ctr=0.1, cpc=0.75, cpm=75, onsite_roas=4, search_impression_share=0.0,
    )
    for name, value in want.items():
        assert row[name] == (pytest.approx(value) if isinstance(value, float) else value), name
    assert len(row) == 66
    assert len(kpi.hourly_table(metrics(spark, [hour]), include_local_time=False).columns) == 61


def test_ratios_over_zero_are_null_and_daily_share_too(spark):
    idle = dict(region="US", timestamp_utc=datetime(2024, 1, 1, 12))
    hourly = kpi.hourly_table(metrics(spark, [idle])).first()
    daily = kpi.daily_report(metrics(spark, [idle])).first()
    for name in ("new_customer_cpp", "blended_roas", "gross_margin", "ctr", "cpc", "cpm"):
        assert hourly[name] is None and daily[name] is None
    assert hourly["search_impression_share"] == 0.0 and daily["search_impression_share"] is None


def orders_fact(spark, rows):
    names = [f.split()[0] for f in schemas.ORDERS_FACT.split(", ")]
    zero = {c: 0.0 for c in names[4:]} | {"shop_timezone": None, "currency": None, "is_new_customer": False}
    return spark.createDataFrame([tuple({**zero, **r}[n] for n in names) for r in rows], schemas.ORDERS_FACT)


def ads_fact(spark, rows):
    names = [f.split()[0] for f in schemas.ADS_FACT.split(", ")]
    blank = {c: None for c in names} | {c: 0.0 for c in schemas.AD_SUMS}
    blank |= {c: "ACTIVE" for c in ("campaign_status", "adset_status", "ad_status")}
    return spark.createDataFrame([tuple({**blank, **r}[n] for n in names) for r in rows], schemas.ADS_FACT)


def random_orders(n=400, seed=3):
    rng = random.Random(seed)
    return [
        dict(
            created_at=datetime(2024, 3, rng.randint(9, 11), rng.randint(0, 4), rng.randint(0, 59), rng.randint(0, 59), rng.randint(0, 999999)),
            shipping_country_code=rng.choice(["US", "GB", "UK", "AU", "DE", None]),
            currency=rng.choice(["USD", "GBP", "EUR", None, ""]),
            order_revenue=round(rng.uniform(0, 500), 2),
            orders_quantity=float(rng.randint(0, 3)),
            is_new_customer=rng.choice([True, False, None]),
            refund_money=round(rng.uniform(0, 20), 2),
        )
        for _ in range(n)
    ]


def test_orders_hourly_brute_force(spark):
    rows = random_orders()
    low, high = datetime(2024, 3, 9, 1), datetime(2024, 3, 11, 2, 30, 0)
    want = defaultdict(lambda: [0.0, 0.0, 0.0, Counter()])
    for r in rows:
        if r["shipping_country_code"] not in kpi.COUNTRIES or not low <= r["created_at"].replace(microsecond=0) <= high:
            continue
        acc = want[r["created_at"].replace(minute=0, second=0, microsecond=0), r["shipping_country_code"]]
        acc[0] += r["order_revenue"]
        acc[1] += r["orders_quantity"] if r["is_new_customer"] else 0
        acc[2] += r["refund_money"]
        if r["currency"] is not None:
            acc[3][r["currency"]] += 1
    got = kpi.orders_hourly(orders_fact(spark, rows), low, high).collect()
    assert len(got) == len(want)
    for g in got:
        acc = want[g.order_hour, g.shipping_country_code]
        assert g.total_sales == pytest.approx(acc[0]) and g.new_customer_orders == acc[1]
        assert g.refund_money == pytest.approx(acc[2])
        assert g.currency == (min(acc[3], key=lambda c: (-acc[3][c], c)) if acc[3] else None)


def random_ads(n=500, seed=5):
    rng = random.Random(seed)
    return [
        dict(
            event_date=date(2024, 3, rng.randint(9, 11)),
            event_hour=rng.randint(0, 2),
            channel=rng.choice(["facebook-ads", "Google-Ads", "tiktok"]),
            account_id=rng.choice(["a", "b", None]),
            campaign_name=rng.choice(["x-AU", "x-UK", "plain", None]),
            adset_name="s",
            currency=rng.choice(["USD", "EUR"]),
            ad_status=rng.choice(["ACTIVE", "ACTIVE", "PAUSED"]),
            spend=round(rng.uniform(0, 50), 2),
            impressions=float(rng.randint(0, 100)),
            search_impression_share=rng.choice([None, 0.25, 0.5, 0.125]),
            ad_ai_recommendation=rng.choice([None, "", "up", "down", "hold"]),
        )
        for _ in range(n)
    ]


def ad_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        if r["ad_status"] == "ACTIVE" and r["channel"].lower() in kpi.CHANNELS:
            hour = datetime.combine(r["event_date"], datetime.min.time()).replace(hour=r["event_hour"])
            groups[hour, r["channel"].lower(), r["account_id"], r["campaign_name"], r["adset_name"]].append(r)
    return groups


def heavy(values):
    seen = Counter(v for v in values if v is not None)
    return min(seen, key=lambda v: (-seen[v], v)) if seen else None


def test_ads_hourly_brute_force(spark):
    rows = random_ads()
    groups = ad_groups(rows)
    got = kpi.ads_hourly(ads_fact(spark, rows)).collect()
    assert len(got) == len(groups)
    for g in got:
        members = groups[g.spend_hour, g.channel, g.account_id, g.campaign_name, g.adset_name]
        shares = [m["search_impression_share"] for m in members if m["search_impression_share"] is not None]
        assert g.spend == pytest.approx(sum(m["spend"] for m in members))
        assert g.search_impression_share == (pytest.approx(sum(shares) / len(shares)) if shares else None)
        assert g.ad_ai_recommendation == heavy(m["ad_ai_recommendation"] for m in members)
        assert g.currency == heavy(m["currency"] for m in members)


def test_metrics_merge_brute_force_and_row_order(spark):
    orders, ads = random_orders(), random_ads()

    def run(o, a):
        hourly = kpi.hourly_region_metrics(
            kpi.orders_hourly(orders_fact(spark, o)), kpi.ads_hourly(ads_fact(spark, a)), "UTC", {"b": "CA"}
        )
        direct = kpi.metrics_from_facts(orders_fact(spark, o), ads_fact(spark, a), "UTC", {"b": "CA"})
        key = lambda r: (r.region, r.timestamp_utc)
        assert sorted(direct.collect(), key=key) == sorted(hourly.collect(), key=key)
        return sorted(hourly.collect(), key=key)

    first = run(orders, ads)
    want = defaultdict(lambda: dict(total_sales=0.0, meta=0.0, google=0.0, impressions=0.0, weighted=0.0))
    for r in orders:
        region = {"US": "US", "GB": "UK", "UK": "UK", "AU": "AU"}.get(r["shipping_country_code"])
        if region:
            want[region, r["created_at"].replace(minute=0, second=0, microsecond=0)]["total_sales"] += r["order_revenue"]
    for (hour, channel, account, campaign, _), members in ad_groups(ads).items():
        region = "CA" if account == "b" else {"x-AU": "AU", "x-UK": "UK"}.get(campaign, "US")
        acc = want[region, hour]
        impressions = sum(m["impressions"] for m in members)
        shares = [m["search_impression_share"] for m in members if m["search_impression_share"] is not None]
        acc["meta" if channel == "facebook-ads" else "google"] += sum(m["spend"] for m in members)
        acc["impressions"] += impressions
        acc["weighted"] += (sum(shares) / len(shares) if shares else 0) * impressions
    assert len(first) == len(want)
    for r in first:
        acc = want[r.region, r.timestamp_utc]
        assert r.total_sales == pytest.approx(acc["total_sales"])
        assert (r.meta_spend, r.google_spend) == (pytest.approx(acc["meta"]), pytest.approx(acc["google"]))
        share = acc["weighted"] / acc["impressions"] if acc["impressions"] else 0.0
        assert r.search_impression_share == pytest.approx(share, abs=1e-6)
    rng = random.Random(1)
    rng.shuffle(orders)
    rng.shuffle(ads)
    assert run(orders, ads) == first


def test_dashboard_any_grouping(spark):
    (row,) = kpi.dashboard(metrics(spark, DAY), ["region"]).collect()
    assert len(row) == 23 and row.gross_margin == pytest.approx(2007 / 2900) and row.cpm == pytest.approx(200000 / 1400)


def test_shop_time_zone_default(spark):
    rows = [dict(created_at=datetime(2024, 1, 1), shipping_country_code="US", shop_timezone="")]
    assert kpi_refresh.detect_store_zone(orders_fact(spark, rows), datetime(2024, 1, 2)) == "UTC"
    rows += [dict(created_at=datetime(2024, 1, 1), shipping_country_code="US", shop_timezone=z) for z in ("A/B", "A/B", "Z/Z")]
    assert kpi_refresh.detect_store_zone(orders_fact(spark, rows), datetime(2024, 1, 2)) == "A/B"
    assert kpi_refresh.detect_store_zone(orders_fact(spark, rows), datetime(2024, 3, 2)) == "UTC"


def test_bounds_reach_the_scan(spark, folder):
    orders_fact(spark, random_orders(20)).write.parquet(folder + "/o")
    ads_fact(spark, random_ads(20)).write.parquet(folder + "/a")
    low, high = datetime(2024, 3, 9), datetime(2024, 3, 10)
    from cartlake.sources import readers

    plans = [
        kpi.orders_hourly(readers.read_orders_fact(spark, folder + "/o"), low, high),
        kpi.ads_hourly(readers.read_ads_fact(spark, folder + "/a"), low, high),
    ]
    explain = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    text = [explain(p._jdf.queryExecution(), "formatted") for p in plans]
    assert "GreaterThanOrEqual(created_at" in text[0] and "In(shipping_country_code" in text[0]
    assert "GreaterThanOrEqual(event_date" in text[1] and "EqualTo(ad_status,ACTIVE)" in text[1]


def test_collapse_metrics(spark):
    body = (
        '{"marketingPerformance":{"edges":['
        '{"node":{"countryCode":"GB","datetime":"2024-01-01T05:00:00+02:00","metrics":['
        '{"source":"facebook","spendUsd":5},{"source":"META","spendUsd":2},{"source":"Google","spendUsd":1},'
        '{"source":null,"newCustomerOrders":3,"newCustomerSalesUsd":9.5,"totalSalesUsd":20},'
        '{"source":"TOTAL","newCustomerOrders":8}]}},'
        '{"node":{"countryCode":"DE","datetime":"2024-01-01T00:00:00Z","metrics":[]}},'
        '{"node":{"countryCode":"US","metrics":[]}},'
        '{"node":{"countryCode":"US","datetime":"2024-01-01T00:00:00Z"}}]}}'
    )
    from cartlake.sources.readers import parse_legacy_performance

    rows = kpi.legacy_performance(parse_legacy_performance(spark.createDataFrame([(body,)], "b string"), "b"))
    got = {r.region: r for r in rows.collect()}
    assert set(got) == {"UK", "US"} and rows.columns == schemas.HOURLY_METRICS.names
    uk = got["UK"]
    assert (uk.meta_spend, uk.google_spend, uk.new_customer_orders, uk.total_sales) == (7.0, 1.0, 3, 20.0)
    assert uk.timestamp_utc == datetime(2024, 1, 1, 3) and got["US"].meta_spend == 0.0
    assert rows.agg(F.count("currency")).first()[0] == 2
