"""Hourly and daily growth metrics per region."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.functions import numeric as num
from cartlake.functions import regions, timeutil as tu

# --- fixed values: filters of the fact scans ---
COUNTRIES = ["US", "CA", "GB", "UK", "AU"]
CHANNELS = {"facebook-ads": "meta_spend", "google-ads": "google_spend"}
ACTIVE = "ACTIVE"
DEFAULT_CURRENCY = "USD"
META_SOURCES = ["META", "FACEBOOK"]
GOOGLE_SOURCES = ["GOOGLE", "GOOGLE_ADS"]
TOTAL_SOURCES = ["TOTAL", "ALL", ""]
# --- end of fixed values ---

AD_KEYS = ["spend_hour", "channel", "account_id", "campaign_name", "adset_name"]
AD_TEXTS = ["currency", *schemas.ADVISORY_TEXTS]


def _clock(value: datetime) -> Column:
    """Literal wall clock in the store's zone, to the second, without a zone."""
    return F.lit(value.replace(microsecond=0).isoformat(sep=" ")).cast(tu.NTZ)


def orders_hourly(orders: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Order facts by (store hour, country): exact sums and the most frequent currency (A1, A3).

    Bounds are store-local like the facts, inclusive to the second, and reach the scan. Sums are
    grouped by currency as well first: that makes the currency vote a second, tiny aggregate.
    """
    if start is not None:
        orders = orders.filter(F.col("created_at") >= _clock(start))
    if end is not None:
        orders = orders.filter(F.col("created_at") < _clock(end) + F.expr("interval 1 second"))
    value = {c: c for c in schemas.ORDER_METRICS[4:]} | {
        "total_sales": "order_revenue",
        "total_orders": "orders_quantity",
        "new_customer_sales": "if(is_new_customer, order_revenue, 0D)",
        "new_customer_orders": "if(is_new_customer, orders_quantity, 0D)",
    }
    by_currency = (
        orders.filter(F.col("shipping_country_code").isin(COUNTRIES))
        .withColumn("order_hour", tu.hour_of(F.col("created_at")))
        .groupBy("order_hour", "shipping_country_code", "currency")
        .agg(
            F.expr("count(1) AS votes"),
            *[F.expr(f"sum({num.term(value[c])}) AS {c}") for c in schemas.ORDER_METRICS],
        )
    )
    return by_currency.groupBy("order_hour", "shipping_country_code").agg(
        F.expr("min_by(currency, if(currency IS NULL, NULL, struct(-votes, currency))) AS currency"),
        *[F.expr(f"cast(sum({c}) AS double) AS {c}") for c in schemas.ORDER_METRICS],
    )


def _active_ads(ads: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Active rows of the two channels within the bounds."""
    hour = tu.date_and_hour(F.col("event_date"), F.col("event_hour"))
    if start is not None:
        ads = ads.filter((F.col("event_date") >= F.date_sub(F.to_date(_clock(start)), 1)) & (hour >= _clock(start)))
    if end is not None:
        ads = ads.filter((F.col("event_date") <= F.to_date(_clock(end))) & (hour <= _clock(end)))
    for c in ("campaign_status", "adset_status", "ad_status"):
        ads = ads.filter(F.col(c) == ACTIVE)
    channel = F.lower("channel")
    return ads.filter(channel.isin(list(CHANNELS))).withColumn(
        "_key", F.struct(hour.alias("spend_hour"), channel.alias("channel"), *AD_KEYS[2:])
    )


def _ad_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_key").agg(
        *[F.expr(f"{num.exact_total(c)} AS {c}") for c in schemas.AD_SUMS],
        *[F.expr(f"try_divide({num.exact_total(c)}, count({c})) AS {c}") for c in schemas.SEARCH_SHARES],
    )


def _ad_texts(rows: DataFrame) -> DataFrame:
    pairs = ", ".join(f"struct('{c}' AS field, {c} AS value)" for c in AD_TEXTS)
    counted = (
        rows.select("_key", F.expr(f"inline(filter(array({pairs}), r -> r.value IS NOT NULL))"))
        .groupBy("_key", "field", "value")
        .agg(F.expr("count(1) AS votes"))
    )
    return counted.groupBy("_key").agg(
        *[F.expr(f"min_by(value, if(field = '{c}', struct(-votes, value), NULL)) AS {c}") for c in AD_TEXTS]
    )


def ads_hourly_sums(ads: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Sums and means per (hour, channel, account, campaign, ad set), without the texts."""
    return _ad_sums(_active_ads(ads, start, end)).select("_key.*", *schemas.AD_SUMS, *schemas.SEARCH_SHARES)


def ads_hourly_texts(ads: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Most frequent currency and advisory texts of the same groups (A4)."""
    return _ad_texts(_active_ads(ads, start, end)).select("_key.*", *AD_TEXTS)


def ads_hourly(ads: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Ad facts by (hour, channel, account, campaign, ad set): sums, means, frequent texts (A2, A4, A5).

    Two branches, one over the numbers and one over the texts; each scan reads its own columns.
    Texts are counted per (group, field, value) before the winner is picked, so the distinct texts
    of a group are never in one task's memory. Both branches end partitioned by the group, kept as
    one struct: they join in place, and a null in a key matches a null.
    """
    rows = _active_ads(ads, start, end)
    both = _ad_sums(rows).join(_ad_texts(rows), "_key", "left")
    return both.select("_key.*", *schemas.AD_SUMS, *schemas.SEARCH_SHARES, *AD_TEXTS)


def hourly_region_metrics(
    order_hours: DataFrame,
    ad_hours: DataFrame,
    store_zone: str,
    account_regions: dict[str, str] | DataFrame | None = None,
    ad_texts: DataFrame | None = None,
) -> DataFrame:
    """Both fact sides on (region, UTC hour), a key on either side makes a row.

    Orders and ads are united and aggregated once, where a full outer join would shuffle each.
    Numbers go through a hash aggregate. Currency and texts need sorted aggregation, so they take
    a narrow branch of their own and meet the sums when both are down to one row per hour.
    ``ad_texts`` may give the texts apart from ``ad_hours``.
    """
    orders = (
        order_hours.withColumn("region", regions.region_of_country(F.col("shipping_country_code")))
        .filter(F.col("region").isNotNull())
        .withColumn("timestamp_utc", tu.store_to_utc(F.col("order_hour"), store_zone))
    )
    placed = lambda df: regions.with_ad_region(df, account_regions).withColumn(
        "timestamp_utc", tu.store_to_utc(F.col("spend_hour"), store_zone)
    )
    key = ["region", "timestamp_utc"]
    ad_numbers = placed(ad_hours).select(
        *key,
        *[F.expr(f"if(channel = '{ch}', spend, 0D) AS {c}") for ch, c in CHANNELS.items()],
        *schemas.AD_COUNTS,
        *schemas.SEARCH_IMPRESSIONS,
        *[F.expr(f"coalesce({c}, 0D) * impressions AS {c}") for c in schemas.SEARCH_SHARES],
    )
    sums = (
        orders.select(*key, *schemas.ORDER_METRICS)
        .unionByName(ad_numbers, allowMissingColumns=True)
        .groupBy(*key)
        .agg(
            *[F.expr(f"{num.exact_total(c)} AS {c}") for c in schemas.HOURLY_SUMS],
            *[F.expr(f"{num.exact_total(c)} AS {c}") for c in schemas.SEARCH_SHARES],
        )
    )
    currency = orders.filter("currency <> ''").select(*key, "currency", F.col("shipping_country_code").alias("country"))
    advice = placed(ad_hours if ad_texts is None else ad_texts).select(
        *key,
        F.struct(*AD_KEYS[1:]).alias("text_rank"),
        *[F.expr(f"nullif({c}, '') AS {c}") for c in schemas.ADVISORY_TEXTS],
    )
    texts = (
        currency.unionByName(advice, allowMissingColumns=True)
        .groupBy(*key)
        .agg(
            F.expr("max_by(currency, country) AS currency"),
            *[F.expr(f"min_by({c}, if({c} IS NULL, NULL, text_rank)) AS {c}") for c in schemas.ADVISORY_TEXTS],
        )
    )
    shown = {c: f"if(impressions > 0, {c} / impressions, 0D) AS {c}" for c in schemas.SEARCH_SHARES}
    shown |= {c: f"coalesce({c}, '') AS {c}" for c in schemas.ADVISORY_TEXTS}
    shown["currency"] = f"coalesce(currency, '{DEFAULT_CURRENCY}') AS currency"
    shown["new_customer_orders"] = "cast(bround(new_customer_orders) AS bigint) AS new_customer_orders"
    return sums.join(texts, key, "left").selectExpr(*[shown.get(c, c) for c in schemas.HOURLY_METRICS.names])


def metrics_from_facts(
    orders: DataFrame,
    ads: DataFrame,
    store_zone: str,
    account_regions: dict[str, str] | DataFrame | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Hourly metrics straight from the facts; sums and texts of the ads never have to be joined."""
    return hourly_region_metrics(
        orders_hourly(orders, start, end),
        ads_hourly_sums(ads, start, end),
        store_zone,
        account_regions,
        ads_hourly_texts(ads, start, end),
    )


_SPEND = "(meta_spend + google_spend)"
_PROFIT = "(total_sales - cost_of_goods - shipping_costs - payment_gateway_costs - handling_fees)"
# Report columns that follow from the sums (F1-F5); a ratio over 0 or NULL is NULL.
DERIVED = {
    "total_spend": _SPEND,
    "new_customer_cpp": f"try_divide({_SPEND}, new_customer_orders)",
    "new_customer_aov": "try_divide(new_customer_sales, new_customer_orders)",
    "new_customer_roas": f"try_divide(new_customer_sales, {_SPEND})",
    "blended_roas": f"try_divide(total_sales, {_SPEND})",
    "returning_orders": "greatest(total_orders - new_customer_orders, 0D)",
    "returning_sales": "total_sales - new_customer_sales",
    "net_sales": "total_sales - refund_money",
    "gross_profit": _PROFIT,
    "gross_margin": f"try_divide({_PROFIT}, total_sales)",
    "discount_rate": "try_divide(discount_amount, total_sales)",
    "refund_rate": "try_divide(refund_money, total_sales)",
    "ctr": "try_divide(clicks, impressions)",
    "cpc": f"try_divide({_SPEND}, clicks)",
    "cpm": f"try_divide({_SPEND} * 1000, impressions)",
    "onsite_roas": f"try_divide(onsite_conversion_value, {_SPEND})",
}


def with_local_time(metrics: DataFrame) -> DataFrame:
    """Region and central wall clocks of the hour."""
    local = tu.utc_to_region(F.col("timestamp_utc"), F.col("region"))
    central = F.convert_timezone(F.lit("UTC"), F.lit(tu.CENTRAL_ZONE), F.col("timestamp_utc"))
    return metrics.withColumns({"local_datetime": local, "central_datetime": central}).withColumns(
        {
            "local_date": F.to_date("local_datetime"),
            "local_hour": tu.hour_text(F.col("local_datetime")),
            "central_hour": tu.hour_text(F.col("central_datetime")),
        }
    )


def hourly_table(metrics: DataFrame, include_local_time: bool = True) -> DataFrame:
    """Hourly metrics with the derived columns; row-wise, no shuffle."""
    out = metrics.selectExpr("*", *[f"{e} AS {n}" for n, e in DERIVED.items()])
    if not include_local_time:
        return out
    return with_local_time(out).select(*schemas.HOURLY_TABLE.names)


def daily_report(metrics: DataFrame) -> DataFrame:
    """Hourly metrics rolled up by (region, local date)."""
    local = metrics.withColumn("local_date", F.to_date(tu.utc_to_region(F.col("timestamp_utc"), F.col("region"))))
    first = ["currency", *schemas.ADVISORY_TEXTS]
    rolled = local.groupBy("region", "local_date").agg(
        *[F.expr(f"{num.exact_total(c)} AS {c}") for c in schemas.HOURLY_SUMS],
        *[
            F.expr(f"{num.exact_total(f'{c} * coalesce(impressions, 0D)')} AS {c}")
            for c in schemas.SEARCH_SHARES
        ],
        *[F.expr(f"min_by({c}, if({c} IS NULL, NULL, timestamp_utc)) AS {c}") for c in first],
    )
    expr = DERIVED | {c: f"try_divide({c}, impressions)" for c in schemas.SEARCH_SHARES}
    expr["new_customer_orders"] = "cast(new_customer_orders AS bigint)"
    return rolled.selectExpr(*[f"{expr[c]} AS {c}" if c in expr else c for c in schemas.DAILY_COLUMNS])


def between_local_dates(df: DataFrame, start, end) -> DataFrame:
    """Requested local dates, inclusive."""
    return df.filter(F.col("local_date").between(F.lit(start), F.lit(end)))


# --- fixed values: digits of each report column ---
DIGITS = {
    **{c: 3 for c in ("gross_margin", "discount_rate", "refund_rate", "onsite_roas", "new_customer_roas", "blended_roas")},
    **{c: 4 for c in ("ctr", "cpc", "cpm", *schemas.SEARCH_SHARES)},
}
DEFAULT_DIGITS = 2
# --- end of fixed values ---


def rounded_report(daily: DataFrame) -> DataFrame:
    """Report rounding."""
    out = []
    for f in daily.schema.fields:
        col = F.col(f.name)
        if f.dataType.typeName() == "double":
            col = num.round_exact(col, DIGITS.get(f.name, DEFAULT_DIGITS)).alias(f.name)
        elif f.name == "local_date":
            col = F.date_format(col, "yyyy-MM-dd").alias(f.name)
        out.append(col)
    return daily.select(*out)


# --- fixed values: dashboard metrics over sums of the hourly table ---
DASHBOARD = {
    "new_customer_orders": "new_customer_orders",
    "total_orders": "total_orders",
    "returning_orders": "total_orders - new_customer_orders",
    "new_customer_sales": "new_customer_sales",
    "total_sales": "total_sales",
    "net_sales": "total_sales - refund_money",
    "gross_profit": _PROFIT,
    "gross_margin": f"try_divide({_PROFIT}, total_sales)",
    "total_spend": _SPEND,
    "new_customer_aov": "try_divide(new_customer_sales, new_customer_orders)",
    "new_customer_cpp": f"try_divide({_SPEND}, new_customer_orders)",
    "new_customer_roas": f"try_divide(new_customer_sales, {_SPEND})",
    "blended_roas": f"try_divide(total_sales, {_SPEND})",
    "discount_rate": "try_divide(discount_amount, total_sales)",
    "refund_rate": "try_divide(refund_money, total_sales)",
    "ctr": "try_divide(clicks, impressions)",
    "cpc": f"try_divide({_SPEND}, clicks)",
    "cpm": f"try_divide({_SPEND} * 1000, impressions)",
    "onsite_roas": f"try_divide(onsite_conversion_value, {_SPEND})",
    "meta_purchases": "meta_purchases",
    "onsite_purchases": "onsite_purchases",
    "non_tracked_spend": "non_tracked_spend",
}
# --- end of fixed values ---


def dashboard(hourly: DataFrame, by: list[str], names: list[str] | None = None) -> DataFrame:
    """Dashboard metrics over any grouping of the hourly table."""
    sums = hourly.groupBy(*by).agg(
        *[F.expr(f"{num.exact_total(c)} AS {c}") for c in schemas.HOURLY_SUMS if c in hourly.columns]
    )
    return sums.selectExpr(*by, *[f"{DASHBOARD[n]} AS {n}" for n in (names or DASHBOARD)])


def shop_time_zone(orders: DataFrame, as_of: datetime, days: int = 30, default: str = "UTC") -> DataFrame:
    """Zone most orders of the last ``days`` name, one row, the default when none does (O3)."""
    recent = orders.filter(
        (F.col("created_at") >= _clock(as_of) - F.make_dt_interval(F.lit(days)))
        & (F.col("created_at") <= _clock(as_of))
        & (F.col("shop_timezone") != "")
    )
    votes = recent.groupBy("shop_timezone").agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by("shop_timezone", F.struct((-F.col("_n")).alias("n"), F.col("shop_timezone")))
    return votes.agg(F.coalesce(best, F.lit(default)).alias("shop_timezone"))


def collapse_metrics(metrics: Column) -> dict[str, Column]:
    """Per-source metrics of one payload collapsed to totals."""
    source = lambda m: F.upper(F.coalesce(m["source"], F.lit("")))

    def spend_of(names: list[str]) -> Column:
        own = F.filter(metrics, lambda m: source(m).isin(names))
        add = lambda acc, m: acc + F.coalesce(m["spendUsd"], F.lit(0.0))
        return F.coalesce(F.aggregate(own, F.lit(0.0), add), F.lit(0.0))

    total = F.get(F.filter(metrics, lambda m: source(m).isin(TOTAL_SOURCES)), F.lit(0))
    return {
        "meta_spend": spend_of(META_SOURCES),
        "google_spend": spend_of(GOOGLE_SOURCES),
        "new_customer_orders": F.coalesce(total["newCustomerOrders"], F.lit(0).cast("bigint")),
        "new_customer_sales": F.coalesce(total["newCustomerSalesUsd"], F.lit(0.0)),
        "total_sales": F.coalesce(total["totalSalesUsd"], F.lit(0.0)),
    }


def legacy_performance(payloads: DataFrame) -> DataFrame:
    """Legacy nested payloads to hourly metrics; other metrics take their defaults.

    Rows of unmapped countries and rows without a time are left out.
    """
    nodes = payloads.select(F.explode("marketingPerformance.edges").alias("e")).select("e.node.*")
    region = regions.region_of_country_legacy(F.col("countryCode"))
    kept = nodes.withColumn("region", region).filter(
        F.col("region").isNotNull() & F.col("datetime").isNotNull() & (F.col("datetime") != "")
    )
    values = collapse_metrics(F.col("metrics"))
    known = kept.select(
        "region",
        tu.utc_clock(F.col("datetime")).alias("timestamp_utc"),
        *[v.alias(k) for k, v in values.items()],
    )
    blank = {"currency": F.lit(DEFAULT_CURRENCY)} | {c: F.lit("") for c in schemas.ADVISORY_TEXTS}
    return known.select(
        *[
            F.col(n) if n in known.columns else blank.get(n, F.lit(0.0)).alias(n)
            for n in schemas.HOURLY_METRICS.names
        ]
    )
