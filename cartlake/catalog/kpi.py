"""Growth metric queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.catalog import facts
from cartlake.catalog.registry import ORACLES, plain, props_k, query, stamp, table
from cartlake.functions import regions
from cartlake.functions.timeutil import fetch_window_columns
from cartlake.operators import kpi
from cartlake.operators.ranking import most_frequent
from cartlake.plans import kpi_refresh
from cartlake.session import shared_dir
from cartlake.sources import readers
from cartlake.sources.readers import parse_legacy_performance


def shown(df):
    """Shares to 6 digits, clocks as text."""
    six = {c: f"floor({c} * 1e6D + 0.5D) / 1e6D AS {c}" for c in schemas.SEARCH_SHARES}
    return plain(df.selectExpr(*[six.get(c, f"`{c}`") for c in df.columns]))


@query(
    "kpi_daily_region",
    f"WITH {facts.METRICS_SQL},\n{facts.daily_sql()}\nSELECT {facts.shown_sql(schemas.DAILY_COLUMNS)} FROM daily",
)
def daily_region(spark, sf):
    """Daily report per region (flagship)."""
    return shown(kpi.daily_report(facts.metrics(spark, sf)))


@query(
    "kpi_hourly_region",
    f"WITH {facts.METRICS_SQL},\n{facts.hourly_sql()}\n"
    f"SELECT {facts.shown_sql(schemas.HOURLY_TABLE.names, facts.HOURLY_SHOWN)} FROM hourly",
)
def hourly_region(spark, sf):
    return shown(kpi.hourly_table(facts.metrics(spark, sf)))


@query(
    "kpi_orders_hourly",
    f"""WITH {facts.EVENTS_SQL},\n{facts.ORDERS_FACT_SQL},\n{facts.orders_hourly_sql()}
SELECT strftime(order_hour, '%Y-%m-%d %H:%M:%S') AS order_hour, shipping_country_code, currency,
  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.ORDER_METRICS)}
FROM orders_hourly""",
)
def orders_hourly(spark, sf):
    return plain(kpi.orders_hourly(facts.orders_fact(spark, sf)))


@query("kpi_orders_text_facts", ORACLES["kpi_orders_hourly"])
def orders_text_facts(spark, sf):
    """The same from a fact table that holds text: numbers are read out of it, what is no number is 0."""
    path = shared_dir(spark, "text-facts")
    facts_of = facts.orders_fact(spark, sf)
    text = lambda f: (  # noqa: E731  zeros are written in the ways that stand for one
        F.when(F.col(f.name) == 0, F.element_at(F.array(F.lit("n/a"), F.lit(" "), F.lit("0")), F.second("created_at") % 3 + 1))
        .otherwise(F.col(f.name).cast("string"))
        .alias(f.name)
        if f.dataType.typeName() == "double"
        else F.col(f.name).cast("string")
    )
    facts_of.select(*[text(f) for f in facts_of.schema.fields]).write.parquet(path)
    read = readers.typed_fact(spark.read.parquet(path), schemas.ORDERS_FACT)
    return plain(kpi.orders_hourly(read))


@query(
    "kpi_ads_hourly",
    f"""WITH {facts.EVENTS_SQL},\n{facts.ADS_FACT_SQL},\n{facts.ads_hourly_sql()}
SELECT strftime(spend_hour, '%Y-%m-%d %H:%M:%S') AS spend_hour, channel, account_id, campaign_name, adset_name,
  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.AD_SUMS)},
  {", ".join(f"{facts.six_digits(c)} AS {c}" for c in schemas.SEARCH_SHARES)},
  currency, {", ".join(schemas.ADVISORY_TEXTS)}
FROM ads_hourly""",
)
def ads_hourly(spark, sf):
    return shown(kpi.ads_hourly(facts.ads_fact(spark, sf)))


@query(
    "kpi_weighted_share_hourly",
    f"""WITH {facts.METRICS_SQL}
SELECT region, strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S') AS timestamp_utc, impressions,
  {", ".join(f"{facts.six_digits(c)} AS {c}" for c in schemas.SEARCH_SHARES)}
FROM metrics""",
)
def weighted_share_hourly(spark, sf):
    """Hourly shares: 0 without impressions."""
    return shown(facts.metrics(spark, sf).select("region", "timestamp_utc", "impressions", *schemas.SEARCH_SHARES))


@query(
    "kpi_weighted_share_daily",
    f"""WITH {facts.METRICS_SQL}, {facts.daily_sql()}
SELECT region, strftime(local_date, '%Y-%m-%d') AS local_date, impressions,
  {", ".join(f"{facts.six_digits(c)} AS {c}" for c in schemas.SEARCH_SHARES)}
FROM daily""",
)
def weighted_share_daily(spark, sf):
    """Daily shares: NULL without impressions."""
    daily = kpi.daily_report(facts.metrics(spark, sf))
    return shown(daily.select("region", "local_date", "impressions", *schemas.SEARCH_SHARES))


RANGE = (date(2024, 1, 10), date(2024, 1, 12))
_LOW, _HIGH = kpi_refresh.store_bounds(*RANGE, facts.STORE_ZONE)


@query(
    "kpi_requested_range",
    f"""WITH {facts.metrics_sql_between(str(_LOW), str(_HIGH))},\n{facts.daily_sql()}
SELECT {facts.shown_sql(schemas.DAILY_COLUMNS)} FROM daily
WHERE local_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""",
)
def requested_range(spark, sf):
    """Report of a range of local dates, read from the facts that range can need."""
    return shown(
        kpi_refresh.daily_between(
            facts.orders_fact(spark, sf), facts.ads_fact(spark, sf), *RANGE, facts.STORE_ZONE, facts.ACCOUNTS
        )
    )


def _rounded_sql() -> str:
    out = []
    for c in schemas.DAILY_COLUMNS:
        if c == "local_date":
            out.append("strftime(local_date, '%Y-%m-%d') AS local_date")
        elif c in ("region", "currency", "new_customer_orders", *schemas.ADVISORY_TEXTS):
            out.append(c)
        else:
            out.append(f"CAST(printf('%.{kpi.DIGITS.get(c, kpi.DEFAULT_DIGITS)}f', {c}) AS DOUBLE) AS {c}")
    return ", ".join(out)


@query(
    "kpi_report_rounded",
    f"WITH {facts.METRICS_SQL},\n{facts.daily_sql()}\nSELECT {_rounded_sql()} FROM daily",
)
def report_rounded(spark, sf):
    return kpi.rounded_report(kpi.daily_report(facts.metrics(spark, sf)))


_PROFIT = "total_sales - cost_of_goods - shipping_costs - payment_gateway_costs - handling_fees"
_SP = "(meta_spend + google_spend)"
_DASH = f"""new_customer_orders, total_orders, total_orders - new_customer_orders AS returning_orders,
  new_customer_sales, total_sales, total_sales - refund_money AS net_sales, {_PROFIT} AS gross_profit,
  ({_PROFIT}) / nullif(total_sales, 0) AS gross_margin, {_SP} AS total_spend,
  new_customer_sales / nullif(new_customer_orders, 0) AS new_customer_aov,
  {_SP} / nullif(new_customer_orders, 0) AS new_customer_cpp,
  new_customer_sales / nullif({_SP}, 0) AS new_customer_roas, total_sales / nullif({_SP}, 0) AS blended_roas,
  discount_amount / nullif(total_sales, 0) AS discount_rate, refund_money / nullif(total_sales, 0) AS refund_rate,
  clicks / nullif(impressions, 0) AS ctr, {_SP} / nullif(clicks, 0) AS cpc,
  {_SP} * 1000 / nullif(impressions, 0) AS cpm, onsite_conversion_value / nullif({_SP}, 0) AS onsite_roas,
  meta_purchases, onsite_purchases, non_tracked_spend"""


def _dash_sql(by: str) -> str:
    sums = ", ".join(f"CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) AS {c}" for c in schemas.HOURLY_SUMS)
    return f"""WITH {facts.METRICS_SQL},
sums AS (SELECT {by}, {sums} FROM metrics GROUP BY 1)
SELECT {by.split(" AS ")[-1]}, {_DASH} FROM sums"""


@query("kpi_any_grouping", _dash_sql("region"))
def any_grouping(spark, sf):
    return kpi.dashboard(facts.metrics(spark, sf), ["region"])


@query("kpi_any_grouping_hour", _dash_sql("CAST(hour(timestamp_utc) AS BIGINT) AS hour_of_day"))
def any_grouping_hour(spark, sf):
    hourly = facts.metrics(spark, sf).withColumn("hour_of_day", F.hour("timestamp_utc").cast("bigint"))
    return kpi.dashboard(hourly, ["hour_of_day"])


@query(
    "kpi_heavy_value",
    """SELECT user_id, event_type FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
  FROM events GROUP BY 1, 2) WHERE rn = 1""",
)
def heavy_value(spark, sf):
    """Most frequent event type per user, ties to the smallest name."""
    return most_frequent(table(spark, sf, "events"), ["user_id"], "event_type")


@query(
    "kpi_first_text",
    """SELECT user_id,
  coalesce(arg_min(props, {'t': ts, 'i': event_id}) FILTER (WHERE value > 20), '') AS first_text,
  coalesce(arg_max(event_type, {'t': ts, 'i': event_id}) FILTER (WHERE event_type <> 'view'), 'USD') AS last_value
FROM events GROUP BY 1""",
)
def first_text(spark, sf):
    """First non-empty text and last non-empty value in an explicit order."""
    order = F.struct("ts", "event_id")
    text = F.when(F.col("value") > 20, F.col("props"))
    last = F.when(F.col("event_type") != "view", F.col("event_type"))
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.coalesce(F.min_by("props", F.when(text.isNotNull(), order)), F.lit("")).alias("first_text"),
        F.coalesce(F.max_by("event_type", F.when(last.isNotNull(), order)), F.lit("USD")).alias("last_value"),
    )


AS_OF = datetime(2024, 1, 31)


@query(
    "shop_time_zone",
    f"""WITH {facts.EVENTS_SQL},\n{facts.ORDERS_FACT_SQL}
SELECT coalesce(max(shop_timezone), 'UTC') AS shop_timezone FROM (
  SELECT shop_timezone FROM orders_fact
  WHERE shop_timezone <> '' AND created_at >= TIMESTAMP '2024-01-01' AND created_at <= TIMESTAMP '2024-01-31'
  GROUP BY 1 ORDER BY count(*) DESC, shop_timezone LIMIT 1)""",
)
def shop_time_zone(spark, sf):
    return kpi.shop_time_zone(facts.orders_fact(spark, sf), AS_OF)


def _performance_payloads(spark, sf):
    """Each event as one legacy payload: two nodes, one of them possibly unusable."""
    e = table(spark, sf, "events").withColumn("k", props_k())
    k = F.col("k")
    country = F.element_at(F.array(*[F.lit(c) for c in ("US", "CA", "GB", "AU", "UK", "us")]), (k % 6 + 1).cast("int"))
    source = F.element_at(
        F.array(*[F.lit(c) for c in ("Meta", "FACEBOOK", "google", "GOOGLE_ADS", "tiktok")]), (k % 5 + 1).cast("int")
    )
    metric = lambda s, spend, n, sales, total: F.struct(
        s.alias("source"),
        spend.alias("spendUsd"),
        n.cast("bigint").alias("newCustomerOrders"),
        sales.alias("newCustomerSalesUsd"),
        total.alias("totalSalesUsd"),
    )
    none = F.lit(None).cast("double")
    v = F.col("value")
    metrics = F.array(
        metric(source, v, F.lit(9), v, v),
        metric(F.lit("meta"), F.when(k % 4 == 0, none).otherwise(v * 2), F.lit(9), v, v),
        metric(F.when(k % 3 == 0, "total").when(k % 3 == 1, "ALL"), none, k, v, v * 4),
        metric(F.lit("TOTAL"), none, F.lit(1), v, v),
    )
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    node = lambda c, t: F.struct(
        F.struct(c.alias("countryCode"), t.alias("datetime"), metrics.alias("metrics")).alias("node")
    )
    edges = F.array(node(country, when), node(F.lit("US"), F.when(k % 2 == 0, when)))
    payload = F.to_json(F.struct(F.struct(edges.alias("edges")).alias("marketingPerformance")))
    return e.select(payload.alias("body"))


@query(
    "metrics_collapse",
    """WITH e AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events),
nodes AS (
  SELECT *, CASE k % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'UK' WHEN 3 THEN 'AU' END AS region FROM e
  UNION ALL SELECT *, 'US' FROM e WHERE k % 2 = 0)
SELECT region, strftime(ts, '%Y-%m-%d') AS day, count(*) AS node_count,
  CAST(sum(CAST(CASE WHEN k % 5 IN (0, 1) THEN value ELSE 0 END
    + CASE WHEN k % 4 = 0 THEN 0 ELSE value * 2 END AS DECIMAL(38,12))) AS DOUBLE) AS meta_spend,
  CAST(sum(CAST(CASE WHEN k % 5 IN (2, 3) THEN value ELSE 0 END AS DECIMAL(38,12))) AS DOUBLE) AS google_spend,
  CAST(sum(k) AS BIGINT) AS new_customer_orders,
  CAST(sum(CAST(value AS DECIMAL(38,12))) AS DOUBLE) AS new_customer_sales,
  CAST(sum(CAST(value * 4 AS DECIMAL(38,12))) AS DOUBLE) AS total_sales
FROM nodes WHERE region IS NOT NULL GROUP BY 1, 2""",
)
def metrics_collapse(spark, sf):
    """Legacy payloads parsed, exploded and collapsed, then added up per region and day."""
    rows = kpi.legacy_performance(parse_legacy_performance(_performance_payloads(spark, sf), "body"))
    total = lambda c: F.sum(F.col(c).cast("decimal(18,6)")).cast("double").alias(c)
    return rows.groupBy("region", F.date_format("timestamp_utc", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("node_count"),
        total("meta_spend"),
        total("google_spend"),
        F.sum("new_customer_orders").alias("new_customer_orders"),
        total("new_customer_sales"),
        total("total_sales"),
    )


PART_KEYWORDS = {"AU": ["RED"], "UK": ["BLUE", "BOLT"], "CA": ["GEAR", "25"], "US": ["WIDGET"]}
PART_ACCOUNTS = {"7": "UK", "11": "AU", "13": ""}


@query(
    "ads_region_inference",
    r"""WITH t AS (
  SELECT p_partkey, list_distinct(list_filter(
    string_split_regex(upper(p_name || ' ' || p_brand), '[^A-Z0-9]+'), lambda x: x <> '')) AS tokens FROM part)
SELECT p_partkey, CAST(len(tokens) AS BIGINT) AS token_count,
  CASE WHEN p_partkey = 7 THEN 'UK' WHEN p_partkey = 11 THEN 'AU'
    WHEN list_has_any(tokens, ['RED']) THEN 'AU'
    WHEN list_has_any(tokens, ['BLUE', 'BOLT']) THEN 'UK'
    WHEN list_has_any(tokens, ['GEAR', '25']) THEN 'CA'
    ELSE 'US' END AS region
FROM t""",
)
def ads_region_inference(spark, sf):
    """Region by account, else by keyword priority, else the default."""
    ads = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("account_id"),
        F.col("p_name").alias("campaign_name"),
        F.col("p_brand").alias("adset_name"),
    )
    tokens = regions.ad_tokens(F.col("campaign_name"), F.col("adset_name"))
    return (
        regions.with_ad_region(ads, PART_ACCOUNTS, PART_KEYWORDS)
        .withColumn("token_count", F.size(tokens).cast("bigint"))
        .select("p_partkey", "token_count", "region")
    )


@query(
    "expand_window",
    """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
zones AS (SELECT unnest(['America/Chicago', 'America/Regina', 'Europe/London', 'Australia/Sydney']) AS z),
ranges AS (SELECT d, CAST(d AS TIMESTAMP) AS s, CAST(d + 2 AS TIMESTAMP) + INTERVAL 86399 SECOND AS e FROM days),
edges AS (
  SELECT d, timezone('UTC', timezone('America/Chicago', s)) AS lo, timezone('UTC', timezone('America/Chicago', e)) AS hi
  FROM ranges
  UNION ALL
  SELECT d, timezone('UTC', timezone(z, CAST(CAST(s AS DATE) AS TIMESTAMP))),
    timezone('UTC', timezone(z, CAST(CAST(e AS DATE) + 1 AS TIMESTAMP))) - INTERVAL 1 SECOND
  FROM ranges, zones
  UNION ALL
  SELECT d, timezone('UTC', timezone(z, CAST(CAST(timezone(z, timezone('America/Chicago', s)) AS DATE) AS TIMESTAMP))),
    timezone('UTC', timezone(z, CAST(CAST(timezone(z, timezone('America/Chicago', e)) AS DATE) + 1 AS TIMESTAMP)))
      - INTERVAL 1 SECOND
  FROM ranges, zones)
SELECT strftime(d, '%Y-%m-%d') AS day, strftime(min(lo), '%Y-%m-%d %H:%M:%S') AS fetch_start,
  strftime(max(hi), '%Y-%m-%d %H:%M:%S') AS fetch_end
FROM edges GROUP BY d""",
)
def expand_window(spark, sf):
    """Fact bounds of a three-day store-local range starting on each day with events."""
    days = table(spark, sf, "events").select(F.to_date("ts").alias("d")).distinct()
    start = F.col("d").cast("timestamp_ntz")
    end = F.date_add("d", 2).cast("timestamp_ntz") + F.expr("interval 86399 seconds")
    low, high = fetch_window_columns(start, end, facts.STORE_ZONE)
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("day"),
        stamp(low).alias("fetch_start"),
        stamp(high).alias("fetch_end"),
    )
