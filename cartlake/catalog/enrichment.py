"""Payload projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlake.catalog.events import ISO
from cartlake.catalog.registry import plain, props_k, query, table
from cartlake.operators import enrich, envelope
from cartlake.operators.state import as_of_literal

AS_OF = "2024-01-31 00:00:00"
SKUS = ["promo", ""]
RHYTHMS = {"monthly": ["economy"], "quarterly": ["standard", "large"]}
# --- fixed values: part types of the driver's data; any other type counts as OTHER ---
PART_TYPES = ["STANDARD", "SMALL", "ECONOMY", "PROMO", "MEDIUM", "LARGE"]
# --- end of fixed values ---


def order_items(spark, sf):
    """Units per order and kind of part: at most one row per kind, so the item list is bounded."""
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_partkey")
        .agg(F.expr("sum(cast(l_quantity AS bigint)) AS quantity"))
    )
    parts = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_type").isin(PART_TYPES), F.col("p_type")).otherwise("OTHER").alias("sku")
    )
    kinds = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "sku")
        .agg(F.sum("quantity").alias("quantity"))
    )
    item = F.struct((-F.col("quantity")).alias("r"), F.col("sku"), F.col("quantity"))
    ranked = F.sort_array(F.collect_list(item))
    return kinds.groupBy("l_orderkey").agg(
        F.transform(ranked, lambda i: F.struct(i["sku"].alias("sku"), i["quantity"].alias("quantity"))).alias("items")
    )


def order_payloads(spark, sf):
    """Orders as landed envelopes with a nested JSON payload; orders without items keep an empty list."""
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    o = (
        table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(order_items(spark, sf), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    key = F.col("o_orderkey")
    when = F.date_format("o_orderdate", ISO)
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    customer = F.struct(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("first_name"),
        F.when(key % 2 == 0, "").otherwise(F.lit(None)).alias("phone"),
        F.col("c_mktsegment").alias("tags"),
    )
    address = F.struct(
        F.col("n_name").alias("province"),
        F.col("r_name").alias("country"),
        F.concat(F.lit("+1-"), F.col("o_custkey").cast("string")).alias("phone"),
    )
    payload = F.struct(
        key.alias("id"),
        (key + 1000).alias("order_number"),
        F.when(key % 13 != 0, when).alias("created_at"),
        when.alias("updated_at"),
        price.alias("total_price"),
        F.when(key % 5 == 0, "").when(key % 5 == 1, F.lit(None)).otherwise(price).alias("subtotal_price"),
        F.struct(F.struct(F.lit("4.50").alias("amount")).alias("shop_money")).alias("total_shipping_price_set"),
        F.when(key % 3 != 0, "CAD").alias("currency"),
        F.col("o_orderstatus").alias("financial_status"),
        F.when(key % 10 == 0, F.lit(True)).alias("test"),
        F.when(key % 7 == 0, "Subscription, vip").when(key % 7 == 1, "recurring").when(key % 7 == 2, "gift").alias("tags"),
        F.col("o_orderpriority").alias("source_name"),
        F.when(key % 11 != 0, customer).alias("customer"),
        address.alias("shipping_address"),
        F.col("items").alias("line_items"),
        F.when(key % 4 == 0, F.array(F.struct(F.lit("SAVE").alias("code")))).alias("discount_codes"),
    )
    return o.select(
        F.concat(F.lit("e"), key.cast("string")).alias("event_id"),
        F.lit("orders/create").alias("event_type"),
        F.date_format(F.col("o_orderdate") + F.expr("interval 90 minutes"), ISO).alias("event_time"),
        when.alias("ingested_at"),
        F.to_json(payload).alias("data"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


def enriched(spark, sf):
    return enrich.enrich_orders(
        order_payloads(spark, sf), SKUS, "demo", as_of_literal(AS_OF), rhythm_words=RHYTHMS
    )


_ITEMS_SQL = """kinds AS (
  SELECT l_orderkey, p_type AS sku, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
items AS (
  SELECT l_orderkey, count(*) AS line_item_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
    bool_or(sku = 'PROMO') AS has_promo,
    '[' || string_agg('{"sku":"' || sku || '","quantity":' || quantity || '}', ',' ORDER BY quantity DESC, sku) || ']'
      AS line_items,
    arg_min(CASE WHEN sku = 'ECONOMY' THEN 'monthly' ELSE 'quarterly' END, {'q': -quantity, 's': sku})
      FILTER (WHERE sku IN ('ECONOMY', 'STANDARD', 'LARGE')) AS rhythm
  FROM kinds GROUP BY 1),
o AS (
  SELECT *, o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS made,
    CASE o_orderkey % 7 WHEN 0 THEN 'Subscription, vip' WHEN 1 THEN 'recurring' WHEN 2 THEN 'gift' ELSE '' END AS tags,
    o_orderkey % 7 IN (0, 1) OR coalesce(has_promo, FALSE) AS is_subscription
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey LEFT JOIN items ON o_orderkey = l_orderkey)"""


@query(
    "order_enrich",
    f"""WITH {_ITEMS_SQL}
SELECT CAST(k AS VARCHAR) AS order_id, CAST(k + 1000 AS VARCHAR) AS order_number,
  CASE WHEN k % 13 <> 0 THEN made ELSE strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
  made AS updated_at,
  CASE WHEN k % 11 <> 0 AND o_custkey <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN k % 11 <> 0 THEN 'c' || o_custkey || '@example.com' END AS customer_email,
  CASE WHEN k % 11 <> 0 THEN c_name END AS customer_first_name, '+1-' || o_custkey AS customer_phone,
  CASE WHEN k % 11 <> 0 THEN c_mktsegment END AS customer_tags,
  CAST(price AS DOUBLE) AS total_price, CASE WHEN k % 5 < 2 THEN 0.0 ELSE CAST(price AS DOUBLE) END AS subtotal_price,
  CAST(0 AS DOUBLE) AS total_tax, CAST(4.5 AS DOUBLE) AS total_shipping,
  CASE WHEN k % 3 <> 0 THEN 'CAD' ELSE 'USD' END AS currency, o_orderstatus AS financial_status, k % 10 = 0 AS test,
  n_name AS shipping_state, r_name AS shipping_country, CAST(NULL AS VARCHAR) AS billing_city,
  o_orderpriority AS source_name, tags, CASE WHEN k % 4 = 0 THEN '[{{"code":"SAVE"}}]' ELSE '[]' END AS discount_codes,
  '[]' AS refunds, is_subscription, CASE WHEN is_subscription THEN coalesce(rhythm, 'monthly') END AS subscription_type,
  coalesce(line_items, '[]') AS line_items, coalesce(line_item_count, 0) AS line_item_count,
  coalesce(total_quantity, 0) AS total_quantity, 'orders/create' AS event_type,
  '2024-01-31T00:00:00.000Z' AS _ingested_at, 'demo' AS _brand
FROM o""",
)
def order_enrich(spark, sf):
    """Every order as a nested JSON payload, enriched back to flat columns."""
    return plain(
        enriched(spark, sf).select(
            *"order_id order_number created_at updated_at customer_id customer_email customer_first_name "
            "customer_phone customer_tags total_price subtotal_price total_tax total_shipping currency "
            "financial_status test shipping_state shipping_country billing_city source_name tags discount_codes "
            "refunds is_subscription subscription_type line_items line_item_count total_quantity event_type "
            "_ingested_at _brand".split()
        )
    )


@query(
    "order_item_rollup",
    f"""WITH {_ITEMS_SQL}
SELECT o_orderpriority AS source_name, count(*) AS orders, CAST(sum(coalesce(line_item_count, 0)) AS BIGINT) AS items,
  CAST(sum(coalesce(total_quantity, 0)) AS BIGINT) AS units,
  count(*) FILTER (WHERE line_item_count IS NULL) AS without_items
FROM o GROUP BY 1""",
)
def order_item_rollup(spark, sf):
    """Item and unit counts of the payload lists, added up; orders without items are kept."""
    return enriched(spark, sf).groupBy("source_name").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("line_item_count").alias("items"),
        F.sum("total_quantity").alias("units"),
        F.count(F.when(F.col("line_item_count") == 0, 1)).alias("without_items"),
    )


@query(
    "order_subscription_flags",
    f"""WITH {_ITEMS_SQL}
SELECT is_subscription, CASE WHEN is_subscription THEN coalesce(rhythm, 'monthly') END AS subscription_type,
  tags = 'recurring' AS batch_flag, count(*) AS orders, CAST(sum(price) AS DOUBLE) AS revenue
FROM o GROUP BY 1, 2, 3""",
)
def order_subscription_flags(spark, sf):
    """Full flag and rhythm next to the simplified, case-sensitive batch flag."""
    return plain(
        enriched(spark, sf)
        .groupBy(
            "is_subscription", "subscription_type", enrich.batch_subscription_flag(F.col("tags")).alias("batch_flag")
        )
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_price").alias("revenue"))
    )


@query(
    "exclude_tests",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, CAST(month(o_orderdate) AS BIGINT) AS order_month,
  CAST(day(o_orderdate) AS BIGINT) AS order_day, 'demo' AS brand, count(*) AS orders
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2, 3""",
)
def exclude_tests(spark, sf):
    """Test orders left out; date parts and brand added."""
    orders = table(spark, sf, "orders").select(
        "o_orderdate", F.when(F.col("o_orderpriority") == "5-LOW", True).alias("test")
    )
    kept = envelope.without_tests(orders)
    parts = envelope.with_brand(
        envelope.with_date_parts(kept, F.col("o_orderdate"), F.lit("2024-01-31T00:00:00")), "demo"
    )
    return plain(
        parts.groupBy("order_year", "order_month", "order_day", "brand").agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "bulk_range",
    """SELECT o_orderstatus, count(*) AS orders, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day,
  strftime(max(o_orderdate), '%Y-%m-%d') AS last_day
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31' GROUP BY 1""",
)
def bulk_range(spark, sf):
    """Inclusive creation range."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "created_at")
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-12-31"))
    return (
        envelope.created_between(orders, low, high)
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.date_format(F.min("created_at"), "yyyy-MM-dd").alias("first_day"),
            F.date_format(F.max("created_at"), "yyyy-MM-dd").alias("last_day"),
        )
    )


@query(
    "json_scalar",
    """SELECT event_id, props AS list_text, CASE WHEN event_id % 3 = 0 THEN '[]' ELSE '[' || event_id || ']' END AS ids,
  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events""",
)
def json_scalar(spark, sf):
    """JSON text of list attributes with the empty default, and a value read from JSON."""
    ids = F.when(F.col("event_id") % 3 != 0, F.to_json(F.array("event_id")))
    return table(spark, sf, "events").select(
        "event_id",
        enrich.list_text(F.col("props")).alias("list_text"),
        enrich.list_text(ids).alias("ids"),
        props_k().cast("bigint").alias("k"),
    )


def _nested(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("kind")).alias("deep")).alias("who"),
        F.array(F.col("event_id"), F.col("user_id")).alias("ids"),
        F.create_map(F.col("event_type"), F.col("user_id")).alias("by_type"),
    )


@query(
    "flatten_one_level",
    """SELECT event_id, user_id AS who_id, event_type AS deep_kind, '[' || event_id || ',' || user_id || ']' AS ids FROM events""",
)
def flatten_one_level(spark, sf):
    """One level of nesting opened, lists as text, the next level kept."""
    flat = enrich.flatten_one_level(_nested(spark, sf).drop("by_type"))
    return flat.select("event_id", "who_id", F.col("who_deep.kind").alias("deep_kind"), "ids")


@query(
    "stringify_complex",
    """SELECT event_id, user_id AS who_id, '[' || event_id || ',' || user_id || ']' AS ids,
  '{"' || event_type || '":' || user_id || '}' AS by_type FROM events""",
)
def stringify_complex(spark, sf):
    """Lists and maps as JSON text at the end, structs kept."""
    flat = enrich.stringify_complex(_nested(spark, sf))
    return flat.select("event_id", F.col("who.id").alias("who_id"), "ids", "by_type")


def payload_envelopes(spark, sf, payload, event_type=None):
    """Events as envelopes around ``payload``."""
    e = table(spark, sf, "events").withColumn("k", props_k())
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        (event_type if event_type is not None else F.col("event_type")).alias("event_type"),
        F.date_format("ts", ISO).alias("event_time"),
        F.date_format("ts", ISO).alias("ingested_at"),
        F.to_json(payload).alias("data"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


_K, _ID, _USER = F.col, "event_id", "user_id"
_TS = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_KSQL = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"


def checkout_envelopes(spark, sf):
    k = F.col("k")
    payload = F.struct(
        F.concat(F.lit("tok-"), F.col("user_id").cast("string")).alias("token"),
        F.col("event_id").alias("id"),
        F.lit("a@example.com").alias("email"),
        F.when(k % 3 != 0, F.struct(F.col("user_id").alias("id"))).alias("customer"),
        F.date_format("ts", ISO).alias("created_at"),
        F.when(k % 4 == 0, F.date_format("ts", ISO)).alias("completed_at"),
        (k * 2).cast("string").alias("total_price"),
        F.lit("USD").alias("currency"),
        F.when(k % 2 == 0, F.array(F.struct(k.alias("q")))).alias("line_items"),
    )
    return payload_envelopes(spark, sf, payload, F.lit("checkouts/update"))


@query(
    "project_checkouts",
    f"""SELECT 'tok-' || user_id AS checkout_token, 'a@example.com' AS customer_email,
  CASE WHEN {_KSQL} % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id, {_TS} AS created_at,
  CAST({_KSQL} * 2 AS VARCHAR) AS total_price, 'USD' AS currency,
  CASE WHEN {_KSQL} % 2 = 0 THEN '[{{"q":' || {_KSQL} || '}}]' ELSE '[]' END AS line_items,
  CASE WHEN {_KSQL} % 4 = 0 THEN {_TS} END AS completed_at, CAST(1707868800 AS BIGINT) AS ttl,
  CAST(event_id AS VARCHAR) AS event_id
FROM events""",
)
def project_checkouts(spark, sf):
    rows = enrich.project_checkouts(checkout_envelopes(spark, sf), as_of_literal(AS_OF))
    return rows.select(
        *"checkout_token customer_email customer_id created_at total_price currency line_items completed_at ttl".split(),
        F.col("_event_id").alias("event_id"),
    )


def customer_envelopes(spark, sf):
    k = F.col("k")
    payload = F.struct(
        F.col("user_id").alias("id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("email"),
        F.date_format("ts", ISO).alias("updated_at"),
        F.when(k % 2 == 0, k).alias("orders_count"),
        F.when(k % 3 == 0, k.cast("string")).alias("total_spent"),
        F.when(k % 5 == 0, F.lit(True)).alias("accepts_marketing"),
        F.when(k % 7 == 0, F.lit("enabled")).alias("state"),
    )
    topic = F.when(k % 10 == 9, "customers/delete").when(k % 10 == 8, "customers/enable").otherwise("customers/update")
    return payload_envelopes(spark, sf, payload, topic)


@query(
    "project_customers",
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id, 'u' || user_id AS email,
  {_TS} AS updated_at, CASE WHEN {_KSQL} % 2 = 0 THEN {_KSQL} ELSE 0 END AS orders_count,
  CASE WHEN {_KSQL} % 3 = 0 THEN CAST({_KSQL} AS VARCHAR) ELSE '0' END AS total_spent, '' AS tags,
  {_KSQL} % 5 = 0 AS accepts_marketing, CASE WHEN {_KSQL} % 7 = 0 THEN 'enabled' END AS state
FROM events""",
)
def project_customers(spark, sf):
    return enrich.project_customers(customer_envelopes(spark, sf)).select(
        F.col("_event_id").alias("event_id"),
        *"customer_id email updated_at orders_count total_spent tags accepts_marketing state".split(),
    )


def subscription_envelopes(spark, sf):
    k = F.col("k")
    payload = F.struct(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("customer_id"),
        F.when(k % 2 == 0, k).alias("shopify_customer_id"),
        F.when(F.col("event_type") == "error", "cancelled").otherwise("active").alias("status"),
        F.when(F.col("event_type") == "error", F.date_format("ts", ISO)).alias("cancelled_at"),
        F.when(k % 3 == 0, "too expensive").alias("cancellation_reason"),
        F.lit("Monthly Box").alias("product_title"),
        (k * 3).cast("string").alias("price"),
        k.alias("quantity"),
    )
    kind = F.when(F.col("event_type") == "error", "subscription/cancelled").otherwise("subscription/updated")
    return payload_envelopes(spark, sf, payload, kind)


@query(
    "project_subscriptions",
    f"""SELECT CAST(event_id AS VARCHAR) AS subscription_id, CAST(user_id AS VARCHAR) AS customer_id,
  CASE WHEN {_KSQL} % 2 = 0 AND {_KSQL} <> 0 THEN CAST({_KSQL} AS VARCHAR) END AS shopify_customer_id,
  CASE WHEN event_type = 'error' THEN 'cancelled' ELSE 'active' END AS status,
  CASE WHEN event_type = 'error' THEN {_TS} END AS cancelled_at, 'Monthly Box' AS product_title,
  CAST({_KSQL} * 3 AS VARCHAR) AS price, {_KSQL} AS quantity,
  CASE WHEN event_type = 'error' THEN 'subscription/cancelled' ELSE 'subscription/updated' END AS event_type
FROM events""",
)
def project_subscriptions(spark, sf):
    return enrich.project_subscriptions(subscription_envelopes(spark, sf)).select(
        *"subscription_id customer_id shopify_customer_id status cancelled_at product_title price quantity "
        "event_type".split()
    )


def charge_envelopes(spark, sf):
    k = F.col("k")
    failed = F.col("event_type") == "error"
    payload = F.struct(
        F.col("event_id").alias("id"),
        (F.col("event_id") % 100).alias("subscription_id"),
        F.col("user_id").alias("customer_id"),
        F.when(k % 2 == 0, k).alias("shopify_order_id"),
        F.when(failed, "error").otherwise("success").alias("status"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("total_price"),
        F.when(failed & (k % 3 != 0), "declined").alias("error"),
        F.when(failed, "CARD").alias("error_type"),
        F.when(k % 4 != 0, k % 4).alias("billing_attempt_count"),
    )
    return payload_envelopes(spark, sf, payload, F.when(failed, "charge/failed").otherwise("charge/paid"))


@query(
    "project_subscription_charges",
    f"""SELECT CAST(event_id AS VARCHAR) AS charge_id, CAST(event_id % 100 AS VARCHAR) AS subscription_id,
  CAST(user_id AS VARCHAR) AS customer_id,
  CASE WHEN {_KSQL} % 2 = 0 AND {_KSQL} <> 0 THEN CAST({_KSQL} AS VARCHAR) END AS shopify_order_id,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS total_price,
  CASE WHEN event_type = 'error' AND {_KSQL} % 3 <> 0 THEN 'declined' END AS error,
  {_KSQL} % 4 AS billing_attempt_count,
  CASE WHEN event_type = 'error' THEN 'charge/failed' ELSE 'charge/paid' END AS event_type
FROM events""",
)
def project_subscription_charges(spark, sf):
    return enrich.project_subscription_charges(charge_envelopes(spark, sf)).select(
        *"charge_id subscription_id customer_id shopify_order_id status total_price error billing_attempt_count "
        "event_type".split()
    )


def payment_envelopes(spark, sf):
    """Gateway charge events: amounts in cents, epoch seconds, payload under data.object."""
    k = F.col("k")
    failed = F.col("event_type") == "error"
    charge = F.struct(
        F.concat(F.lit("ch_"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("cus_"), F.col("user_id").cast("string")).alias("customer"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
        F.lit("usd").alias("currency"),
        F.when(failed, "failed").otherwise("succeeded").alias("status"),
        (~failed).alias("paid"),
        F.when(failed, "card_declined").alias("failure_code"),
        F.when(failed & (k % 2 == 0), "no funds").alias("failure_message"),
        F.unix_timestamp("ts").alias("created"),
        F.when(k % 3 == 0, F.struct((k * 10).cast("string").alias("order_id"))).alias("metadata"),
    )
    event = F.struct(
        F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("id"),
        F.struct(charge.alias("object")).alias("data"),
    )
    return payload_envelopes(spark, sf, event, F.when(failed, "charge.failed").otherwise("charge.succeeded"))


@query(
    "project_payments",
    f"""SELECT 'ch_' || event_id AS charge_id, 'cus_' || user_id AS customer_id,
  CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount, 'USD' AS currency, event_type <> 'error' AS paid,
  CASE WHEN event_type = 'error' THEN 'card_declined' END AS failure_code,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS created,
  CASE WHEN {_KSQL} % 3 = 0 THEN CAST({_KSQL} * 10 AS VARCHAR) END AS shopify_order_id,
  CASE WHEN event_type = 'error' THEN 'charge.failed' ELSE 'charge.succeeded' END AS event_type
FROM events""",
)
def project_payments(spark, sf):
    return plain(
        enrich.project_payment_charges(payment_envelopes(spark, sf)).select(
            *"charge_id customer_id amount currency paid failure_code created shopify_order_id event_type".split()
        )
    )


@query(
    "project_invoices",
    f"""SELECT 'in_' || event_id AS invoice_id, 'cus_' || user_id AS customer_id,
  CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount_due, {_KSQL} / 100.0 AS amount_paid,
  CAST(0 AS DOUBLE) AS amount_remaining, 'EUR' AS currency, CAST(0 AS BIGINT) AS attempt_count,
  CASE WHEN {_KSQL} % 2 = 0 THEN strftime(date_trunc('second', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') END
    AS next_payment_attempt,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS created
FROM events""",
)
def project_invoices(spark, sf):
    k = F.col("k")
    invoice = F.struct(
        F.concat(F.lit("in_"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("cus_"), F.col("user_id").cast("string")).alias("customer"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount_due"),
        k.alias("amount_paid"),
        F.lit("eur").alias("currency"),
        F.when(k % 2 == 0, F.unix_timestamp("ts") + 86400).otherwise(0).alias("next_payment_attempt"),
        F.unix_timestamp("ts").alias("created"),
    )
    event = F.struct(F.struct(invoice.alias("object")).alias("data"))
    rows = enrich.project_invoices(payload_envelopes(spark, sf, event, F.lit("invoice.paid")))
    return plain(
        rows.select(
            *"invoice_id customer_id amount_due amount_paid amount_remaining currency attempt_count "
            "next_payment_attempt created".split()
        )
    )


def dispute_envelopes(spark, sf):
    dispute = F.struct(
        F.concat(F.lit("dp_"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("ch_"), F.col("user_id").cast("string")).alias("charge"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
        F.lit("gbp").alias("currency"),
        F.when(F.col("k") % 2 == 0, "fraudulent").alias("reason"),
        F.lit("needs_response").alias("status"),
        F.unix_timestamp("ts").alias("created"),
    )
    event = F.struct(F.struct(dispute.alias("object")).alias("data"))
    return payload_envelopes(spark, sf, event, F.lit("charge.dispute.created"))


@query(
    "project_disputes",
    f"""SELECT 'dp_' || event_id AS dispute_id, 'ch_' || user_id AS charge_id,
  CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount, 'GBP' AS currency,
  CASE WHEN {_KSQL} % 2 = 0 THEN 'fraudulent' END AS reason, 'needs_response' AS status,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS created
FROM events""",
)
def project_disputes(spark, sf):
    return plain(
        enrich.project_disputes(dispute_envelopes(spark, sf)).select(
            *"dispute_id charge_id amount currency reason status created".split()
        )
    )

