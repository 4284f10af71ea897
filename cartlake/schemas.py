"""Explicit schemas of every source and the column lists of every report.

Identifiers are STRING: the JSON reader keeps the digits of a number as written, so an id of
any length survives. List attributes that are only passed on are STRING too: the reader hands
over their JSON text untouched, whatever the elements look like.
"""

from __future__ import annotations

from pyspark.sql import types as T


def fields(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


TEXT, DOUBLE, LONG, CLOCK = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()
TEXT_MAP = T.MapType(TEXT, TEXT)
CORRUPT = "_corrupt_record"

# Flat schemas are StructTypes, nested payloads are DDL text, which needs no session at import.

# One captured transport event per line; ``detail`` stays raw JSON.
TRANSPORT_EVENT = T.StructType(fields(f"id detail-type time detail {CORRUPT}", TEXT))

# What the lake keeps for every event, whichever system sent it.
ENVELOPE = T.StructType(
    [*fields("event_id event_type event_time ingested_at data", TEXT), T.StructField("metadata", TEXT_MAP)]
)

# Captured webhook request.
REQUEST = T.StructType(
    [*fields("request_id received_at body", TEXT), T.StructField("headers", TEXT_MAP)]
)

ORDER_CUSTOMER = (
    "struct<id string, email string, first_name string, last_name string, phone string, "
    "created_at string, orders_count bigint, total_spent string, tags string, "
    "accepts_marketing boolean, marketing_opt_in_level string>"
)
ADDRESS = (
    "struct<city string, province string, zip string, country string, address1 string, "
    "address2 string, company string, name string, phone string>"
)
ORDER = (
    "id string, order_number string, created_at string, updated_at string, processed_at string, "
    "closed_at string, total_price string, subtotal_price string, total_discounts string, "
    "total_tax string, total_line_items_price string, "
    "total_shipping_price_set struct<shop_money struct<amount string>>, currency string, "
    "financial_status string, fulfillment_status string, cancelled_at string, "
    "cancel_reason string, confirmed boolean, test boolean, tags string, note string, "
    "gateway string, processing_method string, source_name string, source_identifier string, "
    "source_url string, referring_site string, landing_site string, landing_site_ref string, "
    "checkout_token string, cart_token string, "
    f"customer {ORDER_CUSTOMER}, shipping_address {ADDRESS}, billing_address {ADDRESS}, "
    "line_items string, discount_codes string, discount_applications string, "
    "note_attributes string, payment_gateway_names string, fulfillments string, refunds string"
)
ORDER_ITEMS = "array<struct<sku string, quantity bigint>>"

CHECKOUT = (
    "token string, id string, email string, customer struct<id string>, created_at string, "
    "updated_at string, completed_at string, abandoned_checkout_url string, total_price string, "
    "currency string, line_items string"
)
CUSTOMER = (
    "id string, email string, first_name string, last_name string, phone string, "
    "created_at string, updated_at string, orders_count bigint, total_spent string, tags string, "
    "accepts_marketing boolean, marketing_opt_in_level string, state string"
)
SUBSCRIPTION = (
    "id string, customer_id string, shopify_customer_id string, status string, created_at string, "
    "updated_at string, cancelled_at string, cancellation_reason string, "
    "cancellation_reason_comments string, next_charge_scheduled_at string, "
    "order_interval_frequency string, order_interval_unit string, product_title string, "
    "price string, quantity bigint, shopify_product_id string, shopify_variant_id string, sku string"
)
SUBSCRIPTION_CHARGE = (
    "id string, subscription_id string, customer_id string, shopify_order_id string, "
    "status string, type string, scheduled_at string, processed_at string, total_price string, "
    "subtotal_price string, error string, error_type string, retry_date string, "
    "billing_attempt_count bigint"
)
PAYMENT_CHARGE = (
    "id string, customer string, amount bigint, currency string, status string, paid boolean, "
    "failure_code string, failure_message string, payment_method string, created bigint, "
    "metadata struct<order_id string, customer_id string>"
)
INVOICE = (
    "id string, subscription string, customer string, amount_due bigint, amount_paid bigint, "
    "amount_remaining bigint, currency string, status string, attempt_count bigint, "
    "next_payment_attempt bigint, created bigint"
)
DISPUTE = (
    "id string, charge string, amount bigint, currency string, reason string, status string, "
    "created bigint"
)

_PRICE_SET = "struct<shopMoney struct<amount string, currencyCode string>>"
BULK_ORDER = (
    "id string, name string, email string, createdAt string, updatedAt string, "
    "cancelledAt string, cancelReason string, "
    f"totalPriceSet {_PRICE_SET}, subtotalPriceSet {_PRICE_SET}, totalDiscountsSet {_PRICE_SET}, "
    f"totalTaxSet {_PRICE_SET}, financialStatus string, fulfillmentStatus string, tags string, "
    "note string, "
    "customer struct<id string, email string, firstName string, lastName string, phone string, "
    "tags string>, "
    "shippingAddress struct<city string, province string, zip string, country string, phone string>, "
    "billingAddress struct<city string, province string, zip string, country string>, "
    "lineItems struct<edges array<struct<node struct<id string, name string, quantity bigint, "
    "sku string, variant struct<id string, title string>, "
    f"originalUnitPriceSet {_PRICE_SET}>>>>, "
    "fulfillments array<struct<id string, status string, createdAt string, updatedAt string, "
    "trackingInfo array<struct<number string, url string, company string>>>>"
)

LEGACY_PERFORMANCE = (
    "marketingPerformance struct<edges array<struct<node struct<countryCode string, "
    "datetime string, metrics array<struct<source string, spendUsd double, "
    "newCustomerOrders bigint, newCustomerSalesUsd double, totalSalesUsd double>>>>>>"
)

# --- fixed values: metric names of the hourly dataset and the daily report ---
ORDER_METRICS = [
    "total_sales",
    "new_customer_sales",
    "new_customer_orders",
    "total_orders",
    "gross_sales",
    "gross_product_sales",
    "refund_money",
    "discount_amount",
    "cost_of_goods",
    "shipping_costs",
    "estimated_shipping_costs",
    "handling_fees",
    "payment_gateway_costs",
]
SEARCH_SHARES = [
    "search_impression_share",
    "search_top_impression_share",
    "search_absolute_top_impression_share",
    "search_budget_lost_top_impression_share",
    "search_budget_lost_absolute_top_impression_share",
    "search_rank_lost_top_impression_share",
    "search_rank_lost_impression_share",
]
SEARCH_IMPRESSIONS = [
    "search_top_impressions",
    "search_absolute_top_impressions",
    "search_budget_lost_top_impressions",
    "search_budget_lost_absolute_top_impressions",
    "search_rank_lost_top_impressions",
    "search_rank_lost_impressions",
]
AD_COUNTS = [
    "non_tracked_spend",
    "impressions",
    "clicks",
    "onsite_purchases",
    "onsite_conversion_value",
    "meta_purchases",
]
ADVISORY_TEXTS = [
    "campaign_ai_recommendation",
    "campaign_ai_roas_pacing",
    "adset_ai_recommendation",
    "adset_ai_roas_pacing",
    "ad_ai_recommendation",
    "ad_ai_roas_pacing",
    "channel_ai_recommendation",
    "channel_ai_roas_pacing",
]
DAILY_COLUMNS = [
    "region",
    "local_date",
    "currency",
    "meta_spend",
    "google_spend",
    "total_spend",
    "new_customer_orders",
    "returning_orders",
    "total_orders",
    "new_customer_sales",
    "returning_sales",
    "total_sales",
    "net_sales",
    "gross_sales",
    "gross_product_sales",
    "refund_money",
    "discount_amount",
    "cost_of_goods",
    "shipping_costs",
    "estimated_shipping_costs",
    "handling_fees",
    "payment_gateway_costs",
    "gross_profit",
    "gross_margin",
    "discount_rate",
    "refund_rate",
    "non_tracked_spend",
    "impressions",
    "clicks",
    "ctr",
    "cpc",
    "cpm",
    "meta_purchases",
    "onsite_purchases",
    "onsite_conversion_value",
    "onsite_roas",
    *SEARCH_SHARES,
    *SEARCH_IMPRESSIONS,
    *ADVISORY_TEXTS,
    "new_customer_aov",
    "new_customer_roas",
    "blended_roas",
    "new_customer_cpp",
]
# --- end of fixed values ---

AD_SUMS = ["spend", *AD_COUNTS, *SEARCH_IMPRESSIONS]
HOURLY_SUMS = ["meta_spend", "google_spend", *ORDER_METRICS, *AD_COUNTS, *SEARCH_IMPRESSIONS]

ORDERS_FACT = (
    "created_at timestamp_ntz, shipping_country_code string, currency string, "
    "shop_timezone string, order_revenue double, orders_quantity double, "
    "is_new_customer boolean, "
    + ", ".join(f"{c} double" for c in ORDER_METRICS[4:])
)
ADS_FACT = (
    "event_date date, event_hour int, channel string, account_id string, campaign_name string, "
    "adset_name string, currency string, campaign_status string, adset_status string, "
    "ad_status string, "
    + ", ".join(f"{c} double" for c in [*AD_SUMS, *SEARCH_SHARES])
    + ", "
    + ", ".join(f"{c} string" for c in ADVISORY_TEXTS)
)
HOURLY_METRICS = T.StructType(
    [
        T.StructField("region", TEXT),
        T.StructField("timestamp_utc", CLOCK),
        T.StructField("currency", TEXT),
        *[T.StructField(c, LONG if c == "new_customer_orders" else DOUBLE) for c in HOURLY_SUMS],
        *[T.StructField(c, DOUBLE) for c in SEARCH_SHARES],
        *[T.StructField(c, TEXT) for c in ADVISORY_TEXTS],
    ]
)
# Data columns of the partitioned hourly table, writer and DDL alike, in file order.
HOURLY_DERIVED = [
    "total_spend",
    "new_customer_cpp",
    "new_customer_aov",
    "new_customer_roas",
    "blended_roas",
    "returning_orders",
    "returning_sales",
    "net_sales",
    "gross_profit",
    "gross_margin",
    "discount_rate",
    "refund_rate",
    "ctr",
    "cpc",
    "cpm",
    "onsite_roas",
]
HOURLY_TABLE = T.StructType(
    [
        *HOURLY_METRICS.fields,
        *[T.StructField(c, DOUBLE) for c in HOURLY_DERIVED],
        T.StructField("local_datetime", CLOCK),
        T.StructField("local_date", T.DateType()),
        T.StructField("local_hour", TEXT),
        T.StructField("central_datetime", CLOCK),
        T.StructField("central_hour", TEXT),
    ]
)

QUALITY_CHECK = (
    "struct<check string, status string, message string, missing_hours array<string>, "
    "current_count bigint, average_count double, threshold double, item_count bigint, "
    "table_status string>"
)
