"""Transport events to envelopes, routing, and what is rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions import timeutil as tu
from cartlake.functions.jsontext import computed_once, parsed

# --- fixed values: header names of the store platform, topic prefixes of each entity ---
TOPIC_HEADER = "X-Shopify-Topic"
TRIGGERED_HEADER = "X-Shopify-Triggered-At"
TOPIC_PREFIXES = {
    "orders": [
        "orders",
        "draft_orders",
        "refunds",
        "returns",
        "disputes",
        "subscription_contracts",
        "subscription_billing_attempts",
        "subscription_billing_cycle_edits",
        "subscription_billing_cycles",
        "bulk_operations",
    ],
    "fulfillments": ["fulfillments", "fulfillment_orders"],
    "customers": ["customers", "customer_payment_methods"],
    "products": ["products", "inventory_items", "inventory_levels", "locations", "markets"],
    "carts": ["carts", "checkouts"],
}
# --- end of fixed values ---


def _truthy(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def _empty_payload(data: Column) -> Column:
    return F.coalesce(F.trim(data), F.lit("")).isin("", "{}", "[]", "null")


def extract_payload(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Transport events to envelopes.

    ``detail`` is either the payload itself or ``{payload, metadata}``. The transport id is
    kept as ``event_id``: redelivered events are recognised by it.
    """
    wrapped = F.coalesce(F.array_contains(F.json_object_keys("detail"), "payload"), F.lit(False))
    parts = F.from_json("detail", "payload string, metadata map<string,string>")
    no_metadata = F.create_map().cast("map<string,string>")
    staged = computed_once(events, F.struct(wrapped.alias("wrapped"), parts.alias("parts")), "_p")
    is_wrapped = F.col("_p.wrapped")
    metadata = F.coalesce(F.when(is_wrapped, F.col("_p.parts.metadata")), no_metadata)
    stamp = ingested_at if ingested_at is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
    )
    return staged.select(
        F.col("id").alias("event_id"),
        F.coalesce(_truthy(metadata[TOPIC_HEADER]), F.col("detail-type")).alias("event_type"),
        F.coalesce(_truthy(metadata[TRIGGERED_HEADER]), F.col("time")).alias("event_time"),
        stamp.alias("ingested_at"),
        F.when(is_wrapped, F.col("_p.parts.payload")).otherwise(F.col("detail")).alias("data"),
        metadata.alias("metadata"),
        *([F.col("_corrupt_record")] if "_corrupt_record" in events.columns else []),
    )


def quarantine_reason(envelopes: DataFrame) -> Column:
    """Why an envelope cannot be processed, NULL when it can."""
    reason = F.when(_empty_payload(F.col("data")), "empty_payload")
    if "_corrupt_record" in envelopes.columns:
        reason = F.when(F.col("_corrupt_record").isNotNull(), "malformed_json").when(
            _empty_payload(F.col("data")), "empty_payload"
        )
    return reason.when(F.coalesce(F.trim("event_type"), F.lit("")) == "", "missing_event_type")


def split_quarantine(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(processable, quarantined with a ``reason``)."""
    tagged = envelopes.withColumn("reason", quarantine_reason(envelopes))
    good = tagged.filter(F.col("reason").isNull()).drop("reason", "_corrupt_record")
    return good, tagged.filter(F.col("reason").isNotNull())


def route_entity(topic: Column) -> Column:
    """Store topic to the entity that handles it, by the part before the slash."""
    prefix = F.when(F.contains(topic, F.lit("/")), F.substring_index(topic, "/", 1))
    chain = None
    for entity, prefixes in TOPIC_PREFIXES.items():
        hit = prefix.isin(prefixes)
        chain = F.when(hit, entity) if chain is None else chain.when(hit, entity)
    return chain.otherwise("other")


def route_cart(topic: Column) -> Column:
    """Checkout stream or cart stream; unknown topics land with the carts (R2)."""
    return F.when(F.contains(topic, F.lit("checkout")), "checkouts").otherwise("carts")


def route_subscription(event_type: Column) -> Column:
    """Landing folder of a subscription-platform event."""
    return (
        F.when(F.contains(event_type, F.lit("subscription")), "subscriptions")
        .when(F.contains(event_type, F.lit("charge")), "charges")
        .otherwise("other")
    )


def subscription_state_table(event_type: Column) -> Column:
    """State table a subscription-platform event updates, by prefix."""
    return F.when(F.startswith(event_type, F.lit("subscription/")), "subscriptions").when(
        F.startswith(event_type, F.lit("charge/")), "charges"
    )


def route_payment(event_type: Column) -> Column:
    """Landing folder of a gateway event; the order of the rules matters."""
    has = lambda word: F.contains(event_type, F.lit(word))
    return (
        F.when(has("charge") & ~has("dispute"), "charges")
        .when(has("payment_intent"), "payment_intents")
        .when(has("invoice"), "invoices")
        .when(has("dispute"), "disputes")
        .otherwise("other")
    )


def customer_operation(topic: Column) -> Column:
    """What a customer event does to the state."""
    return (
        F.when(topic.isin("customers/create", "customers/update"), "upsert")
        .when(topic == "customers/delete", "delete")
        .otherwise("none")
    )


def subscription_envelope(requests: DataFrame) -> DataFrame:
    """Accepted subscription-platform requests to envelopes; their clock is arrival."""
    return parsed(requests, F.col("body"), "type string, data string", "_b").select(
        F.col("request_id").alias("event_id"),
        F.col("_b.type").alias("event_type"),
        F.lit(None).cast("string").alias("event_time"),
        F.col("received_at").alias("ingested_at"),
        F.col("_b.data").alias("data"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


def payment_envelope(requests: DataFrame) -> DataFrame:
    """Accepted gateway requests to envelopes; the whole event is kept as ``data``."""
    return parsed(requests, F.col("body"), "id string, type string", "_b").select(
        F.col("_b.id").alias("event_id"),
        F.col("_b.type").alias("event_type"),
        F.lit(None).cast("string").alias("event_time"),
        F.col("received_at").alias("ingested_at"),
        F.col("body").alias("data"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


def landing_partitions(envelopes: DataFrame, clock: str = "event") -> DataFrame:
    """``date`` and ``hour`` of the event, or of its arrival, in UTC."""
    arrival = tu.utc_clock(F.col("ingested_at"))
    moment = F.coalesce(tu.utc_clock(F.col("event_time")), arrival) if clock == "event" else arrival
    return envelopes.withColumns(
        {"date": F.date_format(moment, "yyyy-MM-dd"), "hour": F.date_format(moment, "HH")}
    )


def payload_columns(landed: DataFrame) -> DataFrame:
    """Fields of the payload next to type and time; ``data`` wins over ``detail``."""
    name = next((c for c in ("data", "detail") if c in landed.columns), None)
    if name is None:
        raise ValueError("neither data nor detail is present")
    return landed.select("event_type", "event_time", f"{name}.*")


def created_between(df: DataFrame, start=None, end=None, column: str = "created_at") -> DataFrame:
    """Bulk range: inclusive, either side optional."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    return df


def without_tests(orders: DataFrame) -> DataFrame:
    """Leave out test orders."""
    return orders.filter(~F.coalesce(F.col("test"), F.lit(False)))


def with_brand(df: DataFrame, brand: str, column: str = "brand") -> DataFrame:
    return df.withColumn(column, F.lit(brand))


def with_date_parts(orders: DataFrame, created: Column, processed_at: Column | None = None) -> DataFrame:
    """Year, month, day of an order and when it was processed (P25)."""
    stamp = processed_at if processed_at is not None else F.current_timestamp().cast("string")
    return orders.withColumns(
        {
            "order_year": F.year(created),
            "order_month": F.month(created),
            "order_day": F.dayofmonth(created),
            "processing_timestamp": stamp,
        }
    )
