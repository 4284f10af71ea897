"""Payload projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake import schemas
from cartlake.functions import numeric as num
from cartlake.functions import timeutil as tu
from cartlake.functions.jsontext import parsed

# --- fixed values: words that mark a subscription order and its rhythm ---
SUBSCRIPTION_TAGS = ["subscription", "recurring"]
RHYTHM_WORDS = {"monthly": ["monthly"], "quarterly": ["quarterly", "3x"]}
DEFAULT_RHYTHM = "monthly"
# --- end of fixed values ---

ORDER_TTL_DAYS = 30
CART_TTL_DAYS = 14


def stringify_complex(df: DataFrame) -> DataFrame:
    """Top-level lists and maps become JSON text and move to the end."""
    complex_ = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType))]
    plain = [F.col(f"`{c}`") for c in df.columns if c not in complex_]
    return df.select(*plain, *[F.to_json(f"`{c}`").alias(c) for c in complex_])


def flatten_one_level(df: DataFrame) -> DataFrame:
    """Structs spread to ``<name>_<field>``, lists become JSON text, deeper structs stay."""
    out: list[Column] = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            out += [
                F.col(f"`{field.name}`.`{sub.name}`").alias(f"{field.name}_{sub.name}")
                for sub in field.dataType.fields
            ]
        elif isinstance(field.dataType, T.ArrayType):
            out.append(F.to_json(f"`{field.name}`").alias(field.name))
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)


def list_text(col: Column) -> Column:
    """JSON text of a list attribute, ``[]`` when it is missing."""
    return F.coalesce(F.nullif(col, F.lit("null")), F.lit("[]"))


def _has_any(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return hit


def is_subscription(
    tags: Column,
    items: Column,
    subscription_skus: list[str],
    tag_words: list[str] = SUBSCRIPTION_TAGS,
) -> Column:
    """Tagged as a subscription, or any item SKU holds a configured SKU."""
    skus = [s.strip().lower() for s in subscription_skus if s.strip()]
    by_tag = _has_any(F.lower(F.coalesce(tags, F.lit(""))), tag_words)
    if not skus:
        return by_tag
    by_sku = F.exists(items, lambda i: _has_any(F.lower(F.coalesce(i["sku"], F.lit(""))), skus))
    return by_tag | F.coalesce(by_sku, F.lit(False))


def subscription_type(
    flag: Column,
    items: Column,
    rhythm_words: dict[str, list[str]] = RHYTHM_WORDS,
    default: str = DEFAULT_RHYTHM,
) -> Column:
    """Rhythm named by the first item that names one."""

    def rhythm(item: Column) -> Column:
        sku = F.lower(F.coalesce(item["sku"], F.lit("")))
        chain = None
        for name, words in rhythm_words.items():
            hit = _has_any(sku, words)
            chain = F.when(hit, name) if chain is None else chain.when(hit, name)
        return chain

    named = F.filter(F.transform(items, rhythm), lambda r: r.isNotNull())
    return F.when(flag, F.coalesce(F.get(named, F.lit(0)), F.lit(default)))


def batch_subscription_flag(tags: Column) -> Column:
    """The simplified flag of the batch job: case-sensitive, tags only."""
    return F.coalesce(_has_any(tags, SUBSCRIPTION_TAGS), F.lit(False))


def total_quantity(items: Column) -> Column:
    """Units over all items of an order."""
    return F.aggregate(
        items, F.lit(0).cast("bigint"), lambda acc, i: acc + F.coalesce(i["quantity"], F.lit(0).cast("bigint"))
    )


def _parsed(envelopes: DataFrame, schema: str, path: str | None = None) -> DataFrame:
    """Envelopes with their payload parsed into ``d``."""
    return parsed(envelopes, F.get_json_object("data", path) if path else F.col("data"), schema)


def _stamp(as_of: Column | None) -> Column:
    return F.date_format(as_of if as_of is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def _fields(names: str, prefix: str = "") -> list[Column]:
    return [F.col(f"d.{n}").alias(f"{prefix}{n}") for n in names.split()]


def _id_text(path: str, name: str) -> Column:
    """Identifier as text; blank and zero count as missing."""
    col = F.col(path)
    return F.when(~col.isin("", "0"), col).alias(name)


def _address(path: str, prefix: str) -> list[Column]:
    a = F.col(path)
    return [
        a["city"].alias(f"{prefix}_city"),
        a["province"].alias(f"{prefix}_state"),
        a["zip"].alias(f"{prefix}_zip"),
        a["country"].alias(f"{prefix}_country"),
        a["address1"].alias(f"{prefix}_address_1"),
        a["address2"].alias(f"{prefix}_address_2"),
        a["company"].alias(f"{prefix}_company"),
        a["name"].alias(f"{prefix}_name"),
    ]


def enrich_orders(
    envelopes: DataFrame,
    subscription_skus: list[str],
    brand: str,
    as_of: Column | None = None,
    tag_words: list[str] = SUBSCRIPTION_TAGS,
    rhythm_words: dict[str, list[str]] = RHYTHM_WORDS,
) -> DataFrame:
    """Order envelopes to enriched orders, one projection and no shuffle.

    Absent and null attributes both take the default. ``event_id``, ``event_time`` and
    ``ingested_at`` come along as the order in which versions of an order are ranked.
    """
    df = _parsed(envelopes, schemas.ORDER).withColumn(
        "_items", F.coalesce(F.from_json("d.line_items", schemas.ORDER_ITEMS), F.array().cast(schemas.ORDER_ITEMS))
    )
    items = F.col("_items")
    df = df.withColumn("_sub", is_subscription(F.col("d.tags"), items, subscription_skus, tag_words))
    customer = F.col("d.customer")
    return df.select(
        F.col("d.id").alias("order_id"),
        F.col("d.order_number").alias("order_number"),
        F.coalesce(F.nullif("d.created_at", F.lit("")), F.col("event_time")).alias("created_at"),
        *_fields("updated_at processed_at closed_at"),
        _id_text("d.customer.id", "customer_id"),
        customer["email"].alias("customer_email"),
        customer["first_name"].alias("customer_first_name"),
        customer["last_name"].alias("customer_last_name"),
        F.coalesce(F.nullif(customer["phone"], F.lit("")), F.col("d.shipping_address.phone")).alias("customer_phone"),
        customer["created_at"].alias("customer_created_at"),
        customer["orders_count"].alias("customer_orders_count"),
        customer["total_spent"].alias("customer_total_spent"),
        customer["tags"].alias("customer_tags"),
        customer["accepts_marketing"].alias("customer_accepts_marketing"),
        customer["marketing_opt_in_level"].alias("customer_marketing_opt_in_level"),
        *[
            num.money(F.col(f"d.{c}")).alias(c)
            for c in ("total_price", "subtotal_price", "total_discounts", "total_tax")
        ],
        num.money(F.col("d.total_shipping_price_set.shop_money.amount")).alias("total_shipping"),
        num.money(F.col("d.total_line_items_price")).alias("total_line_items_price"),
        F.coalesce("d.currency", F.lit("USD")).alias("currency"),
        *_fields("financial_status fulfillment_status cancelled_at cancel_reason confirmed"),
        F.coalesce("d.test", F.lit(False)).alias("test"),
        *_address("d.shipping_address", "shipping"),
        *_address("d.billing_address", "billing"),
        *_fields("source_name source_identifier source_url referring_site landing_site landing_site_ref"),
        *_fields("checkout_token cart_token"),
        list_text(F.col("d.discount_codes")).alias("discount_codes"),
        list_text(F.col("d.discount_applications")).alias("discount_applications"),
        F.coalesce("d.tags", F.lit("")).alias("tags"),
        F.col("d.note").alias("note"),
        list_text(F.col("d.note_attributes")).alias("note_attributes"),
        F.col("d.gateway").alias("gateway"),
        list_text(F.col("d.payment_gateway_names")).alias("payment_gateway_names"),
        F.col("d.processing_method").alias("processing_method"),
        F.col("_sub").alias("is_subscription"),
        subscription_type(F.col("_sub"), items, rhythm_words).alias("subscription_type"),
        list_text(F.col("d.fulfillments")).alias("fulfillments"),
        list_text(F.col("d.refunds")).alias("refunds"),
        list_text(F.col("d.line_items")).alias("line_items"),
        F.size(items).cast("bigint").alias("line_item_count"),
        total_quantity(items).alias("total_quantity"),
        F.col("event_type"),
        _stamp(as_of).alias("_ingested_at"),
        F.lit(brand).alias("_brand"),
        F.col("event_id").alias("_event_id"),
        F.col("event_time").alias("_event_time"),
        F.col("ingested_at").alias("_landed_at"),
    )


def recent_only(df: DataFrame, as_of: Column, days: int = ORDER_TTL_DAYS, column: str = "created_at") -> DataFrame:
    """Keep what is missing a readable date or is not older than ``days``."""
    created = tu.parse_instant(F.col(column))
    return df.filter(created.isNull() | (created >= as_of - F.make_dt_interval(F.lit(days))))


def with_ttl(df: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Epoch second after which a row is dropped (F16)."""
    return df.withColumn("ttl", F.unix_timestamp(as_of + F.make_dt_interval(F.lit(days))))


def project_checkouts(envelopes: DataFrame, as_of: Column) -> DataFrame:
    """Checkout rows (P7); completed ones keep their ``completed_at`` for the caller."""
    rows = _parsed(envelopes, schemas.CHECKOUT).select(
        F.col("d.token").alias("checkout_token"),
        F.col("d.email").alias("customer_email"),
        F.col("d.customer.id").alias("customer_id"),
        *_fields("created_at updated_at abandoned_checkout_url total_price currency"),
        list_text(F.col("d.line_items")).alias("line_items"),
        _stamp(as_of).alias("_tracked_at"),
        F.nullif("d.completed_at", F.lit("")).alias("completed_at"),
        F.col("event_id").alias("_event_id"),
        F.col("event_time").alias("_event_time"),
        F.col("ingested_at").alias("_landed_at"),
    )
    return with_ttl(rows, as_of, CART_TTL_DAYS)


def project_customers(envelopes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Customer rows with their defaults."""
    return _parsed(envelopes, schemas.CUSTOMER).select(
        F.col("d.id").alias("customer_id"),
        *_fields("email first_name last_name phone created_at updated_at"),
        F.coalesce("d.orders_count", F.lit(0).cast("bigint")).alias("orders_count"),
        F.coalesce("d.total_spent", F.lit("0")).alias("total_spent"),
        F.coalesce("d.tags", F.lit("")).alias("tags"),
        F.coalesce("d.accepts_marketing", F.lit(False)).alias("accepts_marketing"),
        *_fields("marketing_opt_in_level state"),
        _stamp(as_of).alias("_updated_at"),
        F.col("event_type"),
        F.col("event_id").alias("_event_id"),
        F.col("event_time").alias("_event_time"),
        F.col("ingested_at").alias("_landed_at"),
    )


def _audit(as_of: Column | None) -> list[Column]:
    return [
        F.col("event_type"),
        _stamp(as_of).alias("_updated_at"),
        F.col("event_id").alias("_event_id"),
        F.col("ingested_at").alias("_landed_at"),
    ]


def project_subscriptions(envelopes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Subscription rows."""
    return _parsed(envelopes, schemas.SUBSCRIPTION).select(
        F.col("d.id").alias("subscription_id"),
        F.col("d.customer_id").alias("customer_id"),
        _id_text("d.shopify_customer_id", "shopify_customer_id"),
        *_fields(
            "status created_at updated_at cancelled_at cancellation_reason "
            "cancellation_reason_comments next_charge_scheduled_at order_interval_frequency "
            "order_interval_unit product_title price quantity"
        ),
        _id_text("d.shopify_product_id", "shopify_product_id"),
        _id_text("d.shopify_variant_id", "shopify_variant_id"),
        F.col("d.sku").alias("sku"),
        *_audit(as_of),
    )


def project_subscription_charges(envelopes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Subscription charge rows (P10)."""
    return _parsed(envelopes, schemas.SUBSCRIPTION_CHARGE).select(
        F.col("d.id").alias("charge_id"),
        *_fields("subscription_id customer_id"),
        _id_text("d.shopify_order_id", "shopify_order_id"),
        *_fields("status type scheduled_at processed_at total_price subtotal_price error error_type retry_date"),
        F.coalesce("d.billing_attempt_count", F.lit(0).cast("bigint")).alias("billing_attempt_count"),
        *_audit(as_of),
    )


def _epoch_clock(path: str, name: str) -> Column:
    return tu.instant_to_utc_clock(F.timestamp_seconds(F.col(path))).alias(name)


def project_payment_charges(envelopes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Payment attempts."""
    return _parsed(envelopes, schemas.PAYMENT_CHARGE, "$.data.object").select(
        F.col("d.id").alias("charge_id"),
        F.col("d.customer").alias("customer_id"),
        num.cents(F.col("d.amount")).alias("amount"),
        F.upper("d.currency").alias("currency"),
        *_fields("status paid failure_code failure_message payment_method"),
        _epoch_clock("d.created", "created"),
        F.col("d.metadata.order_id").alias("shopify_order_id"),
        F.col("d.metadata.customer_id").alias("shopify_customer_id"),
        *_audit(as_of),
    )


def project_invoices(envelopes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Invoice payments."""
    zero = F.lit(0).cast("bigint")
    return _parsed(envelopes, schemas.INVOICE, "$.data.object").select(
        F.col("d.id").alias("invoice_id"),
        F.col("d.subscription").alias("subscription_id"),
        F.col("d.customer").alias("customer_id"),
        num.cents(F.col("d.amount_due")).alias("amount_due"),
        num.cents(F.coalesce("d.amount_paid", zero)).alias("amount_paid"),
        num.cents(F.coalesce("d.amount_remaining", zero)).alias("amount_remaining"),
        F.upper("d.currency").alias("currency"),
        F.col("d.status").alias("status"),
        F.coalesce("d.attempt_count", zero).alias("attempt_count"),
        tu.instant_to_utc_clock(
            F.timestamp_seconds(F.nullif(F.col("d.next_payment_attempt"), zero))
        ).alias("next_payment_attempt"),
        _epoch_clock("d.created", "created"),
        *_audit(as_of),
    )


def project_disputes(envelopes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Disputes (P13)."""
    return _parsed(envelopes, schemas.DISPUTE, "$.data.object").select(
        F.col("d.id").alias("dispute_id"),
        F.col("d.charge").alias("charge_id"),
        num.cents(F.col("d.amount")).alias("amount"),
        F.upper("d.currency").alias("currency"),
        *_fields("reason status"),
        _epoch_clock("d.created", "created"),
        *_audit(as_of),
    )
