"""Latest-state tables, change feed, expiry and look-ups."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.operators.ranking import latest_per_key, split_lag, time_levels
from cartlake.operators.skew import HOT_ROWS

# Keys of the state tables, and the columns they are looked up by.
STATE_KEYS = {
    "orders": ["order_id", "created_at"],
    "customers": ["customer_id"],
    "abandoned_carts": ["checkout_token"],
    "subscriptions": ["subscription_id"],
    "subscription_charges": ["charge_id"],
    "payment_attempts": ["charge_id"],
    "invoice_payments": ["invoice_id"],
    "disputes": ["dispute_id"],
}
STATE_LOOKUPS = {
    "orders": [["customer_email", "created_at"], ["order_number"]],
    "customers": [["email"]],
    "subscriptions": [["customer_id"]],
    "subscription_charges": [["subscription_id"]],
    "payment_attempts": [["customer_id"]],
    "invoice_payments": [["subscription_id"]],
}
VERSION = ["_event_time", "_landed_at", "_event_id"]
IN_LIST_LIMIT = 1000


def version_order(df: DataFrame) -> list[Column]:
    """Total order of the versions of a row: event time, arrival, event id.

    Times compare as instants, so offsets written differently do not matter.
    """
    as_rank = lambda c: F.col(c) if c == "_event_id" else F.try_to_timestamp(F.col(c)).alias(c)
    return [as_rank(c) for c in VERSION if c in df.columns]


def upsert(versions: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """Full-row replace, newest version wins (T2). Rows without a key are not state."""
    for key in keys:
        versions = versions.filter(F.col(key).isNotNull())
    return latest_per_key(versions, keys, order or version_order(versions))


def merge_state(state: DataFrame, changes: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """State table with a batch of versions applied; replaying a batch changes nothing."""
    return upsert(state.unionByName(changes, allowMissingColumns=True), keys, order)


def without_deleted(state: DataFrame, deleted: Column) -> DataFrame:
    """Drop rows whose newest version is a tombstone (T4)."""
    return state.filter(~F.coalesce(deleted, F.lit(False)))


def alive(state: DataFrame, as_of: Column, ttl: str = "ttl") -> DataFrame:
    """Drop rows past their expiry second; rows without one stay."""
    return state.filter(F.col(ttl).isNull() | (F.col(ttl) > F.unix_timestamp(as_of)))


def order_state(enriched: DataFrame, tombstones: bool = False) -> DataFrame:
    """Order state from enriched events: only ``orders/`` topics count.

    With ``tombstones`` an ``orders/delete`` event removes the order.
    """
    own = enriched.filter(F.startswith("event_type", F.lit("orders/")))
    state = upsert(own, STATE_KEYS["orders"])
    return without_deleted(state, F.col("event_type") == "orders/delete") if tombstones else state


def abandoned_checkouts(
    versions: DataFrame,
    key: str = "checkout_token",
    completed: Column | None = None,
    order: list[Column | str] | None = None,
    clear_on_complete: bool = False,
) -> DataFrame:
    """Newest open version per checkout (T5).

    A completed version never becomes a row. By default an earlier open version stays until it
    expires; with ``clear_on_complete`` a checkout whose newest version is complete is dropped.
    """
    done = completed if completed is not None else F.col("completed_at").isNotNull()
    done = F.coalesce(done, F.lit(False))
    if clear_on_complete:
        return without_deleted(upsert(versions, [key], order), done)
    return upsert(versions.filter(~done), [key], order)


def change_feed(
    versions: DataFrame,
    key: str,
    time: str,
    sequence: str,
    columns: list[str],
    hot_rows: int = HOT_ROWS,
    settle: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every version, by (time, sequence), with the image it replaced.

    ``settle`` writes the short tables of hot keys and cells; a checkpoint by default.
    """
    levels = time_levels(F.col(time), F.col(sequence))
    linked = split_lag(versions, [key], levels, [time, sequence], columns, "old_image", hot_rows, settle=settle)
    return linked.withColumn("new_image", F.struct(*columns))


def look_up(state: DataFrame, column: str, values: list | DataFrame) -> DataFrame:
    """Rows of a state table by one of its look-up columns.

    A short list becomes an IN filter that reaches the scan; a table of values is semi-joined.
    """
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(values.columns[0]).alias("_wanted"))
        return state.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
    if len(values) <= IN_LIST_LIMIT:
        return state.filter(F.col(column).isin(list(values)))
    table = state.sparkSession.createDataFrame([(v,) for v in values], ["_wanted"])
    return state.join(table, F.col(column) == F.col("_wanted"), "left_semi")


# --- fixed values: snapshot names and the event names they stand for ---
SNAPSHOT_NAMES = {
    "createdAt": "created_at",
    "updatedAt": "updated_at",
    "cancelledAt": "cancelled_at",
    "cancelReason": "cancel_reason",
    "financialStatus": "financial_status",
    "fulfillmentStatus": "fulfillment_status",
    "customer_id": "customer_id",
    "customer_email": "customer_email",
    "customer_firstName": "customer_first_name",
    "customer_lastName": "customer_last_name",
    "customer_phone": "customer_phone",
    "customer_tags": "customer_tags",
    "shippingAddress_city": "shipping_city",
    "shippingAddress_province": "shipping_state",
    "shippingAddress_zip": "shipping_zip",
    "shippingAddress_country": "shipping_country",
    "billingAddress_city": "billing_city",
    "billingAddress_province": "billing_state",
    "billingAddress_zip": "billing_zip",
    "billingAddress_country": "billing_country",
}
SNAPSHOT_MONEY = {
    "totalPriceSet_shopMoney": "total_price",
    "subtotalPriceSet_shopMoney": "subtotal_price",
    "totalDiscountsSet_shopMoney": "total_discounts",
    "totalTaxSet_shopMoney": "total_tax",
}
# --- end of fixed values ---


def normalise_snapshot(flat: DataFrame) -> DataFrame:
    """Flattened bulk rows under the names of the event path.

    Snapshot ids are paths such as ``<scheme>/Order/123``; the last part is the id.
    """
    from cartlake.functions.numeric import money

    last = lambda c: F.element_at(F.split(F.col(c).cast("string"), "/"), -1)
    out = [last("id").alias("order_id")]
    for name in flat.columns:
        if name in SNAPSHOT_MONEY:
            out.append(money(F.col(name)["amount"]).alias(SNAPSHOT_MONEY[name]))
        elif name == "customer_id":
            out.append(last(name).alias("customer_id"))
        elif name != "id":
            out.append(F.col(f"`{name}`").alias(SNAPSHOT_NAMES.get(name, name)))
    if "totalPriceSet_shopMoney" in flat.columns:
        out.append(F.col("totalPriceSet_shopMoney")["currencyCode"].alias("currency"))
    return flat.select(*out)


def combine_orders(events: DataFrame | None, snapshots: DataFrame | None) -> DataFrame:
    """Events and normalised snapshots by name; one side may be missing, not both."""
    if events is None and snapshots is None:
        raise ValueError("neither events nor snapshots are present")
    if events is None or snapshots is None:
        return events if snapshots is None else snapshots
    return events.unionByName(snapshots, allowMissingColumns=True)


def dedupe_orders(orders: DataFrame) -> DataFrame:
    """Newest row per order; a full tie is settled by the text of the row."""
    updated = F.try_to_timestamp(F.col("updated_at")).alias("u")
    rest = [c for c in orders.columns if c not in ("order_id", "updated_at")]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in rest]).alias("h")
    return latest_per_key(
        orders.filter(F.col("order_id").isNotNull()), ["order_id"], [updated, *version_order(orders), tie]
    )


def as_of_literal(moment: datetime | str) -> Column:
    """Fixed UTC instant; jobs pass it so that a retry sees the same now."""
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")
