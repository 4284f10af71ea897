"""State table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlake.catalog.enrichment import ISO, checkout_envelopes, customer_envelopes
from cartlake.catalog.registry import plain, query, table
from cartlake.operators import enrich, envelope, state
from cartlake.operators.state import as_of_literal

AS_OF = "2024-01-31 00:00:00"
ORDER = ["ts", "event_id"]
_LATEST = """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events"""
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_K = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"


@query(
    "dedupe_latest",
    f"""SELECT CAST(user_id AS VARCHAR) AS order_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS updated_at, event_id, event_type
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
)
def dedupe_latest(spark, sf):
    """Newest version per order by its update time."""
    versions = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("order_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
        F.col("event_id").alias("_event_id"),
        "event_type",
    )
    return state.dedupe_orders(versions).withColumnRenamed("_event_id", "event_id")


@query(
    "state_upsert",
    f"SELECT user_id, event_id, {_TS} AS ts, event_type, value, props FROM ({_LATEST}) WHERE rn = 1",
)
def state_upsert(spark, sf):
    return plain(state.upsert(table(spark, sf, "events"), ["user_id"], ORDER))


@query(
    "state_merge",
    f"SELECT user_id, event_id, {_TS} AS ts, event_type, value, props FROM ({_LATEST}) WHERE rn = 1",
)
def state_merge(spark, sf):
    """State of the first half, then a batch that overlaps it: the same as one upsert."""
    events = table(spark, sf, "events")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    first = state.upsert(events.filter(F.col("ts") < middle), ["user_id"], ORDER)
    changes = events.filter(F.col("ts") >= middle - F.expr("interval 1 day"))
    return plain(state.merge_state(first, changes, ["user_id"], ORDER))


@query(
    "state_delete",
    f"SELECT user_id, event_id, event_type FROM ({_LATEST}) WHERE rn = 1 AND event_type <> 'error'",
)
def state_delete(spark, sf):
    """Users whose newest event is a tombstone are gone."""
    latest = state.upsert(table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], ORDER)
    return state.without_deleted(latest, F.col("event_type") == "error").select("user_id", "event_id", "event_type")


@query(
    "customer_state",
    f"""SELECT CAST(user_id AS VARCHAR) AS customer_id, CASE WHEN {_K} % 2 = 0 THEN {_K} ELSE 0 END AS orders_count,
  CAST(event_id AS VARCHAR) AS event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, CAST(event_id AS VARCHAR) DESC) AS rn
  FROM events WHERE {_K} % 10 <> 8) WHERE rn = 1 AND {_K} % 10 <> 9""",
)
def customer_state(spark, sf):
    """Customer events through projection, operation routing, upsert and delete."""
    rows = enrich.project_customers(customer_envelopes(spark, sf), as_of_literal(AS_OF))
    rows = rows.withColumn("op", envelope.customer_operation(F.col("event_type"))).filter("op <> 'none'")
    latest = state.without_deleted(state.upsert(rows, ["customer_id"]), F.col("op") == "delete")
    return latest.select("customer_id", "orders_count", F.col("_event_id").alias("event_id"))


@query(
    "state_ttl",
    f"""SELECT user_id, event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) + 86400 AS ttl
FROM ({_LATEST}) WHERE rn = 1 AND CAST(epoch(date_trunc('second', ts)) AS BIGINT) + 86400
  > epoch(TIMESTAMP '2024-01-31')""",
)
def state_ttl(spark, sf):
    """Rows that expire a day after their event, as of a fixed instant."""
    latest = state.upsert(table(spark, sf, "events").select("user_id", "event_id", "ts"), ["user_id"], ORDER)
    rows = enrich.with_ttl(latest, F.col("ts").cast("timestamp"), 1)
    return state.alive(rows, as_of_literal(AS_OF)).select("user_id", "event_id", "ttl")


@query(
    "recent_orders",
    """SELECT event_id, CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'not a date'
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at
FROM events WHERE event_id % 9 < 2 OR date_trunc('second', ts) >= TIMESTAMP '2024-01-28'""",
)
def recent_orders(spark, sf):
    """Missing and unreadable dates count as recent."""
    shape = F.col("event_id") % 9
    rows = table(spark, sf, "events").select(
        "event_id", F.when(shape == 1, "not a date").when(shape > 1, F.date_format("ts", ISO)).alias("created_at")
    )
    return enrich.recent_only(rows, as_of_literal(AS_OF), days=3)


@query(
    "change_feed",
    """SELECT event_id, user_id, lag(event_type) OVER w AS old_type, lag(value) OVER w AS old_value,
  lag(event_id) OVER w AS old_event, event_type AS new_type, value AS new_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def change_feed(spark, sf):
    """Every event with the image it replaced."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    feed = state.change_feed(events, "user_id", "ts", "event_id", ["event_id", "event_type", "value"])
    return feed.select(
        "event_id",
        "user_id",
        F.col("old_image.event_type").alias("old_type"),
        F.col("old_image.value").alias("old_value"),
        F.col("old_image.event_id").alias("old_event"),
        F.col("new_image.event_type").alias("new_type"),
        F.col("new_image.value").alias("new_value"),
    )


@query(
    "state_lookup_secondary",
    """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def state_lookup_secondary(spark, sf):
    """Latest order per customer, looked up by a list of priorities and by a table of customers."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    latest = state.upsert(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    wanted = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    found = state.look_up(state.look_up(latest, "o_orderpriority", ["1-URGENT", "2-HIGH"]), "o_custkey", wanted)
    return found.select(
        "o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority"
    )


def _checkouts(spark, sf):
    return enrich.project_checkouts(checkout_envelopes(spark, sf), as_of_literal(AS_OF))


_CHECKOUTS = f"""SELECT 'tok-' || user_id AS checkout_token, CAST(event_id AS VARCHAR) AS event_id,
  CAST({_K} * 2 AS VARCHAR) AS total_price, {_K} % 4 = 0 AS done,
  row_number() OVER (PARTITION BY user_id, {{by}} ORDER BY date_trunc('second', ts) DESC, CAST(event_id AS VARCHAR) DESC) AS rn
FROM events"""


@query(
    "abandoned_checkouts",
    f"""SELECT checkout_token, event_id, total_price FROM ({_CHECKOUTS.format(by=f"{_K} % 4 = 0")})
WHERE rn = 1 AND NOT done""",
)
def abandoned_checkouts(spark, sf):
    """Newest open version per checkout; completion does not clear it."""
    rows = state.abandoned_checkouts(_checkouts(spark, sf))
    return rows.select("checkout_token", F.col("_event_id").alias("event_id"), "total_price")


@query(
    "abandoned_checkouts_cleared",
    f"""SELECT checkout_token, event_id, total_price FROM ({_CHECKOUTS.format(by="1 = 1")})
WHERE rn = 1 AND NOT done""",
)
def abandoned_checkouts_cleared(spark, sf):
    """Checkouts whose newest version is complete are cleared."""
    rows = state.abandoned_checkouts(_checkouts(spark, sf), clear_on_complete=True)
    return rows.select("checkout_token", F.col("_event_id").alias("event_id"), "total_price")

