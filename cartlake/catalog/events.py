"""Transport, routing and signature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.catalog.registry import props_k, query, table
from cartlake.functions import signature
from cartlake.operators import envelope

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"

TOPICS = [
    "orders/create",
    "orders/delete",
    "draft_orders/update",
    "refunds/create",
    "subscription_contracts/create",
    "fulfillments/create",
    "fulfillment_orders/moved",
    "customers/create",
    "customers/update",
    "customers/delete",
    "customer_payment_methods/create",
    "products/update",
    "inventory_levels/update",
    "carts/update",
    "checkouts/create",
    "themes/publish",
    "orders",
    "subscription/cancelled",
    "charge/failed",
    "plan/subscription_moved",
    "charge.failed",
    "charge.dispute.created",
    "payment_intent.succeeded",
    "invoice.paid",
    "payout.paid",
]


def pick(values: list[str], index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sql_pick(values: list[str], index: str) -> str:
    inner = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{inner}], CAST({index} AS INTEGER) + 1)"


@query(
    "route_topics",
    f"""WITH t AS (SELECT event_id, {sql_pick(TOPICS, f"event_id % {len(TOPICS)}")} AS topic FROM events)
SELECT event_id, topic,
  CASE WHEN regexp_matches(topic, '^(orders|draft_orders|refunds|returns|disputes|bulk_operations)/') THEN 'orders'
    WHEN regexp_matches(topic, '^subscription_(contracts|billing_attempts|billing_cycle_edits|billing_cycles)/')
      THEN 'orders'
    WHEN regexp_matches(topic, '^(fulfillments|fulfillment_orders)/') THEN 'fulfillments'
    WHEN regexp_matches(topic, '^(customers|customer_payment_methods)/') THEN 'customers'
    WHEN regexp_matches(topic, '^(products|inventory_items|inventory_levels|locations|markets)/') THEN 'products'
    WHEN regexp_matches(topic, '^(carts|checkouts)/') THEN 'carts' ELSE 'other' END AS entity,
  CASE WHEN topic LIKE '%checkout%' THEN 'checkouts' ELSE 'carts' END AS cart_stream,
  CASE WHEN topic LIKE '%subscription%' THEN 'subscriptions' WHEN topic LIKE '%charge%' THEN 'charges'
    ELSE 'other' END AS subscription_folder,
  CASE WHEN topic LIKE 'subscription/%' THEN 'subscriptions' WHEN topic LIKE 'charge/%' THEN 'charges'
    ELSE 'none' END AS subscription_state,
  CASE WHEN topic LIKE '%charge%' AND topic NOT LIKE '%dispute%' THEN 'charges'
    WHEN topic LIKE '%payment\\_intent%' ESCAPE '\\' THEN 'payment_intents' WHEN topic LIKE '%invoice%' THEN 'invoices'
    WHEN topic LIKE '%dispute%' THEN 'disputes' ELSE 'other' END AS payment_folder,
  CASE topic WHEN 'customers/create' THEN 'upsert' WHEN 'customers/update' THEN 'upsert'
    WHEN 'customers/delete' THEN 'delete' ELSE 'none' END AS customer_operation
FROM t""",
)
def route_topics(spark, sf):
    topic = F.col("topic")
    events = table(spark, sf, "events").select(
        "event_id", pick(TOPICS, F.col("event_id") % len(TOPICS)).alias("topic")
    )
    return events.select(
        "event_id",
        "topic",
        envelope.route_entity(topic).alias("entity"),
        envelope.route_cart(topic).alias("cart_stream"),
        envelope.route_subscription(topic).alias("subscription_folder"),
        F.coalesce(envelope.subscription_state_table(topic), F.lit("none")).alias("subscription_state"),
        envelope.route_payment(topic).alias("payment_folder"),
        envelope.customer_operation(topic).alias("customer_operation"),
    )


def transport_lines(spark, sf):
    """Each event as one captured line, in five shapes; every fifth line is cut off."""
    e = table(spark, sf, "events").withColumn("k", props_k())
    when = F.date_format("ts", ISO)
    later = F.date_format(F.col("ts") + F.expr("interval 1 hour"), ISO)
    payload = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id"), F.col("k")))
    named = F.to_json(
        F.create_map(F.lit(envelope.TOPIC_HEADER), F.lit("orders/create"), F.lit(envelope.TRIGGERED_HEADER), later)
    )
    shape = F.col("event_id") % 5
    wrapped = lambda p, m: F.concat(F.lit('{"payload":'), p, F.lit(',"metadata":'), m, F.lit("}"))
    detail = (
        F.when(shape == 0, wrapped(payload, named))
        .when(shape == 1, payload)
        .when(shape == 2, wrapped(F.lit("null"), F.lit("{}")))
        .otherwise(wrapped(payload, F.lit("{}")))
    )
    head = F.concat(
        F.lit('{"id":"evt-'), F.col("event_id").cast("string"), F.lit('","detail-type":"storeEvent","time":"'), when, F.lit('"')
    )
    line = F.when(shape == 3, F.concat(head, F.lit(',"detail'))).otherwise(
        F.concat(head, F.lit(',"detail":'), detail, F.lit("}"))
    )
    return e.select(line.alias("line"))


def parse_lines(lines):
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    return lines.select(F.from_json("line", schemas.TRANSPORT_EVENT, options).alias("e")).select("e.*")


@query(
    "extract_payload",
    """SELECT CASE WHEN event_id % 5 = 3 THEN NULL ELSE 'evt-' || event_id END AS event_id,
  CASE event_id % 5 WHEN 0 THEN 'orders/create' WHEN 3 THEN NULL ELSE 'storeEvent' END AS event_type,
  CASE event_id % 5 WHEN 0 THEN strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') WHEN 3 THEN NULL
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_time,
  CASE WHEN event_id % 5 IN (0, 1, 4) THEN CAST(event_id AS VARCHAR) END AS payload_id,
  CASE event_id % 5 WHEN 0 THEN 'orders/create' END AS metadata_topic,
  CASE event_id % 5 WHEN 2 THEN 'empty_payload' WHEN 3 THEN 'malformed_json' END AS reason
FROM events""",
)
def extract_payload(spark, sf):
    """Lines of every shape to envelopes, with the reason of those that are rejected."""
    env = envelope.extract_payload(parse_lines(transport_lines(spark, sf)))
    return env.select(
        "event_id",
        "event_type",
        "event_time",
        F.get_json_object("data", "$.id").alias("payload_id"),
        F.col("metadata")[envelope.TOPIC_HEADER].alias("metadata_topic"),
        envelope.quarantine_reason(env).alias("reason"),
    )


DEMO_KEY = "demo-signing-key"
LONG_KEY = "k" * 80


def _hex_pad(key: str, byte: int) -> str:
    return "".join(f"\\x{b ^ byte:02X}" for b in key.encode().ljust(64, b"\0"))


def hmac_sql(text: str, key: str = DEMO_KEY) -> str:
    inner = f"unhex(sha256('{_hex_pad(key, 0x36)}'::BLOB || encode({text})))"
    return f"sha256('{_hex_pad(key, 0x5C)}'::BLOB || {inner})"


@query(
    "hmac_signature",
    f"""WITH d AS (SELECT doc_id, text, {hmac_sql("text")} AS expected FROM documents)
SELECT doc_id, expected, CASE WHEN length(text) > 0 THEN doc_id % 3 = 0 ELSE FALSE END AS valid FROM d""",
)
def hmac_signature(spark, sf):
    """Whole texts as request bodies; a third signed rightly, a third wrongly, a third not at all."""
    text, i = F.col("text"), F.col("doc_id") % 3
    expected = signature.hmac_sha256_hex(text, DEMO_KEY)
    header = F.when(i == 0, expected).when(i == 1, F.reverse(expected))
    return table(spark, sf, "documents").select(
        "doc_id", expected.alias("expected"), signature.body_signature_valid(text, header, DEMO_KEY).alias("valid")
    )


@query(
    "gateway_signature",
    f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'bad_payload' ELSE 'bad_signature' END AS reason,
  {hmac_sql("CAST(epoch(date_trunc('second', ts)) AS BIGINT) || '.' || props")} AS signature
FROM events""",
)
def gateway_signature(spark, sf):
    """Timestamped headers: genuine, not JSON, tampered, and signed with the wrong time."""
    e = table(spark, sf, "events")
    stamp = F.unix_timestamp("ts").cast("string")
    shape = F.col("event_id") % 4
    body = F.when(shape == 1, "not json").when(shape == 2, F.concat("props", F.lit(" "))).otherwise(F.col("props"))
    signed = F.when(shape == 1, F.lit("not json")).otherwise(F.col("props"))
    own = signature.hmac_sha256_hex(F.concat(stamp, F.lit("."), signed), DEMO_KEY)
    claimed = F.when(shape == 3, F.lit("1")).otherwise(stamp)
    header = F.concat(F.lit("t="), claimed, F.lit(", v0=zz, v1="), own)
    return e.select(
        "event_id",
        signature.gateway_signature_reason(body, header, DEMO_KEY).alias("reason"),
        signature.hmac_sha256_hex(F.concat(stamp, F.lit("."), F.col("props")), DEMO_KEY).alias("signature"),
    )


@query(
    "metadata_of_payload",
    """SELECT event_type, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, count(*) AS n
FROM events GROUP BY 1, 2""",
)
def metadata_of_payload(spark, sf):
    """Fields of a parsed payload next to type and time, then counted."""
    landed = table(spark, sf, "events").select(
        "event_type", F.col("ts").alias("event_time"), F.from_json("props", "k bigint").alias("data")
    )
    return envelope.payload_columns(landed).groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))

