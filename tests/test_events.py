"""Transport events, routing, enrichment and projections on hand-made payloads."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.catalog.events import parse_lines
from cartlake.operators import alerts, enrich, envelope, state
from cartlake.operators.state import as_of_literal

NOW = lambda: as_of_literal("2025-10-03 20:00:00")
SKUS = ["plan_monthly", " ", "plan_quarterly"]


def envelopes(spark, payloads, event_type="orders/create", time="2025-10-03T16:00:00Z"):
    rows = [
        (f"e{i}", event_type, time, time, p if p is None or isinstance(p, str) else json.dumps(p), {})
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def lines(spark, *events):
    text = [(e if isinstance(e, str) else json.dumps(e),) for e in events]
    return envelope.extract_payload(parse_lines(spark.createDataFrame(text, "line string")))


def test_both_shapes_and_rejects(spark):
    meta = {envelope.TOPIC_HEADER: "orders/paid", envelope.TRIGGERED_HEADER: "2025-01-01T00:00:00Z"}
    base = {"id": "1", "detail-type": "storeEvent", "time": "2025-02-02T00:00:00Z"}
    rows = lines(
        spark,
        {**base, "detail": {"payload": {"id": 5}, "metadata": meta}},
        {**base, "detail": {"id": 6, "nested": {"a": [1]}}},
        {**base, "detail": {"payload": {"id": 7}, "metadata": None}},
        {**base, "detail": {"payload": None}},
        {**base, "detail": {}},
        {**base, "detail": None},
        {"id": "2", "detail": {"id": 8}},
        '{"id": "3", "detail',
    )
    got = rows.withColumn("reason", envelope.quarantine_reason(rows)).collect()
    assert [(r.event_type, r.event_time) for r in got[:3]] == [
        ("orders/paid", "2025-01-01T00:00:00Z"),
        ("storeEvent", "2025-02-02T00:00:00Z"),
        ("storeEvent", "2025-02-02T00:00:00Z"),
    ]
    assert json.loads(got[1].data) == {"id": 6, "nested": {"a": [1]}} and got[0].metadata == meta
    assert [r.reason for r in got] == [
        None, None, None, "empty_payload", "empty_payload", "empty_payload", "missing_event_type", "malformed_json",
    ]
    good, bad = envelope.split_quarantine(rows)
    assert good.count() == 3 and bad.count() == 5 and "_corrupt_record" not in good.columns


def test_routes(spark):
    topics = ["orders/create", "ordersx/create", "markets/update", "orders", None, "checkouts/create", "nothing/known"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(topics)], "i int, t string").orderBy("i")
    t = F.col("t")
    assert [r[0] for r in df.select(envelope.route_entity(t)).collect()] == [
        "orders", "other", "products", "other", "other", "carts", "other",
    ]
    assert [r[0] for r in df.select(envelope.route_cart(t)).collect()][5:] == ["checkouts", "carts"]


def test_landing_partition_is_utc(spark):
    rows = envelopes(spark, [{"id": 1}], time="2025-10-03T23:30:00-04:00")
    r = envelope.landing_partitions(rows).first()
    assert (r.date, r.hour) == ("2025-10-04", "03")


def order(**changes):
    base = {
        "id": 9999999999999,
        "created_at": "2025-10-03T12:00:00-04:00",
        "total_price": "99.99",
        "subtotal_price": "89.99",
        "total_tax": "10.00",
        "tags": "subscription, monthly",
        "line_items": [{"id": 1, "sku": "PLAN_Monthly", "quantity": 1}],
        "customer": {"id": 77, "email": "a@example.com", "phone": ""},
        "shipping_address": {"province": "TX", "country": "US", "phone": "+1"},
    }
    return {k: v for k, v in {**base, **changes}.items() if v is not ...}


def enriched(spark, *orders):
    return enrich.enrich_orders(envelopes(spark, list(orders)), SKUS, "demo", NOW()).orderBy("_event_id").collect()


def test_order_golden(spark):
    (r,) = enriched(spark, order())
    assert r.order_id == "9999999999999" and r.customer_id == "77" and r.customer_phone == "+1"
    assert (float(r.total_price), float(r.subtotal_price), float(r.total_tax)) == (99.99, 89.99, 10.0)
    assert (r.is_subscription, r.subscription_type, r.line_item_count, r.total_quantity) == (True, "monthly", 1, 1)
    assert (r.currency, r.test, r.discount_codes, r._brand) == ("USD", False, "[]", "demo")
    assert json.loads(r.line_items) == [{"id": 1, "sku": "PLAN_Monthly", "quantity": 1}]
    names = [c for c in r.asDict() if c not in ("_event_id", "_event_time", "_landed_at")]
    assert len(names) == 72


def test_order_edges(spark):
    item = lambda sku, **k: {"sku": sku, **k}
    got = enriched(
        spark,
        order(customer=None, shipping_address=None, tags=...),
        order(tags=..., line_items=[]),
        order(tags="", line_items=[item("x_quarterly")]),
        order(tags="RECURRING", line_items=[item("pack-3X", quantity=4), item("plan_monthly")]),
        order(tags=None, line_items=[item(None), item("my-PLAN_quarterly-1", quantity=2)]),
        order(tags="recurring", line_items=...),
        order(created_at=..., total_price=None, subtotal_price="", currency=None, total_tax=3),
    )
    flags = [(r.is_subscription, r.subscription_type, r.line_item_count, r.total_quantity) for r in got]
    assert flags == [
        (True, "monthly", 1, 1),
        (False, None, 0, 0),
        (False, None, 1, 0),
        (True, "quarterly", 2, 4),
        (True, "quarterly", 2, 2),
        (True, "monthly", 0, 0),
        (True, "monthly", 1, 1),
    ]
    assert got[0].customer_id is None and got[0].tags == "" and got[0].shipping_city is None
    last = got[6]
    assert last.created_at == "2025-10-03T16:00:00Z" and last.currency == "USD"
    assert (float(last.total_price), float(last.subtotal_price), float(last.total_tax)) == (0, 0, 3)


def test_recency_keeps_unreadable_dates(spark):
    rows = [("new", "2025-10-01T00:00:00Z"), ("edge", "2025-09-03T20:00:00Z"), ("old", "2025-09-03T19:59:59Z"), ("bad", "x"), ("none", None)]
    df = spark.createDataFrame(rows, "n string, created_at string")
    assert {r.n for r in enrich.recent_only(df, NOW()).collect()} == {"new", "edge", "bad", "none"}


def test_order_state_ignores_other_topics_and_can_delete(spark):
    def version(i, kind, when):
        return (f"e{i}", kind, when, when, json.dumps(order(id=1)), {})

    rows = spark.createDataFrame(
        [
            version(1, "orders/create", "2025-10-03T10:00:00Z"),
            version(2, "refunds/create", "2025-10-03T12:00:00Z"),
            version(3, "orders/delete", "2025-10-03T09:00:00-04:00"),  # 13:00Z, the newest
        ],
        schemas.ENVELOPE,
    )
    out = enrich.enrich_orders(rows, SKUS, "demo", NOW())
    assert [r.event_type for r in state.order_state(out).collect()] == ["orders/delete"]
    assert state.order_state(out, tombstones=True).count() == 0


def test_gateway_amounts_and_alert_limit(spark):
    def charge(i, amount, kind="charge.failed", **extra):
        data = {"data": {"object": {"id": f"ch{i}", "amount": amount, "currency": "usd", "status": "failed", "created": 1700000000, **extra}}}
        return (f"e{i}", kind, None, "2025-01-01T00:00:00Z", json.dumps(data), {})

    rows = spark.createDataFrame(
        [charge(1, 10000), charge(2, 10001, metadata={"order_id": "o"}), charge(3, 99999, "charge.succeeded")], schemas.ENVELOPE
    )
    paid = enrich.project_payment_charges(rows, NOW())
    by_id = {r.charge_id: r for r in paid.collect()}
    assert float(by_id["ch2"].amount) == 100.01 and by_id["ch2"].currency == "USD" and by_id["ch2"].shopify_order_id == "o"
    assert by_id["ch1"].created == datetime(2023, 11, 14, 22, 13, 20)
    (alert,) = alerts.high_value_failures(paid).collect()
    assert alert.record_id == "ch2" and alert.subject == "High-Value Payment Failure $100.01"


def test_repeat_failure_needs_two_attempts(spark):
    rows = envelopes(
        spark, [{"id": 1}, {"id": 2, "billing_attempt_count": 1}, {"id": 3, "billing_attempt_count": 2}], "charge/failed"
    )
    got = alerts.repeat_failures(enrich.project_subscription_charges(rows, NOW())).collect()
    assert [r.record_id for r in got] == ["3"] and "Error: None (None)" in got[0].message


def test_request_envelopes(spark):
    body = json.dumps({"type": "subscription/created", "data": {"id": 4}})
    event = json.dumps({"id": "evt_9", "type": "invoice.paid", "data": {"object": {"id": "in_1"}}})
    requests = spark.createDataFrame(
        [("r1", "2025-01-01T00:00:00Z", {}, body), ("r2", "2025-01-01T00:00:00Z", {}, event)],
        "request_id string, received_at string, headers map<string,string>, body string",
    )
    sub = envelope.subscription_envelope(requests).first()
    assert (sub.event_type, json.loads(sub.data)) == ("subscription/created", {"id": 4})
    pay = envelope.payment_envelope(requests).collect()[1]
    assert (pay.event_id, pay.event_type, pay.data) == ("evt_9", "invoice.paid", event)


def test_flatten_and_stringify(spark):
    df = spark.createDataFrame(
        [(1, {"x": 1}, [1, 2], ("a", ("b",)))], "id int, m map<string,int>, l array<int>, s struct<t:string,u:struct<v:string>>"
    )
    flat = enrich.flatten_one_level(df.drop("m"))
    assert flat.columns == ["id", "l", "s_t", "s_u"] and flat.first().l == "[1,2]"
    text = enrich.stringify_complex(df)
    assert text.columns == ["id", "s", "m", "l"] and text.first().m == '{"x":1}'
    with pytest.raises(ValueError):
        envelope.payload_columns(df)


def test_snapshot_names(spark):
    price = {"shopMoney": {"amount": "5.50", "currencyCode": "EUR"}}
    line = json.dumps({"id": "gid://store/Order/12", "totalPriceSet": price, "customer": {"id": "gid://store/Customer/3"}, "updatedAt": "2025-01-01T00:00:00Z"})
    df = spark.createDataFrame([(line,)], "v string").select(F.from_json("v", schemas.BULK_ORDER).alias("r")).select("r.*")
    r = state.normalise_snapshot(enrich.flatten_one_level(df)).first()
    assert (r.order_id, r.customer_id, float(r.total_price), r.currency, r.updated_at) == ("12", "3", 5.5, "EUR", "2025-01-01T00:00:00Z")
