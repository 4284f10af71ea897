"""Queries that write through a sink into the shared folder and read the result back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.catalog import facts
from cartlake.catalog.events import ISO, TOPICS, parse_lines, pick, sql_pick, transport_lines
from cartlake.catalog.enrichment import enriched
from cartlake.catalog.kpi import shown
from cartlake.catalog.registry import plain, props_k, query, table
from cartlake.operators import curated, envelope, state
from cartlake.plans import bulk_load, kpi_refresh
from cartlake.session import shared_dir
from cartlake.sinks import writers
from cartlake.sources import readers
from cartlake.streaming import jobs

_TOPIC = sql_pick(TOPICS, f"event_id % {len(TOPICS)}")
_K = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"


def store_envelopes(spark, sf):
    """Events as landed envelopes: event time in the payload's zone, arrival some minutes later."""
    e = table(spark, sf, "events").withColumn("k", props_k())
    arrival = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k"))
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        pick(TOPICS, F.col("event_id") % len(TOPICS)).alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-04:00'").alias("event_time"),
        F.date_format(arrival, ISO).alias("ingested_at"),
        F.to_json(F.struct(F.col("event_id").alias("id"), "k")).alias("data"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


_ENTITY = f"""CASE WHEN regexp_matches({_TOPIC}, '^(orders|draft_orders|refunds|returns|disputes|bulk_operations)/') THEN 'orders'
    WHEN regexp_matches({_TOPIC}, '^subscription_(contracts|billing_attempts|billing_cycle_edits|billing_cycles)/') THEN 'orders'
    WHEN regexp_matches({_TOPIC}, '^(fulfillments|fulfillment_orders)/') THEN 'fulfillments'
    WHEN regexp_matches({_TOPIC}, '^(customers|customer_payment_methods)/') THEN 'customers'
    WHEN regexp_matches({_TOPIC}, '^(products|inventory_items|inventory_levels|locations|markets)/') THEN 'products'
    WHEN regexp_matches({_TOPIC}, '^(carts|checkouts)/') THEN 'carts' ELSE 'other' END"""


@query(
    "raw_landing",
    f"""SELECT {_ENTITY} AS entity, strftime(ts + INTERVAL 4 HOUR, '%Y-%m-%d') AS date, count(*) AS events,
  CAST(sum({_K}) AS BIGINT) AS k_total
FROM events GROUP BY 1, 2""",
)
def raw_landing(spark, sf):
    """Envelopes landed by event time and entity, read back by partition."""
    path = shared_dir(spark, "raw")
    entity = envelope.route_entity(F.col("event_type"))
    writers.land_raw(store_envelopes(spark, sf), path, entity, by_hour=False)
    landed = readers.read_landed(spark, path)
    return landed.groupBy("entity", "date").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.get_json_object("data", "$.k").cast("bigint")).alias("k_total")
    )


@query(
    "raw_landing_arrival",
    f"""SELECT CASE WHEN {_TOPIC} LIKE '%charge%' AND {_TOPIC} NOT LIKE '%dispute%' THEN 'charges'
    WHEN {_TOPIC} LIKE '%payment\\_intent%' ESCAPE '\\' THEN 'payment_intents' WHEN {_TOPIC} LIKE '%invoice%' THEN 'invoices'
    WHEN {_TOPIC} LIKE '%dispute%' THEN 'disputes' ELSE 'other' END AS entity,
  strftime(date_trunc('second', ts) + to_minutes({_K}), '%Y-%m-%d') AS date, count(*) AS events
FROM events WHERE strftime(date_trunc('second', ts) + to_minutes({_K}), '%Y-%m-%d') = '2024-01-15' GROUP BY 1, 2""",
)
def raw_landing_arrival(spark, sf):
    """Gateway events landed by arrival; one date read with partition pruning."""
    path = shared_dir(spark, "raw-payments")
    folder = envelope.route_payment(F.col("event_type"))
    writers.land_raw(store_envelopes(spark, sf), path, folder, clock="arrival", by_hour=False)
    landed = readers.read_landed(spark, path, date="2024-01-15")
    return landed.groupBy("entity", "date").agg(F.count(F.lit(1)).alias("events"))


@query(
    "quarantine_replay",
    """SELECT CASE event_id % 5 WHEN 2 THEN 'empty_payload' ELSE 'repaired' END AS outcome, count(*) AS events
FROM events WHERE event_id % 5 IN (2, 3) GROUP BY 1""",
)
def quarantine_replay(spark, sf):
    """Rejected lines written aside, repaired where the text allows it and run again."""
    path = shared_dir(spark, "quarantine")
    _, bad = envelope.split_quarantine(envelope.extract_payload(parse_lines(transport_lines(spark, sf))))
    writers.write_quarantine(bad, path)
    cut = F.col(schemas.CORRUPT)

    def repair(waiting):
        body = F.concat(F.regexp_replace(cut, ',"detail$', ""), F.lit(',"detail":{"repaired":true}}'))
        fixed = envelope.extract_payload(parse_lines(waiting.filter(cut.isNotNull()).select(body.alias("line"))))
        return fixed.unionByName(waiting.filter(cut.isNull()), allowMissingColumns=True)

    left = shared_dir(spark, "quarantine")
    good, _ = jobs.replay_quarantine(readers.read_quarantine(spark, path), repair, left)
    rest = readers.read_quarantine(spark, left)
    outcome = good.select(F.lit("repaired").alias("outcome")).unionByName(rest.select(F.col("reason").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("events"))


def _export_lines(spark, sf):
    """Orders as export lines, with a blank and a cut-off line after every 50th."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    amount = F.struct(
        F.struct(
            F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"), F.lit("USD").alias("currencyCode")
        ).alias("shopMoney")
    )
    line = F.to_json(
        F.struct(
            F.concat(F.lit("gid://store/Order/"), F.col("o_orderkey").cast("string")).alias("id"),
            F.date_format("o_orderdate", ISO).alias("createdAt"),
            F.date_format("o_orderdate", ISO).alias("updatedAt"),
            amount.alias("totalPriceSet"),
            F.when(F.col("o_orderkey") % 7 == 0, "subscription").alias("tags"),
            F.struct(
                F.concat(F.lit("gid://store/Customer/"), F.col("o_custkey").cast("string")).alias("id"),
                F.col("c_name").alias("firstName"),
            ).alias("customer"),
            F.array(F.struct(F.lit("f1").alias("id"), F.col("o_orderstatus").alias("status"))).alias("fulfillments"),
        )
    )
    lines = F.when(F.col("o_orderkey") % 50 == 0, F.array(line, F.lit(""), F.lit('{"id": "gid'))).otherwise(F.array(line))
    return o.select(F.explode(lines).alias("value"))


_SNAPSHOT = """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  c_name AS customer_first_name, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_price, 'USD' AS currency,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
  CASE WHEN o_orderkey % 7 = 0 THEN 'subscription' END AS tags, '2024-01-31' AS date
FROM orders JOIN customer ON o_custkey = c_custkey"""


def _snapshot(spark, sf):
    export, path = shared_dir(spark, "export"), shared_dir(spark, "snapshots")
    _export_lines(spark, sf).write.option("compression", "gzip").text(export)
    bulk_load.load_export(spark, export, path, "2024-01-31")
    return readers.read_snapshots(spark, path, "2024-01-31")


@query("bulk_snapshot", _SNAPSHOT)
def bulk_snapshot(spark, sf):
    """Gzip JSONL export to a flattened parquet snapshot, read back under event names."""
    rows = state.normalise_snapshot(_snapshot(spark, sf))
    return plain(
        rows.select(
            *"order_id customer_id customer_first_name total_price currency created_at tags".split(),
            F.col("date").cast("string").alias("date"),
        )
    )


@query(
    "combine_sources",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN o_orderstatus = 'F' THEN 'event' ELSE 'snapshot' END AS origin,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def combine_sources(spark, sf):
    """Snapshot rows and later events of finished orders, newest kept."""
    snapshots = state.normalise_snapshot(_snapshot(spark, sf)).withColumn("origin", F.lit("snapshot"))
    events = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.date_format(F.col("o_orderdate") + F.expr("interval 1 day"), ISO).alias("updated_at"),
            (F.col("o_totalprice").cast("decimal(18,2)") + 1).cast("decimal(18,4)").alias("total_price"),
            F.lit("event").alias("origin"),
        )
    )
    latest = state.dedupe_orders(
        state.combine_orders(events, snapshots.select("order_id", "updated_at", "total_price", "origin"))
    )
    return plain(latest.select("order_id", "origin", "total_price"))


RANGE = (date(2023, 12, 31), date(2024, 1, 31))
_HOURLY_ALL = (
    f"WITH {facts.METRICS_SQL},\n{facts.hourly_sql()}\n"
    f"SELECT {facts.shown_sql(schemas.HOURLY_TABLE.names, facts.HOURLY_SHOWN)}, "
    "strftime(local_date, '%Y') AS year, strftime(local_date, '%m') AS month, strftime(local_date, '%d') AS day "
    "FROM hourly"
)


def _refresh(spark, sf, **options):
    path = shared_dir(spark, "hourly")
    info = kpi_refresh.refresh(
        facts.orders_fact(spark, sf),
        facts.ads_fact(spark, sf),
        *RANGE,
        facts.STORE_ZONE,
        path,
        facts.ACCOUNTS,
        **options,
    )
    return path, info


@query("kpi_table_parquet", _HOURLY_ALL)
def kpi_table_parquet(spark, sf):
    """Refresh into parquet by day and region, read through the defined table."""
    _refresh(spark, sf, output_format="parquet", table="kpi_hourly")
    return shown(spark.table("kpi_hourly"))


@query("kpi_table_csv", _HOURLY_ALL)
def kpi_table_csv(spark, sf):
    """Refresh into gzip CSV by day and region, read back with the table schema."""
    path, _ = _refresh(spark, sf, output_format="csv")
    return shown(writers.read_kpi(spark, path, "csv"))


@query(
    "kpi_manifest",
    f"""WITH {facts.METRICS_SQL},\n{facts.hourly_sql()},
p AS (SELECT DISTINCT 'year=' || strftime(local_date, '%Y') || '/month=' || strftime(local_date, '%m') || '/day='
  || strftime(local_date, '%d') || '/region=' || region AS part FROM hourly)
SELECT (SELECT count(*) FROM hourly) AS row_count, '2023-12-31' AS start_date, '2024-01-31' AS end_date,
  (SELECT string_agg(part, ',' ORDER BY part) FROM p) AS partitions, 'parquet' AS output_format,
  FALSE AS partition_by_hour""",
)
def kpi_manifest(spark, sf):
    """What a refresh says it has written."""
    _, info = _refresh(spark, sf, output_format="parquet")
    return info["manifest"].drop("written_at").withColumn("partitions", F.array_join("partitions", ","))


@query(
    "table_partitions",
    """SELECT DISTINCT 'day=' || strftime(ts, '%Y-%m-%d') || '/event_type=' || event_type AS partition FROM events""",
)
def table_partitions(spark, sf):
    """Partitions found by a repair of an external table."""
    path = shared_dir(spark, "events-table")
    events = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    columns = ["day", "event_type"]
    writers.rebalanced(events, columns).write.partitionBy(*columns).parquet(path)
    writers.define_table(spark, "events_by_day", events.schema, columns, path)
    return writers.partition_values(spark, "events_by_day")


@query(
    "orders_date_overwrite",
    """SELECT '2024-01-01' AS date, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders
UNION ALL SELECT '2024-01-02', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
FROM orders WHERE o_orderstatus = 'O'""",
)
def orders_date_overwrite(spark, sf):
    """Two dates written, one of them again: the other stays as it was."""
    path = shared_dir(spark, "processed")
    orders = table(spark, sf, "orders").withColumn("total", F.col("o_totalprice").cast("decimal(18,2)"))
    writers.write_orders(orders, path, "2024-01-01")
    writers.write_orders(orders.filter("o_orderstatus = 'F'"), path, "2024-01-02")
    writers.write_orders(orders.filter("o_orderstatus = 'O'"), path, "2024-01-02")
    written = spark.read.schema("total decimal(18,2), date string").parquet(path)
    return plain(written.groupBy("date").agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("revenue")))


@query(
    "subscription_orders_write",
    """WITH kinds AS (SELECT l_orderkey, p_type AS sku, sum(CAST(l_quantity AS BIGINT)) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
items AS (SELECT l_orderkey, bool_or(sku = 'PROMO') AS has_promo,
    arg_min(CASE WHEN sku = 'ECONOMY' THEN 'monthly' ELSE 'quarterly' END, {'q': -quantity, 's': sku})
      FILTER (WHERE sku IN ('ECONOMY', 'STANDARD', 'LARGE')) AS rhythm
  FROM kinds GROUP BY 1)
SELECT coalesce(rhythm, 'monthly') AS subscription_type, '2024-01-31' AS date, count(*) AS orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders LEFT JOIN items ON o_orderkey = l_orderkey
WHERE o_orderkey % 7 IN (0, 1) OR coalesce(has_promo, FALSE) GROUP BY 1""",
)
def subscription_orders_write(spark, sf):
    """Subscription orders split by type in one write."""
    path = shared_dir(spark, "subscription-orders")
    writers.write_subscription_orders(enriched(spark, sf), path, "2024-01-31")
    written = spark.read.schema("total_price decimal(18,4), subscription_type string, date string").parquet(path)
    return plain(
        written.groupBy("subscription_type", "date").agg(
            F.count(F.lit(1)).alias("orders"), F.sum("total_price").alias("revenue")
        )
    )


@query(
    "report_export",
    """SELECT f AS format, o_orderpriority AS source_name, count(DISTINCT o_orderkey) AS orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders, (SELECT unnest(['csv', 'json']) AS f) GROUP BY 1, 2""",
)
def report_export(spark, sf):
    """A report written as CSV and as JSON records, read back from both."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_price"),
        F.col("o_orderpriority").alias("source_name"),
    )
    report = curated.revenue_by_source(o).select("source_name", "orders", "revenue")
    out = None
    for kind in ("csv", "json"):
        path = shared_dir(spark, f"report-{kind}")
        writers.export_report(report, path, kind)
        reader = spark.read.schema("source_name string, orders bigint, revenue decimal(28,2)")
        back = reader.option("header", True).csv(path) if kind == "csv" else reader.json(path)
        back = back.select(F.lit(kind).alias("format"), "*")
        out = back if out is None else out.unionByName(back)
    return plain(out)


@query(
    "quality_document_write",
    """SELECT '2024-01-30' AS date, c AS "check" FROM (
  SELECT unnest(['hourly_data_gaps', 'order_count_anomaly', 'state_table_health']) AS c) WHERE (SELECT count(*) FROM events) > 0""",
)
def quality_document_write(spark, sf):
    """The quality document under its date, read back."""
    from cartlake.catalog.quality import AS_OF, all_checks
    from cartlake.operators.quality import quality_result

    path = shared_dir(spark, "quality")
    writers.write_quality(quality_result(all_checks(spark, sf), F.lit(AS_OF).cast("timestamp")), path)
    back = spark.read.schema(f"timestamp string, checks array<{schemas.QUALITY_CHECK}>, date string").json(path)
    return back.select("date", F.explode("checks").alias("c")).select("date", F.col("c.check").alias("check"))
