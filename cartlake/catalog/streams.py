"""Streaming queries: the driver's events as a file stream, run until everything is read.

Each must give what its batch twin gives. Those that keep state of their own get the events in several arrivals, and
every run goes on from the checkpoint of the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.catalog import alerting
from cartlake.catalog.registry import ORACLES, TABLES, plain, props_k, query, table
from cartlake.operators.ranking import latest_per_key
from cartlake.session import shared_dir, streaming_session
from cartlake.sources import readers
from cartlake.streaming import expiry, jobs


def stream_events(session, sf):
    return readers.stream_files(session, sf, TABLES["events"], "parquet", glob="events.parquet")


def arrivals(spark, sf, order: list[int]) -> Iterator[str]:
    """A folder that gets all events, a slice of time after the other in this order; yields after each.

    Slices are as many as ``order`` has and equally wide; events without a time come with the first.
    """
    events, folder = table(spark, sf, "events"), shared_dir(spark, "arrivals")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    slices = len(order)
    for i in order:
        own = F.lit(True) if first is None else F.lit(False)
        if first is not None:
            width = (last - first) / slices
            own = (F.col("ts") >= first + width * i) | F.lit(i == 0)
            own = own & ((F.col("ts") < first + width * (i + 1)) | F.lit(i == slices - 1))
            own = F.coalesce(own, F.lit(i == 0))
        if first is not None or i == order[0]:
            events.filter(own).write.mode("append").parquet(folder)
        yield folder


def arrived(session, folder):
    return readers.stream_files(session, folder, TABLES["events"], "parquet")


def _session(spark):
    """State partitions follow the cores of the cluster; a checkpoint keeps its number."""
    return streaming_session(spark, max(8, spark.sparkContext.defaultParallelism))


@query("stream_state_upsert", ORACLES["state_upsert"])
def stream_state_upsert(spark, sf):
    """Latest event per user as a running aggregate; events out of order, the log compacted on the way."""
    s = _session(spark)
    path, folded, checkpoint = shared_dir(spark, "state"), shared_dir(spark, "folded"), shared_dir(spark, "ckpt")
    for folder in arrivals(spark, sf, [2, 0, 3, 1]):
        events = arrived(s, folder)
        jobs.upsert_stream(
            events, ["user_id"], ["ts", "event_id"], path, checkpoint, compacted=folded, compact_every=2
        ).awaitTermination()
    return plain(jobs.read_state(spark, path, events.schema, ["user_id"], folded))


@query("stream_alarm_5min", ORACLES["alarm_5min"])
def stream_alarm_5min(spark, sf):
    """5-minute alarm windows, each at its final value."""
    s = _session(spark)
    path = shared_dir(spark, "alarms")
    samples = alerting.with_samples(stream_events(s, sf))
    jobs.alarm_stream(samples, "ts", "source", F.col("errors"), path, shared_dir(spark, "ckpt")).awaitTermination()
    clock = T.TimestampType()
    fields = T.StructType(
        [
            T.StructField("window_start", clock),
            T.StructField("window_end", clock),
            T.StructField("metric", T.StringType()),
            T.StructField("value", T.LongType()),
        ]
    )
    return plain(jobs.read_state(spark, path, fields, ["window_start", "metric"]))


@query(
    "stream_dedupe",
    """SELECT event_id, user_id, event_type FROM events""",
)
def stream_dedupe(spark, sf):
    """Every event delivered up to three times, kept once."""
    s = _session(spark)
    path = shared_dir(spark, "unique")
    events = stream_events(s, sf).select("event_id", "user_id", "event_type", "ts")
    copies = F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int"))
    delivered = events.withColumn("copy", F.explode(copies)).drop("copy")
    jobs.dedupe_stream(delivered, "ts", "event_id", path, shared_dir(spark, "ckpt")).awaitTermination()
    return jobs.read_log(spark, path, events.schema).select("event_id", "user_id", "event_type")


@query("stream_change_feed", ORACLES["change_feed"])
def stream_change_feed(spark, sf):
    """Old and new image of every event, over several batches."""
    s = _session(spark)
    feed, tails, checkpoint = shared_dir(spark, "feed"), shared_dir(spark, "tails"), shared_dir(spark, "ckpt")
    images = ["event_id", "event_type", "value"]
    for folder in arrivals(spark, sf, [0, 1, 2, 3]):
        jobs.change_feed_stream(
            arrived(s, folder), "user_id", "ts", "event_id", images, feed, tails, checkpoint, full_every=2
        ).awaitTermination()
    rows = spark.read.parquet(feed)
    return rows.select(
        "event_id",
        "user_id",
        F.col("old_image.event_type").alias("old_type"),
        F.col("old_image.value").alias("old_value"),
        F.col("old_image.event_id").alias("old_event"),
        F.col("new_image.event_type").alias("new_type"),
        F.col("new_image.value").alias("new_value"),
    )


@query(
    "stream_state_ttl",
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, event_type FROM l
WHERE rn = 1 AND epoch_ms(ts) + 86400000 > (SELECT epoch_ms(max(ts)) - 3600000 FROM events)""",
)
def stream_state_ttl(spark, sf):
    """Latest event per user, gone a day after it; what is alive when the stream has been read, out of order."""
    live = expiry.read_live(spark, _expiring(spark, sf, [1, 0, 3, 2]))
    return live.select(F.col("key").alias("user_id"), F.col("sequence").alias("event_id"), "event_type")


def _expiring(spark, sf, order: list[int]) -> str:
    s = _session(spark)
    path, checkpoint = shared_dir(spark, "expiring"), shared_dir(spark, "ckpt")
    for folder in arrivals(spark, sf, order):
        expiry.expiring_state_stream(
            arrived(s, folder), "user_id", "ts", "event_id", 86400, ["event_type"], path, checkpoint
        ).awaitTermination()
    return path


@query(
    "stream_state_removals",
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_id,
  CASE WHEN epoch_ms(ts) + 86400000 > (SELECT epoch_ms(max(ts)) - 3600000 FROM events) THEN 'upsert' ELSE 'expired' END AS op
FROM l WHERE rn = 1""",
)
def stream_state_removals(spark, sf):
    """The last entry of every user in the expiring log: its newest event, or the removal of that."""
    log = spark.read.parquet(_expiring(spark, sf, [0, 1, 2, 3]))
    last = latest_per_key(log, ["key"], [*expiry.RANK, F.expr(f"op = '{expiry.EXPIRED}'").alias("gone")])
    return last.select(F.col("key").alias("user_id"), F.col("sequence").alias("event_id"), "op")


@query(
    "stream_landing",
    """SELECT CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'signup' THEN 'customers' ELSE 'other' END AS entity,
  strftime(ts, '%Y-%m-%d') AS date, count(*) AS events
FROM events WHERE event_id % 10 <> 0 GROUP BY 1, 2""",
)
def stream_landing(spark, sf):
    """Transport events to partitioned raw files; a tenth has no payload and goes to the quarantine."""
    s = _session(spark)
    path, rejected = shared_dir(spark, "raw-stream"), shared_dir(spark, "rejected")
    e = stream_events(s, sf).withColumn("k", props_k())
    topic = F.when(F.col("event_type") == "purchase", "orders/create").when(
        F.col("event_type") == "signup", "customers/create"
    ).otherwise(F.concat(F.lit("misc/"), F.col("event_type")))
    detail = F.when(F.col("event_id") % 10 == 0, "{}").otherwise(F.to_json(F.struct("event_id", "k")))
    events = e.select(
        F.col("event_id").cast("string").alias("id"),
        topic.alias("detail-type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        detail.alias("detail"),
    )
    jobs.land_stream(events, path, rejected, shared_dir(spark, "ckpt"), by_hour=False).awaitTermination()
    return readers.read_landed(spark, path).groupBy("entity", "date").agg(F.count(F.lit(1)).alias("events"))

