"""Streams over several micro-batches against their batch twins."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.operators import alerts, state
from cartlake.session import streaming_session
from cartlake.sources import readers
from cartlake.streaming import jobs

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("kind", T.StringType()),
    ]
)


@pytest.fixture
def source(spark, folder):
    """Five files in order of time, read one per micro-batch."""
    rng = random.Random(8)
    rows = [(i, 0 if i % 3 == 0 else rng.randint(1, 6), datetime(2024, 1, 1) + timedelta(minutes=2 * i), rng.choice("ab")) for i in range(200)]
    path = folder + "/in"
    for part in range(5):
        spark.createDataFrame(rows[part * 40 : part * 40 + 40], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    session = streaming_session(spark, 4)
    stream = readers.stream_files(session, path, SCHEMA, "parquet", files_per_trigger=1)
    return spark.createDataFrame(rows, SCHEMA), stream


def rows_of(df, *columns):
    return sorted(df.select(*columns).collect(), key=repr)


def test_upsert(spark, folder, source):
    batch, stream = source
    for _ in range(2):  # the second run finds nothing new
        jobs.upsert_stream(stream, ["user_id"], ["ts", "event_id"], folder + "/s", folder + "/c").awaitTermination()
    got = jobs.read_state(spark, folder + "/s", SCHEMA, ["user_id"])
    want = state.upsert(batch, ["user_id"], ["ts", "event_id"])
    assert rows_of(got, *SCHEMA.names) == rows_of(want, *SCHEMA.names)
    compact = folder + "/compact"
    for _ in range(2):  # a repeat starts from the first
        jobs.compact_state(spark, folder + "/s", SCHEMA, ["user_id"], compact)
    again = jobs.read_state(spark, folder + "/s", SCHEMA, ["user_id"], compact)
    assert rows_of(again, *SCHEMA.names) == rows_of(want, *SCHEMA.names)
    newer = batch.limit(1).withColumn("kind", F.lit("z"))
    newer.write.parquet(folder + "/s/_batch=99")
    changed = jobs.read_state(spark, folder + "/s", SCHEMA, ["user_id"], compact)
    assert changed.count() == want.count() and changed.filter("kind = 'z'").count() == 1


@pytest.mark.parametrize("hot_rows, full_every", [(10**6, 20), (5, 2)])
def test_change_feed(spark, folder, source, hot_rows, full_every):
    batch, stream = source
    jobs.change_feed_stream(
        stream, "user_id", "ts", "event_id", ["event_id", "kind"], folder + "/f", folder + "/t", folder + "/c", hot_rows, full_every
    ).awaitTermination()
    got = spark.read.parquet(folder + "/f")
    assert got.select("_batch").distinct().count() == 5
    want = state.change_feed(batch, "user_id", "ts", "event_id", ["event_id", "kind"])
    names = ["event_id", "user_id", "old_image", "new_image"]
    assert rows_of(got, *names) == rows_of(want, *names)


def test_alarms(spark, folder, source):
    batch, stream = source
    errors = F.when(F.col("kind") == "a", 1).otherwise(0).cast("bigint")
    source_name = F.concat(F.lit("s"), (F.col("user_id") % 2).cast("string"))
    named = lambda df: df.select("ts", source_name.alias("name"), errors.alias("n"))
    want = alerts.alarm_windows(named(batch), "ts", "name", F.col("n"))
    text = [F.col("window_start").cast("string").alias("w"), "metric", "value"]
    fields = T.StructType(
        [
            T.StructField("window_start", T.TimestampType()),
            T.StructField("window_end", T.TimestampType()),
            T.StructField("metric", T.StringType()),
            T.StructField("value", T.LongType()),
        ]
    )
    jobs.alarm_stream(named(stream), "ts", "name", F.col("n"), folder + "/u", folder + "/cu").awaitTermination()
    updated = jobs.read_state(spark, folder + "/u", fields, ["window_start", "metric"])
    assert rows_of(updated, *text) == rows_of(want, *text)
    jobs.alarm_stream(named(stream), "ts", "name", F.col("n"), folder + "/a", folder + "/ca", mode="append").awaitTermination()
    closed = rows_of(jobs.read_log(spark, folder + "/a", fields), *text)
    # windows the watermark has passed, each exactly once
    assert closed and set(closed) <= set(rows_of(want, *text)) and len(closed) == len(set(closed))


def test_dedupe(spark, folder, source):
    batch, stream = source
    twice = stream.unionByName(stream)
    jobs.dedupe_stream(twice, "ts", "event_id", folder + "/d", folder + "/c").awaitTermination()
    got = jobs.read_log(spark, folder + "/d", SCHEMA)
    assert rows_of(got, *SCHEMA.names) == rows_of(batch, *SCHEMA.names)


def test_landing(spark, folder):
    lines = folder + "/lines"
    good = '{"id":"1","detail-type":"orders/create","time":"2024-01-01T05:00:00Z","detail":{"id":1}}'
    spark.createDataFrame([(good,), ('{"id":"2","time":"x","detail":{}}',), ("{cut",)], "value string").write.text(lines)
    session = streaming_session(spark, 2)
    from cartlake import schemas

    stream = readers.stream_files(session, lines, schemas.TRANSPORT_EVENT)
    jobs.land_stream(stream, folder + "/raw", folder + "/bad", folder + "/c").awaitTermination()
    (row,) = readers.read_landed(spark, folder + "/raw").collect()
    assert (row.event_id, row.entity, row.date, row.hour) == ("1", "orders", "2024-01-01", "05")
    bad = readers.read_quarantine(spark, folder + "/bad")
    assert sorted(r.reason for r in bad.collect()) == ["empty_payload", "malformed_json"]
    still, rest = jobs.replay_quarantine(bad, lambda df: df.withColumn("data", F.coalesce("data", F.lit("{}"))), folder + "/again")
    assert still.count() == 0 and rest.count() == 2


def test_expiry(spark, folder):
    from cartlake.streaming import expiry

    start = datetime(2024, 1, 1)
    rows = [(i, i % 3, start + timedelta(hours=i), f"k{i}") for i in range(12)]
    parts = [[*rows[:6], (100, 9, start, "old")], rows[6:], [(200, 1, start + timedelta(days=8), "late")]]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = readers.stream_files(streaming_session(spark, 2), folder + "/in", SCHEMA, "parquet", files_per_trigger=1)
    expiry.expiring_state_stream(
        stream, "user_id", "ts", "event_id", 86400, ["kind"], folder + "/out", folder + "/c", "10 minutes"
    ).awaitTermination()
    got = {(r.key, r.kind, r.op) for r in spark.read.parquet(folder + "/out").collect()}
    assert {g for g in got if g[2] == "expired"} == {("0", "k9", "expired"), ("2", "k11", "expired"), ("9", "old", "expired")}
    assert ("1", "late", "upsert") in got and ("0", "k3", "upsert") in got


def test_expiry_keeps_revived_and_drops_dead_on_arrival(spark, folder):
    from cartlake.streaming import expiry

    start = datetime(2024, 1, 1)
    day = timedelta(days=1)
    arrivals = [
        [(1, 1, start, "a"), (2, 2, start, "b")],
        [(3, 1, start + timedelta(hours=20), "c"), (4, 3, start + 3 * day, "d"), (4, 3, start + 3 * day, "d")],
        [(5, 4, start, "dead"), (6, 2, start + 3 * day, "again"), (7, None, start, "x"), (8, 5, None, "y")],
        [(9, 9, start + 3 * day + timedelta(hours=1), "z")],
    ]
    session = streaming_session(spark, 2)
    for part in arrivals:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder + "/in")
        stream = readers.stream_files(session, folder + "/in", SCHEMA, "parquet")
        expiry.expiring_state_stream(
            stream, "user_id", "ts", "event_id", 86400, ["kind"], folder + "/out", folder + "/c"
        ).awaitTermination()
    log = spark.read.parquet(folder + "/out")
    assert {(r.key, r.kind) for r in log.filter("op = 'expired'").collect()} == {("1", "c"), ("2", "b")}
    assert {(r.key, r.kind) for r in expiry.read_live(spark, folder + "/out").collect()} == {("2", "again"), ("3", "d"), ("9", "z")}


def test_expiry_combines_a_hot_key_before_the_shuffle(spark, folder):
    from cartlake.streaming import expiry

    rows = spark.range(0, 100_000, 1, 8).select(
        F.col("id").alias("event_id"),
        F.lit(1).cast("bigint").alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 1000)).cast("timestamp_ntz").alias("ts"),
        F.lit("k").alias("kind"),
    )
    rows.write.parquet(folder + "/in")
    stream = readers.stream_files(streaming_session(spark, 2), folder + "/in", SCHEMA, "parquet")
    running = expiry.expiring_state_stream(stream, "user_id", "ts", "event_id", 60, ["kind"], folder + "/out", folder + "/c")
    running.awaitTermination()
    # the state takes one session a task, not a row for each event
    assert max(op.numRowsUpdated for p in running.removals.recentProgress for op in p.stateOperators) <= 8
    (only,) = spark.read.parquet(folder + "/out").filter("op = 'upsert'").collect()
    assert only.sequence == 99_999


def test_log_is_one_compaction_and_a_tail(spark, folder):
    log, out = folder + "/log", folder + "/out"
    want = {}
    for n in range(50):
        rows = [(n, n % 7, datetime(2024, 1, 1) + timedelta(minutes=n), f"k{n}")]
        want[n % 7] = f"k{n}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{log}/_batch={n}")
        if n % 20 == 19:
            jobs.compact_state(spark, log, SCHEMA, ["user_id"], out, generations=0)
    assert jobs.finished(spark, log) == list(range(40, 50)) and jobs.finished(spark, out) == [39]
    read = lambda: {r.user_id: r.kind for r in jobs.read_state(spark, log, SCHEMA, ["user_id"], out).collect()}
    assert read() == want
    # a compaction that is being written has rows but no mark yet: it is not read, and a retry replaces it
    wrong = spark.createDataFrame([(1, 1, datetime(2024, 1, 1), "half")], SCHEMA)
    wrong.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{out}/_batch=49")
    assert jobs.finished(spark, out) == [39] and read() == want
    before = jobs.read_state(spark, log, SCHEMA, ["user_id"], out)
    jobs.compact_state(spark, log, SCHEMA, ["user_id"], out)
    # a reader from before still finds its folders; the next compaction lets them go
    assert {r.user_id: r.kind for r in before.collect()} == want == read()
    assert jobs.finished(spark, out) == [39, 49]


def test_change_feed_leaves_bounded_folders(spark, folder):
    import os

    rows = [(i, i % 3, datetime(2024, 1, 1) + timedelta(minutes=i), f"k{i}") for i in range(24)]
    for n in range(12):
        spark.createDataFrame(rows[2 * n : 2 * n + 2], SCHEMA).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = readers.stream_files(streaming_session(spark, 2), folder + "/in", SCHEMA, "parquet", files_per_trigger=1)
    jobs.change_feed_stream(
        stream, "user_id", "ts", "event_id", ["kind"], folder + "/f", folder + "/t", folder + "/c", 1, 3
    ).awaitTermination()
    assert jobs.finished(spark, folder + "/t") == [9, 10, 11] and not os.listdir(folder + "/t.aside")
    got = spark.read.parquet(folder + "/f")
    want = state.change_feed(spark.createDataFrame(rows, SCHEMA), "user_id", "ts", "event_id", ["kind"])
    names = ["event_id", "old_image", "new_image"]
    assert rows_of(got, *names) == rows_of(want, *names)
