"""Latest row per key on a stream, dropped when it expires.

Two native queries over the same source. The first writes the newest row per key of each batch. The second keeps a
session window per key whose gap is the time to live: it ends when its newest row expires, so the event-time state
holds live keys only, and the watermark that passes the end emits the removal. Both combine rows of a key before the
shuffle, so a hot key costs a row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartlake.operators.ranking import latest_per_key
from cartlake.streaming.jobs import BATCH, _log_writer, _start

UPSERT, EXPIRED = "upsert", "expired"
RANK = ["version", "sequence"]
LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


@dataclass
class ExpiringState:
    """The two running queries."""

    upserts: StreamingQuery
    removals: StreamingQuery

    def awaitTermination(self) -> None:  # noqa: N802  named as on a single query
        self.upserts.awaitTermination()
        self.removals.awaitTermination()

    def stop(self) -> None:
        self.upserts.stop()
        self.removals.stop()


def _part(path: str, op: str) -> str:
    return f"{path}/op={op}"


def expiring_state_stream(
    versions: DataFrame,
    key: str,
    time: str,
    sequence: str,
    ttl_seconds: int,
    columns: list[str],
    path: str,
    checkpoint: str,
    late: str = "1 hour",
    trigger: dict | None = None,
) -> ExpiringState:
    """Upserts and expiries per key, written to a change log with a folder per ``op``.

    A removal names the version that it removes and is left out when the log already holds a newer one. Rows without
    a key or a time are not state. ``read_live`` gives what has not expired.
    """
    trigger = trigger or {"availableNow": True}
    seen = F.col(time).cast("timestamp")
    timed = (
        versions.select(
            F.col(key).cast("string").alias("key"),
            seen.alias("_seen_at"),
            F.unix_micros(seen).alias("version"),
            F.col(sequence).cast("bigint").alias("sequence"),
            (F.unix_millis(seen) + ttl_seconds * 1000).alias("expires_ms"),
            *[F.col(c) for c in columns],
        )
        .filter(F.col("key").isNotNull() & F.col("_seen_at").isNotNull())
    )
    names = [*RANK, "expires_ms", *columns]
    upserts_path, into_log = _part(path, UPSERT), _log_writer(_part(path, UPSERT))

    def write_upserts(batch: DataFrame, batch_id: int) -> None:
        into_log(latest_per_key(batch, ["key"], RANK), batch_id)

    upserts = _start(timed.drop("_seen_at"), f"{checkpoint}/upserts", write_upserts, "append", trigger)
    if "availableNow" in trigger:
        upserts.awaitTermination()  # removals then see every newer version

    versions.sparkSession.conf.set(LOCAL_MERGE, "true")
    ended = (
        timed.withWatermark("_seen_at", late)
        .groupBy("key", F.session_window("_seen_at", f"{ttl_seconds} seconds").alias("_alive"))
        .agg(F.max_by(F.struct(*names), F.struct(*RANK)).alias("_r"))
        .select("key", *[F.col(f"_r.`{c}`").alias(c) for c in names])
    )
    remove = _log_writer(_part(path, EXPIRED))

    def write_removals(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            oldest = batch.agg(F.min("version")).first()[0]
            if oldest is not None:
                # the log is in order of time but for late rows: statistics leave the folders of the last time to live
                log = batch.sparkSession.read.schema(_log_schema(batch.schema)).parquet(upserts_path)
                newer = log.filter(F.col("version") >= oldest).groupBy("key").agg(F.max(F.struct(*RANK)).alias("_newest"))
                kept = batch.join(newer, "key", "left")
                batch_out = kept.filter(F.col("_newest").isNull() | (F.struct(*RANK) >= F.col("_newest"))).drop("_newest")
                remove(batch_out, batch_id)
            else:
                remove(batch, batch_id)
        finally:
            batch.unpersist()

    return ExpiringState(upserts, _start(ended, f"{checkpoint}/removals", write_removals, "append", trigger))


def _log_schema(rows: T.StructType) -> T.StructType:
    return T.StructType([*rows.fields, T.StructField(BATCH, T.LongType())])


def read_live(spark: SparkSession, path: str, late_seconds: int = 3600) -> DataFrame:
    """Newest row per key of the log that has no removal and expires after the watermark.

    A row that was past its expiry when it arrived never was live; the watermark, which follows from the newest
    time in the log, leaves it out.
    """
    log = spark.read.parquet(path)
    horizon = log.agg((F.max("version") / 1000 - late_seconds * 1000).alias("_horizon"))
    newest = latest_per_key(log, ["key"], [*RANK, F.expr(f"op = '{EXPIRED}'").alias("gone")])
    # one row by construction
    live = newest.join(F.broadcast(horizon), F.col("expires_ms") > F.col("_horizon"))
    return live.filter(F.col("op") == UPSERT).drop("_horizon")
