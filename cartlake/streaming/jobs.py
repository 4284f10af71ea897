"""Continuous versions of landing, state, alarms and deduplication.

Queries that keep state write the rows that changed in a micro-batch to a log, one folder per
batch. A batch that is run again after a failure overwrites its own folder, so the log holds each
change once. ``read_log`` gives the newest row per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartlake.operators import alerts, envelope, state
from cartlake.operators.ranking import latest_per_key
from cartlake.operators.skew import HOT_ROWS
from cartlake.sinks.writers import write_quarantine

BATCH = "_batch"


def _start(
    df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str, trigger: dict
) -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )


def _with_event_time(df: DataFrame, time: str, late: str, name: str) -> DataFrame:
    """Watermark on an instant; a wall clock without a zone is UTC."""
    return df.withColumn(name, F.col(time).cast("timestamp")).withWatermark(name, late)


def _log_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).parquet(path)


def read_state(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], compacted: str | None = None
) -> DataFrame:
    """Newest row per key of a change log, from its last finished compaction and the batches after it.

    Folders are listed once, the compactions first, and only those that a finished write has marked are read: a
    compaction that is being written is not seen, and what it will fold is still in the batches.
    """
    upto = max(finished(spark, compacted), default=None) if compacted else None
    tail = [n for n in finished(spark, path) if upto is None or n > upto]
    log = _folders(spark, path, schema, tail)
    if upto is not None:
        log = log.unionByName(_folders(spark, compacted, schema, [upto]))
    return latest_per_key(log, keys, [BATCH]).drop(BATCH)


def _folders(spark: SparkSession, path: str, schema: T.StructType, numbers: list[int]) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    if not numbers:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/{BATCH}={n}" for n in numbers])


def _listed(spark: SparkSession, path: str) -> tuple[object, dict[int, object]]:
    """The file system and the batch folders of a path by number: names only, whatever the size of the data."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listStatus(root) if fs.exists(root) else []
    names = {s.getPath().getName(): s.getPath() for s in found}
    return fs, {int(n.split("=")[1]): where for n, where in names.items() if n.startswith(f"{BATCH}=")}


def finished(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders whose write was committed."""
    fs, folders = _listed(spark, path)
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n, where in folders.items() if fs.exists(marker(where, "_SUCCESS")))


def drop_folders(spark: SparkSession, path: str, upto: int) -> None:
    """Delete the batch folders up to a number."""
    fs, folders = _listed(spark, path)
    for n, where in folders.items():
        if n <= upto:
            fs.delete(where, True)


def compact_state(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], out: str, generations: int = 1
) -> None:
    """Fold the batches into one folder with the newest row per key; ``read_state(..., compacted=out)`` reads it.

    Each compaction is a folder named after the newest batch in it and starts from the one before. Its write mark
    makes it valid; only then are folders deleted that no reader needs. ``generations`` earlier compactions and
    the batches after them stay for readers that have listed them already; with 0 the log is one compaction and the tail.
    """
    done, batches = finished(spark, out), finished(spark, path)
    upto = max(batches, default=None)
    if upto is not None and (not done or upto > done[-1]):
        read_state(spark, path, schema, keys, out).write.mode("overwrite").parquet(f"{out}/{BATCH}={upto}")
        done = [*done, upto]
    if len(done) > generations:
        oldest = done[-1 - generations]
        drop_folders(spark, path, oldest)
        drop_folders(spark, out, oldest - 1)


def land_stream(
    events: DataFrame,
    path: str,
    quarantine: str,
    checkpoint: str,
    by_hour: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Transport events to partitioned raw files, rejects to the quarantine.

    Each batch owns its folders ``batch=<id>`` below the partitions, which makes a repeated
    batch harmless.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # both sinks below read it; kept so that the source is read once
        envelopes = envelope.extract_payload(batch).persist()
        try:
            good, bad = envelope.split_quarantine(envelopes)
            staged = envelope.landing_partitions(good).withColumns(
                {"entity": envelope.route_entity(F.col("event_type")), "batch": F.lit(batch_id)}
            )
            columns = ["entity", "date", "hour", "batch"] if by_hour else ["entity", "date", "batch"]
            if not by_hour:
                staged = staged.drop("hour")
            (
                staged.hint("rebalance", *columns[:-1])
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*columns)
                .json(path)
            )
            bad.write.mode("overwrite").json(f"{quarantine}/batch={batch_id}")
        finally:
            envelopes.unpersist()

    return _start(events, checkpoint, write, "append", trigger or {"availableNow": True})


def upsert_stream(
    versions: DataFrame,
    keys: list[str],
    order: list[Column | str],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    compacted: str | None = None,
    compact_every: int = 20,
) -> StreamingQuery:
    """Latest row per key as a running aggregate; changed keys go to the log.

    With ``compacted`` every ``compact_every``-th batch folds the log there, so it stays a state and a short tail.
    """
    latest = latest_per_key(versions, keys, order)
    log = _log_writer(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        log(batch, batch_id)
        if compacted and batch_id % compact_every == compact_every - 1:
            compact_state(batch.sparkSession, path, batch.schema, keys, compacted)

    return _start(latest, checkpoint, write, "update", trigger or {"availableNow": True})


def change_feed_stream(
    versions: DataFrame,
    key: str,
    time: str,
    sequence: str,
    columns: list[str],
    feed: str,
    tails: str,
    checkpoint: str,
    hot_rows: int = HOT_ROWS,
    full_every: int = 20,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Old and new image of every change, across batches.

    Batches arrive in order of time. Each batch is joined to the last image of its own keys and
    then leaves last images behind: every ``full_every``-th batch those of all keys, the others
    those of their own keys. A batch so reads one full set and the few folders after it; older
    folders are deleted once a batch that does not read them runs, and so is what a batch set aside.
    """
    keep = list(dict.fromkeys([key, time, sequence, *columns]))

    def full_before(batch_id: int) -> int:
        return (batch_id - 1) // full_every * full_every

    def last_images(spark: SparkSession, batch_id: int, schema: T.StructType) -> DataFrame:
        newest_full = full_before(batch_id)
        past = read_log(spark, tails, schema).filter(F.col(BATCH).between(newest_full, batch_id - 1))
        return past.select(*keep)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, aside = batch.sparkSession, f"{tails}.aside"
        drop_folders(spark, aside, batch_id)  # of a batch that failed

        def set_aside(df: DataFrame) -> DataFrame:
            place = f"{aside}/{BATCH}={batch_id}/{uuid.uuid4().hex}"
            df.write.parquet(place)
            return spark.read.schema(df.schema).parquet(place)

        # used by several branches below; kept so that the source is read once
        batch = batch.select(*keep).persist()
        try:
            rows, known = batch.withColumn("_new", F.lit(True)), batch
            if batch_id > 0:
                past = last_images(spark, batch_id, batch.schema)
                mine = past.join(batch.select(key).distinct(), key, "left_semi")
                before = latest_per_key(mine, [key], [time, sequence]).select(*keep)
                rows = rows.unionByName(before.withColumn("_new", F.lit(False)))
                if batch_id % full_every == 0:
                    known = batch.unionByName(past)
            fed = state.change_feed(rows, key, time, sequence, columns, hot_rows, set_aside).filter("_new").drop("_new")
            fed.write.mode("overwrite").parquet(f"{feed}/{BATCH}={batch_id}")
            last = latest_per_key(known, [key], [time, sequence])
            last.write.mode("overwrite").parquet(f"{tails}/{BATCH}={batch_id}")
            # the batch before this one is committed, so nothing reads what is older than its full set
            drop_folders(spark, tails, full_before(batch_id) - 1)
        finally:
            drop_folders(spark, aside, batch_id)
            batch.unpersist()

    return _start(versions, checkpoint, write, "append", trigger or {"availableNow": True})


def alarm_stream(
    samples: DataFrame,
    time: str,
    name: str,
    value: Column,
    path: str,
    checkpoint: str,
    late: str = "10 minutes",
    mode: str = "update",
    statistic: str = "sum",
    threshold: float = 0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """5-minute alarm windows with late data.

    ``update`` reports a window as soon as it fires and again when it grows, ``append`` once,
    after the watermark has passed it.
    """
    timed = _with_event_time(samples, time, late, time)
    windows = alerts.alarm_windows(timed, time, name, value, statistic, threshold)
    return _start(windows, checkpoint, _log_writer(path), mode, trigger or {"availableNow": True})


def dedupe_stream(
    events: DataFrame, time: str, event_id: str, path: str, checkpoint: str, late: str = "1 hour", trigger: dict | None = None
) -> StreamingQuery:
    """Redelivered events dropped within the retry age."""
    timed = _with_event_time(events, time, late, "_seen_at")
    unique = timed.dropDuplicatesWithinWatermark([event_id]).drop("_seen_at")
    return _start(unique, checkpoint, _log_writer(path), "append", trigger or {"availableNow": True})


def replay_quarantine(rejected: DataFrame, fix: Callable[[DataFrame], DataFrame], path: str) -> tuple[DataFrame, DataFrame]:
    """Run rejected events through routing again after a repair.

    Returns what is now processable and what is still rejected; the latter is written back.
    """
    good, bad = envelope.split_quarantine(fix(rejected.drop("reason")))
    write_quarantine(bad, path)
    return good, bad
