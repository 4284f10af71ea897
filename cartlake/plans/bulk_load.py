"""Bulk history: JSONL export to a parquet snapshot."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from cartlake import schemas
from cartlake.operators.enrich import flatten_one_level
from cartlake.sinks.writers import write_quarantine, write_snapshot
from cartlake.sources.readers import read_export


def load_export(
    spark: SparkSession, export_path: str, snapshots_path: str, date: str, quarantine_path: str | None = None
) -> dict:
    """Flatten an export into the snapshot of a date; an export without records is an error.

    Malformed lines are counted in the same pass and, with a path, kept in the quarantine.
    A gzip file is read by one task, so exports are best cut into many files or left plain.
    """
    seen, corrupt = Observation(), F.col(schemas.CORRUPT)
    lines = read_export(spark, export_path, keep_malformed=True).observe(seen, F.count(corrupt).alias("malformed"))
    info = write_snapshot(flatten_one_level(lines.filter(corrupt.isNull()).drop(schemas.CORRUPT)), snapshots_path, date)
    info["malformed"] = seen.get["malformed"]
    if quarantine_path and info["malformed"]:
        bad = read_export(spark, export_path, keep_malformed=True).filter(corrupt.isNotNull())
        write_quarantine(bad.select(corrupt.alias("raw"), "id", F.lit("malformed line").alias("reason")), quarantine_path)
    return info
