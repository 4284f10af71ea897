"""Daily order job: raw events and snapshots to processed and curated orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.functions.timeutil import utc_clock
from cartlake.operators import enrich, envelope, state
from cartlake.sinks import writers
from cartlake.sources import readers


def processed_orders(
    events: DataFrame | None,
    snapshots: DataFrame | None,
    subscription_skus: list[str],
    brand: str,
    as_of: Column | None = None,
) -> DataFrame:
    """Newest row per order over both sources, with date parts."""
    enriched = None
    if events is not None:
        own, _ = envelope.split_quarantine(events)
        own = own.filter(F.startswith("event_type", F.lit("orders/")))
        enriched = enrich.enrich_orders(own, subscription_skus, brand, as_of)
    normal = None
    if snapshots is not None:
        normal = state.normalise_snapshot(snapshots)
        if "tags" in normal.columns:
            flag = enrich.batch_subscription_flag(F.col("tags"))
            normal = normal.withColumns(
                {"is_subscription": flag, "subscription_type": F.when(flag, F.lit(enrich.DEFAULT_RHYTHM))}
            )
    combined = state.combine_orders(enriched, normal)
    return envelope.with_date_parts(state.dedupe_orders(combined), utc_clock(F.col("created_at")))


def run(
    spark: SparkSession,
    events_path: str,
    snapshots_path: str,
    processed_path: str,
    curated_path: str,
    date: str,
    subscription_skus: list[str],
    brand: str,
) -> None:
    """Replace one date of the processed and curated orders."""
    events, snapshots = readers.read_day(spark, events_path, snapshots_path, date)
    orders = processed_orders(events, snapshots, subscription_skus, brand)
    writers.write_orders(orders, processed_path, date)
    # the curated split reads the written files, so the job above is not computed twice
    written = spark.read.parquet(processed_path).filter(F.col("date") == date).drop("date")
    writers.write_subscription_orders(written, curated_path, date)


def flatten_landed(spark: SparkSession, raw_path: str, processed_path: str, brand: str, date: str | None = None) -> None:
    """The plain nightly job: parse, flatten, lists to text, brand, overwrite.

    With a date only that date is read, and only its partition is replaced.
    """
    landed = readers.read_order_payloads(spark, raw_path, date)
    orders = enrich.stringify_complex(envelope.payload_columns(landed))
    writers.write_orders(envelope.with_brand(orders.drop("date") if date else orders, brand), processed_path, date)
