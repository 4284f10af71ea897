"""Hourly KPI refresh: facts to the partitioned hourly table."""

from __future__ import annotations

from datetime import date, datetime, time, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame

from cartlake import schemas
from cartlake.functions.timeutil import fetch_window
from cartlake.operators import kpi
from cartlake.sinks import writers


def store_bounds(start: date, end: date, store_zone: str) -> tuple[datetime, datetime]:
    """Store-local bounds of the fact scan for whole local days of every region.

    Facts carry store-local hours, so the bounds are converted and not the column.
    """
    low, high = fetch_window(datetime.combine(start, time(0)), datetime.combine(end, time(23, 59, 59)), store_zone)
    zone = ZoneInfo(store_zone)
    local = lambda utc: utc.replace(tzinfo=timezone.utc).astimezone(zone).replace(tzinfo=None)
    return local(low), local(high)


def metrics_between(
    orders: DataFrame,
    ads: DataFrame,
    start: date,
    end: date,
    store_zone: str,
    account_regions: dict[str, str] | DataFrame | None = None,
) -> DataFrame:
    """Hourly metrics from the facts a range of local dates can need."""
    low, high = store_bounds(start, end, store_zone)
    return kpi.metrics_from_facts(orders, ads, store_zone, account_regions, low, high)


def hourly_between(orders, ads, start: date, end: date, store_zone: str, account_regions=None) -> DataFrame:
    metrics = metrics_between(orders, ads, start, end, store_zone, account_regions)
    return kpi.between_local_dates(kpi.hourly_table(metrics), start, end)


def daily_between(orders, ads, start: date, end: date, store_zone: str, account_regions=None) -> DataFrame:
    metrics = metrics_between(orders, ads, start, end, store_zone, account_regions)
    return kpi.between_local_dates(kpi.daily_report(metrics), start, end)


def detect_store_zone(orders: DataFrame, as_of: datetime) -> str:
    """Store zone as a plain value, one row read (O3)."""
    return kpi.shop_time_zone(orders, as_of).first()["shop_timezone"]


def refresh(
    orders: DataFrame,
    ads: DataFrame,
    start: date,
    end: date,
    store_zone: str,
    path: str,
    account_regions=None,
    output_format: str = "parquet",
    by_hour: bool = False,
    manifest_path: str | None = None,
    table: str | None = None,
) -> dict:
    """Recompute a range of local dates and replace exactly its partitions.

    A date spans two UTC days in some regions; as whole dates are recomputed from all the facts
    they can need, a repeat or a late event leaves the same files.
    """
    hourly = hourly_between(orders, ads, start, end, store_zone, account_regions)
    info = writers.write_kpi(hourly, path, str(start), str(end), output_format, by_hour, manifest_path)
    if table:
        columns = writers.KPI_HOUR_PARTITIONS if by_hour else writers.KPI_PARTITIONS
        writers.define_table(
            orders.sparkSession, table, writers.kpi_schema(by_hour), columns, path, output_format
        )
    return info


HOURLY_COLUMNS = schemas.HOURLY_TABLE.names
