"""Store-local, UTC and region-local time.

All wall clocks are TIMESTAMP_NTZ, so nothing depends on the zone of the session.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: reporting zone of each region ---
REGION_ZONES = {
    "US": "America/Chicago",
    "CA": "America/Regina",
    "UK": "Europe/London",
    "AU": "Australia/Sydney",
}
CENTRAL_ZONE = "America/Chicago"
# --- end of fixed values ---

NTZ = "timestamp_ntz"
HOUR_TEXT = "yyyy-MM-dd HH:00"


def parse_instant(col: Column) -> Column:
    """ISO-8601 text to an instant; text without an offset is UTC, bad text is NULL."""
    return F.try_to_timestamp(col)


def instant_to_utc_clock(col: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast(NTZ))


def utc_clock(col: Column) -> Column:
    """ISO-8601 text to the UTC wall clock."""
    return instant_to_utc_clock(parse_instant(col))


def hour_of(col: Column) -> Column:
    return F.date_trunc("hour", col).cast(NTZ)


def date_and_hour(day: Column, hour: Column) -> Column:
    """Day plus a number of hours, on the hour."""
    zero = F.lit(0)
    return day.cast(NTZ) + F.make_dt_interval(zero, hour.cast("int"), zero, zero)


def store_to_utc(local: Column, store_zone: str) -> Column:
    return F.convert_timezone(F.lit(store_zone), F.lit("UTC"), local)


def utc_to_store(utc: Column, store_zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(store_zone), utc)


def region_zone(region: Column) -> Column:
    """Zone of a region; an unknown region is an error, as there is no right answer."""
    zone = F.create_map(*[F.lit(x) for pair in REGION_ZONES.items() for x in pair])[region]
    unknown = F.raise_error(F.concat(F.lit("unsupported region: "), F.coalesce(region, F.lit("null"))))
    return F.when(zone.isNotNull(), zone).otherwise(unknown.cast("string"))


def utc_to_region(utc: Column, region: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), region_zone(region), utc)


def hour_text(col: Column) -> Column:
    return F.date_format(col, HOUR_TEXT)


def fetch_window(start_local: datetime, end_local: datetime, store_zone: str) -> tuple[datetime, datetime]:
    """UTC bounds holding every region's local days of a store-local range (B2).

    The upper bound follows the last day of the range in each region. Both bounds are
    naive UTC clocks and inclusive.
    """
    zone = ZoneInfo(store_zone)
    start = start_local.replace(tzinfo=zone) if start_local.tzinfo is None else start_local.astimezone(zone)
    end = end_local.replace(tzinfo=zone) if end_local.tzinfo is None else end_local.astimezone(zone)
    if start > end:
        raise ValueError("the range ends before it starts")

    def day_edge(day: date, region: ZoneInfo, clock: time) -> datetime:
        return datetime.combine(day, clock, tzinfo=region).astimezone(timezone.utc)

    lows, highs = [start.astimezone(timezone.utc)], [end.astimezone(timezone.utc)]
    for name in REGION_ZONES.values():
        region = ZoneInfo(name)
        # whole requested local dates, whatever clock the caller gave
        lows.append(day_edge(start.date(), region, time(0)))
        lows.append(day_edge(start.astimezone(region).date(), region, time(0)))
        highs.append(day_edge(end.date() + timedelta(days=1), region, time(0)) - timedelta(seconds=1))
        highs.append(
            day_edge(end.astimezone(region).date() + timedelta(days=1), region, time(0)) - timedelta(seconds=1)
        )
    return min(lows).replace(tzinfo=None), max(highs).replace(tzinfo=None)


def fetch_window_columns(start_local: Column, end_local: Column, store_zone: str) -> tuple[Column, Column]:
    """The same bounds for ranges held in columns, one range per row."""
    lows = [store_to_utc(start_local, store_zone)]
    highs = [store_to_utc(end_local, store_zone)]
    one_second = F.expr("interval 1 second")
    for name in REGION_ZONES.values():
        for clock, out in ((start_local, lows), (end_local, highs)):
            shifted = F.convert_timezone(F.lit(store_zone), F.lit(name), clock)
            for day in (F.to_date(clock), F.to_date(shifted)):
                edge = day if out is lows else F.date_add(day, 1)
                utc = F.convert_timezone(F.lit(name), F.lit("UTC"), edge.cast(NTZ))
                out.append(utc if out is lows else utc - one_second)
    return F.least(*lows), F.greatest(*highs)
