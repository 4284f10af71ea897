"""History windows, retention and erasure."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.functions import timeutil as tu

RETENTION_DAYS = 730


def windows(spark: SparkSession, start: date, end: date, days: int = 7) -> DataFrame:
    """Windows of ``days`` days over [start, end + 1 day), the last one clipped (B1)."""
    first, stop = F.lit(str(start)).cast("date"), F.date_add(F.lit(str(end)).cast("date"), 1)
    starts = F.sequence(first, F.date_sub(stop, 1), F.make_dt_interval(F.lit(days)))
    return spark.range(1).select(F.posexplode(starts).alias("window_id", "_s")).select(
        F.col("window_id").cast("bigint"),
        F.col("_s").cast(tu.NTZ).alias("window_start"),
        F.least(F.date_add("_s", days), stop).cast(tu.NTZ).alias("window_end"),
    )


def window_memberships(created: Column, start: date, end: date, days: int = 7) -> Column:
    """Ids of the windows an instant falls in, both window ends inclusive.

    Pure arithmetic: an instant on a shared boundary belongs to two windows, any other to one,
    and an instant outside the range to none. No window table is joined.
    """
    first = F.lit(str(start)).cast(tu.NTZ)
    stop = F.date_add(F.lit(str(end)).cast("date"), 1).cast(tu.NTZ)
    offset = F.datediff(created, first)
    own = F.floor(offset / days).cast("bigint")
    midnight = created == F.date_trunc("day", created).cast(tu.NTZ)
    on_boundary = midnight & (F.pmod(offset, F.lit(days)) == 0) & (own > 0)
    in_own = created < stop
    # the very end of the range closes the last, possibly clipped, window
    last = F.floor((F.datediff(stop, first) - 1) / days).cast("bigint")
    ids = F.filter(
        F.array(
            F.when(in_own, own),
            F.when(in_own & on_boundary, own - 1),
            F.when(created == stop, last),
        ),
        lambda i: i.isNotNull(),
    )
    return F.when((created >= first) & (created <= stop), ids).otherwise(F.array().cast("array<bigint>"))


def assign_windows(rows: DataFrame, column: str, start: date, end: date, days: int = 7) -> DataFrame:
    """Rows with every window they are exported in; a range predicate reaches the scan."""
    stop = F.date_add(F.lit(str(end)).cast("date"), 1).cast(tu.NTZ)
    in_range = F.col(column).between(F.lit(str(start)).cast(tu.NTZ), stop)
    return rows.filter(in_range).withColumn(
        "window_id", F.explode(window_memberships(F.col(column), start, end, days))
    )


def window_totals(rows: DataFrame, column: str, amount: Column, start: date, end: date, days: int = 7) -> DataFrame:
    """Rows and amount per window, empty windows included (B1)."""
    totals = (
        assign_windows(rows, column, start, end, days)
        .groupBy("window_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(amount).alias("total"))
    )
    return (
        windows(rows.sparkSession, start, end, days)
        .join(totals, "window_id", "left")
        .withColumns(
            {
                "row_count": F.coalesce("row_count", F.lit(0).cast("bigint")),
                "total": F.coalesce("total", F.lit(0)),
            }
        )
    )


def expired_partitions(partitions: DataFrame, as_of: Column, days: int = RETENTION_DAYS, column: str = "date") -> DataFrame:
    """Partition dates older than the retention time (B5); dropping them is the caller's step."""
    old = F.col(column).cast("date") < F.date_sub(as_of.cast("date"), days)
    return partitions.filter(old)


def erase(tables: dict[str, tuple[DataFrame, str]], requests: DataFrame, id_column: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table without the rows of the requested customers, and an audit of rows removed."""
    # an anti join needs no distinct list; straight out of a shuffle, AQE can split a hot customer
    ids = requests.select(F.col(id_column).alias("_erase"))
    kept, audit = {}, None
    for name, (df, column) in tables.items():
        kept[name] = df.join(ids, F.col(column) == F.col("_erase"), "left_anti")
        removed = (
            df.groupBy(F.col(column).alias("_id"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .join(ids, F.col("_id") == F.col("_erase"), "left_semi")
            .agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("_n"), F.lit(0)).alias("removed"))
        )
        audit = removed if audit is None else audit.unionByName(removed)
    return kept, audit
