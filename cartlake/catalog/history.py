"""Backfill, retention and erasure queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cartlake.catalog.registry import plain, query, table
from cartlake.operators import backfill

START, END = date(1995, 1, 1), date(2001, 12, 31)

_WINDOWS = """w AS (
  SELECT CAST(i AS BIGINT) AS window_id, DATE '1995-01-01' + CAST(i * 7 AS INTEGER) AS window_start,
    least(DATE '1995-01-01' + CAST(i * 7 + 7 AS INTEGER), DATE '2002-01-01') AS window_end
  FROM range(0, CAST(ceil((DATE '2002-01-01' - DATE '1995-01-01') / 7.0) AS BIGINT)) t(i))"""


@query(
    "backfill_windows",
    f"""WITH {_WINDOWS}
SELECT window_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, count(o_orderkey) AS row_count,
  coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS total
FROM w LEFT JOIN orders ON o_orderdate >= window_start AND o_orderdate <= window_end GROUP BY 1, 2, 3""",
)
def backfill_windows(spark, sf):
    """Rows and amounts per 7-day window; a row on a shared boundary counts in both."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return plain(backfill.window_totals(table(spark, sf, "orders"), "o_orderdate", amount, START, END))


@query(
    "window_orders",
    f"""WITH {_WINDOWS}
SELECT o_orderkey, window_id FROM orders JOIN w ON o_orderdate >= window_start AND o_orderdate <= window_end""",
)
def window_orders(spark, sf):
    """Every export window of every order."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return backfill.assign_windows(rows, "o_orderdate", START, END).select("o_orderkey", "window_id")


@query(
    "window_overlap_dedupe",
    """SELECT o_orderkey, o_custkey FROM orders""",
)
def window_overlap_dedupe(spark, sf):
    """Orders exported twice at shared boundaries, back to one row each."""
    from cartlake.operators.ranking import latest_per_key

    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    exported = backfill.assign_windows(rows, "o_orderdate", START, END)
    return latest_per_key(exported, ["o_orderkey"], ["o_orderdate", "window_id"]).select("o_orderkey", "o_custkey")


def _erasure(spark, sf):
    requests = table(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select("c_custkey")
    tables = {
        "customer": (table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey"),
        "orders": (table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey"),
        "events": (table(spark, sf, "events").select("event_id", "user_id"), "user_id"),
    }
    return backfill.erase(tables, requests, "c_custkey")


_ERASED = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"


@query(
    "erase_customer",
    f"""SELECT 'customer' AS table_name, c_custkey AS row_id FROM customer WHERE c_custkey NOT IN {_ERASED}
UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_custkey NOT IN {_ERASED}
UNION ALL SELECT 'events', event_id FROM events WHERE user_id NOT IN {_ERASED}""",
)
def erase_customer(spark, sf):
    """What is left of three tables after an erasure request."""
    kept, _ = _erasure(spark, sf)
    rows = [
        df.select(F.lit(name).alias("table_name"), F.col(df.columns[0]).alias("row_id")) for name, df in kept.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "erase_audit",
    f"""SELECT 'customer' AS table_name, count(*) AS removed FROM customer WHERE c_custkey IN {_ERASED}
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey IN {_ERASED}
UNION ALL SELECT 'events', count(*) FROM events WHERE user_id IN {_ERASED}""",
)
def erase_audit(spark, sf):
    return _erasure(spark, sf)[1]


@query(
    "retention_partitions",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS rows FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '2000-06-01' - 730 GROUP BY 1""",
)
def retention_partitions(spark, sf):
    """Partition dates past the retention time, with their rows, as a dry run."""
    parts = (
        table(spark, sf, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return backfill.expired_partitions(parts, F.lit("2000-06-01"))
