"""Joins that hold when one key owns a large share of the rows.

The adaptive planner splits a skewed partition only where both sides of a join come straight out
of a shuffle. A side that was just aggregated by the key does not, so the split is made here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot. A table of n rows has fewer than n / HOT_ROWS hot keys,
# which bounds the broadcast of their list: half a million keys for 10^12 rows.
HOT_ROWS = 2_000_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and their count, safe to broadcast.

    Counts are combined before the shuffle, so a hot key costs one row per task.
    """
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    )


def salted_join(
    many: DataFrame,
    one: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``many`` to ``one`` (few rows per key); the rows of a hot key spread over salts.

    A hot key gets one salt per ``hot_rows`` rows, and its rows on the ``one`` side are repeated
    per salt. The salt is a hash of the row, so a task that runs again deals rows out the same way.
    Every other key has the single salt 0. ``hot`` may be passed from ``hot_keys`` of a cheaper
    table with the same keys; which keys count as hot never changes the result.
    """
    parts = F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int")
    known = hot if hot is not None else hot_keys(many, keys, hot_rows)
    hot = F.broadcast(known.select(*keys, parts.alias("_parts")))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in many.columns])
    salted = many.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_parts").isNotNull(), F.pmod(row_hash, F.col("_parts")).cast("int")).otherwise(0)
    )
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    repeated = one.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    joined = salted.drop("_parts").join(repeated.drop("_parts"), [*keys, "_salt"], how)
    return joined.drop("_salt")
