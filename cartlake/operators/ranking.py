"""Per-key picks that hold when one key owns a large share of the rows.

A window over a key sorts all rows of that key in one task. The functions here either use
aggregates that combine before the shuffle, or treat hot keys apart: the rows of a hot key are
cut into cells by a list of levels, coarse to fine, each a whole number that never falls as the
wanted order rises. Rows are ordered inside a cell only, and small tables with one row per cell
carry the result from cell to cell. Every other key is a single cell.

The hot keys and the table of one row per cell are checkpointed, so the rows themselves are read
for the count, for the cells and for the result, however many levels there are. Without hot keys
the result is a plain window; it is the same either way.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlake.operators.skew import HOT_ROWS, hot_keys
from cartlake.session import checkpointed

# 2^20 consecutive ids per cell: as ids are unique, no finest cell can hold more rows.
ID_BLOCK_BITS = 20


def id_block(col: Column, bits: int = ID_BLOCK_BITS) -> Column:
    return F.shiftright(col.cast("bigint"), bits)


def epoch_micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def time_levels(time: Column, sequence: Column) -> list[Column]:
    """Minute, exact time, block of ids: levels for the order (time, id)."""
    micros = epoch_micros(time)
    return [F.floor(micros / F.lit(60_000_000)).cast("bigint"), micros, id_block(sequence)]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the greatest by ``order``.

    ``max_by`` keeps one row per key before the shuffle, so a hot key costs one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r"))
        .select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in others])
    )


def most_frequent(df: DataFrame, keys: list[str], column: str, extra: list[Column] | None = None) -> DataFrame:
    """Most frequent value per key, ties to the smallest value (A4).

    Counted per (key, value) first, so a key with many distinct values is spread over tasks and
    no task holds a table of its values.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min_by(column, F.struct((-F.col("_n")).alias("n"), F.col(column)))
    return counted.groupBy(*keys).agg(pick.alias(column), *(extra or []))


def _cells(df: DataFrame, keys: list[str], levels: list[Column], hot: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with their cell: the levels for a hot key, one common cell for any other."""
    names = [f"_cell{i}" for i in range(len(levels))]
    tagged = df.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    cells = {n: F.when(F.col("_hot"), v).otherwise(F.lit(0).cast("bigint")) for n, v in zip(names, levels)}
    return tagged.withColumns(cells), names


def _known_hot(df: DataFrame, keys: list[str], hot_rows: int, hot: DataFrame | None) -> DataFrame:
    """The hot keys, counted once: every later step reads the checkpoint and not the table again."""
    return checkpointed(df.sparkSession, hot if hot is not None else hot_keys(df, keys, hot_rows))


def _split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(known), df.filter(~known)


def split_row_number(
    df: DataFrame,
    keys: list[str],
    levels: list[Column],
    order: list[Column | str],
    name: str,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``row_number`` per key, hot keys cut into ``levels``; rows without a key get NULL."""
    known, unknown = _split_null_keys(df, keys)
    hot = _known_hot(known, keys, hot_rows, hot)
    if hot.isEmpty():
        plain = known.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint"))
        return plain.unionByName(unknown.withColumn(name, F.lit(None).cast("bigint")))
    staged, cells = _cells(known, keys, levels, hot)
    leaf = keys + cells
    totals = staged.filter("_hot").groupBy(*leaf).agg(F.count(F.lit(1)).alias("_n"))
    totals = checkpointed(df.sparkSession, totals)
    offsets = totals.withColumn("_before", F.lit(0).cast("bigint"))
    for depth in range(len(cells)):
        group, parent = keys + cells[: depth + 1], keys + cells[:depth]
        earlier = W.partitionBy(*parent).orderBy(cells[depth]).rowsBetween(W.unboundedPreceding, -1)
        level = totals if group == leaf else totals.groupBy(*group).agg(F.sum("_n").alias("_n"))
        level = level.select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_add"))
        offsets = offsets.join(level, group).withColumn("_before", F.col("_before") + F.col("_add")).drop("_add")
    inside = F.row_number().over(W.partitionBy(*leaf).orderBy(*order))
    ranked = (
        staged.withColumn(name, inside.cast("bigint"))
        .join(offsets.drop("_n"), leaf, "left")
        .withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0)))
        .drop("_before", "_hot", *cells)
    )
    return ranked.unionByName(unknown.withColumn(name, F.lit(None).cast("bigint")))


def split_lag(
    df: DataFrame,
    keys: list[str],
    levels: list[Column],
    order: list[Column | str],
    columns: list[str],
    name: str,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
    settle: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Struct of ``columns`` of the previous row of the key, NULL on the first row.

    A job that runs often passes ``settle`` to write what is read again to a place that it deletes.
    """
    settle = settle or partial(checkpointed, df.sparkSession)
    known, unknown = _split_null_keys(df, keys)
    hot = settle(hot if hot is not None else hot_keys(known, keys, hot_rows))
    image, rank = F.struct(*columns), F.struct(*order)
    if hot.isEmpty():
        plain = known.withColumn(name, F.lag(image).over(W.partitionBy(*keys).orderBy(*order)))
        return plain.unionByName(unknown.withColumn(name, F.lit(None).cast(plain.schema[name].dataType)))
    staged, cells = _cells(known, keys, levels, hot)
    leaf = keys + cells
    tails = staged.filter("_hot").groupBy(*leaf).agg(F.max_by(image, rank).alias("_tail"), F.max(rank).alias("_rank"))
    tails = settle(tails)
    heads = tails.select(*leaf, F.lit(None).cast(tails.schema["_tail"].dataType).alias("_prev"))
    for depth in reversed(range(len(cells))):
        group, parent = keys + cells[: depth + 1], keys + cells[:depth]
        level = tails if group == leaf else tails.groupBy(*group).agg(F.max_by("_tail", "_rank").alias("_tail"))
        before = F.lag("_tail").over(W.partitionBy(*parent).orderBy(cells[depth]))
        heads = (
            heads.join(level.select(*group, before.alias("_older")), group)
            .withColumn("_prev", F.coalesce("_prev", "_older"))
            .drop("_older")
        )
    inside = F.lag(image).over(W.partitionBy(*leaf).orderBy(*order))
    linked = (
        staged.withColumn(name, inside)
        .join(heads, leaf, "left")
        .withColumn(name, F.coalesce(name, "_prev"))
        .drop("_prev", "_hot", *cells)
    )
    return linked.unionByName(unknown.withColumn(name, F.lit(None).cast(linked.schema[name].dataType)))
