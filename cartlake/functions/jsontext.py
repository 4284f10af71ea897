"""Parsing of JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows with ``value``, which later filters cannot duplicate.

    A filter on part of a costly value would be pushed below a plain projection and compute the
    value again for every part it names. Filters do not pass a generator, so the value is
    exploded from an array of one.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def parsed(rows: DataFrame, column: Column, schema: str, name: str = "d") -> DataFrame:
    """Rows with the JSON text of ``column`` parsed into the struct ``name``, exactly once."""
    return computed_once(rows, F.from_json(column, schema), name)
