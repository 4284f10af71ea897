"""Coercion, exact sums, safe ratios and report rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"

# Additive metrics are summed as decimals of 12 places: the total is then the same whatever the order
# in which partial sums meet, so a retried task or another partitioning changes nothing. Totals up to
# 1e26 fit; beyond that is an error, not a wrap.
TERM = "decimal(38,12)"


def term(expr: str) -> str:
    """SQL of a numeric expression as a decimal to add up, null as 0."""
    return f"cast(coalesce({expr}, 0D) AS {TERM})"


def exact_total(expr: str) -> str:
    """SQL of the order-free sum of a numeric expression."""
    return f"cast(sum({term(expr)}) AS double)"


def number(col: Column) -> Column:
    """Null, blank or unreadable becomes 0.0."""
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def money(col: Column) -> Column:
    """Money text or number as a decimal, null and blank as 0."""
    text = F.nullif(F.trim(col.cast("string")), F.lit(""))
    return F.coalesce(text.try_cast(MONEY), F.lit(0).cast(MONEY))


def cents(col: Column) -> Column:
    """Gateway amounts arrive in hundredths whatever the currency."""
    return (col.cast("decimal(18,2)") / F.lit(100)).cast(MONEY)


def safe_ratio(num: Column, den: Column) -> Column:
    """NULL when the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def count_of(col: Column) -> Column:
    """Half-even rounding to a whole number."""
    return F.bround(col, 0).cast("bigint")


def round_exact(col: Column, digits: int) -> Column:
    """Round half to even on the exact binary value, as report figures are rounded.

    ``bround`` works on the shortest decimal text of a double and so moves 2.675 to 2.68, though
    the stored value lies below the tie. The number formatter looks at the value itself.
    """
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", col.cast("double"), F.lit(pattern)).cast("double")


def floor_zero(col: Column) -> Column:
    return F.greatest(col, F.lit(0.0))
