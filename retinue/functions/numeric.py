"""Exact averages, guarded ratios and the two rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL for an empty ``whole``.

    Both sides turn into doubles only here, after they were summed exactly.
    """
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def mean(value: Column) -> Column:
    """Average of the non-null values; the sum stays exact for integers and decimals."""
    return ratio(F.sum(value), F.count(value))


def decimal_ratio(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` of a decimal with a single rounding, on its unscaled value.

    Equal averages give equal doubles, which ranks with ties depend on; turning the total
    into a double first would round twice.
    """
    unit = 10**scale
    return ratio(total * F.lit(unit), count * F.lit(unit))


def decimal_mean(value: Column, scale: int = 2) -> Column:
    """Average of a decimal column of the given scale."""
    return decimal_ratio(F.sum(value), F.count(value), scale)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * F.lit(100), whole)


def round_to(value: Column, digits: int) -> Column:
    """Round a double half away from zero, on the value scaled by a power of ten.

    Spark's own ``round`` looks at the shortest decimal text of the double, which
    differs for ties such as 1.005.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double half to even, as data frames round their columns for display."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * F.lit(scale)) / F.lit(scale)


def money(value: Column) -> Column:
    """The decimal type of every reported amount."""
    return value.cast("decimal(18,2)")
