"""Calendar arithmetic on timestamps without a time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_gap(later: Column, earlier: Column) -> Column:
    """Midnights crossed from ``earlier`` to ``later`` (not full 24-hour spans)."""
    return F.datediff(later, earlier).cast("bigint")


def month_start(ts: Column) -> Column:
    """First instant of the month; goes through a date so that no time zone takes part."""
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")
