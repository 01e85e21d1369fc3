"""Rank over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retinue.operators.staging import RANGE, in_ranges, settle, sums_before


def with_rank(df: DataFrame, key: str, value: str, out: str, *, task_rows: int) -> DataFrame:
    """Add the rank of ``value``, highest first, with gaps after ties; NULL has no rank.

    ``key`` must be unique. ``df`` is read several times: pass a settled frame. Rows go
    through one shuffle and are ranked range by range; ``task_rows`` only sizes the ranges.
    Equal values may fill several ranges, as ``key`` breaks ties between ranges. They all
    take the rank found in the first of them, handed on from range to range.
    """
    valued = df.where(F.col(value).isNotNull())
    inside = Window.partitionBy(RANGE).orderBy(F.col(value).desc())
    local = settle(
        in_ranges(valued, [-F.col(value), F.col(key)], valued.count(), task_rows).withColumn(
            "_local", F.rank().over(inside).cast("bigint")
        )
    )
    ranges = local.groupBy(RANGE).agg(
        F.count("*").alias("_n"), F.min(value).alias("_lowest"), F.max("_local").alias("_lowest_local")
    )
    first = F.min(F.col("_offset") + F.col("_lowest_local")).over(Window.partitionBy("_lowest"))
    borders = settle(sums_before(ranges, RANGE, "_n", "_offset").withColumn("_lowest_rank", first))
    # A range without rows can only be the first one, so the range before is the one before.
    handed = borders.select(
        (F.col(RANGE) + 1).alias(RANGE), F.col("_lowest").alias("_carried"), F.col("_lowest_rank").alias("_carried_rank")
    )
    placed = local.join(borders.select(RANGE, "_offset").join(handed, RANGE, "left"), RANGE)
    rank = F.when(F.col(value) == F.col("_carried"), F.col("_carried_rank")).otherwise(
        F.col("_offset") + F.col("_local")
    )
    unranked = df.where(F.col(value).isNull()).withColumn(out, F.lit(None).cast("bigint"))
    return placed.select(*df.columns, rank.cast("bigint").alias(out)).unionByName(unranked)
