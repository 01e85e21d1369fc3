"""Per-key reductions that combine on the map side, so that hot keys stay small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """The row with the lowest ``position`` of every key; drop unneeded columns before.

    An aggregate rather than a window: copies of one key shrink to one row per map task
    before the shuffle, and no task ever holds all copies of a key.
    """
    others = [c for c in df.columns if c not in key and c != position]
    first = df.groupBy(*key).agg(F.min(F.struct(position, *others)).alias("_first"))
    return first.select(*[F.col(c) if c in key else F.col("_first")[c].alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("nb_lignes")).where(F.col("nb_lignes") > 1)


def most_frequent(counts: DataFrame, group: Sequence[str], value: str, count: str, out: str) -> DataFrame:
    """Per group the value with the highest count; the smallest value wins a tie.

    ``counts`` holds one row per (group, value). NULL is not a candidate.
    """
    return counts.groupBy(*group).agg(best_value(value, count).alias(out))


def best_value(value: str, count: str) -> Column:
    """Aggregate behind :func:`most_frequent`, to combine with others over the same group."""
    candidate = F.when(F.col(value).isNotNull(), F.struct(-F.col(count), F.col(value).alias("value")))
    return F.min(candidate)["value"]


def top(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """First ``rows`` rows; give a unique last order column for a stable choice."""
    return df.orderBy(*order).limit(rows)
