"""The cleaning rules. Each returns a new frame; raw tables stay untouched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.operators.keyed import first_per_key
from retinue.plans.audit import delivered_without_date
from retinue.sources.csv_files import POSITION
from retinue.sources.stored import Change, StoredTable
from retinue.sources.tables import Tables, with_tables


def dedup_reviews(raw: DataFrame, position: str = POSITION) -> DataFrame:
    """First delivered row of each ``review_id``, also when copies name other orders."""
    return first_per_key(raw, ["review_id"], position).drop(position)


def clean_orders(orders: DataFrame) -> DataFrame:
    """A delivered order needs a delivery date; without one it counts as shipped."""
    status = F.when(delivered_without_date(), F.lit("shipped")).otherwise(F.col("order_status"))
    return orders.withColumn("order_status", status)


def correct_orders(table: StoredTable) -> Change:
    """The same rule on a stored table: only files with such an order are written again."""
    return table.update(delivered_without_date(), order_status=F.lit("shipped"))


def clean(t: Tables) -> Tables:
    """Cleaned tables.

    Missing categories, orders without items and missing dates carry meaning and stay.
    """
    return with_tables(t, orders=clean_orders(t["orders"]))
