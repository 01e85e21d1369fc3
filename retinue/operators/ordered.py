"""Values of the previous row in a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retinue.operators.staging import RANGE, ranges_for, settle, with_range


def with_previous(
    df: DataFrame, group: str, order: Sequence[str], values: dict[str, str], *, task_rows: int
) -> DataFrame:
    """Add ``values[column]``: the column's value in the previous row of the group.

    ``group + order`` must be unique. Rows are ranged over (group, order), so a group may be
    of any size, and pass one shuffle. Inside a range a window finds the previous row. The
    predecessor of a group's first row in a range can only be the last row of the range
    before, which is found on the map side, one row per range. ``task_rows`` only sizes the
    ranges.
    """
    df = settle(df)
    rows = df.count()
    ranges = ranges_for(rows, task_rows)
    numbered = with_range(df, [F.col(group), *[F.col(c) for c in order]], rows, ranges)
    w = Window.partitionBy(RANGE, group).orderBy(*order)
    local = numbered.repartitionById(ranges, F.col(RANGE)).withColumns(
        {
            **{out: F.lag(column).over(w) for column, out in values.items()},
            "_first": F.row_number().over(w) == 1,
        }
    )
    last_row = F.max(F.struct(group, *order, *[c for c in values if c not in order]))
    # A range without rows can only be the first one, so the range before is the one before.
    last = numbered.groupBy(RANGE).agg(last_row.alias("_last")).select((F.col(RANGE) + 1).alias(RANGE), "_last")
    joined = local.join(last, RANGE, "left")
    continues = F.col("_first") & (F.col("_last")[group] == F.col(group))
    return joined.withColumns(
        {
            out: F.when(continues, F.col("_last")[column]).otherwise(F.col(out))
            for column, out in values.items()
        }
    ).drop(RANGE, "_first", "_last")
