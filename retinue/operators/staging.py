"""Cutting a plan where a result is read several times, and cutting a table into ordered ranges."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.session import new_folder

RANGE = "_range"
#: Sampled rows for each range; sizes of ranges differ by about an eighth.
SAMPLES = 64


def settle(df: DataFrame, *folders: str) -> DataFrame:
    """Compute once, into a table in the shared folder.

    Readers that ask for some values of the columns ``folders`` open no files of others. The result has no lineage, so a lost executor costs at most the tasks it was running.
    As parquet it is compact, each reader takes only its columns, and its size is known
    to the planner.
    """
    path = new_folder(df.sparkSession, "staged")
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_range(df: DataFrame, order: list[Column], rows: int, ranges: int) -> DataFrame:
    """Add the number of the range each row lies in, when ``df`` is cut into ``ranges`` along ``order``.

    Rows are sampled by a hash of the order columns, so that the borders, quantiles of the
    sample, are the same whenever they are computed: the number is a function of the row and
    may be computed in several places. It is found by halving steps among the borders.
    ``df`` is read for the sample too.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    every = max(1, rows // (SAMPLES * ranges))
    sample = df.select(key.alias("k")).where(F.pmod(F.xxhash64("k"), F.lit(every)) == 0)
    numbered = sample.select(
        "k", F.row_number().over(Window.orderBy("k")).cast("bigint").alias("i"), F.count("*").over(Window.partitionBy()).alias("n")
    )
    passed = F.floor(F.col("i") * ranges / F.col("n")) > F.floor((F.col("i") - 1) * ranges / F.col("n"))
    borders = numbered.where(passed & (F.col("i") < F.col("n"))).agg(F.sort_array(F.collect_list("k"))).scalar()
    placed = df.withColumns({"_borders": borders, "_key": key, RANGE: F.lit(0)})
    for step in (1 << n for n in range(ranges.bit_length() - 1, -1, -1)):
        ahead = F.get("_borders", F.col(RANGE) + (step - 1)) <= F.col("_key")
        placed = placed.withColumn(RANGE, F.when(ahead, F.col(RANGE) + step).otherwise(F.col(RANGE)))
    return placed.drop("_borders", "_key")


def ranges_for(rows: int, task_rows: int) -> int:
    """So many that each holds about ``task_rows / 2``."""
    return max(2, ceil(2 * rows / task_rows))


def in_ranges(df: DataFrame, order: list[Column], rows: int, task_rows: int) -> DataFrame:
    """Deal rows into consecutive ranges of about ``task_rows / 2``, numbered, each in a task of its own.

    ``order`` must end in a unique column: rows that agree on the leading columns then
    spread over several ranges. ``df`` is read twice, for the sample and for its one shuffle.
    """
    ranges = ranges_for(rows, task_rows)
    numbered = with_range(df, order, rows, ranges)
    # Tells the planner that ranges are apart, and never puts two of them into one task.
    return numbered.repartitionById(ranges, F.col(RANGE))


def sums_before(df: DataFrame, order: str, value: str, out: str, block: int = 1000) -> DataFrame:
    """Add the sum of ``value`` over the rows of smaller ``order``, a unique whole number.

    Two levels: blocks of ``order`` are summed side by side, then one task sums the blocks.
    """
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.withColumn("_block", F.floor(F.col(order) / block))
    totals = blocks.groupBy("_block").agg(F.sum(value).alias("_total"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    local = blocks.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(before, "_block").withColumn(out, F.col("_before") + F.col("_inside")).select(*df.columns, out)
