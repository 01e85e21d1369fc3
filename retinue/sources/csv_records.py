"""One large CSV file with line breaks inside quotes, read by many tasks.

A line break ends a record if the quotes before it in the file are even in number. Each block
of the file counts its own quotes; the counts of the blocks before tell whether a block
begins inside a field. So borders of records are found without reading a file in one piece,
and Spark's CSV parser gets whole records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retinue.operators.staging import settle

POSITION = "file_position"
_PLACE = ("file", "block", "line")


def marked_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place, and whether they begin a record should the block begin outside or inside a field.

    ``inside`` is the parity of the quotes before the line in its block. ``starts_0`` and
    ``starts_1`` number the records that begin up to the line in either case. ``next`` is the
    parity at the next line of the block.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("line")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    return placed.withColumn("inside", inside).withColumns(
        {
            "starts_0": F.count_if(F.col("inside") == 0).over(upto),
            "starts_1": F.count_if(F.col("inside") == 1).over(upto),
            "next": F.lead("inside").over(in_block),
        }
    )


def _borders(lines: DataFrame) -> DataFrame:
    """For each block whether it begins inside a field, and the last record that began in a block before it."""
    blocks = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).cast("int").alias("odd"), F.max("starts_0").alias("n_0"), F.max("starts_1").alias("n_1")
    )
    # One row per block of a file.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = blocks.withColumn("open", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    records = F.when(F.col("open") == 0, F.col("n_0")).otherwise(F.col("n_1"))
    begun = F.when(records > 0, F.struct(F.col("block").alias("block"), records.alias("record")))
    return opened.select("file", "block", "open", F.last(begun, ignorenulls=True).over(before).alias("begun"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``record``, the text of each record, its place, and whether it is the ``first`` of its file.

    Line breaks inside a record become ``\\n``. Lines are read once, marked block by block, and staged. Only records of several lines, or
    at the end of a block, are put together by a shuffle.
    """
    lines = settle(marked_lines(spark, path))
    placed = lines.join(_borders(lines), ["file", "block"])
    number = F.when(F.col("open") == 0, F.col("starts_0")).otherwise(F.col("starts_1"))
    own = F.struct("block", number.alias("record"))
    owned = placed.withColumn("owner", F.when(number > 0, own).otherwise(F.col("begun")))
    alone = (F.col("inside") == F.col("open")) & F.coalesce(F.col("next") == F.col("open"), F.lit(False))
    place = F.struct(*_PLACE)
    first = (F.col("owner.block") == 0) & (F.col("owner.record") == 1)
    single = owned.where(alone).select(F.col("value").alias("record"), place.alias(POSITION), first.alias("first"))
    parts = owned.where(~alone).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts")
    )
    start = F.col("parts")[0]
    joined = parts.select(
        F.array_join(F.transform("parts", lambda part: F.rtrim(part["value"], F.lit("\r"))), "\n").alias("record"),
        F.struct("file", start["block"].alias("block"), start["line"].alias("line")).alias(POSITION),
        first.alias("first"),
    )
    whole = F.rtrim(F.col("record"), F.lit("\r")).alias("record")
    return single.unionByName(joined).select(whole, POSITION, "first").where(F.col("record") != "")


def _fields(record: Column, schema: T.StructType) -> Column:
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    return F.from_csv(record, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed rows of CSV files with a header each, and the place of each row (``file_position``).

    Quotes follow the usual rule: a field with a quote, comma or line break is quoted, quotes
    inside are doubled. A malformed row, or a header with other names, fails the job. Places
    grow along a file, whichever tasks read it. One record must fit a task.
    """
    rows = records(spark, path)
    names = F.transform(F.split("record", ","), lambda name: F.trim(F.replace(name, F.lit('"'), F.lit(""))))
    wanted = F.array(*[F.lit(name) for name in schema.names])
    wrong = rows.where(F.col("first") & (names != wanted)).select("record").first()
    if wrong is not None:
        raise ValueError(f"a header does not name the columns {schema.names}: {wrong.record}")
    # A filter on the parsed columns may be evaluated before the one on ``first``.
    parsed = F.when(~F.col("first"), _fields(F.col("record"), schema))
    return rows.where(~F.col("first")).select(parsed.alias("row"), POSITION).select("row.*", POSITION)
