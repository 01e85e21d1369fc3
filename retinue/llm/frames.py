"""What the operators share: reading tables, carrying rows, word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab and the line breaks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

ROW = "row"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def carried(docs: DataFrame, **named: Column | str) -> DataFrame:
    """The given columns, and every column of ``docs`` inside the struct ``row``.

    The operators work on names of their own, so that columns of the input can have any
    name. What nobody reads of ``row`` leaves the plan.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in named.values()]
    return docs.select(
        *[c.alias(name) for c, name in zip(columns, named, strict=True)],
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW),
    )


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def words_of(text: Column) -> Column:
    """The words of a text, in order; null for null. Faster than a regular expression."""
    spaced = text
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " ", -1), "")
