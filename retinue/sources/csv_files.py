"""CSV ingestion: typed loads for the data, inferred loads for a first look."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.operators.keyed import first_per_key
from retinue.sources.csv_records import POSITION, read_records
from retinue.sources.schemas import TABLES

# Only these hold free text with line breaks; the others are read line by line.
MULTILINE_TABLES = {"order_reviews"}


def read_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header and types taken from the data. For profiling: codes lose leading zeros."""
    return spark.read.csv(
        path, header=True, inferSchema=True, multiLine=multi_line, quote='"', escape='"'
    )


def read_typed(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> DataFrame:
    """Load one table with its declared schema; a malformed row fails the job.

    With ``multi_line`` one task reads each file whole; :func:`read_reviews` does not need that.
    """
    if multi_line is None:
        multi_line = table in MULTILINE_TABLES
    return spark.read.schema(TABLES[table].schema).csv(
        path,
        header=True,
        multiLine=multi_line,
        quote='"',
        escape='"',
        mode="FAILFAST",
        enforceSchema=False,
    )


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews with the place of each row; a file of any size is read by many tasks."""
    return read_records(spark, path, TABLES["order_reviews"].schema)


def import_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews with the first row of every ``review_id``; later copies are ignored."""
    return first_per_key(read_reviews(spark, path), TABLES["order_reviews"].key, POSITION).drop(POSITION)


def import_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    if table == "order_reviews":
        return import_reviews(spark, path)
    return read_typed(spark, path, table)


def head(df: DataFrame, rows: int = 5) -> DataFrame:
    """Some rows, in no particular order."""
    return df.limit(rows)
