"""Parquet storage of the model tables and of the feature snapshot."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterator, Mapping
from datetime import timedelta
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.operators.staging import settle
from retinue.sources.schemas import TABLES
from retinue.sources.stored import StoredTable

Tables = Mapping[str, DataFrame]


class LazyTables(Tables):
    """Tables that are opened when first used."""

    def __init__(self, openers: dict[str, Callable[[], DataFrame]]):
        self._openers = openers
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)


def with_tables(t: Tables, **changed: DataFrame) -> Tables:
    """The same tables with some of them exchanged."""
    return ChainMap(changed, t)

# Tables whose joins all run on this column (the joins the indexed layout serves).
JOIN_KEYS = {
    "orders": "order_id",
    "order_items": "order_id",
    "order_payments": "order_id",
    "order_reviews": "order_id",
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns, in order and with the declared types."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].schema.fields]
    )


def save_tables(tables: Tables, folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_tables(spark: SparkSession, folder: str) -> Tables:
    def opener(name: str):
        return lambda: spark.read.schema(TABLES[name].schema).parquet(f"{folder}/{name}")

    return LazyTables({name: opener(name) for name in TABLES})


def register_views(tables: Tables, prefix: str = "") -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def create_view(df: DataFrame, name: str = "v_customer_features") -> DataFrame:
    """Name the lazy result; every read of the view runs its plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize(df: DataFrame, path: str, sort_by: str | None = None) -> DataFrame:
    """Write a snapshot as the next version of the table at ``path``, and read it back.

    Readers of any session see the former version until the new one is complete; ``df`` may
    read the former one.
    """
    table = StoredTable(df.sparkSession, path)
    return table.read(table.replace(df, sort_by=sort_by).version)


def refresh(
    df: DataFrame,
    path: str,
    sort_by: str | None = None,
    view: str | None = None,
    keep: timedelta = timedelta(days=7),
) -> int:
    """Rewrite the snapshot from current data and return its number of rows.

    ``view`` is pointed to the new version, which other sessions find by ``path``. Versions
    that were replaced more than ``keep`` ago are deleted.
    """
    table = StoredTable(df.sparkSession, path)
    change = table.replace(df, sort_by=sort_by)
    if view:
        table.read(change.version).createOrReplaceTempView(view)
    table.vacuum(keep)
    return change.rows


def _bucket_sizes(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.groupBy(F.expr(f"pmod(hash({key}), {buckets})").alias("bucket")).agg(F.count("*").alias("n"))


def heaviest_bucket_share(df: DataFrame, key: str, buckets: int) -> float:
    """Share of all rows that the fullest of ``buckets`` hash buckets would get."""
    row = _bucket_sizes(df, key, buckets).agg(F.max("n").alias("top"), F.sum("n").alias("total")).first()
    return (row["top"] or 0) / (row["total"] or 1)


def save_bucketed(
    tables: Tables,
    folder: str,
    buckets: int,
    prefix: str,
    max_share: float | None = None,
    bucket_rows: int = 1_000_000,
) -> Tables:
    """Store the order-keyed tables in buckets so that joins on ``order_id`` skip the shuffle.

    A bucket is a task of every later join, so ``buckets`` is doubled until the largest table
    has no more than ``bucket_rows`` rows a bucket on average. A table whose fullest bucket has
    over ``max_share`` of all rows is stored unbucketed: its joins then shuffle, where adaptive
    execution can split the hot partition. By default that is halfway between a fair share and
    all rows, and four fair shares at most.
    """
    # Finer buckets, which add up to those of each number that may be chosen.
    sizes = {n: settle(_bucket_sizes(tables[n], key, buckets << 10)) for n, key in JOIN_KEYS.items()}
    rows = max(s.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for s in sizes.values())
    chosen = buckets << min(10, max(0, ceil(rows / (buckets * bucket_rows)) - 1).bit_length())
    limit = min(4.0 / chosen, (1 + 1 / chosen) / 2) if max_share is None else max_share
    stored = {}
    for name, key in JOIN_KEYS.items():
        df = tables[name]
        spark = df.sparkSession
        path = f"{folder}/{name}"
        per_bucket = sizes[name].groupBy(F.col("bucket") % chosen).agg(F.sum("n").alias("n"))
        top, total = per_bucket.agg(F.max("n"), F.sum("n")).first()
        if (top or 0) / (total or 1) > limit:
            df.write.mode("overwrite").parquet(path)
            stored[name] = spark.read.parquet(path)
            continue
        (
            df.repartition(chosen, key)
            .write.mode("overwrite")
            .bucketBy(chosen, key)
            .sortBy(key)
            .option("path", path)
            .saveAsTable(f"{prefix}_{name}")
        )
        stored[name] = spark.table(f"{prefix}_{name}")
    return with_tables(tables, **stored)
