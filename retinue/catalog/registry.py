"""Where queries and their oracle SQL are recorded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.catalog.model_sql import oracle
from retinue.operators.staging import settle
from retinue.plans.features import customer_features
from retinue.plans.states import READ
from retinue.settings import Params
from retinue.sources.csv_files import POSITION
from retinue.sources.schemas import TABLES
from retinue.sources.tables import Tables, with_tables
from retinue.sources.testdata import load_model, raw_reviews


@dataclass
class Context:
    """What a query works on."""

    spark: SparkSession
    folder: str

    @cached_property
    def t(self) -> Tables:
        return load_model(self.spark, self.folder)

    @property
    def raw_reviews(self) -> DataFrame:
        return raw_reviews(self.spark, self.folder)

    @property
    def whole_reviews(self) -> DataFrame:
        """Reviews as delivered, with all columns of the table and their place."""
        raw = self.raw_reviews
        columns = [
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES["order_reviews"].schema.fields
        ]
        return raw.select(*columns, POSITION)

    @cached_property
    def skewed(self) -> Tables:
        """The same tables, but one customer owns a third of all accounts."""
        customers = self.t["customers"]
        hot = F.col("customer_id").cast("bigint") % 3 == 0
        person = F.when(hot, F.lit("hot")).otherwise(F.col("customer_unique_id"))
        return with_tables(self.t, customers=customers.withColumn("customer_unique_id", person))

    @cached_property
    def _loads(self) -> DataFrame:
        """The load that brings each order, 0 to 3: the first three quarters by time, then the rest in three."""
        orders = self.t["orders"].select("order_id", "customer_id", "order_purchase_timestamp")
        day = F.datediff("order_purchase_timestamp", F.lit("1970-01-01").cast("date"))
        cuts = orders.agg(F.percentile_approx(day, [0.75, 0.85, 0.95])).first()[0]
        load = sum(((day > cut).cast("int") for cut in cuts), F.lit(0))
        return settle(orders.select("order_id", "customer_id", load.alias("load")))

    @cached_property
    def _loaded(self) -> dict[str, DataFrame]:
        """What states read of each table, with the load that brings each row; written once, a folder per load."""
        return {name: settle(self._with_load(name).select(*columns, "load"), "load") for name, columns in READ.items()}

    def _with_load(self, name: str) -> DataFrame:
        table, loads = self.t[name], self._loads
        if name == "order_reviews":
            return table.withColumn("load", F.pmod(F.xxhash64("review_id"), F.lit(4)).cast("int"))
        if name == "order_payments":
            late = F.least(F.col("load") + F.col("payment_sequential") - 1, F.lit(3))
            return table.join(loads.drop("customer_id"), "order_id").withColumn("load", late)
        key = "customer_id" if name == "customers" else "order_id"
        return table.join(loads.select(key, "load"), key)

    def batch(self, load: int) -> Tables:
        """What one load brings; a second payment comes a load later, reviews come in any."""
        return self._loads_where(F.col("load") == load)

    def batches_before(self, load: int) -> Tables:
        return self._loads_where(F.col("load") < load)

    def _loads_where(self, chosen: Column) -> Tables:
        return with_tables(self.t, **{n: df.where(chosen).select(*READ[n]) for n, df in self._loaded.items()})

    @property
    def at_scale(self) -> Params:
        """A task size so small that these tables are cut into many ranges."""
        return Params(task_rows=max(1, self.t["orders"].count() // 12))

    def features(self, *columns: str) -> DataFrame:
        return customer_features(self.t, columns=columns or None)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, changed: dict[str, str] | None = None):
    """Record ``function(context)`` under ``name``, with the SQL of the same result.

    ``changed`` exchanges views of the SQL model.
    """

    def record(function: Callable[[Context], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Context(spark, folder))
        if sql is not None:
            ORACLES[name] = oracle(sql, changed)
        return function

    return record
