"""The benchmark tables seen as the marketplace model."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.operators.keyed import first_per_key
from retinue.sources.csv_files import POSITION
from retinue.sources.tables import LazyTables, Tables, conform


# Columns of the benchmark tables; declaring them saves a job per table that would infer them.
BASE = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}


def read_base(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(BASE[name]).parquet(f"{folder}/{name}.parquet")


def load_model(spark: SparkSession, folder: str) -> Tables:
    """All eight tables; reviews are already reduced to one row per ``review_id``."""

    @cache
    def read(name: str) -> DataFrame:
        return read_base(spark, folder, name)

    def reviews(_) -> DataFrame:
        first = first_per_key(raw_reviews(spark, folder), ["review_id"], POSITION)
        none = F.lit(None)
        return first.withColumns(
            {
                "review_comment_title": none,
                "review_comment_message": none,
                "review_answer_timestamp": none,
            }
        )

    views = {
        "customers": _customers,
        "sellers": _sellers,
        "products": _products,
        "product_category_name_translation": _translation,
        "orders": _orders,
        "order_items": _items,
        "order_payments": _payments,
        "order_reviews": reviews,
    }

    def opener(name: str):
        return lambda: conform(views[name](read), name)

    return LazyTables({name: opener(name) for name in views})


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews as delivered: some ``review_id`` occur twice; ``file_position`` orders them."""
    events = read_base(spark, folder, "events")
    event = F.col("event_id")
    rows = events.select(
        F.when(event % 100 == 99, event - 1).otherwise(event).cast("string").alias("review_id"),
        (event * 2).cast("string").alias("order_id"),
        (F.floor("value") % 5 + 1).cast("int").alias("review_score"),
        F.col("ts").alias("review_creation_date"),
        event.alias(POSITION),
    )
    return rows


def _places(read) -> DataFrame:
    nation, region = read("nation"), read("region").dropDuplicates(["r_regionkey"])
    return (
        nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
        .select(
            "n_nationkey",
            F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("zip"),
            F.lower("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )
        .dropDuplicates(["n_nationkey"])
    )


def _customers(read) -> DataFrame:
    """One account per order; a person owns up to four groups of accounts.

    Left joins on keys known to be unique: the optimizer leaves them out of every plan
    that does not ask for the place of a customer.
    """
    owners = read("customer").select("c_custkey", "c_nationkey").dropDuplicates(["c_custkey"])
    orders = read("orders").select("o_orderkey", "o_custkey")
    places = _places(read)
    return (
        orders.join(owners, orders["o_custkey"] == owners["c_custkey"], "left")
        .join(places, owners["c_nationkey"] == places["n_nationkey"], "left")
        .select(
            F.col("o_orderkey").cast("string").alias("customer_id"),
            F.concat(
                F.col("o_custkey").cast("string"), F.lit("-"), (F.col("o_orderkey") % 4).cast("string")
            ).alias("customer_unique_id"),
            F.col("zip").alias("customer_zip_code_prefix"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )
    )


def _sellers(read) -> DataFrame:
    supplier, places = read("supplier"), _places(read)
    return supplier.join(places, supplier["s_nationkey"] == places["n_nationkey"], "left").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("zip").alias("seller_zip_code_prefix"),
        F.col("city").alias("seller_city"),
        F.col("state").alias("seller_state"),
    )


def _products(read) -> DataFrame:
    none = F.lit(None)
    return read("part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.nullif(F.col("p_brand"), F.lit("Brand#13")).alias("product_category_name"),
        none.cast("int").alias("product_name_lenght"),
        none.cast("int").alias("product_description_lenght"),
        F.col("p_size").alias("product_photos_qty"),
        none.cast("decimal(10,2)").alias("product_weight_g"),
        none.cast("decimal(10,2)").alias("product_length_cm"),
        none.cast("decimal(10,2)").alias("product_height_cm"),
        none.cast("decimal(10,2)").alias("product_width_cm"),
    )


def _translation(read) -> DataFrame:
    brands = read("part").where(~F.col("p_brand").isin("Brand#13", "Brand#7")).select("p_brand").distinct()
    return brands.select(
        F.col("p_brand").alias("product_category_name"),
        F.concat(F.lit("EN_"), "p_brand").alias("product_category_name_english"),
    )


def _orders(read) -> DataFrame:
    key, day, status = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")

    def after(days: int):
        return day + F.expr(f"interval {days} day")

    return read("orders").select(
        key.cast("string").alias("order_id"),
        key.cast("string").alias("customer_id"),
        F.when(key % 50 == 0, "canceled")
        .when(key % 50 == 1, "unavailable")
        .when(status == "F", "delivered")
        .when(status == "O", "shipped")
        .when(status == "P", "processing")
        .alias("order_status"),
        day.alias("order_purchase_timestamp"),
        F.when(key % 97 != 0, after(1)).alias("order_approved_at"),
        F.when(status != "P", after(3)).alias("order_delivered_carrier_date"),
        F.when((status == "F") & (key % 37 != 0), after(9)).alias("order_delivered_customer_date"),
        after(20).alias("order_estimated_delivery_date"),
    )


def _items(read) -> DataFrame:
    return read("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
    )


def _payments(read) -> DataFrame:
    key = F.col("o_orderkey")
    order_id = key.cast("string").alias("order_id")
    first = read("orders").select(
        order_id,
        F.lit(1).alias("payment_sequential"),
        F.expr("substr(o_orderpriority, 3)").alias("payment_type"),
        (key % 6 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("payment_value"),
    )
    second = (
        read("orders")
        .where(key % 5 == 0)
        .select(
            order_id,
            F.lit(2).alias("payment_sequential"),
            F.lit("VOUCHER").alias("payment_type"),
            F.lit(1).alias("payment_installments"),
            F.lit(10).cast("decimal(10,2)").alias("payment_value"),
        )
    )
    return first.unionByName(second)
