"""First look at the tables: sizes, keys, gaps, distributions and known anomalies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.functions.numeric import percent, round_to
from retinue.operators.keyed import top
from retinue.settings import DEFAULTS, Params
from retinue.sources.schemas import REPORT_NAMES
from retinue.sources.tables import Tables, with_tables

# Nullable order dates and the names their counts are reported under.
ORDER_DATES = {
    "approved": "order_approved_at",
    "carrier": "order_delivered_carrier_date",
    "delivered": "order_delivered_customer_date",
}


def row_counts(t: Tables) -> DataFrame:
    counts = [
        t[name].agg(F.count("*").alias("nb_lignes")).select(F.lit(label).alias("table_name"), "nb_lignes")
        for name, label in REPORT_NAMES.items()
        if name in t
    ]
    return reduce(DataFrame.unionByName, counts)


def key_audit(t: Tables) -> DataFrame:
    """Account rows against account ids against real customers."""
    return t["customers"].agg(
        F.count("*").alias("total_lignes"),
        F.countDistinct("customer_id").alias("nb_customer_ids_distincts"),
        F.countDistinct("customer_unique_id").alias("nb_clients_reels"),
    )


def customers_with_many_ids(t: Tables) -> DataFrame:
    return (
        t["customers"]
        .groupBy("customer_unique_id")
        .agg(F.countDistinct("customer_id").alias("nb_customer_ids"))
        .where(F.col("nb_customer_ids") > 1)
    )


def order_dates_present(t: Tables) -> DataFrame:
    return t["orders"].agg(
        F.count("*").alias("total"),
        *[F.count(c).alias(f"{name}_non_null") for name, c in ORDER_DATES.items()],
    )


def order_dates_missing(t: Tables) -> DataFrame:
    return t["orders"].agg(
        F.lit("orders").alias("table_name"),
        F.count("*").alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"{name}_null") for name, c in ORDER_DATES.items()],
    )


def category_gaps(t: Tables) -> DataFrame:
    category = F.count("product_category_name")
    return t["products"].agg(
        F.count("*").alias("total_produits"),
        category.alias("avec_categorie"),
        (F.count("*") - category).alias("sans_categorie"),
    )


def null_profile(t: Tables) -> DataFrame:
    """Rows, filled and missing values of the nullable columns that matter, one line each."""
    checks = [("orders", c) for c in ORDER_DATES.values()] + [("products", "product_category_name")]
    lines = []
    for table in ("orders", "products"):
        columns = [c for name, c in checks if name == table]
        counts = t[table].agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in columns])
        lines.append(
            counts.unpivot("total", columns, "colonne", "non_null").select(
                F.lit(table).alias("table_name"),
                "colonne",
                "total",
                "non_null",
                (F.col("total") - F.col("non_null")).alias("nb_null"),
            )
        )
    return lines[0].unionByName(lines[1])


def distribution(df: DataFrame, column: str, count: str) -> DataFrame:
    """Rows per value and their share, from one pass: the counts add up to the total."""
    total = F.sum(count).over(Window.partitionBy())
    return (
        df.groupBy(column)
        .agg(F.count("*").alias(count))
        .withColumn("pct", round_to(percent(F.col(count), total), 2))
    )


def status_distribution(t: Tables) -> DataFrame:
    return distribution(t["orders"], "order_status", "nb_commandes").orderBy(
        F.col("nb_commandes").desc(), F.col("order_status").asc_nulls_last()
    )


def score_distribution(t: Tables) -> DataFrame:
    return distribution(t["order_reviews"], "review_score", "nb_reviews").orderBy(
        F.col("review_score").asc_nulls_last()
    )


def bad_review_rate(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    bad = F.count_if(F.col("review_score") <= p.bad_score)
    return t["order_reviews"].agg(
        bad.alias("mauvaises_reviews"),
        F.count("*").alias("total_reviews"),
        round_to(percent(bad, F.count("*")), 2).alias("pct_mauvaises"),
    )


def delivered_without_date() -> Column:
    return (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull()


def incoherent_orders(t: Tables) -> DataFrame:
    return t["orders"].agg(F.count_if(delivered_without_date()).alias("nb_incoherences"))


def orders_without_items(t: Tables) -> DataFrame:
    """Item rows shrink to order ids before the shuffle, however many one order has."""
    return t["orders"].join(t["order_items"].select("order_id").distinct(), "order_id", "left_anti")


def shipped_without_items(t: Tables) -> DataFrame:
    shipped = t["orders"].where(F.col("order_status") == "shipped")
    return orders_without_items(with_tables(t, orders=shipped)).select("order_id", "order_status")


def orphan_reviews(t: Tables) -> DataFrame:
    """Reviews of unknown orders. Missing order ids have no match either."""
    return t["order_reviews"].join(t["orders"].select("order_id"), "order_id", "left_anti")


def top_cities(t: Tables, rows: int = 20) -> DataFrame:
    per_city = t["customers"].groupBy("customer_city").agg(F.count("*").alias("nb_clients"))
    return top(per_city, rows, F.col("nb_clients").desc(), F.col("customer_city").asc_nulls_last())


def city_variants(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    """Spellings that contain one of the searched city names (case and accents count)."""
    city = F.col("customer_city")
    matches = reduce(Column.__or__, [city.contains(name) for name in p.city_patterns], F.lit(False))
    return t["customers"].where(matches).select("customer_city").distinct().orderBy("customer_city")
