"""From CSV files to the feature snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.operators.staging import settle
from retinue.plans.audit import row_counts
from retinue.plans.cleaning import correct_orders
from retinue.plans.features import PERSON, customer_features
from retinue.plans.quality import constraints
from retinue.settings import DEFAULTS, Params
from retinue.session import staging_scope
from retinue.sources.csv_files import POSITION, import_table, read_reviews
from retinue.sources.schemas import TABLES
from retinue.sources.stored import StoredTable
from retinue.sources.tables import (
    Tables,
    create_view,
    load_tables,
    materialize,
    save_tables,
    with_tables,
)


@dataclass
class Build:
    """What a run leaves behind; every frame reads from ``folder``."""

    tables: Tables
    features: DataFrame
    counts: DataFrame
    violations: DataFrame


def import_csv(spark: SparkSession, files: dict[str, str], folder: str) -> Tables:
    """Load typed CSV files and store them.

    Reviews are added to those of former imports: the first row of a review stays, also
    against later files. The other tables are replaced.
    """
    reviews = StoredTable(spark, f"{folder}/order_reviews")
    if not reviews.exists():
        none = spark.createDataFrame([], TABLES["order_reviews"].schema)
        reviews.replace(none, key=TABLES["order_reviews"].key)
    reviews.insert_ignore(read_reviews(spark, files["order_reviews"]), POSITION)
    save_tables({name: import_table(spark, files[name], name) for name in TABLES if name != "order_reviews"}, folder)
    return with_tables(load_tables(spark, folder), order_reviews=reviews.read())


def build(spark: SparkSession, files: dict[str, str], folder: str, p: Params = DEFAULTS) -> Build:
    """Import, check, clean, and write the feature snapshot. Any failure stops the run.

    So do rules that the features rely on (:func:`broken`): the violations are written, but
    no snapshot, and readers keep the former one. Staged data is deleted in any case.
    """
    with staging_scope(spark):
        raw = import_csv(spark, files, f"{folder}/raw")
        counts = materialize(with_dropped_reviews(spark, files, row_counts(raw)), f"{folder}/row_counts")
        violations = materialize(constraints(raw), f"{folder}/violations")
        faults = broken(violations).collect()
        if faults:
            raise ValueError(f"rules are broken: {[tuple(r) for r in faults]}")

        orders = StoredTable(spark, f"{folder}/clean/orders")
        orders.replace(raw["orders"])
        correct_orders(orders)
        tables = with_tables(raw, orders=orders.read())

        features = materialize(customer_features(tables, p), f"{folder}/mv_customer_features")
        create_view(features)
        return Build(tables, features, counts, violations)


def broken(violations: DataFrame) -> DataFrame:
    """Violated rules that make the features wrong: repeated keys of one column, missing values, ranges.

    Repeated keys of order lines are no fault to the features, nor are unknown parents.
    """
    single = (F.col("controle") == "cle") & ~F.col("colonnes").contains(",")
    return violations.where((F.col("nb_violations") > 0) & (single | F.col("controle").isin("non_null", "domaine")))


def with_dropped_reviews(spark: SparkSession, files: dict[str, str], counts: DataFrame) -> DataFrame:
    """Adds the rows of the review files, and how many of them repeat a review."""
    rows = read_reviews(spark, files["order_reviews"])
    read = rows.agg(F.count("*").alias("lus"), F.countDistinct("review_id").alias("gardes"))
    lines = read.select(
        F.expr("stack(2, 'reviews_fichier', lus, 'reviews_doublons', lus - gardes)").alias("table_name", "nb_lignes")
    )
    return counts.unionByName(lines)


def preview(features: DataFrame, rows: int = 10) -> DataFrame:
    """Some columns of some customers, each line with the size of the table, from one evaluation."""
    table = settle(
        features.select(
            PERSON,
            "nb_commandes",
            "jours_depuis_derniere_commande",
            "segment_client",
            "est_churne",
        )
    )
    return table.orderBy(PERSON).limit(rows).withColumn("nb_clients", table.agg(F.count("*")).scalar())
