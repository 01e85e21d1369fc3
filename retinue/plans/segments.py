"""Churn label, customer segments and the calibration of the churn threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.functions.numeric import percent, round_to
from retinue.settings import DEFAULTS, SEGMENTS, Params


def churn_label(inactive_days: Column, p: Params = DEFAULTS) -> Column:
    return F.when(inactive_days > p.churn_days, 1).otherwise(0)


def segment(orders: Column, inactive_days: Column, p: Params = DEFAULTS) -> Column:
    """First matching rule wins: recent customers split by their number of orders."""
    nouveau, actif, a_risque, churne = SEGMENTS
    return (
        F.when((inactive_days <= p.active_days) & (orders == 1), nouveau)
        .when(inactive_days <= p.active_days, actif)
        .when(inactive_days <= p.churn_days, a_risque)
        .otherwise(churne)
    )


def business_rank(column: Column) -> Column:
    """Sort key that follows the life of a customer rather than the alphabet."""
    rank = F.when(F.lit(False), F.lit(0))
    for place, name in enumerate(SEGMENTS):
        rank = rank.when(column == name, F.lit(place))
    return rank.otherwise(F.lit(len(SEGMENTS)))


def churn_calibration(features: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Share of customers beyond each candidate threshold, from one pass over the table."""
    days = F.col("jours_depuis_derniere_commande")
    counts = features.agg(
        F.count("*").alias("nb_clients"),
        *[F.count_if(days > d).alias(str(d)) for d in p.calibration_days],
    )
    return counts.unpivot(
        "nb_clients", [str(d) for d in p.calibration_days], "seuil_jours", "nb_churnes"
    ).select(
        F.col("seuil_jours").cast("int").alias("seuil_jours"),
        "nb_clients",
        "nb_churnes",
        round_to(percent(F.col("nb_churnes"), F.col("nb_clients")), 2).alias("taux_churn"),
    )
