"""Customer features that follow new rows without reading old orders again.

Each customer has a stored state of sums, first and last order, and sets. States of new rows
are computed as those of all rows are, and merge into the stored ones: only files of changed
customers are written again. Features, and the rank among all customers, come from the states.

Orders are final once loaded and come with their items; reviews and payments may come before
or after their order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.functions.numeric import ratio
from retinue.operators.ranking import with_rank
from retinue.operators.staging import settle
from retinue.plans import features
from retinue.plans.features import BOUGHT_AT, PERSON
from retinue.settings import DEFAULTS, Params
from retinue.sources.schemas import FEATURE_COLUMNS
from retinue.sources.stored import Change, StoredTable
from retinue.sources.tables import Tables, with_tables

#: Columns that states are made of.
READ = {
    "customers": ("customer_id", PERSON),
    "orders": ("order_id", "customer_id", "order_status", BOUGHT_AT),
    "order_items": ("order_id", "product_id", "price", "freight_value"),
    "order_payments": ("order_id", "payment_type", "payment_installments"),
    "order_reviews": ("review_id", "order_id", "review_score"),
}
FACTS = tuple(READ)


def _added(old: Column, new: Column) -> Column:
    return F.coalesce(old + new, old, new)


def _united_map(old: Column, new: Column) -> Column:
    none = F.create_map().cast("map<string,bigint>")
    both = F.map_zip_with(
        F.coalesce(old, none), F.coalesce(new, none), lambda _, a, b: F.coalesce(a + b, a, b)
    )
    return F.when(old.isNotNull() | new.isNotNull(), both)


def _united(old: Column, new: Column) -> Column:
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_union(F.coalesce(old, none), F.coalesce(new, none)))
    return F.when(old.isNotNull() | new.isNotNull(), both)


#: How a column of two states of one customer becomes one.
MERGED: dict[str, Callable[[Column, Column], Column]] = {
    "nb_commandes": _added,
    "derniere_commande": F.greatest,
    "valeur_totale": _added,
    "nb_lignes": _added,
    "nb_commandes_avec_items": _added,
    "premiere": F.least,
    "derniere": F.greatest,
    "nb_reviews": _added,
    "nb_mauvaises_reviews": _added,
    "somme_scores": _added,
    "nb_scores": _added,
    "categories": _united,
    "paiements": _united_map,
    "versements": _added,
    "nb_versements": _added,
}


def _union(old: Tables | None, new: Tables) -> Tables:
    if old is None:
        return new
    return with_tables(new, **{name: old[name].unionByName(new[name]) for name in FACTS})


def states(new: Tables, p: Params = DEFAULTS, known: Tables | None = None) -> DataFrame:
    """What ``new`` rows add to the states of their customers, when the rows of ``known`` are in them already.

    New orders meet all their facts; new reviews and payments also meet known orders. The
    products are those of all rows. All facts of a customer meet in one aggregate.
    """
    every = _union(known, new)
    orders = new["orders"].withColumn("_new", F.lit(True))
    if known is not None:
        orders = orders.unionByName(known["orders"].withColumn("_new", F.lit(False)))
    kept = settle(features.kept_orders(with_tables(every, orders=orders), p, "_new"))
    fresh = kept.where("_new")
    # Pairs of facts and orders that are not both known: each fact meets its order once.
    meetings = [(new, kept)] + ([(known, fresh)] if known is not None else [])

    categories = features.Categories.of(every)
    sold = (
        new["order_items"]
        .select("order_id", "product_id")
        .join(categories.products, "product_id")
        .groupBy("order_id")
        .agg(*categories.collected(F.col("_numero")))
    )
    bought = fresh.join(features.item_totals(new), "order_id", "left").join(sold, "order_id", "left")
    # A person without a name is nobody whose facts could be found again.
    named = F.col(PERSON).isNotNull()
    bought = bought.withColumns({name: F.when(named, F.col(name)) for name in categories.names})
    judged = reduce(
        DataFrame.unionByName,
        [orders.where(named).join(features.review_totals(facts, p), "order_id") for facts, orders in meetings],
    )
    paid = reduce(
        DataFrame.unionByName,
        [
            facts["order_payments"]
            .select("order_id", "payment_type", "payment_installments")
            .join(orders.where(named).select("order_id", PERSON), "order_id")
            for facts, orders in meetings
        ],
    )
    by_type = paid.groupBy(PERSON, "payment_type").agg(
        F.count("*").alias("n"),
        F.sum("payment_installments").alias("versements"),
        F.count("payment_installments").alias("nb_versements"),
    )
    of_orders = [PERSON, "order_id", BOUGHT_AT, "montant_commande", "nb_lignes", *categories.names]
    of_reviews = [PERSON, "nb_avis", "nb_mauvais_avis", "somme_scores", "nb_scores"]
    facts = (
        bought.select(*of_orders)
        .unionByName(judged.select(*of_reviews), allowMissingColumns=True)
        .unionByName(by_type, allowMissingColumns=True)
    )
    # As many as there are payment types.
    entries = F.collect_list(F.when(F.col("payment_type").isNotNull(), F.struct("payment_type", "n")))
    people = facts.groupBy(PERSON).agg(
        F.count(BOUGHT_AT).alias("nb_commandes"),
        F.max(BOUGHT_AT).alias("derniere_commande"),
        *features.monetary_aggregates(),
        *features.border_aggregates(),
        *features.satisfaction_aggregates(),
        *categories.united(),
        F.map_from_entries(F.array_sort(entries)).alias("paiements"),
        F.sum("versements").alias("versements"),
        F.sum("nb_versements").alias("nb_versements"),
    )
    return categories.with_names(people, "categories").select(PERSON, *MERGED)


def start(table: StoredTable, t: Tables, p: Params = DEFAULTS, shards: int = 16) -> Change:
    """Store the states of all customers of ``t``."""
    return table.replace(states(t, p), key=[PERSON], shards=shards)


def advance(table: StoredTable, new: Tables, known: Tables, p: Params = DEFAULTS) -> Change:
    """Merge new rows into the stored states; ``known`` holds the rows merged before.

    Stops if new items belong to a known order.
    """
    late = new["order_items"].join(known["orders"].select("order_id"), "order_id", "left_semi")
    if not late.isEmpty():
        raise ValueError("items of orders that were loaded before: start again from all rows")
    return table.merge(states(new, p, known), MERGED)


def features_of(stored: DataFrame, today: Column, p: Params = DEFAULTS) -> DataFrame:
    """The feature table from states. ``today`` is the latest purchase of any order."""
    best = F.array_min(
        F.transform(F.map_entries("paiements"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("value")))
    )
    people = (
        stored.where(F.col("nb_commandes") > 0)
        .withColumns(
            {
                "nb_reviews": F.coalesce("nb_reviews", F.lit(0).cast("bigint")),
                "nb_mauvaises_reviews": F.coalesce("nb_mauvaises_reviews", F.lit(0).cast("bigint")),
                "nb_categories_distinctes": F.nullif(F.size("categories").cast("bigint"), F.lit(0).cast("bigint")),
                "mode_paiement_prefere": best["value"],
                "nb_moyen_versements": ratio(F.col("versements"), F.col("nb_versements")),
                "_valeur": features.mean_later_order(),
            }
        )
        .drop("categories", "paiements")
    )
    ranked = with_rank(people, PERSON, "_valeur", "rang_par_valeur", task_rows=p.task_rows)
    return features.feature_columns(ranked, today, p, FEATURE_COLUMNS)
