"""One row per real customer.

Everything starts from the kept orders and works in three steps: facts shrink to one row
per order, orders to one row per customer in a single aggregate, and the few features that
need another grouping (categories, payment types, global rank) join on the customer.

Three properties of the model are relied on and checked by ``plans.quality``: ``order_id`` is
unique in orders and ``product_id`` in products, and prices and purchase times are not NULL.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.functions.dates import day_gap
from retinue.functions.numeric import decimal_ratio, money, percent, ratio, round_to
from retinue.operators.keyed import best_value
from retinue.operators.ordered import with_previous
from retinue.operators.ranking import with_rank
from retinue.operators.staging import settle
from retinue.plans.segments import churn_label, segment
from retinue.settings import DEFAULTS, UNKNOWN_CATEGORY, Params
from retinue.sources.schemas import FEATURE_COLUMNS
from retinue.sources.tables import Tables

PERSON = "customer_unique_id"
BOUGHT_AT = "order_purchase_timestamp"
#: Join hint for a side with one short row per key: each partition of it is hashed, and neither
#: side is sorted. Keys that repeat are on the other side, which is streamed.
HASHED = "shuffle_hash"
#: A table of fewer rows may be small enough to broadcast, which the hint would rule out.
MANY_ROWS = 1_000_000

RECENCY = ("nb_commandes", "jours_depuis_derniere_commande", "est_churne", "segment_client")
MONETARY = ("valeur_totale", "panier_moyen", "panier_moyen_par_commande")
SATISFACTION = ("score_moyen_reviews", "nb_reviews", "nb_mauvaises_reviews", "pct_mauvaises_reviews")
DIVERSITY = ("nb_categories_distinctes",)
TREND = ("delai_moyen_inter_commandes", "tendance_panier", "rang_par_valeur")
PAYMENTS = ("mode_paiement_prefere", "nb_moyen_versements")


# --- order grain ---------------------------------------------------------------------


def is_kept(p: Params = DEFAULTS) -> Column:
    """The business filter; an order without a status is not kept."""
    return ~F.col("order_status").isin(*p.excluded_statuses)


def reference_date(t: Tables) -> Column:
    """Latest purchase over all orders, cancelled ones included, as a scalar subquery."""
    return t["orders"].agg(F.max(BOUGHT_AT)).scalar()


def kept_orders(t: Tables, p: Params = DEFAULTS, *others: str) -> DataFrame:
    """Person, id and time of the kept orders, and ``others`` of their columns."""
    orders = t["orders"].where(is_kept(p)).select("order_id", "customer_id", BOUGHT_AT, *others)
    accounts = t["customers"].select("customer_id", PERSON)
    return orders.join(accounts, "customer_id").select(PERSON, "order_id", BOUGHT_AT, *others)


def item_totals(t: Tables, categories: Categories | None = None) -> DataFrame:
    """Amount and number of lines of every order, and its categories; combines on the map side."""
    amount = F.col("price") + F.col("freight_value")
    items, bits = t["order_items"], []
    if categories:
        many = t["products"].count() > MANY_ROWS
        numbered = categories.products.hint(HASHED) if many else categories.products
        items = items.join(numbered, "product_id", "left")
        bits = categories.collected(F.col("_numero"))
    return items.groupBy("order_id").agg(
        F.sum(amount).alias("montant_commande"), F.count(amount).alias("nb_lignes"), *bits
    )


@dataclass(frozen=True)
class Categories:
    """Numbered categories, as bits of 64-bit words: sets of them are united by OR.

    ``products`` has the number of each product's category; products without one share a
    number. There are as many words as the categories need, so a set is exact whatever
    their number.
    """

    products: DataFrame
    words: int
    numbers: DataFrame

    @classmethod
    def of(cls, t: Tables) -> Categories:
        category = F.coalesce("product_category_name", F.lit(UNKNOWN_CATEGORY)).alias("_categorie")
        named = t["products"].select("product_id", category)
        # One row per category.
        numbers = settle(
            named.select("_categorie")
            .distinct()
            .select("_categorie", (F.row_number().over(Window.orderBy("_categorie")) - 1).alias("_numero"))
        )
        return cls(named.join(numbers, "_categorie").drop("_categorie"), ceil(numbers.count() / 64), numbers)

    @property
    def names(self) -> list[str]:
        return [f"_categories_{w}" for w in range(self.words)]

    def collected(self, number: Column) -> list[Column]:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number % 64)
        return [
            F.bit_or(F.when(F.floor(number / 64) == w, bit)).alias(name) for w, name in enumerate(self.names)
        ]

    def united(self) -> list[Column]:
        return [F.bit_or(name).alias(name) for name in self.names]

    def with_names(self, df: DataFrame, out: str) -> DataFrame:
        """Add the names of the categories in each row's set, in order; NULL for none."""
        every = self.numbers.agg(F.array_sort(F.collect_list("_categorie"))).scalar()
        words = F.array(*[F.coalesce(name, F.lit(0).cast("bigint")) for name in self.names])

        def holds(_: Column, number: Column) -> Column:
            word = F.get("_words", F.floor(number / 64).cast("int"))
            return F.call_function("shiftright", word, number % 64).bitwiseAND(1) == 1

        some = reduce(Column.__or__, [F.col(name).isNotNull() for name in self.names], F.lit(False))
        listed = F.when(some, F.filter("_every", holds))
        return df.withColumns({"_every": every, "_words": words}).withColumn(out, listed).drop("_every", "_words")

    def size(self) -> Column:
        """Categories in a set; NULL for none."""
        counts = [F.bit_count(F.coalesce(name, F.lit(0).cast("bigint"))) for name in self.names]
        total = reduce(Column.__add__, counts, F.lit(0))
        return F.nullif(total.cast("bigint"), F.lit(0).cast("bigint"))


def review_totals(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    bad = F.col("review_score") <= p.bad_score
    return (
        t["order_reviews"]
        .groupBy("order_id")
        .agg(
            F.count("review_id").alias("nb_avis"),
            F.count(F.when(bad, F.col("review_id"))).alias("nb_mauvais_avis"),
            F.sum("review_score").alias("somme_scores"),
            F.count("review_score").alias("nb_scores"),
        )
    )


# --- customer aggregates, and what is read from them ---------------------------------


def recency_aggregates() -> list[Column]:
    return [F.count("*").alias("nb_commandes"), F.max(BOUGHT_AT).alias("derniere_commande")]


def monetary_aggregates() -> list[Column]:
    return [
        F.sum("montant_commande").alias("valeur_totale"),
        F.sum("nb_lignes").alias("nb_lignes"),
        F.count("montant_commande").alias("nb_commandes_avec_items"),
    ]


def satisfaction_aggregates() -> list[Column]:
    return [
        F.coalesce(F.sum("nb_avis"), F.lit(0)).alias("nb_reviews"),
        F.coalesce(F.sum("nb_mauvais_avis"), F.lit(0)).alias("nb_mauvaises_reviews"),
        F.sum("somme_scores").alias("somme_scores"),
        F.sum("nb_scores").alias("nb_scores"),
    ]


def border_aggregates() -> list[Column]:
    """First and last order with items; equal times fall back on the order id."""
    order = F.when(
        F.col("montant_commande").isNotNull(), F.struct(BOUGHT_AT, "order_id", "montant_commande")
    )
    return [F.min(order).alias("premiere"), F.max(order).alias("derniere")]


def _mean_line() -> Column:
    return ratio(F.col("valeur_totale"), F.col("nb_lignes"))


def _mean_order() -> Column:
    return ratio(F.col("valeur_totale"), F.col("nb_commandes_avec_items"))


def _mean_score() -> Column:
    return ratio(F.col("somme_scores"), F.col("nb_scores"))


def _bad_pct() -> Column:
    return round_to(percent(F.col("nb_mauvaises_reviews"), F.col("nb_reviews")), 2)


def _steps() -> Column:
    """Number of moves from one order to the next; NULL where there is none."""
    return F.nullif(F.col("nb_commandes_avec_items") - 1, F.lit(0))


# Averages over successive orders need neither a window nor sorted orders: the gaps add up
# to (last time - first time), the changes in amount to (last amount - first amount).


def _mean_gap() -> Column:
    return ratio(day_gap(F.col("derniere")[BOUGHT_AT], F.col("premiere")[BOUGHT_AT]), _steps())


def _mean_change() -> Column:
    change = F.col("derniere")["montant_commande"] - F.col("premiere")["montant_commande"]
    return decimal_ratio(change, _steps())


def mean_later_order() -> Column:
    """Average amount of all orders but the first, the value customers are ranked by."""
    later = F.col("valeur_totale") - F.col("premiere")["montant_commande"]
    return decimal_ratio(later, _steps())


# --- the single feature groups, unrounded --------------------------------------------


def recency_frequency(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    return (
        kept_orders(t, p)
        .groupBy(PERSON)
        .agg(*recency_aggregates())
        .withColumn(
            "jours_depuis_derniere_commande", day_gap(reference_date(t), F.col("derniere_commande"))
        )
    )


def monetary(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    return (
        kept_orders(t, p)
        .join(item_totals(t), "order_id")
        .groupBy(PERSON)
        .agg(*monetary_aggregates())
        .select(
            PERSON,
            money(F.col("valeur_totale")).alias("valeur_totale"),
            _mean_line().alias("panier_moyen"),
            _mean_order().alias("panier_moyen_par_commande"),
        )
    )


def satisfaction(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    return (
        kept_orders(t, p)
        .join(review_totals(t, p), "order_id", "left")
        .groupBy(PERSON)
        .agg(*satisfaction_aggregates())
        .select(
            PERSON,
            _mean_score().alias("score_moyen_reviews"),
            "nb_reviews",
            "nb_mauvaises_reviews",
            _bad_pct().alias("pct_mauvaises_reviews"),
        )
    )


def diversity(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    """Distinct raw categories; products without one count together as one category.

    Item lines shrink to the categories of an order on the map side; no distinct rows are
    shuffled a second time.
    """
    categories = Categories.of(t)
    per_order = (
        t["order_items"]
        .select("order_id", "product_id")
        .join(categories.products, "product_id")
        .groupBy("order_id")
        .agg(*categories.collected(F.col("_numero")))
    )
    return (
        kept_orders(t, p)
        .join(per_order, "order_id")
        .groupBy(PERSON)
        .agg(*categories.united())
        .select(PERSON, categories.size().alias("nb_categories_distinctes"))
    )


def payments(t: Tables, p: Params = DEFAULTS, kept: DataFrame | None = None) -> DataFrame:
    """Preferred payment type, mean instalments and amount paid.

    Counting by (customer, type) first keeps the choice of the type a small aggregate.
    """
    kept = kept_orders(t, p) if kept is None else kept
    by_type = (
        t["order_payments"]
        .select("order_id", "payment_type", "payment_installments", "payment_value")
        .join(kept.select("order_id", PERSON).hint(HASHED), "order_id")
        .groupBy(PERSON, "payment_type")
        .agg(
            F.count("*").alias("n"),
            F.sum("payment_installments").alias("versements"),
            F.count("payment_installments").alias("nb_versements"),
            F.sum("payment_value").alias("valeur"),
        )
    )
    return (
        by_type.groupBy(PERSON)
        .agg(
            best_value("payment_type", "n").alias("mode_paiement_prefere"),
            ratio(F.sum("versements"), F.sum("nb_versements")).alias("nb_moyen_versements"),
            money(F.sum("valeur")).alias("valeur_totale_paiements"),
        )
    )


def order_sequence(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    """Orders with items of each customer, with the amount of and days since the one before."""
    amounts = kept_orders(t, p).join(
        item_totals(t).select("order_id", money(F.col("montant_commande")).alias("montant_commande")),
        "order_id",
    )
    sequence = with_previous(
        amounts,
        PERSON,
        [BOUGHT_AT, "order_id"],
        {"montant_commande": "montant_commande_precedente", BOUGHT_AT: "_avant"},
        task_rows=p.task_rows,
    )
    return sequence.select(
        PERSON,
        "order_id",
        BOUGHT_AT,
        "montant_commande",
        "montant_commande_precedente",
        day_gap(F.col(BOUGHT_AT), F.col("_avant")).alias("delai_inter_commandes_jours"),
    )


def trend(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    """Mean gap, mean change and value rank of customers with two or more orders with items."""
    base = settle(
        kept_orders(t, p)
        .join(item_totals(t), "order_id")
        .groupBy(PERSON)
        .agg(*monetary_aggregates(), *border_aggregates())
        .where(F.col("nb_commandes_avec_items") > 1)
        .select(
            PERSON,
            _mean_gap().alias("delai_moyen_inter_commandes"),
            _mean_change().alias("tendance_panier"),
            mean_later_order().alias("_valeur"),
        )
    )
    return with_rank(base, PERSON, "_valeur", "rang_par_valeur", task_rows=p.task_rows).drop("_valeur")


# --- the feature table ---------------------------------------------------------------


def customer_features(
    t: Tables, p: Params = DEFAULTS, columns: Iterable[str] | None = None
) -> DataFrame:
    """The 18-column feature table, or some of its columns.

    Only the tables behind the asked columns are read. Kept orders that several branches
    read, and the customer aggregates that are ranked, are staged, whatever their size.
    """
    wanted = [c for c in FEATURE_COLUMNS if columns is None or c in set(columns) | {PERSON}]
    need = {
        name: any(c in wanted for c in group)
        for name, group in {
            "recency": RECENCY,
            "monetary": MONETARY,
            "satisfaction": SATISFACTION,
            "diversity": DIVERSITY,
            "trend": TREND,
            "payments": PAYMENTS,
        }.items()
    }
    ranked = "rang_par_valeur" in wanted

    kept = kept_orders(t, p)
    if need["payments"]:
        kept = settle(kept)

    facts, aggregates = kept, recency_aggregates()
    categories = Categories.of(t) if need["diversity"] else None
    if need["monetary"] or need["trend"] or categories:
        facts = facts.join(item_totals(t, categories).hint(HASHED), "order_id", "left")
        aggregates += monetary_aggregates()
    if categories:
        aggregates += categories.united()
    if need["satisfaction"]:
        facts = facts.join(review_totals(t, p).hint(HASHED), "order_id", "left")
        aggregates += satisfaction_aggregates()
    if need["trend"]:
        aggregates += border_aggregates()

    people = facts.groupBy(PERSON).agg(*aggregates)
    if categories:
        people = people.withColumn("nb_categories_distinctes", categories.size()).drop(*categories.names)
    if need["payments"]:
        # Both sides are grouped by the customer, so they meet where they are.
        people = people.join(payments(t, p, kept), PERSON, "left")
    if not ranked:
        return feature_columns(people, reference_date(t), p, wanted)

    # Ranked last, as rows are moved and written for it: by now they are short.
    rank, value = "rang_par_valeur", "_valeur"
    unranked = [c for c in wanted if c != rank]
    people = settle(feature_columns(people, reference_date(t), p, unranked, mean_later_order().alias(value)))
    return with_rank(people, PERSON, value, rank, task_rows=p.task_rows).select(*wanted)


def feature_columns(
    people: DataFrame, today: Column, p: Params, wanted: Iterable[str], *others: Column
) -> DataFrame:
    """The final, rounded columns from the sums of each customer, its rank and what it is joined with."""
    people = people.withColumn("jours_depuis_derniere_commande", day_gap(today, F.col("derniere_commande")))
    values = {
        PERSON: F.col(PERSON),
        "nb_commandes": F.col("nb_commandes"),
        "jours_depuis_derniere_commande": F.col("jours_depuis_derniere_commande"),
        "valeur_totale": money(F.col("valeur_totale")),
        "panier_moyen": round_to(_mean_line(), 2),
        "panier_moyen_par_commande": round_to(_mean_order(), 2),
        "score_moyen_reviews": round_to(_mean_score(), 2),
        "nb_reviews": F.col("nb_reviews"),
        "nb_mauvaises_reviews": F.col("nb_mauvaises_reviews"),
        "pct_mauvaises_reviews": _bad_pct(),
        "nb_categories_distinctes": F.col("nb_categories_distinctes"),
        "delai_moyen_inter_commandes": round_to(_mean_gap(), 1),
        "tendance_panier": round_to(_mean_change(), 2),
        "rang_par_valeur": F.col("rang_par_valeur"),
        "mode_paiement_prefere": F.col("mode_paiement_prefere"),
        "nb_moyen_versements": round_to(F.col("nb_moyen_versements"), 1),
        "est_churne": churn_label(F.col("jours_depuis_derniere_commande"), p),
        "segment_client": segment(
            F.col("nb_commandes"), F.col("jours_depuis_derniere_commande"), p
        ),
    }
    return people.select(*[values[c].alias(c) for c in wanted], *others)


def features_preview(t: Tables, p: Params = DEFAULTS, rows: int = 20) -> DataFrame:
    """Feature columns without label and segment, of the customers with most orders."""
    columns = [c for c in FEATURE_COLUMNS if c not in ("est_churne", "segment_client")]
    return (
        customer_features(t, p, columns)
        .orderBy(F.col("nb_commandes").desc(), F.col(PERSON))
        .limit(rows)
    )
