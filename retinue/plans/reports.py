"""Questions answered from the feature table and from the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from retinue.functions.dates import month_start
from retinue.functions.display import fixed, label_of, shorten, with_thousands
from retinue.functions.numeric import mean, money, percent, ratio, round_half_even
from retinue.operators.keyed import top
from retinue.plans.features import BOUGHT_AT, PERSON, is_kept, item_totals
from retinue.plans.segments import business_rank
from retinue.settings import BEHAVIOUR_LABELS, DEFAULTS, MEASURE_LABELS, SEGMENT_LABELS, UNKNOWN_CATEGORY, Params
from retinue.sources.tables import Tables

# Feature columns each report reads; ask ``customer_features`` for no more.
KPI_COLUMNS = (
    "valeur_totale",
    "nb_commandes",
    "panier_moyen_par_commande",
    "nb_reviews",
    "nb_mauvaises_reviews",
    "est_churne",
    "segment_client",
)
PROFILE_COLUMNS = (
    "segment_client",
    "valeur_totale",
    "score_moyen_reviews",
    "jours_depuis_derniere_commande",
    "nb_commandes",
)
BEHAVIOUR_COLUMNS = (
    "delai_moyen_inter_commandes",
    "nb_reviews",
    "nb_mauvaises_reviews",
    "nb_categories_distinctes",
    "mode_paiement_prefere",
    "nb_commandes",
)
SAMPLE_COLUMNS = (
    "jours_depuis_derniere_commande",
    "valeur_totale",
    "score_moyen_reviews",
    "nb_commandes",
    "panier_moyen_par_commande",
    "segment_client",
)
AT_RISK_COLUMNS = (
    "nb_commandes",
    "jours_depuis_derniere_commande",
    "valeur_totale",
    "score_moyen_reviews",
    "pct_mauvaises_reviews",
    "segment_client",
)


def _exact(column: str):
    """A rounded double as a decimal, so that sums do not depend on their order."""
    return F.col(column).cast("decimal(18,2)")


# --- from orders ---------------------------------------------------------------------


def monthly_revenue(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    """Orders with items and their amount per month; items shrink to orders first."""
    orders = t["orders"].where(is_kept(p)).select("order_id", month_start(F.col(BOUGHT_AT)).alias("mois"))
    return (
        orders.join(item_totals(t), "order_id")
        .groupBy("mois")
        .agg(
            F.count("*").alias("nb_commandes"),
            money(F.sum("montant_commande")).alias("chiffre_affaires"),
        )
        .orderBy("mois")
    )


def month_count(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    return monthly_revenue(t, p).agg(F.count("*").alias("nb_mois"))


def revenue_trend(t: Tables, features: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """What each month would have brought at the average basket."""
    basket = features.agg(mean(_exact("panier_moyen_par_commande"))).scalar()
    return monthly_revenue(t, p).select(
        "mois", "nb_commandes", (F.col("nb_commandes") * basket).alias("tendance")
    )


def review_histogram(t: Tables) -> DataFrame:
    return (
        t["order_reviews"]
        .groupBy("review_score")
        .agg(F.count("*").alias("nb"))
        .orderBy(F.col("review_score").asc_nulls_last())
    )


def mean_review_score(t: Tables) -> DataFrame:
    """Score weighted by its number of reviews."""
    return review_histogram(t).agg(
        ratio(F.sum(F.col("review_score") * F.col("nb")), F.sum("nb")).alias("score_moyen")
    )


def category_sales(t: Tables, p: Params = DEFAULTS) -> DataFrame:
    """Sales per translated category.

    Lines shrink to one row per product, then per raw category, before any lookup.
    """
    kept = t["orders"].where(is_kept(p)).select("order_id")
    per_product = (
        t["order_items"]
        .select("order_id", "product_id", "price")
        .join(kept, "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.count("*").alias("nb"), F.sum("price").alias("montant"))
    )
    per_raw = (
        per_product.join(t["products"].select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("nb").alias("nb"), F.sum("montant").alias("montant"))
    )
    name = F.coalesce(
        "product_category_name_english", "product_category_name", F.lit(UNKNOWN_CATEGORY)
    )
    return (
        per_raw.join(t["product_category_name_translation"], "product_category_name", "left")
        .groupBy(name.alias("categorie"))
        .agg(F.sum("nb").alias("nb_ventes"), money(F.sum("montant")).alias("chiffre_affaires"))
    )


def top_categories(t: Tables, p: Params = DEFAULTS, rows: int = 10) -> DataFrame:
    return top(category_sales(t, p), rows, F.col("nb_ventes").desc(), F.col("categorie"))


# --- from the feature table ----------------------------------------------------------


def kpis(features: DataFrame) -> DataFrame:
    at_risk = F.count_if(F.col("segment_client") == "a_risque")
    return features.agg(
        money(F.sum("valeur_totale")).alias("total_ca"),
        F.sum("nb_commandes").alias("total_orders"),
        F.count("*").alias("total_clients"),
        mean(_exact("panier_moyen_par_commande")).alias("avg_basket"),
        (ratio(F.sum("nb_mauvaises_reviews"), F.sum("nb_reviews")) * 100).alias("pct_bad_rev"),
        (mean(F.col("est_churne")) * 100).alias("pct_churne"),
        F.sum("est_churne").alias("nb_churne"),
        at_risk.alias("nb_a_risque"),
        (ratio(at_risk, F.count("*")) * 100).alias("pct_a_risque"),
    )


def kpi_cards(features: DataFrame) -> DataFrame:
    """The same figures as the texts shown on cards."""
    return kpis(features).select(
        fixed(F.col("total_ca") / 1_000_000, 2, "R$ ", "M").alias("ca_total"),
        with_thousands(F.col("total_orders")).alias("commandes"),
        fixed(F.col("avg_basket"), 0, "R$ ").alias("panier_moyen"),
        with_thousands(F.col("total_clients")).alias("clients"),
        fixed(F.col("pct_a_risque"), 1, suffix="%").alias("a_risque"),
        fixed(F.col("pct_churne"), 1, suffix="%").alias("churn"),
        with_thousands(F.col("nb_churne")).alias("clients_churnes"),
    )


def segment_profile(features: DataFrame) -> DataFrame:
    """Size and means of the segments that occur, in business order."""
    return (
        features.groupBy("segment_client")
        .agg(
            F.count(PERSON).alias("nb_clients"),
            mean(F.col("valeur_totale")).alias("valeur_totale_moy"),
            mean(_exact("score_moyen_reviews")).alias("score_moy"),
            mean(F.col("jours_depuis_derniere_commande")).alias("recence_moy"),
            mean(F.col("nb_commandes")).alias("nb_commandes_moy"),
        )
        .withColumn("libelle", label_of(F.col("segment_client"), SEGMENT_LABELS))
        .orderBy(business_rank(F.col("segment_client")))
    )


def segment_total(features: DataFrame) -> DataFrame:
    return features.groupBy("segment_client").agg(F.count(PERSON).alias("n")).agg(
        F.sum("n").alias("total_clients")
    )


def behaviour_stats(features: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Behaviour of all customers in one row.

    One pass: sums per payment type, then over the few types, which also gives the
    dominant one (the smallest name wins a tie).
    """
    gap = _exact("delai_moyen_inter_commandes")
    per_type = features.groupBy("mode_paiement_prefere").agg(
        F.count("*").alias("n"),
        F.sum(gap).alias("delais"),
        F.count(gap).alias("nb_delais"),
        F.sum("nb_mauvaises_reviews").alias("mauvaises"),
        F.sum("nb_reviews").alias("reviews"),
        F.sum("nb_categories_distinctes").alias("categories"),
        F.count("nb_categories_distinctes").alias("nb_categories"),
        F.count_if(F.col("nb_commandes") > 1).alias("multi"),
    )
    mode = F.col("mode_paiement_prefere")
    bad = ratio(F.sum("mauvaises"), F.sum("reviews")) * 100
    return per_type.agg(
        ratio(F.sum("delais"), F.sum("nb_delais")).alias("delai_moyen"),
        bad.alias("pct_mauvaises"),
        F.when(bad > p.negative_review_pct, "negative").otherwise("positive").alias("signal"),
        ratio(F.sum("categories"), F.sum("nb_categories")).alias("categories_moy"),
        F.min(F.when(mode.isNotNull(), F.struct(-F.col("n"), mode.alias("mode"))))["mode"].alias(
            "mode_paiement_dominant"
        ),
        (ratio(F.sum("multi"), F.sum("n")) * 100).alias("pct_multi_commandes"),
    )


def rfm_sample(features: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Exactly ``sample_size`` customers (or all), the same ones for the same seed.

    The customers with the smallest hashes are drawn. Counting the first 16 bits of all
    hashes shows where the sample ends, so only few more rows than it holds are sorted.
    """
    draw = F.md5(F.concat(F.lit(f"{p.sample_seed}:"), F.col(PERSON)))
    drawn = features.select(PERSON, *SAMPLE_COLUMNS).withColumn("_draw", draw)
    head = F.substring("_draw", 1, 4)
    # At most 65,536 rows.
    sizes = drawn.groupBy(head.alias("_head")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    needed = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    last = needed.where(F.col("_before") < p.sample_size).agg(F.max("_head")).scalar()
    return top(drawn.where(head <= last), p.sample_size, F.col("_draw"), F.col(PERSON)).drop("_draw")


def at_risk_top(features: DataFrame, rows: int = 15) -> DataFrame:
    """Most valuable customers about to churn, rounded for display."""
    chosen = top(
        features.where(F.col("segment_client") == "a_risque"),
        rows,
        F.col("valeur_totale").desc_nulls_last(),
        F.col(PERSON),
    )
    return chosen.select(
        shorten(F.col(PERSON), 20).alias("client_id"),
        F.col("nb_commandes").alias("commandes"),
        F.col("jours_depuis_derniere_commande").alias("inactivite_jours"),
        round_half_even(F.col("valeur_totale"), 0).cast("bigint").alias("ca_total"),
        round_half_even(F.col("score_moyen_reviews"), 2).alias("score_moyen"),
        round_half_even(F.col("pct_mauvaises_reviews"), 1).alias("pct_negatif"),
    )


# --- texts on cards --------------------------------------------------------------------


def score_card(t: Tables) -> DataFrame:
    """The mean score as shown in the middle of the review chart."""
    return mean_review_score(t).select(fixed(F.col("score_moyen"), 2).alias("score_moyen"))


def segment_bars(features: DataFrame) -> DataFrame:
    """The means of each segment as shown on its bars, one row a segment and measure."""
    measures = ["valeur_totale_moy", "score_moy", "recence_moy", "nb_commandes_moy"]
    profile = segment_profile(features).select(
        "libelle", *[round_half_even(F.col(c), 1).alias(c) for c in measures]
    )
    return profile.unpivot(["libelle"], measures, "mesure", "valeur").select(
        "libelle", label_of(F.col("mesure"), MEASURE_LABELS).alias("mesure"), "valeur"
    )


def behaviour_cards(features: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The behaviour of all customers as labelled texts, each with its signal."""
    stats = behaviour_stats(features, p)
    values = {
        "delai_moyen": (fixed(F.col("delai_moyen"), 0, suffix=" jours"), F.lit("neutral")),
        "pct_mauvaises": (fixed(F.col("pct_mauvaises"), 1, suffix="%"), F.col("signal")),
        "categories_moy": (fixed(F.col("categories_moy"), 1), F.lit("neutral")),
        "mode_paiement_dominant": (F.col("mode_paiement_dominant"), F.lit("neutral")),
        "pct_multi_commandes": (fixed(F.col("pct_multi_commandes"), 1, suffix="%"), F.lit("positive")),
    }
    cards = [
        F.struct(F.lit(BEHAVIOUR_LABELS[name]).alias("libelle"), value.alias("valeur"), sign.alias("signal"))
        for name, (value, sign) in values.items()
    ]
    return stats.select(F.inline(F.array(*cards)))


def at_risk_caption(features: DataFrame) -> DataFrame:
    """How many customers are at risk, of how many, in words."""
    found = kpis(features)
    return found.select(
        F.concat(
            F.lit("⚠️ "),
            with_thousands(F.col("nb_a_risque")),
            F.lit(" clients à risque sur "),
            with_thousands(F.col("total_clients")),
            F.lit(" ("),
            fixed(F.col("pct_a_risque"), 1),
            F.lit("%)"),
        ).alias("legende")
    )
