"""Complete jobs: audits, cleaning, feature groups, the feature table, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from retinue.catalog.model_sql import SKEWED
from retinue.catalog.registry import Context, query
from retinue.plans import audit, build, cleaning, features, quality, reports, segments, states
from retinue.session import new_folder
from retinue.settings import Params
from retinue.sources.schemas import REPORT_NAMES, TABLES
from retinue.sources.stored import StoredTable
from retinue.sources.tables import materialize, refresh, save_bucketed, with_tables

# SQL views of the model tables.
VIEWS = {
    "customers": "m_customers",
    "sellers": "m_sellers",
    "products": "m_products",
    "product_category_name_translation": "m_translation",
    "orders": "m_orders",
    "order_items": "m_items",
    "order_payments": "m_payments",
    "order_reviews": "m_reviews",
}

# --- audits --------------------------------------------------------------------------

ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{label}' AS table_name, count(*) AS nb_lignes FROM {VIEWS[name]}"
    for name, label in REPORT_NAMES.items()
)


@query("job_row_counts", ROW_COUNTS)
def _(c: Context):
    return audit.row_counts(c.t)


@query("job_row_counts_raw", ROW_COUNTS.replace("m_reviews", "m_reviews_raw"))
def _(c: Context):
    return audit.row_counts(with_tables(c.t, order_reviews=c.raw_reviews))


@query(
    "job_key_audit",
    """SELECT count(*) AS total_lignes, count(DISTINCT customer_id) AS nb_customer_ids_distincts,
              count(DISTINCT customer_unique_id) AS nb_clients_reels FROM m_customers""",
)
def _(c: Context):
    return audit.key_audit(c.t)


MANY_IDS = """SELECT customer_unique_id, count(DISTINCT customer_id) AS nb_customer_ids
    FROM m_customers GROUP BY customer_unique_id HAVING count(DISTINCT customer_id) > 1"""


@query("job_key_audit_persons", MANY_IDS)
def _(c: Context):
    return audit.customers_with_many_ids(c.t)


@query(
    "job_null_profile",
    " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{column}' AS colonne, count(*) AS total,
                   count({column}) AS non_null, count(*) - count({column}) AS nb_null
            FROM {VIEWS[table]}"""
        for table, column in [
            *[("orders", column) for column in audit.ORDER_DATES.values()],
            ("products", "product_category_name"),
        ]
    ),
)
def _(c: Context):
    return audit.null_profile(c.t)


@query(
    "job_null_profile_final",
    """SELECT 'orders' AS table_name, count(*) AS total,
              count(*) FILTER (order_approved_at IS NULL) AS approved_null,
              count(*) FILTER (order_delivered_carrier_date IS NULL) AS carrier_null,
              count(*) FILTER (order_delivered_customer_date IS NULL) AS delivered_null
       FROM m_orders""",
)
def _(c: Context):
    return audit.order_dates_missing(c.t)


STATUS_DIST = """SELECT order_status, count(*) AS nb_commandes,
    round(count(*) * 100.0 / (SELECT count(*) FROM m_orders), 2) AS pct
    FROM m_orders GROUP BY order_status ORDER BY nb_commandes DESC, order_status"""
SCORE_DIST = """SELECT review_score, count(*) AS nb_reviews,
    round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
    FROM m_reviews GROUP BY review_score ORDER BY review_score"""


@query("job_status_dist", STATUS_DIST)
def _(c: Context):
    return audit.status_distribution(c.t)


@query("job_score_dist", SCORE_DIST)
def _(c: Context):
    return audit.score_distribution(c.t)


@query(
    "job_bad_review_rate",
    """SELECT count(*) FILTER (review_score <= 2) AS mauvaises_reviews, count(*) AS total_reviews,
              round(count(*) FILTER (review_score <= 2) * 100.0 / nullif(count(*), 0), 2)
                  AS pct_mauvaises
       FROM m_reviews""",
)
def _(c: Context):
    return audit.bad_review_rate(c.t)


CLEAN_ORDERS = """SELECT order_id,
    CASE WHEN order_status = 'delivered' AND order_delivered_customer_date IS NULL
         THEN 'shipped' ELSE order_status END AS order_status,
    order_delivered_customer_date FROM m_orders"""


@query(
    "job_incoherent_orders",
    f"""SELECT 'avant' AS etape, count(*) AS nb_incoherences FROM m_orders
        WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL
        UNION ALL
        SELECT 'apres', count(*) FROM ({CLEAN_ORDERS})
        WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL""",
)
def _(c: Context):
    before, after = audit.incoherent_orders(c.t), audit.incoherent_orders(cleaning.clean(c.t))
    return before.select(F.lit("avant").alias("etape"), "nb_incoherences").unionByName(
        after.select(F.lit("apres").alias("etape"), "nb_incoherences")
    )


WITHOUT_ITEMS = """SELECT order_id, order_status FROM m_orders o
    WHERE NOT EXISTS (SELECT 1 FROM m_items i WHERE i.order_id = o.order_id)"""


@query("job_orders_without_items", f"SELECT count(*) AS commandes_sans_items FROM ({WITHOUT_ITEMS})")
def _(c: Context):
    return audit.orders_without_items(c.t).agg(F.count("*").alias("commandes_sans_items"))


@query("job_shipped_without_items", f"{WITHOUT_ITEMS} AND order_status = 'shipped'")
def _(c: Context):
    return audit.shipped_without_items(c.t)


@query(
    "job_orphan_reviews",
    """SELECT count(*) AS reviews_orphelines FROM m_reviews r LEFT JOIN m_orders o
       ON o.order_id = r.order_id WHERE o.order_id IS NULL""",
)
def _(c: Context):
    return audit.orphan_reviews(c.t).agg(F.count("*").alias("reviews_orphelines"))


CITY_TOP = """SELECT customer_city, count(*) AS nb_clients FROM m_customers
    GROUP BY customer_city ORDER BY nb_clients DESC, customer_city LIMIT 20"""


@query("job_city_top", CITY_TOP)
def _(c: Context):
    return audit.top_cities(c.t)


@query(
    "job_city_variants",
    """SELECT DISTINCT customer_city FROM m_customers WHERE customer_city LIKE '%nation_1%'
       OR customer_city LIKE '%nation_2%' ORDER BY customer_city""",
)
def _(c: Context):
    return audit.city_variants(c.t, Params(city_patterns=("nation_1", "nation_2")))


# --- cleaning and rules --------------------------------------------------------------

DEDUP_REVIEWS = "SELECT review_id, order_id, review_score, review_creation_date FROM m_reviews"


@query("job_dedup_reviews", DEDUP_REVIEWS)
def _(c: Context):
    return cleaning.dedup_reviews(c.raw_reviews).select(
        "review_id", "order_id", "review_score", "review_creation_date"
    )


@query("job_clean_orders", CLEAN_ORDERS)
def _(c: Context):
    return cleaning.clean_orders(c.t["orders"]).select(
        "order_id", "order_status", "order_delivered_customer_date"
    )


def _line(check: str, table: str, columns: str, count: str) -> str:
    return f"""SELECT '{check}' AS controle, '{table}' AS table_name, '{columns}' AS colonnes,
        cast(({count}) AS bigint) AS nb_violations"""


def key_sql(composite: bool) -> str:
    lines = []
    for name, spec in TABLES.items():
        if (len(spec.key) > 1) == composite:
            missing = " OR ".join(f"{column} IS NULL" for column in spec.key)
            keys = ", ".join(spec.key)
            lines.append(
                _line(
                    "cle",
                    name,
                    ",".join(spec.key),
                    f"""SELECT count(*) FROM (SELECT {keys}, count(*) AS n FROM {VIEWS[name]}
                        GROUP BY {keys} HAVING count(*) > 1 OR {missing})""",
                )
            )
    return " UNION ALL ".join(lines)


def presence_sql() -> str:
    return " UNION ALL ".join(
        _line("non_null", name, column, f"SELECT count(*) FROM {VIEWS[name]} WHERE {column} IS NULL")
        for name, spec in TABLES.items()
        for column in spec.required
    )


def reference_sql() -> str:
    return " UNION ALL ".join(
        _line(
            "reference",
            name,
            column,
            f"""SELECT count(*) FROM {VIEWS[name]} child LEFT JOIN {VIEWS[parent]} parent
                ON parent.{key} = child.{column}
                WHERE child.{column} IS NOT NULL AND parent.{key} IS NULL""",
        )
        for name, spec in TABLES.items()
        for column, (parent, key) in spec.references.items()
    )


RANGE_SQL = _line(
    "domaine",
    "order_reviews",
    "review_score",
    "SELECT count(*) FROM m_reviews WHERE review_score < 1 OR review_score > 5",
)


@query(
    "job_constraints",
    " UNION ALL ".join(
        [key_sql(False), key_sql(True), presence_sql(), reference_sql(), RANGE_SQL]
    ),
)
def _(c: Context):
    return quality.constraints(c.t)


# --- feature groups ------------------------------------------------------------------


@query("job_recency_frequency", "SELECT * FROM m_recency")
def _(c: Context):
    return features.recency_frequency(c.t)


@query(
    "job_monetary",
    """SELECT customer_unique_id, cast(valeur_totale AS decimal(18,2)) AS valeur_totale,
              panier_moyen, panier_moyen_par_commande FROM m_monetary""",
)
def _(c: Context):
    return features.monetary(c.t)


@query("job_satisfaction", "SELECT * FROM m_satisfaction")
def _(c: Context):
    return features.satisfaction(c.t)


@query("job_diversity", "SELECT * FROM m_diversity")
def _(c: Context):
    return features.diversity(c.t)


SEQUENCE = """SELECT customer_unique_id, order_id, bought_at AS order_purchase_timestamp,
    cast(amount AS decimal(18,2)) AS montant_commande,
    cast(amount_before AS decimal(18,2)) AS montant_commande_precedente,
    gap AS delai_inter_commandes_jours FROM m_sequence"""


@query("job_order_sequence", SEQUENCE)
def _(c: Context):
    return features.order_sequence(c.t)


@query("job_trend", "SELECT * FROM m_trend")
def _(c: Context):
    return features.trend(c.t)


@query(
    "job_payments",
    """SELECT customer_unique_id, mode_paiement_prefere, nb_moyen_versements,
              cast(valeur_totale_paiements AS decimal(18,2)) AS valeur_totale_paiements
       FROM m_paid""",
)
def _(c: Context):
    return features.payments(c.t)


@query(
    "job_features_preview",
    """SELECT * EXCLUDE (est_churne, segment_client) FROM m_features
       ORDER BY nb_commandes DESC, customer_unique_id LIMIT 20""",
)
def _(c: Context):
    return features.features_preview(c.t)


@query("job_customer_features", "SELECT * FROM m_features")
def _(c: Context):
    return features.customer_features(c.t)


@query("job_customer_features_staged", "SELECT * FROM m_features")
def _(c: Context):
    """The plan for large inputs."""
    return features.customer_features(c.t, c.at_scale)


@query("job_customer_features_skewed", "SELECT * FROM m_features", SKEWED)
def _(c: Context):
    return features.customer_features(c.skewed, c.at_scale)


@query("job_customer_features_incremental", "SELECT * FROM m_features")
def _(c: Context):
    """All but the last orders, then three loads of the rest; payments and reviews come in any order."""
    batches = [c.batch(n) for n in range(4)]
    table = StoredTable(c.spark, new_folder(c.spark, "states"))
    states.start(table, batches[0])
    for n in range(1, 4):
        states.advance(table, batches[n], c.batches_before(n))
    return states.features_of(table.read(), features.reference_date(c.t))


@query("job_customer_features_bucketed", "SELECT * FROM m_features")
def _(c: Context):
    folder = new_folder(c.spark, "bucketed")
    prefix = "b_" + folder.rsplit("-", 1)[-1][:12]
    return features.customer_features(save_bucketed(c.t, folder, 8, prefix))


@query("job_churn_label", "SELECT customer_unique_id, est_churne FROM m_features")
def _(c: Context):
    return c.features("est_churne")


@query("job_segment", "SELECT customer_unique_id, segment_client FROM m_features")
def _(c: Context):
    return c.features("segment_client")


@query(
    "job_churn_calibration",
    """SELECT cast(seuil AS integer) AS seuil_jours, count(*) AS nb_clients,
              count(*) FILTER (jours_depuis_derniere_commande > seuil) AS nb_churnes,
              round(count(*) FILTER (jours_depuis_derniere_commande > seuil) * 100.0
                    / nullif(count(*), 0), 2) AS taux_churn
       FROM m_recency, (VALUES (90), (180), (270), (365)) AS seuils(seuil) GROUP BY seuil""",
)
def _(c: Context):
    return segments.churn_calibration(c.features("jours_depuis_derniere_commande"))


@query("job_materialize", "SELECT * FROM m_features")
def _(c: Context):
    return materialize(c.features(), new_folder(c.spark, "mv_customer_features"))


@query("job_refresh", "SELECT * FROM m_features")
def _(c: Context):
    """Refreshed from the table and then from its own former snapshot, of which it is the next version."""
    path, view = new_folder(c.spark, "mv_customer_features"), "retinue_mv_customer_features"
    refresh(c.features(), path, sort_by="segment_client", view=view)
    refresh(c.spark.table(view), path, sort_by="segment_client", view=view)
    return c.spark.table(view)


@query(
    "job_pipeline_check",
    """SELECT customer_unique_id, nb_commandes, jours_depuis_derniere_commande, segment_client,
              est_churne, (SELECT count(*) FROM m_features) AS nb_clients
       FROM m_features ORDER BY customer_unique_id LIMIT 10""",
)
def _(c: Context):
    return build.preview(c.features(*features.RECENCY))


def even_sql(column: str, digits: int) -> str:
    """Half-to-even rounding spelled out, on the value scaled by a power of ten."""
    scaled = f"(cast({column} AS double) * {10**digits}.0)"
    return f"""(CASE WHEN abs({scaled} - trunc({scaled})) = 0.5 THEN 2 * round({scaled} / 2)
        ELSE round({scaled}) END / {10**digits}.0)"""


# --- reports -------------------------------------------------------------------------

REVENUE = "SELECT * FROM m_revenue ORDER BY mois"


@query("job_monthly_revenue", REVENUE)
def _(c: Context):
    return reports.monthly_revenue(c.t)


@query("job_month_count", "SELECT count(*) AS nb_mois FROM m_revenue")
def _(c: Context):
    return reports.month_count(c.t)


MEAN_BASKET = """cast(sum(cast(panier_moyen_par_commande AS decimal(18,2))) AS double)
    / count(panier_moyen_par_commande)"""


@query(
    "job_revenue_trend",
    f"""SELECT mois, nb_commandes,
               nb_commandes * (SELECT {MEAN_BASKET} FROM m_features) AS tendance
        FROM m_revenue ORDER BY mois""",
)
def _(c: Context):
    return reports.revenue_trend(c.t, c.features("panier_moyen_par_commande"))


@query("job_review_hist", "SELECT review_score, count(*) AS nb FROM m_reviews GROUP BY ALL")
def _(c: Context):
    return reports.review_histogram(c.t)


@query("job_score_card", "SELECT format('{:.2f}', avg(review_score)) AS score_moyen FROM m_reviews")
def _(c: Context):
    return reports.score_card(c.t)


@query("job_mean_review_score", "SELECT avg(review_score) AS score_moyen FROM m_reviews")
def _(c: Context):
    return reports.mean_review_score(c.t)


CATEGORIES = "SELECT * FROM m_category_sales ORDER BY nb_ventes DESC, categorie LIMIT 10"


@query("job_top_categories", CATEGORIES)
def _(c: Context):
    return reports.top_categories(c.t)


KPIS = f"""SELECT cast(sum(valeur_totale) AS decimal(18,2)) AS total_ca,
    cast(sum(nb_commandes) AS bigint) AS total_orders, count(*) AS total_clients,
    {MEAN_BASKET} AS avg_basket,
    cast(sum(nb_mauvaises_reviews) AS double) / sum(nb_reviews) * 100 AS pct_bad_rev,
    avg(est_churne) * 100 AS pct_churne, cast(sum(est_churne) AS bigint) AS nb_churne,
    count(*) FILTER (segment_client = 'a_risque') AS nb_a_risque,
    cast(count(*) FILTER (segment_client = 'a_risque') AS double) / count(*) * 100
        AS pct_a_risque
    FROM m_features"""


@query("job_kpis", KPIS)
def _(c: Context):
    return reports.kpis(c.features(*reports.KPI_COLUMNS))


PROFILE = """SELECT segment_client, count(customer_unique_id) AS nb_clients,
    cast(sum(valeur_totale) AS double) / count(valeur_totale) AS valeur_totale_moy,
    cast(sum(cast(score_moyen_reviews AS decimal(18,2))) AS double)
        / nullif(count(score_moyen_reviews), 0) AS score_moy,
    avg(jours_depuis_derniere_commande) AS recence_moy, avg(nb_commandes) AS nb_commandes_moy,
    CASE segment_client WHEN 'nouveau' THEN 'Nouveau' WHEN 'actif' THEN 'Actif'
         WHEN 'a_risque' THEN 'À risque' ELSE 'Churné' END AS libelle
    FROM m_features GROUP BY segment_client"""


@query("job_segment_profile", PROFILE)
def _(c: Context):
    return reports.segment_profile(c.features(*reports.PROFILE_COLUMNS))


@query(
    "job_segment_bars",
    f"""SELECT libelle, mesure, valeur FROM (
            SELECT libelle, {even_sql("valeur_totale_moy", 1)} AS "Valeur totale moy. (R$)",
                   {even_sql("score_moy", 1)} AS "Score review moyen",
                   {even_sql("recence_moy", 1)} AS "Récence moy. (jours)",
                   {even_sql("nb_commandes_moy", 1)} AS "Nb commandes moyen" FROM ({PROFILE}))
        UNPIVOT INCLUDE NULLS (valeur FOR mesure IN ("Valeur totale moy. (R$)", "Score review moyen",
                "Récence moy. (jours)", "Nb commandes moyen"))""",
)
def _(c: Context):
    return reports.segment_bars(c.features(*reports.PROFILE_COLUMNS))


@query("job_segment_total", "SELECT count(*) AS total_clients FROM m_features")
def _(c: Context):
    return reports.segment_total(c.features("segment_client")).select(
        F.col("total_clients").cast("bigint").alias("total_clients")
    )


BEHAVIOUR = """SELECT *, CASE WHEN pct_mauvaises > 10 THEN 'negative' ELSE 'positive' END AS signal
    FROM (SELECT cast(sum(cast(delai_moyen_inter_commandes AS decimal(18,2))) AS double)
                     / nullif(count(delai_moyen_inter_commandes), 0) AS delai_moyen,
                 cast(sum(nb_mauvaises_reviews) AS double) / nullif(sum(nb_reviews), 0) * 100
                     AS pct_mauvaises,
                 avg(nb_categories_distinctes) AS categories_moy,
                 mode() WITHIN GROUP (ORDER BY mode_paiement_prefere) AS mode_paiement_dominant,
                 cast(count(*) FILTER (nb_commandes > 1) AS double) / count(*) * 100
                     AS pct_multi_commandes
          FROM m_features)"""


@query("job_behaviour_stats", BEHAVIOUR)
def _(c: Context):
    return reports.behaviour_stats(c.features(*reports.BEHAVIOUR_COLUMNS))


@query(
    "job_behaviour_cards",
    f"""SELECT unnest([
            {{'libelle': 'Délai inter-commandes moyen', 'valeur': concat(format('{{:.0f}}', delai_moyen), ' jours'),
              'signal': 'neutral'}},
            {{'libelle': '% mauvaises reviews (≤2)', 'valeur': concat(format('{{:.1f}}', pct_mauvaises), '%'),
              'signal': signal}},
            {{'libelle': 'Catégories / client (moy.)', 'valeur': format('{{:.1f}}', categories_moy),
              'signal': 'neutral'}},
            {{'libelle': 'Mode paiement dominant', 'valeur': mode_paiement_dominant, 'signal': 'neutral'}},
            {{'libelle': 'Clients multi-commandes', 'valeur': concat(format('{{:.1f}}', pct_multi_commandes), '%'),
              'signal': 'positive'}}], recursive := true) FROM ({BEHAVIOUR})""",
)
def _(c: Context):
    return reports.behaviour_cards(c.features(*reports.BEHAVIOUR_COLUMNS))


@query(
    "job_at_risk_caption",
    f"""SELECT concat('⚠️ ', format('{{:,}}', nb_a_risque), ' clients à risque sur ', format('{{:,}}', total_clients),
               ' (', format('{{:.1f}}', pct_a_risque), '%)') AS legende FROM ({KPIS})""",
)
def _(c: Context):
    return reports.at_risk_caption(c.features(*reports.KPI_COLUMNS))


SAMPLE = """SELECT customer_unique_id, jours_depuis_derniere_commande, valeur_totale,
    score_moyen_reviews, nb_commandes, panier_moyen_par_commande, segment_client
    FROM m_features ORDER BY md5(concat('42:', customer_unique_id)), customer_unique_id
    LIMIT 5000"""


@query("job_rfm_sample", SAMPLE)
def _(c: Context):
    return reports.rfm_sample(c.features(*reports.SAMPLE_COLUMNS))


AT_RISK = f"""SELECT concat(substr(customer_unique_id, 1, 20), '...') AS client_id,
    nb_commandes AS commandes, jours_depuis_derniere_commande AS inactivite_jours,
    cast({even_sql("valeur_totale", 0)} AS bigint) AS ca_total,
    {even_sql("score_moyen_reviews", 2)} AS score_moyen,
    {even_sql("pct_mauvaises_reviews", 1)} AS pct_negatif
    FROM m_features WHERE segment_client = 'a_risque'
    ORDER BY valeur_totale DESC NULLS LAST, customer_unique_id LIMIT 15"""


@query("job_at_risk_top", AT_RISK)
def _(c: Context):
    return reports.at_risk_top(c.features(*reports.AT_RISK_COLUMNS))
