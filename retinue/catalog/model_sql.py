"""The model and its feature table as SQL, written independently of the Spark plans."""

from __future__ import annotations

import re

MODEL: dict[str, str] = {
    "m_places": """
        SELECT n_nationkey, lpad(cast(n_nationkey AS varchar), 5, '0') AS zip,
               lower(n_name) AS city, r_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "m_customers": """
        SELECT cast(o_orderkey AS varchar) AS customer_id,
               concat(o_custkey, '-', o_orderkey % 4) AS customer_unique_id,
               zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN m_places ON c_nationkey = n_nationkey""",
    "m_sellers": """
        SELECT cast(s_suppkey AS varchar) AS seller_id, zip AS seller_zip_code_prefix,
               city AS seller_city, state AS seller_state
        FROM supplier JOIN m_places ON s_nationkey = n_nationkey""",
    "m_products": """
        SELECT cast(p_partkey AS varchar) AS product_id,
               nullif(p_brand, 'Brand#13') AS product_category_name,
               cast(NULL AS integer) AS product_name_lenght,
               cast(NULL AS integer) AS product_description_lenght,
               p_size AS product_photos_qty
        FROM part""",
    "m_translation": """
        SELECT DISTINCT p_brand AS product_category_name,
               concat('EN_', p_brand) AS product_category_name_english
        FROM part WHERE p_brand NOT IN ('Brand#13', 'Brand#7')""",
    "m_orders": """
        SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_orderkey AS varchar) AS customer_id,
               CASE WHEN o_orderkey % 50 = 0 THEN 'canceled'
                    WHEN o_orderkey % 50 = 1 THEN 'unavailable'
                    WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'O' THEN 'shipped'
                    WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + INTERVAL 1 DAY END
                   AS order_approved_at,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 3 DAY END
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 37 <> 0
                    THEN o_orderdate + INTERVAL 9 DAY END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
        FROM orders""",
    "m_items": """
        SELECT cast(l_orderkey AS varchar) AS order_id, l_linenumber AS order_item_id,
               cast(l_partkey AS varchar) AS product_id, cast(l_suppkey AS varchar) AS seller_id,
               l_shipdate AS shipping_limit_date,
               cast(l_extendedprice AS decimal(10,2)) AS price,
               cast(l_quantity AS decimal(10,2)) AS freight_value
        FROM lineitem""",
    "m_payments": """
        SELECT cast(o_orderkey AS varchar) AS order_id, 1 AS payment_sequential,
               substr(o_orderpriority, 3) AS payment_type,
               cast(1 + o_orderkey % 6 AS integer) AS payment_installments,
               cast(o_totalprice AS decimal(10,2)) AS payment_value
        FROM orders
        UNION ALL
        SELECT cast(o_orderkey AS varchar), 2, 'VOUCHER', 1, cast(10 AS decimal(10,2))
        FROM orders WHERE o_orderkey % 5 = 0""",
    "m_reviews_raw": """
        SELECT cast(CASE WHEN event_id % 100 = 99 THEN event_id - 1 ELSE event_id END AS varchar)
                   AS review_id,
               cast(event_id * 2 AS varchar) AS order_id,
               cast(1 + floor(value) % 5 AS integer) AS review_score,
               ts AS review_creation_date, event_id AS file_position
        FROM events""",
    "m_reviews": """
        SELECT review_id, order_id, review_score, review_creation_date
        FROM m_reviews_raw
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY file_position) = 1""",
    "m_kept": """
        SELECT c.customer_unique_id, o.order_id, o.order_purchase_timestamp AS bought_at
        FROM m_orders o JOIN m_customers c USING (customer_id)
        WHERE o.order_status NOT IN ('canceled', 'unavailable')""",
    "m_recency": """
        SELECT customer_unique_id, count(DISTINCT order_id) AS nb_commandes,
               max(bought_at) AS derniere_commande,
               date_diff('day', max(bought_at),
                         (SELECT max(order_purchase_timestamp) FROM m_orders))
                   AS jours_depuis_derniere_commande
        FROM m_kept GROUP BY customer_unique_id""",
    "m_monetary": """
        SELECT customer_unique_id, sum(price + freight_value) AS valeur_totale,
               avg(price + freight_value) AS panier_moyen,
               sum(price + freight_value) / count(DISTINCT order_id) AS panier_moyen_par_commande
        FROM m_kept JOIN m_items USING (order_id) GROUP BY customer_unique_id""",
    "m_satisfaction": """
        SELECT customer_unique_id, avg(review_score) AS score_moyen_reviews,
               count(review_id) AS nb_reviews,
               count(review_id) FILTER (review_score <= 2) AS nb_mauvaises_reviews,
               round(count(review_id) FILTER (review_score <= 2) * 100.0
                     / nullif(count(review_id), 0), 2) AS pct_mauvaises_reviews
        FROM m_kept LEFT JOIN m_reviews USING (order_id) GROUP BY customer_unique_id""",
    "m_diversity": """
        SELECT customer_unique_id,
               count(DISTINCT coalesce(product_category_name, 'unknown'))
                   AS nb_categories_distinctes
        FROM m_kept JOIN m_items USING (order_id) JOIN m_products USING (product_id)
        GROUP BY customer_unique_id""",
    "m_amounts": """
        SELECT customer_unique_id, order_id, bought_at, sum(price + freight_value) AS amount
        FROM m_kept JOIN m_items USING (order_id)
        GROUP BY customer_unique_id, order_id, bought_at""",
    "m_sequence": """
        SELECT customer_unique_id, order_id, bought_at, amount,
               lag(amount) OVER steps AS amount_before,
               date_diff('day', lag(bought_at) OVER steps, bought_at) AS gap
        FROM m_amounts
        WINDOW steps AS (PARTITION BY customer_unique_id ORDER BY bought_at, order_id)""",
    "m_later": """
        SELECT customer_unique_id, avg(gap) AS delai_moyen_inter_commandes,
               avg(amount - amount_before) AS tendance_panier, avg(amount) AS valeur
        FROM m_sequence WHERE amount_before IS NOT NULL GROUP BY customer_unique_id""",
    "m_trend": """
        SELECT customer_unique_id, delai_moyen_inter_commandes, tendance_panier,
               rank() OVER (ORDER BY valeur DESC) AS rang_par_valeur
        FROM m_later""",
    "m_paid": """
        SELECT customer_unique_id,
               mode() WITHIN GROUP (ORDER BY payment_type) AS mode_paiement_prefere,
               avg(payment_installments) AS nb_moyen_versements,
               sum(payment_value) AS valeur_totale_paiements
        FROM m_kept JOIN m_payments USING (order_id) GROUP BY customer_unique_id""",
    "m_features": """
        SELECT customer_unique_id, nb_commandes, jours_depuis_derniere_commande,
               cast(valeur_totale AS decimal(18,2)) AS valeur_totale,
               round(panier_moyen, 2) AS panier_moyen,
               round(panier_moyen_par_commande, 2) AS panier_moyen_par_commande,
               round(score_moyen_reviews, 2) AS score_moyen_reviews,
               nb_reviews, nb_mauvaises_reviews, pct_mauvaises_reviews, nb_categories_distinctes,
               round(delai_moyen_inter_commandes, 1) AS delai_moyen_inter_commandes,
               round(tendance_panier, 2) AS tendance_panier, rang_par_valeur,
               mode_paiement_prefere, round(nb_moyen_versements, 1) AS nb_moyen_versements,
               CASE WHEN jours_depuis_derniere_commande > 365 THEN 1 ELSE 0 END AS est_churne,
               CASE WHEN jours_depuis_derniere_commande > 365 THEN 'churne'
                    WHEN jours_depuis_derniere_commande > 180 THEN 'a_risque'
                    WHEN nb_commandes > 1 THEN 'actif' ELSE 'nouveau' END AS segment_client
        FROM m_recency
        LEFT JOIN m_monetary USING (customer_unique_id)
        LEFT JOIN m_satisfaction USING (customer_unique_id)
        LEFT JOIN m_diversity USING (customer_unique_id)
        LEFT JOIN m_trend USING (customer_unique_id)
        LEFT JOIN m_paid USING (customer_unique_id)""",
    "m_revenue": """
        SELECT date_trunc('month', order_purchase_timestamp) AS mois,
               count(DISTINCT order_id) AS nb_commandes,
               cast(sum(price + freight_value) AS decimal(18,2)) AS chiffre_affaires
        FROM m_orders JOIN m_items USING (order_id)
        WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY ALL""",
    "m_category_sales": """
        SELECT coalesce(product_category_name_english, p.product_category_name, 'unknown')
                   AS categorie,
               count(*) AS nb_ventes, cast(sum(price) AS decimal(18,2)) AS chiffre_affaires
        FROM m_items JOIN m_products p USING (product_id)
        LEFT JOIN m_translation t ON t.product_category_name = p.product_category_name
        JOIN m_orders USING (order_id)
        WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY ALL""",
}

_NAME = re.compile(r"\bm_[a-z_]+\b")


# One customer owns a third of all accounts, and so about a third of all orders.
SKEWED = {
    "m_customers": MODEL["m_customers"].replace(
        "concat(o_custkey, '-', o_orderkey % 4)",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE concat(o_custkey, '-', o_orderkey % 4) END",
    )
}


def _needed(sql: str, model: dict[str, str], found: set[str]) -> set[str]:
    for name in _NAME.findall(sql):
        if name in model and name not in found:
            found.add(name)
            _needed(model[name], model, found)
    return found


def oracle(select: str, changed: dict[str, str] | None = None) -> str:
    """``select`` preceded by the model views it reads, directly or not."""
    model = {**MODEL, **(changed or {})}
    names = _needed(select, model, set())
    views = ",\n".join(f"{name} AS ({body})" for name, body in model.items() if name in names)
    return f"WITH {views}\n{select}" if views else select
