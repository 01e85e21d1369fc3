"""Reports on a small shop whose answers are known by hand."""

from datetime import datetime
from decimal import Decimal

import pytest

from shop import rows_by
from retinue.plans import reports, segments
from retinue.plans.features import customer_features, features_preview
from retinue.settings import Params


@pytest.fixture
def t(model, shop):
    shop.product("p", "livros").product("q", "sem_traducao").product("n", None).product("m", "livros2")
    shop.order("1", "a" * 30, "2020-01-31T23:00:00", [("p", 100, 10), ("q", 50, 0)], [("card", 2, 1)], [1, 4])
    shop.order("2", "a" * 30, "2020-06-01", [("p", 20, 0)], [("card", 1, 1)], [5])
    shop.order("3", "b", "2019-11-01", [("n", 30, 5.5)], [("cash", 1, 1)], [2])
    shop.order("4", "c", "2019-10-15", [("m", 10, 0.5)], [("cash", 1, 1)])
    shop.order("5", "d", "2017-01-01", [("p", 1, 1)], [("zeta", 1, 1)])
    shop.order("6", "e", "2020-02-01", [("p", 500, 0)], status="canceled")
    shop.rows["product_category_name_translation"] = [
        {"product_category_name": "livros", "product_category_name_english": "books"},
        {"product_category_name": "livros2", "product_category_name_english": "books"},
    ]
    return model(**shop.rows)


def test_monthly_revenue(t):
    got = [tuple(r) for r in reports.monthly_revenue(t).collect()]
    assert got == [
        (datetime(2017, 1, 1), 1, Decimal("2.00")),
        (datetime(2019, 10, 1), 1, Decimal("10.50")),
        (datetime(2019, 11, 1), 1, Decimal("35.50")),
        (datetime(2020, 1, 1), 1, Decimal("160.00")),
        (datetime(2020, 6, 1), 1, Decimal("20.00")),
    ]
    assert reports.month_count(t).first()[0] == 5


def test_revenue_trend_uses_the_mean_rounded_basket(t):
    basket = (90.0 + 35.5 + 10.5 + 2.0) / 4
    got = reports.revenue_trend(t, customer_features(t)).collect()
    assert [r["tendance"] for r in got] == [basket] * 5


def test_translated_categories_merge_and_fall_back(t):
    got = [tuple(r) for r in reports.top_categories(t).collect()]
    assert got == [
        ("books", 4, Decimal("131.00")),
        ("sem_traducao", 1, Decimal("50.00")),
        ("unknown", 1, Decimal("30.00")),
    ]
    assert reports.top_categories(t, rows=1).count() == 1


def test_reviews(t):
    assert [tuple(r) for r in reports.review_histogram(t).collect()] == [(1, 1), (2, 1), (4, 1), (5, 1)]
    assert reports.mean_review_score(t).first()[0] == 3.0


def test_kpis(t):
    row = reports.kpis(customer_features(t, columns=reports.KPI_COLUMNS)).first()
    assert row["total_ca"] == Decimal("228.00")
    assert (row["total_orders"], row["total_clients"]) == (5, 4)
    assert row["avg_basket"] == 34.5
    assert row["pct_bad_rev"] == 50.0
    assert (row["pct_churne"], row["nb_churne"]) == (25.0, 1)
    assert (row["nb_a_risque"], row["pct_a_risque"]) == (2, 50.0)
    cards = reports.kpi_cards(customer_features(t)).first()
    assert cards["ca_total"] == "R$ 0.00M" and cards["a_risque"] == "50.0%" and cards["commandes"] == "5"


def test_segment_profile_in_business_order(t):
    rows = reports.segment_profile(customer_features(t)).collect()
    assert [r["segment_client"] for r in rows] == ["actif", "a_risque", "churne"]
    assert [r["libelle"] for r in rows] == ["Actif", "À risque", "Churné"]
    assert rows[1]["valeur_totale_moy"] == 23.0 and rows[1]["score_moy"] == 2.0
    assert rows[2]["score_moy"] is None
    assert reports.segment_total(customer_features(t)).first()[0] == 4


def test_behaviour_stats(t):
    row = reports.behaviour_stats(customer_features(t, columns=reports.BEHAVIOUR_COLUMNS)).first()
    assert row["delai_moyen"] == 122.0
    assert row["pct_mauvaises"] == 50.0 and row["signal"] == "negative"
    assert row["categories_moy"] == 1.25
    assert row["mode_paiement_dominant"] == "cash"
    assert row["pct_multi_commandes"] == 25.0


def test_calibration_never_rises_with_the_threshold(t):
    got = segments.churn_calibration(customer_features(t), Params(calibration_days=(0, 200, 230, 2000)))
    rows = got.orderBy("seuil_jours").collect()
    assert [r["nb_churnes"] for r in rows] == [3, 3, 1, 0]
    assert [r["taux_churn"] for r in rows] == [75.0, 75.0, 25.0, 0.0]


def test_at_risk_top(t):
    rows = [tuple(r) for r in reports.at_risk_top(customer_features(t)).collect()]
    # 35.5 -> 36 and 10.5 -> 10: halves go to the even neighbour.
    assert rows == [("b...", 1, 213, 36, 2.0, 100.0), ("c...", 1, 230, 10, None, None)]
    assert reports.at_risk_top(customer_features(t), rows=1).count() == 1


def test_sample_size_and_seed(t):
    df = customer_features(t)
    two = Params(sample_size=2)
    first, again = (rows_by(reports.rfm_sample(df, two), "customer_unique_id") for _ in range(2))
    assert first == again and len(first) == 2
    assert reports.rfm_sample(df).count() == 4
    picks = {tuple(sorted(rows_by(reports.rfm_sample(df, Params(sample_size=2, sample_seed=s)),
                                  "customer_unique_id"))) for s in range(6)}
    assert len(picks) > 1


def test_preview(t):
    df = features_preview(t, rows=2)
    assert len(df.columns) == 16
    assert [r["customer_unique_id"] for r in df.collect()] == ["a" * 30, "b"]
