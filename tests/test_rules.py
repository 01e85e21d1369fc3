"""Audits, rules and cleaning on small tables with seeded faults."""

import pytest
from pyspark.sql import functions as F

from retinue.plans import audit, cleaning, quality
from retinue.settings import Params


@pytest.fixture
def faulty(model):
    day = "2020-01-01"
    return model(
        customers=[
            {"customer_id": "c1", "customer_unique_id": "u1", "customer_city": "sao paulo"},
            {"customer_id": "c2", "customer_unique_id": "u1", "customer_city": "sao paulo sp"},
            {"customer_id": "c2", "customer_unique_id": "u2", "customer_city": "São Paulo"},
            {"customer_id": None, "customer_unique_id": "u3", "customer_city": "rio"},
        ],
        orders=[
            {"order_id": "o1", "customer_id": "c1", "order_status": "delivered",
             "order_purchase_timestamp": day, "order_delivered_customer_date": day},
            {"order_id": "o2", "customer_id": "c2", "order_status": "delivered",
             "order_purchase_timestamp": day},
            {"order_id": "o3", "customer_id": "nobody", "order_status": "shipped",
             "order_purchase_timestamp": day},
            {"order_id": "o4", "customer_id": "nobody", "order_status": None,
             "order_purchase_timestamp": None},
        ],
        order_items=[
            {"order_id": "o1", "order_item_id": 1, "product_id": "p1", "seller_id": "s1",
             "price": 1, "freight_value": 1},
            {"order_id": "o1", "order_item_id": 1, "product_id": "p?", "seller_id": "s1",
             "price": None, "freight_value": 1},
            {"order_id": "o2", "order_item_id": 1, "product_id": "p?", "seller_id": "s1",
             "price": 1, "freight_value": 1},
        ],
        products=[{"product_id": "p1"}, {"product_id": "p2", "product_category_name": "x"}],
        sellers=[{"seller_id": "s1"}],
        order_reviews=[
            {"review_id": "r1", "order_id": "o1", "review_score": 0},
            {"review_id": "r2", "order_id": "gone", "review_score": 6},
            {"review_id": "r3", "order_id": "o1", "review_score": 5},
            {"review_id": "r4", "order_id": "o1", "review_score": 2},
        ],
    )


def lines(df):
    return {(r["controle"], r["table_name"], r["colonnes"]): r["nb_violations"] for r in df.collect()}


def test_constraints_report(faulty):
    got = lines(quality.constraints(faulty))
    assert got["cle", "customers", "customer_id"] == 2  # one repeated, one NULL
    assert got["cle", "order_items", "order_id,order_item_id"] == 1
    assert got["cle", "orders", "order_id"] == 0
    assert got["non_null", "order_items", "price"] == 1
    assert got["non_null", "orders", "order_status"] == 1
    assert got["non_null", "customers", "customer_id"] == 1
    assert got["reference", "orders", "customer_id"] == 2
    assert got["reference", "order_items", "product_id"] == 2
    assert got["reference", "order_reviews", "order_id"] == 1
    assert got["domaine", "order_reviews", "review_score"] == 2
    assert sum(k[0] == "reference" for k in got) == 6 and sum(k[0] == "cle" for k in got) == 8


def test_missing_parents_count_rows_per_key(faulty):
    got = quality.missing_parents(faulty, "order_items", "product_id").collect()
    assert [tuple(r) for r in got] == [("p?", 2)]


def test_out_of_range_rows(faulty):
    got = quality.out_of_range(faulty, "order_reviews", "review_score").collect()
    assert sorted(r["review_score"] for r in got) == [0, 6]


def test_clean_orders_changes_only_undated_deliveries_and_is_idempotent(faulty):
    once = cleaning.clean(faulty)["orders"]
    status = {r["order_id"]: r["order_status"] for r in once.collect()}
    assert status == {"o1": "delivered", "o2": "shipped", "o3": "shipped", "o4": None}
    assert cleaning.clean_orders(once).exceptAll(once).count() == 0
    assert audit.incoherent_orders(faulty).first()[0] == 1
    assert audit.incoherent_orders(cleaning.clean(faulty)).first()[0] == 0


def test_dedup_reviews_keeps_the_first_across_orders(spark):
    raw = spark.createDataFrame(
        [("r", "late", 2, 9), ("r", "early", 1, 3), ("q", "x", 5, 4)],
        "review_id string, order_id string, review_score int, file_position int",
    )
    got = {r["review_id"]: r["order_id"] for r in cleaning.dedup_reviews(raw).collect()}
    assert got == {"r": "early", "q": "x"}


def test_key_audit(faulty):
    assert tuple(audit.key_audit(faulty).first()) == (4, 2, 3)
    got = [tuple(r) for r in audit.customers_with_many_ids(faulty).collect()]
    assert got == [("u1", 2)]


def test_orders_without_items_and_orphan_reviews(faulty):
    assert {r["order_id"] for r in audit.orders_without_items(faulty).collect()} == {"o3", "o4"}
    assert [tuple(r) for r in audit.shipped_without_items(faulty).collect()] == [("o3", "shipped")]
    assert [r["review_id"] for r in audit.orphan_reviews(faulty).collect()] == ["r2"]


def test_city_search_minds_case_and_accents(faulty):
    got = [r[0] for r in audit.city_variants(faulty).collect()]
    assert got == ["sao paulo", "sao paulo sp"]
    assert [r[0] for r in audit.top_cities(faulty, 2).collect()] == ["São Paulo", "rio"]


def test_distributions(faulty):
    got = [tuple(r) for r in audit.status_distribution(faulty).collect()]
    assert got == [("delivered", 2, 50.0), ("shipped", 1, 25.0), (None, 1, 25.0)]
    assert tuple(audit.bad_review_rate(faulty).first()) == (2, 4, 50.0)
    assert audit.bad_review_rate(faulty, Params(bad_score=0)).first()[0] == 1


def test_rates_of_empty_tables_are_null(model):
    assert tuple(audit.bad_review_rate(model()).first()) == (0, 0, None)
    assert audit.score_distribution(model()).count() == 0


def test_null_profiles(faulty):
    got = {r["colonne"]: (r["total"], r["non_null"], r["nb_null"]) for r in audit.null_profile(faulty).collect()}
    assert got["order_delivered_customer_date"] == (4, 1, 3)
    assert got["product_category_name"] == (2, 1, 1)
    assert tuple(audit.order_dates_missing(faulty).first()) == ("orders", 4, 4, 4, 3)
    assert tuple(audit.category_gaps(faulty).first()) == (2, 1, 1)


def test_row_counts(faulty):
    got = {r["table_name"]: r["nb_lignes"] for r in audit.row_counts(faulty).collect()}
    assert got["customers"] == 4 and got["payments"] == 0 and len(got) == 8


def test_hot_review_id_does_not_lose_rows(spark):
    raw = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("review_id"),
        F.col("id").cast("string").alias("order_id"),
        F.lit(1).alias("review_score"),
        F.col("id").alias("file_position"),
    )
    got = cleaning.dedup_reviews(raw)
    assert got.count() == 2001 and got.where("review_id = 'hot'").first()["order_id"] == "0"


def test_facts_about_keys_carry_no_counts_of_faults(faulty):
    facts = quality._facts(faulty, "order_items")
    assert facts.columns == ["domaine", "v1", "v2", *quality._ROWS]
    # Own key and three parents of each of three lines, and one row with a missing price.
    assert facts.count() == 3 * 4 + 1
    assert facts.where("domaine < 0").count() == 1


def test_several_faults_of_a_row_all_count(model):
    t = model(order_items=[{"order_id": None, "price": None}, {"order_id": "o", "order_item_id": 1, "price": 1}])
    got = {(r.controle, r.colonnes): r.nb_violations for r in quality.constraints(t).where("table_name = 'order_items'").collect()}
    assert (got["non_null", "order_id"], got["non_null", "price"], got["non_null", "product_id"]) == (1, 1, 2)
