"""A run stops on broken rules before it publishes anything."""

import os

import pytest

from retinue.plans.build import broken, build
from retinue.session import run_folder
from retinue.sources.schemas import TABLES
from retinue.sources.stored import StoredTable


def write(spark, tables, folder):
    files = {}
    for name in TABLES:
        files[name] = f"{folder}/csv/{name}"
        tables[name].coalesce(1).write.csv(files[name], header=True, quote='"', escape='"')
    return files


def small(shop):
    shop.product("p", "toys").order("o1", "ann", "2020-01-01T10:00:00", [("p", 10, 1), ("p", 5, 1)], [("card", 1, 16)], [4])
    shop.order("o2", "ann", "2020-02-01T10:00:00", [("p", 7, 1)], [("card", 1, 8)], [5])
    shop.rows["sellers"].append({"seller_id": "s"})
    shop.rows["product_category_name_translation"].append(
        {"product_category_name": "toys", "product_category_name_english": "TOYS"}
    )
    return shop.rows


def test_a_good_run_counts_dropped_reviews_and_cleans_up(spark, shop, model, tmp_path):
    rows = small(shop)
    rows["order_reviews"].append(dict(rows["order_reviews"][0]))
    rows["order_items"].append(dict(rows["order_items"][0]))  # a repeated order line is no fault
    result = build(spark, write(spark, model(**rows), tmp_path), str(tmp_path / "out"))
    counts = {r.table_name: r.nb_lignes for r in result.counts.collect()}
    assert counts["reviews_fichier"] == 3 and counts["reviews_doublons"] == 1
    assert result.features.count() == 1
    staged = run_folder(spark).removeprefix("file:")
    assert not [f for f in (os.listdir(staged) if os.path.isdir(staged) else []) if f.startswith("run-")]


@pytest.mark.parametrize("fault", ["order", "account", "price"])
def test_broken_rules_stop_the_run(spark, shop, model, tmp_path, fault):
    rows = small(shop)
    if fault == "order":
        rows["orders"].append(dict(rows["orders"][0]))
    if fault == "account":
        rows["customers"].append(dict(rows["customers"][0]))
    if fault == "price":
        rows["order_items"][0]["price"] = None
    with pytest.raises(ValueError, match="rules are broken"):
        build(spark, write(spark, model(**rows), tmp_path), str(tmp_path / "out"))
    assert not (tmp_path / "out" / "mv_customer_features").exists()
    assert broken(StoredTable(spark, str(tmp_path / "out" / "violations")).read()).count() > 0


def test_a_second_import_keeps_the_reviews_stored_first(spark, shop, model, tmp_path):
    rows = small(shop)
    build(spark, write(spark, model(**rows), tmp_path / "a"), str(tmp_path / "out"))
    rows["order_reviews"][0] = {**rows["order_reviews"][0], "review_score": 1}
    rows["order_reviews"].append({"review_id": "later", "order_id": "o2", "review_score": 2})
    result = build(spark, write(spark, model(**rows), tmp_path / "b"), str(tmp_path / "out"))
    scores = {r.review_id: r.review_score for r in result.tables["order_reviews"].collect()}
    assert scores == {"r-o1-1": 4, "r-o2-1": 5, "later": 2}


def test_a_failed_run_leaves_the_former_snapshot(spark, shop, model, tmp_path):
    rows = small(shop)
    build(spark, write(spark, model(**rows), tmp_path / "a"), str(tmp_path / "out"))
    rows["order_items"][0]["price"] = None
    with pytest.raises(ValueError, match="rules are broken"):
        build(spark, write(spark, model(**rows), tmp_path / "b"), str(tmp_path / "out"))
    other = spark.newSession()
    assert StoredTable(other, str(tmp_path / "out" / "mv_customer_features")).read().count() == 1
