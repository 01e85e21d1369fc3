"""CSV ingestion and the run from files to snapshot."""

from datetime import timedelta
from decimal import Decimal

import pytest

from shop import Shop, rows_by
from retinue.plans.build import build, preview
from retinue.plans.features import customer_features
from retinue.sources import csv_files
from retinue.sources.schemas import FEATURE_COLUMNS, TABLES
from retinue.sources.stored import StoredTable
from retinue.sources.tables import create_view, heaviest_bucket_share, materialize, refresh, save_bucketed

REVIEWS = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,"nice ""shop""","line one\nline two",2018-01-02 00:00:00,2018-01-03 10:11:12\n'
    'r2,o2,1,,"",2018-01-02 00:00:00,\n'
    "r1,o3,2,copy,,2018-01-04 00:00:00,\n"
)


def write(folder, name, text):
    path = folder / f"{name}.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quotes_line_breaks_and_empty_fields(spark, tmp_path):
    path = write(tmp_path, "reviews", REVIEWS)
    rows = csv_files.read_typed(spark, path, "order_reviews").collect()
    assert len(rows) == 3
    assert rows[0]["review_comment_title"] == 'nice "shop"'
    assert rows[0]["review_comment_message"] == "line one\nline two"
    assert rows[1]["review_comment_title"] is None and rows[1]["review_comment_message"] is None
    assert rows[1]["review_answer_timestamp"] is None
    assert str(rows[0]["review_answer_timestamp"]) == "2018-01-03 10:11:12"


def test_first_row_of_a_review_id_wins(spark, tmp_path):
    got = rows_by(csv_files.import_reviews(spark, write(tmp_path, "reviews", REVIEWS)), "review_id")
    assert set(got) == {"r1", "r2"} and got["r1"]["order_id"] == "o1"


def test_first_row_over_a_long_file(spark, tmp_path):
    head = REVIEWS.splitlines()[0]
    body = "\n".join(f"r{n % 700},o{n},3,,,," for n in range(2100))
    got = rows_by(csv_files.import_reviews(spark, write(tmp_path, "long", f"{head}\n{body}\n")), "review_id")
    assert all(got[f"r{n}"]["order_id"] == f"o{n}" for n in range(700))


def test_typed_load_keeps_leading_zeros_inferred_load_does_not(spark, tmp_path):
    path = write(
        tmp_path, "sellers", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01310,a,b\n"
    )
    assert csv_files.read_typed(spark, path, "sellers").first()["seller_zip_code_prefix"] == "01310"
    assert csv_files.read_inferred(spark, path).first()["seller_zip_code_prefix"] == 1310
    assert csv_files.head(csv_files.read_inferred(spark, path)).count() == 1


def test_a_malformed_row_stops_the_load(spark, tmp_path):
    path = write(
        tmp_path,
        "payments",
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\no,one,card,1,2.00\n",
    )
    with pytest.raises(Exception, match="one|MALFORMED|Malformed"):
        csv_files.read_typed(spark, path, "order_payments").collect()


def test_amounts_are_decimals(spark, tmp_path):
    path = write(
        tmp_path,
        "payments",
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\no,1,card,1,2.10\n",
    )
    assert csv_files.read_typed(spark, path, "order_payments").first()["payment_value"] == Decimal("2.10")


@pytest.fixture
def csv_folder(model, tmp_path):
    shop = Shop()
    shop.product("p", "cat").product("q")
    shop.order("1", "a", "2020-01-01", [("p", 10, 1), ("q", 5, 0)], [("card", 2, 16)], [5])
    shop.order("2", "a", "2020-03-01", [("p", 7, 1)], [("card", 1, 8)], [1, 2])
    shop.order("3", "b", "2018-01-01", [("q", 3, 1)], [("cash", 1, 4)], status="shipped")
    shop.order("4", "c", "2020-02-01", status="canceled")
    files = {}
    for name, df in model(**shop.rows).items():
        files[name] = str(tmp_path / f"csv-{name}")
        df.coalesce(1).write.csv(files[name], header=True, escape='"')
    return files


def test_build_from_csv_to_snapshot(spark, csv_folder, tmp_path):
    result = build(spark, csv_folder, str(tmp_path / "out"))
    assert result.features.columns == FEATURE_COLUMNS
    rows = rows_by(result.features, "customer_unique_id")
    assert set(rows) == {"a", "b"}
    assert rows["a"]["valeur_totale"] == Decimal("24.00") and rows["a"]["segment_client"] == "actif"
    # The first order has no delivery date, so it is shipped after cleaning.
    assert result.tables["orders"].where("order_status = 'delivered'").count() == 0
    assert rows_by(result.counts, "table_name")["reviews"]["nb_lignes"] == 3
    assert result.violations.where("nb_violations > 0").count() > 0  # sellers are missing
    shown = preview(result.features).collect()
    assert [r["nb_clients"] for r in shown] == [2, 2]
    assert spark.table("v_customer_features").count() == 2
    # A second run replaces the first.
    assert build(spark, csv_folder, str(tmp_path / "out")).features.count() == 2


def test_snapshot_is_frozen_until_refreshed(spark, tmp_path):
    source, snapshot = str(tmp_path / "source"), str(tmp_path / "snapshot")
    spark.range(5).write.parquet(source)
    first = materialize(spark.read.parquet(source), snapshot)
    spark.range(5, 8).write.mode("append").parquet(source)
    assert first.count() == 5
    assert refresh(spark.read.parquet(source), snapshot, keep=timedelta(0)) == 8
    assert StoredTable(spark.newSession(), snapshot).read().count() == 8


def test_view_is_lazy(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(2).write.parquet(source)
    view = create_view(spark.read.parquet(source), "v_lazy")
    assert view.count() == 2 and spark.sql("SELECT max(id) FROM v_lazy").first()[0] == 1


def test_bucketed_tables_join_without_a_shuffle(spark, model, tmp_path):
    shop = Shop()
    shop.product("p", "cat")
    for n in range(300):
        shop.order(f"o{n}", f"c{n % 40}", "2020-01-01", [("p", n, 1)], [("card", 1, n)], [3])
    t = model(**shop.rows)
    stored = save_bucketed(t, str(tmp_path / "b"), 4, f"t{tmp_path.name.replace('-', '_')}", max_share=0.9)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored["order_items"].join(stored["orders"], "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = customer_features(stored).exceptAll(customer_features(t))
    assert got.count() == 0


@pytest.mark.parametrize("buckets", [2, 4, 16])
def test_a_table_with_a_hot_key_is_not_bucketed(spark, model, tmp_path, buckets):
    shop = Shop()
    shop.order("hot", "a", "2020-01-01", [("p", 1, 1)] * 900)
    for n in range(200):
        shop.order(f"o{n}", "b", "2020-01-01", [("p", 1, 1)])
    t = model(**shop.rows)
    assert heaviest_bucket_share(t["order_items"], "order_id", buckets) > 4 / 5
    stored = save_bucketed(t, str(tmp_path / "b"), buckets, f"h{tmp_path.name.replace('-', '_')}")
    assert stored["order_items"].count() == 1100
    scan = stored["order_items"]._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" not in scan
    assert set(stored) == set(TABLES)


def test_larger_tables_get_more_buckets(spark, model, tmp_path):
    shop = Shop()
    for n in range(300):
        shop.order(f"o{n}", "a", "2020-01-01", [("p", 1, 1)])
    t = model(**shop.rows)
    prefix = f"m{tmp_path.name.replace('-', '_')}"
    stored = save_bucketed(t, str(tmp_path / "b"), 2, prefix, bucket_rows=100)
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {prefix}_order_items").collect()}
    assert said["Num Buckets"] == "4" and stored["order_items"].count() == 300
