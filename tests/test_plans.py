"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from retinue.plans import audit, cleaning, features, reports
from retinue.settings import Params
from retinue.sources.tables import with_tables
from retinue.sources.testdata import load_model, raw_reviews

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return load_model(spark, SMALL)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_flagship_has_no_window_over_rows(t):
    """The rank is taken range by range, and the borders of ranges are staged before."""
    plan = optimized(features.customer_features(t))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert not windows


def test_a_rule_report_reads_each_table_once_and_joins_none(t):
    from retinue.plans.quality import constraints

    lines = optimized(constraints(t)).splitlines()
    assert sum("Relation [l_orderkey" in line for line in lines) == 1
    joins = [n for n, line in enumerate(lines) if "Join " in line]
    union = next(n for n, line in enumerate(lines) if "Union" in line)
    # Above the facts of all tables only the totals of the few domains are looked up.
    assert sum(n < union for n in joins) == 1


def test_flagship_at_scale_sends_no_rows_to_a_single_task(t):
    """Left over are the global MAX and the one-row-per-range borders."""
    plan = plan_of(features.customer_features(t, Params(task_rows=50)))
    initial = plan.split("Initial Plan")[-1]
    for chunk in initial.split("Exchange SinglePartition")[1:]:
        below = chunk.split("\n")[1]
        assert "partial_max" in below or "_range" in below, below


def test_items_combine_before_their_only_shuffle(t, no_broadcast):
    """Line items are reduced on the map side and meet the orders as one row per order."""
    plan = plan_of(features.customer_features(t, columns=["valeur_totale"]))
    above_scan = plan[: plan.index("l_extendedprice")].splitlines()
    assert "Project" in above_scan[-1] and "partial_sum" in above_scan[-2]
    assert "Exchange hashpartitioning(order_id" in above_scan[-3]


def test_ranking_is_the_last_step_of_the_flagship(t, no_broadcast):
    """The customers meet their payments before they are ranked, and are not shuffled afterwards."""
    plan = plan_of(features.customer_features(t))
    assert "rang_par_valeur" in plan and "Exchange hashpartitioning(customer_unique_id" not in plan
    assert "premiere#" not in plan and "derniere#" not in plan


def test_facts_of_orders_are_hashed_and_not_sorted(t, no_broadcast):
    """Only orders and accounts meet in a sort-merge join."""
    columns = ["valeur_totale", "score_moyen_reviews"]
    plan = plan_of(features.customer_features(t, columns=columns)).split("Subquery")[0]
    assert plan.count("ShuffledHashJoin [order_id") == 2 and plan.count("SortMergeJoin") == 1
    assert "ShuffledHashJoin [order_id" in plan_of(features.payments(t))


@pytest.mark.parametrize("limit, hinted", [(0, True), (10**6, False)])
def test_only_many_products_are_hashed(t, monkeypatch, limit, hinted):
    monkeypatch.setattr(features, "MANY_ROWS", limit)
    plan = features.item_totals(t, features.Categories.of(t))._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=shuffle_hash" in plan) is hinted


def test_one_shuffle_per_table_on_the_order_key(t, no_broadcast):
    """The aggregated items are already placed by order id when they are joined."""
    plan = plan_of(features.monetary(t))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", plan)) == 2


def test_scans_read_needed_columns_only(t):
    plan = plan_of(features.customer_features(t, columns=["valeur_totale"]))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lines = [s for s in schemas if "l_orderkey" in s]
    assert lines and all(
        s == "l_orderkey:bigint,l_quantity:double,l_extendedprice:double" for s in lines
    )


def test_status_filter_reaches_the_scan_of_stored_tables(spark, t, tmp_path):
    path = str(tmp_path / "orders")
    t["orders"].write.parquet(path)
    stored = with_tables(t, orders=spark.read.parquet(path))
    plan = plan_of(features.kept_orders(stored))
    assert re.search(r"PushedFilters: \[[^\]]*Not\(In\(order_status", plan)


def test_duplicate_reviews_shrink_before_the_shuffle(spark):
    plan = plan_of(cleaning.dedup_reviews(raw_reviews(spark, SMALL)).select("review_id", "order_id"))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(review_id")
    assert "Window" not in plan


def test_places_are_read_only_when_asked_for(t):
    assert "nationkey" not in plan_of(features.kept_orders(t))
    assert "c_nationkey" in plan_of(audit.top_cities(t))


def test_top_k_does_not_sort_everything(t):
    assert "TakeOrderedAndProject" in plan_of(audit.top_cities(t))
    assert "TakeOrderedAndProject" in plan_of(reports.top_categories(t))


def test_shared_reference_date_is_a_scalar_subquery(t):
    plan = plan_of(features.recency_frequency(t))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_hot_join_key_is_split_by_adaptive_execution(spark, t, no_broadcast):
    """A third of all orders name one account: its partition is read in several tasks."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    hot = F.col("order_id").cast("bigint") % 3 == 0
    account = F.when(hot, F.lit("1")).otherwise(F.col("customer_id"))
    orders = t["orders"].withColumn("customer_id", account).repartition(8)
    skewed = with_tables(t, orders=orders)
    expected = features.recency_frequency(skewed).agg(F.sum("nb_commandes")).first()[0]
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        df = features.kept_orders(skewed)
        rows = df.collect()
        assert "skew=true" in plan_of(df)
        assert len(rows) == expected
    finally:
        for name in conf:
            spark.conf.unset(name)
