"""States that follow new rows against features of all rows, and results that are kept."""

import random

import pytest
from pyspark.sql import functions as F

from retinue.operators.staging import settle
from retinue.plans import features, states
from retinue.settings import Params
from retinue.sources.results import remembered
from retinue.sources.stored import StoredTable
from retinue.sources.tables import with_tables
from shop import Shop

NAMES = states.FACTS


def many_orders(seed, orders=90):
    """Orders of some customers, one of whom has a third, on few days."""
    rng = random.Random(seed)
    shop = Shop()
    for p in range(12):
        shop.product(f"p{p}", rng.choice([None, "toys", "garden", "music"]))
    for n in range(orders):
        items = [(f"p{rng.randint(0, 11)}", rng.randint(1, 50), rng.randint(0, 9)) for _ in range(rng.randint(0, 3))]
        paid = [(rng.choice(["card", "voucher", "slip"]), rng.randint(1, 6), 10) for _ in range(rng.randint(0, 2))]
        person = "hot" if n % 3 == 0 else f"c{rng.randint(0, 25)}"
        status = rng.choice(["delivered", "shipped", "delivered", "canceled"])
        scores = [rng.randint(1, 5) for _ in range(rng.randint(0, 2))]
        shop.order(f"o{n:03d}", person, f"2020-0{rng.randint(1, 9)}-01T10:00:00", items, paid, scores, status)
    return shop.rows


def split(rows, loads, seed):
    """Deal rows to loads: an order with its account and items, payments and reviews anywhere."""
    rng = random.Random(seed)
    load_of = {o["order_id"]: rng.randrange(loads) for o in rows["orders"]}
    account = {o["customer_id"]: load_of[o["order_id"]] for o in rows["orders"]}
    out = [{name: [] for name in rows} for _ in range(loads)]
    for name, table in rows.items():
        for row in table:
            if name in ("orders", "order_items"):
                load = load_of[row["order_id"]]
            elif name == "customers":
                load = account[row["customer_id"]]
            else:
                load = rng.randrange(loads) if name in NAMES else 0
            out[load][name].append(row)
    return out


def as_rows(df):
    return {r["customer_unique_id"]: tuple(r) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_a_start_and_three_loads_equal_all_rows(spark, model, tmp_path, seed):
    rows = many_orders(seed)
    whole = model(**rows)
    p = Params(task_rows=8)
    loads = [model(**part) for part in split(rows, 4, seed)]
    products = {"products": whole["products"]}
    table = StoredTable(spark, str(tmp_path / "states"))
    known = with_tables(loads[0], **products)
    states.start(table, known, p, shards=4)
    for load in loads[1:]:
        states.advance(table, with_tables(load, **products), known, p)
        known = with_tables(known, **{n: known[n].unionByName(load[n]) for n in NAMES})
    got = states.features_of(table.read(), features.reference_date(whole), p)
    assert got.columns == features.customer_features(whole, p).columns
    assert as_rows(got) == as_rows(features.customer_features(whole, p))


def test_files_of_unchanged_customers_stay_and_their_orders_are_not_read(spark, model, tmp_path):
    rows = many_orders(5, orders=200)
    t = model(**rows)
    table = StoredTable(spark, str(tmp_path / "states"))
    states.start(table, t, shards=8)
    before = set(table.files())
    later = Shop().product("p0", "toys").order("new", "c1", "2020-12-01", [("p0", 5, 1)], [("card", 1, 6)], [5])
    new = with_tables(model(**later.rows), products=t["products"])
    change = states.advance(table, new, t)
    assert len(change.files) == 1 and len(before - set(table.files())) == 1
    old = as_rows(table.read(0))
    now = as_rows(table.read())
    assert {k for k in now if now[k] != old.get(k)} == {"c1"}


def test_facts_of_a_customer_meet_in_one_aggregate(spark, model):
    t = model(**many_orders(8, orders=30))
    plan = states.states(t)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


def test_a_table_settled_by_load_is_read_load_by_load(spark):
    rows = spark.range(40).selectExpr("id", "cast(id % 4 AS int) AS load")
    one = settle(rows, "load").where("load = 1").select("id")
    assert sorted(r.id for r in one.collect()) == list(range(1, 40, 4))
    assert "PartitionFilters: [isnotnull(load" in one._jdf.queryExecution().executedPlan().toString()


def test_items_of_a_known_order_stop_the_load(spark, model, tmp_path):
    t = model(**many_orders(6, orders=20))
    table = StoredTable(spark, str(tmp_path / "states"))
    states.start(table, t, shards=2)
    late = model(order_items=[{"order_id": "o000", "order_item_id": 9, "product_id": "p0", "price": 1, "freight_value": 1}])
    with pytest.raises(ValueError, match="loaded before"):
        states.advance(table, late, t)
    assert len(table.versions()) == 1


def test_many_categories_are_counted_exactly(spark, model):
    shop = Shop()
    for n in range(150):
        shop.product(f"p{n}", f"cat{n}")
    shop.product("none", None).product("also none", None)
    shop.order("o1", "all", "2020-01-01", [(f"p{n}", 1, 1) for n in range(100)])
    shop.order("o2", "all", "2020-01-02", [(f"p{n}", 1, 1) for n in range(50, 150)] + [("none", 1, 1), ("also none", 1, 1)])
    shop.order("o3", "few", "2020-01-02", [("p149", 1, 1), ("p149", 1, 1), ("p64", 1, 1)])
    shop.order("o4", "unknown product", "2020-01-02", [("x", 1, 1)])
    t = model(**shop.rows)
    got = {r[0]: r[1] for r in features.diversity(t).collect()}
    assert got == {"all": 151, "few": 2}
    whole = features.customer_features(t, columns=["nb_categories_distinctes", "valeur_totale"])
    assert {r[0]: r[2] for r in whole.collect()} == {"all": 151, "few": 2, "unknown product": None}


def test_categories_need_no_second_shuffle(spark, model):
    t = model(**many_orders(7, orders=30))
    plan = features.diversity(t)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Aggregate [")]
    assert "distinct" not in plan.lower() and "Expand" not in plan and len(grouped) == 2


def test_a_result_is_computed_once_until_a_source_changes(spark, tmp_path):
    source, folder = str(tmp_path / "source"), str(tmp_path / "results")
    spark.range(10).write.parquet(source)
    runs = []

    def answer(question="sum"):
        df = spark.read.parquet(source)

        def compute():
            runs.append(question)
            return df.agg(F.sum("id").alias("s"))

        return remembered(spark, folder, question, [df], compute)

    first, again = answer(), answer()
    assert first.first().s == 45 and again.first().s == 45 and runs == ["sum"]
    assert not [f for f in again.inputFiles() if source in f]
    answer("another")
    assert runs == ["sum", "another"]
    spark.range(10, 12).write.mode("append").parquet(source)
    assert answer().first().s == 66 and runs == ["sum", "another", "sum"]
    assert first.first().s == 45
