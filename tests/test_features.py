"""Rules of the feature table on hand-written orders, and a brute-force comparison."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shop import rows_by
from retinue.plans import features
from retinue.settings import Params
from retinue.sources.schemas import FEATURE_COLUMNS, FEATURE_SCHEMA

PERSON = "customer_unique_id"
AT_SCALE = Params(task_rows=3)


def table(model, shop, p=Params()):
    return rows_by(features.customer_features(model(**shop.rows), p), PERSON)


def test_schema_contract(model, shop):
    df = features.customer_features(model(**shop.order("o", "a", "2020-01-01").rows))
    assert df.columns == FEATURE_COLUMNS and len(df.columns) == 18
    assert dict(df.dtypes) == {f.name: f.dataType.simpleString() for f in FEATURE_SCHEMA.fields}


def test_recency_counts_midnights_up_to_the_latest_order_of_all(model, shop):
    shop.order("1", "a", "2020-01-01T23:59:00").order("2", "b", "2020-01-02T00:01:00", status="canceled")
    got = table(model, shop)
    assert got["a"]["jours_depuis_derniere_commande"] == 1
    assert "b" not in got


def test_customers_with_only_dropped_orders_are_absent(model, shop):
    shop.order("1", "a", "2020-01-01", status="unavailable").order("2", "a", "2020-01-02", status="canceled")
    shop.order("3", "b", "2020-01-03")
    assert set(table(model, shop)) == {"b"}


def test_orders_without_items_count_but_do_not_divide(model, shop):
    shop.product("p", "c")
    shop.order("1", "a", "2020-01-01", items=[("p", 10, 2), ("p", 20, 0)]).order("2", "a", "2020-01-05")
    row = table(model, shop)["a"]
    assert row["nb_commandes"] == 2
    assert row["valeur_totale"] == Decimal("32.00")
    assert row["panier_moyen"] == 16.0
    assert row["panier_moyen_par_commande"] == 32.0
    assert row["tendance_panier"] is None and row["rang_par_valeur"] is None


def test_nothing_bought_nothing_reviewed_nothing_paid(model, shop):
    row = table(model, shop.order("1", "a", "2020-01-01"))["a"]
    for column in ("valeur_totale", "panier_moyen", "score_moyen_reviews", "pct_mauvaises_reviews",
                   "nb_categories_distinctes", "mode_paiement_prefere", "nb_moyen_versements"):
        assert row[column] is None
    assert row["nb_reviews"] == 0 and row["nb_mauvaises_reviews"] == 0


def test_every_review_of_an_order_counts(model, shop):
    row = table(model, shop.order("1", "a", "2020-01-01", scores=[1, 2, 5]))["a"]
    assert (row["nb_reviews"], row["nb_mauvaises_reviews"]) == (3, 2)
    assert row["pct_mauvaises_reviews"] == 66.67 and row["score_moyen_reviews"] == 2.67


def test_missing_category_is_one_category(model, shop):
    shop.product("p1", None).product("p2", "x").product("p3", None)
    shop.order("1", "a", "2020-01-01", items=[("p1", 1, 0), ("p2", 1, 0), ("p3", 1, 0)])
    shop.order("2", "b", "2020-01-01", items=[("not a product", 1, 0)])
    got = table(model, shop)
    assert got["a"]["nb_categories_distinctes"] == 2
    assert got["b"]["nb_categories_distinctes"] is None


def test_trend_skips_the_first_order(model, shop):
    shop.product("p", "c")
    for n, (day, price) in enumerate([("2020-01-01", 10), ("2020-01-04", 30), ("2020-01-10", 25)]):
        shop.order(f"o{n}", "a", day, items=[("p", price, 0)])
    row = table(model, shop)["a"]
    assert row["delai_moyen_inter_commandes"] == 4.5
    assert row["tendance_panier"] == 7.5
    assert row["rang_par_valeur"] == 1


def test_same_time_falls_back_on_the_order_id(model, shop):
    shop.product("p", "c")
    shop.order("b", "a", "2020-01-01", items=[("p", 5, 0)]).order("a", "a", "2020-01-01", items=[("p", 9, 0)])
    row = table(model, shop)["a"]
    assert row["tendance_panier"] == -4.0 and row["delai_moyen_inter_commandes"] == 0.0


@pytest.mark.parametrize("p", [Params(), AT_SCALE])
def test_rank_has_gaps_after_ties(model, shop, p):
    shop.product("p", "c")
    for person, later in (("a", 30), ("b", 30), ("c", 10), ("d", 50)):
        shop.order(f"{person}1", person, "2020-01-01", items=[("p", 99, 0)])
        shop.order(f"{person}2", person, "2020-02-01", items=[("p", later, 0)])
    got = table(model, shop, p)
    assert {k: r["rang_par_valeur"] for k, r in got.items()} == {"d": 1, "a": 2, "b": 2, "c": 4}


def test_payment_mode_tie_takes_the_smallest(model, shop):
    shop.order("1", "a", "2020-01-01", payments=[("b", 1, 1), ("a", 2, 1), ("a", 3, 1), ("b", 4, 1)])
    row = table(model, shop)["a"]
    assert row["mode_paiement_prefere"] == "a" and row["nb_moyen_versements"] == 2.5


@pytest.mark.parametrize(
    "days, orders, segment, churned",
    [
        (180, 1, "nouveau", 0),
        (180, 2, "actif", 0),
        (181, 1, "a_risque", 0),
        (365, 2, "a_risque", 0),
        (366, 1, "churne", 1),
    ],
)
def test_segments_at_their_borders(model, shop, days, orders, segment, churned):
    last = datetime(2020, 6, 1)
    shop.order("ref", "z", last)
    for n in range(orders):
        shop.order(f"o{n}", "a", last - timedelta(days=days + n))
    row = table(model, shop)["a"]
    assert (row["segment_client"], row["est_churne"]) == (segment, churned)


def test_thresholds_are_parameters(model, shop):
    shop.order("ref", "z", "2020-06-01").order("1", "a", "2020-05-01")
    p = Params(active_days=10, churn_days=20)
    assert table(model, shop, p)["a"]["segment_client"] == "churne"


def test_asked_columns_only(model, shop):
    t = model(**shop.order("1", "a", "2020-01-01").rows)
    df = features.customer_features(t, columns=["nb_reviews", "segment_client"])
    assert df.columns == [PERSON, "nb_reviews", "segment_client"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "price" not in plan and "payment_type" not in plan


def random_shop(shop, seed, orders=160):
    rng = random.Random(seed)
    for n in range(12):
        shop.product(f"p{n}", None if n % 5 == 0 else f"cat{n % 4}")
    start = datetime(2019, 1, 1)
    for n in range(orders):
        person = "hot" if rng.random() < 0.35 else f"c{rng.randint(0, 50)}"
        shop.order(
            f"o{n:03d}",
            person,
            start + timedelta(days=rng.randint(0, 700), minutes=rng.randint(0, 3) * 479),
            items=[
                (f"p{rng.randint(0, 11)}", rng.randint(100, 99999) / 100, rng.randint(0, 3000) / 100)
                for _ in range(rng.randint(0, 4))
            ],
            payments=[
                (rng.choice(["card", "cash", "voucher"]), rng.randint(1, 8), rng.randint(1, 9))
                for _ in range(rng.randint(0, 3))
            ],
            scores=[rng.randint(1, 5) for _ in range(rng.choice([0, 1, 1, 2]))],
            status=rng.choice(["delivered", "shipped", "delivered", "canceled", "unavailable"]),
        )
    return shop


def brute_force(rows):
    """The feature rules in plain Python, order by order."""

    def rounded(x, digits):
        if x is None:
            return None
        scaled = x * 10**digits
        whole = int(abs(scaled) + 0.5)
        return (whole if scaled >= 0 else -whole) / 10**digits

    def average(values):
        return float(sum(values)) / len(values) if values else None

    people = {r["customer_id"]: r[PERSON] for r in rows["customers"]}
    category = {r["product_id"]: r["product_category_name"] or "unknown" for r in rows["products"]}
    groups = {k: defaultdict(list) for k in ("order_items", "order_payments", "order_reviews")}
    for name, by_order in groups.items():
        for r in rows[name]:
            by_order[r["order_id"]].append(r)
    reference = max(r["order_purchase_timestamp"] for r in rows["orders"])
    kept = defaultdict(list)
    for r in rows["orders"]:
        if r["order_status"] not in ("canceled", "unavailable"):
            kept[people[r["customer_id"]]].append(r)

    def cents(item):
        return Decimal(str(item["price"])) + Decimal(str(item["freight_value"]))

    out, later_mean = {}, {}
    for person, orders in kept.items():
        orders = sorted(orders, key=lambda r: (r["order_purchase_timestamp"], r["order_id"]))
        lines = [i for o in orders for i in groups["order_items"][o["order_id"]]]
        bought = [o for o in orders if groups["order_items"][o["order_id"]]]
        amounts = [sum(map(cents, groups["order_items"][o["order_id"]])) for o in bought]
        scores = [r["review_score"] for o in orders for r in groups["order_reviews"][o["order_id"]]]
        paid = [p for o in orders for p in groups["order_payments"][o["order_id"]]]
        days = (reference.date() - max(o["order_purchase_timestamp"] for o in orders).date()).days
        gaps = [
            (b["order_purchase_timestamp"].date() - a["order_purchase_timestamp"].date()).days
            for a, b in zip(bought, bought[1:])
        ]
        changes = [b - a for a, b in zip(amounts, amounts[1:])]
        bad = sum(s <= 2 for s in scores)
        modes = Counter(p["payment_type"] for p in paid)
        if changes:
            later_mean[person] = sum(amounts[1:]) / len(changes)
        out[person] = {
            PERSON: person,
            "nb_commandes": len(orders),
            "jours_depuis_derniere_commande": days,
            "valeur_totale": sum(amounts) if lines else None,
            "panier_moyen": rounded(average([cents(i) for i in lines]), 2),
            "panier_moyen_par_commande": rounded(average(amounts), 2),
            "score_moyen_reviews": rounded(average(scores), 2),
            "nb_reviews": len(scores),
            "nb_mauvaises_reviews": bad,
            "pct_mauvaises_reviews": rounded(bad * 100 / len(scores), 2) if scores else None,
            "nb_categories_distinctes": len({category[i["product_id"]] for i in lines}) or None,
            "delai_moyen_inter_commandes": rounded(average(gaps), 1),
            "tendance_panier": rounded(average(changes), 2),
            "mode_paiement_prefere": min(modes, key=lambda m: (-modes[m], m)) if modes else None,
            "nb_moyen_versements": rounded(average([p["payment_installments"] for p in paid]), 1),
            "est_churne": int(days > 365),
            "segment_client": "churne" if days > 365 else "a_risque" if days > 180
            else "actif" if len(orders) > 1 else "nouveau",
        }
    for person, row in out.items():
        mine = later_mean.get(person)
        row["rang_par_valeur"] = None if mine is None else 1 + sum(v > mine for v in later_mean.values())
    return out


@pytest.mark.parametrize("p", [Params(), Params(task_rows=40), AT_SCALE])
@pytest.mark.parametrize("seed", [1, 2])
def test_features_equal_brute_force(model, shop, seed, p):
    random_shop(shop, seed)
    got = {k: r.asDict() for k, r in table(model, shop, p).items()}
    assert got == brute_force(shop.rows)


@pytest.mark.parametrize("p", [Params(), AT_SCALE])
def test_sequence_and_trend_agree(model, shop, p):
    """The trend without a window equals the averages over the windowed sequence."""
    t = model(**random_shop(shop, 5).rows)
    steps = features.order_sequence(t, p).where(F.col("montant_commande_precedente").isNotNull())
    expected = rows_by(
        steps.groupBy(PERSON).agg(
            F.avg("delai_inter_commandes_jours").alias("gap"),
            F.sum(F.col("montant_commande") - F.col("montant_commande_precedente")).alias("change"),
            F.count("*").alias("n"),
        ),
        PERSON,
    )
    got = rows_by(features.trend(t, p), PERSON)
    assert set(got) == set(expected)
    for person, row in got.items():
        assert row["delai_moyen_inter_commandes"] == expected[person]["gap"]
        assert row["tendance_panier"] == pytest.approx(float(expected[person]["change"]) / expected[person]["n"])


def test_totals_are_kept(model, shop):
    t = model(**random_shop(shop, 7).rows)
    df = features.customer_features(t).cache()
    kept = features.kept_orders(t)
    row = df.agg(F.sum("nb_commandes").alias("orders"), F.count("*").alias("people")).first()
    assert row["orders"] == kept.count()
    assert row["people"] == kept.select(PERSON).distinct().count()
    assert df.where("(est_churne = 1) != (segment_client = 'churne')").count() == 0
