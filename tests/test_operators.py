"""Operators against plain windows or brute force, with hot keys and ties."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retinue import session
from retinue.operators.keyed import duplicate_keys, first_per_key, most_frequent, top
from retinue.operators.ordered import with_previous
from retinue.operators.ranking import with_rank
from retinue.operators.staging import RANGE, in_ranges, settle, sums_before, with_range
from retinue.session import shared_dir


def test_first_per_key_keeps_whole_first_rows(spark):
    random.seed(3)
    rows = [(random.choice(["hot"] * 30 + list("abcdef")), i, random.choice([None, i])) for i in range(900)]
    shuffled = random.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "k string, pos int, v int").repartition(5)
    expected = {}
    for k, pos, v in rows:
        expected.setdefault(k, (pos, v))
    got = {r["k"]: (r["pos"], r["v"]) for r in first_per_key(df, ["k"], "pos").collect()}
    assert got == expected


def test_first_per_key_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 2)], "k string, pos int, v int")
    plan = first_per_key(df, ["k"], "pos")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_most_frequent_takes_the_smallest_of_a_tie_and_no_null(spark):
    df = spark.createDataFrame(
        [("x", "b", 2), ("x", "a", 2), ("x", "c", 1), ("y", None, 9), ("y", "q", 1), ("z", None, 3)],
        "g string, v string, n bigint",
    )
    got = {r["g"]: r["m"] for r in most_frequent(df, ["g"], "v", "n", "m").collect()}
    assert got == {"x": "a", "y": "q", "z": None}


def test_top_is_sorted(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("v"), "id")
    got = [(r["v"], r["id"]) for r in top(df, 12, F.col("v").desc(), F.col("id")).collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and len(got) == 12


def sequence_rows(kind: str, seed: int):
    """600 rows of which a third or more belong to one group."""
    rng = random.Random(seed)
    start = datetime(2020, 1, 1)
    rows = []
    for i in range(600):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randint(0, 150)}"
        at = start if kind == "same time" else start + timedelta(hours=rng.randint(0, 5000))
        rows.append((group, at, f"o{i:04d}", rng.randint(1, 9)))
    return rows


@pytest.mark.parametrize("kind", ["spread", "same time"])
@pytest.mark.parametrize("task_rows", [7, 60, 150])
def test_previous_across_ranges_equals_the_window(spark, kind, task_rows):
    rows = sequence_rows(kind, task_rows)
    df = spark.createDataFrame(rows, "g string, at timestamp_ntz, id string, v int")
    names = {"v": "v_before", "at": "at_before"}

    def run(limit):
        out = with_previous(df, "g", ["at", "id"], names, task_rows=limit)
        return sorted(tuple(r) for r in out.select("g", "at", "id", "v", "v_before", "at_before").collect())

    def key(r):
        return [str(x) for x in r]

    assert sorted(map(key, run(task_rows))) == sorted(map(key, run(10**6)))


@pytest.mark.parametrize("ties", ["none", "some", "a third", "all"])
@pytest.mark.parametrize("task_rows", [5, 40, 130])
def test_rank_across_ranges_equals_the_window(spark, ties, task_rows):
    rng = random.Random(task_rows)
    pick = {
        "none": lambda i: float(i * 7 % 401),
        "some": lambda i: float(rng.randint(0, 40)),
        "a third": lambda i: 50.0 if rng.random() < 0.34 else rng.random() * 100,
        "all": lambda i: 1.5,
    }[ties]
    rows = [(f"k{i:03d}", pick(i) if i % 11 else None) for i in range(401)]
    df = spark.createDataFrame(rows, "k string, v double")
    values = [v for _, v in rows if v is not None]
    expected = {k: None if v is None else 1 + sum(w > v for w in values) for k, v in rows}
    for limit in (task_rows, 10**6):
        out = with_rank(df, "k", "v", "r", task_rows=limit)
        assert {r["k"]: r["r"] for r in out.collect()} == expected
        assert dict(out.dtypes)["r"] == "bigint"


def test_ranges_split_a_hot_leading_value(spark):
    df = spark.range(4000).select(F.lit(1).alias("v"), "id")
    placed = settle(in_ranges(df, [F.col("v"), F.col("id")], 4000, 1000))
    sizes = [r["n"] for r in placed.groupBy(RANGE).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 4 and max(sizes) < 1000


def test_settled_frames_read_only_what_is_asked(spark):
    df = settle(spark.range(1000).select((F.col("id") % 50).alias("k"), "id"))
    asked = df.groupBy("k").count()
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint>" in plan and "Range" not in plan
    assert asked.count() == 50 and settle(df.where("k < 0")).count() == 0


def test_staging_goes_below_the_checkpoint_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    settled = settle(spark.range(3))
    assert shared_dir(spark) == folder
    assert all(f.removeprefix("file://").startswith(folder) for f in settled.inputFiles())


def test_staged_data_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    assert settle(spark.range(3)).count() == 3
    assert list(tmp_path.glob("retinue-*/staged-*"))
    session.clear_staged(spark)
    assert not list(tmp_path.glob("retinue-*"))


def test_every_range_is_a_task_of_its_own_and_bounded(spark):
    rows = 40_000
    df = spark.range(rows).select((F.col("id") % 7).alias("v"), "id")
    ranged = in_ranges(df, [F.col("v"), F.col("id")], rows, 800)
    by_task = ranged.groupBy(F.spark_partition_id().alias("task"))
    tasks = by_task.agg(F.count_distinct(RANGE).alias("ranges"), F.count("*").alias("n")).collect()
    assert len(tasks) >= 95 and {t["ranges"] for t in tasks} == {1}
    assert max(t["n"] for t in tasks) <= 800 and sum(t["n"] for t in tasks) == rows


def test_a_window_over_ranges_needs_no_other_shuffle(spark):
    ranged = in_ranges(spark.range(100).toDF("v"), [F.col("v")], 100, 10)
    ranked = ranged.withColumn("r", F.rank().over(Window.partitionBy(RANGE).orderBy("v")))
    plan = ranked._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert plan.count("Exchange") == 1 and "rangepartitioning" not in plan


def test_ranges_stay_bounded_when_there_are_very_many(spark):
    rows, ranges = 200_000, 100_000
    df = spark.range(rows).select(F.lit("a").alias("v"), (F.col("id") * 7919 % rows).alias("id"))
    numbered = with_range(df, [F.col("v"), F.col("id")], rows, ranges).withColumnRenamed(RANGE, "r")
    found = numbered.groupBy("r").agg(F.count("*").alias("n")).agg(F.max("n"), F.count("*"), F.max("r")).first()
    assert found[0] <= 4 and found[1] > 0.9 * ranges and found[2] < ranges


def test_sums_before_on_two_levels(spark):
    df = spark.range(0, 5000, 3).select(F.col("id").alias("i"), (F.col("id") % 7).alias("v"))
    got = {r["i"]: r["s"] for r in sums_before(df, "i", "v", "s", block=100).collect()}
    total = 0
    for i in range(0, 5000, 3):
        assert got[i] == total
        total += i % 7


def test_no_operator_forces_a_broadcast(spark):
    df = settle(spark.range(1000).select(F.col("id").cast("string").alias("k"), F.rand(1).alias("v"), "id"))
    for out in (
        with_rank(df, "k", "v", "r", task_rows=100),
        with_previous(df, "k", ["id"], {"v": "before"}, task_rows=100),
    ):
        assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_rank_has_one_plan_at_every_size(spark):
    def shape(rows):
        df = settle(spark.range(rows).select(F.col("id").cast("string").alias("k"), F.rand(1).alias("v")))
        plan = with_rank(df, "k", "v", "r", task_rows=1000)._jdf.queryExecution().optimizedPlan()
        return [line.strip(" +-:").split(" ")[0] for line in plan.toString().splitlines()]

    assert shape(10) == shape(100_000)
