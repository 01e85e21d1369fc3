"""Stored tables: whole steps, filters of keys, files that stay untouched."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from retinue.sources.stored import Conflict, StoredTable

TABLE = "id string, v int, w string"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    """1000 rows in eight files by their key."""
    found = StoredTable(spark, str(tmp_path / "t"))
    found.replace(frame(spark, range(1000)), key=["id"], shards=8)
    return found


def frame(spark, ids, v=0, w="old"):
    return spark.createDataFrame([(f"k{i}", v, w) for i in ids], TABLE)


def placed(spark, ids, v=1, w="new"):
    rows = [(f"k{i}" if i is not None else None, v, w, n) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, f"{TABLE}, place int")


def test_old_keys_stay_and_a_second_load_changes_nothing(spark, table):
    change = table.insert_ignore(placed(spark, [5, 2000, 7, 2001]), "place")
    assert change.rows == 2 and change.version == 1
    got = {r.id: (r.v, r.w) for r in table.read().collect()}
    assert len(got) == 1002 and got["k5"] == (0, "old") and got["k2000"] == (1, "new")
    again = table.insert_ignore(placed(spark, [5, 2000, 7, 2001], v=2), "place")
    assert again.rows == 0 and again.version == 1
    assert len(table.versions()) == 2


def test_the_first_of_new_rows_with_one_key_stays_and_rows_without_a_key_do_not(spark, table):
    rows = spark.createDataFrame(
        [("new", 3, "c", 3), ("new", 1, "a", 1), ("new", 2, "b", 2), (None, 1, "a", 0)], f"{TABLE}, place int"
    )
    assert table.insert_ignore(rows.repartition(3), "place").rows == 1
    assert rows_of(table.read().where("id = 'new'")) == [("new", 1, "a")]
    assert table.read().where("id IS NULL").count() == 0


def test_only_files_that_may_hold_a_key_are_read(spark, table):
    assert len(table.files()) == 8
    one = table.insert_ignore(placed(spark, [17]), "place")
    assert one.rows == 0 and 1 <= len(one.files) <= 2
    # Of a thousand new keys few pass the filters.
    many = placed(spark, range(10_000, 11_000))
    passed = table._may_hold(table.version(), many).count()
    assert passed < 60
    assert table._may_hold(table.version(), placed(spark, range(1000))).select("id").distinct().count() == 1000


def test_many_loads_equal_the_first_rows_of_all(spark, tmp_path):
    rng = random.Random(4)
    table = StoredTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, []), key=["id"], shards=3)
    want = {}
    for load in range(4):
        ids = [rng.choice([0, rng.randint(0, 150)]) for _ in range(120)]
        for i in ids:
            want.setdefault(f"k{i}", load)
        table.insert_ignore(placed(spark, ids, v=load), "place")
    assert {r.id: r.v for r in table.read().collect()} == want
    assert table.read().count() == len(want)


def test_an_update_writes_only_files_with_such_a_row(spark, table):
    before = set(table.files())
    change = table.update(F.col("id").isin("k3", "k4"), v=F.lit(9), w=F.concat("w", F.lit("!")))
    after = set(table.files())
    assert set(change.files) == before - after and 1 <= len(before - after) <= 2
    assert rows_of(table.read().where("v = 9")) == [("k3", 9, "old!"), ("k4", 9, "old!")]
    assert table.read().count() == 1000
    # Filters of the files written again still find their keys.
    assert table.insert_ignore(placed(spark, range(1000)), "place").rows == 0
    nothing = table.update(F.col("id") == "no such", v=F.lit(1))
    assert nothing.version == change.version and nothing.files == ()
    with pytest.raises(ValueError, match="key"):
        table.update(F.lit(True), id=F.lit("x"))


def test_a_condition_that_is_null_changes_nothing(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([("a", None, "x"), ("b", 1, "y")], TABLE))
    table.update(F.col("v") > 0, w=F.lit("z"))
    assert sorted(map(str, rows_of(table.read().select("id", "w")))) == ["('a', 'x')", "('b', 'z')"]


def test_merging_rows_by_key(spark, table):
    add = {"v": lambda old, new: F.coalesce(old, F.lit(0)) + new, "w": lambda old, new: F.coalesce(old, new)}
    before = set(table.files())
    table.update(F.col("id") == "k1", v=F.lit(5))
    change = table.merge(frame(spark, [1, 5000], v=2, w="new"), add)
    assert rows_of(table.read().where("v > 0")) == [("k1", 7, "old"), ("k5000", 2, "new")]
    assert len(change.files) == 1 and len(before & set(table.files())) >= 6


def test_readers_of_another_session_see_old_or_new(spark, table):
    other = StoredTable(spark.newSession(), table.folder)
    old = other.read()
    broken = frame(spark, range(5)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert other.read().count() == 1000
    table.replace(frame(spark, range(5)))
    assert old.count() == 1000 and other.read().count() == 5 and other.read(0).count() == 1000


def test_a_version_is_taken_once(spark, table, monkeypatch):
    number = table._next()
    table.replace(frame(spark, range(3)))
    monkeypatch.setattr(table, "_next", lambda: number)
    with pytest.raises(Conflict):
        table.replace(frame(spark, range(4)))
    assert table.read().count() == 3


def test_a_commit_that_is_being_written_does_not_count(spark, table):
    table._disk.create(f"commits/{7:020d}.json", "")
    assert table.version().number == 0 and table.read().count() == 1000
    assert table.replace(frame(spark, range(2))).version == 8


def test_old_versions_go_and_the_newest_stays(spark, table):
    table.insert_ignore(placed(spark, [3000]), "place")
    table.update(F.col("id") == "k1", v=F.lit(1))
    want = rows_of(table.read())
    assert table.vacuum(timedelta(days=1)) == 0 and len(table.versions()) == 3
    broken = frame(spark, range(5)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert table.vacuum(timedelta(0)) == 2
    assert [v.number for v in table.versions()] == [2]
    assert rows_of(table.read()) == want
    used = {f.rsplit("/", 1)[1] for f in table.files()}
    on_disk = {n for run in table._disk.names("files") for n in table._disk.names(f"files/{run}")}
    assert on_disk == used
    assert table.insert_ignore(placed(spark, [3000, 1]), "place").rows == 0


def test_an_empty_table_and_one_without_versions(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(LookupError):
        table.read()
    table.replace(frame(spark, []), key=["id"])
    assert table.read().count() == 0 and table.files() == []
    assert table.update(F.lit(True), v=F.lit(1)).rows == 0
    assert table.insert_ignore(placed(spark, [1, 1, 2]), "place").rows == 2


def test_rows_without_a_key_meet_no_others_in_a_merge(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    schema = "k string, v bigint, m map<string,bigint>"
    table.replace(spark.createDataFrame([("a", 1, {"x": 1}), (None, 2, None)], schema), key=["k"], shards=2)
    new = spark.createDataFrame([("a", 10, None), ("b", 20, {"y": 2}), (None, 30, None)], schema)
    first = {"v": lambda a, b: F.coalesce(a + b, a, b), "m": lambda a, b: F.coalesce(a, b)}
    table.merge(new, first)
    got = sorted(map(tuple, table.read().collect()), key=str)
    assert got == sorted([("a", 11, {"x": 1}), ("b", 20, {"y": 2}), (None, 2, None), (None, 30, None)], key=str)


def test_a_merge_deals_old_and_new_rows_once(spark, tmp_path, monkeypatch):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint"), key=["k"], shards=2)
    plans = []
    write = StoredTable._write
    monkeypatch.setattr(
        StoredTable,
        "_write",
        lambda self, df, *rest: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(self, df, *rest),
    )
    table.merge(spark.createDataFrame([("a", 5)], "k string, v bigint"), {"v": lambda a, b: F.coalesce(a + b, a, b)})
    assert sorted(map(tuple, table.read().collect())) == [("a", 6), ("b", 2)]
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0]
