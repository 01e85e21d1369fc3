"""Records of large CSV files by many tasks, against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from retinue.operators.keyed import first_per_key
from retinue.sources.csv_files import POSITION, read_reviews, read_typed
from retinue.sources.csv_records import marked_lines, read_records, records
from retinue.sources.schemas import TABLES

HEADER = ",".join(TABLES["order_reviews"].schema.names)


@pytest.fixture
def tiny_blocks(spark):
    """Blocks of some 200 bytes: most files have many, most records lie at a border sooner or later."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def review_file(rng, rows, end="\n"):
    texts = ["", "plain", 'say "hi"', "a, b", f"one{end}two", f"{end}{end}", f'"{end}"', "x" * 300, f'long{end}' * 30, '""']
    lines = [HEADER]
    for n in range(rows):
        title, message = rng.choice(texts), rng.choice(texts)
        key = f"r{rng.randint(0, rows)}"
        lines.append(f"{key},o{n},{rng.randint(1, 5)},{quoted(title)},{quoted(message)},2018-01-02 00:00:00,")
    return end.join(lines) + end


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*TABLES["order_reviews"].schema.names).collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_records_equal_a_file_read_whole(spark, tmp_path, tiny_blocks, seed, end):
    rng = random.Random(seed)
    for n in range(2):
        (tmp_path / f"part{n}.csv").write_bytes(review_file(rng, 60, end).encode())
    path = str(tmp_path)
    got = read_reviews(spark, path)
    assert rows_of(got) == rows_of(read_typed(spark, path, "order_reviews"))
    assert marked_lines(spark, path).select("file", "block").distinct().count() > 20


def test_the_first_row_of_a_key_is_the_first_of_the_file(spark, tmp_path, tiny_blocks):
    rng = random.Random(3)
    (tmp_path / "reviews.csv").write_text(review_file(rng, 150))
    rows = read_reviews(spark, str(tmp_path))
    in_order = [r.order_id for r in rows.orderBy(POSITION).collect()]
    assert in_order == [f"o{n}" for n in range(150)]
    first = first_per_key(rows, ["review_id"], POSITION)
    want = {}
    for r in rows.orderBy(POSITION).collect():
        want.setdefault(r.review_id, r.order_id)
    assert {r.review_id: r.order_id for r in first.collect()} == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_blocks):
    (tmp_path / "reviews.csv").write_text(review_file(random.Random(4), 200))
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_a_wrong_header_or_a_malformed_row_fails(spark, tmp_path):
    schema = TABLES["order_reviews"].schema
    (tmp_path / "a.csv").write_text("review_id,score\nr1,5\n")
    with pytest.raises(ValueError, match="header"):
        read_records(spark, str(tmp_path / "a.csv"), schema)
    (tmp_path / "b.csv").write_text(f"{HEADER}\nr1,o1,five,,,,\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, str(tmp_path / "b.csv"), schema).collect()


def test_empty_files_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n\nr1,o1,5,,,,\n\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\n")
    (tmp_path / "c.csv").write_text("")
    assert [r.review_id for r in read_reviews(spark, str(tmp_path)).collect()] == ["r1"]
    assert records(spark, str(tmp_path)).where(F.col("record") == "").count() == 0
