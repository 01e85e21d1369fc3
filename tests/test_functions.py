from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retinue.functions.dates import day_gap, month_start
from retinue.functions.display import fixed, label_of, shorten, with_thousands
from retinue.functions.numeric import (
    decimal_mean,
    decimal_ratio,
    mean,
    percent,
    ratio,
    round_half_even,
    round_to,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, digits, expected",
    [
        (2.675, 2, 2.68),  # 267.5 after scaling
        (1.005, 2, 1.0),  # 100.49999999999999 after scaling
        (0.285, 2, 0.28),
        (-2.675, 2, -2.68),
        (2.5, 0, 3.0),
        (12.25, 1, 12.3),
    ],
)
def test_round_to_works_on_the_scaled_value(spark, value, digits, expected):
    assert one(spark, round_to(F.lit(value), digits)) == expected


@pytest.mark.parametrize(
    "value, digits, expected",
    [(2.5, 0, 2.0), (3.5, 0, 4.0), (-2.5, 0, -2.0), (12.25, 1, 12.2), (12.35, 1, 12.4)],
)
def test_round_half_even(spark, value, digits, expected):
    assert one(spark, round_half_even(F.lit(value), digits)) == expected


def test_ratio_of_nothing_is_null(spark):
    assert one(spark, ratio(F.lit(0), F.lit(0))) is None
    assert one(spark, ratio(F.lit(5), F.lit(0))) is None
    assert one(spark, ratio(F.lit(None).cast("int"), F.lit(2))) is None
    assert one(spark, percent(F.lit(1), F.lit(8))) == 12.5


def test_means_skip_nulls_and_stay_exact(spark):
    values = [(Decimal("0.10"),), (Decimal("0.20"),), (None,), (Decimal("0.00"),)]
    df = spark.createDataFrame(values, "v decimal(10,2)")
    row = df.agg(mean(F.col("v")).alias("a"), decimal_mean(F.col("v")).alias("b")).first()
    assert row["a"] == 0.3 / 3
    assert row["b"] == 0.1
    assert df.where("v > 5").agg(mean(F.col("v")).alias("a")).first()["a"] is None


def test_equal_averages_give_equal_doubles(spark):
    """0.30 / 3 and 0.10 / 1 are one value; via doubles of the totals they are two."""
    df = spark.createDataFrame(
        [(Decimal("0.30"), 3), (Decimal("0.10"), 1)], "total decimal(18,2), n bigint"
    )
    got = {r["m"] for r in df.select(decimal_ratio(F.col("total"), F.col("n")).alias("m")).collect()}
    assert got == {0.1}


def test_day_gap_counts_midnights(spark):
    df = spark.createDataFrame(
        [
            (datetime(2020, 1, 1, 23, 59), datetime(2020, 1, 2, 0, 1)),
            (datetime(2020, 1, 1, 0, 0), datetime(2020, 1, 1, 23, 59)),
            (datetime(2020, 1, 2, 0, 1), datetime(2020, 1, 1, 23, 59)),
            (None, datetime(2020, 1, 1)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r["d"] for r in df.select(day_gap(F.col("b"), F.col("a")).alias("d")).collect()]
    assert got == [1, 0, -1, None]


def test_month_start_does_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(datetime(2018, 11, 4, 0, 30),)], "t timestamp_ntz")
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(month_start(F.col("t")).alias("m")).first()["m"] == datetime(2018, 11, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_display(spark):
    assert one(spark, shorten(F.lit("abcdef"), 3)) == "abc..."
    assert one(spark, with_thousands(F.lit(1234567))) == "1,234,567"
    assert one(spark, fixed(F.lit(12.345678), 2, "R$ ", "M")) == "R$ 12.35M"
    assert one(spark, fixed(F.lit(41.04), 1, suffix="%")) == "41.0%"
    assert one(spark, label_of(F.lit("a"), {"a": "Alpha"})) == "Alpha"
    assert one(spark, label_of(F.lit("z"), {"a": "Alpha"})) == "z"


def test_number_text_is_that_of_the_exact_binary_value(spark):
    from retinue.functions.display import fixed

    values = [12.25, 2.675, 162.5, 0.25, 0.05, 0.15, 0.005, 0.015, 0.5, 1.5, 2.5, -0.04, -2.5, 0.0, 999.995, 9.95, 1e15, 0.999]
    values += [n / 16 for n in range(-40, 41)] + [n / 1000 for n in range(0, 400, 5)]
    df = spark.createDataFrame([(v,) for v in [*values, float("nan"), None]], "v double")
    got = df.select("v", *[fixed(df.v, d).alias(f"d{d}") for d in range(4)]).collect()
    for r in got:
        for d in range(4):
            assert r[f"d{d}"] == (None if r.v is None else format(r.v, f".{d}f"))
