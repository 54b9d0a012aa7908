from decimal import Decimal

import pytest
from conftest import T0, row
from pyspark.sql import functions as F

from candlewick.functions.columns import beyond, first_violation, relative_difference, stored
from candlewick.operators.rows import CandleValidationError, classify, duplicates, keep_last, late, merge, rejected, require_valid, seams, valid
from candlewick.schema import CANDLE, schema_differences, symbol_dir


def test_first_reason_in_order(candles):
    rows = [row(0), row(1, h="1.1", low="1.2"), row(2, h="1.16", low="1.15"), row(3, low="1.175", h="1.18"), row(4, v="-1")]
    got = [r.reason for r in candles(rows).orderBy("timestamp").select(first_violation().alias("reason")).collect()]
    assert got == [None, "high cannot be below low", "high cannot be below open", "low cannot be above open", "volume cannot be negative"]


def test_an_invalid_duplicate_displaces_nothing(candles):
    df = candles([row(0, "1.1"), row(0, "1.2", h="1.0"), row(99)]).withColumn("ord", F.monotonically_increasing_id())
    c = classify(df, T0, T0.replace(hour=1))
    kept = keep_last(valid(c), ["ord"]).collect()
    assert [(r.timestamp.timestamp(), r.open) for r in kept] == [(T0.timestamp(), Decimal("1.1"))]
    assert rejected(c).count() == 1


def test_the_last_of_a_key_stays(candles):
    df = candles([row(0, "1.1"), row(0, "1.3"), row(0, "1.2"), row(1)]).coalesce(1).withColumn("ord", F.monotonically_increasing_id())
    assert sorted(r.open for r in keep_last(df, ["ord"]).collect()) == [Decimal("1.17"), Decimal("1.2")]
    assert [(r.extra) for r in duplicates(df).collect()] == [2]


def test_incoming_rows_win_and_again_change_nothing(candles):
    old, new = candles([row(0, "1.1"), row(1, "1.1")]), candles([row(1, "1.2"), row(2, "1.2")])
    once = merge(old, new)
    assert {r.timestamp.minute: r.open for r in once.collect()} == {0: Decimal("1.1"), 1: Decimal("1.2"), 2: Decimal("1.2")}
    assert sorted(merge(once, new).collect()) == sorted(once.collect())


def test_stored_rounds_half_to_even(spark):
    df = spark.createDataFrame([(Decimal("1.000000005"),), (Decimal("1.000000015"),)], "open decimal(38,18)")
    assert [r.x for r in df.select(stored("open").alias("x")).collect()] == [Decimal("1.00000000"), Decimal("1.00000002")]


def test_relative_difference_and_tolerance(spark):
    df = spark.createDataFrame([(Decimal(1), Decimal(1)), (Decimal(0), Decimal(0)), (Decimal(0), Decimal(5)), (Decimal(10000), Decimal(10001))], "a decimal(18,8), b decimal(18,8)")
    rel = [r.x for r in df.select(relative_difference(F.col("a"), F.col("b")).alias("x")).collect()]
    assert rel[:3] == [0, 0, 1] and abs(rel[3] - 1 / 10001) < 1e-15
    assert [r.x for r in df.select(beyond(F.col("a"), F.col("b"), "0.0001").alias("x")).collect()] == [False, False, True, False]


def test_late_and_seams(spark):
    df = spark.createDataFrame([(1, 10), (1, 50), (2, 40), (2, 60), (3, 70)], "group int, us long")
    assert [r.us for r in late(df, "group").where("late").collect()] == [40]
    assert {r.group: r.unordered for r in seams(df, "group").collect()} == {1: 0, 2: 1, 3: 0}


def test_require_valid(candles):
    assert require_valid(candles([row(0)])).count() == 1
    with pytest.raises(CandleValidationError):
        require_valid(candles([row(0, h="1.0")]))


def test_schema_differences(spark):
    assert schema_differences(CANDLE) == []
    df = spark.createDataFrame([("x", 1.0)], "symbol string, open double")
    got = schema_differences(df.schema)
    assert "missing column timestamp" in got and "open is double, expected decimal128(18, 8)" in got
    assert schema_differences(df.withColumn("z", F.lit(1)).schema)[-1] == "unexpected column z"
    assert symbol_dir(" eur/usd ") == "EUR_USD"


def test_an_empty_relation(candles):
    e = candles([])
    assert merge(e, e).count() == 0 and classify(e).count() == 0 and duplicates(e).count() == 0
