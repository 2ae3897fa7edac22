from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from fundflow.functions import exact
from fundflow.functions import (
    daily_return,
    domain,
    exact_mean,
    exact_sum,
    inflow,
    outflow,
    positive,
    required,
    settle,
    signed_amount,
)


def half_up(value: Decimal, places: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def published(frame, places=2):
    total = settle(exact_sum("x"), places)
    return frame.agg(total.alias("t"), exact_mean("x", places).alias("m")).first()


@pytest.mark.parametrize("digits", [0, 2, 4, 7, 10])
def test_totals_equal_decimal_arithmetic(spark, digits):
    rng = random.Random(digits)
    values = [round(rng.uniform(-50_000, 50_000), digits) for _ in range(3_000)]
    want = sum(Decimal(repr(v)) for v in values)
    row = published(doubles(spark, values).repartition(7))
    assert row["t"] == half_up(want, 2)
    assert row["m"] == half_up(want / len(values), 2)


def test_total_is_exact_where_doubles_are_not(spark):
    values = [0.1] * 10 + [1e9, -1e9, 0.005]
    assert sum(values) != 1.005
    assert published(doubles(spark, values))["t"] == 1.01


def test_large_and_small_values_share_a_total(spark):
    values = [123_456_789_012.34, 987_654_321_098_765.5, 0.0001, 1e-10, -5e-5, 3e-25]
    want = sum(Decimal(repr(v)) for v in values)
    total = F.col("t")
    parts = doubles(spark, values).agg(exact_sum("x").alias("t")).select(
        exact.base_of(total), exact.whole_of(total), exact.fraction_of(total), total["outside"]
    ).first()
    assert sum(parts[:3]) == want and parts[3] == 0


@pytest.mark.parametrize("value, total", [(4e-11, 4e-5), (1.00000000005, 1000000.00005)])
def test_what_lies_past_ten_places_adds_up(spark, value, total):
    frame = spark.range(1_000_000, numPartitions=8).select(F.lit(value).alias("x"))
    assert frame.agg(settle(exact_sum("x"), 5).alias("t")).first()["t"] == total


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_huge_values_do_not_hide_small_ones(spark, partitions):
    small = spark.range(199_998).select(F.lit(0.01).alias("x"))
    frame = doubles(spark, [1e20, -1e20]).union(small).repartition(partitions)
    assert published(frame)["t"] == 1999.98
    row = published(doubles(spark, [1e20, 2.0]))
    assert (row["t"], row["m"]) == (1e20, 5e19)


def test_a_mean_is_rounded_once(spark):
    # The true mean is 1.004999999975: eleven decimals of it end in a tie.
    frame = spark.range(4_000_000, numPartitions=8).select(
        F.when(F.col("id") == 0, 1.0049).otherwise(1.005).alias("x")
    )
    assert frame.agg(exact_mean("x", 2).alias("m")).first()["m"] == 1.0
    minus = frame.select((-F.col("x")).alias("x"))
    assert minus.agg(exact_mean("x", 2).alias("m")).first()["m"] == -1.0


@pytest.mark.parametrize("tail, want", [(0.0, 1.01), (1e-12, 1.01), (-1e-12, 1.0)])
def test_a_tie_is_decided_by_what_follows(spark, tail, want):
    frame = doubles(spark, [1.005, tail])
    assert published(frame)["t"] == want
    assert published(frame.select((-F.col("x")).alias("x")))["t"] == -want


def test_values_outside_the_range_are_counted(spark):
    values = [1e300, 1e-40, float("nan"), 1.0, 1e-25]
    parts = doubles(spark, values).agg(exact_sum("x").alias("t")).first()["t"]
    assert parts["outside"] == 3
    assert published(doubles(spark, [1e300, 2.0]))["t"] == 1e300


def test_nan_and_infinity_do_not_fail_a_job(spark):
    row = published(doubles(spark, [float("inf"), 1.0]))
    assert row["t"] == float("inf")
    assert published(doubles(spark, [float("nan"), 1.0]))["t"] != 0


def test_no_values_give_null(spark):
    assert tuple(published(doubles(spark, [None, None]))) == (None, None)
    assert tuple(published(doubles(spark, []))) == (None, None)


def test_missing_values_do_not_count_in_a_mean(spark):
    assert published(doubles(spark, [1.0, None, 2.0]))["m"] == 1.5


def test_rounding_is_half_up(spark):
    for value, want in ((1.005, 1.01), (1.255, 1.26), (-1.005, -1.01), (2.675, 2.68)):
        assert published(doubles(spark, [value]))["t"] == want


def test_signed_amount(spark):
    rows = [("BUY", 5.0), ("SELL", 5.0), ("REDEEM", 5.0), ("buy", 5.0), (None, 5.0)]
    kind, amount = F.col("k"), F.col("a")
    frame = spark.createDataFrame(rows, "k string, a double").select(
        signed_amount(kind, amount).alias("s"),
        inflow(kind, amount).alias("i"),
        outflow(kind, amount).alias("o"),
    )
    assert [tuple(r) for r in frame.collect()] == [
        (5.0, 5.0, 0.0),
        (-5.0, 0.0, 5.0),
        (0.0, 0.0, 0.0),
        (0.0, 0.0, 0.0),
        (0.0, 0.0, 0.0),
    ]
    assert dict(frame.dtypes)["s"] == "double"


def test_daily_return(spark):
    rows = [(100.0, 101.5), (3.0, 2.0), (0.0, 5.0), (None, 5.0)]
    frame = spark.createDataFrame(rows, "o double, c double")
    got = [r[0] for r in frame.select(daily_return(F.col("o"), F.col("c"))).collect()]
    assert got == [1.5, -33.3333, None, None]


def test_daily_return_is_rounded_once(spark):
    """In doubles this return is 225.78124999999997."""
    frame = spark.createDataFrame([(1.28, 4.17)], "o double, c double")
    assert frame.select(daily_return(F.col("o"), F.col("c"))).first()[0] == 225.7812


def test_rules_are_never_null(spark):
    values = [1.0, 0.0, -1.0, None, float("nan"), float("inf")]
    got = doubles(spark, values).select(positive("x")).collect()
    assert [r[0] for r in got] == [True, False, False, False, False, False]
    kinds = spark.createDataFrame([("A",), ("C",), (None,)], "k string")
    assert [r[0] for r in kinds.select(domain("k", ["A", "B"])).collect()] == [True, False, False]
    pairs = spark.createDataFrame([(1, 2), (1, None), (None, None)], "a int, b int")
    assert [r[0] for r in pairs.select(required(["a", "b"])).collect()] == [True, False, False]
