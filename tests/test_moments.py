from __future__ import annotations

import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from fundflow.functions.moments import add_moments, billionths, moments, sample_deviation


def exact(values, places=4):
    """Half-up sample deviation of decimals, from whole numbers only."""
    if len(values) < 2:
        return None
    with localcontext() as c:
        c.prec = 200
        k = [int(Decimal(repr(v)).quantize(Decimal("1e-9"), "ROUND_HALF_UP").scaleb(9)) for v in values]
        n = len(k)
        spread = n * sum(x * x for x in k) - sum(k) ** 2
        variance = Decimal(spread) / (n * (n - 1))
        root = variance.sqrt() / 10**9
        return float(root.quantize(Decimal(1).scaleb(-places), "ROUND_HALF_UP"))


def of(spark, groups, parts=3):
    rows = [(g, v) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "g int, x double").withColumn("k", billionths("x"))
    states = frame.repartition(parts).groupBy("g").agg(moments("x", "k").alias("m"))
    return {r["g"]: r["d"] for r in states.select("g", sample_deviation(F.col("m")).alias("d")).collect()}


def groups():
    rnd = random.Random(8)
    out = {0: [], 1: [5.0], 2: [7.25] * 5, 3: [1.0, 2.0], 4: [0.0, 0.0001], 5: [1e8 - 0.01, 1e8 + 0.02]}
    for g in range(10, 40):
        base = 10 ** rnd.uniform(-4, 9)
        places = rnd.choice([2, 4, 4, 6, 9])
        out[g] = [round(base + rnd.gauss(0, base * 10 ** -rnd.randint(0, 6)), places) for _ in range(rnd.randint(2, 400))]
    out[50] = [-x for x in out[20]] + out[21]
    out[52] = [0.0, 0.0001] * 2 + [0.00005] * 3
    # Sum of squares 4 * d ** 2 over n - 1 = 4: the deviation is d itself, at a tie.
    out[53] = [1.0 + 0.00005, 1.0 - 0.00005] * 2 + [1.0]
    out[54] = [10.0 + 0.12345, 10.0 - 0.12345] * 2 + [10.0]
    out[55] = [10.0 + 0.12335, 10.0 - 0.12335] * 2 + [10.0]
    return {g: v for g, v in out.items() if v}


def test_deviation_is_rounded_once(spark):
    want = {g: exact(v) for g, v in groups().items()}
    assert want[53] == 0.0001 and want[54] == 0.1235 and want[55] == 0.1234
    assert of(spark, groups()) == want


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_deviation_does_not_depend_on_partitioning(spark, parts):
    rnd = random.Random(parts)
    shuffled = {g: rnd.sample(v, len(v)) for g, v in groups().items()}
    assert of(spark, shuffled, parts) == {g: exact(v) for g, v in groups().items()}


def test_states_merge(spark):
    rows = [(g, i % 5, v) for g, values in groups().items() for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "g int, part int, x double").withColumn("k", billionths("x"))
    parts = frame.groupBy("g", "part").agg(moments("x", "k").alias("m"))
    merged = parts.groupBy("g").agg(add_moments("m").alias("m"))
    got = {r["g"]: r["d"] for r in merged.select("g", sample_deviation(F.col("m")).alias("d")).collect()}
    assert got == {g: exact(v) for g, v in groups().items()}


def test_values_outside_the_exact_range(spark):
    far = {6: [4.5e9, -4.5e9, 4.5e9 - 1e-6] * 50, 1: [1e12, 3e12], 2: [1.0, 1e10], 3: [1e300, 1e300], 4: [float("nan"), 1.0], 5: [5e9]}
    got = of(spark, far)
    assert got[1] == pytest.approx(1.4142135623731e12, rel=1e-9)
    assert got[2] == pytest.approx(7071067811.158, rel=1e-9)
    assert got[6] == pytest.approx(4256853928.5636, rel=1e-9)
    assert got[4] != got[4] and got[5] is None


def test_many_rows_of_a_large_price(spark):
    frame = spark.range(200_000).selectExpr("cast(4.0e9 + (id % 2) * 0.0002 as double) as x")
    m = frame.withColumn("k", billionths("x")).agg(moments("x", "k").alias("m"))
    assert m.select(sample_deviation(F.col("m"))).first()[0] == exact([4.0e9, 4.0e9 + 0.0002] * 100_000)
