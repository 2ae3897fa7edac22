from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fundflow.operators.positions import positions
from fundflow.operators.summary import shown
from tests.frames import plan_text, rows


def test_positions_equal_one_window(spark):
    rnd = random.Random(3)
    values = [(k, rnd.choice([None, 1.5, -2.0, float(k % 50)]), rnd.choice("ab")) for k in range(3_000)]
    frame = spark.createDataFrame(values, "id int, v double, `a b` string").repartition(11)
    order = [F.desc_nulls_last("v"), F.asc("a b"), F.asc("id")]
    got = positions(frame, order)
    want = frame.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert rows(got) == rows(want) and got.columns == want.columns
    assert "SinglePartition" not in plan_text(got)
    assert "Window" not in plan_text(got)


def test_a_value_of_a_third_of_all_rows_is_split(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(60_000, numPartitions=6).selectExpr("id", "if(id % 3 = 0, 7, id) as v")
        placed = positions(frame, [F.asc("v"), F.asc("id")])
        assert placed.agg(F.sum("position")).first()[0] == 60_000 * 60_001 // 2
        files = spark.read.parquet(*placed.inputFiles()).groupBy(F.input_file_name()).count().collect()
        assert max(r["count"] for r in files) < 2 * 60_000 / len(files)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_rows_and_ties(spark):
    assert positions(spark.range(0), [F.asc("id")]).count() == 0
    level = positions(spark.createDataFrame([(1,)] * 5, "v int"), [F.asc("v")])
    assert sorted(r["position"] for r in level.collect()) == [1, 2, 3, 4, 5]


def test_shown_without_a_limit_numbers_all_rows(spark):
    frame = spark.createDataFrame([(None, 3), (None, 1)], "ingestion_date date, count long").union(
        spark.sql("SELECT date'2024-03-01', 2L")
    )
    got = shown("summary_nav_by_date", frame)
    assert dict(got.dtypes)["position"] == "int"
    assert sorted(r["position"] for r in got.collect()) == [1, 2, 3]
