"""Tables compared through sums of hashes, and windows over slices that lend rows."""

from __future__ import annotations

import pytest
from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartmill.operators import compare, core_checks
from cartmill.operators.expectations import moving_sigma
from cartmill.operators.ranking import with_halo


@pytest.fixture
def orders(spark):
    return spark.range(5_000).selectExpr(
        "id AS k", "if(id % 9 = 0, null, id % 7) AS a", "cast(id as string) AS b", "id / 3 AS c"
    )


def test_equal_tables_exchange_only_sums(spark, orders):
    shuffled = orders.repartition(7).select("k", "a", "b", "c")
    assert compare.differing_buckets(orders, shuffled, orders.columns) == []
    same = core_checks.equality(orders, shuffled)
    assert same.count() == 0 and "Exchange hashpartitioning(k" not in plan(same)


def test_differences_are_found(spark, orders):
    other = orders.filter("k <> 17").withColumn("a", F.when(F.col("k") == 4_000, 99).otherwise(F.col("a")))
    other = other.unionByName(spark.sql("SELECT -5L AS k, 1L AS a, 'new' AS b, 0D AS c"))
    want = rows(orders.subtract(other).withColumn("w", F.lit("a_minus_b")).unionByName(other.subtract(orders).withColumn("w", F.lit("b_minus_a"))))
    got = core_checks.equality(orders, other)
    assert rows(got.select("k", "a", "b", "c", F.col("which_diff").alias("w"))) == want and len(want) == 4
    assert 1 <= len(compare.differing_buckets(orders, other, orders.columns)) <= 4
    changed = compare.changed_rows(orders, other, ["k"])
    assert rows(changed) == [(-5, "added", None), (17, "removed", None), (4000, "changed", "a")]


def test_repeated_rows_count(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert len(compare.differing_buckets(a, b, ["x"])) == 2
    # the check compares distinct rows
    assert core_checks.equality(a, b).count() == 0


def test_nulls_keep_their_column(spark):
    a = spark.createDataFrame([(None, 1), (2, None)], "x int, y int")
    b = spark.createDataFrame([(1, None), (None, 2)], "x int, y int")
    assert compare.differing_buckets(a, b, ["x", "y"]) != []
    assert core_checks.equality(a, b).count() == 4


def test_null_keys_and_empty_tables(spark):
    a = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    b = spark.createDataFrame([(None, "z"), (1, "y")], "k int, v string")
    assert rows(compare.changed_rows(a, b, ["k"])) == [(None, "changed", "v")]
    assert rows(compare.changed_rows(a.limit(0), b, ["k"])) == [(1, "added", None), (None, "added", None)]
    assert compare.changed_rows(a.limit(0), b.limit(0), ["k"]).count() == 0


def test_large_numbers_with_precision(spark):
    a = spark.createDataFrame([(1e30,), (1.0000001,), (2.5e35,)], "x double")
    b = spark.createDataFrame([(1e30,), (1.0000002,), (3.5e35,)], "x double")
    found = core_checks.equality(a, b, precision=3)
    assert found.count() == 2 and found.columns == ["which_diff", "x"]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_slices_lend_rows(spark, by):
    df = spark.range(300).selectExpr("id", "id % 2 AS g", "id * id % 17 AS v").repartition(4)
    back = Window.partitionBy(*by).orderBy("id").rowsBetween(-5, -1)
    want = rows(df.select("id", F.sum("v").over(back).alias("s")))
    cut = with_halo(df, [F.col("id").asc()], by, 5, chunk=7)
    back = Window.partitionBy(*by, "_slice").orderBy("id").rowsBetween(-5, -1)
    got = cut.withColumn("s", F.sum("v").over(back)).filter("_own")
    assert rows(got.select("id", "s")) == want
    assert cut.select("_slice").distinct().count() >= 300 // len(by or "x") // 2 // 7


@pytest.mark.parametrize("diffs", [True, False])
def test_sliced_trend_equals_one_window(spark, diffs):
    df = spark.range(2_000).selectExpr("timestamp_seconds(id * 31) AS t", "id * 7919 % 101 + 1D AS v").repartition(3)
    args = dict(period="minute", lookback_periods=2, trend_periods=9, take_diffs=diffs)
    whole = moving_sigma(df, "v", "t", **args)
    small = moving_sigma(df, "v", "t", halo_chunk=20, **args)
    keep = ["metric_period", *[F.round(c, 9).alias(c) for c in ("metric_test_value", "metric_test_rolling_stddev", "metric_test_sigma")]]
    assert rows(small.select(keep)) == rows(whole.select(keep)) and small.count() > 900
