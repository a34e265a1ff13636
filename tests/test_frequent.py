"""Heavy hitters and quantiles against full counts."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartmill.operators import frequent, profiling
from cartmill.operators.expectations import most_common_value_in_set
from cartmill.operators.ranking import exact_quantiles


def full(df, n):
    counted = df.groupBy(F.col("v").alias("value_field")).agg(F.count("*").alias("n_rows"))
    return [tuple(r) for r in counted.orderBy(F.desc("n_rows"), F.asc("value_field")).limit(n).collect()]


def most(df, n):
    return [tuple(r) for r in frequent.most_frequent(df, F.col("v"), df.schema["v"].dataType, n).collect()]


@pytest.fixture
def small_sketch(monkeypatch):
    monkeypatch.setattr(frequent, "TRACKED", 256)
    monkeypatch.setattr(frequent, "CANDIDATES", 16)


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "double", "decimal(12,2)"])
def test_skewed_values(spark, kind, small_sketch):
    """A few values stand out of tens of thousands; ties at the end are settled by value."""
    make = "date_add(date'1990-01-01', cast(v as int))" if kind == "date" else f"cast(v as {kind})"
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, id % 7, id) AS v").selectExpr(f"{make} AS v")
    assert frequent.candidate_counts(df, F.col("v"), df.schema["v"].dataType, 7) is not None
    assert most(df, 7) == full(df, 7)


def test_flat_values_are_counted_in_full(spark, small_sketch):
    df = spark.range(20_000).selectExpr("id % 5000 AS v")
    assert frequent.candidate_counts(df, F.col("v"), df.schema["v"].dataType, 3) is None
    assert most(df, 3) == full(df, 3) == [(0, 4), (1, 4), (2, 4)]


def test_tie_across_the_end(spark, small_sketch):
    """More values share the last place than are asked for, and than the sketch names."""
    df = spark.range(40_000).selectExpr("if(id < 30000, id % 30, id) AS v")
    for n in (1, 5, 29, 30, 31):
        assert most(df, n) == full(df, n), n


def test_null_is_a_value(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",), ("b",)], "v string")
    assert most(df, 5) == [("b", 3), (None, 2), ("a", 1)]
    assert [tuple(r) for r in profiling.top_values(df, "v", 2).collect()] == [("b", 3), (None, 2)]
    assert rows(most_common_value_in_set(df, "v", ["a"], 1)) == [("b",)]


def test_empty_and_unsuited(spark):
    assert most(spark.range(0).selectExpr("id AS v"), 3) == []
    df = spark.range(4).selectExpr("array(id % 2) AS v")
    assert most(df, 2) == [([0], 2), ([1], 2)]


def python_quantile(values, q):
    return float(np.quantile(np.array(values, float), q))


@pytest.mark.parametrize("shape", ["spread", "ties", "constant", "heavy tail"])
def test_quantiles_of_large_groups(spark, shape):
    rng = random.Random(3)
    n = 12_000
    make = {
        "spread": lambda: rng.uniform(-1e6, 1e6),
        "ties": lambda: float(rng.randint(0, 5)),
        "constant": lambda: 4.25,
        "heavy tail": lambda: rng.paretovariate(0.5),
    }[shape]
    values = [make() for _ in range(n)]
    groups = [(None if i % 3 == 0 else "small" if i % 400 == 1 else "big", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(groups, "g string, v double").repartition(5)
    asked = [0, 0.001, 0.1234, 0.5, 0.9, 0.9999, 1]
    got = {r["g"]: tuple(r)[1:] for r in exact_quantiles(df, "v", asked, ["g"]).collect()}
    for g in (None, "small", "big"):
        own = [v for k, v in groups if k == g]
        assert got[g] == pytest.approx([python_quantile(own, q) for q in asked], rel=1e-12)
    whole = exact_quantiles(df, "v", [0.5]).first()[0]
    assert whole == pytest.approx(statistics.median(values), rel=1e-12)


def test_quantiles_of_whole_numbers_past_doubles(spark):
    """Neighbours that are one double stay apart."""
    base = 2**60
    df = spark.range(9_001).select((F.lit(base) + F.col("id")).alias("v"))
    assert exact_quantiles(df, "v", [0.5]).first()[0] == float(base + 4500)


def test_only_the_bracket_is_sorted(spark, monkeypatch):
    from cartmill.operators import ranking

    seen = []
    keep = ranking.with_rank

    def look(df, *args, **kwargs):
        seen.append(df.count())
        return keep(df, *args, **kwargs)

    monkeypatch.setattr(ranking, "with_rank", look)
    df = spark.range(50_000).select((F.col("id") * 1.5).alias("v"))
    assert exact_quantiles(df, "v", [0.5]).first()[0] == 24_999.5 * 1.5
    assert seen[0] < 250
