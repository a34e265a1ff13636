"""Distributed rank, neighbours and quantiles against brute force, hot groups included."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartmill.operators import ranking
from cartmill.session import clear_scratch, materialize

random.seed(7)
GROUPS = ["hot"] * 10 + ["a", "b", None]
DATA = [
    (random.choice(GROUPS), random.choice([1.0, 1.0, 1.0, 2.5, random.random() * 9]), i) for i in range(3000)
]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(DATA, "g string, v double, k int").repartition(6)


def expected_ranks():
    out = {}
    for g in {d[0] for d in DATA}:
        members = sorted((d for d in DATA if d[0] == g), key=lambda d: (-d[1], d[2]))
        upto = 0.0
        for i, (_, v, k) in enumerate(members, start=1):
            upto += v
            out[k] = (i, len(members), upto)
    return out


def check_ranks(data):
    ranked = ranking.with_rank(
        data, [F.col("v").desc(), F.col("k").asc()], ["g"], total="v", running="upto"
    )
    want = expected_ranks()
    got = {r.k: r for r in ranked.collect()}
    assert len(got) == len(DATA)
    for k, (rank, size, upto) in want.items():
        assert (got[k]["rank"], got[k].group_rows) == (rank, size)
        assert got[k].upto == pytest.approx(upto)
    totals = {g: sum(d[1] for d in DATA if d[0] == g) for g in {d[0] for d in DATA}}
    assert all(r.group_total == pytest.approx(totals[r.g]) for r in got.values())


def test_rank(data):
    check_ranks(data)


@pytest.mark.parametrize("partitions", ["1", "3", "11"])
def test_rank_does_not_depend_on_partitions(spark, data, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_ranks(data)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rank_without_groups_covers_everything(data):
    ranked = ranking.with_rank(data, [F.col("v").asc(), F.col("k").asc()])
    order = [r.k for r in ranked.orderBy("rank").collect()]
    assert order == [d[2] for d in sorted(DATA, key=lambda d: (d[1], d[2]))]


def test_equal_values_are_cut_into_several_ranges(spark):
    """A value held by every row must not end up in a single partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit(1.0).alias("v"), "id")
        placed = ranking._spread(df, [], [F.col("v").asc()])
        sizes = [r["count"] for r in placed.groupBy(ranking.SLICE).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 4000
    assert len(sizes) >= 3 and max(sizes) < 2000


def test_rows_are_never_gathered_in_one_task(data):
    """Only per-range totals may meet in a single partition; rows are written sorted, once."""
    from tests.conftest import plan

    text = plan(ranking.with_rank(data, [F.col("v").desc(), F.col("k").asc()], total="v", running="upto"))
    before, _, after = text.partition("SinglePartition")
    assert text.count("SinglePartition") <= 1 and "HashAggregate" in after


@pytest.mark.parametrize("offset", [-1, 1])
def test_neighbour(data, offset):
    out = ranking.with_neighbour(
        data, "v", [F.col("v").asc(), F.col("k").asc()], ["g"], name="near", offset=offset, flag="edge"
    )
    got = {r.k: (r.near, r.edge) for r in out.collect()}
    for g in {d[0] for d in DATA}:
        members = sorted((d for d in DATA if d[0] == g), key=lambda d: (d[1], d[2]))
        for i, (_, _, k) in enumerate(members):
            j = i + offset
            inside = 0 <= j < len(members)
            assert got[k] == ((members[j][1] if inside else None), not inside)


def test_neighbour_keeps_null_values(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 7)], "k int, v int")
    out = ranking.with_neighbour(df, "v", [F.col("k").asc()], flag="first")
    assert [(r.k, r.previous, r.first) for r in out.orderBy("k").collect()] == [
        (1, None, True),
        (2, None, False),
        (3, 5, False),
        (4, None, False),
    ]


def test_quantiles_match_numpy(data):
    qs = [0.0, 0.2, 0.5, 0.77, 1.0]
    for row in ranking.exact_quantiles(data, "v", qs, ["g"]).collect():
        values = [d[1] for d in DATA if d[0] == row.g]
        assert [row[f"q{i}"] for i in range(len(qs))] == pytest.approx(list(np.quantile(values, qs)))


def test_quantile_out_of_range(data):
    with pytest.raises(ValueError):
        ranking.exact_quantiles(data, "v", [1.5])


def test_scratch_is_cleared(spark):
    df = materialize(spark.range(5))
    assert df.count() == 5
    assert clear_scratch(spark) >= 1
    assert clear_scratch(spark) == 0
