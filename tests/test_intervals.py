"""Points in ranges against a comparison of every pair."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cartmill.operators.intervals import join_containing

ZERO = dt.datetime(1970, 1, 1)


def brute(points, ranges, closed):
    out = []
    for p in points:
        for i, a, z in ranges:
            if p is not None and (a is None or a <= p) and (z is None or p < z or (closed == "both" and p == z)):
                out.append((p, i, a, z))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def value(kind, n):
    if n is None:
        return None
    if kind == "date":
        return dt.date(2000, 1, 1) + dt.timedelta(days=n % 4000 - 2000)
    return ZERO + dt.timedelta(microseconds=n) if kind.startswith("timestamp") else n


@pytest.mark.parametrize("closed", ["both", "left"])
@pytest.mark.parametrize("kind", ["bigint", "date", "timestamp", "timestamp_ntz"])
def test_equals_every_pair(spark, kind, closed):
    rng = random.Random(6)
    most = 4000 if kind == "date" else 10**12
    points = [value(kind, rng.randint(-most, most)) for _ in range(60)] + [None]
    ranges = []
    for i in range(50):
        a = rng.randint(-most, most)
        z = a + rng.choice([0, 1, 7, 8, 9, 63, 1000, most // 50, -5, 3 * most])
        a, z = value(kind, a), value(kind, z)
        ranges.append((i, None if i % 11 == 0 else a, None if i % 13 == 0 else z))
    points += [a for _, a, _ in ranges[:10]] + [z for _, _, z in ranges[:10]]
    left = spark.createDataFrame([(p,) for p in points], f"p {kind}")
    right = spark.createDataFrame(ranges, f"i int, a {kind}, z {kind}")
    got = join_containing(left, "p", right, "a", "z", closed)
    assert got.columns == ["p", "i", "a", "z"]
    assert rows(got) == brute(points, ranges, closed)


def test_known_lengths_look_nothing_up(spark):
    days = spark.range(40).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    weeks = days.filter("dayofweek(day) = 1").select(F.col("day").alias("a"), F.date_add("day", 6).alias("z"))
    got = join_containing(days, "day", weeks, "a", "z", lengths=(6, 6))
    assert rows(got) == rows(join_containing(days, "day", weeks, "a", "z"))
    # one bin for a day, two at most for a week
    assert "Generate" in plan(got) and "sequence" not in plan(got)


def test_empty_sides(spark):
    some, none = spark.range(3), spark.range(0)
    ranges = some.selectExpr("id AS a", "id AS z")
    assert join_containing(none, "id", ranges, "a", "z").count() == 0
    assert join_containing(some, "id", ranges.limit(0), "a", "z").columns == ["id", "a", "z"]
    assert rows(join_containing(some, "id", ranges, "a", "z")) == [(0, 0, 0), (1, 1, 1), (2, 2, 2)]


def test_long_ranges_stay_few(spark):
    """A range of a million days is two rows, not a million."""
    ranges = spark.range(100).selectExpr("-1000000L - id AS a", "1000000L + id AS z")
    got = join_containing(spark.range(10), "id", ranges, "a", "z")
    assert got.count() == 1000 and "explode(sequence" not in plan(got)


def test_other_types(spark):
    df = spark.range(1).selectExpr("1.5D AS p", "1D AS a", "2D AS z")
    with pytest.raises(TypeError):
        join_containing(df.select("p"), "p", df.select("a", "z"), "a", "z")
    with pytest.raises(ValueError):
        join_containing(df, "p", df, "a", "z", closed="right")
