"""Every expectation with a passing and a failing case on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartmill.operators import expectations as X
from conftest import rows

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def data(spark):
    """Four rows of mixed columns, some always NULL."""
    schema = "idx int, date_col date, a double, b double, s string, t string, n int, neg int, total double"
    return spark.createDataFrame(
        [
            (1, dt.date(2020, 10, 21), 0.0, 0.5, "ab", "ab", None, -2, 0.5),
            (2, dt.date(2020, 10, 22), 1.0, 0.5, "cd", "CD", None, -4, 1.5),
            (3, dt.date(2020, 10, 23), 0.5, 0.5, "ef", "gh", None, -6, 1.0),
            (4, dt.date(2020, 10, 23), 0.5, 0.5, "gh", "gh", None, -8, 1.0),
        ],
        schema,
    )


def n(df):
    return df.count()


CASES = {
    "between": (lambda d: X.values_between(d, "idx", 1, 4), lambda d: X.values_between(d, "idx", 1, 4, strictly=True), 2),
    "between_condition": (
        lambda d: X.values_between(d, "a", 0.5, None, row_condition="idx > 1"),
        lambda d: X.values_between(d, "a", 0.5),
        1,
    ),
    "between_null": (lambda d: X.values_between(d, "n", 1), lambda d: X.values_between(d, "neg", 0), 4),
    "true": (lambda d: X.expression_is_true(d, "a <= 1"), lambda d: X.expression_is_true(d, F.col("a") < 1), 1),
    "true_condition": (
        lambda d: X.expression_is_true(d, "a > 5", "= false"),
        lambda d: X.expression_is_true(d, "n > 5", "is not null"),
        4,
    ),
    "grouped": (
        lambda d: X.expression_is_true(d, F.count("*") < 3, by=["date_col"]),
        lambda d: X.expression_is_true(d, F.count("*") == 1, by=["date_col"]),
        1,
    ),
    "in_set": (lambda d: X.values_in_set(d, "idx", [1, 2, 3, 4]), lambda d: X.values_in_set(d, "idx", [1, 2]), 2),
    "in_set_null": (lambda d: X.values_in_set(d, "s", ["ab", "cd", "ef", "gh"]), lambda d: X.values_in_set(d, "n", [1]), 4),
    "not_in_set": (lambda d: X.values_not_in_set(d, "n", [1]), lambda d: X.values_not_in_set(d, "s", ["ab", "x"]), 1),
    "type": (lambda d: X.column_of_type(d, "IDX", "int"), lambda d: X.column_in_type_list(d, "a", ["int", "string"]), 1),
    "null": (lambda d: X.values_null(d, "n"), lambda d: X.values_null(d, "a"), 4),
    "not_null": (lambda d: X.values_not_null(d, "a"), lambda d: X.values_not_null(d, "n", "idx < 3"), 2),
    "unique": (lambda d: X.values_unique(d, "idx"), lambda d: X.values_unique(d, "a"), 1),
    "casing": (lambda d: X.consistent_casing(d, "s"), lambda d: X.consistent_casing(d.selectExpr("explode(array(s, t)) x"), "x"), 1),
    "distinct_equal": (lambda d: X.distinct_count_equal(d, "a", 3), lambda d: X.distinct_count_equal(d, "a", 4), 1),
    "distinct_greater": (
        lambda d: X.distinct_count_greater_than(d, "a", 2),
        lambda d: X.distinct_count_greater_than(d, "a", 3),
        1,
    ),
    "distinct_less": (
        lambda d: X.distinct_count_less_than(d, "a", 4),
        lambda d: X.distinct_count_less_than(d, "a", 3),
        1,
    ),
    "distinct_other": (
        lambda d: X.distinct_count_equal_other_table(d, "a", d, "t"),
        lambda d: X.distinct_count_equal_other_table(d, "a", d, "idx"),
        1,
    ),
    "distinct_in_set": (
        lambda d: X.distinct_values_in_set(d, "a", [0.0, 0.5, 1.0, 9.0]),
        lambda d: X.distinct_values_in_set(d, "a", [0.0, 0.5]),
        1,
    ),
    "contain_set": (
        lambda d: X.distinct_values_contain_set(d, "s", ["ab", "gh"]),
        lambda d: X.distinct_values_contain_set(d, "s", ["ab", "zz", "zz"]),
        1,
    ),
    "equal_set": (
        lambda d: X.distinct_values_equal_set(d, "idx", [1, 2, 3, 4]),
        lambda d: X.distinct_values_equal_set(d, "idx", [2, 3, 4, 5]),
        2,
    ),
    "max": (lambda d: X.max_between(d, "idx", 4, 4), lambda d: X.max_between(d, "idx", None, 4, strictly=True), 1),
    "min": (lambda d: X.min_between(d, "idx", 1, 1), lambda d: X.min_between(d, "idx", 2), 1),
    "mean": (lambda d: X.mean_between(d, "idx", 2.5, 2.5), lambda d: X.mean_between(d, "idx", 3), 1),
    "median": (lambda d: X.median_between(d, "a", 0.5, 0.5), lambda d: X.median_between(d, "idx", 3), 1),
    "quantile": (
        lambda d: X.quantile_between(d, "idx", 0.95, 3.84, 3.86),
        lambda d: X.quantile_between(d, "idx", 0.95, 4),
        1,
    ),
    "stdev": (lambda d: X.stdev_between(d, "idx", 1.29, 1.30), lambda d: X.stdev_between(d, "idx", 0, 1.29), 1),
    "sum": (lambda d: X.sum_between(d, "idx", 10, 10), lambda d: X.sum_between(d, "idx", 2, 1), 1),
    "sum_grouped": (
        lambda d: X.sum_between(d, "idx", 1, 7, by=["date_col"]),
        lambda d: X.sum_between(d, "idx", 2, 5, by=["date_col"]),
        2,
    ),
    "most_common": (
        lambda d: X.most_common_value_in_set(d, "a", [0.5], 1),
        lambda d: X.most_common_value_in_set(d, "a", [0.5], 2),
        1,
    ),
    "unique_share": (
        lambda d: X.proportion_of_unique_values_between(d, "a", 0.75, 0.75),
        lambda d: X.proportion_of_unique_values_between(d, "a", 0.8),
        1,
    ),
    "unique_share_empty": (
        lambda d: X.proportion_of_unique_values_between(d, "n", 1, 1),
        lambda d: X.proportion_of_unique_values_between(d, "n", 0, 0.5),
        1,
    ),
    "unique_count": (
        lambda d: X.unique_value_count_between(d, "a", 3, 3),
        lambda d: X.unique_value_count_between(d, "a", 4),
        1,
    ),
    "pair_greater": (
        lambda d: X.pair_a_greater_than_b(d, "b", "a", row_condition="idx = 1"),
        lambda d: X.pair_a_greater_than_b(d, "a", "b"),
        3,
    ),
    "pair_greater_or_equal": (
        lambda d: X.pair_a_greater_than_b(d, "total", "a", or_equal=True),
        lambda d: X.pair_a_greater_than_b(d, "a", "b", or_equal=True),
        1,
    ),
    "pair_equal": (lambda d: X.pair_equal(d, "a", "a"), lambda d: X.pair_equal(d, "s", "t"), 2),
    "pair_in_set": (
        lambda d: X.pair_in_set(d, "a", "b", [(0.0, 0.5), (1.0, 0.5), (0.5, 0.5)]),
        lambda d: X.pair_in_set(d, "a", "b", [(0.5, 0.5)]),
        2,
    ),
    "compound": (lambda d: X.compound_unique(d, ["date_col", "s"]), lambda d: X.compound_unique(d, ["date_col", "a"]), 1),
    "compound_missing": (
        lambda d: X.compound_unique(d, ["date_col", "n"], "any_value_is_missing"),
        lambda d: X.compound_unique(d, ["date_col", "n"]),
        1,
    ),
    "sum_columns": (
        lambda d: X.multicolumn_sum_equal(d, ["a", "b"], "total"),
        lambda d: X.multicolumn_sum_equal(d, ["a", "b"], 5),
        1,
    ),
    "sum_columns_number": (
        lambda d: X.multicolumn_sum_equal(d, ["a", "b"], 4),
        lambda d: X.multicolumn_sum_equal(d, ["a"], "total", ["idx"]),
        4,
    ),
    "record": (
        lambda d: X.unique_within_record(d, ["s", "idx"]),
        lambda d: X.unique_within_record(d, ["s", "t"]),
        2,
    ),
    "record_missing": (
        lambda d: X.unique_within_record(d, ["s", "n"], "any_value_is_missing"),
        lambda d: X.unique_within_record(d, ["s", "n"]),
        4,
    ),
    "lengths": (
        lambda d: X.value_lengths_between(d, "s", 2, 4),
        lambda d: X.value_lengths_between(d, "s", 2, 4, strictly=True),
        4,
    ),
    "length": (lambda d: X.value_lengths_equal(d, "s", 2), lambda d: X.value_lengths_equal(d, "s", 3), 4),
    "like": (lambda d: X.match_like(d, "s", "__"), lambda d: X.match_like(d, "s", "a%"), 3),
    "not_like": (lambda d: X.not_match_like(d, "s", "x%"), lambda d: X.not_match_like(d, "s", "a%"), 1),
    "like_list": (
        lambda d: X.match_like_list(d, "s", ["%b", "%d", "%f", "%h"]),
        lambda d: X.match_like_list(d, "s", ["a%", "%b"], "all"),
        3,
    ),
    "not_like_list": (
        lambda d: X.not_match_like_list(d, "s", ["a%", "%d"]),
        lambda d: X.not_match_like_list(d, "s", ["a%", "%d"], "all"),
        2,
    ),
    "regex": (lambda d: X.match_regex(d, "t", "^[a-z]+$", "i"), lambda d: X.match_regex(d, "t", "^[a-z]+$"), 1),
    "not_regex": (lambda d: X.not_match_regex(d, "s", "@"), lambda d: X.not_match_regex(d, "s", "[ab]"), 1),
    "regex_list": (
        lambda d: X.match_regex_list(d, "s", ["^[ac]", "^[eg]"]),
        lambda d: X.match_regex_list(d, "s", ["^[ac]", "b$"], "all"),
        3,
    ),
    "not_regex_list": (
        lambda d: X.not_match_regex_list(d, "s", ["^a", "^c"]),
        lambda d: X.not_match_regex_list(d, "s", ["^a", "^c"], "all"),
        2,
    ),
    "exists": (lambda d: X.column_exists(d, "DATE_COL", 2), lambda d: X.column_exists(d, "date_col", 3), 1),
    "column_count": (lambda d: X.column_count_between(d, 1, 9), lambda d: X.column_count_between(d, 0, 0), 1),
    "column_count_equal": (lambda d: X.column_count_equal(d, 9), lambda d: X.column_count_equal(d, 8), 1),
    "column_count_other": (
        lambda d: X.column_count_equal_other_table(d, d),
        lambda d: X.column_count_equal_other_table(d, d.drop("n")),
        1,
    ),
    "columns_contain": (
        lambda d: X.columns_contain_set(d, ["idx", "A"]),
        lambda d: X.columns_contain_set(d, ["idx", "zz", "yy"]),
        2,
    ),
    "columns_not_contain": (
        lambda d: X.columns_not_contain_set(d, ["zz"]),
        lambda d: X.columns_not_contain_set(d, ["idx", "zz"]),
        1,
    ),
    "columns_set": (
        lambda d: X.columns_match_set(d.select("idx", "a"), ["A", "IDX"]),
        lambda d: X.columns_match_set(d.select("idx", "a"), ["a", "b"]),
        2,
    ),
    "columns_ordered": (
        lambda d: X.columns_match_ordered_list(d.select("idx", "a"), ["idx", "a"]),
        lambda d: X.columns_match_ordered_list(d.select("idx", "a"), ["a", "idx", "b"]),
        5,
    ),
    "row_count": (lambda d: X.row_count_between(d, 1, 4), lambda d: X.row_count_between(d, 1, 4, strictly=True), 1),
    "row_count_equal": (lambda d: X.row_count_equal(d, 4), lambda d: X.row_count_equal(d, 1, ["date_col"]), 1),
    "row_count_other": (
        lambda d: X.row_count_equal_other_table(d, d),
        lambda d: X.row_count_equal_other_table(d, d, row_condition="idx > 1", other_row_condition="true"),
        1,
    ),
    "row_count_factor": (
        lambda d: X.row_count_equal_other_table_times_factor(d.union(d), d, 2),
        lambda d: X.row_count_equal_other_table_times_factor(d, d, 2),
        1,
    ),
    "aggregation_other": (
        lambda d: X.aggregation_equal_other_table(d, F.sum("idx"), d, F.sum("neg") / -2),
        lambda d: X.aggregation_equal_other_table(d, F.sum("idx"), d, F.max("idx"), by=["date_col"]),
        1,
    ),
    "decreasing": (
        lambda d: X.values_decreasing(d, "neg", "idx"),
        lambda d: X.values_decreasing(d, "a", "idx"),
        2,
    ),
    "decreasing_loose": (
        lambda d: X.values_decreasing(d, "a", "idx", strictly=False, row_condition="idx > 1"),
        lambda d: X.values_decreasing(d, "neg", "idx", step=3),
        3,
    ),
    "increasing": (
        lambda d: X.values_increasing(d, "idx", step=1),
        lambda d: X.values_increasing(d, "a", "idx"),
        2,
    ),
    "increasing_grouped": (
        lambda d: X.values_increasing(d, "idx", by=["date_col"]),
        lambda d: X.values_increasing(d, "neg", "idx", by=["date_col"]),
        1,
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_expectation(data, name):
    passing, failing, wanted = CASES[name]
    assert n(passing(data)) == 0
    assert n(failing(data)) == wanted


def test_monotonic_keeps_groups_and_spreads(data):
    out = X.values_increasing(data, "neg", "idx", by=["date_col"])
    assert out.columns == ["date_col", "sort_column", "value_field", "value_field_lag"]
    assert rows(out) == [(dt.date(2020, 10, 23), 4, -8, -6)]


def test_errors(data):
    with pytest.raises(ValueError):
        X.values_between(data, "idx")
    with pytest.raises(ValueError):
        X.pair_in_set(data, "a", "b", [(1, 2, 3)])
    with pytest.raises(ValueError):
        X.compound_unique(data, [])
    with pytest.raises(ValueError):
        X.keep_row("sometimes", ["a"])
    with pytest.raises(ValueError):
        X.match_like_list(data, "s", ["a"], "some")


def test_casing_shows_offenders(spark):
    df = spark.createDataFrame([("a",), ("A",), ("b",), (None,)], "s string")
    assert rows(X.consistent_casing(df, "s", display=True)) == [("a", 2)]


def test_equal_expression_by_group(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0), (None, 1.0)], "g int, v double")
    b = spark.createDataFrame([(1, 11.0), (3, 5.0), (None, 1.0)], "k int, v double")
    out = X.equal_expression(a, F.sum("v"), b, by=["g"], other_by=["k"])
    # groups without counterpart compare with zero, and NULL groups never meet
    assert rows(out.select("col_1", "expression_difference")) == [(1, 1.0), (2, 20.0), (3, 5.0), (None, 1.0), (None, 1.0)]
    assert n(X.equal_expression(a, F.sum("v"), b, by=["g"], other_by=["k"], tolerance=5)) == 1
    relative = X.equal_expression(a, F.sum("v"), b, by=["g"], other_by=["k"], tolerance_percent=0.09)
    assert rows(relative.select("col_1")) == [(1,), (2,), (None,)]


def test_within_n_stdevs(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(20)] + [(99, 50.0)], "g int, v double")
    assert [r.g for r in X.within_n_stdevs(df, "v", ["g"]).collect()] == [99]
    assert n(X.within_n_stdevs(df, "v", ["g"], 5)) == 0
    # one group only: nothing to deviate from
    assert n(X.within_n_stdevs(df, "v")) == 0


def test_moving_stdevs(spark):
    series = [(DAY + dt.timedelta(days=i), 100.0 + i % 3) for i in range(40)]
    series[35] = (series[35][0], 900.0)
    df = spark.createDataFrame([(d, v, g) for d, v in series for g in ("x", "y")], "d date, v double, g string")
    now = F.lit(DAY + dt.timedelta(days=40)).cast("timestamp")
    options = {"by": ["g"], "as_of": now, "take_diffs": False, "take_logs": False, "sigma": 6}
    hits = X.within_n_moving_stdevs(df, "v", "d", **options)
    assert {(r.g, r.metric_period.date()) for r in hits.collect()} == {
        ("x", DAY + dt.timedelta(days=35)),
        ("y", DAY + dt.timedelta(days=35)),
    }
    assert n(X.within_n_moving_stdevs(df, "v", "d", test_periods=4, **options)) == 0
    assert n(X.within_n_moving_stdevs(df, "v", "d", **{**options, "sigma_upper": 1e9})) == 0


def test_data_for_every_datepart(spark):
    days = [DAY + dt.timedelta(days=i) for i in (0, 1, 3, 6, 9)]
    df = spark.createDataFrame([(d, 1) for d in days], "d date, v int")
    missing = X.data_for_every_n_datepart(df, "d")
    assert [(r.date_day.date() - DAY).days for r in missing.orderBy("date_day").collect()] == [2, 4, 5, 7, 8]
    assert n(X.data_for_every_n_datepart(df, "d", interval=3)) == 0
    assert n(X.data_for_every_n_datepart(df, "d", interval=2)) == 1
    end = F.lit(DAY + dt.timedelta(days=12))
    assert n(X.data_for_every_n_datepart(df, "d", interval=3, start=F.lit(DAY), end=end)) == 0
    assert n(X.data_for_every_n_datepart(df, "d", exclusion_condition="dayofmonth(date_day) > 6")) == 2
    assert n(X.data_for_every_n_datepart(df, "d", row_condition="v = 0")) == 0


def test_recent_data(spark):
    df = spark.createDataFrame(
        [("x", dt.datetime(2024, 1, 9)), ("y", dt.datetime(2024, 1, 1)), ("x", dt.datetime(2030, 1, 1))],
        "g string, ts timestamp",
    )
    now = F.lit(dt.datetime(2024, 1, 10))
    assert n(X.has_recent_data(df, "ts", "day", 1, as_of=now)) == 0
    assert n(X.has_recent_data(df, "ts", "hour", 1, as_of=now)) == 1
    assert n(X.has_recent_data(df, "ts", "day", 1, "g = 'none'", now)) == 1
    assert [r.g for r in X.grouped_recent_data(df, ["g"], "ts", "day", 2, as_of=now).collect()] == ["y"]
    # a group without qualifying rows is noticed only when it is expected
    condition = "ts > timestamp'2024-01-05'"
    assert n(X.grouped_recent_data(df, ["g"], "ts", "day", 2, condition, now)) == 0
    assert [r.g for r in X.grouped_recent_data(df, ["g"], "ts", "day", 2, condition, now, df).collect()] == ["y"]
