"""Data expectations. Every function returns the failing rows; an empty result passes.

Shared options: ``row_condition`` filters the tested table, ``strictly`` opens the bounds,
``by`` tests each group separately.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmill.functions.dates import SUB_DAY, add_parts, parts_between, truncate
from cartmill.functions.scalars import regex_position
from cartmill.operators.core_checks import as_condition
from cartmill.operators.frequent import most_frequent
from cartmill.operators.ranking import exact_quantiles, with_halo, with_neighbour
from cartmill.operators.relational import date_spine

Condition = Column | str | None
# fixed values: names of the modes and rules callers give
LIST_MODES = ("any", "all")
MISSING_RULES = ("all_values_are_missing", "any_value_is_missing")


def _restrict(df: DataFrame, row_condition: Condition) -> DataFrame:
    return df if row_condition is None else df.filter(as_condition(row_condition))


# --- base forms -----------------------------------------------------------------------


def expression_is_true(
    df: DataFrame,
    expression: Column | str,
    condition: str = "= true",
    by: Sequence[str] = (),
    row_condition: Condition = None,
    aggregate: bool = False,
) -> DataFrame:
    """Rows (or, with an aggregate expression, groups) for which the expression is not met.

    A NULL outcome passes.
    """
    source = _restrict(df, row_condition)
    value = as_condition(expression).alias("expression")
    tested = source.groupBy(*by).agg(value) if by or aggregate else source.withColumn("expression", value)
    return tested.filter(F.expr(f"not(expression {condition})"))


def _within(c: Column, min_value, max_value, strictly: bool) -> Column:
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c > min_value) if strictly else (c >= min_value))
    if max_value is not None:
        ok = ok & ((c < max_value) if strictly else (c <= max_value))
    return ok


def expression_between(
    df: DataFrame,
    expression: Column | str,
    min_value=None,
    max_value=None,
    by: Sequence[str] = (),
    row_condition: Condition = None,
    strictly: bool = False,
    aggregate: bool = False,
) -> DataFrame:
    within = _within(as_condition(expression), min_value, max_value, strictly)
    return expression_is_true(df, within, by=by, row_condition=row_condition, aggregate=aggregate)


def aggregate_between(
    df: DataFrame,
    measure: Column,
    min_value=None,
    max_value=None,
    by: Sequence[str] = (),
    row_condition: Condition = None,
    strictly: bool = False,
) -> DataFrame:
    """Groups whose aggregate leaves the bounds, with the offending value."""
    measured = _restrict(df, row_condition).groupBy(*by).agg(measure.alias("measured"))
    return measured.filter(~_within(F.col("measured"), min_value, max_value, strictly))


def equal_expression(
    df: DataFrame,
    measure: Column,
    other: DataFrame | None = None,
    other_measure: Column | None = None,
    by: Sequence[str] = (),
    other_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    other_row_condition: Condition = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
) -> DataFrame:
    """Aggregates of two tables that differ by more than the tolerance, per group."""
    other = df if other is None else other
    other_measure = measure if other_measure is None else other_measure
    other_by = by if other_by is None else other_by
    if other_row_condition is None:
        other_row_condition = row_condition
    keys = [f"col_{i}" for i in range(1, len(by) + 1)]

    def grouped(frame: DataFrame, condition: Condition, cols: Sequence[str], value: Column, name: str, tag: str):
        named = [F.col(c).alias(f"{tag}_{k}") for c, k in zip(cols, keys, strict=True)]
        return _restrict(frame, condition).groupBy(*named).agg(value.alias(name))

    a = grouped(df, row_condition, by, measure, "expression", "a")
    b = grouped(other, other_row_condition, other_by, other_measure, "compare_expression", "b")
    if by:
        on = reduce(lambda x, y: x & y, [F.col(f"a_{k}") == F.col(f"b_{k}") for k in keys])
        paired = a.join(b, on, "full")
    else:
        paired = a.crossJoin(b)
    zero = F.lit(0)
    difference = F.abs(F.coalesce("expression", zero) - F.coalesce("compare_expression", zero))
    out = paired.select(
        *[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys],
        "expression",
        "compare_expression",
        difference.alias("expression_difference"),
        F.try_divide(difference, F.col("expression") * F.lit(1.0)).alias("expression_difference_percent"),
    )
    if tolerance_percent:
        return out.filter(F.col("expression_difference_percent") > tolerance_percent)
    return out.filter(F.col("expression_difference") > tolerance)


def keep_row(rule: str, columns: Sequence[str]) -> Column:
    """Predicate keeping rows unless all (or any) of the columns are NULL."""
    if rule not in MISSING_RULES:
        raise ValueError(f"ignore_row_if must be one of {MISSING_RULES}, got {rule!r}")
    missing = [F.col(c).isNull() for c in columns]
    join = (lambda a, b: a & b) if rule == MISSING_RULES[0] else (lambda a, b: a | b)
    return ~reduce(join, missing)


# --- column values --------------------------------------------------------------------


def values_between(df, column, min_value=None, max_value=None, strictly=False, row_condition=None) -> DataFrame:
    return expression_between(df, F.col(column), min_value, max_value, (), row_condition, strictly)


def _monotonic(df, column, sort_column, strictly, row_condition, by, step, increasing) -> DataFrame:
    sort = sort_column or column
    rows = _restrict(df, row_condition).select(
        *by, F.col(sort).alias("sort_column"), F.col(column).alias("value_field")
    )
    rows = with_neighbour(
        rows, "value_field", [F.col("sort_column").asc(), F.col("value_field").asc()], by, name="value_field_lag"
    )
    now, before = F.col("value_field"), F.col("value_field_lag")
    rise = (now - before) if increasing else (before - now)
    if increasing:
        ok = (now > before) if strictly else (now >= before)
    else:
        ok = (now < before) if strictly else (now <= before)
    if step is not None:
        ok = ok & (rise == step)
    return rows.filter(before.isNotNull() & ~ok)


def values_increasing(
    df, column, sort_column=None, strictly=True, row_condition=None, by: Sequence[str] = (), step=None
) -> DataFrame:
    """Rows that do not rise over the previous one in sort order."""
    return _monotonic(df, column, sort_column, strictly, row_condition, by, step, True)


def values_decreasing(
    df, column, sort_column=None, strictly=True, row_condition=None, by: Sequence[str] = (), step=None
) -> DataFrame:
    return _monotonic(df, column, sort_column, strictly, row_condition, by, step, False)


def values_in_set(df, column, values: Sequence, row_condition=None) -> DataFrame:
    """NULL fails."""
    c = F.col(column)
    return _restrict(df, row_condition).filter(c.isNull() | ~c.isin(*values))


def values_not_in_set(df, column, values: Sequence, row_condition=None) -> DataFrame:
    """NULL passes."""
    return _restrict(df, row_condition).filter(F.col(column).isin(*values))


def _names(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def column_in_type_list(df: DataFrame, column: str, types: Sequence[str]) -> DataFrame:
    """One row when the column's type is not in the list; type names as Spark prints them."""
    wanted = {t.upper() for t in types}
    bad = [
        (f.name.upper(), f.dataType.simpleString().upper())
        for f in df.schema.fields
        if f.name.upper() == column.upper() and f.dataType.simpleString().upper() not in wanted
    ]
    return _names(df, bad, "relation_column string, relation_column_type string")


def column_of_type(df: DataFrame, column: str, type_: str) -> DataFrame:
    return column_in_type_list(df, column, [type_])


def values_null(df, column, row_condition=None) -> DataFrame:
    return _restrict(df, row_condition).filter(F.col(column).isNotNull())


def values_not_null(df, column, row_condition=None) -> DataFrame:
    return _restrict(df, row_condition).filter(F.col(column).isNull())


def values_unique(df, column, row_condition=None) -> DataFrame:
    return compound_unique(df, [column], row_condition=row_condition)


def consistent_casing(df: DataFrame, column: str, display: bool = False) -> DataFrame:
    """Spellings that differ only by case: the offenders, or one summary row."""
    distinct = df.select(F.col(column).alias("value")).distinct()
    folded = distinct.groupBy(F.lower("value").alias("inconsistent_columns")).agg(
        F.count("value").alias("set_count_case_insensitive"), F.count("*").alias("_spellings")
    )
    if display:
        return folded.filter("set_count_case_insensitive > 1").drop("_spellings")
    summary = folded.agg(
        F.coalesce(F.sum("_spellings"), F.lit(0)).alias("set_count"),
        F.count("inconsistent_columns").alias("set_count_case_insensitive"),
    )
    return summary.filter("set_count != set_count_case_insensitive")


# --- aggregates -----------------------------------------------------------------------


def distinct_count_equal(df, column, value, by: Sequence[str] = (), row_condition=None) -> DataFrame:
    return aggregate_between(df, F.count_distinct(column), value, value, by, row_condition)


def distinct_count_greater_than(df, column, value, by: Sequence[str] = (), row_condition=None) -> DataFrame:
    return aggregate_between(df, F.count_distinct(column), value, None, by, row_condition, strictly=True)


def distinct_count_less_than(df, column, value, by: Sequence[str] = (), row_condition=None) -> DataFrame:
    return aggregate_between(df, F.count_distinct(column), None, value, by, row_condition, strictly=True)


def distinct_count_equal_other_table(
    df, column, other, other_column, row_condition=None, other_row_condition=None
) -> DataFrame:
    return equal_expression(
        df, F.count_distinct(column), other, F.count_distinct(other_column),
        row_condition=row_condition, other_row_condition=other_row_condition,
    )


def _distinct(df, column, row_condition) -> DataFrame:
    return _restrict(df, row_condition).select(F.col(column).alias("value_field")).distinct()


def _set_frame(df: DataFrame, column: str, values: Sequence, name: str) -> DataFrame:
    kind = df.schema[column].dataType.simpleString()
    literals = F.array(*[F.lit(v).cast(kind) for v in values])
    return df.sparkSession.range(1).select(F.explode(F.array_distinct(literals)).alias(name))


def distinct_values_in_set(df, column, values: Sequence, row_condition=None) -> DataFrame:
    """Distinct values outside the set; NULL fails."""
    c = F.col("value_field")
    return _distinct(df, column, row_condition).filter(c.isNull() | ~c.isin(*values))


def distinct_values_contain_set(df, column, values: Sequence, row_condition=None) -> DataFrame:
    """Members of the set the column never takes."""
    wanted = _set_frame(df, column, values, "value_field")
    present = _restrict(df, row_condition).filter(F.col(column).isin(*values))
    present = present.select(F.col(column).alias("value_field")).distinct()
    return wanted.join(present, "value_field", "left_anti")


def distinct_values_equal_set(df, column, values: Sequence, row_condition=None) -> DataFrame:
    """Values and members without a counterpart on the other side."""
    have = _distinct(df, column, row_condition).withColumnRenamed("value_field", "column_value")
    want = _set_frame(df, column, values, "value_field")
    joined = have.join(want, F.col("column_value") == F.col("value_field"), "full")
    return joined.filter(F.col("column_value").isNull() | F.col("value_field").isNull())


def max_between(df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False) -> DataFrame:
    return aggregate_between(df, F.max(column), min_value, max_value, by, row_condition, strictly)


def min_between(df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False) -> DataFrame:
    return aggregate_between(df, F.min(column), min_value, max_value, by, row_condition, strictly)


def mean_between(df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False) -> DataFrame:
    return aggregate_between(df, F.avg(column), min_value, max_value, by, row_condition, strictly)


def sum_between(df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False) -> DataFrame:
    return aggregate_between(df, F.sum(column), min_value, max_value, by, row_condition, strictly)


def stdev_between(df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False) -> DataFrame:
    """Sample standard deviation."""
    return aggregate_between(df, F.stddev(column), min_value, max_value, by, row_condition, strictly)


def quantile_between(
    df, column, quantile: float, min_value=None, max_value=None, by: Sequence[str] = (),
    row_condition=None, strictly=False,
) -> DataFrame:
    """Interpolated quantile of any number of distinct values."""
    found = exact_quantiles(_restrict(df, row_condition), column, [quantile], by)
    found = found.withColumnRenamed("q0", "measured")
    return found.filter(~_within(F.col("measured"), min_value, max_value, strictly))


def median_between(df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False) -> DataFrame:
    return quantile_between(df, column, 0.5, min_value, max_value, by, row_condition, strictly)


def most_common_value_in_set(df, column, values: Sequence, top_n: int, row_condition=None) -> DataFrame:
    """The value at frequency rank ``top_n`` when it is not in the set (ties by value)."""
    order = [F.desc("n_rows"), F.asc("value_field")]
    leaders = most_frequent(_restrict(df, row_condition), F.col(column), df.schema[column].dataType, top_n)
    # at most top_n rows reach this window
    ranked = leaders.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.filter((F.col("_rank") == top_n) & ~F.col("value_field").isin(*values)).select("value_field")


def proportion_of_unique_values_between(
    df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False
) -> DataFrame:
    share = F.coalesce(F.try_divide(F.count_distinct(column), F.count(column)), F.lit(1.0))
    return aggregate_between(df, share, min_value, max_value, by, row_condition, strictly)


def unique_value_count_between(
    df, column, min_value=None, max_value=None, by=(), row_condition=None, strictly=False
) -> DataFrame:
    return aggregate_between(df, F.count_distinct(column), min_value, max_value, by, row_condition, strictly)


# --- distributions --------------------------------------------------------------------


def within_n_stdevs(df: DataFrame, column: str, by: Sequence[str] = (), sigma: float = 3) -> DataFrame:
    """Groups whose sum lies more than ``sigma`` deviations from the mean over all groups."""
    sums = df.groupBy(*by).agg(F.sum(column).alias("group_sum"))
    stats = sums.agg(F.avg("group_sum").alias("sum_average"), F.stddev("group_sum").alias("sum_stddev"))
    scored = sums.crossJoin(F.broadcast(stats)).withColumn(
        "sum_sigma", F.try_divide(F.col("group_sum") - F.col("sum_average"), F.col("sum_stddev"))
    )
    return scored.filter(F.abs("sum_sigma") > sigma)


def moving_sigma(
    df: DataFrame,
    column: str,
    date_column: str,
    by: Sequence[str] = (),
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    take_diffs: bool = True,
    take_logs: bool = True,
    halo_chunk: int = 1 << 16,
) -> DataFrame:
    """Deviation of each period from the preceding trend, in rolling standard deviations."""
    sums = df.groupBy(truncate(period, date_column).alias("metric_period"), *by).agg(
        F.sum(column).alias("agg_metric_value")
    )

    def metric(c: Column) -> Column:
        value = F.ln(F.nullif(c, F.lit(0))) if take_logs else c
        return F.coalesce(value, F.lit(0))

    # windows over one row per period and group: of days and longer periods a calendar holds few, others are sliced
    sliced = period.lower() in SUB_DAY
    if sliced:
        sums = with_halo(sums, [F.col("metric_period").asc()], by, trend_periods + lookback_periods, halo_chunk)
    along = Window.partitionBy(*by, *(["_slice"] if sliced else [])).orderBy("metric_period")
    tested = metric(F.col("agg_metric_value"))
    if take_diffs:
        sums = sums.withColumn("prior_agg_metric_value", F.lag("agg_metric_value", lookback_periods).over(along))
        tested = tested - metric(F.col("prior_agg_metric_value"))
    trend = along.rowsBetween(-trend_periods, -1)
    moved = sums.withColumn("metric_test_value", tested)
    moved = moved.withColumn("metric_test_rolling_average", F.avg("metric_test_value").over(trend))
    moved = moved.withColumn("metric_test_rolling_stddev", F.stddev("metric_test_value").over(trend))
    if sliced:
        moved = moved.filter("_own").drop("_slice", "_own")
    delta = F.col("metric_test_value") - F.col("metric_test_rolling_average")
    return moved.withColumn("metric_test_delta", delta).withColumn(
        "metric_test_sigma", F.try_divide(F.col("metric_test_delta"), F.col("metric_test_rolling_stddev"))
    )


def within_n_moving_stdevs(
    df: DataFrame,
    column: str,
    date_column: str,
    by: Sequence[str] = (),
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma: float = 3,
    sigma_upper: float | None = None,
    sigma_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
    as_of: Column | None = None,
) -> DataFrame:
    """Periods of the test window (the last ``test_periods`` before ``as_of``) off the trend."""
    upper = sigma_upper if sigma_upper else sigma
    lower = sigma_lower if sigma_lower else -sigma
    scored = moving_sigma(
        df, column, date_column, by, period, lookback_periods, trend_periods, take_diffs, take_logs
    )
    end = truncate(period, F.current_timestamp() if as_of is None else as_of)
    p, s = F.col("metric_period"), F.col("metric_test_sigma")
    tested = scored.filter((p >= add_parts(period, -test_periods, end)) & (p < end))
    return tested.filter(~((s >= lower) & (s <= upper)))


def data_for_every_n_datepart(
    df: DataFrame,
    date_column: str,
    part: str = "day",
    interval: int | None = None,
    row_condition: Condition = None,
    exclusion_condition: Condition = None,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Parts (or every n-th part from the start) without rows; the end itself is not tested."""
    name = f"date_{part}"
    rows = _restrict(df, row_condition)
    day = F.to_date(date_column)
    if start is None or end is None:
        limits = rows.agg(F.min(day).alias("_min"), F.max(day).alias("_max"))
    else:
        limits = df.sparkSession.range(1)
    limits = limits.select(
        (F.col("_min") if start is None else start).cast("timestamp").alias("start"),
        (F.col("_max") if end is None else end).cast("timestamp").alias("end"),
    )
    origin = limits.select(F.col("start").alias("_origin"))
    spine = date_spine(limits, part, name).select(F.col(name).cast("timestamp").alias(name))
    bucket = truncate(part, date_column)
    if interval:
        away = parts_between("_origin", name, part)
        spine = spine.crossJoin(origin).filter(away % interval == 0).drop("_origin")
        offset = parts_between("_origin", F.col(date_column), part) % interval
        bucket = add_parts(part, -offset, bucket)
        rows = rows.crossJoin(F.broadcast(origin))  # one row
    counted = rows.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    joined = spine.join(counted, F.col(name) == F.col("_bucket"), "left")
    out = joined.select(
        name, F.col("_bucket").isNull().alias("is_missing"), F.coalesce("_rows", F.lit(0)).alias("row_cnt")
    ).filter("row_cnt = 0")
    return out if exclusion_condition is None else out.filter(as_condition(exclusion_condition))


# --- several columns ------------------------------------------------------------------


def pair_a_greater_than_b(df, column_a, column_b, or_equal=False, row_condition=None) -> DataFrame:
    a, b = F.col(column_a), F.col(column_b)
    return expression_is_true(df, (a >= b) if or_equal else (a > b), row_condition=row_condition)


def pair_equal(df, column_a, column_b, row_condition=None) -> DataFrame:
    return expression_is_true(df, F.col(column_a) == F.col(column_b), row_condition=row_condition)


def pair_in_set(df, column_a, column_b, pairs: Sequence[Sequence], row_condition=None) -> DataFrame:
    if any(len(p) != 2 for p in pairs):
        raise ValueError("every element of the set must be a pair")
    matches = [(F.col(column_a) == a) & (F.col(column_b) == b) for a, b in pairs]
    return expression_is_true(df, reduce(lambda x, y: x | y, matches), row_condition=row_condition)


def compound_unique(
    df: DataFrame,
    columns: Sequence[str],
    ignore_row_if: str = MISSING_RULES[0],
    row_condition: Condition = None,
) -> DataFrame:
    if not columns:
        raise ValueError("columns must not be empty")
    rows = _restrict(df, row_condition).filter(keep_row(ignore_row_if, columns))
    return rows.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def multicolumn_sum_equal(
    df, columns: Sequence[str], total: float | str, by: Sequence[str] = (), row_condition=None
) -> DataFrame:
    """Groups where the column sums do not add up to a number or to another column's sum."""
    added = reduce(lambda a, b: a + b, [F.sum(c) for c in columns])
    target = F.sum(total) if isinstance(total, str) else F.lit(total)
    return expression_is_true(df, added == target, by=by, row_condition=row_condition, aggregate=True)


def unique_within_record(
    df: DataFrame,
    columns: Sequence[str],
    ignore_row_if: str = MISSING_RULES[0],
    row_condition: Condition = None,
) -> DataFrame:
    """Rows repeating a value across the columns; a missing value counts as a repeat."""
    texts = F.array(*[F.col(c).cast("string") for c in columns])
    different = F.size(F.array_distinct(F.array_compact(texts)))
    rows = _restrict(df, row_condition).filter(keep_row(ignore_row_if, columns))
    return rows.withColumn("column_values", different).filter(F.col("column_values") < len(columns))


# --- text -----------------------------------------------------------------------------


def value_lengths_between(df, column, min_value=None, max_value=None, strictly=False, row_condition=None) -> DataFrame:
    return expression_between(df, F.length(column), min_value, max_value, (), row_condition, strictly)


def value_lengths_equal(df, column, value: int, row_condition=None) -> DataFrame:
    return expression_is_true(df, F.length(column) == value, row_condition=row_condition)


def _combine(conditions: Sequence[Column], match_on: str) -> Column:
    if match_on not in LIST_MODES:
        raise ValueError(f"match_on must be one of {LIST_MODES}, got {match_on!r}")
    join: Callable = (lambda a, b: a & b) if match_on == "all" else (lambda a, b: a | b)
    return reduce(join, conditions)


def match_like(df, column, pattern: str, row_condition=None) -> DataFrame:
    return match_like_list(df, column, [pattern], row_condition=row_condition)


def not_match_like(df, column, pattern: str, row_condition=None) -> DataFrame:
    return not_match_like_list(df, column, [pattern], row_condition=row_condition)


def match_like_list(df, column, patterns: Sequence[str], match_on="any", row_condition=None) -> DataFrame:
    found = _combine([F.col(column).like(p) for p in patterns], match_on)
    return expression_is_true(df, found, row_condition=row_condition)


def not_match_like_list(df, column, patterns: Sequence[str], match_on="any", row_condition=None) -> DataFrame:
    absent = _combine([~F.col(column).like(p) for p in patterns], match_on)
    return expression_is_true(df, absent, row_condition=row_condition)


def match_regex(df, column, pattern: str, flags: str = "", row_condition=None) -> DataFrame:
    return match_regex_list(df, column, [pattern], flags=flags, row_condition=row_condition)


def not_match_regex(df, column, pattern: str, flags: str = "", row_condition=None) -> DataFrame:
    return not_match_regex_list(df, column, [pattern], flags=flags, row_condition=row_condition)


def match_regex_list(
    df, column, patterns: Sequence[str], match_on="any", flags: str = "", row_condition=None
) -> DataFrame:
    found = _combine([regex_position(column, p, flags=flags) > 0 for p in patterns], match_on)
    return expression_is_true(df, found, row_condition=row_condition)


def not_match_regex_list(
    df, column, patterns: Sequence[str], match_on="any", flags: str = "", row_condition=None
) -> DataFrame:
    absent = _combine([regex_position(column, p, flags=flags) == 0 for p in patterns], match_on)
    return expression_is_true(df, absent, row_condition=row_condition)


# --- table shape ----------------------------------------------------------------------


def column_exists(df: DataFrame, column: str, index: int | None = None) -> DataFrame:
    """One row when the column is missing or not at the 1-based position."""
    names = [c.upper() for c in df.columns]
    place = names.index(column.upper()) if column.upper() in names else -1
    in_place = index is None or place == max(index - 1, 0)
    bad = [] if place >= 0 and in_place else [(column.upper(), place, in_place)]
    return _names(df, bad, "column_name string, matching_column_index int, column_index_matches boolean")


def has_recent_data(
    df: DataFrame, column: str, part: str, interval: int, row_condition=None, as_of: Column | None = None
) -> DataFrame:
    """One row when the latest non-future value is too old, or there is none."""
    moment = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    past = _restrict(df, row_condition).filter(F.col(column).cast("timestamp") <= moment)
    latest = past.agg(F.max(F.col(column).cast("timestamp")).alias("max_timestamp"))
    fallback = F.lit("1970-01-01").cast("timestamp")
    return latest.filter(F.coalesce("max_timestamp", fallback) < add_parts(part, -interval, moment))


def grouped_recent_data(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    part: str,
    interval: int,
    row_condition=None,
    as_of: Column | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Groups whose latest non-future value is too old.

    A group without any qualifying row is only noticed when listed in ``expected``.
    """
    moment = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    past = _restrict(df, row_condition).filter(F.col(column).cast("timestamp") <= moment)
    latest = past.groupBy(*by).agg(F.max(F.col(column).cast("timestamp")).alias("latest_timestamp"))
    stale = F.col("latest_timestamp") < add_parts(part, -interval, moment)
    if expected is None:
        return latest.filter(stale)
    groups = expected.select(*[F.col(c).alias(f"_e_{c}") for c in by]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(f"_e_{c}").eqNullSafe(F.col(c)) for c in by])
    joined = groups.join(latest, on, "left").filter(F.col("latest_timestamp").isNull() | stale)
    return joined.select(*[F.col(f"_e_{c}").alias(c) for c in by], "latest_timestamp")


def aggregation_equal_other_table(df, measure: Column, other, other_measure: Column | None = None, **options):
    return equal_expression(df, measure, other, other_measure, **options)


def column_count_between(df: DataFrame, min_value: int | None = None, max_value: int | None = None) -> DataFrame:
    """A bound of 0 is a bound; only None is missing."""
    n = len(df.columns)
    low = min_value is not None and n < min_value
    high = max_value is not None and n > max_value
    return _names(df, [(n,)] if low or high else [], "number_columns int")


def column_count_equal(df: DataFrame, value: int) -> DataFrame:
    return column_count_between(df, value, value)


def column_count_equal_other_table(df: DataFrame, other: DataFrame) -> DataFrame:
    a, b = len(df.columns), len(other.columns)
    return _names(df, [] if a == b else [(a, b)], "number_columns int, compare_number_columns int")


def columns_contain_set(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Wanted columns the table lacks."""
    have = {c.upper() for c in df.columns}
    return _names(df, [(c.upper(),) for c in columns if c.upper() not in have], "column_name string")


def columns_not_contain_set(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unwanted columns the table has."""
    have = {c.upper() for c in df.columns}
    return _names(df, [(c.upper(),) for c in columns if c.upper() in have], "column_name string")


def columns_match_set(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    have, want = [c.upper() for c in df.columns], [c.upper() for c in columns]
    bad = [(c, None) for c in have if c not in want] + [(None, c) for c in want if c not in have]
    return _names(df, bad, "relation_column string, input_column string")


def columns_match_ordered_list(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    have, want = [c.upper() for c in df.columns], [c.upper() for c in columns]
    bad = []
    for i in range(max(len(have), len(want))):
        h = have[i] if i < len(have) else None
        w = want[i] if i < len(want) else None
        if h == w:
            continue
        if h is not None:
            bad.append((i + 1, h, None, None))
        if w is not None:
            bad.append((None, None, i + 1, w))
    schema = "relation_column_idx int, relation_column string, input_column_idx int, input_column string"
    return _names(df, bad, schema)


def row_count_between(
    df, min_value=None, max_value=None, by: Sequence[str] = (), row_condition=None, strictly=False
) -> DataFrame:
    return aggregate_between(df, F.count("*"), min_value, max_value, by, row_condition, strictly)


def row_count_equal(df, value: int, by: Sequence[str] = (), row_condition=None) -> DataFrame:
    return row_count_between(df, value, value, by, row_condition)


def row_count_equal_other_table(df, other, factor: float = 1, **options) -> DataFrame:
    n = F.count("*")
    return equal_expression(df, n, other, n * factor, **options)


def row_count_equal_other_table_times_factor(df, other, factor: float, **options) -> DataFrame:
    return row_count_equal_other_table(df, other, factor, **options)
