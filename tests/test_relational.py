"""Relational helpers on seed tables, and the calendar built on them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartmill.operators import calendar as cal
from cartmill.operators import relational as rel
from conftest import rows


def spine(spark, part, start, end):
    out = rel.date_spine(rel.bounds(spark, start, end), part, "d")
    return [r.d for r in out.orderBy("d").collect()]


def test_spine_excludes_the_end(spark):
    days = spine(spark, "day", "2018-01-01", "2018-01-10")
    assert (len(days), days[0], days[-1]) == (9, dt.date(2018, 1, 1), dt.date(2018, 1, 9))
    assert len(spine(spark, "day", "2016-01-01", "2018-12-31")) == 1095
    assert spine(spark, "month", "2018-01-15", "2018-04-01") == [
        dt.date(2018, 1, 15), dt.date(2018, 2, 15), dt.date(2018, 3, 15),
    ]
    assert len(spine(spark, "hour", "2018-01-01", "2018-01-02 06:00:00")) == 30
    assert len(spine(spark, "week", "2018-01-01", "2018-02-01")) == 4
    assert spine(spark, "day", "2018-01-02", "2018-01-02") == []
    assert spine(spark, "day", "2018-01-03", "2018-01-01") == []


def test_long_series(spark):
    """Seconds over ten years: more than one chunk, in many tasks."""
    spine = rel.date_spine(rel.bounds(spark, "2010-01-01", "2010-01-03"), "second", "t")
    assert (spine.count(), spine.distinct().count()) == (172_800, 172_800)
    long = rel.date_spine(rel.bounds(spark, "2010-01-01", "2020-01-01"), "second", "t")
    first, last, n = long.agg(F.min("t"), F.max("t"), F.count("*")).first()
    assert (str(first), str(last), n) == ("2010-01-01 00:00:00", "2019-12-31 23:59:59", 3652 * 86_400)


def test_numbers_up_to(spark):
    limits = spark.createDataFrame([(3,)], "n long")
    assert [r[0] for r in rel.numbers_up_to(limits, "n").orderBy("generated_number").collect()] == [1, 2, 3]
    assert rel.numbers_up_to(spark.createDataFrame([(0,)], "n long"), "n").count() == 0


def test_series(spark):
    assert [r.generated_number for r in rel.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        rel.generate_series(spark, 0)


def test_deduplicate(spark):
    df = spark.createDataFrame(
        [(1, "play", 1), (1, "play", 2), (2, "play", 1), (3, None, 5), (3, None, 4)], "user_id int, event string, version int"
    )
    first = rel.deduplicate(df, ["user_id"], [F.col("version").desc()])
    assert rows(first) == [(1, "play", 2), (2, "play", 1), (3, None, 5)]


def test_keep_latest_treats_null_as_oldest(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "2020", "b"), (1, "2020", "c")], "k int, ts string, t string")
    assert rows(rel.keep_latest(df, ["k"], "ts", ["t"])) == [(1, "2020", "c")]


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    out = df.groupBy("size").agg(*rel.pivot_columns("color", ["red", "blue", "blue's"]))
    assert out.columns == ["size", "red", "blue", "blue's"]
    assert rows(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    named = rel.pivot_columns("color", ["red"], prefix="N ", suffix="-x", slug_names=True, cmp="<>")
    assert df.groupBy("size").agg(*named).columns == ["size", "n_red_x"]


def test_unpivot(spark):
    df = spark.createDataFrame(
        [(123, "2017-01-01", "active", True), (234, "2017-02-01", None, False)],
        "customer_id int, created_at string, status string, is_updated boolean",
    )
    out = rel.unpivot(df, keep=["customer_id"], remove=["created_at"], field_name="prop", value_name="val")
    assert rows(out) == [
        (123, "is_updated", "true"),
        (123, "status", "active"),
        (234, "is_updated", "false"),
        (234, "status", None),
    ]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "drew", None)], "id int, name string, favorite_number int")
    b = spark.createDataFrame([(4, "blue", 7)], "id int, favorite_color string, favorite_number int")
    out = rel.union_relations({"a": a, "b": b})
    assert out.columns == ["source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert rows(out) == [("a", 1, "drew", None, None), ("b", 4, None, 7, "blue")]
    assert rel.union_relations({"a": a, "b": b}, include=["ID"], source_column=None).columns == ["id"]
    assert rel.union_relations({"a": a, "b": b}, where="id > 1").count() == 1
    assert dict(rel.union_relations({"a": a}, column_override={"id": "string"}).dtypes)["id"] == "string"
    with pytest.raises(ValueError):
        rel.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        rel.union_relations({"a": a}, exclude=["id", "name", "favorite_number"])


def test_select_except_and_null_check(spark):
    df = spark.createDataFrame([("a", "", 1)], "field_1 string, field_2 string, field_3 int")
    assert rel.select_except(df, ["FIELD_3"], prefix="p_").columns == ["p_field_1", "p_field_2"]
    assert rows(rel.null_check_table(df)) == [("a", None, 1)]


def test_column_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "field string")
    assert [r.value for r in rel.column_values(df, "field").collect()][:3] == ["b", None, "a"]
    assert [r.value for r in rel.column_values(df, "field", "field <> 'b'", 1).collect()] == ["a"]


def test_tables_by_pattern(spark):
    for day in ("20180101", "20180102"):
        spark.createDataFrame([(1, day)], "user_id int, event string").createOrReplaceTempView(f"seed_events_{day}")
    spark.range(1).createOrReplaceTempView("seedXevents_1")
    assert rel.tables_like(spark, "SEED_events_2018%", exclude="%02") == ["seed_events_20180101"]
    found = rel.tables_with_prefix(spark, "seed_")
    assert found == ["seed_events_20180101", "seed_events_20180102"]
    assert rel.union_tables(spark, found).count() == 2


def test_joins(spark):
    orders = spark.createDataFrame([(1,), (2,), (None,)], "o int")
    lines = spark.createDataFrame([(1, 1), (1, 2)], "o int, seq int")
    assert rows(rel.left_join_where(orders, lines, "o", F.col("seq") == 1)) == [(1, 1), (2, None), (None, None)]
    assert rows(rel.rows_without_parent(orders, lines, "o", "o")) == [(2,)]
    assert rows(rel.rows_with_parent(orders, lines, "o", "o")) == [(1,)]
    assert rows(rel.compare_scalars(orders.agg(F.count("*")), lines.agg(F.count("*")))) == [(3, 2)]


# --- calendar -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def dimension(spark):
    return cal.date_dimension(rel.bounds(spark, "2015-01-01", "2022-12-31")).cache()


def test_dimension_shape(dimension):
    assert dimension.count() == 2921
    leap = dimension.filter("date_day = date'2020-02-29'").first()
    assert leap.prior_year_date_day == dt.date(2019, 2, 28)
    assert leap.prior_year_over_year_date_day == dt.date(2019, 3, 2)
    assert (leap.quarter_end_date, leap.year_end_date) == (dt.date(2020, 3, 31), dt.date(2020, 12, 31))
    assert leap.month_end_date == dt.date(2020, 2, 29)


def test_trailing_dates_include_today(spark):
    as_of = spark.range(1).select(F.lit(dt.date(2021, 3, 5)).alias("as_of"))
    days = [r.date_day.date() for r in cal.trailing_dates(as_of, 3).orderBy("date_day").collect()]
    assert days == [dt.date(2021, 3, d) for d in (2, 3, 4, 5)]


def test_fiscal_years_end_on_the_saturday_closest_to_january(dimension):
    years = {
        r.fiscal_year_number: (r.s, r.e, r.w, r.d)
        for r in cal.fiscal_year_dates(dimension, 1, 1, 1)
        .groupBy("fiscal_year_number")
        .agg(
            F.min("date_day").alias("s"),
            F.max("date_day").alias("e"),
            F.max("fiscal_week_of_year").alias("w"),
            F.count("*").alias("d"),
        )
        .collect()
    }
    assert years[2016] == (dt.date(2016, 1, 31), dt.date(2017, 1, 28), 52, 364)
    # the last week of this year is its 53rd
    assert years[2017] == (dt.date(2017, 1, 29), dt.date(2018, 2, 3), 53, 371)
    assert years[2018] == (dt.date(2018, 2, 4), dt.date(2019, 2, 2), 52, 364)
    assert 2014 not in years


def test_fiscal_periods_follow_454(dimension):
    periods = cal.fiscal_periods(dimension, 1, 1, 1)
    weeks = periods.filter("fiscal_year_number = 2017").select(
        "fiscal_week_of_year", "fiscal_period_number", "fiscal_quarter_number", "fiscal_week_of_period"
    ).distinct()
    by_week = {r.fiscal_week_of_year: tuple(r)[1:] for r in weeks.collect()}
    assert len(by_week) == 53
    lengths = [sum(1 for v in by_week.values() if v[0] == p) for p in range(1, 13)]
    assert lengths == [4, 5, 4, 4, 5, 4, 4, 5, 4, 4, 5, 5]
    assert by_week[1] == (1, 1, 1) and by_week[5] == (2, 1, 1) and by_week[14] == (4, 2, 1)
    assert by_week[53] == (12, 4, 5)


def test_calendar_with_fiscal_keeps_every_day(dimension):
    full = cal.calendar_with_fiscal(dimension, year_end_month=1)
    assert full.count() == dimension.count()
    assert full.filter("fiscal_year_number IS NULL").count() > 0
