"""Calendar and fiscal-year dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmill.functions import dates as D
from cartmill.operators.relational import date_spine, join_week_range

WEEKS_PER_QUARTER = 13


def base_dates(limits: DataFrame, part: str = "day") -> DataFrame:
    """Spine of timestamps from start up to but excluding end."""
    name = f"date_{part}"
    return date_spine(limits, part, name).select(F.col(name).cast("timestamp").alias(name))


def trailing_dates(limits: DataFrame, n: int, part: str = "day") -> DataFrame:
    """Spine over the ``n`` parts before the day ``as_of`` of ``limits`` up to and including it."""
    today = F.to_date("as_of")
    span = limits.select(
        D.add_parts(part, -n, today).alias("start"), F.date_add(today, 1).cast("timestamp").alias("end")
    )
    return base_dates(span, part)


def _last_day(part: str, c: Column) -> Column:
    if part == "month":
        return F.last_day(c)
    months = 3 if part == "quarter" else 12
    return F.date_sub(F.add_months(F.trunc(c, part), months), 1)


def date_dimension(limits: DataFrame, week_mode: str = "sunday") -> DataFrame:
    """One row per day with its calendar attributes and prior-year counterparts."""
    d, py, pyoy = F.col("date_day"), F.col("prior_year_date_day"), F.col("prior_year_over_year_date_day")
    days = base_dates(limits, "day").select(F.to_date("date_day").alias("date_day"))
    days = days.select(
        d, F.add_months(d, -12).alias("prior_year_date_day"), F.date_sub(d, 364).alias("prior_year_over_year_date_day")
    )
    # fixed values: the attribute names are the output contract
    attributes: dict[str, Column] = {
        "date_day": d,
        "prior_date_day": F.date_sub(d, 1),
        "next_date_day": F.date_add(d, 1),
        "prior_year_date_day": py,
        "prior_year_over_year_date_day": pyoy,
        "day_of_week": D.day_of_week(d, iso=False),
        "day_of_week_iso": D.day_of_week(d, iso=True),
        "day_of_week_name": D.day_name(d, short=False),
        "day_of_week_name_short": D.day_name(d, short=True),
        "day_of_month": D.day_of_month(d),
        "day_of_year": D.day_of_year(d),
        "week_start_date": D.week_start(d),
        "week_end_date": D.week_end(d),
        "prior_year_week_start_date": D.week_start(pyoy),
        "prior_year_week_end_date": D.week_end(pyoy),
        "week_of_year": D.week_of_year(d, week_mode),
        "iso_week_start_date": D.iso_week_start(d),
        "iso_week_end_date": D.iso_week_end(d),
        "prior_year_iso_week_start_date": D.iso_week_start(pyoy),
        "prior_year_iso_week_end_date": D.iso_week_end(pyoy),
        "iso_week_of_year": D.iso_week_of_year(d),
        "iso_year_week": D.iso_year_week(d),
        "prior_year_week_of_year": D.week_of_year(pyoy, week_mode),
        "prior_year_iso_week_of_year": D.iso_week_of_year(pyoy),
        "month_of_year": F.month(d),
        "month_name": D.month_name(d, short=False),
        "month_name_short": D.month_name(d, short=True),
        "month_start_date": F.trunc(d, "month"),
        "month_end_date": _last_day("month", d),
        "prior_year_month_start_date": F.trunc(py, "month"),
        "prior_year_month_end_date": _last_day("month", py),
        "quarter_of_year": F.quarter(d),
        "quarter_start_date": F.trunc(d, "quarter"),
        "quarter_end_date": _last_day("quarter", d),
        "year_number": F.year(d),
        "year_start_date": F.trunc(d, "year"),
        "year_end_date": _last_day("year", d),
    }
    return days.select(*[c.alias(name) for name, c in attributes.items()])


def fiscal_year_dates(
    dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Days of each fiscal year that ends with the week closest to the end of a month.

    The first year end found only opens the next year, so its own days are left out.
    """
    weeks = dimension.filter(F.col("day_of_week") == week_start_day).select(
        "year_number",
        "month_of_year",
        "month_end_date",
        F.col("date_day").alias("week_start_date"),
        F.date_add("date_day", 6).alias("week_end_date"),
    )
    closeness = F.abs(F.datediff("week_end_date", "month_end_date"))
    per_year = Window.partitionBy("fiscal_year_number").orderBy(closeness)
    year_ends = (
        weeks.filter(F.col("month_of_year") == year_end_month)
        .withColumn("fiscal_year_number", F.col("year_number") - shift_year)
        .withColumn("_closest", F.rank().over(per_year))
        .filter("_closest = 1")
    )
    # a handful of rows: one or two per calendar year
    along = Window.orderBy("week_end_date")
    years = year_ends.select(
        "fiscal_year_number",
        F.date_add(F.lag("week_end_date").over(along), 1).alias("fiscal_year_start_date"),
        F.col("week_end_date").alias("fiscal_year_end_date"),
    ).filter(F.col("fiscal_year_start_date").isNotNull())
    days = join_week_range(
        dimension.select("date_day"), "date_day",
        years, "fiscal_year_start_date", "fiscal_year_end_date", lengths=(300, 400),
    )
    days = join_week_range(
        days, "date_day", weeks.select("week_start_date", "week_end_date"), "week_start_date", "week_end_date"
    )
    in_year = Window.partitionBy("fiscal_year_number").orderBy("week_start_date")
    return days.withColumn("fiscal_week_of_year", F.dense_rank().over(in_year))


def fiscal_periods(
    dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """4-5-4 periods in 13-week quarters; a 53rd week joins the last period."""
    week = F.col("fiscal_week_of_year") - 1
    in_quarter = F.pmod(week, F.lit(WEEKS_PER_QUARTER))
    quarter = F.least(F.floor(week / WEEKS_PER_QUARTER), F.lit(3)).cast("int")
    period = (
        F.when(F.col("fiscal_week_of_year") == 53, 3)
        .when(in_quarter < 4, 1)
        .when(in_quarter < 9, 2)
        .otherwise(3)
    )
    dates = fiscal_year_dates(dimension, year_end_month, week_start_day, shift_year)
    numbered = dates.withColumn("_quarter", quarter).withColumn("fiscal_period_of_quarter", period)
    numbered = numbered.withColumn(
        "fiscal_period_number", F.col("_quarter") * 3 + F.col("fiscal_period_of_quarter")
    )
    in_period = Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return numbered.select(
        "date_day",
        "fiscal_year_number",
        "week_start_date",
        "week_end_date",
        "fiscal_week_of_year",
        F.dense_rank().over(in_period).alias("fiscal_week_of_period"),
        "fiscal_period_number",
        (F.col("_quarter") + 1).alias("fiscal_quarter_number"),
        "fiscal_period_of_quarter",
    )


def calendar_with_fiscal(dimension: DataFrame, **fiscal) -> DataFrame:
    """Calendar left-joined with its fiscal periods."""
    periods = fiscal_periods(dimension, **fiscal).drop("week_start_date", "week_end_date")
    return dimension.join(periods, "date_day", "left")
