"""Date scalars, calendar and fiscal dimensions, all driven by the tables' own dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartmill.catalog.common import longs
from cartmill.catalog.pipeline import ORDER_DATES, order_dates
from cartmill.catalog.registry import query
from cartmill.catalog.shop import Shop
from cartmill.functions import dates as D
from cartmill.operators import calendar as cal
from cartmill.operators.relational import date_spine

DAY = "CAST(o_orderdate AS DATE)"


def _select(s: Shop, **columns):
    """Key plus the given columns of orders, whole numbers as bigint."""
    df = s.orders.withColumn("d", F.to_date("o_orderdate")).select(
        "o_orderkey", *[c.alias(n) for n, c in columns.items()]
    )
    return longs(df, *[f.name for f in df.schema.fields if f.dataType.simpleString() in ("int", "bigint")])


def _sql(**columns: str) -> str:
    cols = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT o_orderkey, {cols} FROM (SELECT *, {DAY} AS d FROM orders)"


@query("dt01_date_part", _sql(y="year(d)", q="quarter(d)", m="month(d)", dd="day(d)", doy="dayofyear(d)"))
def _(s: Shop):
    parts = {"y": "year", "q": "quarter", "m": "month", "dd": "day", "doy": "doy"}
    return _select(s, **{n: D.date_part(p, "d") for n, p in parts.items()})


@query("dt02_day_of_week", _sql(iso="isodow(d)", sunday_first="dayofweek(d) + 1"))
def _(s: Shop):
    return _select(s, iso=D.day_of_week("d"), sunday_first=D.day_of_week("d", iso=False))


@query("dt03_day_of_month_year", _sql(day_of_month="day(d)", day_of_year="dayofyear(d)"))
def _(s: Shop):
    return _select(s, day_of_month=D.day_of_month("d"), day_of_year=D.day_of_year("d"))


@query("dt04_day_name", _sql(short_name="strftime(d, '%a')", long_name="strftime(d, '%A')"))
def _(s: Shop):
    return _select(s, short_name=D.day_name("d"), long_name=D.day_name("d", short=False))


@query("dt05_month_name", _sql(short_name="strftime(d, '%b')", long_name="strftime(d, '%B')"))
def _(s: Shop):
    return _select(s, short_name=D.month_name("d"), long_name=D.month_name("d", short=False))


def _list(words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"


# Expected names of four of the languages, Monday or January first.
FI_DAYS = _list("maanantai tiistai keskiviikko torstai perjantai lauantai sunnuntai")
SV_DAYS = _list("mån tis ons tor fre lör sön")
PL_MONTHS = _list(
    "styczeń luty marzec kwiecień maj czerwiec lipiec sierpień wrzesień październik listopad grudzień"
)
CS_MONTHS = _list("led úno bře dub kvě čer čvc srp zář říj lis pro")


@query(
    "dt06_localized_names",
    _sql(
        fi_day=f"{FI_DAYS}[isodow(d)]",
        sv_day=f"{SV_DAYS}[isodow(d)]",
        pl_month=f"{PL_MONTHS}[month(d)]",
        cs_month=f"{CS_MONTHS}[month(d)]",
    ),
)
def _(s: Shop):
    return _select(
        s,
        fi_day=D.day_name_localized("d", "fi", short=False),
        sv_day=D.day_name_localized("d", "sv"),
        pl_month=D.month_name_localized("d", "pl", short=False),
        cs_month=D.month_name_localized("d", "cs"),
    )


SUNDAY = "d - dayofweek(d)::INT"
MONDAY = "d - (isodow(d) - 1)::INT"


@query("dt07_week_start_end", _sql(week_start=SUNDAY, week_end=f"{SUNDAY} + 6"))
def _(s: Shop):
    return _select(s, week_start=D.week_start("d"), week_end=D.week_end("d"))


@query("dt08_iso_week_start_end", _sql(week_start=MONDAY, week_end=f"{MONDAY} + 6"))
def _(s: Shop):
    return _select(s, week_start=D.iso_week_start("d"), week_end=D.iso_week_end("d"))


@query("dt09_week_of_year", _sql(sunday_week="strftime(d, '%U')::BIGINT", iso_week="weekofyear(d)"))
def _(s: Shop):
    return _select(s, sunday_week=D.week_of_year("d"), iso_week=D.week_of_year("d", "iso"))


@query("dt10_iso_week_of_year", _sql(iso_week="strftime(d, '%V')::BIGINT"))
def _(s: Shop):
    return _select(s, iso_week=D.iso_week_of_year("d"))


@query("dt11_iso_year_week", _sql(label="strftime(d, '%G-W%V')"))
def _(s: Shop):
    return _select(s, label=D.iso_year_week("d"))


@query(
    "dt12_days_shifted",
    _sql(ago="d - 10", away="d + 45", yesterday="d - 1", tomorrow="d + 1"),
)
def _(s: Shop):
    return _select(
        s, ago=D.n_days_ago(10, "d"), away=D.n_days_away(45, "d"), yesterday=D.yesterday("d"), tomorrow=D.tomorrow("d")
    )


@query(
    "dt13_weeks_shifted",
    _sql(
        ago=f"{SUNDAY} - 21",
        away=f"{SUNDAY} + 14",
        last_week=f"{SUNDAY} - 7",
        next_week=f"{SUNDAY} + 7",
        iso_last_week=f"{MONDAY} - 7",
    ),
)
def _(s: Shop):
    return _select(
        s,
        ago=D.n_weeks_ago(3, "d"),
        away=D.n_weeks_away(2, "d"),
        last_week=D.last_week("d"),
        next_week=D.next_week("d"),
        iso_last_week=D.last_week("d", iso=True),
    )


def _month_shift(n: int) -> str:
    return f"CAST(date_trunc('month', d + INTERVAL ({n}) MONTH) AS DATE)"


@query(
    "dt14_months_shifted",
    _sql(
        ago=_month_shift(-5),
        away=_month_shift(7),
        last_month=_month_shift(-1),
        next_month=_month_shift(1),
        last_name=f"strftime({_month_shift(-1)}, '%b')",
        next_name=f"strftime({_month_shift(1)}, '%B')",
        last_number=f"month({_month_shift(-1)})",
        next_number=f"month({_month_shift(1)})",
    ),
)
def _(s: Shop):
    return _select(
        s,
        ago=D.n_months_ago(5, "d"),
        away=D.n_months_away(7, "d"),
        last_month=D.last_month("d"),
        next_month=D.next_month("d"),
        last_name=D.last_month_name("d"),
        next_name=D.next_month_name("d", short=False),
        last_number=D.last_month_number("d"),
        next_number=D.next_month_number("d"),
    )


# Three hours behind the universal time all year, as no daylight saving applies there.
FIXED_ZONE = "America/Argentina/Buenos_Aires"


@query(
    "dt15_now_today",
    f"""SELECT event_id, ts - INTERVAL 3 HOUR AS local_now, CAST(ts - INTERVAL 3 HOUR AS DATE) AS local_today,
        CAST(ts AS DATE) AS utc_today FROM events""",
)
def _(s: Shop):
    return s.events.select(
        "event_id",
        D.now("ts", FIXED_ZONE).alias("local_now"),
        D.today("ts", FIXED_ZONE).alias("local_today"),
        D.today("ts").alias("utc_today"),
    )


AS_OF = "TIMESTAMP '2024-01-31 12:00:00'"


@query(
    "dt16_periods_since",
    f"""SELECT event_id, date_diff('day', ts, {AS_OF}) AS days, date_diff('hour', ts, {AS_OF}) AS hours,
        date_diff('month', ts, {AS_OF}) AS months FROM events""",
)
def _(s: Shop):
    as_of = F.lit("2024-01-31 12:00:00").cast("timestamp")
    return s.events.select(
        "event_id",
        *[D.periods_since("ts", p, as_of).alias(f"{p}s") for p in ("day", "hour", "month")],
    )


@query(
    "dt17_convert_timezone",
    """SELECT event_id, ts + INTERVAL 9 HOUR AS tokyo, ts - INTERVAL 9 HOUR AS from_tokyo,
       ts + INTERVAL 1 HOUR AS amsterdam FROM events""",
)
def _(s: Shop):
    """January only, so Amsterdam is one hour ahead throughout."""
    return s.events.select(
        "event_id",
        D.convert_timezone("ts", "Asia/Tokyo").alias("tokyo"),
        D.convert_timezone("ts", "UTC", "Asia/Tokyo").alias("from_tokyo"),
        D.convert_timezone("ts", "Europe/Amsterdam").alias("amsterdam"),
    )


@query(
    "dt18_from_unix",
    """SELECT o_orderkey, make_timestamp(e * 1000000) AS from_seconds, make_timestamp(e * 1000000 + 5000) AS from_millis,
       make_timestamp(e * 1000000 + 7) AS from_micros, make_timestamp(e * 1000000 + 7) AS from_nanos
       FROM (SELECT o_orderkey, epoch(o_orderdate)::BIGINT + o_orderkey AS e FROM orders)""",
)
def _(s: Shop):
    e = D.to_unix("o_orderdate") + F.col("o_orderkey")
    return s.orders.select(
        "o_orderkey",
        D.from_unix(e).alias("from_seconds"),
        D.from_unix(e * 1000 + 5, "milliseconds").alias("from_millis"),
        D.from_unix(e * 1_000_000 + 7, "microseconds").alias("from_micros"),
        D.from_unix(e * 1_000_000_000 + 7_900, "nanoseconds").alias("from_nanos"),
    )


@query("dt19_to_unix", "SELECT event_id, floor(epoch(ts))::BIGINT AS epochs FROM events")
def _(s: Shop):
    return s.events.select("event_id", D.to_unix("ts").alias("epochs"))


@query(
    "dt20_round_to_day",
    "SELECT event_id, CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS TIMESTAMP) AS nearest FROM events",
)
def _(s: Shop):
    return s.events.select("event_id", D.round_to_day("ts").alias("nearest"))


# --- dimensions -----------------------------------------------------------------------


@query(
    "cal01_base_dates",
    f"""SELECT 'range' AS kind, CAST(d AS TIMESTAMP) AS moment FROM (
          SELECT unnest(generate_series(a, b - 1, INTERVAL 1 DAY)) AS d FROM ({ORDER_DATES}))
        UNION ALL SELECT 'trailing', CAST(d AS TIMESTAMP) FROM (
          SELECT unnest(generate_series(b - 30, b, INTERVAL 1 DAY)) AS d FROM ({ORDER_DATES}))""",
)
def _(s: Shop):
    limits = order_dates(s)
    trailing = cal.trailing_dates(limits.select(F.col("end").alias("as_of")), 30)
    return (
        cal.base_dates(limits)
        .select(F.lit("range").alias("kind"), F.col("date_day").alias("moment"))
        .unionByName(trailing.select(F.lit("trailing").alias("kind"), F.col("date_day").alias("moment")))
    )


def _last(part: str, c: str) -> str:
    return f"CAST(date_trunc('{part}', {c}) + INTERVAL 1 {part.upper()} - INTERVAL 1 DAY AS DATE)"


def _sunday(c: str) -> str:
    return f"({c} - dayofweek({c})::INT)"


def _monday(c: str) -> str:
    return f"({c} - (isodow({c}) - 1)::INT)"


DIMENSION = f"""WITH spine AS (
  SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(a, b - 1, INTERVAL 1 DAY)) AS d
  FROM ({ORDER_DATES}))),
dated AS (SELECT d, CAST(d - INTERVAL 1 YEAR AS DATE) AS py, d - 364 AS pp FROM spine),
dimension AS (
  SELECT d AS date_day, d - 1 AS prior_date_day, d + 1 AS next_date_day, py AS prior_year_date_day,
    pp AS prior_year_over_year_date_day, (dayofweek(d) + 1)::BIGINT AS day_of_week,
    isodow(d)::BIGINT AS day_of_week_iso, strftime(d, '%A') AS day_of_week_name,
    strftime(d, '%a') AS day_of_week_name_short, day(d)::BIGINT AS day_of_month, dayofyear(d)::BIGINT AS day_of_year,
    {_sunday("d")} AS week_start_date, {_sunday("d")} + 6 AS week_end_date,
    {_sunday("pp")} AS prior_year_week_start_date, {_sunday("pp")} + 6 AS prior_year_week_end_date,
    strftime(d, '%U')::BIGINT AS week_of_year, {_monday("d")} AS iso_week_start_date,
    {_monday("d")} + 6 AS iso_week_end_date, {_monday("pp")} AS prior_year_iso_week_start_date,
    {_monday("pp")} + 6 AS prior_year_iso_week_end_date, weekofyear(d)::BIGINT AS iso_week_of_year,
    strftime(d, '%G-W%V') AS iso_year_week, strftime(pp, '%U')::BIGINT AS prior_year_week_of_year,
    weekofyear(pp)::BIGINT AS prior_year_iso_week_of_year, month(d)::BIGINT AS month_of_year,
    strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
    CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
    CAST(date_trunc('month', py) AS DATE) AS prior_year_month_start_date, last_day(py) AS prior_year_month_end_date,
    quarter(d)::BIGINT AS quarter_of_year, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
    {_last("quarter", "d")} AS quarter_end_date, year(d)::BIGINT AS year_number,
    CAST(date_trunc('year', d) AS DATE) AS year_start_date, {_last("year", "d")} AS year_end_date
  FROM dated)
"""
DIMENSION_NUMBERS = (
    "day_of_week", "day_of_week_iso", "day_of_month", "day_of_year", "week_of_year", "iso_week_of_year",
    "prior_year_week_of_year", "prior_year_iso_week_of_year", "month_of_year", "quarter_of_year", "year_number",
)


@query("cal02_date_dimension", DIMENSION + "SELECT * FROM dimension")
def _(s: Shop):
    return longs(cal.date_dimension(order_dates(s)), *DIMENSION_NUMBERS)


FISCAL = (
    DIMENSION
    + """, weeks AS (SELECT year_number, month_of_year, month_end_date, date_day AS week_start_date,
  date_day + 6 AS week_end_date FROM dimension WHERE day_of_week = 1),
year_ends AS (
  SELECT fiscal_year_number, week_end_date FROM (
    SELECT year_number - 1 AS fiscal_year_number, week_end_date,
      rank() OVER (PARTITION BY year_number ORDER BY abs(week_end_date - month_end_date)) AS r
    FROM weeks WHERE month_of_year = 1) WHERE r = 1),
fiscal_years AS (
  SELECT fiscal_year_number, lag(week_end_date) OVER (ORDER BY week_end_date) + 1 AS fiscal_year_start_date,
    week_end_date AS fiscal_year_end_date FROM year_ends),
fiscal_dates AS (
  SELECT date_day, fiscal_year_number, fiscal_year_start_date, fiscal_year_end_date, week_start_date, week_end_date,
    dense_rank() OVER (PARTITION BY fiscal_year_number ORDER BY week_start_date) AS fiscal_week_of_year
  FROM (SELECT date_day FROM dimension)
  JOIN fiscal_years ON date_day BETWEEN fiscal_year_start_date AND fiscal_year_end_date
  JOIN weeks ON date_day BETWEEN week_start_date AND week_end_date),
fiscal_numbered AS (
  SELECT *, least((fiscal_week_of_year - 1) // 13, 3) AS q,
    CASE WHEN fiscal_week_of_year = 53 THEN 3 WHEN (fiscal_week_of_year - 1) % 13 <= 3 THEN 1
         WHEN (fiscal_week_of_year - 1) % 13 <= 8 THEN 2 ELSE 3 END AS fiscal_period_of_quarter FROM fiscal_dates),
periods AS (
  SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year,
    dense_rank() OVER (PARTITION BY q * 3 + fiscal_period_of_quarter ORDER BY fiscal_week_of_year)
      AS fiscal_week_of_period,
    q * 3 + fiscal_period_of_quarter AS fiscal_period_number, q + 1 AS fiscal_quarter_number,
    fiscal_period_of_quarter FROM fiscal_numbered)
"""
)
PERIOD_NUMBERS = (
    "fiscal_year_number", "fiscal_week_of_year", "fiscal_week_of_period", "fiscal_period_number",
    "fiscal_quarter_number", "fiscal_period_of_quarter",
)
JANUARY_YEAR = {"year_end_month": 1, "week_start_day": 1, "shift_year": 1}


@query("cal03_fiscal_year_dates", FISCAL + "SELECT * FROM fiscal_dates")
def _(s: Shop):
    days = cal.fiscal_year_dates(cal.date_dimension(order_dates(s)), **JANUARY_YEAR)
    return longs(days, "fiscal_year_number", "fiscal_week_of_year")


PERIOD_SQL = ", ".join(f"{c}::BIGINT AS {c}" for c in PERIOD_NUMBERS)


@query("cal04_fiscal_periods", FISCAL + f"SELECT date_day, week_start_date, week_end_date, {PERIOD_SQL} FROM periods")
def _(s: Shop):
    return longs(cal.fiscal_periods(cal.date_dimension(order_dates(s)), **JANUARY_YEAR), *PERIOD_NUMBERS)


@query(
    "cal05_calendar_with_fiscal",
    FISCAL
    + f"""SELECT date_day, iso_year_week, {PERIOD_SQL} FROM dimension LEFT JOIN periods USING (date_day)""",
)
def _(s: Shop):
    full = cal.calendar_with_fiscal(cal.date_dimension(order_dates(s)), **JANUARY_YEAR)
    return longs(full.select("date_day", "iso_year_week", *PERIOD_NUMBERS), *PERIOD_NUMBERS)


@query(
    "cal05_hourly_spine",
    """SELECT d AS date_hour FROM (
         SELECT unnest(generate_series(a, b - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS d
         FROM (SELECT date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events))""",
)
def _(s: Shop):
    span = s.events.agg(
        F.date_trunc("hour", F.min("ts")).alias("start"), F.date_trunc("hour", F.max("ts")).alias("end")
    )
    return date_spine(span, "hour")
