"""Calendar columns. Functions relative to "now" take an explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartmill.functions.scalars import to_column

SUB_DAY = {"hour": 3600, "minute": 60, "second": 1}
IN_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _as_of(as_of) -> Column:
    return F.current_timestamp() if as_of is None else to_column(as_of)


def date_part(part: str, value) -> Column:
    return F.date_part(F.lit(part), to_column(value))


def day_of_week(value, iso: bool = True) -> Column:
    """ISO: Monday 1 .. Sunday 7; otherwise Sunday 1 .. Saturday 7."""
    c = to_column(value)
    return F.weekday(c) + 1 if iso else F.dayofweek(c)


def day_of_month(value) -> Column:
    return F.dayofmonth(to_column(value))


def day_of_year(value) -> Column:
    return F.dayofyear(to_column(value))


def day_name(value, short: bool = True) -> Column:
    return F.date_format(to_column(value), "E" if short else "EEEE")


def month_name(value, short: bool = True) -> Column:
    return F.date_format(to_column(value), "MMM" if short else "MMMM")


def week_start(value) -> Column:
    """The Sunday on or before the date."""
    d = F.to_date(to_column(value))
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(value) -> Column:
    return F.date_add(week_start(value), 6)


def iso_week_start(value) -> Column:
    """The Monday on or before the date."""
    return F.to_date(F.date_trunc("WEEK", to_column(value)))


def iso_week_end(value) -> Column:
    return F.date_add(iso_week_start(value), 6)


def iso_week_of_year(value) -> Column:
    return F.weekofyear(to_column(value))


def week_of_year(value, mode: str = "sunday") -> Column:
    """``sunday``: weeks start on Sunday, days before the first Sunday are week 0."""
    c = to_column(value)
    if mode == "iso":
        return F.weekofyear(c)
    if mode != "sunday":
        raise ValueError(f"mode must be 'sunday' or 'iso', got {mode!r}")
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")


def iso_year_week(value) -> Column:
    """'YYYY-Www'; the Thursday of a week decides which year the week belongs to."""
    thursday = F.date_add(iso_week_start(value), 3)
    week = F.lpad(iso_week_of_year(value).cast("string"), 2, "0")
    return F.concat(F.year(thursday).cast("string"), F.lit("-W"), week)


def truncate(part: str, value) -> Column:
    """date_trunc, with weeks starting on Sunday."""
    c = to_column(value)
    if part == "week":
        return week_start(c).cast("timestamp")
    return F.date_trunc(part, c)


def add_parts(part: str, n, value) -> Column:
    """Timestamp ``n`` (number or Column) parts later."""
    moment = to_column(value).cast("timestamp")
    n = n if isinstance(n, Column) else F.lit(n)
    if part in SUB_DAY:
        return moment + F.make_dt_interval(secs=(n * SUB_DAY[part]).cast("decimal(18,6)"))
    if part in ("day", "week"):
        return moment + F.make_dt_interval(days=(n * (7 if part == "week" else 1)).cast("int"))
    if part in IN_MONTHS:
        return moment + F.make_ym_interval(F.lit(0), (n * IN_MONTHS[part]).cast("int"))
    raise ValueError(f"unknown date part {part!r}")


def parts_between(first, second, part: str) -> Column:
    """Number of part boundaries crossed going from ``first`` to ``second``."""
    a, b = to_column(first), to_column(second)
    if part == "day":
        return F.datediff(b, a).cast("bigint")
    if part == "week":
        return (F.datediff(week_start(b), week_start(a)) / 7).cast("bigint")
    if part in SUB_DAY:
        low, high = (F.unix_timestamp(F.date_trunc(part, v.cast("timestamp"))) for v in (a, b))
        return ((high - low) / SUB_DAY[part]).cast("bigint")
    if part in IN_MONTHS:
        width = IN_MONTHS[part]
        ordinal = lambda v: F.year(v) * (12 // width) + F.floor((F.month(v) - 1) / width)
        return (ordinal(b) - ordinal(a)).cast("bigint")
    raise ValueError(f"unknown date part {part!r}")


def whole_days_between(first, second) -> Column:
    """Complete 24-hour units from ``first`` to ``second``, truncated toward zero."""
    return F.timestamp_diff("DAY", to_column(first), to_column(second))


def now(as_of=None, tz: str | None = None) -> Column:
    moment = _as_of(as_of)
    return convert_timezone(moment, tz) if tz else moment


def today(as_of=None, tz: str | None = None) -> Column:
    return F.to_date(now(as_of, tz))


def n_days_ago(n: int, as_of=None, tz: str | None = None) -> Column:
    return F.date_sub(today(as_of, tz), n)


def n_days_away(n: int, as_of=None, tz: str | None = None) -> Column:
    return F.date_add(today(as_of, tz), n)


def yesterday(as_of=None, tz: str | None = None) -> Column:
    return n_days_ago(1, as_of, tz)


def tomorrow(as_of=None, tz: str | None = None) -> Column:
    return n_days_away(1, as_of, tz)


def n_weeks_ago(n: int, as_of=None, tz: str | None = None, iso: bool = False) -> Column:
    shifted = F.date_sub(today(as_of, tz), 7 * n)
    return iso_week_start(shifted) if iso else week_start(shifted)


def n_weeks_away(n: int, as_of=None, tz: str | None = None, iso: bool = False) -> Column:
    return n_weeks_ago(-n, as_of, tz, iso)


def last_week(as_of=None, tz: str | None = None, iso: bool = False) -> Column:
    return n_weeks_ago(1, as_of, tz, iso)


def next_week(as_of=None, tz: str | None = None, iso: bool = False) -> Column:
    return n_weeks_away(1, as_of, tz, iso)


def n_months_ago(n: int, as_of=None, tz: str | None = None) -> Column:
    return F.trunc(F.add_months(today(as_of, tz), -n), "month")


def n_months_away(n: int, as_of=None, tz: str | None = None) -> Column:
    return n_months_ago(-n, as_of, tz)


def last_month(as_of=None, tz: str | None = None) -> Column:
    return n_months_ago(1, as_of, tz)


def next_month(as_of=None, tz: str | None = None) -> Column:
    return n_months_away(1, as_of, tz)


def last_month_name(as_of=None, short: bool = True, tz: str | None = None) -> Column:
    return month_name(last_month(as_of, tz), short)


def next_month_name(as_of=None, short: bool = True, tz: str | None = None) -> Column:
    return month_name(next_month(as_of, tz), short)


def last_month_number(as_of=None, tz: str | None = None) -> Column:
    return F.month(last_month(as_of, tz))


def next_month_number(as_of=None, tz: str | None = None) -> Column:
    return F.month(next_month(as_of, tz))


def periods_since(value, part: str = "day", as_of=None, tz: str | None = None) -> Column:
    return parts_between(value, now(as_of, tz), part)


def convert_timezone(value, target: str, source: str = "UTC") -> Column:
    """Wall-clock time in ``target`` for a wall-clock time in ``source``."""
    ntz = F.convert_timezone(F.lit(source), F.lit(target), to_column(value).cast("timestamp_ntz"))
    return ntz.cast("timestamp")


def from_unix(value, unit: str = "seconds") -> Column:
    c = to_column(value)
    if unit == "seconds":
        return F.timestamp_seconds(c)
    if unit == "milliseconds":
        return F.timestamp_millis(c)
    if unit == "microseconds":
        return F.timestamp_micros(c)
    if unit == "nanoseconds":
        return F.timestamp_micros(F.floor(c / 1000).cast("bigint"))
    raise ValueError(f"unknown epoch unit {unit!r}")


def to_unix(value) -> Column:
    return F.unix_timestamp(to_column(value).cast("timestamp"))


def round_to_day(value) -> Column:
    """Midnight nearest to the instant; noon rounds up."""
    return F.date_trunc("DAY", to_column(value).cast("timestamp") + F.expr("INTERVAL 12 HOURS"))


def period(year, month) -> Column:
    """'YYYY-MM' label."""
    return F.format_string("%04d-%02d", to_column(year).cast("int"), to_column(month).cast("int"))


def period_of(value) -> Column:
    return F.date_format(to_column(value), "yyyy-MM")


# Languages and deviations are fixed values: where the locale data of the Java runtime
# differs from the names reports expect, the expected one is stated here.
LANGUAGES = ("en", "nl", "de", "fr", "es", "it", "pt", "pl", "da", "sv", "tr", "cs", "fi")
SHORT_NAME_OVERRIDES = {("cs", "čvn"): "čer"}
THREE_LETTER_LANGUAGES = ("sv",)
WEEKDAY_SUFFIX = {"fi": "na"}


def _localized(value, pattern: str, language: str, short: bool) -> Column:
    if language not in LANGUAGES:
        raise ValueError(f"no names for language {language!r}; known: {', '.join(LANGUAGES)}")
    day = F.to_date(to_column(value))
    text = F.to_csv(F.struct(day.alias("d")), {"dateFormat": pattern, "locale": language})
    text = F.when(day.isNotNull(), F.rtrim(text, F.lit(".")))
    if short and language in THREE_LETTER_LANGUAGES:
        text = F.left(text, F.lit(3))
    for (lang, found), wanted in SHORT_NAME_OVERRIDES.items():
        if short and lang == language:
            text = F.when(text == found, F.lit(wanted)).otherwise(text)
    return text


def day_name_localized(value, language: str, short: bool = True) -> Column:
    """Weekday name from the Java runtime's locale data."""
    text = _localized(value, "EEE" if short else "EEEE", language, short)
    suffix = "" if short else WEEKDAY_SUFFIX.get(language, "")
    return F.regexp_replace(text, f"{suffix}$", "") if suffix else text


def month_name_localized(value, language: str, short: bool = True) -> Column:
    """Month name in its stand-alone form from the Java runtime's locale data."""
    return _localized(value, "LLL" if short else "LLLL", language, short)
