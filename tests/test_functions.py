"""Scalar, URL, date and business columns: golden values and NULL rules."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from cartmill.functions import business, dates, scalars, web


def values(spark, schema, data, column):
    df = spark.createDataFrame(data, schema).withColumn("_i", F.monotonically_increasing_id())
    return [r.x for r in df.select("_i", column.alias("x")).orderBy("_i").collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_surrogate_key(spark):
    key = scalars.surrogate_key("a", "b", "c")
    got = values(spark, "a string, b string, c string", [("a", "b", "c"), ("a", None, "c"), ("", "b", "c")], key)
    # md5 of the joined texts, the placeholder standing for NULL
    want = [
        "7b193b3d33184464106f41ddf733783b",
        "4f32a73dc87b7bbb7a654d8898d58c7e",
        "c76ecdd27333cd79a78eb51a62d3d6c2",
    ]
    assert got == want
    legacy = scalars.surrogate_key("a", "b", treat_nulls_as_empty=True)
    assert values(spark, "a string, b string", [("a", None)], legacy) == [hashlib.md5(b"a-").hexdigest()]
    with pytest.raises(ValueError):
        scalars.surrogate_key()


def test_blank_and_empty(spark):
    data = [("",), ("  ",), (" x ",), (None,)]
    assert values(spark, "s string", data, scalars.blank_to_null("s")) == [None, None, " x ", None]


def test_safe_arithmetic(spark):
    data = [(1, 2, 3), (1, None, 3), (None, None, None)]
    schema = "a int, b int, c int"
    assert values(spark, schema, data, scalars.safe_add("a", "b", "c")) == [6, 4, 0]
    assert values(spark, schema, data, scalars.safe_subtract("a", "b", "c")) == [-4, -2, 0]
    pairs = [(6, 3), (0, 5), (5, 0), (None, 1), (1, None)]
    assert values(spark, "a int, b int", pairs, scalars.safe_divide("a", "b")) == [2.0, 0.0, None, None, None]
    for f in (scalars.safe_add, scalars.safe_subtract):
        with pytest.raises(ValueError):
            f()


def test_at_least_keeps_null(spark):
    assert values(spark, "a int", [(0,), (3,), (None,)], scalars.at_least("a", 1)) == [1, 3, None]


def test_width_bucket(spark):
    data = [(-1.0,), (0.0,), (0.5,), (9.99,), (10.0,), (11.0,)]
    assert values(spark, "a double", data, scalars.width_bucket("a", 0.0, 10.0, 5)) == [0, 1, 1, 5, 6, 6]


def test_haversine(spark):
    # two capitals, 430 km or 267 miles apart
    data = [(48.864716, 2.349014, 52.379189, 4.899431)]
    schema = "a double, b double, c double, d double"
    km = values(spark, schema, data, F.round(scalars.haversine("a", "b", "c", "d", "km")))
    mi = values(spark, schema, data, F.round(scalars.haversine("a", "b", "c", "d")))
    assert (km, mi) == ([430.0], [267.0])
    with pytest.raises(ValueError):
        scalars.haversine("a", "b", "c", "d", "m")


def test_regex_position(spark):
    data = [("ab12cd34ef56",), ("none",), (None,)]
    find = lambda **k: values(spark, "s string", data, scalars.regex_position("s", "[0-9]{2}", **k))
    assert find() == [3, 0, None]
    assert find(occurrence=2) == [7, 0, None]
    assert find(occurrence=3) == [11, 0, None]
    assert find(occurrence=4) == [0, 0, None]
    assert find(position=4) == [7, 0, None]
    assert one(spark, scalars.regex_position(F.lit("xABC"), "abc")) == 0
    assert one(spark, scalars.regex_position(F.lit("xABC"), "abc", flags="i")) == 2
    with pytest.raises(ValueError):
        scalars.regex_position("s", "a", flags="q")
    with pytest.raises(ValueError):
        scalars.regex_position("s", "a", position=0)


def test_slugify(spark):
    names = ["Hello World-2", "2 fast", "a!b", "", "A - B"]
    want = ["hello_world_2", "_2_fast", "ab", "", "a_b"]
    assert [scalars.slugify_text(n) for n in names] == want
    assert values(spark, "s string", [(n,) for n in names], scalars.slugify("s")) == want


def test_url_parts(spark):
    urls = [
        ("http://www.example.com/a/b?utm_medium=mail&utm_source=x",),
        ("example.com?utm_source=x",),
        ("https://www.example.com",),
        ("android-app://com.example/path",),
        ("http://example.com/page?utm_medium=&b=1",),
    ]
    assert values(spark, "u string", urls, web.url_host("u")) == [
        "www.example.com",
        "example.com",
        "www.example.com",
        "com.example",
        "example.com",
    ]
    assert values(spark, "u string", urls, web.url_path("u"))[:2] == ["a/b", ""]
    assert values(spark, "u string", urls, web.url_parameter("u", "utm_source")) == ["x", "x", None, None, None]
    assert values(spark, "u string", urls, web.url_parameter("u", "utm_medium")) == ["mail", None, None, None, None]


# --- dates ----------------------------------------------------------------------------

SUNDAY, TUESDAY = dt.date(2020, 11, 29), dt.date(2020, 12, 1)
CALENDAR = {
    "day_of_week": (lambda: dates.day_of_week("d", iso=False), 1, 3),
    "day_of_week_iso": (lambda: dates.day_of_week("d"), 7, 2),
    "day_name": (lambda: dates.day_name("d", short=False), "Sunday", "Tuesday"),
    "day_name_short": (lambda: dates.day_name("d"), "Sun", "Tue"),
    "day_of_month": (lambda: dates.day_of_month("d"), 29, 1),
    "day_of_year": (lambda: dates.day_of_year("d"), 334, 336),
    "week_start": (lambda: dates.week_start("d"), SUNDAY, SUNDAY),
    "week_end": (lambda: dates.week_end("d"), dt.date(2020, 12, 5), dt.date(2020, 12, 5)),
    "week_of_year": (lambda: dates.week_of_year("d"), 48, 48),
    "week_of_year_iso": (lambda: dates.week_of_year("d", "iso"), 48, 49),
    "iso_week_start": (lambda: dates.iso_week_start("d"), dt.date(2020, 11, 23), dt.date(2020, 11, 30)),
    "iso_week_end": (lambda: dates.iso_week_end("d"), SUNDAY, dt.date(2020, 12, 6)),
    "iso_year_week": (lambda: dates.iso_year_week("d"), "2020-W48", "2020-W49"),
    "month_name": (lambda: dates.month_name("d", short=False), "November", "December"),
    "month_name_short": (lambda: dates.month_name("d"), "Nov", "Dec"),
    "day_nl": (lambda: dates.day_name_localized("d", "nl", short=False), "zondag", "dinsdag"),
    "day_de_short": (lambda: dates.day_name_localized("d", "de"), "So", "Di"),
    "day_fi": (lambda: dates.day_name_localized("d", "fi", short=False), "sunnuntai", "tiistai"),
    "day_sv_short": (lambda: dates.day_name_localized("d", "sv"), "sön", "tis"),
    "month_fr_short": (lambda: dates.month_name_localized("d", "fr"), "nov", "déc"),
    "month_pl": (lambda: dates.month_name_localized("d", "pl", short=False), "listopad", "grudzień"),
    "last_month": (lambda: dates.last_month("d"), dt.date(2020, 10, 1), dt.date(2020, 11, 1)),
    "next_month_name": (lambda: dates.next_month_name("d"), "Dec", "Jan"),
    "next_month_number": (lambda: dates.next_month_number("d"), 12, 1),
    "yesterday": (lambda: dates.yesterday("d"), dt.date(2020, 11, 28), dt.date(2020, 11, 30)),
    "n_weeks_ago": (lambda: dates.n_weeks_ago(2, "d"), dt.date(2020, 11, 15), dt.date(2020, 11, 15)),
}


@pytest.mark.parametrize("name", CALENDAR)
def test_calendar_goldens(spark, name):
    column, sunday, tuesday = CALENDAR[name]
    assert values(spark, "d date", [(SUNDAY,), (TUESDAY,)], column()) == [sunday, tuesday]


def test_iso_year_week_at_year_ends(spark):
    days = [dt.date(2015, 12, 28) + dt.timedelta(days=i) for i in range(8 * 366)]
    got = values(spark, "d date", [(d,) for d in days], dates.iso_year_week("d"))
    assert got == [d.strftime("%G-W%V") for d in days]


def test_sunday_weeks(spark):
    days = [dt.date(2014, 1, 1) + dt.timedelta(days=i) for i in range(9 * 365)]
    got = values(spark, "d date", [(d,) for d in days], dates.week_of_year("d"))
    assert got == [int(d.strftime("%U")) for d in days]


def test_localized_names(spark):
    assert one(spark, dates.month_name_localized(F.lit(dt.date(2021, 6, 1)), "cs")) == "čer"
    assert one(spark, dates.month_name_localized(F.lit(dt.date(2021, 7, 1)), "sv")) == "jul"
    assert one(spark, dates.month_name_localized(F.lit(dt.date(2021, 3, 1)), "nl")) == "mrt"
    assert one(spark, dates.day_name_localized(F.lit(None).cast("date"), "en")) is None
    with pytest.raises(ValueError):
        dates.day_name_localized("d", "xx")


def test_epochs_and_rounding(spark):
    moment = dt.datetime(2021, 6, 7, 14, 35, 20)
    assert one(spark, dates.from_unix(F.lit(1623076520))) == moment
    assert one(spark, dates.from_unix(F.lit(1623076520000), "milliseconds")) == moment
    assert one(spark, dates.from_unix(F.lit(1623076520000000), "microseconds")) == moment
    assert one(spark, dates.from_unix(F.lit(1623076520000000000), "nanoseconds")) == moment
    assert one(spark, dates.to_unix(F.lit(moment))) == 1623076520
    assert one(spark, dates.round_to_day(F.lit(moment))) == dt.datetime(2021, 6, 8)
    zoned = dates.convert_timezone(F.lit(moment), "America/New_York")
    assert one(spark, zoned) == dt.datetime(2021, 6, 7, 10, 35, 20)
    assert one(spark, dates.round_to_day(zoned)) == dt.datetime(2021, 6, 7)
    with pytest.raises(ValueError):
        dates.from_unix(F.lit(1), "hours")


def test_parts_between_counts_boundaries(spark):
    a, b = F.lit(dt.datetime(2020, 12, 31, 23, 59)), F.lit(dt.datetime(2021, 1, 1, 0, 1))
    for part in ("day", "month", "quarter", "year", "hour"):
        assert one(spark, dates.parts_between(a, b, part)) == 1
        assert one(spark, dates.parts_between(b, a, part)) == -1
    assert one(spark, dates.parts_between(a, b, "week")) == 0
    assert one(spark, dates.parts_between(a, b, "minute")) == 2
    with pytest.raises(ValueError):
        dates.parts_between(a, b, "eon")


def test_whole_days_truncate_toward_zero(spark):
    due = dt.datetime(2018, 5, 10)
    cases = [(-47, -1), (-23, 0), (0, 0), (23, 0), (25, 1), (47, 1), (48, 2)]
    for hours, want in cases:
        actual = due + dt.timedelta(hours=hours)
        assert one(spark, dates.whole_days_between(F.lit(due), F.lit(actual))) == want


def test_add_parts(spark):
    start = F.lit(dt.datetime(2020, 1, 31))
    want = {
        "day": dt.datetime(2020, 2, 1),
        "week": dt.datetime(2020, 2, 7),
        "month": dt.datetime(2020, 2, 29),
        "quarter": dt.datetime(2020, 4, 30),
        "year": dt.datetime(2021, 1, 31),
        "hour": dt.datetime(2020, 1, 31, 1),
    }
    for part, moment in want.items():
        assert one(spark, dates.add_parts(part, 1, start)) == moment
    with pytest.raises(ValueError):
        dates.add_parts("eon", 1, start)


# --- business rules -------------------------------------------------------------------


def test_regions(spark):
    states = [("SP",), ("BA",), ("DF",), ("PR",), ("AM",), ("XX",), (None,)]
    assert values(spark, "s string", states, business.region_of("s")) == [
        "Southeast",
        "Northeast",
        "Central-West",
        "South",
        "North",
        "Unknown",
        "Unknown",
    ]
    assert sum(len(v) for v in business.REGION_STATES.values()) == 27
    df = spark.createDataFrame([("SP",)], "customer_state string")
    assert business.add_region(df).columns == ["customer_state", "customer_region"]


def test_nps_and_delay(spark):
    scores = [(5,), (4,), (3,), (2,), (1,), (None,)]
    assert values(spark, "s int", scores, business.nps_category("s")) == [
        "promoter",
        "promoter",
        "passive",
        "detractor",
        "detractor",
        None,
    ]
    days = [(-1,), (0,), (1,), (3,), (4,), (7,), (8,), (None,)]
    assert values(spark, "d int", days, business.delay_bin("d")) == [
        "early",
        "on-time",
        "1-3d late",
        "1-3d late",
        "4-7d late",
        "4-7d late",
        "7+d late",
        None,
    ]


SEGMENT_TABLE = {
    ("F1", 5): "Promising", ("F1", 4): "Promising", ("F1", 3): "Hibernating", ("F1", 2): "Hibernating",
    ("F1", 1): "Hibernating", ("F2", 5): "Loyal", ("F2", 4): "Loyal", ("F2", 3): "Loyal", ("F2", 2): "At Risk",
    ("F2", 1): "At Risk", ("F3", 5): "Champions", ("F3", 4): "Champions", ("F3", 3): "Loyal",
    ("F3", 2): "High Value Lost", ("F3", 1): "High Value Lost",
}


def test_segments(spark):
    data = [(r, f) for f, r in SEGMENT_TABLE]
    got = values(spark, "r int, f string", data, business.rfm_segment("r", "f"))
    assert got == list(SEGMENT_TABLE.values())


def test_seller_tiers(spark):
    data = [(4.0, 0.02), (4.0, 0.03), (3.5, 0.05), (3.0, 0.1), (2.9, 0.0), (5.0, 0.2), (None, 0.0)]
    got = values(spark, "s double, c double", data, business.seller_tier("s", "c"))
    assert got == ["Premium", "Good", "Good", "Average", "At Risk", "At Risk", "Unrated"]
