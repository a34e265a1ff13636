"""Arithmetic, hashing, regular-expression and geographic column builders."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Null placeholder and separator that published surrogate keys depend on.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# Earth radius in miles and kilometres per mile of the distance formula.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def to_column(value) -> Column:
    """Accept a column name or a Column."""
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*fields, treat_nulls_as_empty: bool = False) -> Column:
    """md5 over the fields' text, with NULLs kept distinguishable from ''."""
    if not fields:
        raise ValueError("a surrogate key needs at least one field")
    filler = F.lit("" if treat_nulls_as_empty else SURROGATE_NULL)
    texts = [F.coalesce(to_column(f).cast("string"), filler) for f in fields]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *texts))


def blank_to_null(value) -> Column:
    """Empty or whitespace-only text becomes NULL, other text is left untouched."""
    c = to_column(value)
    return F.when(F.trim(c) != "", c)


def safe_add(*values) -> Column:
    if not values:
        raise ValueError("safe_add needs at least one value")
    return reduce(lambda a, b: a + b, [F.coalesce(to_column(v), F.lit(0)) for v in values])


def safe_subtract(*values) -> Column:
    if not values:
        raise ValueError("safe_subtract needs at least one value")
    return reduce(lambda a, b: a - b, [F.coalesce(to_column(v), F.lit(0)) for v in values])


def safe_divide(numerator, denominator) -> Column:
    """NULL instead of an error for a zero denominator."""
    return F.try_divide(to_column(numerator), to_column(denominator))


def at_least(value, floor) -> Column:
    """Raise small values to ``floor`` but keep NULL (Spark's greatest would drop it)."""
    c = to_column(value)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def width_bucket(value, low, high, buckets: int) -> Column:
    """Equal-width bucket number: 0 below ``low``, ``buckets`` + 1 from ``high`` on."""
    return F.width_bucket(to_column(value), F.lit(low), F.lit(high), F.lit(buckets))


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    a1, o1, a2, o2 = (F.radians(to_column(v)) for v in (lat1, lon1, lat2, lon2))
    half_lat = F.sin((a2 - a1) / 2)
    half_lon = F.sin((o2 - o1) / 2)
    chord = half_lat * half_lat + F.cos(a1) * F.cos(a2) * half_lon * half_lon
    miles = F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord))
    return miles * F.lit(KM_PER_MILE) if unit == "km" else miles


def natural_log(value) -> Column:
    return F.ln(to_column(value))


def text_md5(value) -> Column:
    return F.md5(to_column(value).cast("string"))


def regex_position(value, pattern: str, position: int = 1, occurrence: int = 1, flags: str = "") -> Column:
    """1-based position of the n-th match at or after ``position``; 0 when there is none."""
    if position < 1 or occurrence < 1:
        raise ValueError("position and occurrence start at 1")
    unknown = set(flags) - set("imsx")
    if unknown:
        raise ValueError(f"unsupported regex flags: {sorted(unknown)}")
    rx = f"(?{flags}){pattern}" if flags else pattern
    c = to_column(value)
    rest = c if position == 1 else F.substring(c, position, 2_147_483_647)
    if occurrence == 1:
        found = F.regexp_instr(rest, F.lit(rx))
    else:
        # cut the text after the (n-1)-th match and look for one more
        skip = rf"^(?s:(?:.*?(?:{rx})){{{occurrence - 1}}})"
        head = F.regexp_extract(rest, skip, 0)
        tail = F.substring(rest, F.length(head) + 1, F.lit(2_147_483_647))
        in_tail = F.regexp_instr(tail, F.lit(rx))
        found = F.when(
            (F.regexp_instr(rest, F.lit(skip)) > 0) & (in_tail > 0), F.length(head) + in_tail
        ).otherwise(F.when(c.isNull(), F.lit(None)).otherwise(F.lit(0)))
    if position == 1:
        return found
    return F.when(found > 0, found + (position - 1)).otherwise(found)


def slugify_text(name: str) -> str:
    """Turn a label into an identifier."""
    if not name:
        return ""
    slug = re.sub(r"[ -]+", "_", name.lower())
    slug = re.sub(r"[^a-z0-9_]+", "", slug)
    return "_" + slug if slug[:1].isdigit() else slug


def slugify(value) -> Column:
    """Column form of :func:`slugify_text`."""
    c = F.regexp_replace(F.lower(to_column(value)), "[ -]+", "_")
    c = F.regexp_replace(c, "[^a-z0-9_]+", "")
    return F.regexp_replace(c, "^([0-9])", "_$1")
