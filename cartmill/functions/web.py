"""URL pieces by text rules, so scheme-less and app URLs are accepted too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartmill.functions.scalars import to_column


def _without(c: Column, *schemes: str) -> Column:
    for scheme in schemes:
        c = F.replace(c, F.lit(scheme), F.lit(""))
    return c


def _before(c: Column, mark: str) -> Column:
    return F.split_part(c, F.lit(mark), F.lit(1))


def url_host(value) -> Column:
    """Text before the first '/' or '?' once the scheme is removed."""
    bare = _without(to_column(value), "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def url_path(value) -> Column:
    """Text after the first '/' (or from the '?' on when there is no '/'), without the query."""
    bare = _without(to_column(value), "http://", "https://")
    slash = F.locate("/", bare)
    start = F.when(slash > 0, slash).otherwise(F.locate("?", bare) - 1)
    # right() with a length beyond the text returns the whole text
    return _before(F.right(bare, F.length(bare) - start), "?")


def url_parameter(value, name: str) -> Column:
    """Text between ``name=`` and the next '&'; NULL when absent or empty."""
    found = _before(F.split_part(to_column(value), F.lit(f"{name}="), F.lit(2)), "&")
    return F.when(found != "", found)
