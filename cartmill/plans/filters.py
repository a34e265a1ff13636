"""Report filters as one predicate, so they reach the Parquet scan of a gold extract."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FULL_FILTERS = ("date", "category", "state", "region")
GEO_FILTERS = ("month", "state", "region")
PLACE_FILTERS = ("state", "region")

# Columns each list filter looks for, first match wins.
LIST_COLUMNS = {
    "category": ("product_category_name_english", "primary_product_category"),
    "state": ("customer_state", "seller_state"),
    "region": ("customer_region", "seller_region", "region"),
}


@dataclass(frozen=True)
class FilterSpec:
    """Inclusive date range and value lists; an empty list means no restriction."""

    start: str | None = None
    end: str | None = None
    categories: Sequence[str] = ()
    states: Sequence[str] = ()
    regions: Sequence[str] = ()


def _date_predicate(spec: FilterSpec) -> Column:
    out = F.lit(True)
    if spec.start:
        out = out & (F.col("date_key") >= F.lit(spec.start).cast("date"))
    if spec.end:
        out = out & (F.col("date_key") <= F.lit(spec.end).cast("date"))
    return out


def _month_predicate(spec: FilterSpec) -> Column:
    """Whole months: year * 100 + month between the months of the range's ends."""
    month = F.col("year") * 100 + F.col("month")
    out = F.lit(True)
    if spec.start:
        out = out & (month >= int(spec.start[:4]) * 100 + int(spec.start[5:7]))
    if spec.end:
        out = out & (month <= int(spec.end[:4]) * 100 + int(spec.end[5:7]))
    return out


def _apply(df: DataFrame, spec: FilterSpec, kinds: Sequence[str]) -> DataFrame:
    predicate = F.lit(True)
    if "date" in kinds and "date_key" in df.columns:
        predicate = predicate & _date_predicate(spec)
    if "month" in kinds:
        predicate = predicate & _month_predicate(spec)
    lists = {"category": spec.categories, "state": spec.states, "region": spec.regions}
    for kind, values in lists.items():
        column = next((c for c in LIST_COLUMNS[kind] if c in df.columns), None)
        if kind in kinds and values and column:
            predicate = predicate & F.col(column).isin(*values)
    return df.filter(predicate)


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return _apply(df, spec, FULL_FILTERS)


def apply_geo_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return _apply(df, spec, GEO_FILTERS)


def apply_rfm_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return _apply(df, spec, PLACE_FILTERS)


def apply_seller_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return _apply(df, spec, PLACE_FILTERS)


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values offered for a list filter."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
