"""Marketplace rules as columns: scores, bins, tiers, segments and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.functions.scalars import to_column

# State codes of the five macro-regions.
REGION_STATES = {
    "North": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Northeast": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Central-West": ("DF", "GO", "MS", "MT"),
    "Southeast": ("ES", "MG", "RJ", "SP"),
    "South": ("PR", "RS", "SC"),
}
UNKNOWN_REGION = "Unknown"

# Labels in report order.
DELAY_BINS = ("early", "on-time", "1-3d late", "4-7d late", "7+d late")
SEGMENTS = ("Champions", "Loyal", "Promising", "At Risk", "High Value Lost", "Hibernating")
SELLER_TIERS = ("Premium", "Good", "Average", "At Risk", "Unrated")


def region_of(state) -> Column:
    c = to_column(state)
    out = F.lit(UNKNOWN_REGION)
    for region, states in REGION_STATES.items():
        out = F.when(c.isin(*states), F.lit(region)).otherwise(out)
    return out


def region_column_name(state_col: str) -> str:
    return state_col.replace("_state", "_region")


def add_region(df: DataFrame, state_col: str = "customer_state", regions: DataFrame | None = None) -> DataFrame:
    """Append the macro-region of ``state_col``.

    ``regions(state, region)`` replaces the built-in mapping for other geographies.
    """
    out = region_column_name(state_col)
    if regions is None:
        return df.withColumn(out, region_of(state_col))
    lookup = regions.select(F.col("state").alias(state_col), F.col("region").alias(out))
    return df.join(lookup, state_col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(UNKNOWN_REGION)))


def nps_category(score) -> Column:
    c = to_column(score)
    return F.when(c >= 4, "promoter").when(c == 3, "passive").when(c <= 2, "detractor")


def delay_bin(days) -> Column:
    c = to_column(days)
    early, on_time, short, medium, long = DELAY_BINS
    return (
        F.when(c < 0, early)
        .when(c == 0, on_time)
        .when(c <= 3, short)
        .when(c <= 7, medium)
        .when(c.isNotNull(), long)
    )


def frequency_tier(orders) -> Column:
    c = to_column(orders)
    return F.when(c == 1, "F1").when(c == 2, "F2").otherwise("F3")


def rfm_segment(r_score, f_tier) -> Column:
    """First matching rule wins, so a recent repeat buyer is Loyal before At Risk is tried."""
    r, f = to_column(r_score), to_column(f_tier)
    repeat = f.isin("F2", "F3")
    return (
        F.when((r >= 4) & (f == "F3"), "Champions")
        .when((r >= 3) & repeat, "Loyal")
        .when((r >= 4) & (f == "F1"), "Promising")
        .when((r <= 2) & (f == "F3"), "High Value Lost")
        .when((r <= 2) & repeat, "At Risk")
        .otherwise("Hibernating")
    )


def seller_tier(score, cancellation_rate) -> Column:
    s, c = to_column(score), to_column(cancellation_rate)
    return (
        F.when(s.isNull(), "Unrated")
        .when((s >= 4.0) & (c <= 0.02), "Premium")
        .when((s >= 3.5) & (c <= 0.05), "Good")
        .when((s >= 3.0) & (c <= 0.10), "Average")
        .otherwise("At Risk")
    )


def position_in(value, labels) -> Column:
    """0-based place of a label in a fixed report order, for sorting."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), to_column(value)) - 1
