"""Lorenz, Gini, Herfindahl and top-share statistics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.operators.ranking import with_rank

# Market-share index below which a market counts as diversified.
DIVERSIFIED_BELOW = 1500


def _usable(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull() & ~F.isnan(v)).withColumn(value, v)


def lorenz_curve(df: DataFrame, value: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Points (x, y): share of entities against share of value, poorest first, from (0, 0)."""
    ranked = with_rank(
        _usable(df, value), [F.col(value).asc(), F.col(key).asc()], by,
        total=value, running="_upto",
    )
    points = ranked.select(
        *by,
        (F.col("rank") / F.col("group_rows")).alias("x"),
        F.try_divide(F.col("_upto"), F.col("group_total")).alias("y"),
    )
    origin = _usable(df, value).groupBy(*by).agg(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return points.unionByName(origin)


def pareto_curve(df: DataFrame, value: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Richest first: cumulative percent of value against cumulative percent of entities."""
    ranked = with_rank(
        _usable(df, value), [F.col(value).desc(), F.col(key).asc()], by,
        total=value, running="_upto",
    )
    return ranked.select(
        *by,
        key,
        value,
        "rank",
        (100 * F.col("rank") / F.col("group_rows")).alias("entity_pct"),
        (100 * F.try_divide(F.col("_upto"), F.col("group_total"))).alias("cum_value_pct"),
    )


def share_reaching(pareto: DataFrame, percent: float = 80.0, by: Sequence[str] = ()) -> DataFrame:
    """Smallest percent of entities whose value adds up to at least ``percent``."""
    reached = pareto.filter(F.col("cum_value_pct") >= percent)
    return reached.groupBy(*by).agg(F.min("entity_pct").alias("entity_pct"))


def top_count(rows: Column, divisor: int = 5, rounding: str = "ceil") -> Column:
    """Entities in the top 1/divisor, at least one."""
    if rounding == "ceil":
        n = F.floor((rows + (divisor - 1)) / divisor)
    elif rounding == "floor":
        n = F.floor(rows / divisor)
    else:
        raise ValueError(f"rounding must be 'ceil' or 'floor', got {rounding!r}")
    return F.greatest(F.lit(1), n)


def hhi(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum of squared shares times 10 000; no ordering needed."""
    v = F.col(value)
    return (
        _usable(df, value)
        .groupBy(*by)
        .agg((F.try_divide(F.sum(v * v), F.sum(v) * F.sum(v)) * 10_000).alias("hhi"))
    )


def concentration_summary(
    df: DataFrame,
    value: str,
    key: str,
    by: Sequence[str] = (),
    top: Sequence[int] = (4, 10),
    rounding: str | Sequence[str] = "ceil",
    min_entities: int = 1,
) -> DataFrame:
    """Gini, HHI, top-k shares, top-20 % share and entity count in one pass per group.

    Several roundings give a column each, named after them.
    """
    names = {"top_20pct_share": rounding} if isinstance(rounding, str) else {f"top_20pct_share_{m}": m for m in rounding}
    v, r, n, t = F.col(value), F.col("rank"), F.col("group_rows"), F.col("group_total")
    ranked = with_rank(_usable(df, value), [v.desc(), F.col(key).asc()], by, total=value)
    # with the richest ranked first, the ascending rank is n - r + 1
    weight = n + 1 - 2 * r
    shares = [
        F.when(F.max(n) >= k, F.try_divide(F.sum(F.when(r <= k, v).otherwise(0.0)), F.max(t))).alias(f"cr{k}")
        for k in top
    ]
    grouped = ranked.groupBy(*by).agg(
        F.try_divide(F.sum(weight * v), F.max(n) * F.max(t)).alias("gini"),
        *shares,
        (F.try_divide(F.sum(v * v), F.max(t) * F.max(t)) * 10_000).alias("hhi"),
        F.max(n).alias("n_entities"),
        *[
            F.try_divide(F.sum(F.when(r <= top_count(n, 5, mode), v).otherwise(0.0)), F.max(t)).alias(name)
            for name, mode in names.items()
        ],
    )
    return grouped.filter(F.col("n_entities") >= min_entities)


def gini(df: DataFrame, value: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    return concentration_summary(df, value, key, by, top=()).select(*by, "gini")


def top_share(df: DataFrame, value: str, key: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Share of the k largest entities; NULL for groups with fewer than k."""
    return concentration_summary(df, value, key, by, top=(k,)).select(*by, f"cr{k}")


def diversification(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        "market", F.when(F.col("hhi") < DIVERSIFIED_BELOW, "diversified").otherwise("concentrated")
    )
