"""Profiling and referential-integrity reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.operators.frequent import most_frequent
from cartmill.operators.core_checks import not_null_proportion
from cartmill.operators.relational import rows_with_parent, rows_without_parent


def _blank(c: Column, text: bool) -> Column:
    return (c.isNull() | (F.trim(c) == "")) if text else c.isNull()


def _per_column(df: DataFrame, measures: Mapping[str, Mapping[str, Column]], columns: Sequence[str]) -> DataFrame:
    """One scan computing every measure of every column, turned into one row per column."""
    aggs = [c.alias(f"{i}_{m}") for i, col in enumerate(columns) for m, c in measures[col].items()]
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(col).alias("column_name"), *[F.col(f"{i}_{m}").alias(m) for m in measures[col]])
            for i, col in enumerate(columns)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString() == "string"


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Blank cells per column, columns without any left out."""
    chosen = list(columns or df.columns)
    measures = {c: {"blank_count": F.count_if(_blank(F.col(c), _is_text(df, c)))} for c in chosen}
    return _per_column(df, measures, chosen).filter("blank_count > 0")


def null_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table, column, total, nulls, percent) for chosen columns of several tables."""
    out = None
    for name, (df, columns) in tables.items():
        measures = {
            c: {"total_rows": F.count("*"), "null_count": F.count_if(F.col(c).isNull())} for c in columns
        }
        part = _per_column(df, measures, columns).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    pct = F.round(100 * F.try_divide(F.col("null_count"), F.col("total_rows")), 2)
    return out.withColumn("null_pct", pct)


def empty_string_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures = {
        c: {"total_rows": F.count("*"), "empty_count": F.count_if(F.col(c) == "")} for c in columns
    }
    pct = F.round(100 * F.try_divide(F.col("empty_count"), F.col("total_rows")), 2)
    return _per_column(df, measures, columns).withColumn("empty_pct", pct)


def value_distribution(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Counts per value, most common first."""
    source = df if where is None else df.filter(where)
    counted = source.groupBy(column).agg(F.count("*").alias("n_rows"))
    return counted.orderBy(F.desc("n_rows"), F.asc(column))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most common values, ties by value; see ``frequent``."""
    found = most_frequent(df, F.col(column), df.schema[column].dataType, n)
    return found.withColumnRenamed("value_field", column)


def numeric_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures = {
        c: {
            "min_value": F.min(c).cast("double"),
            "max_value": F.max(c).cast("double"),
            "not_positive": F.count_if(F.col(c) <= 0),
            "negative": F.count_if(F.col(c) < 0),
        }
        for c in columns
    }
    return _per_column(df, measures, columns)


def key_multiplicity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, repeated keys, largest and mean group size."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("repeated_keys"),
        F.max("_n").alias("max_rows_per_key"),
        F.avg("_n").alias("avg_rows_per_key"),
    )


# Postal codes are five digits.
ZIP_PATTERN = "^[0-9]{5}$"


def format_violations(df: DataFrame, column: str, pattern: str = ZIP_PATTERN) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), F.count_if(~F.col(column).rlike(pattern)).alias("violations")
    )


def box_outliers(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside [low, high] per coordinate."""
    aggs = [F.count_if(~F.col(c).between(low, high)).alias(f"{c}_outside") for c, (low, high) in limits.items()]
    return df.agg(*aggs)


def match_rate(df: DataFrame, key: str, reference: DataFrame, reference_key: str) -> DataFrame:
    """Share of distinct keys and of rows found in a reference key set."""
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    known = reference.select(F.col(reference_key).alias("_known")).distinct()
    joined = per_key.join(known, F.col("_key") == F.col("_known"), "left")
    hit = F.col("_known").isNotNull()
    return joined.agg(
        F.count("*").alias("distinct_keys"),
        F.count_if(hit).alias("matched_keys"),
        F.sum("_n").alias("total_rows"),
        F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias("matched_rows"),
    ).select(
        "*",
        F.try_divide(F.col("matched_keys"), F.col("distinct_keys")).alias("key_match_rate"),
        F.try_divide(F.col("matched_rows"), F.col("total_rows")).alias("row_match_rate"),
    )


def missing_keys(pairs: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per named pair, how many distinct keys of the first table the second lacks."""
    out = None
    for name, (left, left_key, right, right_key) in pairs.items():
        # distinct keys first, so that frequent keys reach the join once
        lost = rows_without_parent(left.select(left_key).distinct(), right, left_key, right_key)
        part = lost.agg(F.count("*").alias("missing_keys")).select(F.lit(name).alias("pair"), "missing_keys")
        out = part if out is None else out.unionByName(part)
    return out


def itemless_orders(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders without items per status, and how many of them were reviewed."""
    empty = rows_without_parent(orders, items, "order_id", "order_id")
    reviewed = rows_with_parent(empty, reviews, "order_id", "order_id").select("order_id", F.lit(1).alias("_r"))
    joined = empty.join(reviewed, "order_id", "left")
    return joined.groupBy("order_status").agg(
        F.count("*").alias("itemless_orders"), F.count("_r").alias("reviewed_orders")
    )


def values_missing_from(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Distinct non-blank values the other table does not list."""
    used = df.filter(F.trim(column) != "").select(column).distinct()
    return rows_without_parent(used, other, column, other_column)


# Least filled share per column.
FILL_THRESHOLDS = {"review_comment_title": 0.08, "review_comment_message": 0.40, "geolocation_lat": 0.97}


def fill_rate_violations(df: DataFrame, column: str, mostly: float) -> DataFrame:
    """One row when the share of non-blank cells is below ``mostly``."""
    filled = df.select(F.when(~_blank(F.col(column), _is_text(df, column)), F.lit(1)).alias(column))
    return not_null_proportion(filled, column, at_least=mostly)


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tidy (table, column, metric, value) profile of whole tables, one scan each."""
    out = None
    for name, df in tables.items():
        columns = df.columns
        measures = {
            c: {
                "rows": F.count("*"),
                "blanks": F.count_if(_blank(F.col(c), _is_text(df, c))),
                "filled": F.count(c),
            }
            for c in columns
        }
        wide = _per_column(df, measures, columns)
        part = wide.unpivot(["column_name"], ["rows", "blanks", "filled"], "metric", "value")
        part = part.select(F.lit(name).alias("table_name"), "column_name", "metric", "value")
        out = part if out is None else out.unionByName(part)
    return out


def write_profile(report: DataFrame, path: str) -> None:
    """JSON sink, one line per metric, partitioned by table."""
    report.write.mode("overwrite").partitionBy("table_name").json(path)
