"""The most frequent values, counted exactly without shuffling all values.

A sketch of frequent items, kept in each task and merged, names candidates, those whose count surely exceeds its error,
with upper bounds. Whatever it does not name has at most twice the error or, where the list is full, the last bound. The candidates are then counted
exactly, in one row per candidate and task. If the last of the values asked for has more than what any other value can
have, the result is certain, ties included; otherwise all values are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values a sketch tracks, a power of two, and candidates taken from it at least.
TRACKED, CANDIDATES = 1 << 16, 1000
#: A sketch's error is at most this share of the rows by the number of values tracked.
_ERROR = 3.5
_SIMPLE = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.BooleanType)


def candidate_counts(df: DataFrame, value: Column, kind: T.DataType, n: int) -> DataFrame | None:
    """(value_field, n_rows) of values that are sure to include the ``n`` most frequent, or None if that is not sure.

    NULL is a value.
    """
    if not isinstance(kind, _SIMPLE):
        return None
    most = max(CANDIDATES, 2 * n)
    rows = df.select(value.alias("value_field"))
    sketch = F.call_function("approx_top_k", F.col("value_field"), F.lit(most), F.lit(max(TRACKED, most)))
    seen = rows.agg(F.count("value_field").alias("n"), sketch.alias("top")).first()
    top, others = seen["top"] or (), 0
    if sum(r["count"] for r in top) != seen["n"]:  # else it has tracked every value
        others = 2 * _ERROR * seen["n"] / max(TRACKED, most)
        if len(top) >= most:
            others = max(others, *(r["count"] for r in top[-1:]))
    named = [r["item"] for r in top if r["item"] is not None]
    schema = T.StructType([T.StructField("value_field", kind)])
    asked = F.broadcast(df.sparkSession.createDataFrame([(v,) for v in [*named, None]], schema))
    mine = asked.withColumnRenamed("value_field", "_named")
    found = rows.join(mine, F.col("value_field").eqNullSafe(F.col("_named")), "left_semi")
    counted = found.groupBy("value_field").agg(F.count("*").alias("n_rows"))
    best = counted.orderBy(F.desc("n_rows")).limit(n).collect()
    if others and (len(best) < n or best[-1]["n_rows"] <= others):
        return None
    return counted


def most_frequent(df: DataFrame, value: Column, kind: T.DataType, n: int) -> DataFrame:
    """(value_field, n_rows) of the ``n`` most frequent values, most frequent first, ties by value."""
    counted = candidate_counts(df, value, kind, n)
    if counted is None:
        counted = df.groupBy(value.alias("value_field")).agg(F.count("*").alias("n_rows"))
    return counted.orderBy(F.desc("n_rows"), F.asc("value_field")).limit(n)
