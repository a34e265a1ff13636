"""Comparing tables that are nearly equal, without moving the rows they share.

Both tables are condensed to sums of two 64-bit hashes per bucket, combined in each task, so that order does not matter
and repeated rows count. Only buckets whose sums differ are looked into; equal tables exchange some thousand rows of
sums, whatever their size. (Differing buckets with equal sums would take an accident of some 1 in 2**120.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _hash(columns: Sequence[str], seed: int) -> Column:
    """Of values and of which are null; values of other types have other hashes."""
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def bucket_of(columns: Sequence[str]) -> Column:
    return F.pmod(_hash(columns, 1), F.lit(BUCKETS)).cast("int")


def bucket_sums(df: DataFrame, columns: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
    """(bucket, n, a, b) of the rows; buckets go by ``keys``, or by whole rows."""
    hashes = [F.sum(_hash(columns, s).cast("decimal(38,0)")) for s in (2, 3)]
    bucket = bucket_of(keys or columns).alias("bucket")
    return df.groupBy(bucket).agg(F.count("*").alias("n"), hashes[0].alias("a"), hashes[1].alias("b"))


def differing_buckets(left: DataFrame, right: DataFrame, columns: Sequence[str], keys: Sequence[str] | None = None) -> list[int]:
    """Buckets whose rows are not the same on both sides; there are ``BUCKETS`` at most."""
    both = bucket_sums(left, columns, keys).unionAll(bucket_sums(right.select(left.columns), columns, keys))
    per_bucket = both.groupBy("bucket").agg(
        F.count("*").alias("sides"), *[(F.min(c) != F.max(c)).alias(c) for c in ("n", "a", "b")]
    )
    return [r["bucket"] for r in per_bucket.filter("sides < 2 or n or a or b").select("bucket").collect()]


def only_differing(
    left: DataFrame, right: DataFrame, columns: Sequence[str], keys: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both tables without the buckets they agree on."""
    buckets = differing_buckets(left, right, columns, keys)
    if len(buckets) == BUCKETS:
        return left, right
    inside = bucket_of(keys or columns).isin(*buckets) if buckets else F.lit(False)
    return left.filter(inside), right.filter(inside)


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(keys, change, differing): keys that were 'added', 'removed' or 'changed', and the columns that changed.

    Keys are unique on either side; a null key matches a null key, a null value equals a null value.
    """
    own = [c for c in (columns or before.columns) if c not in keys]
    chosen = [*keys, *own]
    a, b = only_differing(before.select(chosen), after.select(chosen), chosen, keys)
    a = a.select(F.lit(True).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in chosen])
    b = b.select(F.lit(True).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in chosen])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
    joined = a.join(b, same, "full")
    changed = [F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.lit(c)) for c in own]
    found = joined.select(
        *[F.when(F.col("_a"), F.col(f"_a_{k}")).otherwise(F.col(f"_b_{k}")).alias(k) for k in keys],
        F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed").alias("change"),
        F.when(F.col("_a") & F.col("_b"), F.concat_ws(",", *changed)).alias("differing"),
    )
    return found.filter((F.col("change") != "changed") | (F.col("differing") != ""))
