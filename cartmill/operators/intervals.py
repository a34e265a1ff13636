"""Which ranges contain a point, as an equi-join.

Every range goes to a level whose bins are just wide enough for it, each level's bins eight times as wide as those of the
one before. It then touches two bins at most, however long it is, and a point has one bin on every level in use. Points and
ranges meet by (level, bin), where ranges of like length stand together, so few of the pairs compared fail; a pair
meets in one bin only. Neither side is expanded to days, and an open range costs no more than another.

A bin that very many points share is split like any skewed key by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits by which bins grow from level to level.
_STEP = 3


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"{column} is {kind.simpleString()}; ranges are of dates, timestamps or whole numbers")


def _bin(number: Column, level: Column) -> Column:
    """Number of the bin, rounded towards minus infinity."""
    return F.call_function("shiftright", number, (level * _STEP).cast("int"))


def _level(length: int) -> int:
    """The first level whose bins are longer."""
    return 0 if length < 1 else -(-length.bit_length() // _STEP)


def join_containing(
    points: DataFrame,
    at: str,
    ranges: DataFrame,
    start: str,
    end: str,
    closed: str = "both",
    lengths: tuple[int, int] | None = None,
) -> DataFrame:
    """Each point with each range that contains it: columns of the points, then of the ranges.

    ``closed``: "both" or "left", whether the range holds its end. A null start or end leaves that side open; a null
    point is in no range; a range that ends before it starts holds nothing. All three columns are of one type: dates,
    timestamps or whole numbers. ``lengths``: least and greatest end - start, in days, microseconds or units, of ranges
    that are known to have none outside and no open side; then nothing is looked up before the join.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be both or left, got {closed!r}")
    first, last = _number(ranges, start), _number(ranges, end) - (0 if closed == "both" else 1)
    if lengths is None:
        limits = points.agg(F.min(_number(points, at)).alias("low"), F.max(_number(points, at)).alias("high")).first()
        low, high = (limits["low"], limits["high"]) if limits["low"] is not None else (0, -1)
        first = F.greatest(F.coalesce(first, F.lit(low)), F.lit(low))
        last = F.least(F.coalesce(last, F.lit(high)), F.lit(high))
        levels = range(_level(max(0, high - low)) + 1)
    else:
        levels = range(_level(lengths[0]), _level(lengths[1]) + 1)
    placed = ranges.withColumns({"_from": first, "_to": last}).filter(F.col("_from") <= F.col("_to"))
    level = F.lit(levels[0])
    for i in levels[1:]:
        level = F.when(F.col("_to") - F.col("_from") >= 1 << (_STEP * (i - 1)), i).otherwise(level)
    placed = placed.withColumn("_level", level)
    used = levels if lengths else [r["_level"] for r in placed.select("_level").distinct().collect()]  # 22 at most
    if not used:
        return points.join(ranges, F.lit(False))
    own = F.array(_bin(F.col("_from"), F.col("_level")), _bin(F.col("_to"), F.col("_level")))
    spread = placed.withColumn("_bin", F.explode(F.array_distinct(own)))
    bins = [F.struct(F.lit(i).alias("l"), _bin(F.col("_at"), F.lit(i)).alias("b")) for i in used]
    asked = points.withColumn("_at", _number(points, at)).filter(F.col("_at").isNotNull())
    asked = asked.withColumn("_place", F.explode(F.array(*bins)))
    asked = asked.withColumns({"_l": F.col("_place.l"), "_b": F.col("_place.b")})
    inside = (F.col("_l") == F.col("_level")) & (F.col("_b") == F.col("_bin"))
    inside = inside & F.col("_at").between(F.col("_from"), F.col("_to"))
    return asked.join(spread, inside).drop("_at", "_place", "_l", "_b", "_from", "_to", "_level", "_bin")
