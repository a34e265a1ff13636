"""Rank, running sums, neighbours and quantiles without one-task windows.

A window over a whole table, or over a group that may hold a third of it, ends up in one
task. Here rows are range-partitioned on (group, order), sorted locally and written once
with their position. Small per-partition totals then supply what each partition has to
add, whatever the group sizes are. Every input takes this path, so results and plans do
not change with its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmill.session import materialize

POSITION = "_position"
SLICE = "_slice"
TIE = "_tie"


def _spread(df: DataFrame, by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Globally sorted copy; the position is increasing across the whole result.

    A hash of the row settles ties the caller's order leaves, so that a value shared by many
    rows can be cut into several ranges. It is a pure function of the row: a task that runs
    again sends each row where the first attempt did. Only rows equal in every column stay
    together; they are sorted, never collected.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sort = [*[F.col(b).asc() for b in by], *order_by, F.col(TIE).asc()]
    marked = df.withColumn(TIE, row)
    ranged = marked.repartitionByRange(*sort).sortWithinPartitions(*sort).drop(TIE)
    placed = materialize(ranged.withColumn(POSITION, F.monotonically_increasing_id()))
    # the upper bits of the id are the partition, the lower 33 the row inside it
    return placed.withColumn(SLICE, F.shiftright(F.col(POSITION), 33))


def _attach(rows: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join per-slice totals back; NULL groups match."""
    renamed = totals
    condition = F.col(SLICE) == F.col("_t_slice")
    renamed = renamed.withColumnRenamed(SLICE, "_t_slice")
    for b in by:
        renamed = renamed.withColumnRenamed(b, f"_t_{b}")
        condition = condition & F.col(b).eqNullSafe(F.col(f"_t_{b}"))
    joined = rows.join(renamed, condition)
    return joined.drop("_t_slice", *[f"_t_{b}" for b in by])


def with_rank(
    df: DataFrame,
    order_by: Sequence[Column],
    by: Sequence[str] = (),
    rank: str = "rank",
    size: str = "group_rows",
    total: str | None = None,
    total_name: str = "group_total",
    running: str | None = None,
) -> DataFrame:
    """Append the 1-based rank within ``by`` and the group's row count.

    ``total`` names a column whose group sum is appended as ``total_name``; ``running``
    additionally asks for its running sum in rank order.
    """
    if running and not total:
        raise ValueError("a running sum needs the total column")
    rows = _spread(df, by, order_by)
    aggs = [F.min(POSITION).alias("_first"), F.count("*").alias("_n")]
    if total:
        aggs.append(F.sum(total).alias("_sum"))
    slices = rows.groupBy(*by, SLICE).agg(*aggs)
    # at most one row per (partition, group): windows here are over partition counts
    group = Window.partitionBy(*by)
    before = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    cols = [
        *by,
        F.col(SLICE),
        F.col("_first"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_n").over(group).alias(size),
    ]
    if total:
        cols.append(F.sum("_sum").over(group).alias(total_name))
        cols.append(F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"))
    joined = _attach(rows, slices.select(*cols), by)
    out = joined.withColumn(rank, F.col("_rows_before") + F.col(POSITION) - F.col("_first") + 1)
    if running:
        w = Window.partitionBy(*by, SLICE).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(running, F.col("_sum_before") + F.sum(total).over(w))
    return out.drop(POSITION, SLICE, "_first", "_rows_before", "_sum_before")


def with_neighbour(
    df: DataFrame,
    value: Column | str,
    order_by: Sequence[Column],
    by: Sequence[str] = (),
    name: str = "previous",
    offset: int = -1,
    flag: str | None = None,
) -> DataFrame:
    """Append the value of the row before (``offset`` -1) or after (+1) within ``by``.

    ``flag`` names a boolean column marking rows that have no such neighbour.
    """
    if offset not in (-1, 1):
        raise ValueError("offset must be -1 or 1")
    c = F.col(value) if isinstance(value, str) else value
    rows = _spread(df.withColumn("_value", c), by, order_by)
    edge = (F.max if offset < 0 else F.min)(POSITION)
    own = (F.min if offset < 0 else F.max)(POSITION)
    pick = F.max_by if offset < 0 else F.min_by
    slices = rows.groupBy(*by, SLICE).agg(
        own.alias("_own_edge"),
        edge.alias("_far_edge"),
        pick(F.struct("_value"), POSITION).alias("_edge_value"),
    )
    across = Window.partitionBy(*by).orderBy(F.col(SLICE).asc() if offset < 0 else F.col(SLICE).desc())
    slices = slices.select(
        *by, SLICE, "_own_edge", F.lag("_edge_value").over(across).alias("_outside")
    )
    joined = _attach(rows, slices, by)
    within = Window.partitionBy(*by, SLICE).orderBy(POSITION)
    inside = F.lag("_value").over(within) if offset < 0 else F.lead("_value").over(within)
    at_edge = F.col(POSITION) == F.col("_own_edge")
    out = joined.withColumn(name, F.when(at_edge, F.col("_outside._value")).otherwise(inside))
    if flag:
        out = out.withColumn(flag, at_edge & F.col("_outside").isNull())
    return out.drop("_value", POSITION, SLICE, "_own_edge", "_outside")


def with_halo(df: DataFrame, order_by: Sequence[Column], by: Sequence[str], rows: int, chunk: int = 1 << 16) -> DataFrame:
    """Cut each group into slices of ``chunk`` rows in order, each preceded by the last ``rows`` of the slice before.

    Adds ``_slice`` and ``_own``, false for the rows lent to the next slice: a window over (by, _slice) that looks back
    ``rows`` rows at most is right for a slice's own rows, and no group has to fit one task.
    """
    chunk = max(chunk, rows)
    ranked = with_rank(df, order_by, by, rank="_rank", size="_rows")
    at, first = F.col("_rank") - 1, (F.col("_rank") - 1) % chunk
    mine = F.struct((F.floor(at / chunk)).cast("bigint").alias("s"), F.lit(True).alias("own"))
    lent = F.struct((F.floor(at / chunk) + 1).cast("bigint").alias("s"), F.lit(False).alias("own"))
    places = F.when(first >= chunk - rows, F.array(mine, lent)).otherwise(F.array(mine))
    placed = ranked.withColumn("_place", F.explode(places))
    return placed.withColumns({"_slice": F.col("_place.s"), "_own": F.col("_place.own")}).drop("_rank", "_rows", "_place")


#: Share of the rows on either side of a quantile that a sketch with errors up to 1 / ``ACCURACY`` is asked for.
MARGIN, ACCURACY = 0.001, 10_000
#: Groups of fewer rows are counted whole: there the margin may hold less than the two rows a quantile lies between.
SMALL_GROUP = 4096


def exact_quantiles(
    df: DataFrame, value: str, quantiles: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles q0, q1, ... per group, for any number of values.

    A quantile sketch of each group names two values that surely have the quantile between them. Of the rows below the
    lower one only the number counts, those above the upper one do not matter, so what is left to sort is a small part
    of the distinct values.
    """
    for q in quantiles:
        if not 0 <= q <= 1:
            raise ValueError(f"quantile out of range: {q}")
    rows = df.filter(F.col(value).isNotNull()).select(*by, value, F.col(value).cast("double").alias("_number"))
    asked = [p for q in quantiles for p in (max(0.0, q - MARGIN), min(1.0, q + MARGIN))]
    limits = rows.groupBy(*by).agg(
        F.count("*").alias("_size"),
        F.percentile_approx("_number", [float(p) for p in asked], ACCURACY).alias("_limits"),
    )
    if by:
        named = limits.withColumnsRenamed({b: f"_l_{b}" for b in by})
        same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_l_{b}")) for b in by])
        bounded = rows.join(named, same).drop(*[f"_l_{b}" for b in by])
    else:
        bounded = rows.crossJoin(F.broadcast(limits))  # one row
    large = F.col("_size") >= SMALL_GROUP
    sides = [
        F.struct(
            F.lit(i).alias("i"),
            # what lies below is one value, NULL, which sorts first
            F.when(~large | (F.col("_number") >= F.col("_limits")[2 * i]), F.col(value)).alias("v"),
            (~large | (F.col("_number") <= F.col("_limits")[2 * i + 1])).alias("keep"),
        )
        for i in range(len(quantiles))
    ]
    kept = bounded.select(*by, "_size", F.explode(F.filter(F.array(*sides), lambda s: s["keep"])).alias("_s"))
    counted = kept.groupBy(*by, F.col("_s.i").alias("_i"), F.col("_s.v").alias("_v")).agg(
        F.count("*").alias("_count"), F.first("_size").alias("_size")
    )
    ranked = with_rank(
        counted, [F.col("_v").asc_nulls_first()], [*by, "_i"], total="_count", total_name="_kept", running="_upto"
    )
    place = (F.col("_size") - 1) * F.element_at(F.array(*[F.lit(float(q)) for q in quantiles]), F.col("_i") + 1)
    edges = ranked.groupBy(*by, "_i").agg(
        F.min(F.when(F.col("_upto") > F.floor(place), F.col("_v"))).alias("_low"),
        F.min(F.when(F.col("_upto") > F.ceil(place), F.col("_v"))).alias("_high"),
        F.max(place - F.floor(place)).alias("_share"),
    )
    between = (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).cast("double")
    picks = [F.max(F.when(F.col("_i") == i, between)).alias(f"q{i}") for i in range(len(quantiles))]
    return edges.groupBy(*by).agg(*picks)
