"""Relational helpers: series, deduplication, pivoting, unions, joins and lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartmill.functions.dates import SUB_DAY, add_parts, parts_between
from cartmill.functions.scalars import slugify_text
from cartmill.operators import membership
from cartmill.operators.intervals import join_containing

AGGREGATES: Mapping[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
}


# --- series ---------------------------------------------------------------------------


def bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row (start, end) from literals, as input of :func:`date_spine`."""
    return spark.range(1).select(
        F.lit(start).cast("timestamp").alias("start"), F.lit(end).cast("timestamp").alias("end")
    )


SERIES_CHUNK = 1 << 16


def _numbered(limits: DataFrame, count: str, *keep: str) -> DataFrame:
    """Rows ``_i`` = 0 .. count - 1 for each row of ``limits``.

    The first explosion makes a row for each chunk; these are dealt out, and every task makes the
    numbers of its chunks. So a series neither meets the limit of arrays nor fills one task.
    """
    n = F.col(count).cast("bigint")
    last = F.floor((n - 1) / SERIES_CHUNK).cast("bigint")
    chunks = limits.filter(n > 0).select(*keep, n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_c"))
    first = F.col("_c") * SERIES_CHUNK
    inside = F.sequence(first, F.least(first + SERIES_CHUNK, F.col("_n")) - 1)
    return chunks.repartition("_c").select(*keep, F.explode(inside).alias("_i"))


def numbers_up_to(limits: DataFrame, count: str, name: str = "generated_number") -> DataFrame:
    """Numbers 1 .. n, n being a column of the one-row frame ``limits``, such as a count."""
    return _numbered(limits, count).select((F.col("_i") + 1).alias(name))


def date_spine(limits: DataFrame, part: str = "day", name: str | None = None) -> DataFrame:
    """One row per ``part`` from ``start`` up to but excluding ``end``.

    ``limits`` is a one-row frame with columns start and end, e.g. min and max of a fact.
    """
    name = name or f"date_{part}"
    series = _numbered(limits.withColumn("_steps", parts_between("start", "end", part)), "_steps", "start")
    moment = add_parts(part, F.col("_i"), "start")
    return series.select((moment if part in SUB_DAY else moment.cast("date")).alias(name))


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """Numbers 1 .. ``upper``."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).select(F.col("id").alias("generated_number"))


# --- row selection --------------------------------------------------------------------


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark plans the row_number filter as a limit per key before the shuffle, so a key
    holding most of the table still sends one row per input partition.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_latest(df: DataFrame, keys: Sequence[str], moment: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Row with the greatest ``moment`` per key; NULL moments lose, ties by ``tie_break``."""
    return deduplicate(df, keys, [F.col(moment).desc(), *[F.col(t).desc() for t in tie_break]])


def select_except(df: DataFrame, except_: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but some (names compared without case), optionally renamed."""
    dropped = {c.lower() for c in except_}
    kept = [c for c in df.columns if c.lower() not in dropped]
    return df.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in kept])


def null_check_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """'' becomes NULL in the given (default: all) text columns."""
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    chosen = text if columns is None else text & set(columns)
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in chosen else F.col(c) for c in df.columns])


# --- reshaping ------------------------------------------------------------------------

COMPARISONS: Mapping[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def pivot_columns(
    column: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    distinct: bool = False,
    slug_names: bool = False,
) -> list[Column]:
    """One conditional aggregate per value; use inside ``groupBy(...).agg(*...)``."""
    compare = COMPARISONS[cmp]
    out = []
    for value in values:
        hit = F.when(compare(F.col(column), F.lit(value)), _value(then_value)).otherwise(_value(else_value))
        if distinct and agg == "count":
            measured = F.count_distinct(hit)
        elif distinct and agg == "sum":
            measured = F.sum_distinct(hit)
        else:
            measured = AGGREGATES[agg](hit)
        name = f"{prefix}{value}{suffix}"
        out.append(measured.alias(slugify_text(name) if slug_names else name))
    return out


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def unpivot(
    df: DataFrame,
    keep: Sequence[str] = (),
    remove: Sequence[str] = (),
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in a single scan; ``keep`` columns repeat, ``remove`` are dropped."""
    skip = {c.lower() for c in (*keep, *remove)}
    measures = [c for c in df.columns if c.lower() not in skip]
    narrow = df.select(*keep, *[F.col(c).cast(cast_to).alias(c) for c in measures])
    return narrow.unpivot(list(keep), measures, field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column: str | None = "source_relation",
    where: Column | str | None = None,
) -> DataFrame:
    """UNION ALL by column name over the superset of columns, missing ones NULL."""
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    wanted = {c.lower() for c in include}
    unwanted = {c.lower() for c in exclude}
    types: dict[str, str] = {}
    for df in relations.values():
        for field in df.schema.fields:
            low = field.name.lower()
            if low in unwanted or (wanted and low not in wanted):
                continue
            types.setdefault(field.name, field.dataType.simpleString())
    if not types:
        raise ValueError("no columns left to union")
    types.update({c: t for c, t in (column_override or {}).items() if c in types})
    out = None
    for name, df in relations.items():
        source = df if where is None else df.filter(where)
        cols = [F.lit(name).alias(source_column)] if source_column else []
        present = set(df.columns)
        cols += [(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        part = source.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def column_values(
    df: DataFrame, column: str, where: Column | str | None = None, max_records: int | None = None
) -> DataFrame:
    """Distinct values, most frequent first (ties by value)."""
    source = df if where is None else df.filter(where)
    counted = source.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    ordered = counted.orderBy(F.desc("n_rows"), F.asc("value"))
    return ordered if max_records is None else ordered.limit(max_records)


def tables_like(spark: SparkSession, pattern: str, exclude: str = "", database: str | None = None) -> list[str]:
    """Catalog tables whose name matches a SQL LIKE pattern, ignoring case."""
    names = spark.createDataFrame(
        [(t.name,) for t in spark.catalog.listTables(database)], "table_name string"
    ).filter(F.col("table_name").ilike(pattern))
    if exclude:
        names = names.filter(~F.col("table_name").ilike(exclude))
    return [r.table_name for r in names.orderBy("table_name").collect()]


def tables_with_prefix(spark: SparkSession, prefix: str, exclude: str = "", database: str | None = None) -> list[str]:
    return tables_like(spark, prefix.replace("_", r"\_") + "%", exclude, database)


def union_tables(spark: SparkSession, names: Sequence[str], **options) -> DataFrame:
    """UNION ALL of catalog tables, e.g. the result of :func:`tables_like`."""
    return union_relations({n: spark.table(n) for n in names}, **options)


# --- joins ----------------------------------------------------------------------------


def left_join_where(left: DataFrame, right: DataFrame, on: str | Sequence[str], right_condition: Column) -> DataFrame:
    """LEFT JOIN whose extra condition concerns the right side only; unmatched rows stay."""
    return left.join(right.filter(right_condition), on, "left")


def rows_without_parent(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key is missing from the parent; see ``membership``."""
    return membership.orphans(child, child_key, parent, parent_key)


def rows_with_parent(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.join(keys, F.col(child_key) == F.col("_parent_key"), "left_semi")


def compare_scalars(left: DataFrame, right: DataFrame) -> DataFrame:
    """Side by side of two one-row aggregates."""
    return left.crossJoin(right)


def join_week_range(
    days: DataFrame, day: str, weeks: DataFrame, start: str, end: str, lengths: tuple[int, int] = (6, 6)
) -> DataFrame:
    """Each day with the calendar range that contains it; ``lengths`` as in ``intervals.join_containing``."""
    return join_containing(days, day, weeks, start, end, lengths=lengths)


def null_safe_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on ``keys`` that also matches NULL with NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


