"""Core data checks. Every function returns the failing rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.functions.dates import add_parts
from cartmill.operators.compare import only_differing
from cartmill.operators.ranking import with_neighbour
from cartmill.operators.relational import rows_without_parent


def as_condition(condition: Column | str | None) -> Column:
    if condition is None:
        return F.lit(True)
    return F.expr(condition) if isinstance(condition, str) else condition


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values occurring more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, by: Sequence[str] = ()
) -> DataFrame:
    share = (F.count(column) / F.count("*")).alias("not_null_proportion")
    p = F.col("not_null_proportion")
    return df.groupBy(*by).agg(share).filter((p < at_least) | (p > at_most))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside the list; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return (
        df.filter(F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    return rows_without_parent(child, parent, column, field)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Keys without parent and how many child rows hold them; condense with ORPHAN_ROWS.

    Rows are counted per key before the join, so only distinct keys are shuffled and a
    frequent key is one row.
    """
    counted = child.groupBy(column).agg(F.count("*").alias("n_records"))
    return rows_without_parent(counted, parent, column, field)


def relationships_where(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    from_condition: Column | str | None = None,
    to_condition: Column | str | None = None,
) -> DataFrame:
    return rows_without_parent(
        child.filter(as_condition(from_condition)), parent.filter(as_condition(to_condition)), column, field
    )


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; NULL passes."""
    c = F.col(column)
    broken = F.lit(False)
    if min_value is not None:
        broken = broken | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        broken = broken | ((c > max_value) if inclusive else (c >= max_value))
    return df.filter(broken)


def at_least_one(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table, when it has no value at all) without a non-null value."""
    return df.groupBy(*by).agg(F.count(column).alias("n_values")).filter("n_values = 0")


def cardinality_equality(df: DataFrame, column: str, other: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs present on one side only."""

    def counted(frame: DataFrame, c: str) -> DataFrame:
        return frame.groupBy(F.col(c).alias("value_field")).agg(F.count("*").alias("num_rows"))

    a, b = counted(df, column), counted(other, field)
    return a.subtract(b).unionByName(b.subtract(a))


def _paired_counts(df: DataFrame, other: DataFrame, by: Sequence[str], names: tuple[str, str]) -> DataFrame:
    a = df.groupBy(*by).agg(F.count("*").alias(names[0]))
    b = other.groupBy(*by).agg(F.count("*").alias(names[1]))
    if not by:
        return a.crossJoin(b)
    for c in by:
        a, b = a.withColumnRenamed(c, f"{c}_a"), b.withColumnRenamed(c, f"{c}_b")
    condition = F.lit(True)
    for c in by:
        condition = condition & (F.col(f"{c}_a") == F.col(f"{c}_b"))
    return a.join(b, condition, "full")


ORPHAN_ROWS = "sum(n_records)"
EQUAL_ROWCOUNT_FAILURES = "sum(coalesce(diff_count, 0))"
FEWER_ROWS_FAILURES = "sum(coalesce(row_count_delta, 0))"
EQUALITY_FAILURES = (
    "count(*) + coalesce(abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)"
)


def equal_rowcount(df: DataFrame, other: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts side by side; condense with EQUAL_ROWCOUNT_FAILURES.

    A group missing on one side has a NULL difference, which counts as 0.
    """
    paired = _paired_counts(df, other, by, ("count_a", "count_b"))
    return paired.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, other: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fails unless ``df`` has fewer rows than ``other``; condense with FEWER_ROWS_FAILURES."""
    paired = _paired_counts(df, other, by, ("count_our_model", "count_comparison_model"))
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return paired.withColumn("row_count_delta", delta)


def equality(
    df: DataFrame,
    other: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows present on one side only; condense with EQUALITY_FAILURES.

    Rows are compared only in the buckets whose hashes differ, see ``compare``.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        columns = list(compare_columns)
    else:
        skip = {c.lower() for c in exclude_columns or ()}
        columns = [c for c in df.columns if c.lower() not in skip]
        theirs = {c.lower() for c in other.columns if c.lower() not in skip}
        if {c.lower() for c in columns} != theirs:
            raise ValueError("the two tables have different columns")
    fractional = ("float", "double", "decimal")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def comparable(frame: DataFrame) -> DataFrame:
        out, beyond = [], []
        for c in columns:
            if precision is not None and kinds[c].startswith(fractional):
                exact = F.col(c).try_cast("decimal(38,9)")
                out.append(F.round(exact, precision).alias(c))
                # what no decimal of this size holds is compared as it is
                beyond.append(F.when(exact.isNull(), F.col(c).cast("double")).alias(f"_beyond_{c}"))
            else:
                out.append(F.col(c))
        return frame.select(*out, *beyond)

    a, b = comparable(df), comparable(other)
    a, b = only_differing(a, b, a.columns)
    only_a = a.subtract(b).select(F.lit("a_minus_b").alias("which_diff"), *columns)
    only_b = b.subtract(a).select(F.lit("b_minus_a").alias("which_diff"), *columns)
    return only_a.unionByName(only_b)


def expression_is_true(df: DataFrame, expression: Column | str, column: str | None = None) -> DataFrame:
    """Rows where the expression is false; ``column`` prefixes a bare comparison like '> 0'."""
    if column is not None:
        expression = f"{column} {expression}"
    return df.filter(~as_condition(expression))


GAP_RULES = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    by: Sequence[str] = (),
    gaps: str = "allowed",
    zero_length: bool = False,
) -> DataFrame:
    """Ranges that are reversed, overlap the next range, or break the gap rule."""
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(GAP_RULES)}, got {gaps!r}")
    ranges = df.select(*by, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"))
    order = [F.col("lower_bound").asc(), F.col("upper_bound").asc()]
    ranges = with_neighbour(
        ranges, "lower_bound", order, by, name="next_lower_bound", offset=1, flag="is_last_record"
    )
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    proper = F.coalesce((low <= high) if zero_length else (low < high), F.lit(False))
    separate = F.coalesce(GAP_RULES[gaps](high, following), F.col("is_last_record"))
    return ranges.filter(~(proper & separate))


def not_constant(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Groups whose non-null values are all the same (min = max avoids a distinct)."""
    extremes = df.groupBy(*by).agg(F.min(column).alias("_min"), F.max(column).alias("_max"))
    return extremes.filter(F.col("_min") == F.col("_max")).select(*by, F.lit(1).cast("bigint").alias("n_distinct"))


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    c = F.trim(F.col(column)) if trim else F.col(column)
    return df.filter(c == "")


def recency(
    df: DataFrame,
    column: str,
    part: str,
    interval: int,
    as_of: Column | None = None,
    ignore_time: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose latest value is older than ``interval`` parts before ``as_of``."""
    moment = F.current_timestamp() if as_of is None else as_of
    threshold = add_parts(part, -interval, moment)
    latest = F.max(column)
    if ignore_time:
        threshold, latest = threshold.cast("date"), latest.cast("date")
    grouped = df.groupBy(*by).agg(latest.alias("most_recent"))
    return grouped.withColumn("threshold", threshold).filter("most_recent < threshold")


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, part: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows that do not follow the previous value by exactly ``interval``; first rows pass."""
    rows = with_neighbour(df.select(*by, column), column, [F.col(column).asc()], by, name="previous_value")
    previous = F.col("previous_value")
    if part:
        return rows.filter(F.col(column).cast("timestamp") != add_parts(part, interval, previous))
    return rows.filter(F.col(column) != previous + interval)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value combinations held by several rows; NULLs group together."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


# --- marketplace rules ----------------------------------------------------------------

# Payment type that is always paid at once, tolerated difference per order.
SINGLE_INSTALLMENT_TYPE = "boleto"
RECONCILIATION_TOLERANCE = 20.0


def single_installment(payments: DataFrame) -> DataFrame:
    return payments.filter(
        (F.col("payment_type") == SINGLE_INSTALLMENT_TYPE) & (F.col("payment_installments") != 1)
    ).select("order_id", "payment_sequential", "payment_installments")


def date_key_range(facts: dict[str, DataFrame], first: str, last: str) -> DataFrame:
    """Rows of any fact outside the known date range, tagged with the table."""
    out = None
    for name, df in facts.items():
        outside = ~F.col("date_key").between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
        part = df.filter(outside).select(F.lit(name).alias("source_table"), "date_key")
        out = part if out is None else out.unionByName(part)
    return out


def payment_reconciliation(
    payments: DataFrame, sales: DataFrame, tolerance: float = RECONCILIATION_TOLERANCE
) -> DataFrame:
    """Orders paid at once whose payments and sales differ by more than the tolerance."""
    paid = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_total"), F.max("payment_installments").alias("_installments")
    )
    sold = sales.groupBy("order_id").agg(F.sum("total_sale_amount").alias("sales_total"))
    diff = F.abs(F.col("payment_total") - F.col("sales_total"))
    return (
        paid.filter("_installments = 1")
        .join(sold, "order_id")
        .select("order_id", diff.alias("diff"))
        .filter(F.col("diff") > tolerance)
    )


