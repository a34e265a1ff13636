"""Check contract: a check is a set of failing rows plus a threshold on a number of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.operators import membership


@dataclass(frozen=True)
class RowCheck:
    """Rows for which ``broken`` is true fail; NULL passes."""

    name: str
    broken: Column
    error_if: str = "!= 0"
    warn_if: str = "!= 0"


@dataclass(frozen=True)
class FrameCheck:
    """``failing`` derives the failing rows from the table; ``fail_calc`` condenses them."""

    name: str
    failing: Callable[[DataFrame], DataFrame]
    fail_calc: Column = field(default_factory=lambda: F.count("*"))
    error_if: str = "!= 0"
    warn_if: str = "!= 0"


@dataclass(frozen=True)
class KeyCheck:
    """Something is wrong with a key; checks on the same columns share one aggregation.

    ``rule`` "unique": keys held by several rows fail; "absent": every key found fails, ``where`` saying
    which rows are looked at; "known": rows fail whose key the column ``field`` of ``parent`` lacks.
    A key with a NULL is passed over unless ``with_null``.
    """

    name: str
    columns: tuple[str, ...]
    rule: str
    where: Column | None = None
    parent: DataFrame | None = None
    field: str | None = None
    with_null: bool = False
    error_if: str = "!= 0"
    warn_if: str = "!= 0"


Check = RowCheck | FrameCheck | KeyCheck


def row_failures(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """(check, failures) of all row checks on one table, in a single scan."""
    counts = df.agg(*[F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(checks)])
    pairs = F.array(
        *[F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
    )
    return counts.select(F.explode(pairs).alias("p")).select("p.check_name", "p.failures")


def _key_counts(df: DataFrame, columns: Sequence[str], checks: Mapping[int, KeyCheck]) -> DataFrame:
    """One row (n<check>) of the checks on how often each key of these columns stands in the table.

    Keys keep their types; a frequent key is one row for each task.
    """
    with_null = any(c.with_null for c in checks.values())
    wanted = [c.where for c in checks.values()]
    if all(w is not None for w in wanted):
        df = df.filter(reduce(lambda a, b: a | b, wanted))
    if not with_null:
        df = df.dropna(subset=list(columns))
    found = df.groupBy(*columns).agg(
        *[(F.count("*") if c.where is None else F.count_if(c.where)).alias(f"n{i}") for i, c in checks.items()]
    )
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    held = {"unique": lambda n: n > 1, "absent": lambda n: n > 0}
    return found.agg(
        *[F.count_if(held[c.rule](F.col(f"n{i}")) & (F.lit(c.with_null) | whole)).alias(f"n{i}") for i, c in checks.items()]
    )


def _orphans(df: DataFrame, checks: Mapping[int, KeyCheck]) -> DataFrame:
    """One row (n<check>) of the rows without a parent; references to small sets of whole numbers share one scan."""
    plain, tests = [], {}
    for i, c in checks.items():
        (column,) = c.columns
        known = membership.key_set(c.parent, c.field) if membership.alike(df, column, c.parent, c.field) else None
        if known is None:
            counted = df.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n")).filter("key IS NOT NULL")
            lost = counted.join(c.parent.select(F.col(c.field).alias("key")), "key", "left_anti")
            plain.append(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(f"n{i}")))
        else:
            tests[i] = (column, known)
    if tests:
        marked = df.select(*dict.fromkeys(column for column, _ in tests.values()))
        for i, (column, known) in tests.items():
            marked = membership.marked(marked, column, known, f"lost{i}")
        plain.append(marked.agg(*[F.count_if(f"lost{i}").alias(f"n{i}") for i in tests]))
    return reduce(DataFrame.crossJoin, plain)


def key_failures(tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, KeyCheck]]) -> DataFrame:
    """(table_name, check_name, failures) of key checks on any number of tables.

    Checks on the same columns of a table share one aggregation of typed keys.
    """
    groups: dict[tuple, dict[int, KeyCheck]] = {}
    for i, (table, c) in enumerate(checks):
        kind = ("known",) if c.rule == "known" else ("counted", c.columns, c.where is None)
        groups.setdefault((table, *kind), {})[i] = c
    parts = []
    for (table, kind, *columns), own in groups.items():
        counts = _orphans(tables[table], own) if kind == "known" else _key_counts(tables[table], columns[0], own)
        rows = [
            F.struct(F.lit(table).alias("table_name"), F.lit(c.name).alias("check_name"), F.col(f"n{i}").alias("failures"))
            for i, c in own.items()
        ]
        parts.append(counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    return reduce(DataFrame.unionAll, parts)


def failures(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """(check, failures) for one table: one job, however many checks."""
    checks = list(checks)
    rows = [c for c in checks if isinstance(c, RowCheck)]
    out = row_failures(df, rows) if rows else None
    keys = [("", c) for c in checks if isinstance(c, KeyCheck)]
    if keys:
        found = key_failures({"": df}, keys).drop("table_name")
        out = found if out is None else out.unionByName(found)
    for c in checks:
        if isinstance(c, RowCheck | KeyCheck):
            continue
        counted = c.failing(df).agg(F.coalesce(c.fail_calc, F.lit(0)).cast("bigint").alias("failures"))
        part = counted.select(F.lit(c.name).alias("check_name"), "failures")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no checks given")
    return out


def _verdict(checks: Iterable[Check]) -> Column:
    verdict = F.lit(None).cast("string")
    for c in checks:
        level = F.when(F.expr(f"failures {c.error_if}"), "error").when(F.expr(f"failures {c.warn_if}"), "warn")
        verdict = F.when(F.col("check_name") == c.name, level.otherwise("pass")).otherwise(verdict)
    return verdict


def with_verdict(counted: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Append 'error', 'warn' or 'pass' by each check's thresholds."""
    return counted.withColumn("verdict", _verdict(checks))


def run_suite(tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence[Check]]) -> DataFrame:
    """(table_name, check_name, failures, verdict) of a whole declared suite.

    Row checks take one scan of their table, key checks one aggregation for each set of columns.
    """
    if not suite:
        raise ValueError("empty suite")
    return with_verdicts(suite_failures(tables, suite), suite)


def suite_failures(tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence[Check]]) -> DataFrame:
    """(table_name, check_name, failures) of all checks of a suite."""
    counted = []
    keys = [(table, c) for table, checks in suite.items() for c in checks if isinstance(c, KeyCheck)]
    if keys:
        counted.append(key_failures(tables, keys))
    for table, checks in suite.items():
        others = [c for c in checks if not isinstance(c, KeyCheck)]
        if others:
            counted.append(failures(tables[table], others).select(F.lit(table).alias("table_name"), "check_name", "failures"))
    return reduce(DataFrame.unionByName, counted)


def with_verdicts(counted: DataFrame, suite: Mapping[str, Sequence[Check]]) -> DataFrame:
    """Append the verdict of each table's checks."""
    verdict = F.lit(None).cast("string")
    for table, checks in suite.items():
        here = F.col("table_name") == table
        verdict = F.when(here, _verdict(checks)).otherwise(verdict)
    return counted.withColumn("verdict", verdict)
