"""The build as a graph: what runs at the same time, what a failure stops, and how often a table is read."""

from __future__ import annotations

import threading

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cartmill.operators import checks as chk
from cartmill.operators import core_checks, membership
from cartmill.operators.relational import rows_without_parent
from cartmill.plans import build


def test_independent_tables_overlap(spark, tmp_path):
    """Each of two steps waits until the other has begun."""
    both = threading.Barrier(2)

    def step(_):
        both.wait(timeout=60)
        return spark.range(3)

    done, report = build.gated_build(spark, {"a": step, "b": step}, lambda _: {}, str(tmp_path), {})
    assert sorted(done) == ["a", "b"] and [r.status for r in report.collect()] == ["built", "built"]


def test_order_of_dependent_tables(spark, tmp_path):
    steps = {
        "c": lambda t: t["a"].unionAll(t["b"]),
        "a": lambda t: spark.range(2),
        "b": lambda t: t["a"].withColumn("id", F.col("id") + 10),
    }
    done, report = build.gated_build(spark, steps, lambda _: {}, str(tmp_path), {"c": ("a", "b"), "b": ("a",)}, workers=2)
    assert [r.table_name for r in report.collect()] == ["c", "a", "b"]
    assert rows(done["c"]) == [(0,), (1,), (10,), (11,)]


def test_failure_stops_only_what_depends_on_it(spark, tmp_path):
    def broken(_):
        raise ValueError("no source")

    steps = {
        "a": broken,
        "b": lambda t: t["a"],
        "c": lambda t: t["b"],
        "d": lambda t: spark.range(3),
        "e": lambda t: t["d"].filter("id > 0"),
        "f": lambda t: t["e"],
    }
    needs = {"b": ("a",), "c": ("b",), "e": ("d",), "f": ("e",)}
    rules = {"e": [chk.RowCheck("below_two", F.col("id") >= 2)], "d": [chk.RowCheck("positive", F.col("id") < 0)]}
    done, report = build.gated_build(spark, steps, lambda _: rules, str(tmp_path), needs)
    assert sorted(done) == ["d"]
    assert [tuple(r) for r in report.collect()] == [
        ("a", "failed", "error: no source", None),
        ("b", "skipped", None, None),
        ("c", "skipped", None, None),
        ("d", "built", None, None),
        ("e", "failed", "below_two", 1),
        ("f", "skipped", None, None),
    ]


def test_circle(spark):
    with pytest.raises(ValueError, match="need each other"):
        build.concurrently(spark, {"a": lambda _: 1, "b": lambda _: 2}, {"a": ("b",), "b": ("a",)})


def test_row_checks_take_no_scan_of_their_own(spark, tmp_path):
    """A row that is counted while it is written is computed once."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(100).mapInArrow(look, "id long")
    rules = {"t": [chk.RowCheck(f"r{i}", F.col("id") % (i + 2) == 0) for i in range(5)]}
    stored, found = build.checked_tables(spark, {"t": source}, lambda _: rules, str(tmp_path))
    counts = {r.check_name: r.failures for r in found.collect()}
    assert counts == {"r0": 50, "r1": 34, "r2": 25, "r3": 20, "r4": 17}
    assert seen.value == 100
    # no check is left that would read the stored table
    assert "Scan parquet" not in plan(found) and stored["t"].count() == 100


def test_checked_tables_equal_the_suite(spark, tmp_path):
    parent = spark.range(0, 40, 2).withColumnRenamed("id", "key")
    child = spark.range(50).select((F.col("id") % 25).alias("key"), F.when(F.col("id") > 3, F.col("id") % 7).alias("kind"))
    rules = {
        "child": [
            chk.RowCheck("no_kind", F.col("kind").isNull()),
            chk.KeyCheck("unique", ("key",), "unique"),
            chk.KeyCheck("unique_both", ("key", "kind"), "unique", with_null=True),
            chk.KeyCheck("absent", ("kind",), "absent", where=F.col("kind") > 4),
            chk.KeyCheck("known", ("key",), "known", parent=parent, field="key"),
            chk.FrameCheck("frame", lambda df: df.filter("kind = 6")),
        ],
        "parent": [chk.KeyCheck("unique", ("key",), "unique")],
    }
    tables = {"child": child, "parent": parent}
    _, found = build.checked_tables(spark, tables, lambda _: rules, str(tmp_path))
    want = chk.run_suite(tables, rules)
    assert rows(found) == rows(want.select(found.columns))
    assert {r.check_name: r.failures for r in want.filter("table_name = 'child'").collect()} == {
        "no_kind": 4, "unique": 25, "unique_both": 0, "absent": 2, "known": 24, "frame": 7,
    }


# --- rows without a parent --------------------------------------------------------------


def test_orphans_of_small_sets_are_not_shuffled(spark):
    child = spark.createDataFrame([(-70,), (-64,), (-1,), (0,), (63,), (64,), (None,), (2**62,)], "k long")
    parent = spark.createDataFrame([(-70,), (-1,), (63,), (None,), (2**62,)], "p long")
    lost = rows_without_parent(child, parent, "k", "p")
    assert rows(lost) == [(-64,), (0,), (64,)]
    assert "BroadcastHashJoin" in plan(lost) and "Exchange hashpartitioning" not in plan(lost)


@pytest.mark.parametrize("kind", ["int", "date", "string", "tinyint"])
def test_orphans_of_any_type(spark, kind, monkeypatch):
    make = "date_add(date'1969-12-01', cast(id as int))" if kind == "date" else f"cast(id as {kind})"
    child = spark.range(100).selectExpr(f"{make} AS k")
    parent = spark.range(0, 90, 3).selectExpr(f"{make} AS p")
    want = rows(child.join(parent, F.col("k") == F.col("p"), "left_anti"))
    assert rows(rows_without_parent(child, parent, "k", "p")) == want and len(want) == 70
    monkeypatch.setattr(membership, "MOST_WORDS", 0)  # too large a set for every task
    assert rows(core_checks.relationships(child, "k", parent, "p")) == want


def test_empty_parent(spark):
    child, parent = spark.range(3).withColumnRenamed("id", "k"), spark.range(0)
    assert rows(rows_without_parent(child, parent, "k", "id")) == [(0,), (1,), (2,)]
