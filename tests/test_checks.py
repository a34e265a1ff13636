"""Every check with a passing and a failing fixture."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartmill.operators import checks as chk
from cartmill.operators import core_checks as C
from conftest import rows


def table(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def empty(df):
    return df.count() == 0


def test_not_null_and_unique(spark):
    df = table(spark, "a int", (1,), (2,), (2,), (None,), (None,))
    assert C.not_null(df, "a").count() == 2
    assert empty(C.not_null(df.filter("a = 1"), "a"))
    assert rows(C.unique(df, "a")) == [(2, 2)]
    assert empty(C.unique(df.filter("a = 1"), "a"))


def test_proportion(spark):
    df = table(spark, "g string, v int", *[("x", 1 if i < 9 else None) for i in range(10)], ("y", None), ("y", 2))
    assert empty(C.not_null_proportion(df.filter("g = 'x'"), "v", 0.9))
    assert rows(C.not_null_proportion(df.filter("g = 'x'"), "v", 0.95)) == [(0.9,)]
    assert rows(C.not_null_proportion(df, "v", 0.6, by=["g"])) == [("y", 0.5)]
    assert rows(C.not_null_proportion(df, "v", 0.1, 0.6, by=["g"])) == [("x", 0.9)]


def test_value_lists(spark):
    df = table(spark, "city string", ("Rome",), ("Oslo",), ("Oslo",), (None,))
    assert rows(C.accepted_values(df, "city", ["Rome"])) == [("Oslo", 2)]
    assert empty(C.accepted_values(df, "city", ["Rome", "Oslo"]))
    assert rows(C.not_accepted_values(df, "city", ["Rome", "Paris"])) == [("Rome", 1)]
    assert empty(C.not_accepted_values(df, "city", ["Paris"]))


def test_relationships(spark):
    child, parent = table(spark, "id int", (1,), (2,), (None,), (3,)), table(spark, "id int, ok boolean", (1, True), (2, False))
    assert rows(C.relationships(child, "id", parent, "id")) == [(3,)]
    assert empty(C.relationships(child.filter("id < 3"), "id", parent, "id"))
    orphans = C.orphan_keys(child.union(child), "id", parent, "id")
    assert rows(orphans) == [(3, 2)] and orphans.agg(F.expr(C.ORPHAN_ROWS)).first()[0] == 2
    assert rows(C.relationships_where(child, "id", parent, "id", "id <> 3", "ok")) == [(2,)]
    assert empty(C.relationships_where(child, "id", parent, "id", "id <> 3"))


def test_range(spark):
    df = table(spark, "id int", (-1,), (11,), (None,))
    assert rows(C.accepted_range(df, "id", 0, 11)) == [(-1,)]
    assert rows(C.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert empty(C.accepted_range(df, "id", -1))
    assert empty(C.accepted_range(df, "id"))


def test_at_least_one_and_not_constant(spark):
    df = table(spark, "g int, v int", (1, None), (1, 5), (2, None), (3, 7), (3, 7))
    assert rows(C.at_least_one(df, "v", ["g"])) == [(2, 0)]
    assert empty(C.at_least_one(df, "v"))
    assert not empty(C.at_least_one(df.filter("g = 2"), "v"))
    assert rows(C.not_constant(df, "v", ["g"])) == [(1, 1), (3, 1)]
    assert empty(C.not_constant(df, "v"))


def test_cardinality(spark):
    a, b = table(spark, "x int", (1,), (1,), (2,)), table(spark, "y int", (1,), (2,), (2,))
    assert empty(C.cardinality_equality(a, "x", a, "x"))
    assert C.cardinality_equality(a, "x", b, "y").count() == 4


def test_row_counts(spark):
    a, b = table(spark, "g int", (1,), (1,), (2,)), table(spark, "g int", (1,), (1,), (3,))
    plain = C.equal_rowcount(a, b).agg(F.expr(C.EQUAL_ROWCOUNT_FAILURES)).first()[0]
    assert plain == 0
    grouped = C.equal_rowcount(a, b, ["g"])
    # groups missing on one side have no difference
    assert grouped.count() == 3 and grouped.agg(F.expr(C.EQUAL_ROWCOUNT_FAILURES)).first()[0] == 0
    larger = C.equal_rowcount(a, b.limit(1)).agg(F.expr(C.EQUAL_ROWCOUNT_FAILURES)).first()[0]
    assert larger == 2
    fewer = lambda x, y, by=(): C.fewer_rows_than(x, y, by).agg(F.expr(C.FEWER_ROWS_FAILURES)).first()[0]
    assert fewer(a.limit(1), b) == 0
    assert fewer(a, b) == 1
    assert fewer(a, b.limit(1)) == 2
    assert fewer(a, b, ["g"]) == 1


def test_equality(spark):
    a = table(spark, "a int, b double", (1, 1.001), (2, 2.0), (2, 2.0))
    b = table(spark, "a int, b double", (1, 1.002), (2, 2.0))
    fail = lambda df: df.agg(F.expr(C.EQUALITY_FAILURES)).first()[0]
    assert rows(C.equality(a, b)) == [("a_minus_b", 1, 1.001), ("b_minus_a", 1, 1.002)]
    assert fail(C.equality(a, b)) == 2
    assert empty(C.equality(a, b, precision=2))
    assert empty(C.equality(a, b, compare_columns=["a"]))
    assert empty(C.equality(a, b, exclude_columns=["B"]))
    assert fail(C.equality(a, b.filter("a = 2"), compare_columns=["a"])) == 2
    with pytest.raises(ValueError):
        C.equality(a, b.drop("b"))
    with pytest.raises(ValueError):
        C.equality(a, b, compare_columns=["a"], exclude_columns=["b"])


def test_expression(spark):
    df = table(spark, "a int, b int", (1, 2), (3, 1), (None, 1))
    assert rows(C.expression_is_true(df, "a < b")) == [(3, 1)]
    assert empty(C.expression_is_true(df, "> 0", column="a"))


RANGES = [(0, 1), (1, 3), (3, 3), (5, 6)]


def test_ranges(spark):
    df = table(spark, "lo int, hi int", *RANGES)
    check = lambda d, **k: [r[:2] for r in rows(C.mutually_exclusive_ranges(d, "lo", "hi", **k).select("lower_bound", "upper_bound"))]  # noqa: E731,E501
    assert check(df) == [(3, 3)]
    assert check(df, zero_length=True) == []
    assert check(df, zero_length=True, gaps="not_allowed") == [(3, 3)]
    assert check(df, zero_length=True, gaps="required") == [(0, 1), (1, 3)]
    overlapping = table(spark, "lo int, hi int", (0, 5), (3, 8), (8, None))
    assert check(overlapping) == [(0, 5), (8, None)]
    grouped = table(spark, "g int, lo int, hi int", (1, 0, 5), (2, 3, 8), (2, 6, 9))
    assert check(grouped, by=["g"]) == [(3, 8)]
    with pytest.raises(ValueError):
        check(df, gaps="maybe")


def test_empty_strings(spark):
    df = table(spark, "s string", ("a",), (" ",), ("",), (None,))
    assert C.not_empty_string(df, "s").count() == 2
    assert C.not_empty_string(df, "s", trim=False).count() == 1


def test_recency(spark):
    df = table(spark, "g int, ts timestamp", (1, dt.datetime(2024, 1, 10)), (2, dt.datetime(2024, 1, 1)))
    now = F.lit(dt.datetime(2024, 1, 11))
    assert [r.g for r in C.recency(df, "ts", "day", 2, now, by=["g"]).collect()] == [2]
    assert empty(C.recency(df, "ts", "day", 2, now))
    assert C.recency(df, "ts", "hour", 2, now).count() == 1
    assert empty(C.recency(df, "ts", "day", 1, F.lit(dt.datetime(2024, 1, 11, 23)), ignore_time=True))


def test_sequences(spark):
    even = table(spark, "v int", (2,), (4,), (6,), (8,))
    assert empty(C.sequential_values(even, "v", 2))
    assert C.sequential_values(even, "v").count() == 3
    hours = table(spark, "t timestamp", *[(dt.datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)])
    assert rows(C.sequential_values(hours, "t", part="hour")) == [
        (dt.datetime(2021, 1, 1, 4), dt.datetime(2021, 1, 1, 2))
    ]
    grouped = table(spark, "g int, v int", (1, 1), (1, 2), (2, 5), (2, 7))
    assert rows(C.sequential_values(grouped, "v", by=["g"])) == [(2, 7, 5)]


def test_unique_combination(spark):
    df = table(spark, "a int, b int", (1, 1), (1, 2), (None, 1), (None, 1))
    assert rows(C.unique_combination(df, ["a", "b"])) == [(None, 1, 2)]
    assert empty(C.unique_combination(df.filter("a = 1"), ["a", "b"]))


def test_marketplace_rules(spark):
    payments = table(
        spark, "order_id int, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        (1, 1, "boleto", 1, 100.0), (2, 1, "boleto", 3, 10.0), (3, 1, "credit_card", 1, 60.0), (3, 2, "voucher", 1, 60.0),
        (4, 1, "credit_card", 5, 999.0),
    )
    sales = table(spark, "order_id int, total_sale_amount double", (1, 60.0), (1, 30.0), (3, 50.0), (4, 1.0))
    assert rows(C.single_installment(payments)) == [(2, 1, 3)]
    assert rows(C.payment_reconciliation(payments, sales)) == [(3, 70.0)]
    assert empty(C.payment_reconciliation(payments.filter("order_id = 1"), sales))
    facts = {"fct": table(spark, "date_key date", (dt.date(2015, 12, 31),), (dt.date(2016, 1, 1),), (None,))}
    assert rows(C.date_key_range(facts, "2016-01-01", "2018-12-31")) == [("fct", dt.date(2015, 12, 31))]


# --- contract -------------------------------------------------------------------------


def test_verdicts_and_must_fail_checks(spark):
    df = table(spark, "a int", (1,), (None,), (1,))
    rules = [
        chk.RowCheck("a_present", F.col("a").isNull()),
        chk.RowCheck("tolerated", F.col("a").isNull(), error_if="> 10"),
        chk.RowCheck("must_fail", F.col("a") > 5, error_if="= 0"),
        chk.FrameCheck("unique_a", lambda d: C.unique(d, "a")),
        chk.FrameCheck("equal", lambda d: C.equality(d, d), F.expr(C.EQUALITY_FAILURES)),
    ]
    got = {r.check_name: (r.failures, r.verdict) for r in chk.with_verdict(chk.failures(df, rules), rules).collect()}
    assert got == {
        "a_present": (1, "error"),
        "tolerated": (1, "warn"),
        "must_fail": (0, "error"),
        "unique_a": (1, "error"),
        "equal": (0, "pass"),
    }


def test_row_checks_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    rules = [chk.RowCheck(f"c{i}", F.col("id") == i) for i in range(20)]
    counted = chk.failures(spark.read.parquet(path), rules)
    assert counted.agg(F.sum("failures")).first()[0] == 20
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_fail_calc_of_empty_result_is_zero(spark):
    df = table(spark, "a int", (1,))
    rule = chk.FrameCheck("rows", lambda d: C.equal_rowcount(d.limit(0), d.limit(0), ["a"]), F.expr(C.EQUAL_ROWCOUNT_FAILURES))
    assert chk.failures(df, [rule]).first().failures == 0


def test_suite_needs_checks(spark):
    with pytest.raises(ValueError):
        chk.failures(spark.range(1), [])
    with pytest.raises(ValueError):
        chk.run_suite({}, {})
