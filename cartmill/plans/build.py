"""The whole job: raw text to staging, star schema and gold, each table behind its checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.operators import core_checks as C
from cartmill.operators import expectations as X
from cartmill.operators.checks import (
    Check,
    FrameCheck,
    KeyCheck,
    RowCheck,
    failures,
    suite_failures,
    with_verdict,
    with_verdicts,
)
from cartmill.plans import star as star_plan
from cartmill.plans.staging import LAT_RANGE, LNG_RANGE, stage_all
from cartmill.sources.tables import write_measured

T = TypeVar("T")

# Accepted codes and the date range facts may cover.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
FACT_DATES = ("2016-01-01", "2018-12-31")
ROW_BOUNDS = {"dim_date": (1000, 1100), "fct_sales": (110_000, 120_000), "fct_reviews": (95_000, 100_000)}


def not_null(column: str) -> Check:
    return RowCheck(f"not_null_{column}", F.col(column).isNull())


def unique(column: str) -> Check:
    return KeyCheck(f"unique_{column}", (column,), "unique")


def accepted(column: str, values: Sequence[str]) -> Check:
    return KeyCheck(f"accepted_values_{column}", (column,), "absent", where=~F.col(column).isin(*values))


def between(column: str, low=None, high=None) -> Check:
    c = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (c < low)
    if high is not None:
        broken = broken | (c > high)
    return RowCheck(f"between_{column}", broken)


def unique_key(*columns: str) -> Check:
    return KeyCheck(f"unique_{'_'.join(columns)}", columns, "unique", with_null=True)


def references(column: str, parent: DataFrame, field: str) -> Check:
    return KeyCheck(f"relationships_{column}", (column,), "known", parent=parent, field=field)


def row_count(bounds: tuple[int, int]) -> Check:
    return FrameCheck("row_count", lambda df: X.row_count_between(df, *bounds))


def declared_suite(
    tables: Mapping[str, DataFrame],
    row_bounds: Mapping[str, tuple[int, int]] = ROW_BOUNDS,
    fact_dates: tuple[str, str] = FACT_DATES,
) -> dict[str, list[Check]]:
    """The declared checks per table: 73 generic ones and the 3 business rules."""
    first, last = (F.lit(d).cast("date") for d in fact_dates)
    approved_late = F.col("order_approved_at") >= F.col("order_purchase_timestamp")
    date_ok = F.col("date_key").between(first, last)
    outside = RowCheck("date_key_range", ~date_ok)
    payment_rules = [
        accepted("payment_type", PAYMENT_TYPES),
        between("payment_installments", 1),
        between("payment_value", 0),
    ]
    return {
        "stg_customers": [
            not_null("customer_id"),
            unique("customer_id"),
            not_null("customer_unique_id"),
            not_null("customer_state"),
        ],
        "stg_orders": [
            RowCheck("approved_after_purchase", ~approved_late),
            not_null("order_id"),
            unique("order_id"),
            not_null("customer_id"),
            not_null("order_status"),
            accepted("order_status", ORDER_STATUSES),
        ],
        "stg_order_items": [
            unique_key("order_id", "order_item_id"),
            *[
                not_null(c)
                for c in ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
            ],
        ],
        "stg_payments": [
            not_null("order_id"),
            not_null("payment_sequential"),
            not_null("payment_type"),
            *payment_rules,
        ],
        "stg_reviews": [
            not_null("review_id"),
            unique("review_id"),
            not_null("order_id"),
            between("review_score", 1, 5),
        ],
        "stg_products": [not_null("product_id"), unique("product_id")],
        "stg_geolocation": [
            not_null("zip_code_prefix"),
            unique("zip_code_prefix"),
            between("geolocation_lat", *LAT_RANGE),
            between("geolocation_lng", *LNG_RANGE),
        ],
        "stg_sellers": [not_null("seller_id"), unique("seller_id")],
        "stg_category_translation": [not_null("product_category_name")],
        "dim_customers": [not_null("customer_unique_id"), unique("customer_unique_id")],
        "dim_products": [
            not_null("product_id"),
            unique("product_id"),
            not_null("product_category_name_english"),
            RowCheck("length_product_category_name_english", F.length("product_category_name_english") < 1),
        ],
        "dim_sellers": [not_null("seller_id"), unique("seller_id")],
        "dim_date": [
            row_count(row_bounds["dim_date"]),
            RowCheck("expression_is_true", ~date_ok),
            not_null("date_key"),
            unique("date_key"),
        ],
        "fct_sales": [
            unique_key("order_id", "order_item_id"),
            row_count(row_bounds["fct_sales"]),
            not_null("order_id"),
            not_null("order_item_id"),
            not_null("product_id"),
            references("product_id", tables["dim_products"], "product_id"),
            not_null("seller_id"),
            references("seller_id", tables["dim_sellers"], "seller_id"),
            not_null("customer_unique_id"),
            references("customer_unique_id", tables["dim_customers"], "customer_unique_id"),
            not_null("date_key"),
            references("date_key", tables["dim_date"], "date_key"),
            between("total_sale_amount", 0),
            outside,
        ],
        "fct_reviews": [
            row_count(row_bounds["fct_reviews"]),
            not_null("review_id"),
            unique("review_id"),
            not_null("order_id"),
            references("order_id", tables["stg_orders"], "order_id"),
            between("review_score", 1, 5),
            outside,
        ],
        "fct_payments": [
            unique_key("order_id", "payment_sequential"),
            not_null("order_id"),
            not_null("payment_sequential"),
            *payment_rules,
            outside,
            FrameCheck("single_installment", C.single_installment),
            FrameCheck("reconciliation", lambda df: C.payment_reconciliation(df, tables["fct_sales"])),
        ],
    }


# Tables each table is built from or checked against.
DEPENDS_ON: dict[str, tuple[str, ...]] = {
    "dim_customers": ("stg_customers", "stg_geolocation"),
    "dim_products": ("stg_products",),
    "dim_sellers": ("stg_sellers", "stg_geolocation"),
    "fct_sales": (
        "stg_order_items",
        "stg_orders",
        "stg_customers",
        "dim_customers",
        "dim_products",
        "dim_sellers",
        "dim_date",
    ),
    "fct_reviews": ("stg_reviews", "stg_orders"),
    "fct_payments": ("stg_payments", "stg_orders", "fct_sales"),
}


Builder = Callable[[Mapping[str, DataFrame]], DataFrame]
Rules = Callable[[Mapping[str, DataFrame]], Mapping[str, Sequence[Check]]]


def concurrently(
    spark: SparkSession,
    work: Mapping[str, Callable[[Mapping[str, T]], T]],
    needs: Mapping[str, Sequence[str]],
    workers: int = 4,
) -> tuple[dict[str, T], dict[str, BaseException | None]]:
    """Run functions at the same time, each as soon as what it needs is there.

    Each gets the results so far and runs its Spark jobs in a thread, job group and pool of its own name (pools share
    executors fairly where ``spark.scheduler.mode`` is FAIR). Returns the results, and for each name that has none the
    exception, or None where something it needs has no result.
    """
    unknown = {n: set(needs.get(n, ())) & work.keys() for n in work}
    done: dict[str, T] = {}
    lost: dict[str, BaseException | None] = {}

    def run(name: str, ready: Mapping[str, T]) -> T:
        context = spark.sparkContext
        context.setJobGroup(name, name)
        context.setLocalProperty("spark.scheduler.pool", name)
        return work[name](ready)

    waiting, running = list(work), {}
    with ThreadPoolExecutor(workers) as pool:
        while waiting or running:
            for name in list(waiting):
                if unknown[name] & lost.keys():
                    lost[name] = None
                elif unknown[name] <= done.keys():
                    running[pool.submit(inheritable_thread_target(spark)(run), name, dict(done))] = name
                else:
                    continue
                waiting.remove(name)
            if running:
                for finished in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(finished)
                    if finished.exception() is None:
                        done[name] = finished.result()
                    else:
                        lost[name] = finished.exception()
            elif waiting and not any(unknown[n] & lost.keys() for n in waiting):
                raise ValueError(f"{', '.join(waiting)} need each other")
    return done, lost


class Rejected(Exception):
    """A table did not pass; ``broken`` has its failing checks and their failures."""

    def __init__(self, name: str, broken: list[tuple[str, int]]):
        super().__init__(f"{name}: {broken}")
        self.broken = broken


def write_checked(
    name: str, df: DataFrame, known: Mapping[str, DataFrame], checks: Rules, path: str, partition_by: Sequence[str] = ()
) -> tuple[DataFrame, list[tuple[str, int]], list[Check]]:
    """Write a table and count what its row checks find in the same pass.

    Returns the stored table, (check, failures) of the row checks, and the checks that are left to do on it.
    """
    rows = [c for c in checks({**known, name: df}).get(name, ()) if isinstance(c, RowCheck)]
    counts = {f"c{i}": F.count_if(c.broken) for i, c in enumerate(rows)}
    table, seen = write_measured(df, path, counts, partition_by)
    others = [c for c in checks({**known, name: table}).get(name, ()) if not isinstance(c, RowCheck)]
    return table, [(c.name, seen[f"c{i}"]) for i, c in enumerate(rows)], others


def gated_build(
    spark: SparkSession,
    steps: Mapping[str, Builder],
    checks: Rules,
    folder: str,
    depends_on: Mapping[str, Sequence[str]] = DEPENDS_ON,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    workers: int = 4,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write each table, check it, and skip whatever depends on a failed one.

    Tables that do not depend on each other are built at the same time, ``workers`` at most; a step sees the tables
    built before, of which only those in ``depends_on`` are sure to be there. ``partition_by`` names the storage
    partitions of large tables, e.g. facts by date. Returns the tables that passed and a report (table_name, status,
    check_name, failures), in the order of the steps; a step that raised counts as failed, its error in check_name.
    """

    def build(name: str, ready: Mapping[str, DataFrame]) -> DataFrame:
        path, parts = f"{folder}/{name}", (partition_by or {}).get(name, ())
        table, measured, others = write_checked(name, steps[name](ready), ready, checks, path, parts)
        rules = list(checks({**ready, name: table}).get(name, ()))
        if rules:
            found = spark.createDataFrame(measured, "check_name string, failures bigint")
            if others:
                found = found.unionByName(failures(table, others))
            broken = with_verdict(found, rules).filter("verdict = 'error'").collect()
            if broken:
                raise Rejected(name, [(r.check_name, r.failures) for r in broken])
        return table

    work = {name: (lambda ready, name=name: build(name, ready)) for name in steps}
    done, lost = concurrently(spark, work, depends_on, workers)
    report: list[tuple[str, str, str | None, int | None]] = []
    for name in steps:
        error = lost.get(name)
        if name in done:
            report.append((name, "built", None, None))
        elif isinstance(error, Rejected):
            report += [(name, "failed", check, n) for check, n in error.broken]
        elif error is None:
            report.append((name, "skipped", None, None))
        else:
            report.append((name, "failed", f"error: {error}"[:400], None))
    schema = "table_name string, status string, check_name string, failures bigint"
    return done, spark.createDataFrame(report, schema)


def checked_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], checks: Rules, folder: str, workers: int = 4
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write tables, several at a time, and run all their checks, whatever fails.

    Row checks are counted while a table is written; the others read what was written. Returns the stored tables and
    (table_name, check_name, failures, verdict).
    """
    order = list(tables)
    work = {n: (lambda _, n=n: write_checked(n, tables[n], tables, checks, f"{folder}/{n}")) for n in order}
    done, lost = concurrently(spark, work, {}, workers)
    for error in lost.values():
        raise error
    stored = {n: done[n][0] for n in order}
    suite = checks(stored)
    counted = [(n, check, k) for n in order for check, k in done[n][1]]
    found = spark.createDataFrame(counted, "table_name string, check_name string, failures bigint")
    others = {n: [c for c in suite.get(n, ()) if not isinstance(c, RowCheck)] for n in order}
    if any(others.values()):
        found = found.unionByName(suite_failures(stored, others))
    return stored, with_verdicts(found, suite)


def marketplace_steps(
    raw: dict[str, DataFrame], calendar: DataFrame
) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Build steps of the staging views and the star schema, in dependency order."""
    staged = stage_all(raw)
    steps: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
        name: (lambda _done, df=df: df) for name, df in staged.items()
    }
    steps |= {
        "dim_date": lambda _t: calendar,
        "dim_customers": lambda t: star_plan.dim_customers(t["stg_customers"], t["stg_geolocation"]),
        "dim_products": lambda t: star_plan.dim_products(t["stg_products"]),
        "dim_sellers": lambda t: star_plan.dim_sellers(t["stg_sellers"], t["stg_geolocation"]),
        "fct_sales": lambda t: star_plan.fct_sales(t["stg_order_items"], t["stg_orders"], t["stg_customers"]),
        "fct_reviews": lambda t: star_plan.fct_reviews(t["stg_reviews"]),
        "fct_payments": lambda t: star_plan.fct_payments(t["stg_payments"], t["stg_orders"]),
    }
    return steps


class Known(dict):
    """Tables built so far; those still missing look up as None."""

    def __missing__(self, _key):
        return None


def suite_for(
    row_bounds: Mapping[str, tuple[int, int]] = ROW_BOUNDS, fact_dates: tuple[str, str] = FACT_DATES
) -> Callable[[Mapping[str, DataFrame]], Mapping[str, Sequence[Check]]]:
    """The declared suite as a function of the tables built so far."""
    return lambda tables: declared_suite(Known(tables), row_bounds, fact_dates)

