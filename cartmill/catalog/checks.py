"""Core data checks over the driver tables: each query returns the failing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartmill.catalog.common import rounded, scratch_path
from cartmill.catalog.registry import query
from cartmill.catalog.shop import Shop
from cartmill.catalog.shop_sql import STAGING, STAR
from cartmill.operators import checks as chk
from cartmill.operators import core_checks as C
from cartmill.plans import build, staging

HOLED = """(SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS cust,
            CASE WHEN o_orderkey % 9 = 0 THEN '  ' ELSE o_orderpriority END AS priority FROM orders)"""


def holed(s: Shop):
    """Orders with missing customers and blank priorities."""
    key = F.col("o_orderkey")
    return s.orders.select(
        key,
        "o_orderstatus",
        F.when(key % 7 != 0, F.col("o_custkey")).alias("cust"),
        F.when(key % 9 == 0, "  ").otherwise(F.col("o_orderpriority")).alias("priority"),
    )


def order_rules() -> list[chk.Check]:
    return [
        chk.RowCheck("not_null_cust", F.col("cust").isNull(), error_if="> 5000", warn_if="> 100"),
        chk.RowCheck("blank_priority", F.trim("priority") == ""),
        chk.RowCheck("positive_key", ~(F.col("o_orderkey") >= 0), error_if="= 0"),
        chk.RowCheck("known_status", ~F.col("o_orderstatus").isin("P", "O", "F")),
        chk.FrameCheck("unique_cust", lambda df: C.unique(df, "cust"), warn_if="> 1000000", error_if="> 1000000"),
    ]


@query(
    "dq00_check_verdicts",
    f"""WITH t AS (SELECT * FROM {HOLED}), f AS (
        SELECT 'not_null_cust' AS check_name, count(*) FILTER (cust IS NULL) AS failures FROM t
        UNION ALL SELECT 'blank_priority', count(*) FILTER (trim(priority) = '') FROM t
        UNION ALL SELECT 'positive_key', count(*) FILTER (NOT o_orderkey >= 0) FROM t
        UNION ALL SELECT 'known_status', count(*) FILTER (o_orderstatus NOT IN ('P', 'O', 'F')) FROM t
        UNION ALL SELECT 'unique_cust', count(*) FROM (SELECT cust FROM t WHERE cust IS NOT NULL GROUP BY 1
          HAVING count(*) > 1))
        SELECT *, CASE check_name
          WHEN 'not_null_cust' THEN CASE WHEN failures > 5000 THEN 'error' WHEN failures > 100 THEN 'warn' ELSE 'pass' END
          WHEN 'positive_key' THEN CASE WHEN failures = 0 THEN 'error' ELSE 'warn' END
          WHEN 'unique_cust' THEN CASE WHEN failures > 1000000 THEN 'error' ELSE 'pass' END
          ELSE CASE WHEN failures <> 0 THEN 'error' ELSE 'pass' END END AS verdict FROM f""",
)
def _(s: Shop):
    rules = order_rules()
    return chk.with_verdict(chk.failures(holed(s), rules), rules)


@query("dq01_not_null", f"SELECT o_orderkey FROM {HOLED} WHERE cust IS NULL")
def _(s: Shop):
    return C.not_null(holed(s), "cust").select("o_orderkey")


@query(
    "dq02_unique",
    f"""SELECT cust AS unique_field, count(*) AS n_records FROM {HOLED} WHERE cust IS NOT NULL
        GROUP BY 1 HAVING count(*) > 1""",
)
def _(s: Shop):
    return C.unique(holed(s), "cust")


@query(
    "dq03_not_null_proportion",
    f"""SELECT o_orderstatus, round(count(cust) / count(*), 6) AS not_null_proportion FROM {HOLED}
        GROUP BY 1 HAVING count(cust) / count(*) < 0.9""",
)
def _(s: Shop):
    return rounded(C.not_null_proportion(holed(s), "cust", 0.9, by=["o_orderstatus"]), 6, "not_null_proportion")


@query(
    "dq04_accepted_values",
    """SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""",
)
def _(s: Shop):
    return C.accepted_values(s.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query(
    "dq05_not_accepted_values",
    """SELECT c_mktsegment AS value_field, count(*) AS n_records FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'NONE') GROUP BY 1""",
)
def _(s: Shop):
    return C.not_accepted_values(s.customer, "c_mktsegment", ["BUILDING", "NONE"])


@query(
    "dq06_relationships",
    """SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS l_partkey FROM lineitem
       WHERE l_partkey + l_suppkey NOT IN (SELECT p_partkey FROM part)""",
)
def _(s: Shop):
    shifted = s.lineitem.withColumn("l_partkey", F.col("l_partkey") + F.col("l_suppkey"))  # some beyond all parts
    return C.relationships(shifted, "l_partkey", s.part, "p_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    "dq07_relationships_where",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'
       AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def _(s: Shop):
    return C.relationships_where(
        s.orders, "o_custkey", s.customer, "c_custkey", F.col("o_orderstatus") == "F", "c_acctbal > 0"
    ).select("o_orderkey")


@query(
    "dq08_accepted_range",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 3 OR l_quantity > 45
       UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 3""",
)
def _(s: Shop):
    keys = ("l_orderkey", "l_linenumber", "l_quantity")
    closed = C.accepted_range(s.lineitem, "l_quantity", 3, 45).select(*keys)
    return closed.unionByName(C.accepted_range(s.lineitem, "l_quantity", 3, None, inclusive=False).select(*keys))


@query(
    "dq09_at_least_one",
    """SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS n_values FROM orders
       GROUP BY 1 HAVING count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) = 0""",
)
def _(s: Shop):
    canceled = s.orders.select("o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("v"))
    return C.at_least_one(canceled, "v", ["o_custkey"])


@query(
    "dq10_cardinality_equality",
    """WITH a AS (SELECT c_nationkey AS value_field, count(*) AS num_rows FROM customer GROUP BY 1),
       b AS (SELECT s_nationkey AS value_field, count(*) AS num_rows FROM supplier GROUP BY 1)
       SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL
       SELECT * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def _(s: Shop):
    return C.cardinality_equality(s.customer, "c_nationkey", s.supplier, "s_nationkey")


@query(
    "dq11_equal_rowcount",
    """SELECT a.k AS nation_a, b.k AS nation_b, count_a, count_b, abs(count_a - count_b) AS diff_count
       FROM (SELECT c_nationkey AS k, count(*) AS count_a FROM customer GROUP BY 1) a
       FULL JOIN (SELECT s_nationkey AS k, count(*) AS count_b FROM supplier GROUP BY 1) b
       ON a.k = b.k""",
)
def _(s: Shop):
    a = s.customer.select(F.col("c_nationkey").alias("nation"))
    b = s.supplier.select(F.col("s_nationkey").alias("nation"))
    return C.equal_rowcount(a, b, ["nation"])


@query(
    "dq12_equality",
    """WITH a AS (SELECT o_orderkey, o_custkey, round(o_totalprice, 0) AS o_totalprice FROM orders),
       b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 5 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
         round(o_totalprice, 0) AS o_totalprice FROM orders)
       SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
       UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def _(s: Shop):
    key = F.col("o_orderkey")
    base = s.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    moved = F.when(key % 100 == 5, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    other = base.withColumn("o_custkey", moved).withColumn("o_totalprice", F.col("o_totalprice") + 0.0001)
    diff = C.equality(base, other, exclude_columns=["O_ORDERSTATUS"], precision=0)
    return diff.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(
    "dq13_expression_is_true",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_extendedprice * l_discount < 5000)
       UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_quantity > 1)""",
)
def _(s: Shop):
    keys = ("l_orderkey", "l_linenumber")
    costly = C.expression_is_true(s.lineitem, "l_extendedprice * l_discount < 5000").select(*keys)
    return costly.unionByName(C.expression_is_true(s.lineitem, "> 1", column="l_quantity").select(*keys))


@query(
    "dq14_fewer_rows_than",
    """SELECT a.k AS nation_a, b.k AS nation_b, count_our_model, count_comparison_model,
         CASE WHEN count_our_model > count_comparison_model THEN count_our_model - count_comparison_model
              WHEN count_our_model = count_comparison_model THEN 1 ELSE 0 END AS row_count_delta
       FROM (SELECT s_nationkey AS k, count(*) AS count_our_model FROM supplier GROUP BY 1) a
       FULL JOIN (SELECT c_nationkey AS k, count(*) AS count_comparison_model FROM customer GROUP BY 1) b ON a.k = b.k""",
)
def _(s: Shop):
    a = s.supplier.select(F.col("s_nationkey").alias("nation"))
    b = s.customer.select(F.col("c_nationkey").alias("nation"))
    return C.fewer_rows_than(a, b, ["nation"])


def _ranges(s: Shop):
    """Validity ranges of orders per customer; cancelled orders have length zero."""
    days = F.when(F.col("o_orderstatus") == "F", 0).otherwise(F.col("o_orderkey") % 90)
    start = F.to_date("o_orderdate")
    return s.orders.select("o_custkey", start.alias("valid_from"), F.date_add(start, days.cast("int")).alias("valid_to"))


def _ranges_sql(proper: str, separate: str, partition: str = "o_custkey") -> str:
    return f"""WITH r AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS lower_bound, CAST(o_orderdate AS DATE)
         + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_orderkey % 90 END::INT AS upper_bound FROM orders),
       w AS (SELECT *, lead(lower_bound) OVER o AS next_lower_bound, lead(1) OVER o IS NULL AS is_last_record FROM r
         WINDOW o AS (PARTITION BY {partition} ORDER BY lower_bound, upper_bound))
       SELECT {partition}, lower_bound, upper_bound, next_lower_bound, is_last_record FROM w
       WHERE NOT (coalesce(lower_bound {proper} upper_bound, FALSE)
         AND coalesce(upper_bound {separate} next_lower_bound, is_last_record))"""


@query("dq15_mutually_exclusive_ranges", _ranges_sql("<=", "<="))
def _(s: Shop):
    return C.mutually_exclusive_ranges(_ranges(s), "valid_from", "valid_to", ["o_custkey"], zero_length=True)


@query("dq15_ranges_without_gaps", _ranges_sql("<", "="))
def _(s: Shop):
    return C.mutually_exclusive_ranges(_ranges(s), "valid_from", "valid_to", ["o_custkey"], gaps="not_allowed")


@query("dq15_ranges_with_required_gaps", _ranges_sql("<", "<"))
def _(s: Shop):
    return C.mutually_exclusive_ranges(_ranges(s), "valid_from", "valid_to", ["o_custkey"], gaps="required")


@query(
    "dq16_not_constant",
    """SELECT o_custkey, 1::BIGINT AS n_distinct FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1""",
)
def _(s: Shop):
    return C.not_constant(s.orders, "o_orderstatus", ["o_custkey"])


@query("dq17_not_empty_string", f"SELECT o_orderkey FROM {HOLED} WHERE trim(priority) = ''")
def _(s: Shop):
    return C.not_empty_string(holed(s), "priority").select("o_orderkey")


AS_OF = "2024-01-31"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


@query(
    "dq18_recency",
    """SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 12:00:00' AS threshold FROM events
       GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'""",
)
def _(s: Shop):
    return C.recency(s.events, "ts", "hour", 12, as_of(), by=["user_id"])


@query(
    "dq18_recency_by_day",
    """SELECT event_type, max(ts)::DATE AS most_recent, DATE '2024-02-07' AS threshold FROM events
       GROUP BY 1 HAVING max(ts)::DATE < DATE '2024-02-07'""",
)
def _(s: Shop):
    later = F.lit("2024-02-08").cast("timestamp")
    return C.recency(s.events, "ts", "day", 1, later, ignore_time=True, by=["event_type"])


@query(
    "dq19_sequential_values",
    """SELECT l_suppkey, l_orderkey, previous_value FROM (
         SELECT l_suppkey, l_orderkey, lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey)
           AS previous_value FROM lineitem) WHERE NOT (l_orderkey = previous_value + 1)""",
)
def _(s: Shop):
    return C.sequential_values(s.lineitem, "l_orderkey", by=["l_suppkey"])


@query(
    "dq19_sequential_dates",
    """SELECT day, previous_value FROM (SELECT day, lag(day) OVER (ORDER BY day) AS previous_value
         FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders))
       WHERE day <> previous_value + 1""",
)
def _(s: Shop):
    days = s.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return C.sequential_values(days, "day", part="day")


@query(
    "dq20_unique_combination",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(s: Shop):
    return C.unique_combination(s.lineitem, ["l_orderkey", "l_linenumber"])


# --- marketplace rules ----------------------------------------------------------------


@query(
    "dq21_single_installment",
    STAR
    + """SELECT order_id, payment_sequential, payment_installments FROM fct_payments
      WHERE payment_type = 'boleto' AND payment_installments <> 1""",
)
def _(s: Shop):
    return C.single_installment(s.star["fct_payments"])


@query(
    "dq22_date_key_range",
    STAR
    + " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, date_key FROM {t} WHERE date_key NOT BETWEEN '1996-01-01' AND '2000-12-31'"
        for t in ("fct_sales", "fct_reviews", "fct_payments")
    ),
)
def _(s: Shop):
    facts = {t: s.star[t] for t in ("fct_sales", "fct_reviews", "fct_payments")}
    return C.date_key_range(facts, "1996-01-01", "2000-12-31")


@query(
    "dq23_payment_reconciliation",
    STAR
    + """SELECT order_id, round(abs(paid - sold), 4) AS diff
      FROM (SELECT order_id, sum(payment_value) AS paid, max(payment_installments) AS plan FROM fct_payments GROUP BY 1)
      JOIN (SELECT order_id, sum(total_sale_amount) AS sold FROM fct_sales GROUP BY 1) USING (order_id)
      WHERE plan = 1 AND abs(paid - sold) > 20""",
)
def _(s: Shop):
    return rounded(C.payment_reconciliation(s.star["fct_payments"], s.star["fct_sales"]), 4, "diff")


GATED_ROWS = {"dim_date": (100, 10_000), "fct_sales": (1, 10**12), "fct_reviews": (1, 10**12)}
FACT_DATES = ("1995-01-01", "2001-12-31")


@query(
    "dq24_gated_build",
    STAR
    + """SELECT * FROM (VALUES ('stg_orders', 'failed', 'approved_after_purchase',
        (SELECT count(*) FROM stg_orders WHERE order_approved_at < order_purchase_timestamp)),
      ('stg_order_items', 'failed', 'unique_order_id_order_item_id',
        (SELECT count(*) FROM (SELECT 1 FROM stg_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1))),
      ('stg_customers', 'built', NULL, NULL), ('stg_payments', 'built', NULL, NULL),
      ('stg_reviews', 'built', NULL, NULL), ('stg_products', 'built', NULL, NULL),
      ('stg_geolocation', 'built', NULL, NULL), ('stg_sellers', 'built', NULL, NULL),
      ('stg_category_translation', 'built', NULL, NULL), ('dim_date', 'built', NULL, NULL),
      ('dim_customers', 'built', NULL, NULL), ('dim_products', 'built', NULL, NULL),
      ('dim_sellers', 'built', NULL, NULL), ('fct_sales', 'skipped', NULL, NULL),
      ('fct_reviews', 'skipped', NULL, NULL), ('fct_payments', 'skipped', NULL, NULL))
      t(table_name, status, check_name, failures)""",
)
def _(s: Shop):
    """Raw text to star schema; facts built on the two failing staging tables are skipped."""
    _, report = build.gated_build(
        s.spark,
        build.marketplace_steps(s.raw, s.calendar),
        build.suite_for(GATED_ROWS, FACT_DATES),
        scratch_path(s.spark, "build"),
    )
    return report


def _fails(table: str, check: str, sql: str) -> str:
    return f"SELECT '{table}' AS table_name, '{check}' AS check_name, ({sql})::BIGINT AS failures"


FAILING_CHECKS = (
    ("stg_orders", "approved_after_purchase",
     "SELECT count(*) FROM stg_orders WHERE order_approved_at < order_purchase_timestamp"),
    ("stg_order_items", "unique_order_id_order_item_id",
     "SELECT count(*) FROM (SELECT 1 FROM stg_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1)"),
    ("fct_sales", "unique_order_id_order_item_id",
     "SELECT count(*) FROM (SELECT 1 FROM fct_sales GROUP BY order_id, order_item_id HAVING count(*) > 1)"),
    ("fct_payments", "single_installment",
     "SELECT count(*) FROM fct_payments WHERE payment_type = 'boleto' AND payment_installments <> 1"),
    ("fct_payments", "reconciliation",
     """SELECT count(*) FROM (SELECT order_id, sum(payment_value) AS paid, max(payment_installments) AS plan
          FROM fct_payments GROUP BY 1)
        JOIN (SELECT order_id, sum(total_sale_amount) AS sold FROM fct_sales GROUP BY 1) USING (order_id)
        WHERE plan = 1 AND abs(paid - sold) > 20"""),
)


@query(
    "dq25_declared_suite",
    STAR + " UNION ALL ".join(_fails(t, c, q) for t, c, q in FAILING_CHECKS) + " UNION ALL SELECT 'all', 'checks', 78",
)
def _(s: Shop):
    """Failing checks of the whole suite, and how many checks ran."""
    translation = staging.stg_category_translation(s.raw["category_translation"])
    tables = {**s.star, **s.staging, "stg_category_translation": translation}
    rules = build.suite_for(GATED_ROWS, FACT_DATES)
    _, verdicts = build.checked_tables(s.spark, tables, rules, scratch_path(s.spark, "suite"))
    verdicts = verdicts.select("table_name", "check_name", "failures")
    ran = verdicts.agg(F.count("*").alias("failures"))
    return verdicts.filter("failures > 0").unionByName(
        ran.select(F.lit("all").alias("table_name"), F.lit("checks").alias("check_name"), "failures")
    )
