"""Profiling reports over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartmill.catalog.checks import HOLED, holed
from cartmill.catalog.common import rounded, scratch_path
from cartmill.catalog.registry import query
from cartmill.catalog.shop import Shop
from cartmill.catalog.shop_sql import STAGING
from cartmill.operators import profiling as prf
from cartmill.sources.tables import table_counts


@query(
    "prf01_null_counts",
    f"""SELECT * FROM (SELECT 'cust' AS column_name, count(*) FILTER (cust IS NULL) AS blank_count FROM {HOLED}
        UNION ALL SELECT 'priority', count(*) FILTER (trim(priority) = '') FROM {HOLED}) WHERE blank_count > 0""",
)
def _(s: Shop):
    return prf.null_counts(holed(s))


@query(
    "prf02_null_report",
    STAGING
    + """SELECT 'stg_orders' AS table_name, c AS column_name, n AS total_rows, x AS null_count,
      round(100 * x / n, 2) AS null_pct FROM (
        SELECT 'order_approved_at' AS c, count(*) AS n, count(*) FILTER (order_approved_at IS NULL) AS x FROM stg_orders
        UNION ALL SELECT 'order_delivered_customer_date', count(*),
          count(*) FILTER (order_delivered_customer_date IS NULL) FROM stg_orders)
      UNION ALL SELECT 'stg_reviews', 'review_score', count(*), 0, 0 FROM stg_reviews""",
)
def _(s: Shop):
    return prf.null_report(
        {
            "stg_orders": (s.headers, ["order_approved_at", "order_delivered_customer_date"]),
            "stg_reviews": (s.reviews, ["review_score"]),
        }
    )


@query(
    "prf03_empty_string_report",
    STAGING
    + """SELECT column_name, total_rows, empty_count, round(100 * empty_count / total_rows, 2) AS empty_pct FROM (
        SELECT 'review_comment_title' AS column_name, count(*) AS total_rows,
          count(*) FILTER (review_comment_title = '') AS empty_count FROM stg_reviews
        UNION ALL SELECT 'review_comment_message', count(*), count(*) FILTER (review_comment_message = '')
        FROM stg_reviews)""",
)
def _(s: Shop):
    return prf.empty_string_report(s.reviews, ["review_comment_title", "review_comment_message"])


@query("prf04_value_distribution", "SELECT o_orderpriority, count(*) AS n_rows FROM orders GROUP BY 1")
def _(s: Shop):
    return prf.value_distribution(s.orders, "o_orderpriority")


@query(
    "prf05_numeric_range",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value,
            count(*) FILTER ({c} <= 0) AS not_positive, count(*) FILTER ({c} < 0) AS negative FROM customer"""
        for c in ("c_acctbal", "c_custkey")
    ),
)
def _(s: Shop):
    return prf.numeric_range(s.customer, ["c_acctbal", "c_custkey"])


@query(
    "prf06_row_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("pages", "documents", "conversations")
    ),
)
def _(s: Shop):
    return table_counts({t: s.table(t) for t in ("pages", "documents", "conversations")})


@query(
    "prf07_key_multiplicity",
    """SELECT count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys, max(n) AS max_rows_per_key,
       round(avg(n), 6) AS avg_rows_per_key FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def _(s: Shop):
    return rounded(prf.key_multiplicity(s.lineitem, ["l_orderkey", "l_linenumber"]), 6, "avg_rows_per_key")


@query(
    "prf08_format_violations",
    """SELECT count(*) AS total_rows, count(*) FILTER (NOT regexp_matches(
         CASE WHEN c_custkey % 13 = 0 THEN 'x' || c_custkey ELSE lpad(c_custkey::VARCHAR, 5, '0') END, '^[0-9]{5}$'))
         AS violations FROM customer""",
)
def _(s: Shop):
    key = F.col("c_custkey")
    text = F.when(key % 13 == 0, F.concat(F.lit("x"), key)).otherwise(F.lpad(key.cast("string"), 5, "0"))
    return prf.format_violations(s.customer.select(text.alias("zip")), "zip")


@query(
    "prf09_top_values",
    STAGING
    + """SELECT customer_state, count(*) AS n_rows FROM stg_customers GROUP BY 1
      ORDER BY n_rows DESC, customer_state LIMIT 10""",
)
def _(s: Shop):
    return prf.top_values(s.customers, "customer_state", 10)


@query(
    "prf10_conditional_distribution",
    STAGING
    + """SELECT payment_installments, count(*) AS n_rows FROM stg_payments WHERE payment_type = 'boleto' GROUP BY 1""",
)
def _(s: Shop):
    return prf.value_distribution(s.payments, "payment_installments", F.col("payment_type") == "boleto")


@query(
    "prf11_box_outliers",
    STAGING
    + """SELECT count(*) FILTER (geolocation_lat NOT BETWEEN -35 AND 5) AS geolocation_lat_outside,
      count(*) FILTER (geolocation_lng NOT BETWEEN -75 AND -34) AS geolocation_lng_outside FROM points""",
)
def _(s: Shop):
    return prf.box_outliers(s.points, {"geolocation_lat": (-35.0, 5.0), "geolocation_lng": (-75.0, -34.0)})


@query(
    "prf12_match_rate",
    STAGING
    + """SELECT count(*) AS distinct_keys, count(z) AS matched_keys, sum(n)::BIGINT AS total_rows,
      (sum(n) FILTER (z IS NOT NULL))::BIGINT AS matched_rows, round(count(z) / count(*), 6) AS key_match_rate,
      round(sum(n) FILTER (z IS NOT NULL) / sum(n), 6) AS row_match_rate
      FROM (SELECT customer_zip_code_prefix AS k, count(*) AS n FROM stg_customers GROUP BY 1)
      LEFT JOIN (SELECT zip_code_prefix AS z FROM stg_geolocation) ON k = z""",
)
def _(s: Shop):
    rate = prf.match_rate(s.customers, "customer_zip_code_prefix", s.locations, "zip_code_prefix")
    return rounded(rate, 6, "key_match_rate", "row_match_rate")


@query(
    "prf13_missing_keys",
    STAGING
    + """SELECT 'orders-payments' AS pair, count(*) AS missing_keys FROM (
        SELECT DISTINCT order_id FROM stg_orders EXCEPT SELECT order_id FROM stg_payments)
      UNION ALL SELECT 'orders-reviews', count(*) FROM (
        SELECT DISTINCT order_id FROM stg_orders EXCEPT SELECT order_id FROM stg_reviews)
      UNION ALL SELECT 'orders-items', count(*) FROM (
        SELECT DISTINCT order_id FROM stg_orders EXCEPT SELECT order_id FROM stg_order_items)
      UNION ALL SELECT 'orders-customers', count(*) FROM (
        SELECT DISTINCT customer_id FROM stg_orders EXCEPT SELECT customer_id FROM stg_customers)
      UNION ALL SELECT 'customers-orders', count(*) FROM (
        SELECT DISTINCT customer_id FROM stg_customers EXCEPT SELECT customer_id FROM stg_orders)""",
)
def _(s: Shop):
    return prf.missing_keys(
        {
            "orders-payments": (s.headers, "order_id", s.payments, "order_id"),
            "orders-reviews": (s.headers, "order_id", s.reviews, "order_id"),
            "orders-items": (s.headers, "order_id", s.items, "order_id"),
            "orders-customers": (s.headers, "customer_id", s.customers, "customer_id"),
            "customers-orders": (s.customers, "customer_id", s.headers, "customer_id"),
        }
    )


@query(
    "prf13_itemless_orders",
    STAGING
    + """SELECT order_status, count(*) AS itemless_orders,
      count(*) FILTER (order_id IN (SELECT order_id FROM stg_reviews)) AS reviewed_orders
      FROM stg_orders WHERE order_id NOT IN (SELECT order_id FROM stg_order_items) GROUP BY 1""",
)
def _(s: Shop):
    return prf.itemless_orders(s.headers, s.items, s.reviews)


@query(
    "prf14_untranslated_categories",
    """SELECT DISTINCT p_brand AS product_category_name FROM part WHERE p_brand LIKE '%5' AND p_partkey % 50 <> 0""",
)
def _(s: Shop):
    return prf.values_missing_from(
        s.products, "product_category_name", s.raw["category_translation"], "product_category_name"
    )


@query(
    "prf15_fill_rate",
    STAGING
    + """SELECT 'review_comment_title' AS column_name, round(avg((review_comment_title <> '')::INT), 6)
        AS not_null_proportion FROM stg_reviews
        HAVING avg((review_comment_title <> '')::INT) < 0.2
      UNION ALL SELECT 'review_comment_message', round(avg((review_comment_message <> '')::INT), 6) FROM stg_reviews
        HAVING avg((review_comment_message <> '')::INT) < 0.2""",
)
def _(s: Shop):
    out = None
    for column in ("review_comment_title", "review_comment_message"):
        part = prf.fill_rate_violations(s.reviews, column, 0.2).select(
            F.lit(column).alias("column_name"), F.round("not_null_proportion", 6).alias("not_null_proportion")
        )
        out = part if out is None else out.unionByName(part)
    return out


PROFILED = {"customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
            "events": ("event_id", "ts", "user_id", "event_type", "value", "props")}


@query(
    "prf16_profile_report",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{m}' AS metric, {v} AS value FROM {t}"
        for t, columns in PROFILED.items()
        for c in columns
        for m, v in (
            ("rows", "count(*)"),
            ("blanks", f"count(*) FILTER (trim({c}::VARCHAR) = '' OR {c} IS NULL)"),
            ("filled", f"count({c})"),
        )
    ),
)
def _(s: Shop):
    """Written as JSON per table and read back."""
    path = scratch_path(s.spark, "profile")
    prf.write_profile(prf.profile({t: s.table(t) for t in PROFILED}), path)
    schema = "column_name string, metric string, value bigint, table_name string"
    return s.spark.read.schema(schema).json(path)
