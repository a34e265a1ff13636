"""Data expectations over the driver tables: each query returns the failing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartmill.catalog.checks import HOLED, as_of, holed
from cartmill.catalog.common import longs, rounded
from cartmill.catalog.registry import query
from cartmill.catalog.shop import Shop
from cartmill.operators import expectations as X

LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINES = ", ".join(LINE)

# --- base forms -----------------------------------------------------------------------


@query(
    "ex01_expression_is_true",
    """SELECT o_custkey, FALSE AS expression FROM orders WHERE o_orderstatus <> 'P'
       GROUP BY 1 HAVING NOT (sum(o_totalprice) < 1500000)""",
)
def _(s: Shop):
    return X.expression_is_true(
        s.orders, F.sum("o_totalprice") < 1_500_000, by=["o_custkey"], row_condition="o_orderstatus <> 'P'"
    )


@query(
    "ex02_expression_between",
    f"SELECT {LINES} FROM lineitem WHERE NOT (l_extendedprice / l_quantity > 950 AND l_extendedprice / l_quantity < 4000)",
)
def _(s: Shop):
    return X.expression_between(
        s.lineitem, F.col("l_extendedprice") / F.col("l_quantity"), 950, 4000, strictly=True
    ).select(*LINE)


def _pair_sql(a: str, b: str, where: str) -> str:
    return f"""SELECT coalesce(a.k, b.k) AS col_1, x AS expression, y AS compare_expression,
        abs(coalesce(x, 0) - coalesce(y, 0)) AS expression_difference,
        round(abs(coalesce(x, 0) - coalesce(y, 0)) / nullif(x * 1.0, 0), 6) AS expression_difference_percent
        FROM ({a}) a FULL JOIN ({b}) b ON a.k = b.k WHERE {where}"""


@query(
    "ex03_equal_expression",
    _pair_sql(
        "SELECT c_nationkey AS k, count(*) AS x FROM customer WHERE c_nationkey <> 4 GROUP BY 1",
        "SELECT s_nationkey AS k, count(*) * 15 AS y FROM supplier GROUP BY 1",
        "abs(coalesce(x, 0) - coalesce(y, 0)) > 10",
    ),
)
def _(s: Shop):
    out = X.equal_expression(
        s.customer, F.count("*"), s.supplier, F.count("*") * 15, by=["c_nationkey"], other_by=["s_nationkey"],
        row_condition="c_nationkey <> 4", other_row_condition="true", tolerance=10,
    )
    return rounded(out, 6, "expression_difference_percent")


@query(
    "ex03_equal_expression_percent",
    _pair_sql(
        "SELECT c_nationkey AS k, count(*) AS x FROM customer GROUP BY 1",
        "SELECT s_nationkey AS k, count(*) * 15 AS y FROM supplier GROUP BY 1",
        "abs(coalesce(x, 0) - coalesce(y, 0)) / nullif(x * 1.0, 0) > 0.25",
    ),
)
def _(s: Shop):
    out = X.equal_expression(
        s.customer, F.count("*"), s.supplier, F.count("*") * 15, by=["c_nationkey"], other_by=["s_nationkey"],
        tolerance_percent=0.25,
    )
    return rounded(out, 6, "expression_difference_percent")


@query(
    "ex04_ignore_row_if",
    """SELECT count(*) FILTER (NOT (a IS NULL AND b IS NULL)) AS kept_unless_all,
       count(*) FILTER (NOT (a IS NULL OR b IS NULL)) AS kept_unless_any
       FROM (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN 1 END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN 1 END AS b
             FROM orders)""",
)
def _(s: Shop):
    key = F.col("o_orderkey")
    df = s.orders.select(F.when(key % 3 != 0, 1).alias("a"), F.when(key % 5 != 0, 1).alias("b"))
    return df.agg(
        F.count_if(X.keep_row("all_values_are_missing", ["a", "b"])).alias("kept_unless_all"),
        F.count_if(X.keep_row("any_value_is_missing", ["a", "b"])).alias("kept_unless_any"),
    )


# --- column values --------------------------------------------------------------------


@query("ex05_values_between", f"SELECT {LINES} FROM lineitem WHERE l_linestatus = 'F' AND NOT l_quantity BETWEEN 5 AND 40")
def _(s: Shop):
    return X.values_between(s.lineitem, "l_quantity", 5, 40, row_condition="l_linestatus = 'F'").select(*LINE)


def _lag_sql(value: str, sort: str, by: str, table: str, bad: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""SELECT {keys}sort_column, value_field, value_field_lag FROM (
      SELECT {keys}{sort} AS sort_column, {value} AS value_field,
        lag({value}) OVER ({part} ORDER BY {sort}, {value}) AS value_field_lag FROM {table})
      WHERE value_field_lag IS NOT NULL AND ({bad})"""


@query("ex06_values_increasing", _lag_sql("value", "ts", "user_id", "events", "NOT value_field >= value_field_lag"))
def _(s: Shop):
    return X.values_increasing(s.events, "value", "ts", strictly=False, by=["user_id"])


@query("ex06_values_decreasing", _lag_sql("value", "ts", "", "events", "NOT value_field < value_field_lag"))
def _(s: Shop):
    """No group: the order runs over the whole table."""
    return X.values_decreasing(s.events, "value", "ts")


@query(
    "ex06_values_increasing_by_step",
    _lag_sql(
        "event_id", "ts", "", "events",
        "NOT (value_field > value_field_lag AND value_field - value_field_lag = 1)",
    )
    + " UNION ALL "
    + _lag_sql("o_orderkey", "o_orderkey", "", "orders", "NOT (value_field > value_field_lag AND value_field - value_field_lag = 2)").replace(
        "o_orderkey AS sort_column", "to_timestamp(o_orderkey)::TIMESTAMP AS sort_column"
    ),
)
def _(s: Shop):
    events = X.values_increasing(s.events, "event_id", "ts", step=1)
    orders = X.values_increasing(s.orders, "o_orderkey", step=2)
    as_time = F.timestamp_seconds("sort_column").cast("timestamp_ntz")
    return events.unionByName(orders.withColumn("sort_column", as_time))


@query("ex07_values_in_set", f"SELECT o_orderkey FROM {HOLED} WHERE cust IS NULL OR cust NOT IN (1, 2, 3, 899, 769)")
def _(s: Shop):
    return X.values_in_set(holed(s), "cust", [1, 2, 3, 899, 769]).select("o_orderkey")


@query("ex08_values_not_in_set", f"SELECT o_orderkey FROM {HOLED} WHERE cust IN (1, 2, 3, 899, 769)")
def _(s: Shop):
    return X.values_not_in_set(holed(s), "cust", [1, 2, 3, 899, 769]).select("o_orderkey")


def _with_rows(findings, table):
    """Schema findings next to the number of rows they concern."""
    return findings.crossJoin(table.agg(F.count("*").alias("rows_concerned")))


@query(
    "ex10_values_null",
    f"""SELECT 'null' AS rule, o_orderkey FROM {HOLED} WHERE cust IS NOT NULL AND o_orderstatus = 'F'
        UNION ALL SELECT 'not_null', o_orderkey FROM {HOLED} WHERE cust IS NULL AND o_orderstatus = 'F'""",
)
def _(s: Shop):
    condition = "o_orderstatus = 'F'"
    null = X.values_null(holed(s), "cust", condition).select(F.lit("null").alias("rule"), "o_orderkey")
    filled = X.values_not_null(holed(s), "cust", condition).select(F.lit("not_null").alias("rule"), "o_orderkey")
    return null.unionByName(filled)


@query(
    "ex11_values_unique",
    f"SELECT cust, count(*) AS n_records FROM {HOLED} WHERE cust IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
def _(s: Shop):
    return X.values_unique(holed(s), "cust")


CASED = """(SELECT CASE WHEN c_custkey % 3 = 0 AND c_mktsegment <> 'BUILDING' THEN lower(c_mktsegment)
            ELSE c_mktsegment END AS segment FROM customer)"""


def _cased(s: Shop):
    low = (F.col("c_custkey") % 3 == 0) & (F.col("c_mktsegment") != "BUILDING")
    spelled = F.when(low, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    return s.customer.select(spelled.alias("segment"))


@query(
    "ex12_consistent_casing",
    f"""SELECT count(DISTINCT segment) AS set_count, count(DISTINCT lower(segment)) AS set_count_case_insensitive
        FROM {CASED} HAVING count(DISTINCT segment) <> count(DISTINCT lower(segment))""",
)
def _(s: Shop):
    return X.consistent_casing(_cased(s), "segment")


@query(
    "ex12_inconsistent_spellings",
    f"""SELECT lower(segment) AS inconsistent_columns, count(DISTINCT segment) AS set_count_case_insensitive
        FROM {CASED} GROUP BY 1 HAVING count(DISTINCT segment) > 1""",
)
def _(s: Shop):
    return X.consistent_casing(_cased(s), "segment", display=True)


# --- aggregates -----------------------------------------------------------------------


def _aggregate_sql(measure: str, by: str, table: str, bad: str) -> str:
    return f"SELECT * FROM (SELECT {by}, {measure} AS measured FROM {table} GROUP BY 1) WHERE {bad}"


@query(
    "ex13_distinct_count_equal",
    _aggregate_sql("count(DISTINCT o_orderpriority)", "o_custkey", "orders", "measured <> 5"),
)
def _(s: Shop):
    return X.distinct_count_equal(s.orders, "o_orderpriority", 5, ["o_custkey"])


@query(
    "ex14_distinct_count_greater_less",
    _aggregate_sql("count(DISTINCT o_orderpriority)", "o_custkey", "orders", "NOT measured > 4")
    + " UNION ALL "
    + _aggregate_sql("count(DISTINCT o_orderstatus)", "o_custkey", "orders", "NOT measured < 3"),
)
def _(s: Shop):
    above = X.distinct_count_greater_than(s.orders, "o_orderpriority", 4, ["o_custkey"])
    return above.unionByName(X.distinct_count_less_than(s.orders, "o_orderstatus", 3, ["o_custkey"]))


SCALAR_PAIR = """SELECT x AS expression, y AS compare_expression, abs(x - y) AS expression_difference,
    round(abs(x - y) / nullif(x * 1.0, 0), 6) AS expression_difference_percent FROM ({a}), ({b}) WHERE abs(x - y) > 0"""


@query(
    "ex15_distinct_count_equal_other_table",
    SCALAR_PAIR.format(
        a="SELECT count(DISTINCT o_custkey) AS x FROM orders WHERE o_orderstatus = 'F'",
        b="SELECT count(DISTINCT c_custkey) AS y FROM customer"
    ),
)
def _(s: Shop):
    out = X.distinct_count_equal_other_table(
        s.orders, "o_custkey", s.customer, "c_custkey", "o_orderstatus = 'F'", "true"
    )
    return rounded(out, 6, "expression_difference_percent")


@query(
    "ex16_distinct_values_in_set",
    f"SELECT DISTINCT cust AS value_field FROM {HOLED} WHERE cust IS NULL OR cust NOT IN (1, 2, 3)",
)
def _(s: Shop):
    return X.distinct_values_in_set(holed(s), "cust", [1, 2, 3])


@query(
    "ex17_distinct_values_contain_set",
    """SELECT unnest(['BUILDING', 'NONE', 'MACHINERY', 'OTHER']) AS value_field
       EXCEPT SELECT DISTINCT c_mktsegment FROM customer""",
)
def _(s: Shop):
    return X.distinct_values_contain_set(s.customer, "c_mktsegment", ["BUILDING", "NONE", "MACHINERY", "OTHER", "NONE"])


@query(
    "ex18_distinct_values_equal_set",
    """SELECT column_value, value_field FROM (SELECT DISTINCT c_mktsegment AS column_value FROM customer)
       FULL JOIN (SELECT unnest(['BUILDING', 'NONE', 'MACHINERY']) AS value_field) ON column_value = value_field
       WHERE column_value IS NULL OR value_field IS NULL""",
)
def _(s: Shop):
    return X.distinct_values_equal_set(s.customer, "c_mktsegment", ["BUILDING", "NONE", "MACHINERY"])


def _bounded(name: str, function, measure: str, bad: str, digits: int | None, *args, **kwargs):
    """Register an aggregate expectation over order totals per customer."""
    shown = f"round({measure}, {digits})" if digits is not None else measure

    @query(
        name,
        f"""SELECT o_custkey, {shown} AS measured FROM orders GROUP BY 1
            HAVING NOT ({bad.replace("measured", measure)})""",
    )
    def _(s: Shop):
        out = function(s.orders, *args, by=["o_custkey"], **kwargs)
        return out if digits is None else rounded(out, digits, "measured")


_bounded("ex19_max_between", X.max_between, "max(o_totalprice)", "measured <= 480000", None, "o_totalprice", None, 480_000)
_bounded("ex20_min_between", X.min_between, "min(o_totalprice)", "measured >= 20000", None, "o_totalprice", 20_000)
_bounded(
    "ex21_mean_between", X.mean_between, "avg(o_totalprice)", "measured BETWEEN 200000 AND 300000", 6,
    "o_totalprice", 200_000, 300_000,
)
_bounded(
    "ex22_median_between", X.median_between, "median(o_totalprice)", "measured BETWEEN 200000 AND 300000", 6,
    "o_totalprice", 200_000, 300_000,
)
_bounded(
    "ex23_quantile_between", X.quantile_between, "quantile_cont(o_totalprice, 0.8)", "measured < 400000", 6,
    "o_totalprice", 0.8, None, 400_000, strictly=True,
)
_bounded(
    "ex24_stdev_between", X.stdev_between, "stddev_samp(o_totalprice)", "measured > 100000", 4,
    "o_totalprice", 100_000, None, strictly=True,
)
_bounded("ex25_sum_between", X.sum_between, "sum(o_totalprice)", "measured >= 1500000", 4, "o_totalprice", 1_500_000)


@query(
    "ex26_most_common_value_in_set",
    """SELECT event_type AS value_field FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1
         ORDER BY n DESC, event_type LIMIT 1 OFFSET 1) WHERE event_type NOT IN ('nothing')""",
)
def _(s: Shop):
    return X.most_common_value_in_set(s.events, "event_type", ["nothing"], 2)


_bounded(
    "ex27_proportion_of_unique_values", X.proportion_of_unique_values_between,
    "count(DISTINCT o_orderstatus) / count(o_orderstatus)", "measured <= 0.3", 6, "o_orderstatus", None, 0.3,
)
_bounded(
    "ex28_unique_value_count", X.unique_value_count_between, "count(DISTINCT o_orderpriority)",
    "measured BETWEEN 3 AND 4", None, "o_orderpriority", 3, 4,
)


# --- distributions --------------------------------------------------------------------


@query(
    "ex29_within_n_stdevs",
    """SELECT o_custkey, round(group_sum, 4) AS group_sum, round(sum_average, 4) AS sum_average,
         round(sum_stddev, 4) AS sum_stddev, round((group_sum - sum_average) / sum_stddev, 6) AS sum_sigma
       FROM (SELECT *, avg(group_sum) OVER () AS sum_average, stddev_samp(group_sum) OVER () AS sum_stddev
             FROM (SELECT o_custkey, sum(o_totalprice) AS group_sum FROM orders GROUP BY 1))
       WHERE abs((group_sum - sum_average) / sum_stddev) > 2""",
)
def _(s: Shop):
    out = X.within_n_stdevs(s.orders, "o_totalprice", ["o_custkey"], 2)
    return rounded(rounded(out, 4, "group_sum", "sum_average", "sum_stddev"), 6, "sum_sigma")


MOVING = """WITH p AS (SELECT date_trunc('day', ts)::TIMESTAMP AS metric_period, event_type, sum(value) AS v FROM events GROUP BY 1, 2),
  l AS (SELECT *, lag(v, 1) OVER (PARTITION BY event_type ORDER BY metric_period) AS prior FROM p),
  t AS (SELECT *, {test} AS x FROM l),
  r AS (SELECT *, avg(x) OVER w AS m, stddev_samp(x) OVER w AS sd FROM t
        WINDOW w AS (PARTITION BY event_type ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
  z AS (SELECT *, (x - m) / nullif(sd, 0) AS s FROM r)
  SELECT metric_period, event_type, round(v, 4) AS agg_metric_value, round(s, 6) AS metric_test_sigma FROM z
  WHERE metric_period >= TIMESTAMP '2024-01-17' AND metric_period < TIMESTAMP '2024-01-31'
    AND NOT (s >= {low} AND s <= {high})"""


@query(
    "ex30_within_n_moving_stdevs",
    MOVING.format(
        test="coalesce(ln(nullif(v, 0)), 0) - coalesce(ln(nullif(prior, 0)), 0)", low="-1", high="1"
    ),
)
def _(s: Shop):
    out = X.within_n_moving_stdevs(s.events, "value", "ts", ["event_type"], sigma=1, as_of=as_of())
    out = out.select("metric_period", "event_type", "agg_metric_value", "metric_test_sigma")
    out = out.withColumn("metric_period", F.col("metric_period").cast("timestamp"))
    return rounded(rounded(out, 4, "agg_metric_value"), 6, "metric_test_sigma")


@query(
    "ex30_moving_stdevs_by_minute",
    """WITH p AS (SELECT date_trunc('minute', ts)::TIMESTAMP AS metric_period, sum(value) AS v FROM events GROUP BY 1),
      l AS (SELECT *, lag(v, 3) OVER (ORDER BY metric_period) AS prior FROM p),
      t AS (SELECT *, coalesce(v, 0) - coalesce(prior, 0) AS x FROM l),
      r AS (SELECT *, avg(x) OVER w AS m, stddev_samp(x) OVER w AS sd FROM t
            WINDOW w AS (ORDER BY metric_period ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
      SELECT metric_period, round(v, 4) AS agg_metric_value, round((x - m) / nullif(sd, 0), 6) AS metric_test_sigma FROM r
      WHERE metric_period < TIMESTAMP '2024-01-31' AND NOT abs((x - m) / nullif(sd, 0)) <= 3""",
)
def _(s: Shop):
    """Minutes of the whole month, in slices that lend their last rows to the next one."""
    scored = X.within_n_moving_stdevs(
        s.events, "value", "ts", period="minute", lookback_periods=3, trend_periods=30, test_periods=50_000, sigma=3,
        take_logs=False, as_of=as_of(),
    )
    out = scored.select(F.col("metric_period").cast("timestamp").alias("metric_period"), "agg_metric_value", "metric_test_sigma")
    return rounded(rounded(out, 4, "agg_metric_value"), 6, "metric_test_sigma")


@query("ex30_moving_stdevs_plain", MOVING.format(test="coalesce(v, 0)", low="-0.5", high="1.5"))
def _(s: Shop):
    out = X.within_n_moving_stdevs(
        s.events, "value", "ts", ["event_type"], sigma_upper=1.5, sigma_lower=-0.5,
        take_diffs=False, take_logs=False, as_of=as_of(),
    )
    out = out.select("metric_period", "event_type", "agg_metric_value", "metric_test_sigma")
    out = out.withColumn("metric_period", F.col("metric_period").cast("timestamp"))
    return rounded(rounded(out, 4, "agg_metric_value"), 6, "metric_test_sigma")


@query(
    "ex31_data_for_every_datepart",
    """WITH f AS (SELECT ts FROM events WHERE event_type <> 'error'),
       spine AS (SELECT unnest(generate_series(a, b - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS date_hour
         FROM (SELECT min(ts)::DATE::TIMESTAMP AS a, max(ts)::DATE::TIMESTAMP AS b FROM f)),
       c AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM f GROUP BY 1)
       SELECT date_hour, TRUE AS is_missing, 0::BIGINT AS row_cnt FROM spine LEFT JOIN c ON date_hour = h
       WHERE h IS NULL AND hour(date_hour) < 20""",
)
def _(s: Shop):
    out = X.data_for_every_n_datepart(
        s.events, "ts", "hour", row_condition="event_type <> 'error'", exclusion_condition="hour(date_hour) < 20"
    )
    return longs(out, "row_cnt")


@query(
    "ex31_data_for_every_n_days",
    """WITH f AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus <> 'P'),
       span AS (SELECT min(d) AS a, max(d) AS b FROM f),
       spine AS (SELECT CAST(d AS TIMESTAMP) AS date_day FROM (
         SELECT unnest(generate_series(a, b - 1, INTERVAL 3 DAY)) AS d FROM span)),
       c AS (SELECT d - (date_diff('day', a, d) % 3)::INT AS day, count(*) AS n FROM f, span GROUP BY 1)
       SELECT date_day, TRUE AS is_missing, 0::BIGINT AS row_cnt FROM spine LEFT JOIN c ON date_day = day
       WHERE day IS NULL""",
)
def _(s: Shop):
    out = X.data_for_every_n_datepart(s.orders, "o_orderdate", "day", 3, row_condition="o_orderstatus <> 'P'")
    return longs(out, "row_cnt")


# --- several columns ------------------------------------------------------------------


@query(
    "ex32_pair_a_greater_than_b",
    """SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       WHERE NOT l_shipdate >= o_orderdate""",
)
def _(s: Shop):
    joined = s.orders.join(s.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    bad = X.pair_a_greater_than_b(joined, "l_shipdate", "o_orderdate", or_equal=True)
    return bad.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("ex33_pair_equal", f"SELECT {LINES} FROM lineitem WHERE l_quantity > 49 AND NOT l_discount = l_tax")
def _(s: Shop):
    return X.pair_equal(s.lineitem, "l_discount", "l_tax", row_condition="l_quantity > 49").select(*LINE)


@query(
    "ex34_pair_in_set",
    f"""SELECT {LINES} FROM lineitem WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F')
        OR (l_returnflag = 'N' AND l_linestatus = 'O'))""",
)
def _(s: Shop):
    return X.pair_in_set(s.lineitem, "l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")]).select(*LINE)


@query(
    "ex35_compound_unique",
    f"""SELECT cust, priority, count(*) AS n_records FROM {HOLED}
        WHERE NOT (cust IS NULL OR priority IS NULL) GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(s: Shop):
    return X.compound_unique(holed(s), ["cust", "priority"], "any_value_is_missing")


@query(
    "ex36_multicolumn_sum_equal",
    """SELECT l_suppkey, FALSE AS expression FROM lineitem GROUP BY 1
       HAVING NOT (sum(l_linenumber) + sum(l_quantity::BIGINT) = sum(l_partkey % 40))""",
)
def _(s: Shop):
    df = s.lineitem.select(
        "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q"), (F.col("l_partkey") % 40).alias("t")
    )
    return X.multicolumn_sum_equal(df, ["l_linenumber", "q"], "t", ["l_suppkey"])


@query(
    "ex37_unique_within_record",
    """SELECT o_orderkey, len(list_distinct([a, b, c]))::BIGINT AS column_values
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 4 END AS a, o_orderkey % 5 AS b,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 6 END AS c FROM orders)
       WHERE len(list_distinct([a, b, c])) < 3""",
)
def _(s: Shop):
    key = F.col("o_orderkey")
    df = s.orders.select(
        key, F.when(key % 3 != 0, key % 4).alias("a"), (key % 5).alias("b"), F.when(key % 7 != 0, key % 6).alias("c")
    )
    return longs(X.unique_within_record(df, ["a", "b", "c"]).select("o_orderkey", "column_values"), "column_values")


# --- text -----------------------------------------------------------------------------


@query(
    "ex38_value_lengths",
    """SELECT 'between' AS rule, doc_id AS id FROM documents WHERE NOT length(text) BETWEEN 50 AND 2000
       UNION ALL SELECT 'equal', c_custkey FROM customer WHERE NOT length(c_mktsegment) = 9""",
)
def _(s: Shop):
    ranged = X.value_lengths_between(s.documents, "text", 50, 2000)
    exact = X.value_lengths_equal(s.customer, "c_mktsegment", 9)
    return ranged.select(F.lit("between").alias("rule"), F.col("doc_id").alias("id")).unionByName(
        exact.select(F.lit("equal").alias("rule"), F.col("c_custkey").alias("id"))
    )


@query(
    "ex39_like_pattern",
    """SELECT 'match' AS rule, p_partkey FROM part WHERE NOT p_name LIKE '%ring'
       UNION ALL SELECT 'not_match', p_partkey FROM part WHERE p_name LIKE 'red %'""",
)
def _(s: Shop):
    hit = X.match_like(s.part, "p_name", "%ring").select(F.lit("match").alias("rule"), "p_partkey")
    miss = X.not_match_like(s.part, "p_name", "red %").select(F.lit("not_match").alias("rule"), "p_partkey")
    return hit.unionByName(miss)


@query(
    "ex40_like_pattern_list",
    """SELECT 'any' AS rule, p_partkey FROM part WHERE NOT (p_name LIKE 'red%' OR p_name LIKE '%widget')
       UNION ALL SELECT 'all', p_partkey FROM part WHERE NOT (p_name LIKE 'red%' AND p_name LIKE '%widget')
       UNION ALL SELECT 'not_any', p_partkey FROM part WHERE NOT (p_name NOT LIKE 'red%' OR p_name NOT LIKE '%widget')
       UNION ALL SELECT 'not_all', p_partkey FROM part WHERE NOT (p_name NOT LIKE 'red%' AND p_name NOT LIKE '%widget')""",
)
def _(s: Shop):
    patterns = ["red%", "%widget"]
    out = None
    for rule, check, mode in (
        ("any", X.match_like_list, "any"),
        ("all", X.match_like_list, "all"),
        ("not_any", X.not_match_like_list, "any"),
        ("not_all", X.not_match_like_list, "all"),
    ):
        part = check(s.part, "p_name", patterns, mode).select(F.lit(rule).alias("rule"), "p_partkey")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "ex41_regex",
    """SELECT 'match' AS rule, doc_id FROM documents WHERE NOT regexp_matches(text, '[0-9]{3}')
       UNION ALL SELECT 'not_match', doc_id FROM documents WHERE regexp_matches(text, '(?i)copyright|license')""",
)
def _(s: Shop):
    hit = X.match_regex(s.documents, "text", "[0-9]{3}").select(F.lit("match").alias("rule"), "doc_id")
    miss = X.not_match_regex(s.documents, "text", "copyright|license", "i")
    return hit.unionByName(miss.select(F.lit("not_match").alias("rule"), "doc_id"))


@query(
    "ex42_regex_list",
    """SELECT 'any' AS rule, page_id FROM pages WHERE NOT (regexp_matches(url, '^https') OR regexp_matches(url, 'page=[0-9]+'))
       UNION ALL SELECT 'all', page_id FROM pages WHERE NOT (regexp_matches(url, '^https') AND regexp_matches(url, 'page=[0-9]+'))
       UNION ALL SELECT 'not_any', page_id FROM pages
         WHERE NOT (NOT regexp_matches(url, '^https') OR NOT regexp_matches(url, 'page=[0-9]+'))
       UNION ALL SELECT 'not_all', page_id FROM pages
         WHERE NOT (NOT regexp_matches(url, '^https') AND NOT regexp_matches(url, 'page=[0-9]+'))""",
)
def _(s: Shop):
    patterns = ["^https", "page=[0-9]+"]
    out = None
    for rule, check, mode in (
        ("any", X.match_regex_list, "any"),
        ("all", X.match_regex_list, "all"),
        ("not_any", X.not_match_regex_list, "any"),
        ("not_all", X.not_match_regex_list, "all"),
    ):
        part = check(s.pages, "url", patterns, mode).select(F.lit(rule).alias("rule"), "page_id")
        out = part if out is None else out.unionByName(part)
    return out


# --- table shape ----------------------------------------------------------------------


@query(
    "ex44_recent_data",
    """SELECT max(ts) AS max_timestamp FROM events WHERE ts <= TIMESTAMP '2024-01-20' AND event_type = 'click'
       HAVING max(ts) < TIMESTAMP '2024-01-20' - INTERVAL 1 SECOND""",
)
def _(s: Shop):
    moment = F.lit("2024-01-20").cast("timestamp")
    return X.has_recent_data(s.events, "ts", "second", 1, "event_type = 'click'", moment)


@query(
    "ex45_grouped_recent_data",
    """SELECT user_id, max(ts) AS latest_timestamp FROM events WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1
       HAVING max(ts) < TIMESTAMP '2024-01-19 12:00:00'""",
)
def _(s: Shop):
    moment = F.lit("2024-01-20").cast("timestamp")
    return X.grouped_recent_data(s.events, ["user_id"], "ts", "hour", 12, as_of=moment)


@query(
    "ex46_aggregation_equal_other_table",
    SCALAR_PAIR.format(a="SELECT max(o_orderkey) AS x FROM orders", b="SELECT max(l_partkey) AS y FROM lineitem"),
)
def _(s: Shop):
    out = X.aggregation_equal_other_table(s.orders, F.max("o_orderkey"), s.lineitem, F.max("l_partkey"))
    return rounded(out, 6, "expression_difference_percent")


@query(
    "ex49_row_count",
    """SELECT c_nationkey, count(*) AS measured FROM customer GROUP BY 1 HAVING NOT (count(*) BETWEEN 55 AND 65)
       UNION ALL SELECT c_nationkey, count(*) FROM customer WHERE c_acctbal > 0 GROUP BY 1 HAVING count(*) <> 50""",
)
def _(s: Shop):
    ranged = X.row_count_between(s.customer, 55, 65, ["c_nationkey"])
    return ranged.unionByName(X.row_count_equal(s.customer, 50, ["c_nationkey"], "c_acctbal > 0"))


@query(
    "ex50_row_count_equal_other_table",
    _pair_sql(
        "SELECT l_orderkey AS k, count(*) AS x FROM lineitem GROUP BY 1",
        "SELECT o_orderkey AS k, count(*) * 4 AS y FROM orders GROUP BY 1",
        "abs(coalesce(x, 0) - coalesce(y, 0)) > 0",
    ),
)
def _(s: Shop):
    out = X.row_count_equal_other_table_times_factor(
        s.lineitem, s.orders, 4, by=["l_orderkey"], other_by=["o_orderkey"]
    )
    return rounded(out, 6, "expression_difference_percent")
