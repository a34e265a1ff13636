"""Relational helpers, scalars, URL pieces and math."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartmill.catalog.common import longs, rounded
from cartmill.catalog.pipeline import ORDER_DATES, order_dates
from cartmill.catalog.registry import query
from cartmill.catalog.shop import Shop
from cartmill.functions import scalars as sc
from cartmill.functions import web
from cartmill.functions.dates import parts_between
from cartmill.operators import ranking
from cartmill.operators import relational as rel

# --- series ---------------------------------------------------------------------------

SPINE_PARTS = ("day", "week", "month", "quarter", "year")
WEEK_OF = "(d - ((dayofweek(d)) || ' days')::INTERVAL)"


@query(
    "rel01_date_spine",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS part, CAST(d AS DATE) AS moment FROM (
            SELECT unnest(generate_series(a, b, INTERVAL 1 {p.upper()})) AS d, b FROM ({ORDER_DATES}))
            WHERE {"d < b" if p == "day" else
                   "date_diff('day', (a0 - dayofweek(a0)::INT), (CAST(d AS DATE) - dayofweek(d)::INT)) < date_diff('day', (a0 - dayofweek(a0)::INT), (b - dayofweek(b)::INT))" if p == "week" else
                   f"date_trunc('{p}', d) < date_trunc('{p}', b)"}"""
        for p in SPINE_PARTS
    ).replace("AS d, b FROM", "AS d, a AS a0, b FROM"),
)
def _(s: Shop):
    """Every date part between the first and the last order."""
    out = None
    for part in SPINE_PARTS:
        spine = rel.date_spine(order_dates(s), part, "moment").select(F.lit(part).alias("part"), "moment")
        out = spine if out is None else out.unionByName(spine)
    return out


@query(
    "rel02_intervals_between",
    """SELECT o_orderkey, date_diff('day', o_orderdate, l_shipdate) AS days,
       date_diff('month', o_orderdate, l_shipdate) AS months,
       date_diff('quarter', o_orderdate, l_shipdate) AS quarters,
       date_diff('year', o_orderdate, l_shipdate) AS years,
       date_diff('hour', o_orderdate, l_shipdate) AS hours,
       (date_diff('day', o_orderdate::DATE - dayofweek(o_orderdate)::INT, l_shipdate::DATE - dayofweek(l_shipdate)::INT)
         // 7)::BIGINT AS weeks
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def _(s: Shop):
    joined = s.orders.join(s.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        "o_orderkey",
        *[
            parts_between("o_orderdate", "l_shipdate", p).alias(f"{p}s")
            for p in ("day", "week", "month", "quarter", "year", "hour")
        ],
    )


@query(
    "rel03_generate_series",
    "SELECT unnest(generate_series(1, n))::BIGINT AS generated_number FROM (SELECT count(*) AS n FROM customer)",
)
def _(s: Shop):
    return rel.numbers_up_to(s.customer.agg(F.count("*").alias("n")), "n", "generated_number")


# --- selection and shape --------------------------------------------------------------


@query(
    "rel04_deduplicate",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
       SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(s: Shop):
    order = [F.col("l_shipdate").desc(), *[F.col(c).asc() for c in ("l_partkey", "l_suppkey", "l_quantity")]]
    first = rel.deduplicate(s.lineitem, ["l_orderkey", "l_linenumber"], order)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "rel05_pivot",
    """SELECT o_orderstatus, sum((o_orderpriority = '1-URGENT')::INT)::BIGINT AS "n_1-URGENT_orders",
       sum((o_orderpriority = '5-LOW')::INT)::BIGINT AS "n_5-LOW_orders",
       count(DISTINCT CASE WHEN o_custkey > 500 THEN o_custkey ELSE 0 END) AS customers_above_500,
       round(max(CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice ELSE 0 END), 2) AS "max_not_2-HIGH"
       FROM orders GROUP BY 1""",
)
def _(s: Shop):
    counts = rel.pivot_columns("o_orderpriority", ["1-URGENT", "5-LOW"], prefix="n_", suffix="_orders")
    distinct = rel.pivot_columns(
        "o_custkey", [500], agg="count", cmp=">", distinct=True, then_value=F.col("o_custkey"),
        prefix="customers above ", slug_names=True,
    )
    largest = rel.pivot_columns(
        "o_orderpriority", ["2-HIGH"], agg="max", cmp="<>", then_value=F.col("o_totalprice"), prefix="max_not_"
    )
    out = s.orders.groupBy("o_orderstatus").agg(*counts, *distinct, *largest)
    return rounded(out, 2, "max_not_2-HIGH")


@query(
    "rel06_unpivot",
    """SELECT p_partkey, 'p_name' AS field_name, p_name AS value FROM part
       UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
       UNION ALL SELECT p_partkey, 'is_large', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END FROM part""",
)
def _(s: Shop):
    flagged = s.part.withColumn("is_large", F.col("p_size") > 25)
    return rel.unpivot(flagged, keep=["p_partkey"], remove=["P_BRAND", "p_type", "p_retailprice"])


@query(
    "rel07_union_relations",
    """SELECT 'customer' AS source_relation, c_custkey AS id, c_nationkey::BIGINT AS nation, c_mktsegment AS segment,
         NULL::VARCHAR AS label FROM customer WHERE c_nationkey > 3
       UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, NULL, s_name FROM supplier WHERE s_nationkey > 3""",
)
def _(s: Shop):
    customers = s.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )
    suppliers = s.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"),
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"),
    )
    return rel.union_relations(
        {"customer": customers, "supplier": suppliers},
        column_override={"nation": "bigint"}, exclude=["BALANCE"], where="nation > 3",
    )


@query(
    "rel08_select_except",
    """SELECT c_custkey AS x_c_custkey_y, c_name AS x_c_name_y, c_nationkey AS x_c_nationkey_y FROM customer""",
)
def _(s: Shop):
    return rel.select_except(s.customer, ["C_ACCTBAL", "c_mktsegment"], prefix="x_", suffix="_y")


@query(
    "rel10_column_values",
    """SELECT p_brand AS value, count(*) AS n_rows FROM part WHERE p_size > 10 GROUP BY 1
       ORDER BY n_rows DESC, value LIMIT 7""",
)
def _(s: Shop):
    return rel.column_values(s.part, "p_brand", where="p_size > 10", max_records=7)


@query(
    "rel13_union_tables_by_prefix",
    """SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
def _(s: Shop):
    """A view for every event type there is; a name prefix finds them, one is excluded by name."""
    prefix = f"cartmill_{uuid.uuid4().hex[:8]}_"
    for row in s.events.select("event_type").distinct().collect():
        s.events.filter(F.col("event_type") == row.event_type).createOrReplaceTempView(f"{prefix}{row.event_type}")
    names = rel.tables_with_prefix(s.spark, prefix.upper(), exclude=f"{prefix}error")
    together = rel.union_tables(s.spark, names)
    return together.groupBy("event_type").agg(F.count("*").alias("n"))


# --- scalars --------------------------------------------------------------------------

NULL_KEY = f"'{sc.SURROGATE_NULL}'"


@query(
    "rel14_surrogate_key",
    f"""SELECT o_orderkey, md5(coalesce(o_orderkey::VARCHAR, {NULL_KEY}) || '-' ||
          coalesce(nullif(o_orderpriority, '5-LOW'), {NULL_KEY}) || '-' || coalesce(o_custkey::VARCHAR, {NULL_KEY}))
          AS surrogate_key,
        md5(o_orderkey::VARCHAR || '-' || coalesce(nullif(o_orderpriority, '5-LOW'), '')) AS key_null_as_empty
        FROM orders""",
)
def _(s: Shop):
    rare = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return s.orders.select(
        "o_orderkey",
        sc.surrogate_key("o_orderkey", rare, "o_custkey").alias("surrogate_key"),
        sc.surrogate_key("o_orderkey", rare, treat_nulls_as_empty=True).alias("key_null_as_empty"),
    )


@query(
    "rel15_null_check",
    """SELECT p_partkey, nullif(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END, '') AS p_name, p_size,
       CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS p_type FROM part""",
)
def _(s: Shop):
    key = F.col("p_partkey")
    holed = s.part.select(
        key,
        F.when(key % 3 == 0, "").otherwise(F.col("p_name")).alias("p_name"),
        "p_size",
        F.when(key % 4 == 0, "").otherwise(F.col("p_type")).alias("p_type"),
    )
    return rel.null_check_table(holed, ["p_name"])


def _holes(s: Shop):
    key = F.col("o_orderkey")
    return s.orders.select(
        key,
        F.when(key % 3 != 0, F.col("o_custkey")).alias("a"),
        F.when(key % 5 != 0, key % 7).alias("b"),
    )


HOLES = """(SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS a,
            CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 END AS b FROM orders)"""


@query(
    "rel16_safe_add_subtract",
    f"""SELECT o_orderkey, coalesce(a, 0) + coalesce(b, 0) + 1 AS added, coalesce(a, 0) - coalesce(b, 0) AS subtracted
        FROM {HOLES}""",
)
def _(s: Shop):
    return _holes(s).select(
        "o_orderkey",
        sc.safe_add("a", "b", F.lit(1)).alias("added"),
        sc.safe_subtract("a", "b").alias("subtracted"),
    )


@query("rel17_safe_divide", f"SELECT o_orderkey, round(a / nullif(b, 0), 9) AS ratio FROM {HOLES}")
def _(s: Shop):
    return _holes(s).select("o_orderkey", F.round(sc.safe_divide("a", "b"), 9).alias("ratio"))


@query(
    "rel18_width_bucket",
    """SELECT p_partkey, CASE WHEN p_retailprice < 1000 THEN 0 WHEN p_retailprice >= 1080 THEN 9
         ELSE floor((p_retailprice - 1000) / 10) + 1 END::BIGINT AS bucket FROM part""",
)
def _(s: Shop):
    return s.part.select("p_partkey", sc.width_bucket("p_retailprice", 1000.0, 1080.0, 8).alias("bucket"))


GEO = """(SELECT c_custkey, (c_custkey * 13 % 500) / 10.0::DOUBLE - 40 AS lat1,
          (c_custkey * 7 % 500) / 10.0::DOUBLE - 80 AS lon1, (c_custkey * 3 % 170) - 85.0::DOUBLE AS lat2,
          (c_custkey * 11 % 350) - 175.0::DOUBLE AS lon2 FROM customer)"""
CHORD = """sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)
           + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))"""


@query(
    "rel19_haversine_distance",
    f"""SELECT c_custkey, round(2 * 3961 * asin({CHORD}), 6) AS miles,
        round(2 * 3961 * asin({CHORD}) * 1.60934, 6) AS km FROM {GEO}""",
)
def _(s: Shop):
    key = F.col("c_custkey")
    points = s.customer.select(
        key,
        ((key * 13 % 500) / 10.0 - 40).alias("lat1"),
        ((key * 7 % 500) / 10.0 - 80).alias("lon1"),
        (key * 3 % 170 - 85.0).alias("lat2"),
        (key * 11 % 350 - 175.0).alias("lon2"),
    )
    ends = ("lat1", "lon1", "lat2", "lon2")
    return points.select(
        key,
        F.round(sc.haversine(*ends), 6).alias("miles"),
        F.round(sc.haversine(*ends, unit="km"), 6).alias("km"),
    )


@query(
    "rel21_slugify",
    r"""SELECT DISTINCT o_orderpriority, regexp_replace(regexp_replace(regexp_replace(lower(o_orderpriority), '[ -]+', '_', 'g'),
        '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\1') AS slug FROM orders""",
)
def _(s: Shop):
    return s.orders.select("o_orderpriority", sc.slugify("o_orderpriority").alias("slug")).distinct()


# --- urls -----------------------------------------------------------------------------

BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query(
    "web01_url_host",
    f"SELECT page_id, split_part(split_part(replace({BARE}, 'android-app://', ''), '/', 1), '?', 1) AS host FROM pages",
)
def _(s: Shop):
    return s.pages.select("page_id", web.url_host("url").alias("host"))


@query(
    "web02_url_path",
    f"""SELECT page_id, split_part(right(b, length(b) - CASE WHEN instr(b, '/') > 0 THEN instr(b, '/')
          ELSE instr(b, '?') - 1 END), '?', 1) AS path
        FROM (SELECT page_id, {BARE} AS b FROM pages)""",
)
def _(s: Shop):
    return s.pages.select("page_id", web.url_path("url").alias("path"))


@query(
    "web03_url_parameter",
    """SELECT page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
       nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref FROM pages""",
)
def _(s: Shop):
    return s.pages.select(
        "page_id", web.url_parameter("url", "page").alias("page"), web.url_parameter("url", "ref").alias("ref")
    )


# --- math and text --------------------------------------------------------------------


@query(
    "mth01_percentiles",
    """SELECT l_returnflag, round(median(l_extendedprice), 6) AS median,
       round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(quantile_cont(l_extendedprice, 0.123), 6) AS p12
       FROM lineitem GROUP BY 1""",
)
def _(s: Shop):
    q = ranking.exact_quantiles(s.lineitem, "l_extendedprice", [0.5, 0.9, 0.123], ["l_returnflag"])
    return rounded(
        q.withColumnsRenamed({"q0": "median", "q1": "p90", "q2": "p12"}), 6, "median", "p90", "p12"
    )


@query("mth02_natural_log", "SELECT o_orderkey, round(ln(o_totalprice), 9) AS log_price FROM orders")
def _(s: Shop):
    return s.orders.select("o_orderkey", F.round(sc.natural_log("o_totalprice"), 9).alias("log_price"))


@query(
    "mth03_regexp_position",
    """SELECT doc_id, CASE WHEN regexp_matches(text, '[.!?] ') THEN
         length(regexp_extract(text, '^(?s)(.*?)[.!?] ', 1)) + 1 ELSE 0 END::BIGINT AS first_stop,
       CASE WHEN regexp_matches(text, '^(?s).*?[.!?] .*?[.!?] ') THEN
         length(regexp_extract(text, '^(?s)(.*?[.!?] .*?)[.!?] ', 1)) + 1 ELSE 0 END::BIGINT AS second_stop
       FROM documents""",
)
def _(s: Shop):
    return longs(
        s.documents.select(
            "doc_id",
            sc.regex_position("text", "[.!?] ").alias("first_stop"),
            sc.regex_position("text", "[.!?] ", occurrence=2).alias("second_stop"),
        ),
        "first_stop",
        "second_stop",
    )


@query("mth04_md5", "SELECT doc_id, md5(text) AS digest FROM documents")
def _(s: Shop):
    return s.documents.select("doc_id", sc.text_md5("text").alias("digest"))


@query(
    "scl01_distributed_rank",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER w AS price_rank, round(sum(l_extendedprice) OVER w, 2) AS running_price
       FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
         l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING)""",
)
def _(s: Shop):
    """Three groups hold the whole table: rank and running sum spread over all tasks."""
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ranked = ranking.with_rank(
        s.lineitem.select("l_returnflag", "l_extendedprice", *keys),
        [F.col("l_extendedprice").desc(), *[F.col(k).asc() for k in keys]],
        ["l_returnflag"],
        rank="price_rank",
        total="l_extendedprice",
        running="running_price",
    )
    return ranked.select("l_returnflag", *keys, "price_rank", F.round("running_price", 2).alias("running_price"))
