"""Sources, sinks, staging, star schema, gold extracts and concentration."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartmill.catalog.common import rounded, scratch_path
from cartmill.catalog.registry import query
from cartmill.catalog.shop import WINDOW, Shop
from cartmill.catalog.shop_sql import GOLD, STAGING, STAR
from cartmill.functions.business import add_region
from cartmill.functions.scalars import blank_to_null
from cartmill.operators import concentration as con
from cartmill.operators import relational as rel
from cartmill.operators.compare import changed_rows
from cartmill.operators.intervals import join_containing
from cartmill.plans import gold, metrics, staging, star
from cartmill.sources import raw as raw_source
from cartmill.sources import tables
from cartmill.sources.split_csv import read_split_csv

# --- sources and sinks ----------------------------------------------------------------


@query(
    "src01_read_raw_csv",
    STAGING
    + """SELECT CAST(customer_id AS VARCHAR) AS customer_id,
      CAST(customer_unique_id AS VARCHAR) AS customer_unique_id, customer_zip_code_prefix, customer_city,
      customer_state FROM stg_customers""",
)
def _(s: Shop):
    path = scratch_path(s.spark, "customers-csv")
    s.raw["customers"].write.option("header", True).csv(path)
    return raw_source.read_raw(s.spark, path, "customers")


@query(
    "src02_byte_order_mark",
    STAGING
    + """SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_zip_code_prefix, customer_state
      FROM stg_customers""",
)
def _(s: Shop):
    """Every written file starts with a byte-order mark, as some exports do."""
    path = scratch_path(s.spark, "customers-marked")
    customers = s.raw["customers"]
    marked = customers.withColumnRenamed(customers.columns[0], f"\ufeff{customers.columns[0]}")
    marked.write.option("header", True).csv(path)
    read = raw_source.read_raw(s.spark, path, "customers")
    return read.select("customer_id", "customer_zip_code_prefix", "customer_state")


@query(
    "src03_blank_cells",
    STAGING
    + """SELECT CAST(review_id AS VARCHAR) AS review_id, review_comment_title AS kept_blank,
      nullif(review_comment_title, '') AS blank_as_null FROM stg_reviews""",
)
def _(s: Shop):
    path = scratch_path(s.spark, "reviews-csv")
    columns = raw_source.ENTITIES["order_reviews"].columns
    staging_rows = s.reviews.select(*[F.col(c).cast("string") for c in columns])
    staging_rows.write.option("header", True).option("escape", '"').csv(path)
    kept = raw_source.read_raw(s.spark, path, "order_reviews", "empty")
    nulled = raw_source.apply_blank_policy(kept, "null")
    return kept.select("review_id", F.col("review_comment_title").alias("kept_blank")).join(
        nulled.select("review_id", F.col("review_comment_title").alias("blank_as_null")), "review_id"
    )


@query(
    "src05_split_quoted_breaks",
    """SELECT doc_id::VARCHAR AS doc_id, lang, md5(text) AS text_md5, length(text)::INTEGER AS n_chars,
      (length(text) - length(replace(text, chr(10), '')))::INTEGER AS n_breaks FROM documents""",
)
def _(s: Shop):
    """Texts with line breaks and quotes, written as CSV and read in blocks that records cross the borders of."""
    path = scratch_path(s.spark, "documents-csv")
    texts = s.documents.select(F.col("doc_id").cast("string"), "lang", "text")
    keep = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    texts.write.option("header", True).options(**keep).csv(path)
    read = read_split_csv(s.spark, path, texts.schema)
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return read.select("doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), breaks.alias("n_breaks"))


@query("src04_read_gold", GOLD + "SELECT * FROM geo_delivery")
def _(s: Shop):
    folder = scratch_path(s.spark, "gold")
    tables.write_gold(s.geo, "geo_delivery", folder)
    return tables.read_gold(s.spark, "geo_delivery", folder)


@query(
    "snk01_write_table",
    """SELECT year(o_orderdate)::INTEGER AS order_year, count(*) AS n_orders FROM orders GROUP BY 1""",
)
def _(s: Shop):
    """Full refresh twice over the same path; only the second write remains."""
    path = scratch_path(s.spark, "orders")
    dated = s.orders.withColumn("order_year", F.year("o_orderdate"))
    tables.write_table(dated.withColumn("order_year", F.col("order_year") - 100), path, ["order_year"])
    again = tables.write_table(dated, path, ["order_year"])
    return again.groupBy("order_year").agg(F.count("*").alias("n_orders"))


@query("snk02_create_view", "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY 1")
def _(s: Shop):
    name = f"cartmill_orders_{uuid.uuid4().hex}"
    tables.create_view(s.orders, name)
    return s.spark.sql(f"SELECT o_orderstatus, count(*) AS n_orders FROM {name} GROUP BY o_orderstatus")


@query(
    "snk03_write_gold",
    GOLD + "SELECT * REPLACE (round(gmv, 4) AS gmv, round(avg_review_score, 6) AS avg_review_score)"
    " FROM seller_performance",
)
def _(s: Shop):
    written = tables.write_gold(s.seller_stats, "seller_performance", scratch_path(s.spark, "gold"))
    return rounded(rounded(written, 4, "gmv"), 6, "avg_review_score")


ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations".split()
)


@query(
    "snk04_table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ALL_TABLES),
)
def _(s: Shop):
    return tables.table_counts({t: s.table(t) for t in ALL_TABLES})


# --- staging --------------------------------------------------------------------------


def _as_text_sql(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


@query(
    "stg01_customers",
    STAGING
    + f"""SELECT {_as_text_sql('customer_id', 'customer_unique_id')}, customer_zip_code_prefix, customer_city,
      customer_state FROM stg_customers""",
)
def _(s: Shop):
    return staging.stg_customers(s.raw["customers"])


@query(
    "stg02_orders",
    STAGING
    + f"""SELECT {_as_text_sql('order_id', 'customer_id')}, order_status, order_purchase_timestamp,
      order_approved_at, CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
      order_delivered_customer_date, order_estimated_delivery_date, date_key FROM stg_orders""",
)
def _(s: Shop):
    return staging.stg_orders(s.raw["orders"])


@query(
    "stg03_order_items",
    STAGING
    + f"""SELECT {_as_text_sql('order_id', 'product_id', 'seller_id')}, order_item_id, shipping_limit_date,
      price, freight_value FROM stg_order_items""",
)
def _(s: Shop):
    return staging.stg_order_items(s.raw["order_items"])


@query(
    "stg04_payments",
    STAGING
    + f"""SELECT {_as_text_sql('order_id')}, payment_sequential, payment_type, payment_installments,
      payment_value FROM stg_payments""",
)
def _(s: Shop):
    return staging.stg_payments(s.raw["order_payments"])


@query(
    "stg05_reviews",
    STAGING
    + f"""SELECT {_as_text_sql('review_id', 'order_id')}, review_score, review_comment_title,
      review_comment_message, review_creation_date, review_answer_timestamp, date_key FROM stg_reviews""",
)
def _(s: Shop):
    return staging.stg_reviews(s.raw["order_reviews"])


@query(
    "stg06_products",
    STAGING
    + f"""SELECT {_as_text_sql('product_id')}, product_category_name, product_category_name_english,
      product_name_length, product_description_length, product_photos_qty,
      CASE WHEN product_id % 7 <> 0 THEN product_weight_g END AS product_weight_g,
      product_length_cm, product_height_cm, product_width_cm FROM stg_products""",
)
def _(s: Shop):
    return staging.stg_products(s.raw["products"], s.raw["category_translation"])


@query(
    "stg07_sellers",
    STAGING
    + f"""SELECT {_as_text_sql('seller_id')}, seller_zip_code_prefix, seller_city, seller_state
      FROM stg_sellers""",
)
def _(s: Shop):
    return staging.stg_sellers(s.raw["sellers"])


@query(
    "stg08_geolocation",
    STAGING
    + """SELECT zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat,
      round(geolocation_lng, 6) AS geolocation_lng FROM stg_geolocation""",
)
def _(s: Shop):
    return rounded(staging.stg_geolocation(s.raw["geolocation"]), 6, "geolocation_lat", "geolocation_lng")


@query(
    "stg09_category_translation",
    """SELECT DISTINCT p_brand AS product_category_name, lower(p_brand) AS product_category_name_english
       FROM part WHERE p_brand NOT LIKE '%5'""",
)
def _(s: Shop):
    return staging.stg_category_translation(s.raw["category_translation"])


@query(
    "stg10_keep_latest",
    """SELECT user_id, event_type, event_id, ts, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
         FROM events) WHERE rn = 1""",
)
def _(s: Shop):
    latest = rel.keep_latest(s.events, ["user_id", "event_type"], "ts", ["event_id"])
    return latest.select("user_id", "event_type", "event_id", "ts", "value")


@query(
    "stg11_blank_to_null",
    """SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN NULL
              ELSE ' ' || p_brand END AS cleaned FROM part""",
)
def _(s: Shop):
    key = F.col("p_partkey")
    padded = F.when(key % 50 == 0, "").when(key % 50 == 1, "   ").otherwise(F.concat(F.lit(" "), "p_brand"))
    return s.part.select("p_partkey", blank_to_null(padded).alias("cleaned"))


@query(
    "stg12_clean_rows",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_returnflag <> 'R' AND l_quantity BETWEEN 10 AND 20 AND l_shipdate IS NOT NULL
         AND l_linestatus IN ('O', 'F') AND l_shipdate >= TIMESTAMP '1998-01-01'""",
)
def _(s: Shop):
    return s.lineitem.filter(
        (F.col("l_returnflag") != "R")
        & F.col("l_quantity").between(10, 20)
        & F.col("l_shipdate").isNotNull()
        & F.col("l_linestatus").isin("O", "F")
        & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp"))
    ).select("l_orderkey", "l_linenumber", "l_quantity")


# --- star schema ----------------------------------------------------------------------


@query(
    "dim01_customers",
    STAR
    + """SELECT * REPLACE (round(geolocation_lat, 6) AS geolocation_lat,
      round(geolocation_lng, 6) AS geolocation_lng) FROM dim_customers""",
)
def _(s: Shop):
    return rounded(s.star["dim_customers"], 6, "geolocation_lat", "geolocation_lng")


@query("dim02_products", STAR + "SELECT * FROM dim_products")
def _(s: Shop):
    return s.star["dim_products"]


@query(
    "dim03_sellers",
    STAR
    + """SELECT * REPLACE (round(geolocation_lat, 6) AS geolocation_lat,
      round(geolocation_lng, 6) AS geolocation_lng) FROM dim_sellers""",
)
def _(s: Shop):
    return rounded(s.star["dim_sellers"], 6, "geolocation_lat", "geolocation_lng")


ORDER_DATES = "SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders"


def order_dates(s: Shop):
    """One row with the first and last order date."""
    day = F.to_date("o_orderdate")
    return s.orders.agg(F.min(day).alias("start"), F.max(day).alias("end")).select(
        F.col("start").cast("timestamp"), F.col("end").cast("timestamp")
    )


@query(
    "dim04_date",
    f"""SELECT CAST(d AS DATE) AS date_key, year(d)::INT AS year, month(d)::INT AS month, day(d)::INT AS day,
        (dayofweek(d) + 1)::INT AS day_of_week, quarter(d)::INT AS quarter
        FROM (SELECT unnest(generate_series(a, b - 1, INTERVAL 1 DAY)) AS d FROM ({ORDER_DATES}))""",
)
def _(s: Shop):
    return star.dim_date_of(order_dates(s))


@query("fct01_sales", STAR + "SELECT * FROM fct_sales")
def _(s: Shop):
    return s.star["fct_sales"]


@query("fct02_reviews", STAR + "SELECT * FROM fct_reviews")
def _(s: Shop):
    return s.star["fct_reviews"]


@query("fct03_payments", STAR + "SELECT * FROM fct_payments")
def _(s: Shop):
    return s.star["fct_payments"]


# --- join shapes ----------------------------------------------------------------------


@query(
    "jn01_conditional_left_join",
    STAGING
    + """SELECT o.order_id, p.payment_type, p.payment_value FROM stg_orders o
      LEFT JOIN stg_payments p ON o.order_id = p.order_id AND p.payment_sequential = 1""",
)
def _(s: Shop):
    joined = rel.left_join_where(
        s.headers.select("order_id"), s.payments, "order_id", F.col("payment_sequential") == 1
    )
    return joined.select("order_id", "payment_type", "payment_value")


@query(
    "jn02_star_join",
    STAR
    + """SELECT year, customer_state, product_category_name_english, count(*) AS items,
      round(sum(total_sale_amount), 4) AS revenue
      FROM fct_sales s JOIN dim_date d ON s.date_key = d.date_key
      JOIN dim_customers c ON s.customer_unique_id = c.customer_unique_id
      JOIN dim_products p ON s.product_id = p.product_id GROUP BY 1, 2, 3""",
)
def _(s: Shop):
    t = s.star
    joined = (
        t["fct_sales"]
        .join(t["dim_date"].select("date_key", F.col("year").cast("bigint")), "date_key")
        .join(t["dim_customers"].select("customer_unique_id", "customer_state"), "customer_unique_id")
        .join(t["dim_products"].select("product_id", "product_category_name_english"), "product_id")
    )
    return joined.groupBy("year", "customer_state", "product_category_name_english").agg(
        F.count("*").alias("items"), F.round(F.sum("total_sale_amount"), 4).alias("revenue")
    )


@query(
    "jn03_join_of_aggregates",
    STAR
    + """SELECT order_id, round(paid, 4) AS paid, round(sold, 4) AS sold
      FROM (SELECT order_id, sum(payment_value) AS paid FROM fct_payments GROUP BY 1)
      JOIN (SELECT order_id, sum(total_sale_amount) AS sold FROM fct_sales GROUP BY 1) USING (order_id)""",
)
def _(s: Shop):
    paid = s.star["fct_payments"].groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    sold = s.star["fct_sales"].groupBy("order_id").agg(F.sum("total_sale_amount").alias("sold"))
    return rounded(paid.join(sold, "order_id"), 4, "paid", "sold")


@query(
    "jn04_left_anti",
    """SELECT p_partkey, p_brand FROM part
       WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)""",
)
def _(s: Shop):
    return rel.rows_without_parent(s.part, s.customer, "p_partkey", "c_custkey").select("p_partkey", "p_brand")


@query(
    "jn05_full_outer",
    """SELECT coalesce(a.k, b.k) AS cents, parts, suppliers
       FROM (SELECT floor(p_retailprice)::BIGINT AS k, count(*) AS parts FROM part GROUP BY 1) a
       FULL JOIN (SELECT floor(s_acctbal)::BIGINT AS k, count(*) AS suppliers FROM supplier GROUP BY 1) b
       ON a.k = b.k""",
)
def _(s: Shop):
    a = s.part.groupBy(F.floor("p_retailprice").alias("cents")).agg(F.count("*").alias("parts"))
    b = s.supplier.groupBy(F.floor("s_acctbal").alias("cents")).agg(F.count("*").alias("suppliers"))
    joined = a.join(b, rel.null_safe_keys(a, b, ["cents"]), "full")
    return joined.select(F.coalesce(a["cents"], b["cents"]).alias("cents"), "parts", "suppliers")


@query(
    "jn06_scalar_cross_join",
    """SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers""",
)
def _(s: Shop):
    return rel.compare_scalars(
        s.orders.agg(F.count("*").alias("orders")), s.customer.agg(F.count("*").alias("customers"))
    )


@query(
    "jn07_range_join",
    f"""WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
        weeks AS (SELECT CAST(d AS DATE) AS week_start, CAST(d + INTERVAL 6 DAY AS DATE) AS week_end
                  FROM (SELECT unnest(generate_series(a - 7, b + 7, INTERVAL 1 DAY)) AS d FROM ({ORDER_DATES}))
                  WHERE dayofweek(d) = 0)
        SELECT day, week_start, week_end FROM days JOIN weeks ON day BETWEEN week_start AND week_end""",
)
def _(s: Shop):
    days = s.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    span = order_dates(s).select(
        (F.col("start") - F.expr("INTERVAL 7 DAYS")).alias("start"),
        (F.col("end") + F.expr("INTERVAL 8 DAYS")).alias("end"),
    )
    spine = rel.date_spine(span, "day", "week_start").filter(F.dayofweek("week_start") == 1)
    weeks = spine.withColumn("week_end", F.date_add("week_start", 6))
    return rel.join_week_range(days, "day", weeks, "week_start", "week_end")


@query(
    "jn11_changed_rows",
    """WITH later AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 70 = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders UNION ALL SELECT -c_custkey, 'N', 0 FROM customer WHERE c_custkey % 40 = 0)
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' ELSE 'changed' END AS change,
          CASE WHEN a.o_orderkey IS NOT NULL THEN concat_ws(',', CASE WHEN a.o_orderstatus <> b.o_orderstatus THEN 'o_orderstatus' END,
            CASE WHEN a.o_totalprice <> b.o_totalprice THEN 'o_totalprice' END) END AS differing
        FROM orders a FULL JOIN later b ON a.o_orderkey = b.o_orderkey
        WHERE a.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus OR a.o_totalprice <> b.o_totalprice""",
)
def _(s: Shop):
    """What changed from one version of the orders to the next."""
    key = F.col("o_orderkey")
    before = s.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    later = before.withColumns(
        {
            "o_orderstatus": F.when(key % 50 == 1, "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.col("o_totalprice") + F.when(key % 70 == 2, 1.0).otherwise(0.0),
        }
    )
    fresh = s.customer.filter("c_custkey % 40 = 0").selectExpr("-c_custkey AS o_orderkey", "'N' AS o_orderstatus", "0D AS o_totalprice")
    return changed_rows(before, later.unionByName(fresh), ["o_orderkey"])


@query(
    "jn10_key_ranges",
    """WITH spans AS (SELECT s_suppkey, CASE WHEN s_suppkey * 20 > 480 THEN s_suppkey * 20 - 480 END AS first_key,
          s_suppkey * 20 - 480 + s_suppkey * 37 % 500 AS last_key FROM supplier)
        SELECT s_suppkey, count(*) AS n_parts, min(p_partkey) AS lowest, max(p_partkey) AS highest
        FROM spans JOIN part ON (first_key IS NULL OR p_partkey >= first_key) AND p_partkey <= last_key GROUP BY 1""",
)
def _(s: Shop):
    """Parts by the ranges of keys that suppliers cover, of very different lengths; the first ones have no lower end."""
    low = F.col("s_suppkey") * 20 - 480
    spans = s.supplier.select(
        "s_suppkey", F.when(low > 0, low).alias("first_key"), (low + F.col("s_suppkey") * 37 % 500).alias("last_key")
    )
    hits = join_containing(s.part.select("p_partkey"), "p_partkey", spans, "first_key", "last_key")
    return hits.groupBy("s_suppkey").agg(
        F.count("*").alias("n_parts"), F.min("p_partkey").alias("lowest"), F.max("p_partkey").alias("highest")
    )


@query(
    "jn08_semi_join",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)
         AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def _(s: Shop):
    rich = s.customer.filter("c_acctbal > 9000")
    urgent = s.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return rel.rows_with_parent(urgent, rich, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


# --- gold extracts --------------------------------------------------------------------


@query("gld01_sales_orders", GOLD + "SELECT * FROM sales_orders")
def _(s: Shop):
    return s.sales


@query(
    "gld02_customer_rfm",
    GOLD + "SELECT * REPLACE (round(monetary_value, 4) AS monetary_value) FROM customer_rfm",
)
def _(s: Shop):
    return rounded(s.rfm, 4, "monetary_value")


@query(
    "gld15_stored_extracts",
    GOLD
    + " UNION ALL ".join(f"SELECT '{name}' AS extract, count(*) AS n_rows FROM {name}" for name in gold.STORED),
)
def _(s: Shop):
    """All extracts written and read back, as dashboards do instead of building them anew."""
    folder = scratch_path(s.spark, "gold")
    built = gold.build_gold(s.stored_star, WINDOW, s.regions)
    return tables.table_counts({name: tables.write_gold(df, name, folder) for name, df in built.items()}).select(
        F.col("table_name").alias("extract"), "n_rows"
    )


@query(
    "gld03_r_score",
    GOLD
    + """SELECT r_score, count(*) AS customers, min(recency_days) AS min_days, max(recency_days) AS max_days
      FROM customer_rfm GROUP BY 1""",
)
def _(s: Shop):
    # both sides read the one aggregation by day
    per_day = gold.per_recency(gold.customer_totals(s.star, WINDOW))
    scored = per_day.crossJoin(F.broadcast(gold.edges_of(per_day))).withColumn("r_score", gold.r_score())
    return scored.groupBy("r_score").agg(
        F.sum("customers").alias("customers"),
        F.min("recency_days").alias("min_days"),
        F.max("recency_days").alias("max_days"),
    )


@query("gld04_f_tier", GOLD + "SELECT f_tier, count(*) AS customers FROM customer_rfm GROUP BY 1")
def _(s: Shop):
    from cartmill.functions.business import frequency_tier

    people = gold.customer_totals(s.star, WINDOW)
    return people.groupBy(frequency_tier("frequency").alias("f_tier")).agg(F.count("*").alias("customers"))


@query(
    "gld05_m_score",
    GOLD
    + """SELECT m_score, count(*) AS customers, round(min(monetary_value), 4) AS min_value,
      round(max(monetary_value), 4) AS max_value FROM customer_rfm GROUP BY 1""",
)
def _(s: Shop):
    return s.rfm.groupBy("m_score").agg(
        F.count("*").alias("customers"),
        F.round(F.min("monetary_value"), 4).alias("min_value"),
        F.round(F.max("monetary_value"), 4).alias("max_value"),
    )


@query(
    "gld06_rfm_segment",
    GOLD + "SELECT segment, r_score, f_tier, count(*) AS customers FROM customer_rfm GROUP BY 1, 2, 3",
)
def _(s: Shop):
    return s.rfm.groupBy("segment", "r_score", "f_tier").agg(F.count("*").alias("customers"))


@query("gld07_satisfaction_summary", GOLD + "SELECT * FROM satisfaction_summary")
def _(s: Shop):
    return s.satisfaction


@query("gld08_primary_category", GOLD + "SELECT * FROM primary_category")
def _(s: Shop):
    orders = gold.order_categories(gold.in_window(s.star["fct_sales"], WINDOW), s.star["dim_products"])
    return orders.select("order_id", "primary_product_category")


@query(
    "gld09_nps_category",
    GOLD
    + """SELECT nps_category, review_score, count(*) AS orders FROM satisfaction_summary GROUP BY 1, 2""",
)
def _(s: Shop):
    return s.satisfaction.groupBy("nps_category", "review_score").agg(F.count("*").alias("orders"))


@query(
    "gld10_delay_days",
    STAGING
    + """SELECT order_id,
      date_sub('day', order_estimated_delivery_date, order_delivered_customer_date) AS delay_days
      FROM stg_orders""",
)
def _(s: Shop):
    from cartmill.functions.dates import whole_days_between

    delay = whole_days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    return s.headers.select("order_id", delay.alias("delay_days"))


@query("gld11_delay_bin", GOLD + "SELECT delay_bin, count(*) AS orders FROM satisfaction_summary GROUP BY 1")
def _(s: Shop):
    return s.satisfaction.groupBy("delay_bin").agg(F.count("*").alias("orders"))


@query("gld12_geo_delivery", GOLD + "SELECT * FROM geo_delivery")
def _(s: Shop):
    return s.geo


@query(
    "gld13_seller_performance",
    GOLD + "SELECT * REPLACE (round(gmv, 4) AS gmv, round(avg_review_score, 6) AS avg_review_score)"
    " FROM seller_performance",
)
def _(s: Shop):
    return rounded(rounded(s.seller_stats, 4, "gmv"), 6, "avg_review_score")


CONCENTRATION_SQL = (
    GOLD
    + """SELECT dimension, group_key, round(gini, 6) AS gini, round(cr4, 6) AS cr4, round(cr10, 6) AS cr10,
    round(hhi, 4) AS hhi, n_entities, round(top_20pct_share, 6) AS top_20pct_share FROM concentration_metrics"""
)


@query("gld14_concentration_metrics", CONCENTRATION_SQL)
def _(s: Shop):
    stats = gold.concentration_metrics(s.stored_star, WINDOW)
    return rounded(rounded(stats, 6, "gini", "cr4", "cr10", "top_20pct_share"), 4, "hhi")


@query(
    "gld15_add_region",
    STAGING
    + """SELECT customer_id, customer_state, coalesce(region, 'Unknown') AS customer_region
      FROM stg_customers LEFT JOIN regions ON customer_state = state""",
)
def _(s: Shop):
    places = s.customers.select("customer_id", "customer_state")
    return add_region(places, "customer_state", s.regions).select(
        "customer_id", "customer_state", "customer_region"
    )


# --- concentration --------------------------------------------------------------------

CATEGORY_VALUES = """, parts AS (SELECT p_brand, p_partkey, p_retailprice AS v FROM part),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY v, p_partkey) AS i,
  count(*) OVER (PARTITION BY p_brand) AS n, sum(v) OVER (PARTITION BY p_brand) AS t FROM parts)
"""
PARTS = "WITH one AS (SELECT 1)" + CATEGORY_VALUES


@query(
    "con01_lorenz_curve",
    PARTS
    + """SELECT p_brand, round(i / n, 6) AS x,
      round(sum(v) OVER (PARTITION BY p_brand ORDER BY i ROWS UNBOUNDED PRECEDING) / t, 6) AS y FROM ranked
      UNION ALL SELECT DISTINCT p_brand, 0.0::DOUBLE, 0.0::DOUBLE FROM parts""",
)
def _(s: Shop):
    return rounded(con.lorenz_curve(s.part, "p_retailprice", "p_partkey", ["p_brand"]), 6, "x", "y").select(
        "p_brand", "x", "y"
    )


@query(
    "con02_gini",
    GOLD
    + """SELECT round(sum((2 * i - n - 1) * gmv) / (any_value(n) * sum(gmv)), 6) AS gini
      FROM (SELECT gmv, row_number() OVER (ORDER BY gmv, seller_id) AS i, count(*) OVER () AS n
            FROM seller_performance)""",
)
def _(s: Shop):
    return rounded(con.gini(s.seller_stats, "gmv", "seller_id"), 6, "gini")


@query(
    "con03_hhi",
    """SELECT l_suppkey % 10 AS supplier_group, round(sum(v * v) / (sum(v) * sum(v)) * 10000, 6) AS hhi
       FROM (SELECT l_suppkey, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1) GROUP BY 1""",
)
def _(s: Shop):
    totals = s.lineitem.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("v"))
    grouped = totals.withColumn("supplier_group", F.col("l_suppkey") % 10)
    return rounded(con.hhi(grouped, "v", ["supplier_group"]), 6, "hhi")


@query(
    "con04_top_k_share",
    """SELECT c_mktsegment, CASE WHEN count(*) >= 10 THEN
         round(sum(CASE WHEN r <= 10 THEN v ELSE 0 END) / sum(v), 6) END AS cr10
       FROM (SELECT c_mktsegment, v, row_number() OVER (PARTITION BY c_mktsegment ORDER BY v DESC, c_custkey) AS r
             FROM (SELECT c_custkey, c_mktsegment, sum(o_totalprice) AS v FROM orders
                   JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)) GROUP BY 1""",
)
def _(s: Shop):
    spend = s.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("v"))
    placed = spend.join(s.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
    return rounded(con.top_share(placed, "v", "c_custkey", 10, ["c_mktsegment"]), 6, "cr10")


@query(
    "con05_top_20_percent_share",
    """SELECT round(sum(CASE WHEN r <= greatest(1, (n + 4) // 5) THEN v ELSE 0 END) / sum(v), 6) AS ceil_share,
         round(sum(CASE WHEN r <= greatest(1, n // 5) THEN v ELSE 0 END) / sum(v), 6) AS floor_share
       FROM (SELECT v, row_number() OVER (ORDER BY v DESC, l_suppkey) AS r, count(*) OVER () AS n
             FROM (SELECT l_suppkey, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1))""",
)
def _(s: Shop):
    totals = s.lineitem.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("v"))
    both = con.concentration_summary(totals, "v", "l_suppkey", top=(), rounding=("ceil", "floor"))
    return both.select(*[F.round(f"top_20pct_share_{mode}", 6).alias(f"{mode}_share") for mode in ("ceil", "floor")])


@query(
    "con06_concentration_summary",
    GOLD
    + """SELECT group_key AS customer_state, round(gini, 6) AS gini, round(cr4, 6) AS cr4,
      round(cr10, 6) AS cr10, round(hhi, 4) AS hhi, n AS n_entities,
      round(top_20pct_share, 6) AS top_20pct_share
      FROM (SELECT group_key, any_value(n) AS n, sum((n + 1 - 2 * rnk) * value) / (any_value(n) * sum(value)) AS gini,
              CASE WHEN any_value(n) >= 4
                   THEN sum(CASE WHEN rnk <= 4 THEN value ELSE 0 END) / sum(value) END AS cr4,
              CASE WHEN any_value(n) >= 10
                   THEN sum(CASE WHEN rnk <= 10 THEN value ELSE 0 END) / sum(value) END AS cr10,
              sum(value * value) / (sum(value) * sum(value)) * 10000 AS hhi,
              sum(CASE WHEN rnk <= greatest(1, (n + 4) // 5) THEN value ELSE 0 END) / sum(value)
                AS top_20pct_share
            FROM (SELECT customer_state AS group_key, monetary_value AS value,
                    row_number() OVER (PARTITION BY customer_state ORDER BY monetary_value DESC,
                                       customer_unique_id) AS rnk,
                    count(*) OVER (PARTITION BY customer_state) AS n FROM rfm_base) GROUP BY 1)""",
)
def _(s: Shop):
    people = gold.customer_totals(s.star, WINDOW)
    stats = con.concentration_summary(people, "monetary_value", "customer_unique_id", ["customer_state"])
    return rounded(rounded(stats, 6, "gini", "cr4", "cr10", "top_20pct_share"), 4, "hhi")


PARETO = (
    GOLD
    + """, pareto AS (SELECT seller_id, gmv, row_number() OVER w AS rank,
      100.0::DOUBLE * row_number() OVER w / count(*) OVER () AS entity_pct,
      100.0::DOUBLE * sum(gmv) OVER w / sum(gmv) OVER () AS cum_value_pct FROM seller_performance
      WINDOW w AS (ORDER BY gmv DESC, seller_id ROWS UNBOUNDED PRECEDING))
"""
)


@query(
    "con07_pareto_curve",
    PARETO
    + """SELECT seller_id, round(gmv, 4) AS gmv, rank, round(entity_pct, 6) AS entity_pct,
      round(cum_value_pct, 6) AS cum_value_pct FROM pareto""",
)
def _(s: Shop):
    curve = con.pareto_curve(s.seller_stats, "gmv", "seller_id")
    return rounded(rounded(curve, 6, "entity_pct", "cum_value_pct"), 4, "gmv")


@query(
    "con08_share_reaching_80",
    PARETO + "SELECT round(min(entity_pct), 6) AS entity_pct FROM pareto WHERE cum_value_pct >= 80",
)
def _(s: Shop):
    curve = con.pareto_curve(s.seller_stats, "gmv", "seller_id")
    return rounded(con.share_reaching(curve, 80.0), 6, "entity_pct")


@query(
    "con09_filtered_category_concentration",
    GOLD
    + """, slice AS (SELECT product_category_name_english AS c, sum(total_sale_amount) AS v FROM sales_orders
       WHERE customer_state IN ('NATION_1', 'NATION_7') GROUP BY 1),
     r AS (SELECT v, row_number() OVER (ORDER BY v DESC, c) AS r, count(*) OVER () AS n FROM slice)
     SELECT round(sum((n + 1 - 2 * r) * v) / (any_value(n) * sum(v)), 6) AS gini,
       round(sum(CASE WHEN r <= 4 THEN v ELSE 0 END) / sum(v), 6) AS cr4,
       round(sum(CASE WHEN r <= 10 THEN v ELSE 0 END) / sum(v), 6) AS cr10,
       round(sum(v * v) / (sum(v) * sum(v)) * 10000, 4) AS hhi, any_value(n) AS n_entities,
       round(sum(CASE WHEN r <= greatest(1, (n + 4) // 5) THEN v ELSE 0 END) / sum(v), 6) AS top_20pct_share,
       CASE WHEN sum(v * v) / (sum(v) * sum(v)) * 10000 < 1500 THEN 'diversified' ELSE 'concentrated' END
         AS market FROM r""",
)
def _(s: Shop):
    from cartmill.plans.filters import FilterSpec, apply_filters

    sliced = apply_filters(s.sales, FilterSpec(states=["NATION_1", "NATION_7"]))
    stats = metrics.category_concentration(sliced)
    return rounded(rounded(stats, 6, "gini", "cr4", "cr10", "top_20pct_share"), 4, "hhi")


@query(
    "con10_monthly_gini_trend",
    GOLD
    + """SELECT group_key AS period, round(gini, 6) AS gini, round(avg(gini) OVER (), 6) AS mean_gini
      FROM concentration_metrics WHERE dimension = 'seller_gmv_monthly'""",
)
def _(s: Shop):
    return rounded(metrics.gini_trend(gold.concentration_metrics(s.star, WINDOW, families=["seller_gmv_monthly"])), 6, "gini", "mean_gini")
