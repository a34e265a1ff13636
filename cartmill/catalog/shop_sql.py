"""The bindings of ``shop`` as common table expressions for the oracle.

``STAGING`` defines the stg_* relations, ``STAR`` adds the star schema, ``GOLD`` the gold
extracts. A query's SQL is one of them followed by its own SELECT (or ", name AS (...)").
"""

STAGING = """
WITH places AS (SELECT n_nationkey, n_name AS state FROM nation),
regions AS (
  SELECT n_name AS state, CASE WHEN n_regionkey <> 4 THEN r_name END AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
stg_customers AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 10 = 0 THEN c_custkey - 1 ELSE c_custkey END AS customer_unique_id,
         lpad(CAST(c_nationkey * 1000 + c_custkey % 7 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, state AS customer_state
  FROM customer JOIN places ON c_nationkey = n_nationkey
),
stg_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'shipped' ELSE 'delivered' END AS order_status,
         o_orderdate AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 50 <> 0
              THEN o_orderdate + to_hours(CAST(o_orderkey % 5 - 1 AS INTEGER)) END AS order_approved_at,
         CASE WHEN o_orderstatus <> 'O'
              THEN o_orderdate + to_hours(CAST(o_orderkey * 37 % 900 AS INTEGER)) END
           AS order_delivered_customer_date,
         o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date,
         CAST(o_orderdate AS DATE) AS date_key
  FROM orders
),
stg_order_items AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
         l_extendedprice * (1 - l_discount) AS price, l_extendedprice * l_tax AS freight_value
  FROM lineitem
),
stg_payments AS (
  SELECT o_orderkey AS order_id, CAST(seq AS BIGINT) AS payment_sequential,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
              WHEN '3-MEDIUM' THEN 'credit_card' WHEN '4-NOT SPECIFIED' THEN 'voucher'
              WHEN '5-LOW' THEN 'debit_card' END AS payment_type,
         greatest(o_orderkey % 24, 1) AS payment_installments,
         CASE WHEN o_orderkey % 10 = 3 THEN o_totalprice / 2 ELSE o_totalprice END AS payment_value
  FROM orders JOIN (VALUES (1), (2)) s(seq) ON seq = 1 OR o_orderkey % 10 = 3
),
stg_reviews AS (
  SELECT o_orderkey * 2 + copy AS review_id, o_orderkey AS order_id,
         (o_orderkey * 7 + o_custkey + copy) % 5 + 1 AS review_score,
         CASE WHEN o_orderkey % 8 = 1 THEN 'title' ELSE '' END AS review_comment_title,
         CASE WHEN o_orderkey % 5 < 2 THEN 'message' ELSE '' END AS review_comment_message,
         o_orderdate + INTERVAL 30 DAY AS review_creation_date,
         o_orderdate + INTERVAL 32 DAY + to_hours(copy) AS review_answer_timestamp,
         CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS date_key
  FROM orders JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR o_orderkey % 10 = 7
),
stg_products AS (
  SELECT p_partkey AS product_id, raw_category AS product_category_name,
         CASE WHEN raw_category = '' THEN 'uncategorized' WHEN raw_category LIKE '%5' THEN raw_category
              ELSE lower(raw_category) END AS product_category_name_english,
         length(p_name) AS product_name_length, length(p_type) AS product_description_length,
         p_partkey % 4 AS product_photos_qty, CAST(p_size AS BIGINT) AS product_weight_g,
         p_size * 1.0::DOUBLE AS product_length_cm, p_size * 2.0::DOUBLE AS product_height_cm,
         p_size * 0.5::DOUBLE AS product_width_cm
  FROM (SELECT *, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE p_brand END AS raw_category FROM part)
),
stg_sellers AS (
  SELECT s_suppkey AS seller_id,
         lpad(CAST(s_nationkey * 1000 + s_suppkey % 7 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
         s_name AS seller_city, state AS seller_state
  FROM supplier JOIN places ON s_nationkey = n_nationkey
),
points AS (
  SELECT lpad(CAST(c_nationkey * 1000 + c_custkey % 7 AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
         (c_custkey * 13 % 500) / 10.0::DOUBLE - 40 AS geolocation_lat,
         (c_custkey * 7 % 500) / 10.0::DOUBLE - 80 AS geolocation_lng
  FROM customer
),
stg_geolocation AS (
  SELECT geolocation_zip_code_prefix AS zip_code_prefix, avg(geolocation_lat) AS geolocation_lat,
         avg(geolocation_lng) AS geolocation_lng
  FROM points
  WHERE geolocation_lat BETWEEN -35 AND 5 AND geolocation_lng BETWEEN -75 AND -34 GROUP BY 1
)
"""

STAR = (
    STAGING
    + """,
dim_date AS (
  SELECT CAST(d AS DATE) AS date_key, year(d) AS year, month(d) AS month, day(d) AS day,
         dayofweek(d) + 1 AS day_of_week, quarter(d) AS quarter
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS d)
),
dim_customers AS (
  SELECT customer_unique_id, customer_city, customer_state, customer_zip_code_prefix,
         geolocation_lat, geolocation_lng
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) AS rn
        FROM stg_customers)
  LEFT JOIN stg_geolocation ON customer_zip_code_prefix = zip_code_prefix WHERE rn = 1
),
dim_products AS (
  SELECT product_id, product_category_name_english, product_name_length, product_description_length,
         product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
  FROM stg_products
),
dim_sellers AS (
  SELECT seller_id, seller_city, seller_state, seller_zip_code_prefix, geolocation_lat, geolocation_lng
  FROM stg_sellers LEFT JOIN stg_geolocation ON seller_zip_code_prefix = zip_code_prefix
),
fct_sales AS (
  SELECT i.order_id, order_item_id, product_id, seller_id, customer_unique_id, date_key, order_status,
         price, freight_value, price + freight_value AS total_sale_amount,
         order_delivered_customer_date, order_estimated_delivery_date
  FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id
  JOIN stg_customers c ON o.customer_id = c.customer_id
),
fct_reviews AS (
  SELECT review_id, order_id, review_score, review_comment_title, review_comment_message, date_key,
         review_answer_timestamp FROM stg_reviews
),
fct_payments AS (
  SELECT p.order_id, payment_sequential, payment_type, payment_installments, payment_value, date_key
  FROM stg_payments p LEFT JOIN stg_orders o ON p.order_id = o.order_id
)
"""
)

GOLD = (
    STAR
    + """,
win_sales AS (SELECT * FROM fct_sales WHERE date_key BETWEEN DATE '2000-01-01' AND DATE '2001-08-31'),
sales_orders AS (
  SELECT s.order_id, order_item_id, s.product_id, product_category_name_english, s.date_key,
         CAST(year(s.date_key) AS BIGINT) AS year, CAST(month(s.date_key) AS BIGINT) AS month, order_status,
         total_sale_amount, price, freight_value, payment_type AS primary_payment_type,
         payment_installments AS primary_payment_installments, customer_state,
         coalesce(region, 'Unknown') AS customer_region
  FROM win_sales s JOIN dim_customers c ON s.customer_unique_id = c.customer_unique_id
  JOIN dim_products p ON s.product_id = p.product_id
  LEFT JOIN fct_payments f ON s.order_id = f.order_id AND f.payment_sequential = 1
  LEFT JOIN regions ON state = customer_state
),
rfm_base AS (
  SELECT s.customer_unique_id, customer_state,
         date_diff('day', max(date_key), DATE '2001-08-31') AS recency_days,
         count(DISTINCT order_id) AS frequency, sum(total_sale_amount) AS monetary_value
  FROM fct_sales s JOIN dim_customers c ON s.customer_unique_id = c.customer_unique_id
  WHERE date_key <= DATE '2001-08-31' GROUP BY 1, 2
),
rfm_edges AS (
  SELECT quantile_cont(recency_days, 0.2) AS e1, quantile_cont(recency_days, 0.4) AS e2,
         quantile_cont(recency_days, 0.6) AS e3, quantile_cont(recency_days, 0.8) AS e4 FROM rfm_base
),
rfm_scored AS (
  SELECT b.*,
         5 - (recency_days > e1)::INT - (recency_days > e2)::INT - (recency_days > e3)::INT
           - (recency_days > e4)::INT AS r_score,
         CASE frequency WHEN 1 THEN 'F1' WHEN 2 THEN 'F2' ELSE 'F3' END AS f_tier,
         CAST(greatest(1, ceil(
           (row_number() OVER (ORDER BY monetary_value, customer_unique_id) - 1) * 5.0
           / greatest(count(*) OVER () - 1, 1))) AS INTEGER) AS m_score
  FROM rfm_base b, rfm_edges
),
customer_rfm AS (
  SELECT customer_unique_id, customer_state, coalesce(region, 'Unknown') AS customer_region, recency_days,
         frequency, monetary_value, r_score, f_tier, m_score,
         CASE WHEN r_score >= 4 AND f_tier = 'F3' THEN 'Champions'
              WHEN r_score >= 3 AND f_tier <> 'F1' THEN 'Loyal'
              WHEN r_score >= 4 THEN 'Promising'
              WHEN r_score <= 2 AND f_tier = 'F3' THEN 'High Value Lost'
              WHEN r_score <= 2 AND f_tier = 'F2' THEN 'At Risk'
              ELSE 'Hibernating' END AS segment
  FROM rfm_scored LEFT JOIN regions ON state = customer_state
),
order_delivery AS (
  SELECT DISTINCT order_id, customer_unique_id, date_key, order_delivered_customer_date,
         order_estimated_delivery_date FROM win_sales
),
primary_category AS (
  SELECT order_id, product_category_name_english AS primary_product_category FROM (
    SELECT order_id, product_category_name_english, row_number() OVER (
        PARTITION BY order_id
        ORDER BY total_sale_amount DESC, order_item_id, product_category_name_english DESC) AS rn
    FROM win_sales s JOIN dim_products p ON s.product_id = p.product_id) WHERE rn = 1
),
reviews_latest AS (
  SELECT order_id, review_score FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
        ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC) AS rn FROM fct_reviews) WHERE rn = 1
),
satisfaction_base AS (
  SELECT d.order_id, review_score,
         CASE WHEN review_score >= 4 THEN 'promoter' WHEN review_score = 3 THEN 'passive'
              WHEN review_score <= 2 THEN 'detractor' END AS nps_category,
         date_sub('day', order_estimated_delivery_date, order_delivered_customer_date) AS delivery_delay_days,
         d.date_key, CAST(year(d.date_key) AS BIGINT) AS year, CAST(month(d.date_key) AS BIGINT) AS month,
         customer_state, coalesce(region, 'Unknown') AS customer_region, primary_product_category
  FROM order_delivery d JOIN dim_customers c ON d.customer_unique_id = c.customer_unique_id
  LEFT JOIN reviews_latest r ON d.order_id = r.order_id
  LEFT JOIN primary_category p ON d.order_id = p.order_id
  LEFT JOIN regions ON state = customer_state
),
satisfaction_summary AS (
  SELECT order_id, review_score, nps_category, delivery_delay_days,
         CASE WHEN delivery_delay_days < 0 THEN 'early' WHEN delivery_delay_days = 0 THEN 'on-time'
              WHEN delivery_delay_days <= 3 THEN '1-3d late' WHEN delivery_delay_days <= 7 THEN '4-7d late'
              WHEN delivery_delay_days IS NOT NULL THEN '7+d late' END AS delay_bin,
         date_key, year, month, customer_state, customer_region, primary_product_category
  FROM satisfaction_base
),
geo_delivery AS (
  SELECT customer_state, coalesce(any_value(region), 'Unknown') AS region,
         CAST(year(date_key) AS BIGINT) AS year, CAST(month(date_key) AS BIGINT) AS month,
         count(DISTINCT order_id) AS total_orders,
         count(*) FILTER (order_delivered_customer_date <= order_estimated_delivery_date) AS on_time_orders,
         round(count(*) FILTER (order_delivered_customer_date <= order_estimated_delivery_date)
               / count(DISTINCT order_id), 4) AS on_time_rate,
         round(avg(date_sub('day', order_estimated_delivery_date, order_delivered_customer_date)), 2)
           AS avg_delay_days
  FROM order_delivery d JOIN dim_customers c ON d.customer_unique_id = c.customer_unique_id
  LEFT JOIN regions ON state = customer_state
  WHERE order_delivered_customer_date IS NOT NULL GROUP BY customer_state, 3, 4
),
seller_reviews AS (
  SELECT seller_id, avg(review_score) AS avg_review_score
  FROM win_sales s JOIN fct_reviews r ON s.order_id = r.order_id GROUP BY 1
),
seller_performance AS (
  SELECT s.seller_id, seller_state, coalesce(any_value(region), 'Unknown') AS seller_region,
         sum(total_sale_amount) AS gmv, count(DISTINCT order_id) AS order_count, avg_review_score,
         round(count(DISTINCT CASE WHEN order_status = 'canceled' THEN order_id END)
               / count(DISTINCT order_id), 4) AS cancellation_rate
  FROM win_sales s JOIN dim_sellers d ON s.seller_id = d.seller_id
  LEFT JOIN seller_reviews r ON s.seller_id = r.seller_id
  LEFT JOIN regions ON state = seller_state GROUP BY s.seller_id, seller_state, avg_review_score
),
concentration_inputs AS (
  SELECT 'seller_gmv' AS dimension, 'overall' AS group_key, CAST(seller_id AS VARCHAR) AS entity,
         sum(total_sale_amount) AS value FROM win_sales GROUP BY seller_id
  UNION ALL
  SELECT 'seller_gmv_monthly', strftime(date_key, '%Y-%m'), CAST(seller_id AS VARCHAR), sum(total_sale_amount)
  FROM win_sales GROUP BY 2, seller_id
  UNION ALL
  SELECT 'category_seller_gmv', product_category_name_english, CAST(seller_id AS VARCHAR),
         sum(total_sale_amount)
  FROM win_sales s JOIN dim_products p ON s.product_id = p.product_id GROUP BY 2, seller_id
  UNION ALL
  SELECT 'category_revenue', 'overall', product_category_name_english, sum(total_sale_amount)
  FROM win_sales s JOIN dim_products p ON s.product_id = p.product_id GROUP BY 3
  UNION ALL
  SELECT 'customer_monetary', 'overall', CAST(customer_unique_id AS VARCHAR), monetary_value FROM rfm_base
),
concentration_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dimension, group_key ORDER BY value DESC, entity) AS rnk,
         count(*) OVER (PARTITION BY dimension, group_key) AS n FROM concentration_inputs
),
concentration_all AS (
  SELECT dimension, group_key,
         sum((n + 1 - 2 * rnk) * value) / (any_value(n) * sum(value)) AS gini,
         CASE WHEN any_value(n) >= 4 THEN sum(CASE WHEN rnk <= 4 THEN value ELSE 0 END) / sum(value) END AS cr4,
         CASE WHEN any_value(n) >= 10 THEN sum(CASE WHEN rnk <= 10 THEN value ELSE 0 END) / sum(value) END
           AS cr10,
         sum(value * value) / (sum(value) * sum(value)) * 10000 AS hhi, any_value(n) AS n_entities,
         sum(CASE WHEN rnk <= greatest(1, (n + 4) // 5) THEN value ELSE 0 END) / sum(value) AS top_20pct_share
  FROM concentration_ranked GROUP BY 1, 2
),
concentration_metrics AS (
  SELECT * FROM concentration_all
  WHERE CASE dimension WHEN 'seller_gmv_monthly' THEN n_entities >= 50
             WHEN 'category_seller_gmv' THEN n_entities >= 10 ELSE TRUE END
)
"""
)
