"""Report filters and business metrics over the gold extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartmill.catalog.common import longs, rounded
from cartmill.catalog.registry import query
from cartmill.catalog.shop import WINDOW, Shop
from cartmill.catalog.shop_sql import GOLD, STAGING, STAR
from cartmill.functions.dates import period
from cartmill.plans import filters as fil
from cartmill.plans import gold
from cartmill.plans import metrics as met

SLICE = fil.FilterSpec(
    start="2000-03-15",
    end="2001-06-10",
    categories=["brand#1", "brand#11", "Brand#15", "uncategorized"],
    states=["NATION_1", "NATION_4", "NATION_12", "NATION_20"],
    regions=["AFRICA", "AMERICA", "ASIA", "Unknown"],
)
IN_STATES = "('NATION_1', 'NATION_4', 'NATION_12', 'NATION_20')"
IN_REGIONS = "('AFRICA', 'AMERICA', 'ASIA', 'Unknown')"
PERIOD = "printf('%04d-%02d', year, month) AS period"

# --- filters --------------------------------------------------------------------------


@query(
    "fil01_apply_filters",
    GOLD
    + f"""SELECT * FROM sales_orders WHERE date_key BETWEEN DATE '2000-03-15' AND DATE '2001-06-10'
      AND product_category_name_english IN ('brand#1', 'brand#11', 'Brand#15', 'uncategorized')
      AND customer_state IN {IN_STATES} AND customer_region IN {IN_REGIONS}""",
)
def _(s: Shop):
    return fil.apply_filters(s.sales, SLICE)


@query(
    "fil02_apply_geo_filters",
    GOLD
    + f"""SELECT * FROM geo_delivery WHERE year * 100 + month BETWEEN 200003 AND 200106
      AND customer_state IN {IN_STATES} AND region IN {IN_REGIONS}""",
)
def _(s: Shop):
    return fil.apply_geo_filters(s.geo, SLICE)


@query(
    "fil03_apply_place_filters",
    GOLD
    + f"""SELECT 'customers' AS what, count(*) AS n FROM customer_rfm
      WHERE customer_state IN {IN_STATES} AND customer_region IN {IN_REGIONS}
      UNION ALL SELECT 'sellers', count(*) FROM seller_performance
      WHERE seller_state IN {IN_STATES} AND seller_region IN {IN_REGIONS}""",
)
def _(s: Shop):
    people = fil.apply_rfm_filters(s.rfm, SLICE).agg(F.count("*").alias("n"))
    sellers = fil.apply_seller_filters(s.seller_stats, SLICE).agg(F.count("*").alias("n"))
    return people.select(F.lit("customers").alias("what"), "n").unionByName(
        sellers.select(F.lit("sellers").alias("what"), "n")
    )


@query(
    "fil04_filter_options",
    GOLD
    + """SELECT DISTINCT 'category' AS kind, product_category_name_english AS choice FROM sales_orders
      UNION ALL SELECT DISTINCT 'state', customer_state FROM sales_orders""",
)
def _(s: Shop):
    category = fil.filter_options(s.sales, "product_category_name_english")
    state = fil.filter_options(s.sales, "customer_state")
    return category.select(F.lit("category").alias("kind"), F.col(category.columns[0]).alias("choice")).unionByName(
        state.select(F.lit("state").alias("kind"), F.col("customer_state").alias("choice"))
    )


# --- sales ----------------------------------------------------------------------------


@query(
    "met01_period",
    """SELECT o_orderkey, printf('%04d-%02d', year(o_orderdate), month(o_orderdate)) AS period FROM orders""",
)
def _(s: Shop):
    return s.orders.select("o_orderkey", period(F.year("o_orderdate"), F.month("o_orderdate")).alias("period"))


@query(
    "met02_headline_kpis",
    GOLD
    + """SELECT round(gmv, 4) AS gmv, orders, round(gmv / orders, 6) AS aov, round(on_time_rate, 6) AS on_time_rate,
      round(nps, 6) AS nps, round(repeat_rate, 6) AS repeat_rate
      FROM (SELECT sum(total_sale_amount) AS gmv, count(DISTINCT order_id) AS orders FROM sales_orders),
           (SELECT sum(on_time_orders) / sum(total_orders) AS on_time_rate FROM geo_delivery),
           (SELECT 100 * (count(*) FILTER (nps_category = 'promoter') - count(*) FILTER (nps_category = 'detractor'))
              / count(nps_category) AS nps FROM satisfaction_summary),
           (SELECT avg((frequency > 1)::INT) AS repeat_rate FROM customer_rfm)""",
)
def _(s: Shop):
    facts = s.stored_star
    extracts = (gold.sales_orders, gold.satisfaction_summary, gold.geo_delivery)
    kpis = met.headline_kpis(*[extract(facts, WINDOW, s.regions) for extract in extracts], gold.customer_totals(facts, WINDOW))
    return rounded(rounded(rounded(kpis, 4, "gmv"), 6, "aov"), 6, "on_time_rate", "nps", "repeat_rate")


@query(
    "met03_monthly_sales",
    GOLD
    + f"""SELECT {PERIOD}, round(sum(total_sale_amount), 4) AS gmv, count(DISTINCT order_id) AS orders
      FROM sales_orders GROUP BY 1""",
)
def _(s: Shop):
    return rounded(met.monthly_sales(s.sales), 4, "gmv")


@query(
    "met04_monthly_order_volume",
    STAGING
    + """SELECT strftime(date_key, '%Y-%m') AS period, count(*) AS orders, count(*) < 50 AS is_artefact
      FROM stg_orders GROUP BY 1""",
)
def _(s: Shop):
    return met.monthly_order_volume(s.headers)


@query(
    "met05_half_year_growth",
    GOLD
    + """SELECT half, round(gmv, 4) AS gmv, round(100 * (gmv - lag(gmv) OVER w) / lag(gmv) OVER w, 6) AS growth_pct
      FROM (SELECT year || CASE WHEN month <= 6 THEN '-H1' ELSE '-H2' END AS half, sum(total_sale_amount) AS gmv
            FROM sales_orders GROUP BY 1) WINDOW w AS (ORDER BY half)""",
)
def _(s: Shop):
    return rounded(rounded(met.half_year_growth(s.sales), 4, "gmv"), 6, "growth_pct")


@query(
    "met06_monthly_aov",
    GOLD
    + f"""SELECT {PERIOD}, round(sum(total_sale_amount), 4) AS gmv, count(DISTINCT order_id) AS orders,
      round(sum(total_sale_amount) / count(DISTINCT order_id), 6) AS aov FROM sales_orders GROUP BY 1""",
)
def _(s: Shop):
    return rounded(rounded(met.monthly_aov(s.sales), 4, "gmv"), 6, "aov")


FIRST_ITEMS = (
    GOLD
    + """, first_items AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY order_item_id, product_id, total_sale_amount) AS rn FROM sales_orders) WHERE rn = 1)
"""
)


@query(
    "met07_first_item_aov_by_month",
    FIRST_ITEMS + f"SELECT {PERIOD}, round(avg(total_sale_amount), 6) AS first_item_aov FROM first_items GROUP BY 1",
)
def _(s: Shop):
    # of a mean of cents the seventh digit can be an exact five; noise in the last ones must not decide
    return rounded(rounded(met.first_item_aov_by_month(s.sales), 9, "first_item_aov"), 6, "first_item_aov")


@query(
    "met07_first_item_aov_by_payment",
    FIRST_ITEMS
    + """SELECT primary_payment_type, round(avg(total_sale_amount), 6) AS first_item_aov FROM first_items
      WHERE primary_payment_type IS NOT NULL GROUP BY 1""",
)
def _(s: Shop):
    return rounded(met.first_item_aov_by_payment(s.sales), 6, "first_item_aov")


@query(
    "met08_payment_mix",
    GOLD
    + """SELECT primary_payment_type, count(DISTINCT order_id) AS orders,
      round(count(DISTINCT order_id) / sum(count(DISTINCT order_id)) OVER (), 6) AS share
      FROM sales_orders WHERE primary_payment_type IS NOT NULL GROUP BY 1""",
)
def _(s: Shop):
    return rounded(met.payment_mix(s.sales), 6, "share")


@query(
    "met09_payment_totals",
    STAR
    + """SELECT payment_type, count(*) AS payments, round(sum(payment_value), 2) AS total_value
      FROM fct_payments GROUP BY 1""",
)
def _(s: Shop):
    return met.payment_totals(s.star["fct_payments"])


CARD_ORDERS = (
    GOLD
    + """, cards AS (SELECT DISTINCT order_id, primary_payment_installments AS installments FROM sales_orders
      WHERE primary_payment_type = 'credit_card')
"""
)


@query(
    "met10_installment_histogram", CARD_ORDERS + "SELECT installments, count(*) AS orders FROM cards GROUP BY 1"
)
def _(s: Shop):
    return met.card_installments(s.sales)


@query(
    "met10_installment_summary",
    CARD_ORDERS
    + """SELECT median(installments) AS median_installments, round(avg(installments), 6) AS mean_installments,
      round(avg((installments >= 10)::INT), 6) AS share_many FROM cards""",
)
def _(s: Shop):
    return rounded(met.installment_summary(met.card_installments(s.sales)), 6, "mean_installments", "share_many")


@query(
    "met11_status_mix",
    GOLD
    + """SELECT order_status, count(DISTINCT order_id) AS orders,
      round(100 * count(DISTINCT order_id) / sum(count(DISTINCT order_id)) OVER (), 6) AS pct
      FROM sales_orders GROUP BY 1""",
)
def _(s: Shop):
    return rounded(met.status_mix(s.sales), 6, "pct")


@query(
    "met12_monthly_status_rate",
    GOLD
    + f"""SELECT * FROM (SELECT {PERIOD}, order_status, count(DISTINCT order_id) AS orders,
      round(100 * count(DISTINCT order_id) / sum(count(DISTINCT order_id)) OVER (PARTITION BY year, month), 6) AS pct
      FROM sales_orders GROUP BY year, month, order_status) WHERE order_status IN ('canceled', 'unavailable')""",
)
def _(s: Shop):
    return rounded(met.monthly_status_rate(s.sales), 6, "pct")


@query(
    "met13_cancellation_rate",
    GOLD
    + """SELECT round(count(DISTINCT CASE WHEN order_status = 'canceled' THEN order_id END)
      / count(DISTINCT order_id), 6) AS cancellation_rate FROM sales_orders""",
)
def _(s: Shop):
    return rounded(met.cancellation_rate(s.sales), 6, "cancellation_rate")


@query(
    "met14_top_categories",
    GOLD
    + """SELECT product_category_name_english, round(revenue, 4) AS revenue, round(share, 6) AS share
      FROM (SELECT product_category_name_english, sum(total_sale_amount) AS revenue,
              sum(total_sale_amount) / sum(sum(total_sale_amount)) OVER () AS share
            FROM sales_orders GROUP BY 1)
      ORDER BY revenue DESC LIMIT 15""",
)
def _(s: Shop):
    return rounded(rounded(met.top_categories(s.sales, 15), 4, "revenue"), 6, "share")


@query(
    "met15_freight_ratio_by_category",
    GOLD
    + """SELECT product_category_name_english, round(sum(freight_value), 4) AS freight,
      round(sum(price), 4) AS price, count(*) AS items, round(sum(freight_value) / sum(price), 6) AS freight_ratio
      FROM sales_orders GROUP BY 1 HAVING count(*) >= 100
      ORDER BY sum(freight_value) / sum(price) DESC LIMIT 15""",
)
def _(s: Shop):
    top = met.freight_ratio_by_category(s.sales)
    return rounded(rounded(top, 4, "freight", "price"), 6, "freight_ratio")


@query(
    "met16_freight_share",
    GOLD
    + """SELECT round(sum(freight_value) / sum(price), 6) AS freight_ratio,
      round(sum(freight_value) / sum(total_sale_amount), 6) AS freight_share_of_gmv FROM sales_orders""",
)
def _(s: Shop):
    return rounded(met.freight_ratio(s.sales), 6, "freight_ratio", "freight_share_of_gmv")


@query(
    "met17_peak_season",
    GOLD
    + f"""SELECT {PERIOD}, round(sum(total_sale_amount), 4) AS gmv, count(DISTINCT order_id) AS orders,
      round(sum(total_sale_amount) / count(DISTINCT order_id), 6) AS aov
      FROM sales_orders WHERE month BETWEEN 9 AND 12 GROUP BY 1""",
)
def _(s: Shop):
    return rounded(rounded(met.peak_season(s.sales), 4, "gmv"), 6, "aov")


# --- geography ------------------------------------------------------------------------


@query(
    "met18_gmv_by_state",
    GOLD
    + """SELECT customer_state, round(sum(total_sale_amount), 4) AS gmv,
      round(sum(total_sale_amount) / sum(sum(total_sale_amount)) OVER (), 6) AS share
      FROM sales_orders GROUP BY 1""",
)
def _(s: Shop):
    return rounded(rounded(met.gmv_by(s.sales, "customer_state"), 4, "gmv"), 6, "share")


@query(
    "met18_top_region",
    GOLD
    + """SELECT customer_region, round(gmv, 4) AS gmv, round(share, 6) AS share FROM (
      SELECT customer_region, sum(total_sale_amount) AS gmv,
        sum(total_sale_amount) / sum(sum(total_sale_amount)) OVER () AS share
      FROM sales_orders GROUP BY 1) ORDER BY gmv DESC LIMIT 1""",
)
def _(s: Shop):
    return rounded(rounded(met.top_place(s.sales, "customer_region"), 4, "gmv"), 6, "share")


@query(
    "met19_on_time_by_region",
    GOLD
    + """SELECT region, sum(total_orders)::BIGINT AS total_orders, sum(on_time_orders)::BIGINT AS on_time_orders,
      round(sum(on_time_orders) / sum(total_orders), 6) AS on_time_rate
      FROM geo_delivery GROUP BY 1 HAVING sum(total_orders) >= 30""",
)
def _(s: Shop):
    return rounded(met.on_time_by_region(s.geo), 6, "on_time_rate")


WEIGHTED = "sum(avg_delay_days * total_orders) / sum(total_orders)"


@query(
    "met20_delay_by_region",
    GOLD
    + f"""SELECT region, sum(total_orders)::BIGINT AS total_orders, round({WEIGHTED}, 9) AS avg_delay,
      CASE WHEN {WEIGHTED} < 0 THEN 'Ahead of schedule' ELSE 'Behind schedule' END AS schedule_status
      FROM geo_delivery GROUP BY 1 HAVING sum(total_orders) >= 30""",
)
def _(s: Shop):
    return rounded(met.delay_by_region(s.geo), 9, "avg_delay")


@query(
    "met21_region_month_delay",
    GOLD
    + f"""SELECT region, {PERIOD}, sum(total_orders)::BIGINT AS total_orders,
      CASE WHEN sum(total_orders) >= 30 THEN round({WEIGHTED}, 9) END AS delay
      FROM geo_delivery GROUP BY 1, 2""",
)
def _(s: Shop):
    return rounded(met.region_month_delay(s.geo), 9, "delay")


MATRIX_MONTHS = ("2000-01", "2000-02", "2000-03")


@query(
    "met21_region_month_matrix",
    GOLD
    + "SELECT region, "
    + ", ".join(
        f"""CASE WHEN sum(total_orders) FILTER (p = '{m}') >= 30 THEN round(
          sum(avg_delay_days * total_orders) FILTER (p = '{m}') / sum(total_orders) FILTER (p = '{m}'), 9)
          END AS "{m}" """
        for m in MATRIX_MONTHS
    )
    + " FROM (SELECT *, printf('%04d-%02d', year, month) AS p FROM geo_delivery) GROUP BY 1",
)
def _(s: Shop):
    return rounded(met.region_month_matrix(s.geo, MATRIX_MONTHS), 9, *MATRIX_MONTHS)


@query(
    "met22_delivery_summary",
    STAR
    + """SELECT count(*) AS delivered,
      count(*) FILTER (order_delivered_customer_date <= order_estimated_delivery_date) AS on_time,
      count(*) FILTER (order_delivered_customer_date > order_estimated_delivery_date) AS late,
      round(avg(date_sub('day', order_estimated_delivery_date, order_delivered_customer_date)), 1)
        AS avg_delay_days
      FROM (SELECT DISTINCT order_id, order_delivered_customer_date, order_estimated_delivery_date FROM fct_sales
            WHERE order_delivered_customer_date IS NOT NULL)""",
)
def _(s: Shop):
    return met.delivery_summary(s.star["fct_sales"])


@query(
    "met23_lead_times",
    STAGING
    + """SELECT coalesce(region, 'Unknown') AS customer_region,
      round(avg(date_sub('day', order_purchase_timestamp, order_estimated_delivery_date)), 6) AS promised_days,
      round(avg(date_sub('day', order_purchase_timestamp, order_delivered_customer_date)), 6) AS actual_days,
      round(avg(date_sub('day', order_purchase_timestamp, order_estimated_delivery_date))
        - avg(date_sub('day', order_purchase_timestamp, order_delivered_customer_date)), 6) AS buffer_days
      FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id
      LEFT JOIN regions ON customer_state = state
      WHERE order_delivered_customer_date IS NOT NULL GROUP BY 1""",
)
def _(s: Shop):
    from cartmill.functions.business import add_region

    placed = s.headers.join(s.customers.select("customer_id", "customer_state"), "customer_id")
    times = met.lead_times(add_region(placed, "customer_state", s.regions), "customer_region")
    return rounded(times, 6, "promised_days", "actual_days", "buffer_days")


# --- sellers --------------------------------------------------------------------------

TIERED = (
    GOLD
    + """, tiered AS (SELECT *, CASE WHEN avg_review_score IS NULL THEN 'Unrated'
        WHEN avg_review_score >= 4.0 AND cancellation_rate <= 0.02 THEN 'Premium'
        WHEN avg_review_score >= 3.5 AND cancellation_rate <= 0.05 THEN 'Good'
        WHEN avg_review_score >= 3.0 AND cancellation_rate <= 0.10 THEN 'Average'
        ELSE 'At Risk' END AS tier FROM seller_performance)
"""
)
# The tables cancel a third of all orders, so tiers are tested on a scaled-down rate.
SCALED = TIERED.replace("FROM seller_performance)\n", "FROM scaled)\n").replace(
    ", tiered AS", ", scaled AS (SELECT * REPLACE (cancellation_rate / 10 AS cancellation_rate)"
    " FROM seller_performance), tiered AS"
)


def scaled_sellers(s: Shop):
    return s.seller_stats.withColumn("cancellation_rate", F.col("cancellation_rate") / 10)


@query("met24_seller_tier", SCALED + "SELECT seller_id, tier FROM tiered")
def _(s: Shop):
    return met.with_tier(scaled_sellers(s)).select("seller_id", "tier")


@query(
    "met25_seller_kpis",
    SCALED
    + """SELECT count(*) AS sellers, round(100 * avg((tier = 'Premium')::INT), 6) AS premium_pct,
      round(100 * sum(CASE WHEN r <= greatest(1, n // 5) THEN gmv ELSE 0 END) / sum(gmv), 6) AS top_20_share_pct
      FROM (SELECT *, row_number() OVER (ORDER BY gmv DESC, seller_id) AS r, count(*) OVER () AS n FROM tiered)""",
)
def _(s: Shop):
    return rounded(met.seller_kpis(scaled_sellers(s)), 6, "premium_pct", "top_20_share_pct")


@query(
    "met26_tier_by_region",
    SCALED
    + """SELECT tier, seller_region, round(sum(gmv), 4) AS gmv, count(*) AS sellers FROM tiered
      WHERE order_count >= 10 GROUP BY ROLLUP (tier, seller_region)""",
)
def _(s: Shop):
    return rounded(met.tier_by_region(scaled_sellers(s)), 4, "gmv")


@query(
    "met27_seller_scatter",
    GOLD
    + """SELECT seller_id, round(gmv, 4) AS gmv, round(avg_review_score, 6) AS avg_review_score, order_count,
      seller_region FROM seller_performance WHERE avg_review_score IS NOT NULL""",
)
def _(s: Shop):
    return rounded(rounded(met.seller_scatter(s.seller_stats), 4, "gmv"), 6, "avg_review_score")


# --- customers ------------------------------------------------------------------------


@query(
    "met28_segment_profile",
    GOLD
    + """SELECT segment, 'r_score' AS score, round(avg(r_score), 6) AS mean_score FROM customer_rfm GROUP BY 1
      UNION ALL SELECT segment, 'f_score', round(avg(CAST(f_tier[2] AS INT)), 6) FROM customer_rfm GROUP BY 1
      UNION ALL SELECT segment, 'm_score', round(avg(m_score), 6) FROM customer_rfm GROUP BY 1""",
)
def _(s: Shop):
    return rounded(met.segment_profile(s.rfm), 6, "mean_score")


@query(
    "met29_score_matrix",
    GOLD
    + """SELECT r AS r_score, count(*) FILTER (f_tier = 'F1') AS "F1", count(*) FILTER (f_tier = 'F2') AS "F2",
      count(*) FILTER (f_tier = 'F3') AS "F3"
      FROM (SELECT unnest([1, 2, 3, 4, 5])::INT AS r) LEFT JOIN customer_rfm ON r = r_score GROUP BY 1""",
)
def _(s: Shop):
    return met.score_matrix(s.rfm)


@query(
    "met30_segment_stats",
    GOLD
    + """SELECT segment, count(*) AS customers, round(avg(monetary_value), 6) AS avg_spend,
      round(avg(recency_days), 6) AS avg_recency, round(avg(frequency), 6) AS avg_frequency
      FROM customer_rfm GROUP BY 1""",
)
def _(s: Shop):
    return rounded(rounded(met.segment_stats(s.rfm), 6, "avg_spend"), 6, "avg_recency", "avg_frequency")


@query(
    "met31_segment_sizes",
    GOLD
    + """SELECT segment, count(*) AS customers, list_position(['Champions', 'Loyal', 'Promising', 'At Risk',
      'High Value Lost', 'Hibernating'], segment)::BIGINT - 1 AS position FROM customer_rfm GROUP BY 1""",
)
def _(s: Shop):
    return longs(met.segment_sizes(s.rfm), "position")


@query(
    "met32_repeat_rate",
    GOLD
    + """SELECT round(avg((frequency > 1)::INT), 6) AS repeat_rate,
      round(avg((frequency = 1)::INT), 6) AS single_purchase_share FROM customer_rfm""",
)
def _(s: Shop):
    return rounded(met.repeat_summary(s.rfm), 6, "repeat_rate", "single_purchase_share")


# --- reviews --------------------------------------------------------------------------


@query(
    "met33_score_distribution",
    GOLD
    + """SELECT review_score, nps_category, count(*) AS orders, round(count(*) / sum(count(*)) OVER (), 6) AS share
      FROM satisfaction_summary WHERE review_score IS NOT NULL GROUP BY 1, 2""",
)
def _(s: Shop):
    return rounded(met.score_distribution(s.satisfaction), 6, "share")


NPS = "100 * (count(*) FILTER (nps_category = 'promoter') - count(*) FILTER (nps_category = 'detractor'))"


@query(
    "met34_nps_headline",
    GOLD
    + f"""SELECT round({NPS} / count(nps_category), 6) AS nps, round(avg(review_score), 6) AS avg_score
      FROM satisfaction_summary""",
)
def _(s: Shop):
    return rounded(met.nps_summary(s.satisfaction), 6, "nps", "avg_score")


@query(
    "met35_monthly_score",
    GOLD + f"SELECT {PERIOD}, round(avg(review_score), 6) AS avg_score FROM satisfaction_summary GROUP BY 1",
)
def _(s: Shop):
    return rounded(met.monthly_score(s.satisfaction), 6, "avg_score")


@query(
    "met36_monthly_nps_mix",
    GOLD
    + f"""SELECT * FROM (SELECT {PERIOD}, nps_category, count(*) AS orders,
      round(100 * count(*) / sum(count(*)) OVER (PARTITION BY year, month), 6) AS pct
      FROM satisfaction_summary GROUP BY year, month, nps_category) WHERE nps_category IS NOT NULL""",
)
def _(s: Shop):
    return rounded(met.monthly_nps_mix(s.satisfaction), 6, "pct")


@query(
    "met37_monthly_nps_all_orders",
    GOLD + f"SELECT {PERIOD}, round({NPS} / count(*), 6) AS nps FROM satisfaction_summary GROUP BY 1",
)
def _(s: Shop):
    return rounded(met.monthly_nps_all_orders(s.satisfaction), 6, "nps")


@query(
    "met38_score_by_delay",
    GOLD
    + """SELECT delay_bin, round(avg_score, 6) AS avg_score, orders, round(pct, 6) AS pct,
      round(max(avg_score) FILTER (delay_bin = 'early') OVER () - avg_score, 6) AS drop_from_early,
      list_position(['early', 'on-time', '1-3d late', '4-7d late', '7+d late'], delay_bin)::BIGINT - 1 AS position
      FROM (SELECT delay_bin, avg(review_score) AS avg_score, count(*) AS orders,
              100 * count(*) / sum(count(*)) OVER () AS pct
            FROM satisfaction_summary WHERE delay_bin IS NOT NULL GROUP BY 1)""",
)
def _(s: Shop):
    bins = longs(met.score_by_delay(s.satisfaction), "position")
    return rounded(bins, 6, "avg_score", "pct", "drop_from_early")


@query(
    "met39_score_box_by_delay",
    GOLD
    + """SELECT delay_bin, min(review_score) AS min_score, quantile_cont(review_score, 0.25) AS q1_score,
      quantile_cont(review_score, 0.5) AS median_score, quantile_cont(review_score, 0.75) AS q3_score,
      max(review_score) AS max_score
      FROM satisfaction_summary WHERE delay_bin IS NOT NULL AND review_score IS NOT NULL GROUP BY 1""",
)
def _(s: Shop):
    return met.score_box_by_delay(s.satisfaction)


@query(
    "met40_purchase_frequency",
    STAR
    + """SELECT orders, count(*) AS customers FROM (
      SELECT customer_unique_id, count(DISTINCT order_id) AS orders FROM fct_sales GROUP BY 1) GROUP BY 1""",
)
def _(s: Shop):
    return met.purchase_frequency(s.star["fct_sales"])


BY_STATE = (
    STAR
    + """, by_state AS (SELECT customer_state, count(*) AS customers,
      count(*) / sum(count(*)) OVER () AS share FROM dim_customers GROUP BY 1)
"""
)


@query("met41_customers_by_state", BY_STATE + "SELECT customer_state, customers, round(share, 6) AS share FROM by_state")
def _(s: Shop):
    return rounded(met.customers_by_state(s.star["dim_customers"]), 6, "share")


@query(
    "met41_top_states_share",
    BY_STATE
    + """SELECT round(sum(share), 6) AS top_share
      FROM (SELECT share FROM by_state ORDER BY customers DESC, customer_state LIMIT 5)""",
)
def _(s: Shop):
    return rounded(met.top_states_share(s.star["dim_customers"]), 6, "top_share")


@query(
    "gld02_customer_totals",
    GOLD
    + """SELECT customer_unique_id, customer_state, recency_days, frequency,
      round(monetary_value, 4) AS monetary_value FROM rfm_base""",
)
def _(s: Shop):
    return rounded(gold.customer_totals(s.star, WINDOW), 4, "monetary_value")
