"""Gold extracts over the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.functions.business import (
    add_region,
    delay_bin,
    frequency_tier,
    nps_category,
    region_column_name,
    rfm_segment,
)
from cartmill.functions.dates import period_of, whole_days_between
from cartmill.operators.concentration import concentration_summary
from cartmill.operators.ranking import with_rank
from cartmill.operators.relational import deduplicate, left_join_where
from cartmill.sources.tables import to_contract


@dataclass(frozen=True)
class Window:
    """Observation window, both ends included, and the reference day of customer recency."""

    start: str = "2017-01-01"
    end: str = "2018-08-31"
    reference: str = "2018-08-31"


DEFAULT_WINDOW = Window()

# fixed values: the families of the concentration extract
CUSTOMER_FAMILY = "customer_monetary"
STORED = ("sales_orders", "customer_rfm", "satisfaction_summary", "geo_delivery", "seller_performance", "concentration_metrics")
FAMILIES = ("seller_gmv", "seller_gmv_monthly", "category_seller_gmv", "category_revenue", CUSTOMER_FAMILY)

# Fewest sellers for a monthly and a category concentration figure.
MIN_SELLERS_PER_MONTH = 50
MIN_SELLERS_PER_CATEGORY = 10


def in_window(sales: DataFrame, window: Window) -> DataFrame:
    first, last = F.lit(window.start).cast("date"), F.lit(window.end).cast("date")
    return sales.filter(F.col("date_key").between(first, last))


def _with_calendar(df: DataFrame, calendar: DataFrame) -> DataFrame:
    parts = calendar.select("date_key", F.col("year").cast("bigint"), F.col("month").cast("bigint"))
    return df.join(parts, "date_key")


def _with_state(df: DataFrame, customers: DataFrame) -> DataFrame:
    return df.join(customers.select("customer_unique_id", "customer_state"), "customer_unique_id")


def sales_orders(star: dict[str, DataFrame], window: Window = DEFAULT_WINDOW, regions=None) -> DataFrame:
    """Order items of the window with category, first payment and region.

    Payments join first: the facts are already spread by order when they come from a join.
    """
    payments = star["fct_payments"].select(
        "order_id",
        F.col("payment_type").alias("primary_payment_type"),
        F.col("payment_installments").alias("primary_payment_installments"),
        "payment_sequential",
    )
    sales = in_window(star["fct_sales"], window)
    sales = left_join_where(sales, payments, "order_id", F.col("payment_sequential") == 1)
    sales = _with_state(_with_calendar(sales, star["dim_date"]), star["dim_customers"])
    sales = sales.join(star["dim_products"].select("product_id", "product_category_name_english"), "product_id")
    return to_contract(add_region(sales, "customer_state", regions), "sales_orders")


def customer_totals(star: dict[str, DataFrame], window: Window = DEFAULT_WINDOW) -> DataFrame:
    """Recency, frequency and money per person up to the reference day."""
    reference = F.lit(window.reference).cast("date")
    sales = star["fct_sales"].filter(F.col("date_key") <= reference)
    # to order grain first: the distinct count becomes a plain count
    orders = sales.groupBy("customer_unique_id", "order_id").agg(
        F.max("date_key").alias("_last"), F.sum("total_sale_amount").alias("_amount")
    )
    people = orders.groupBy("customer_unique_id").agg(
        F.datediff(reference, F.max("_last")).cast("bigint").alias("recency_days"),
        F.count("order_id").alias("frequency"),
        F.sum("_amount").alias("monetary_value"),
    )
    return _with_state(people, star["dim_customers"])


def per_recency(people: DataFrame) -> DataFrame:
    """(recency_days, customers); recency has few distinct values."""
    return people.groupBy("recency_days").agg(F.count("*").alias("customers"))


def recency_edges(people: DataFrame) -> DataFrame:
    """The quintile edges of recency as one row e0 .. e5."""
    return edges_of(per_recency(people))


def edges_of(per_day: DataFrame) -> DataFrame:
    points = F.expr("percentile(recency_days, array(0.0, 0.2, 0.4, 0.6, 0.8, 1.0), customers)")
    edges = per_day.agg(points.alias("e"))
    return edges.select(*[F.col("e")[i].alias(f"e{i}") for i in range(6)])


def r_score() -> Column:
    """5 for the most recent fifth .. 1; coinciding edges are an error, as bins would vanish."""
    distinct = F.lit(True)
    for i in range(5):
        distinct = distinct & (F.col(f"e{i}") < F.col(f"e{i + 1}"))
    later = sum((F.when(F.col("recency_days") > F.col(f"e{i}"), 1).otherwise(0) for i in range(1, 5)), F.lit(0))
    return F.when(distinct, F.lit(5) - later).otherwise(
        F.raise_error(F.lit("recency quintile edges coincide")).cast("int")
    )


def m_score() -> Column:
    """Quintile of the monetary rank: right-closed fifths of the range 1 .. n."""
    n = F.greatest(F.col("group_rows") - 1, F.lit(1))
    fifths = F.floor(((F.col("_money_rank") - 1) * 5 + n - 1) / n)
    return F.greatest(F.lit(1), fifths).cast("int")


def customer_rfm(star: dict[str, DataFrame], window: Window = DEFAULT_WINDOW, regions=None) -> DataFrame:
    """Customers with their recency, frequency and money scores and segment."""
    people = customer_totals(star, window)
    ranked = with_rank(
        people, [F.col("monetary_value").asc(), F.col("customer_unique_id").asc()], rank="_money_rank"
    )
    scored = (
        ranked.crossJoin(F.broadcast(recency_edges(ranked)))  # one row
        .withColumn("r_score", r_score())
        .withColumn("f_tier", frequency_tier("frequency"))
        .withColumn("m_score", m_score())
        .withColumn("segment", rfm_segment("r_score", "f_tier"))
    )
    return to_contract(add_region(scored, "customer_state", regions), "customer_rfm")


def last_review(reviews: DataFrame) -> DataFrame:
    """Score of the latest answered review per order; equal times by review id."""
    return deduplicate(
        reviews, ["order_id"], [F.col("review_answer_timestamp").desc(), F.col("review_id").desc()]
    ).select("order_id", "review_score")


ORDER_GRAIN = (
    "order_id",
    "customer_unique_id",
    "date_key",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def order_categories(sales: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order with the category of its highest-amount item.

    Grouping by the order alone (its other attributes depend on it) leaves the result
    spread by order, as the join with the reviews needs it.
    """
    lookup = products.select("product_id", "product_category_name_english", F.lit(True).alias("_known"))
    items = sales.join(lookup, "product_id", "left")
    weight = F.when(
        F.col("_known"),
        F.struct("total_sale_amount", -F.col("order_item_id"), "product_category_name_english"),
    )
    return items.groupBy("order_id").agg(
        *[F.min(c).alias(c) for c in ORDER_GRAIN if c != "order_id"],
        F.max_by("product_category_name_english", weight).alias("primary_product_category"),
    )


def satisfaction_summary(star: dict[str, DataFrame], window: Window = DEFAULT_WINDOW, regions=None) -> DataFrame:
    """Orders of the window with review, delay and main category."""
    orders = order_categories(in_window(star["fct_sales"], window), star["dim_products"])
    orders = orders.join(last_review(star["fct_reviews"]), "order_id", "left")
    orders = _with_state(_with_calendar(orders, star["dim_date"]), star["dim_customers"])
    delay = whole_days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    scored = (
        orders.withColumn("nps_category", nps_category("review_score"))
        .withColumn("delivery_delay_days", delay)
        .withColumn("delay_bin", delay_bin("delivery_delay_days"))
    )
    return to_contract(add_region(scored, "customer_state", regions), "satisfaction_summary")


def geo_delivery(star: dict[str, DataFrame], window: Window = DEFAULT_WINDOW, regions=None) -> DataFrame:
    """Delivered orders per state and month: punctuality and mean delay."""
    delivered = in_window(star["fct_sales"], window).filter(F.col("order_delivered_customer_date").isNotNull())
    orders = delivered.select(*ORDER_GRAIN).distinct()
    orders = _with_calendar(_with_state(orders, star["dim_customers"]), star["dim_date"])
    on_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    delay = whole_days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    cells = orders.groupBy("customer_state", "year", "month").agg(
        # the grain is one row per order
        F.count("order_id").alias("total_orders"),
        F.count_if(on_time).alias("on_time_orders"),
        F.round(F.avg(delay), 2).alias("avg_delay_days"),
    )
    cells = cells.withColumn("on_time_rate", F.round(F.col("on_time_orders") / F.col("total_orders"), 4))
    cells = add_region(cells, "customer_state", regions)
    return to_contract(cells.withColumnRenamed(region_column_name("customer_state"), "region"), "geo_delivery")


CANCELED = "canceled"


def seller_performance(star: dict[str, DataFrame], window: Window = DEFAULT_WINDOW, regions=None) -> DataFrame:
    """Sellers with revenue, orders, cancellation rate and mean score weighted by items."""
    per_order = (
        in_window(star["fct_sales"], window)
        .groupBy("seller_id", "order_id", "order_status")
        .agg(F.sum("total_sale_amount").alias("_amount"), F.count("*").alias("_items"))
    )
    reviews = (
        star["fct_reviews"]
        .groupBy("order_id")
        .agg(F.sum("review_score").alias("_score"), F.count("review_score").alias("_reviews"))
    )
    joined = per_order.join(reviews, "order_id", "left")
    sellers = joined.groupBy("seller_id").agg(
        F.sum("_amount").alias("gmv"),
        F.count("order_id").alias("order_count"),
        F.round(
            F.try_divide(F.count_if(F.col("order_status") == CANCELED), F.count("order_id")), 4
        ).alias("cancellation_rate"),
        F.try_divide(
            F.sum(F.col("_items") * F.col("_score")), F.sum(F.col("_items") * F.col("_reviews"))
        ).alias("avg_review_score"),
    )
    named = sellers.join(star["dim_sellers"].select("seller_id", "seller_state"), "seller_id")
    return to_contract(add_region(named, "seller_state", regions), "seller_performance")


def concentration_inputs(
    star: dict[str, DataFrame],
    window: Window = DEFAULT_WINDOW,
    customers: DataFrame | None = None,
    chosen: Sequence[str] = FAMILIES,
) -> DataFrame:
    """(dimension, group_key, entity, value) of the chosen concentration families."""
    sales = in_window(star["fct_sales"], window)
    categories = star["dim_products"].select("product_id", "product_category_name_english")
    # one pass over the facts; every seller and category family rolls up from it
    base = (
        sales.join(categories, "product_id", "left")
        .groupBy(
            "seller_id",
            F.col("product_category_name_english").alias("category"),
            period_of("date_key").alias("period"),
        )
        .agg(F.sum("total_sale_amount").alias("value"))
    )
    people = (customer_totals(star, window) if customers is None else customers).select(
        F.lit(CUSTOMER_FAMILY).alias("dimension"),
        F.lit("overall").alias("group_key"),
        F.col("customer_unique_id").cast("string").alias("entity"),
        F.col("monetary_value").alias("value"),
    )

    overall = F.lit("overall")

    def family(name: str, group: Column, entity: str) -> Column:
        return F.struct(
            F.lit(name).alias("dimension"), group.alias("group_key"), F.col(entity).cast("string").alias("entity")
        )

    # every base row counts once in each family, so one aggregate serves them all
    by_name = {
        "seller_gmv": (overall, "seller_id"),
        "seller_gmv_monthly": (F.col("period"), "seller_id"),
        "category_seller_gmv": (F.col("category"), "seller_id"),
        "category_revenue": (overall, "category"),
    }
    families = F.array(*[family(name, *of) for name, of in by_name.items() if name in chosen])
    rolled = (
        base.select("value", F.explode(families).alias("family"))
        .select("family.*", "value")
        .filter(F.col("group_key").isNotNull() & F.col("entity").isNotNull())
        .groupBy("dimension", "group_key", "entity")
        .agg(F.sum("value").alias("value"))
    )
    return rolled.unionByName(people) if CUSTOMER_FAMILY in chosen else rolled


def concentration_metrics(
    star: dict[str, DataFrame],
    window: Window = DEFAULT_WINDOW,
    min_month: int = MIN_SELLERS_PER_MONTH,
    min_category: int = MIN_SELLERS_PER_CATEGORY,
    customers: DataFrame | None = None,
    families: Sequence[str] = FAMILIES,
) -> DataFrame:
    """Concentration figures of the chosen families, of groups that have enough entities."""
    inputs = concentration_inputs(star, window, customers, families)
    stats = concentration_summary(inputs, "value", "entity", ["dimension", "group_key"])
    d, n = F.col("dimension"), F.col("n_entities")
    enough = (
        F.when(d == "seller_gmv_monthly", n >= min_month)
        .when(d == "category_seller_gmv", n >= min_category)
        .otherwise(True)
    )
    return to_contract(stats.filter(enough), "concentration_metrics")


def build_gold(star: dict[str, DataFrame], window: Window = DEFAULT_WINDOW, regions=None) -> dict[str, DataFrame]:
    return {
        "sales_orders": sales_orders(star, window, regions),
        "customer_rfm": customer_rfm(star, window, regions),
        "satisfaction_summary": satisfaction_summary(star, window, regions),
        "geo_delivery": geo_delivery(star, window, regions),
        "seller_performance": seller_performance(star, window, regions),
        "concentration_metrics": concentration_metrics(star, window),
    }
