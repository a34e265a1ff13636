"""Star schema over the staging views."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.operators.relational import bounds, date_spine, deduplicate

# Calendar covered by the date dimension, the end excluded.
CALENDAR_START = "2016-01-01"
CALENDAR_END = "2018-12-31"


def _with_location(df: DataFrame, zip_column: str, geo: DataFrame) -> DataFrame:
    return df.join(geo, F.col(zip_column) == F.col("zip_code_prefix"), "left").drop("zip_code_prefix")


def dim_customers(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """One row per person: the address of the smallest customer id."""
    people = deduplicate(customers, ["customer_unique_id"], [F.col("customer_id").asc()])
    cols = ["customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"]
    return _with_location(people.select(*cols), "customer_zip_code_prefix", geo)


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_category_name_english",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_sellers(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    cols = ["seller_id", "seller_city", "seller_state", "seller_zip_code_prefix"]
    return _with_location(sellers.select(*cols), "seller_zip_code_prefix", geo)


def dim_date_of(limits: DataFrame) -> DataFrame:
    """Date dimension over a one-row frame (start, end), the end excluded."""
    d = F.col("date_key")
    return date_spine(limits, "day", "date_key").select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.quarter(d).alias("quarter"),
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    return dim_date_of(bounds(spark, start, end))


def fct_sales(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order items with their order's dates and status and the person who bought.

    Orders meet customers before the items join, so the larger side is shuffled once.
    """
    headers = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "date_key",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ).join(customers.select("customer_id", "customer_unique_id"), "customer_id")
    return items.join(headers, "order_id").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "customer_unique_id",
        "date_key",
        "order_status",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_sale_amount"),
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )


def fct_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "date_key",
        "review_answer_timestamp",
    )


def fct_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments keep their row when the order is unknown; the date is then NULL."""
    return payments.join(orders.select("order_id", "date_key"), "order_id", "left").select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        "date_key",
    )


class LazyTables(Mapping):
    """Tables by name, each planned when first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build_star(stg: Mapping[str, DataFrame], calendar: DataFrame) -> LazyTables:
    """All star-schema tables from the staging views and a date dimension."""
    return LazyTables(
        {
            "dim_customers": lambda: dim_customers(stg["stg_customers"], stg["stg_geolocation"]),
            "dim_products": lambda: dim_products(stg["stg_products"]),
            "dim_sellers": lambda: dim_sellers(stg["stg_sellers"], stg["stg_geolocation"]),
            "dim_date": lambda: calendar,
            "fct_sales": lambda: fct_sales(stg["stg_order_items"], stg["stg_orders"], stg["stg_customers"]),
            "fct_reviews": lambda: fct_reviews(stg["stg_reviews"]),
            "fct_payments": lambda: fct_payments(stg["stg_payments"], stg["stg_orders"]),
        }
    )
