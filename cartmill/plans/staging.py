"""Typed, cleansed views over the raw text entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.functions.scalars import at_least, blank_to_null
from cartmill.operators.relational import keep_latest

# Payment type to drop, label of products without a category, and the
# bounding box a coordinate must lie in.
UNDEFINED_PAYMENT = "not_defined"
NO_CATEGORY = "uncategorized"
LAT_RANGE = (-35.0, 5.0)
LNG_RANGE = (-75.0, -34.0)


def _text(*names: str) -> list[Column]:
    return [F.col(n).cast("string").alias(n) for n in names]


def _safe(name: str, kind: str, alias: str | None = None) -> Column:
    """Unparsable text becomes NULL."""
    return F.col(name).try_cast(kind).alias(alias or name)


def _strict(name: str, kind: str) -> Column:
    """Unparsable text is an error."""
    return F.col(name).cast(kind).alias(name)


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text(
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        )
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    moments = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    typed = raw.select(
        *_text("order_id", "customer_id", "order_status"), *[_safe(m, "timestamp") for m in moments]
    )
    return typed.withColumn("date_key", F.to_date("order_purchase_timestamp"))


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("order_id"),
        _strict("order_item_id", "bigint"),
        *_text("product_id", "seller_id"),
        _strict("shipping_limit_date", "timestamp"),
        _strict("price", "double"),
        _strict("freight_value", "double"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    kept = raw.filter(F.col("payment_type") != UNDEFINED_PAYMENT)
    return kept.select(
        *_text("order_id"),
        _strict("payment_sequential", "bigint"),
        *_text("payment_type"),
        at_least(F.col("payment_installments").cast("bigint"), 1).alias("payment_installments"),
        _strict("payment_value", "double"),
    )


def stg_reviews(raw: DataFrame) -> DataFrame:
    """Latest answer per review; equal answer times are settled by order id."""
    latest = keep_latest(raw, ["review_id"], "review_answer_timestamp", ["order_id"])
    typed = latest.select(
        *_text("review_id", "order_id"),
        _strict("review_score", "bigint"),
        *_text("review_comment_title", "review_comment_message"),
        _strict("review_creation_date", "timestamp"),
        _strict("review_answer_timestamp", "timestamp"),
    )
    return typed.withColumn("date_key", F.to_date("review_creation_date"))


def stg_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    lookup = translation.select(
        F.col("product_category_name").alias("_name"),
        F.col("product_category_name_english").cast("string").alias("_english"),
    )
    joined = raw.join(lookup, F.col("product_category_name") == F.col("_name"), "left")
    english = F.coalesce("_english", blank_to_null("product_category_name"), F.lit(NO_CATEGORY))
    return joined.select(
        *_text("product_id", "product_category_name"),
        english.alias("product_category_name_english"),
        _safe("product_name_lenght", "bigint", "product_name_length"),
        _safe("product_description_lenght", "bigint", "product_description_length"),
        _safe("product_photos_qty", "bigint"),
        _safe("product_weight_g", "bigint"),
        _safe("product_length_cm", "double"),
        _safe("product_height_cm", "double"),
        _safe("product_width_cm", "double"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(*_text("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"))


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """Mean coordinate per postal prefix over the points inside the bounding box."""
    lat, lng = F.col("geolocation_lat").cast("double"), F.col("geolocation_lng").cast("double")
    inside = raw.filter(lat.between(*LAT_RANGE) & lng.between(*LNG_RANGE))
    return inside.groupBy(F.col("geolocation_zip_code_prefix").cast("string").alias("zip_code_prefix")).agg(
        F.avg(lat).alias("geolocation_lat"), F.avg(lng).alias("geolocation_lng")
    )


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(*_text("product_category_name", "product_category_name_english"))


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging views from the nine raw entities."""
    return {
        "stg_customers": stg_customers(raw["customers"]),
        "stg_orders": stg_orders(raw["orders"]),
        "stg_order_items": stg_order_items(raw["order_items"]),
        "stg_payments": stg_payments(raw["order_payments"]),
        "stg_reviews": stg_reviews(raw["order_reviews"]),
        "stg_products": stg_products(raw["products"], raw["category_translation"]),
        "stg_sellers": stg_sellers(raw["sellers"]),
        "stg_geolocation": stg_geolocation(raw["geolocation"]),
        "stg_category_translation": stg_category_translation(raw["category_translation"]),
    }
