"""Header CSV files read with every column as text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.functions.scalars import blank_to_null
from cartmill.sources.split_csv import read_split_csv


@dataclass(frozen=True)
class Entity:
    """A source file: its columns in file order and the ones identifying a row."""

    columns: tuple[str, ...]
    keys: tuple[str, ...]
    multiline: bool = False


# Column names of the nine source files, two of them misspelt at the source.
ENTITIES: dict[str, Entity] = {
    "customers": Entity(
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        ("customer_id",),
    ),
    "orders": Entity(
        (
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
        ("order_id",),
    ),
    "order_items": Entity(
        (
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
        ),
        ("order_id", "order_item_id"),
    ),
    "order_payments": Entity(
        ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        ("order_id", "payment_sequential"),
    ),
    "order_reviews": Entity(
        (
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        ),
        ("review_id",),
        multiline=True,
    ),
    "products": Entity(
        (
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
        ("product_id",),
    ),
    "sellers": Entity(
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"), ("seller_id",)
    ),
    "geolocation": Entity(
        (
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ),
        ("geolocation_zip_code_prefix",),
    ),
    "category_translation": Entity(
        ("product_category_name", "product_category_name_english"), ("product_category_name",)
    ),
}

BLANK_POLICIES = ("empty", "null", "keep")


def read_raw(spark: SparkSession, path: str, entity: str, blanks: str = "empty") -> DataFrame:
    """Read one entity as text; a leading byte-order mark in the header is ignored.

    Files of any entity are read by many tasks, those with line breaks inside quotes too.

    ``blanks``: "empty" turns missing cells into '', "null" turns blank cells into NULL,
    "keep" leaves what the CSV reader produced.
    """
    spec = ENTITIES[entity]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in spec.columns])
    if spec.multiline:
        return apply_blank_policy(read_split_csv(spark, path, schema), blanks)
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", True)
    return apply_blank_policy(reader.csv(path), blanks)


def apply_blank_policy(df: DataFrame, blanks: str) -> DataFrame:
    if blanks not in BLANK_POLICIES:
        raise ValueError(f"blanks must be one of {BLANK_POLICIES}, got {blanks!r}")
    if blanks == "keep":
        return df
    if blanks == "empty":
        return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])
    return df.select(*[blank_to_null(c).alias(c) for c in df.columns])
