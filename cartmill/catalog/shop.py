"""The driver's tables seen as a marketplace.

Line items are order items, suppliers are sellers, parts are products. What the tables
lack (payments, reviews, delivery times, coordinates) is derived by arithmetic on keys, so
it grows with the tables. ``shop_sql`` holds the same definitions for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartmill.plans import gold, star
from cartmill.plans.staging import LAT_RANGE, LNG_RANGE
from cartmill.session import materialize

WINDOW = gold.Window(start="2000-01-01", end="2001-08-31", reference="2001-08-31")
CALENDAR = ("1995-01-01", "2002-01-01")


class Shop:
    """Lazily bound tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The table, its schema inferred from the files once per process."""
        if name not in self._tables:
            path = f"{self.folder}/{name}.parquet"
            reader = self.spark.read
            if path in SCHEMAS:
                reader = reader.schema(SCHEMAS[path])
            self._tables[name] = reader.parquet(path)
            SCHEMAS.setdefault(path, self._tables[name].schema)
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    # --- staging views, typed ---------------------------------------------------------

    @cached_property
    def places(self) -> DataFrame:
        return self.nation.selectExpr("n_nationkey", "n_name AS state")

    @cached_property
    def regions(self) -> DataFrame:
        """(state, region); the nations of one region have none, to exercise 'Unknown'."""
        named = self.nation.join(self.region, F.expr("n_regionkey = r_regionkey"))
        return named.selectExpr("n_name AS state", "IF(n_regionkey <> 4, r_name, NULL) AS region")

    @cached_property
    def customers(self) -> DataFrame:
        """Every tenth customer id belongs to the person before it."""
        return self.customer.join(self.places, F.expr("c_nationkey = n_nationkey")).selectExpr(
            "c_custkey AS customer_id",
            "CASE WHEN c_custkey % 10 = 0 THEN c_custkey - 1 ELSE c_custkey END AS customer_unique_id",
            f"{zip_code('c_nationkey', 'c_custkey')} AS customer_zip_code_prefix",
            "c_mktsegment AS customer_city",
            "state AS customer_state",
        )

    @cached_property
    def headers(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            """CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'shipped' ELSE 'delivered' END
               AS order_status""",
            "o_orderdate AS order_purchase_timestamp",
            f"""CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + {hours('o_orderkey % 5 - 1')} END
                AS order_approved_at""",
            f"""CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + {hours('o_orderkey * 37 % 900')} END
                AS order_delivered_customer_date""",
            "o_orderdate + INTERVAL 20 DAYS AS order_estimated_delivery_date",
            "to_date(o_orderdate) AS date_key",
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "l_orderkey AS order_id",
            "CAST(l_linenumber AS BIGINT) AS order_item_id",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            "l_shipdate AS shipping_limit_date",
            "l_extendedprice * (1 - l_discount) AS price",
            "l_extendedprice * l_tax AS freight_value",
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One payment per order, a second one for every tenth order."""
        kinds = " ".join(f"WHEN '{found}' THEN '{kind}'" for found, kind in PAYMENT_KINDS.items())
        return self.orders.selectExpr(
            "o_orderkey AS order_id",
            "explode(sequence(1L, IF(o_orderkey % 10 = 3, 2L, 1L))) AS payment_sequential",
            f"CASE o_orderpriority {kinds} END AS payment_type",
            "greatest(o_orderkey % 24, 1L) AS payment_installments",
            "IF(o_orderkey % 10 = 3, o_totalprice / 2, o_totalprice) AS payment_value",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """One review per order, two for every tenth."""
        copies = self.orders.selectExpr("*", "explode(sequence(0, IF(o_orderkey % 10 = 7, 1, 0))) AS copy")
        return copies.selectExpr(
            "o_orderkey * 2 + copy AS review_id",
            "o_orderkey AS order_id",
            "(o_orderkey * 7 + o_custkey + copy) % 5 + 1 AS review_score",
            "IF(o_orderkey % 8 = 1, 'title', '') AS review_comment_title",
            "IF(o_orderkey % 5 < 2, 'message', '') AS review_comment_message",
            "o_orderdate + INTERVAL 30 DAYS AS review_creation_date",
            f"o_orderdate + INTERVAL 32 DAYS + {hours('copy')} AS review_answer_timestamp",
            "to_date(o_orderdate + INTERVAL 30 DAYS) AS date_key",
        )

    @cached_property
    def products(self) -> DataFrame:
        blanked = self.part.selectExpr("*", "IF(p_partkey % 50 = 0, '', p_brand) AS raw_category")
        return blanked.selectExpr(
            "p_partkey AS product_id",
            "raw_category AS product_category_name",
            """CASE WHEN raw_category = '' THEN 'uncategorized' WHEN raw_category LIKE '%5' THEN raw_category
               ELSE lower(raw_category) END AS product_category_name_english""",
            "CAST(length(p_name) AS BIGINT) AS product_name_length",
            "CAST(length(p_type) AS BIGINT) AS product_description_length",
            "p_partkey % 4 AS product_photos_qty",
            "CAST(p_size AS BIGINT) AS product_weight_g",
            "p_size * 1.0D AS product_length_cm",
            "p_size * 2.0D AS product_height_cm",
            "p_size * 0.5D AS product_width_cm",
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self.supplier.join(self.places, F.expr("s_nationkey = n_nationkey")).selectExpr(
            "s_suppkey AS seller_id",
            f"{zip_code('s_nationkey', 's_suppkey')} AS seller_zip_code_prefix",
            "s_name AS seller_city",
            "state AS seller_state",
        )

    @cached_property
    def points(self) -> DataFrame:
        """Raw coordinates, some outside the bounding box."""
        return self.customer.selectExpr(
            f"{zip_code('c_nationkey', 'c_custkey')} AS geolocation_zip_code_prefix",
            "(c_custkey * 13 % 500) / 10.0D - 40 AS geolocation_lat",
            "(c_custkey * 7 % 500) / 10.0D - 80 AS geolocation_lng",
        )

    @cached_property
    def locations(self) -> DataFrame:
        inside = self.points.filter(
            F.col("geolocation_lat").between(*LAT_RANGE) & F.col("geolocation_lng").between(*LNG_RANGE)
        )
        return inside.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
            F.avg("geolocation_lat").alias("geolocation_lat"), F.avg("geolocation_lng").alias("geolocation_lng")
        )

    @cached_property
    def staging(self) -> star.LazyTables:
        return star.LazyTables(
            {
                "stg_customers": lambda: self.customers,
                "stg_orders": lambda: self.headers,
                "stg_order_items": lambda: self.items,
                "stg_payments": lambda: self.payments,
                "stg_reviews": lambda: self.reviews,
                "stg_products": lambda: self.products,
                "stg_sellers": lambda: self.sellers,
                "stg_geolocation": lambda: self.locations,
            }
        )

    # --- star schema and gold ---------------------------------------------------------

    @cached_property
    def calendar(self) -> DataFrame:
        return star.dim_date(self.spark, *CALENDAR)

    @cached_property
    def star(self) -> star.LazyTables:
        return star.build_star(self.staging, self.calendar)

    @cached_property
    def stored_star(self) -> dict[str, DataFrame]:
        """The star schema with the sales written once, for queries reading them often."""
        return {**self.star, "fct_sales": materialize(self.star["fct_sales"])}

    @cached_property
    def sales(self) -> DataFrame:
        return gold.sales_orders(self.star, WINDOW, self.regions)

    @cached_property
    def rfm(self) -> DataFrame:
        return gold.customer_rfm(self.star, WINDOW, self.regions)

    @cached_property
    def satisfaction(self) -> DataFrame:
        return gold.satisfaction_summary(self.star, WINDOW, self.regions)

    @cached_property
    def geo(self) -> DataFrame:
        return gold.geo_delivery(self.star, WINDOW, self.regions)

    @cached_property
    def seller_stats(self) -> DataFrame:
        return gold.seller_performance(self.star, WINDOW, self.regions)

    # --- raw text, with the defects staging has to cope with ----------------------------

    @cached_property
    def raw(self) -> star.LazyTables:
        return star.LazyTables(
            {
                "customers": lambda: as_text(self.customers),
                "orders": lambda: as_text(
                    self.headers.drop("date_key").withColumn("order_delivered_carrier_date", F.lit(""))
                ),
                "order_items": lambda: as_text(self.items),
                "order_payments": self._raw_payments,
                "order_reviews": self._raw_reviews,
                "products": self._raw_products,
                "sellers": lambda: as_text(self.sellers),
                "geolocation": lambda: as_text(self.points),
                "category_translation": self._raw_translation,
            }
        )

    def _raw_payments(self) -> DataFrame:
        """Adds an undefined third payment to every order, and zero installments."""
        lost = self.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.lit(3).alias("payment_sequential"),
            F.lit("not_defined").alias("payment_type"),
            F.lit(1).alias("payment_installments"),
            F.lit(0.0).alias("payment_value"),
        )
        plan = F.when(F.col("order_id") % 24 == 0, 0).otherwise(F.col("payment_installments"))
        return as_text(self.payments.withColumn("payment_installments", plan).unionByName(lost))

    def _raw_reviews(self) -> DataFrame:
        """Repeats some review ids with an earlier answer and another score."""
        reviews = self.reviews.drop("date_key")
        earlier = F.col("review_answer_timestamp") - F.expr("INTERVAL 1 DAY")
        again = reviews.filter(F.col("order_id") % 20 == 1).withColumns(
            {"review_answer_timestamp": earlier, "review_score": F.lit(1)}
        )
        return as_text(reviews.unionByName(again))

    def _raw_products(self) -> DataFrame:
        """Source spelling of two headers, and weights that are not whole numbers."""
        text = as_text(self.products).drop("product_category_name_english")
        fraction = F.when(F.col("product_id") % 7 == 0, F.concat("product_weight_g", F.lit(".5")))
        return text.withColumnsRenamed(
            {
                "product_name_length": "product_name_lenght",
                "product_description_length": "product_description_lenght",
            }
        ).withColumn("product_weight_g", F.coalesce(fraction, "product_weight_g"))

    def _raw_translation(self) -> DataFrame:
        """Brands ending in 5 have no translation."""
        brand = F.col("p_brand")
        known = self.part.filter(~brand.endswith("5")).select(brand.alias("product_category_name"))
        return known.distinct().withColumn("product_category_name_english", F.lower("product_category_name"))


def as_text(df: DataFrame) -> DataFrame:
    """Every column as the text a CSV file would hold; NULL becomes ''."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


TABLES = frozenset(
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations".split()
)


# Schemas of the tables read so far, by path.
SCHEMAS: dict[str, StructType] = {}


def hours(n: str) -> str:
    return f"make_dt_interval(0, CAST({n} AS INT))"


def zip_code(nation: str, key: str) -> str:
    """Five digits: two for the nation, three spread over its keys."""
    return f"lpad(CAST({nation} * 1000 + {key} % 7 AS STRING), 5, '0')"


# Payment type per order priority.
PAYMENT_KINDS = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "credit_card",
    "4-NOT SPECIFIED": "voucher",
    "5-LOW": "debit_card",
}
