"""Tables, views and gold extracts."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column contracts of the gold extracts, in order.
GOLD_CONTRACTS: dict[str, tuple[str, ...]] = {
    "sales_orders": (
        "order_id", "order_item_id", "product_id", "product_category_name_english", "date_key", "year",
        "month", "order_status", "total_sale_amount", "price", "freight_value", "primary_payment_type",
        "primary_payment_installments", "customer_state", "customer_region",
    ),
    "customer_rfm": (
        "customer_unique_id", "customer_state", "customer_region", "recency_days", "frequency",
        "monetary_value", "r_score", "f_tier", "m_score", "segment",
    ),
    "satisfaction_summary": (
        "order_id", "review_score", "nps_category", "delivery_delay_days", "delay_bin", "date_key", "year",
        "month", "customer_state", "customer_region", "primary_product_category",
    ),
    "geo_delivery": (
        "customer_state", "region", "year", "month", "total_orders", "on_time_orders", "on_time_rate",
        "avg_delay_days",
    ),
    "seller_performance": (
        "seller_id", "seller_state", "seller_region", "gmv", "order_count", "avg_review_score",
        "cancellation_rate",
    ),
    "concentration_metrics": (
        "dimension", "group_key", "gini", "cr4", "cr10", "hhi", "n_entities", "top_20pct_share",
    ),
}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2) -> DataFrame:
    """Full refresh of a Parquet table; returns a frame reading what was written.

    The rows go to a folder of their own; a manifest that names it comes last. Until then, or if the write fails,
    readers find the rows of the version before, and a query that runs on those keeps its files: the last ``keep``
    versions stay. With partition columns the rows are rebalanced on them first: each value goes to few files, and a
    value too large for one task is split.
    """
    return write_measured(df, path, {}, partition_by, keep)[0]


def write_measured(
    df: DataFrame, path: str, measures: Mapping[str, Column], partition_by: Sequence[str] = (), keep: int = 2
) -> tuple[DataFrame, dict[str, object]]:
    """``write_table``, and aggregates of the rows collected in the pass that writes them."""
    spark, columns = df.sparkSession, df.columns
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    seen = Observation() if measures else None
    if seen is not None:
        df = df.observe(seen, *[m.alias(name) for name, m in measures.items()])
    snapshot = f"snapshot-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{snapshot}")
    table = Versions(spark, path)
    table.publish({"snapshot": snapshot, "schema": df.schema.json(), "columns": columns})
    table.drop_old(keep)
    return table.read(), dict(seen.get) if seen is not None else {}


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a table that ``write_table`` wrote, or the one asked for."""
    return Versions(spark, path).read(version)


class Versions:
    """Manifests of a table: ``_versions/<number>.json`` names the folder that holds the rows of a version.

    A manifest is created, never replaced, so of two writers one gets the number and the other takes the next; one that
    was cut off while being written does not parse and counts for nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._text = jvm.org.apache.commons.io.IOUtils

    def _names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in milliseconds) of what a folder holds."""
        where = self._path(folder)
        if not self._files.exists(where):
            return []
        return [(f.getPath().getName(), f.getModificationTime()) for f in self._files.listStatus(where)]

    def numbers(self) -> list[int]:
        """Numbers of all manifests, oldest first."""
        found = (re.fullmatch(r"(\d+)\.json", name) for name, _ in self._names(f"{self.root}/_versions"))
        return sorted(int(m[1]) for m in found if m)

    def manifest(self, number: int) -> dict | None:
        stream = self._files.open(self._path(f"{self.root}/_versions/{number:09}.json"))
        try:
            return json.loads(self._text.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def publish(self, manifest: Mapping[str, object]) -> int:
        """Write the manifest of a new version under the next free number."""
        number = max(self.numbers(), default=0) + 1
        while True:
            where = self._path(f"{self.root}/_versions/{number:09}.json")
            try:
                stream = self._files.create(where, False)
                break
            except Py4JJavaError as e:
                if not self._files.exists(where):
                    raise e
                number += 1
        stream.write(json.dumps(manifest).encode())
        stream.close()
        return number

    def read(self, number: int | None = None) -> DataFrame:
        for n in reversed(self.numbers()) if number is None else [number]:
            manifest = self.manifest(n)
            if manifest:
                schema = T.StructType.fromJson(json.loads(manifest["schema"]))
                return self.spark.read.schema(schema).parquet(f"{self.root}/{manifest['snapshot']}").select(*manifest["columns"])
        raise FileNotFoundError(f"no version of a table in {self.root}")

    def drop_old(self, keep: int, orphans_after_hours: float = 24) -> int:
        """Delete versions before the last ``keep``, and rows that have had no manifest for long, as of failed writes."""
        manifests = {n: self.manifest(n) for n in self.numbers()}
        whole = [n for n, m in manifests.items() if m]
        old = [n for n in whole if n < whole[-max(1, keep)]] if len(whole) > keep else []
        for n in old:  # manifests first: rows without one are found again, a manifest without rows would be read
            self._files.delete(self._path(f"{self.root}/_versions/{n:09}.json"), False)
            self._files.delete(self._path(f"{self.root}/{manifests[n]['snapshot']}"), True)
        named = {m["snapshot"] for m in manifests.values() if m}
        limit = time.time() * 1000 - orphans_after_hours * 3_600_000
        for name, changed in self._names(self.root):
            if name.startswith("snapshot-") and name not in named and changed < limit:
                self._files.delete(self._path(f"{self.root}/{name}"), True)
        return len(old)


def save_table(df: DataFrame, name: str, bucket_by: Sequence[str] = (), buckets: int = 0) -> None:
    """Full refresh of a catalog table, written under another name and then renamed.

    Until the rows are written the old table stays as it is, also if writing fails. Tables bucketed alike on the order
    id join each other without a shuffle.
    """
    spark, fresh = df.sparkSession, f"{name}__{uuid.uuid4().hex[:12]}"
    writer = df.write.format("parquet")
    if bucket_by:
        if buckets < 1:
            raise ValueError("give the number of buckets")
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    try:
        writer.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def to_contract(df: DataFrame, name: str) -> DataFrame:
    """Exact columns of a gold extract; missing ones are an error before anything is written."""
    contract = GOLD_CONTRACTS[name]
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df.select(*contract)


def write_gold(df: DataFrame, name: str, folder: str, partition_by: Sequence[str] = ()) -> DataFrame:
    return write_table(to_contract(df, name), f"{folder}/{name}", partition_by)


def read_gold(spark: SparkSession, name: str, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}").select(*GOLD_CONTRACTS[name])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table in one result."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def describe_schema(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable) of every column."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, is_nullable boolean"
    )
