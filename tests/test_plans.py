"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cartmill.catalog.shop import WINDOW, Shop
from cartmill.operators import relational as rel
from cartmill.plans import gold, metrics, star
from cartmill.plans.filters import FilterSpec, apply_filters
from cartmill.sources.tables import save_table, write_table
from conftest import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    """The star schema as stored tables, too large to broadcast."""
    folder = tmp_path_factory.mktemp("star")
    built = Shop(spark, SF).star
    return {name: write_table(df, str(folder / name)) for name, df in built.items()}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def extracts(marts):
    return {
        "sales_orders": gold.sales_orders(marts, WINDOW),
        "satisfaction_summary": gold.satisfaction_summary(marts, WINDOW),
        "geo_delivery": gold.geo_delivery(marts, WINDOW),
        "seller_performance": gold.seller_performance(marts, WINDOW),
    }


def test_no_python_and_no_single_partition(marts, no_broadcast):
    for name, df in extracts(marts).items():
        text = plan(df)
        assert "Python" not in text, name
        assert "SinglePartition" not in text, name
        assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_date_window_reaches_the_scan(marts):
    text = plan(gold.geo_delivery(marts, WINDOW))
    assert "GreaterThanOrEqual(date_key,2000-01-01)" in text
    assert "IsNotNull(order_delivered_customer_date)" in text


def test_only_needed_columns_are_read(marts):
    text = plan(metrics.cancellation_rate(marts["fct_sales"]))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["order_id:bigint,order_status:string"]


def test_filter_lists_reach_the_scan(spark, marts, tmp_path):
    extract = write_table(gold.geo_delivery(marts, WINDOW), str(tmp_path / "geo"))
    text = plan(apply_filters(extract, FilterSpec(states=["NATION_1", "NATION_2"])))
    assert "In(customer_state, [NATION_1,NATION_2])" in text


def test_latest_row_is_limited_before_the_shuffle(marts):
    text = plan(rel.keep_latest(marts["fct_reviews"], ["order_id"], "review_answer_timestamp", ["review_id"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_unused_location_join_disappears(spark):
    shop = Shop(spark, SF)
    people = star.dim_customers(shop.customers, shop.locations).select("customer_unique_id", "customer_state")
    assert "geolocation" not in plan(people)


def test_order_grain_needs_one_shuffle_before_the_reviews(marts, no_broadcast):
    orders = gold.order_categories(marts["fct_sales"], marts["dim_products"])
    joined = orders.join(gold.last_review(marts["fct_reviews"]), "order_id", "left")
    text = plan(joined)
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#", text)) == 2


def test_sales_join_shuffles_items_once(spark, no_broadcast):
    shop = Shop(spark, SF)
    text = plan(star.fct_sales(shop.items, shop.headers, shop.customers.hint("merge")))
    items = [line for line in text.splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(items) == 2


def test_counting_orders_needs_no_distinct_expansion(marts):
    text = plan(metrics.monthly_sales(gold.sales_orders(marts, WINDOW)))
    assert "Expand" not in text and "distinct" not in text.lower().replace("isdistinct", "")


def test_share_of_total_uses_one_row_not_a_window(marts):
    text = plan(metrics.top_categories(gold.sales_orders(marts, WINDOW)))
    assert "Window [" not in text and "BroadcastNestedLoopJoin" in text


def test_results_do_not_depend_on_partitions(spark, marts):
    results = []
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rfm = gold.customer_rfm(marts, WINDOW).withColumn("monetary_value", F.round("monetary_value", 4))
        results.append(sorted(map(tuple, rfm.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_partitioned_facts_are_pruned(marts, tmp_path):
    stored = write_table(marts["fct_sales"], str(tmp_path / "facts"), ["date_key"])
    assert dict(stored.dtypes)["date_key"] == "date"
    text = plan(gold.in_window(stored, WINDOW))
    assert re.search(r"PartitionFilters: \[[^\]]*date_key#\d+ >= 2000-01-01", text)
    assert stored.count() == marts["fct_sales"].count()


def test_tables_bucketed_on_the_order_join_without_shuffle(spark, marts, no_broadcast):
    names = ("bucketed_sales", "bucketed_reviews")
    for name, table in zip(names, ("fct_sales", "fct_reviews"), strict=True):
        save_table(marts[table], name, ["order_id"], 4)
    joined = spark.table(names[0]).join(spark.table(names[1]), "order_id")
    assert "Exchange" not in plan(joined)
    with pytest.raises(ValueError):
        save_table(marts["fct_sales"], "bucketed_sales", ["order_id"])
    for name in names:
        spark.sql(f"DROP TABLE {name}")
