"""Raw files to gold on a hand-made marketplace holding every known source defect."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartmill.operators import checks as chk
from cartmill.operators import profiling as prf
from cartmill.plans import build, gold, metrics, staging, star
from cartmill.plans.filters import FilterSpec, apply_filters, apply_geo_filters, apply_rfm_filters, filter_options
from cartmill.sources import raw, tables
from conftest import rows

FILES = {
    "customers": [
        "c1,p1,01000,sao paulo,SP",
        "c2,p1,02000,rio,RJ",
        "c0,p1,03000,bahia,BA",
        "c3,p2,01000,sao paulo,SP",
        "c4,p3,99999,nowhere,XX",
        "c5,p4,01000,sao paulo,SP",
    ],
    "orders": [
        # delivered in time, a day late, unreviewed and undelivered, itemless, cancelled
        "o1,c1,delivered,2017-05-01 10:00:00,2017-05-01 11:00:00,,2017-05-20 00:00:00,2017-05-20 00:00:00",
        "o2,c2,delivered,2018-01-02 10:00:00,2018-01-02 11:00:00,,2018-01-10 23:00:00,2018-01-10 00:00:00",
        "o3,c3,shipped,2018-03-03 10:00:00,,,,2018-03-20 00:00:00",
        "o4,c4,delivered,2018-08-31 23:59:59,2018-09-01 00:00:00,,2018-09-21 01:00:00,2018-09-20 00:00:00",
        "o5,c5,unavailable,2018-04-01 00:00:00,,,,2018-04-20 00:00:00",
        "o6,c3,canceled,2018-12-31 08:00:00,,,,2019-01-20 00:00:00",
    ],
    "order_items": [
        "o1,1,x1,s1,2017-05-05 00:00:00,10.00,1.00",
        "o1,2,x2,s2,2017-05-05 00:00:00,50.00,5.00",
        "o2,1,x3,s1,2018-01-05 00:00:00,20.00,2.00",
        "o2,2,x1,s1,2018-01-05 00:00:00,20.00,2.00",
        "o3,1,x4,s1,2018-03-05 00:00:00,30.00,3.00",
        "o4,1,x1,s2,2018-09-05 00:00:00,40.00,4.00",
        "o6,1,x1,s2,2019-01-05 00:00:00,70.00,7.00",
    ],
    "order_payments": [
        "o1,1,boleto,1,66.00",
        "o2,1,credit_card,0,40.00",
        "o2,2,voucher,1,4.00",
        "o3,1,credit_card,3,33.00",
        "o4,1,not_defined,1,0.00",
        "zz,1,debit_card,1,5.00",
    ],
    "order_reviews": [
        'r1,o1,5,"good, really","line one',
        'line two",2017-05-21 00:00:00,2017-05-22 00:00:00',
        "r1,o2,1,,,2017-05-21 00:00:00,2017-05-21 00:00:00",
        "r2,o2,2,,,2018-01-11 00:00:00,2018-01-12 00:00:00",
        "r3,o2,4,,bad,2018-01-11 00:00:00,2018-01-13 00:00:00",
        "r5,o5,3,,,2018-04-21 00:00:00,2018-04-22 00:00:00",
    ],
    "products": [
        "x1,cama_mesa,40,200,1,500,10,5.5,3",
        "x2,pc_gamer,,,,12.5,10,5,3",
        "x3,,40,200,1,500,10,5,3",
        "x4,   ,40,200,1,500,10,5,3",
    ],
    "sellers": ["s1,01000,sao paulo,SP", "s2,50000,recife,PE", "s3,02000,rio,RJ"],
    "geolocation": [
        "01000,-23.0,-46.0,sao paulo,SP",
        "01000,-24.0,-47.0,sao paulo,SP",
        "01000,45.0,-47.0,milano,SP",
        "02000,-22.0,-75.0,rio,RJ",
    ],
    "category_translation": ["cama_mesa,bed_bath"],
}


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    out = {}
    for entity, lines in FILES.items():
        path = folder / f"{entity}.csv"
        header = ",".join(raw.ENTITIES[entity].columns)
        # one of the real files starts with a byte-order mark
        mark = "﻿" if entity == "category_translation" else ""
        path.write_text(mark + header + "\n" + "\n".join(lines) + "\n", encoding="utf-8")
        out[entity] = raw.read_raw(spark, str(path), entity)
    return out


@pytest.fixture(scope="module")
def stg(source):
    return staging.stage_all(source)


@pytest.fixture(scope="module")
def marts(spark, stg):
    return star.build_star(stg, star.dim_date(spark))


def by(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


# --- reading --------------------------------------------------------------------------


def test_raw_is_text_and_ignores_the_byte_order_mark(source):
    assert {t for df in source.values() for _, t in df.dtypes} == {"string"}
    assert source["category_translation"].columns[0] == "product_category_name"
    assert source["category_translation"].first().product_category_name == "cama_mesa"


def test_multiline_cells_stay_together(source):
    review = source["order_reviews"].filter("review_id = 'r1' AND order_id = 'o1'").first()
    assert review.review_comment_title == "good, really"
    assert review.review_comment_message == "line one\nline two"


def test_blank_policies(spark, source, tmp_path):
    assert source["order_reviews"].filter("review_comment_title = ''").count() == 4
    nulled = raw.apply_blank_policy(source["products"], "null")
    assert nulled.filter("product_category_name IS NULL").count() == 2
    with pytest.raises(ValueError):
        raw.apply_blank_policy(nulled, "maybe")
    path = tmp_path / "t.csv"
    path.write_text("product_category_name,product_category_name_english\na,\nb,\"\"\nc, \n")
    kept = raw.read_raw(spark, str(path), "category_translation", "keep")
    assert [r[1] for r in kept.orderBy("product_category_name").collect()] == [None, None, " "]


# --- staging --------------------------------------------------------------------------


def test_orders(stg):
    orders = by(stg["stg_orders"], "order_id")
    assert orders["o3"].order_approved_at is None and orders["o1"].order_delivered_carrier_date is None
    assert orders["o4"].date_key == dt.date(2018, 8, 31)


def test_items_are_strict(spark, stg, source):
    assert stg["stg_order_items"].agg(F.sum("price")).first()[0] == 240.0
    broken = source["order_items"].withColumn("price", F.lit("n/a"))
    with pytest.raises(PySparkException):
        staging.stg_order_items(broken).collect()


def test_payments(stg, source):
    got = by(stg["stg_payments"], "order_id", "payment_sequential")
    assert got[("o2", 1)].payment_installments == 1 and ("o4", 1) not in got
    odd = source["order_payments"].limit(1).withColumn("payment_installments", F.lit(None).cast("string"))
    assert staging.stg_payments(odd).first().payment_installments is None
    untyped = source["order_payments"].withColumn("payment_type", F.lit(None).cast("string"))
    assert staging.stg_payments(untyped).count() == 0


def test_reviews_keep_the_latest_answer(stg):
    got = by(stg["stg_reviews"], "review_id")
    assert len(got) == 4 and got["r1"].order_id == "o1" and got["r1"].date_key == dt.date(2017, 5, 21)


def test_products(stg):
    got = by(stg["stg_products"], "product_id")
    english = {k: v.product_category_name_english for k, v in got.items()}
    assert english == {"x1": "bed_bath", "x2": "pc_gamer", "x3": "uncategorized", "x4": "uncategorized"}
    assert got["x2"].product_name_length is None and got["x2"].product_weight_g is None
    assert got["x1"].product_height_cm == 5.5


def test_geolocation_drops_outliers_before_averaging(stg):
    got = by(stg["stg_geolocation"], "zip_code_prefix")
    assert got["01000"].geolocation_lat == -23.5 and got["02000"].geolocation_lng == -75.0


# --- star schema ----------------------------------------------------------------------


def test_dimensions(marts):
    people = by(marts["dim_customers"], "customer_unique_id")
    assert people["p1"].customer_state == "BA" and len(people) == 4
    assert people["p3"].geolocation_lat is None and people["p2"].geolocation_lat == -23.5
    assert by(marts["dim_sellers"], "seller_id")["s2"].geolocation_lat is None
    calendar = marts["dim_date"]
    assert calendar.count() == 1095
    assert calendar.agg(F.max("date_key")).first()[0] == dt.date(2018, 12, 30)
    assert calendar.filter("date_key = date'2018-12-30'").first().day_of_week == 1


def test_facts(marts):
    sales = marts["fct_sales"]
    assert sales.count() == 7 and sales.filter("order_id = 'o5'").count() == 0
    assert sales.filter("order_id = 'o1' AND order_item_id = 2").first().total_sale_amount == 55.0
    payments = by(marts["fct_payments"], "order_id", "payment_sequential")
    assert payments[("zz", 1)].date_key is None and payments[("o1", 1)].date_key == dt.date(2017, 5, 1)
    assert marts["fct_reviews"].columns[0] == "review_id"


# --- gold -----------------------------------------------------------------------------


def test_sales_orders(marts):
    got = by(gold.sales_orders(marts), "order_id", "order_item_id")
    assert tuple(gold.sales_orders(marts).columns) == tables.GOLD_CONTRACTS["sales_orders"]
    # purchases after the window stay out; an undefined payment leaves no first payment
    assert len(got) == 6 and ("o6", 1) not in got
    assert got[("o4", 1)].primary_payment_type is None and got[("o4", 1)].customer_region == "Unknown"
    assert got[("o2", 1)].primary_payment_installments == 1
    assert got[("o1", 1)].customer_region == "Northeast"


def test_satisfaction(marts):
    got = by(gold.satisfaction_summary(marts), "order_id")
    assert len(got) == 4
    assert (got["o1"].delivery_delay_days, got["o1"].delay_bin, got["o1"].nps_category) == (0, "on-time", "promoter")
    # 23 hours late is still on time; the latest answered review counts
    assert (got["o2"].delivery_delay_days, got["o2"].delay_bin, got["o2"].review_score) == (0, "on-time", 4)
    assert (got["o4"].delivery_delay_days, got["o4"].delay_bin) == (1, "1-3d late")
    assert got["o3"].delivery_delay_days is None and got["o3"].nps_category is None
    # amounts tie in the second order: the first item decides
    assert (got["o1"].primary_product_category, got["o2"].primary_product_category) == ("pc_gamer", "uncategorized")


def test_geo_delivery(marts):
    got = by(gold.geo_delivery(marts), "customer_state", "year")
    assert got[("BA", 2018)].on_time_orders == 0 and got[("BA", 2018)].avg_delay_days == 0.0
    assert got[("BA", 2017)].on_time_rate == 1.0
    assert got[("XX", 2018)].region == "Unknown"


def test_seller_performance(marts):
    got = by(gold.seller_performance(marts), "seller_id")
    assert got["s1"].gmv == 88.0 and got["s1"].order_count == 3
    # two items of one order weigh its reviews twice: (5 + 2 * (2 + 4)) / 5
    assert got["s1"].avg_review_score == pytest.approx(17 / 5)
    assert got["s2"].cancellation_rate == 0.0 and "s3" not in got
    late = gold.seller_performance(marts, gold.Window(end="2018-12-31"))
    assert by(late, "seller_id")["s2"].cancellation_rate == pytest.approx(0.3333)


def people(spark, data):
    schema = "customer_unique_id string, customer_state string, recency_days bigint, frequency bigint, monetary_value double"
    return spark.createDataFrame(data, schema)


def test_scores_match_quantile_cuts(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    n = 57
    data = [(f"p{i:03}", "SP", (i * 37) % 301, 1 + i % 4, float((i * 11) % 13)) for i in range(n)]
    monkeypatch.setattr(gold, "customer_totals", lambda *a: people(spark, data))
    got = gold.customer_rfm({}, gold.DEFAULT_WINDOW).toPandas().sort_values("customer_unique_id")
    frame = pd.DataFrame(data, columns=["p", "s", "r", "f", "m"]).sort_values(["m", "p"])
    frame["m_score"] = pd.qcut(np.arange(1, n + 1), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
    frame["r_score"] = pd.qcut(frame["r"], q=5, labels=[5, 4, 3, 2, 1]).astype(int)
    frame = frame.sort_values("p")
    assert list(got["r_score"]) == list(frame["r_score"])
    assert list(got["m_score"]) == list(frame["m_score"])
    assert tuple(got.columns) == tables.GOLD_CONTRACTS["customer_rfm"]


def test_coinciding_recency_edges_are_an_error(spark, monkeypatch):
    data = [(f"p{i}", "SP", 7, 1, float(i)) for i in range(10)]
    monkeypatch.setattr(gold, "customer_totals", lambda *a: people(spark, data))
    with pytest.raises(PySparkException):
        gold.customer_rfm({}, gold.DEFAULT_WINDOW).collect()


def test_customer_totals(marts):
    got = by(gold.customer_totals(marts), "customer_unique_id")
    # one person bought under two customer ids; purchases after the reference day do not count
    assert got["p1"].frequency == 2 and got["p1"].monetary_value == 110.0
    assert got["p3"].recency_days == 0 and got["p2"].frequency == 1


def test_concentration_thresholds(marts):
    totals = gold.customer_totals(marts)
    all_ = gold.concentration_metrics(marts, min_month=1, min_category=1, customers=totals)
    few = gold.concentration_metrics(marts, customers=totals)
    assert {r.dimension for r in few.collect()} == {"seller_gmv", "category_revenue", "customer_monetary"}
    sellers = [r for r in all_.collect() if r.dimension == "seller_gmv"][0]
    assert sellers.n_entities == 2 and sellers.cr4 is None
    # 88 against 99: gini of two values is half the difference over the sum
    assert sellers.gini == pytest.approx(11 / (2 * 187))


def test_gold_round_trip(spark, marts, tmp_path):
    extract = gold.geo_delivery(marts)
    written = tables.write_gold(extract, "geo_delivery", str(tmp_path))
    assert rows(tables.read_gold(spark, "geo_delivery", str(tmp_path))) == rows(extract)
    assert tuple(written.columns) == tables.GOLD_CONTRACTS["geo_delivery"]
    with pytest.raises(ValueError):
        tables.to_contract(extract.drop("region"), "geo_delivery")


def test_save_table(spark):
    tables.save_table(spark.range(3), "cartmill_saved")
    tables.save_table(spark.range(2), "cartmill_saved")
    assert spark.table("cartmill_saved").count() == 2
    spark.sql("DROP TABLE cartmill_saved")


# --- metrics --------------------------------------------------------------------------


def test_two_nps_definitions(marts):
    satisfaction = gold.satisfaction_summary(marts)
    assert metrics.nps_summary(satisfaction).first().nps == 100.0
    monthly = {r.period: r.nps for r in metrics.monthly_nps_all_orders(satisfaction).collect()}
    assert monthly == {"2017-05": 100.0, "2018-01": 100.0, "2018-03": 0.0, "2018-08": 0.0}


def test_first_item_differs_from_order_value(marts):
    sales = gold.sales_orders(marts)
    assert {r.period: r.aov for r in metrics.monthly_aov(sales).collect()}["2017-05"] == 66.0
    assert {r.period: r.first_item_aov for r in metrics.first_item_aov_by_month(sales).collect()}["2017-05"] == 11.0


def test_empty_slice(marts):
    nothing = apply_filters(gold.sales_orders(marts), FilterSpec(states=["ZZ"]))
    assert metrics.gmv_summary(nothing).first().aov is None
    assert metrics.category_concentration(nothing).count() == 0
    assert metrics.payment_mix(nothing).count() == 0


def test_filters(marts):
    sales = gold.sales_orders(marts)
    assert apply_filters(sales, FilterSpec()).count() == sales.count()
    assert apply_filters(sales, FilterSpec(start="2018-01-02", end="2018-03-03")).count() == 3
    assert apply_filters(sales, FilterSpec(categories=["bed_bath"], regions=["Unknown"])).count() == 1
    geo = gold.geo_delivery(marts)
    assert apply_geo_filters(geo, FilterSpec(start="2018-01-31", end="2018-08-01")).count() == 2
    assert apply_rfm_filters(geo, FilterSpec(start="1990-01-01", end="1990-01-02", states=["BA"])).count() == 2
    options = [r[0] for r in filter_options(sales, "customer_state").collect()]
    assert options == ["BA", "SP", "XX"]


def test_region_matrix_hides_thin_cells(marts):
    geo = gold.geo_delivery(marts)
    matrix = metrics.region_month_matrix(geo, ["2018-01"], min_orders=30)
    assert {r.region: r["2018-01"] for r in matrix.collect()}["Northeast"] is None
    assert {r.region: r["2018-01"] for r in metrics.region_month_matrix(geo, ["2018-01"], 1).collect()}["Northeast"] == 0.0


# --- profile and build ----------------------------------------------------------------


def test_profile(source, stg, tmp_path, spark):
    blanks = {r.column_name: r.blank_count for r in prf.null_counts(source["products"]).collect()}
    assert blanks["product_category_name"] == 2 and "product_id" not in blanks
    assert rows(prf.values_missing_from(
        source["products"], "product_category_name", source["category_translation"], "product_category_name"
    )) == [("pc_gamer",)]
    empty = prf.itemless_orders(stg["stg_orders"], stg["stg_order_items"], stg["stg_reviews"])
    assert rows(empty) == [("unavailable", 1, 1)]
    rate = prf.match_rate(stg["stg_customers"], "customer_zip_code_prefix", stg["stg_geolocation"], "zip_code_prefix").first()
    assert (rate.distinct_keys, rate.matched_keys, rate.matched_rows) == (4, 2, 4)
    assert rows(prf.format_violations(source["customers"], "customer_zip_code_prefix")) == [(6, 0)]
    assert prf.fill_rate_violations(stg["stg_reviews"], "review_comment_title", 0.2).count() == 0
    assert prf.fill_rate_violations(stg["stg_reviews"], "review_comment_title", 0.3).count() == 1
    report = prf.profile({"sellers": source["sellers"]})
    prf.write_profile(report, str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).count() == 12


BOUNDS = {"dim_date": (1000, 1100), "fct_sales": (1, 100), "fct_reviews": (1, 100)}


def test_gated_build_skips_dependents(spark, source, tmp_path):
    steps = build.marketplace_steps(source, star.dim_date(spark))
    done, report = build.gated_build(spark, steps, build.suite_for(BOUNDS), str(tmp_path / "a"))
    status = {r.table_name: (r.status, r.check_name) for r in report.collect()}
    # a purchase on the day after the calendar ends breaks the facts' date reference
    assert status["fct_sales"] == ("failed", "relationships_date_key")
    assert status["fct_payments"] == ("skipped", None)
    assert status["dim_customers"] == ("built", None) and "fct_sales" not in done

    clean = {**source, "orders": source["orders"].filter("order_id <> 'o6'")}
    steps = build.marketplace_steps(clean, star.dim_date(spark))
    by_date = {"fct_sales": ["date_key"], "fct_payments": ["date_key"]}
    done, report = build.gated_build(
        spark, steps, build.suite_for(BOUNDS), str(tmp_path / "b"), partition_by=by_date
    )
    bad = [tuple(r) for r in report.collect() if r.status != "built"]
    assert bad == []
    verdicts = chk.run_suite(done, build.declared_suite(done, BOUNDS))
    assert verdicts.count() == 78 and verdicts.filter("verdict <> 'pass'").count() == 0


def test_declared_suite_size(marts, stg):
    suite = build.declared_suite({**stg, **marts})
    generic = sum(len(v) for v in suite.values()) - 3 - 2
    assert generic == 73
