"""Business metrics over the gold extracts and staging views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmill.functions.business import DELAY_BINS, SEGMENTS, position_in, seller_tier
from cartmill.functions.dates import period, period_of, whole_days_between
from cartmill.operators.concentration import concentration_summary, diversification, top_count
from cartmill.operators.ranking import with_rank
from cartmill.operators.relational import unpivot

# Fixed values used by the reports.
ARTEFACT_BELOW = 50
MIN_GEO_ORDERS = 30
MIN_CATEGORY_ITEMS = 100
ACTIVE_SELLER_ORDERS = 10
PEAK_MONTHS = (9, 10, 11, 12)
CARD = "credit_card"
MANY_INSTALLMENTS = 10




def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def _with_share(df: DataFrame, value: str, name: str, factor: int = 1) -> DataFrame:
    """Append a column's share of its total; however many groups there are, they meet one row."""
    total = df.agg(F.sum(value).alias("_total"))
    joined = df.crossJoin(F.broadcast(total))
    return joined.withColumn(name, factor * _share(F.col(value), F.col("_total"))).drop("_total")


def _monthly_pct(df: DataFrame) -> DataFrame:
    """Append percent of the month's orders, over rows reduced to a few groups per month."""
    of_month = F.sum("orders").over(Window.partitionBy("period"))
    return df.withColumn("pct", 100 * _share(F.col("orders"), of_month))


def order_view(sales: DataFrame, *columns: str) -> DataFrame:
    """Order-level attributes of item rows, one row per order."""
    return sales.select("order_id", *columns).distinct()


def first_items(sales: DataFrame, *columns: str) -> DataFrame:
    """The order's first item (smallest item id, then product and amount)."""
    order = F.struct("order_item_id", "product_id", "total_sale_amount")
    return sales.groupBy("order_id", *columns).agg(F.min_by("total_sale_amount", order).alias("first_amount"))


def _per_order(sales: DataFrame, *by: str | Column) -> DataFrame:
    """Amounts per order; counting orders afterwards needs no distinct."""
    return sales.groupBy("order_id", *by).agg(F.sum("total_sale_amount").alias("_amount"))


def _month() -> Column:
    return period("year", "month").alias("period")


# --- sales ----------------------------------------------------------------------------


def gmv_summary(sales: DataFrame) -> DataFrame:
    return _per_order(sales).agg(
        F.sum("_amount").alias("gmv"),
        F.count("order_id").alias("orders"),
        _share(F.sum("_amount"), F.count("order_id")).alias("aov"),
    )


def on_time_summary(geo: DataFrame) -> DataFrame:
    return geo.agg(_share(F.sum("on_time_orders"), F.sum("total_orders")).alias("on_time_rate"))


def nps_summary(satisfaction: DataFrame) -> DataFrame:
    """Promoters minus detractors in percent of reviewed orders, and the mean score."""
    c, reviewed = F.col("nps_category"), F.count("nps_category")
    return satisfaction.agg(
        (100 * _share(F.count_if(c == "promoter") - F.count_if(c == "detractor"), reviewed)).alias("nps"),
        F.avg("review_score").alias("avg_score"),
    )


def repeat_summary(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        _share(F.count_if(F.col("frequency") > 1), F.count("*")).alias("repeat_rate"),
        _share(F.count_if(F.col("frequency") == 1), F.count("*")).alias("single_purchase_share"),
    )


def headline_kpis(sales: DataFrame, satisfaction: DataFrame, geo: DataFrame, customers: DataFrame) -> DataFrame:
    """One row; every input is reduced to a scalar before they meet."""
    return (
        gmv_summary(sales)
        .crossJoin(on_time_summary(geo))
        .crossJoin(nps_summary(satisfaction).select("nps"))
        .crossJoin(repeat_summary(customers).select("repeat_rate"))
    )


def monthly_sales(sales: DataFrame) -> DataFrame:
    return (
        _per_order(sales, "year", "month")
        .groupBy(_month())
        .agg(F.sum("_amount").alias("gmv"), F.count("order_id").alias("orders"))
    )


def monthly_order_volume(orders: DataFrame) -> DataFrame:
    """Orders per purchase month over all headers; sparse months are marked."""
    counted = orders.filter(F.col("date_key").isNotNull()).groupBy(period_of("date_key").alias("period"))
    volume = counted.agg(F.count("*").alias("orders"))
    return volume.withColumn("is_artefact", F.col("orders") < ARTEFACT_BELOW)


def half_year_growth(sales: DataFrame) -> DataFrame:
    """Revenue per half-year and its change on the half before."""
    half = F.concat(F.col("year").cast("string"), F.when(F.col("month") <= 6, "-H1").otherwise("-H2"))
    halves = sales.groupBy(half.alias("half")).agg(F.sum("total_sale_amount").alias("gmv"))
    # two rows per year reach this window
    before = F.lag("gmv").over(Window.orderBy("half"))
    return halves.withColumn("growth_pct", 100 * _share(F.col("gmv") - before, before))


def monthly_aov(sales: DataFrame) -> DataFrame:
    return monthly_sales(sales).withColumn("aov", _share(F.col("gmv"), F.col("orders")))


def first_item_aov_by_month(sales: DataFrame) -> DataFrame:
    """Mean amount of each order's first item, as the dashboard defines it."""
    return first_items(sales, "year", "month").groupBy(_month()).agg(F.avg("first_amount").alias("first_item_aov"))


def first_item_aov_by_payment(sales: DataFrame) -> DataFrame:
    firsts = first_items(sales, "primary_payment_type").filter(F.col("primary_payment_type").isNotNull())
    return firsts.groupBy("primary_payment_type").agg(F.avg("first_amount").alias("first_item_aov"))


def payment_mix(sales: DataFrame) -> DataFrame:
    """Orders per first payment type with their share."""
    orders = order_view(sales, "primary_payment_type").filter(F.col("primary_payment_type").isNotNull())
    counted = orders.groupBy("primary_payment_type").agg(F.count("*").alias("orders"))
    return _with_share(counted, "orders", "share")


def payment_totals(payments: DataFrame) -> DataFrame:
    totals = payments.groupBy("payment_type").agg(
        F.count("*").alias("payments"), F.round(F.sum("payment_value"), 2).alias("total_value")
    )
    return totals.orderBy(F.desc("payments"), F.asc("payment_type"))


def card_installments(sales: DataFrame, card: str = CARD) -> DataFrame:
    """Credit-card orders per number of installments."""
    orders = order_view(sales, "primary_payment_type", "primary_payment_installments")
    cards = orders.filter(F.col("primary_payment_type") == card)
    return cards.groupBy(F.col("primary_payment_installments").alias("installments")).agg(
        F.count("*").alias("orders")
    )


def installment_summary(histogram: DataFrame, many: int = MANY_INSTALLMENTS) -> DataFrame:
    """Median, mean and share of long plans, from the histogram."""
    total = F.sum("orders")
    return histogram.agg(
        F.expr("percentile(installments, 0.5, orders)").alias("median_installments"),
        _share(F.sum(F.col("installments") * F.col("orders")), total).alias("mean_installments"),
        _share(F.sum(F.when(F.col("installments") >= many, F.col("orders")).otherwise(0)), total).alias(
            "share_many"
        ),
    )


def status_mix(sales: DataFrame) -> DataFrame:
    """Distinct orders per status and percent of all."""
    counted = order_view(sales, "order_status").groupBy("order_status").agg(F.count("*").alias("orders"))
    return _with_share(counted, "orders", "pct", 100)


def monthly_status_rate(sales: DataFrame, statuses: Sequence[str] = ("canceled", "unavailable")) -> DataFrame:
    """Percent of a month's orders in the given statuses."""
    orders = order_view(sales, "year", "month", "order_status")
    counted = orders.groupBy(_month(), "order_status").agg(F.count("*").alias("orders"))
    return _monthly_pct(counted).filter(F.col("order_status").isin(*statuses))


def cancellation_rate(sales: DataFrame, status: str = "canceled") -> DataFrame:
    orders = order_view(sales, "order_status")
    return orders.agg(_share(F.count_if(F.col("order_status") == status), F.count("*")).alias("cancellation_rate"))


def top_categories(sales: DataFrame, n: int = 15, category: str = "product_category_name_english") -> DataFrame:
    """Largest categories by revenue with their share of the total."""
    totals = sales.groupBy(category).agg(F.sum("total_sale_amount").alias("revenue"))
    shared = _with_share(totals, "revenue", "share")
    return shared.orderBy(F.desc("revenue"), F.asc(category)).limit(n)


def freight_ratio_by_category(
    sales: DataFrame,
    min_items: int = MIN_CATEGORY_ITEMS,
    n: int = 15,
    category: str = "product_category_name_english",
) -> DataFrame:
    totals = sales.groupBy(category).agg(
        F.sum("freight_value").alias("freight"), F.sum("price").alias("price"), F.count("*").alias("items")
    )
    ratios = totals.filter(F.col("items") >= min_items).withColumn(
        "freight_ratio", _share(F.col("freight"), F.col("price"))
    )
    return ratios.orderBy(F.desc("freight_ratio"), F.asc(category)).limit(n)


def freight_ratio(sales: DataFrame) -> DataFrame:
    """Freight over price, and freight's share of revenue."""
    return sales.agg(
        _share(F.sum("freight_value"), F.sum("price")).alias("freight_ratio"),
        _share(F.sum("freight_value"), F.sum("total_sale_amount")).alias("freight_share_of_gmv"),
    )


def peak_season(sales: DataFrame, months: Sequence[int] = PEAK_MONTHS) -> DataFrame:
    return monthly_aov(sales.filter(F.col("month").isin(*months)))


def category_concentration(sales: DataFrame, category: str = "product_category_name_english") -> DataFrame:
    """Concentration of category revenue on any slice; empty below two categories."""
    revenue = sales.groupBy(category).agg(F.sum("total_sale_amount").alias("revenue"))
    return diversification(concentration_summary(revenue, "revenue", category, min_entities=2))


def gini_trend(concentration: DataFrame, dimension: str = "seller_gmv_monthly") -> DataFrame:
    """Gini per month next to the mean over all months."""
    months = concentration.filter(F.col("dimension") == dimension).select(F.col("group_key").alias("period"), "gini")
    return months.crossJoin(F.broadcast(months.agg(F.avg("gini").alias("mean_gini"))))


# --- geography ------------------------------------------------------------------------


def gmv_by(sales: DataFrame, place: str) -> DataFrame:
    """Revenue per state or region with its share."""
    totals = sales.groupBy(place).agg(F.sum("total_sale_amount").alias("gmv"))
    return _with_share(totals, "gmv", "share")


def top_place(sales: DataFrame, place: str) -> DataFrame:
    return gmv_by(sales, place).orderBy(F.desc("gmv"), F.asc(place)).limit(1)


def _weighted_delay() -> Column:
    """Mean delay weighted by orders."""
    return _share(F.sum(F.col("avg_delay_days") * F.col("total_orders")), F.sum("total_orders"))


def on_time_by_region(geo: DataFrame, min_orders: int = MIN_GEO_ORDERS) -> DataFrame:
    totals = geo.groupBy("region").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("on_time_orders").alias("on_time_orders")
    )
    enough = totals.filter(F.col("total_orders") >= min_orders)
    return enough.withColumn("on_time_rate", _share(F.col("on_time_orders"), F.col("total_orders")))


def delay_by_region(geo: DataFrame, min_orders: int = MIN_GEO_ORDERS) -> DataFrame:
    totals = geo.groupBy("region").agg(
        F.sum("total_orders").alias("total_orders"), _weighted_delay().alias("avg_delay")
    )
    label = F.when(F.col("avg_delay") < 0, "Ahead of schedule").otherwise("Behind schedule")
    return totals.filter(F.col("total_orders") >= min_orders).withColumn("schedule_status", label)


def region_month_delay(geo: DataFrame, min_orders: int = MIN_GEO_ORDERS) -> DataFrame:
    """Weighted delay per region and month; thin cells are NULL."""
    cells = geo.groupBy("region", _month()).agg(
        F.sum("total_orders").alias("total_orders"), _weighted_delay().alias("delay")
    )
    return cells.withColumn("delay", F.when(F.col("total_orders") >= min_orders, F.col("delay")))


def region_month_matrix(geo: DataFrame, periods: Sequence[str], min_orders: int = MIN_GEO_ORDERS) -> DataFrame:
    """The same with one column per listed month."""
    cells = region_month_delay(geo, min_orders)
    return cells.groupBy("region").pivot("period", list(periods)).agg(F.first("delay"))


def delivery_summary(sales: DataFrame) -> DataFrame:
    """Delivered, punctual and late orders and the mean delay over distinct orders."""
    actual, due = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    orders = sales.filter(actual.isNotNull()).select(
        "order_id", "order_delivered_customer_date", "order_estimated_delivery_date"
    )
    return orders.distinct().agg(
        F.count("*").alias("delivered"),
        F.count_if(actual <= due).alias("on_time"),
        F.count_if(actual > due).alias("late"),
        F.round(F.avg(whole_days_between(due, actual)), 1).alias("avg_delay_days"),
    )


def lead_times(orders: DataFrame, region: str) -> DataFrame:
    """Promised and actual lead days of delivered orders, and the buffer between them."""
    bought, due, actual = (
        F.col("order_purchase_timestamp"),
        F.col("order_estimated_delivery_date"),
        F.col("order_delivered_customer_date"),
    )
    times = orders.filter(actual.isNotNull()).groupBy(region).agg(
        F.avg(whole_days_between(bought, due)).alias("promised_days"),
        F.avg(whole_days_between(bought, actual)).alias("actual_days"),
    )
    return times.withColumn("buffer_days", F.col("promised_days") - F.col("actual_days"))


# --- sellers --------------------------------------------------------------------------


def with_tier(sellers: DataFrame) -> DataFrame:
    return sellers.withColumn("tier", seller_tier("avg_review_score", "cancellation_rate"))


def seller_kpis(sellers: DataFrame) -> DataFrame:
    """Seller count, percent premium over all sellers, revenue share of the top fifth."""
    ranked = with_rank(
        with_tier(sellers).select("seller_id", "gmv", "tier"),
        [F.col("gmv").desc(), F.col("seller_id").asc()],
        total="gmv",
    )
    top = F.col("rank") <= top_count(F.col("group_rows"), 5, "floor")
    return ranked.agg(
        F.count("*").alias("sellers"),
        (100 * _share(F.count_if(F.col("tier") == "Premium"), F.count("*"))).alias("premium_pct"),
        (100 * _share(F.sum(F.when(top, F.col("gmv")).otherwise(0.0)), F.sum("gmv"))).alias("top_20_share_pct"),
    )


def tier_by_region(sellers: DataFrame, min_orders: int = ACTIVE_SELLER_ORDERS) -> DataFrame:
    """Revenue and sellers of active sellers per tier and region, with subtotals."""
    active = with_tier(sellers).filter(F.col("order_count") >= min_orders)
    return active.rollup("tier", "seller_region").agg(F.sum("gmv").alias("gmv"), F.count("*").alias("sellers"))


def seller_scatter(sellers: DataFrame) -> DataFrame:
    return sellers.filter(F.col("avg_review_score").isNotNull()).select(
        "seller_id", "gmv", "avg_review_score", "order_count", "seller_region"
    )


# --- customers ------------------------------------------------------------------------


def segment_profile(rfm: DataFrame) -> DataFrame:
    """Mean recency, frequency and money score per segment in long form."""
    tier = F.substring("f_tier", 2, 1).cast("int")
    means = rfm.groupBy("segment").agg(
        F.avg("r_score").alias("r_score"), F.avg(tier).alias("f_score"), F.avg("m_score").alias("m_score")
    )
    return unpivot(means, keep=["segment"], cast_to="double", field_name="score", value_name="mean_score")


def score_matrix(rfm: DataFrame) -> DataFrame:
    """Customers per recency score (5 rows) and frequency tier (3 columns), empty cells 0."""
    counted = rfm.groupBy("r_score").pivot("f_tier", ["F1", "F2", "F3"]).count()
    axis = rfm.sparkSession.range(1, 6).select(F.col("id").cast("int").alias("r_score"))
    return axis.join(counted, "r_score", "left").fillna(0, ["F1", "F2", "F3"])


def segment_stats(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.avg("monetary_value").alias("avg_spend"),
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
    )


def segment_sizes(rfm: DataFrame) -> DataFrame:
    """Customers per segment in report order."""
    counted = rfm.groupBy("segment").agg(F.count("*").alias("customers"))
    return counted.withColumn("position", position_in("segment", SEGMENTS)).orderBy("position")


def purchase_frequency(sales: DataFrame, customer: str = "customer_unique_id") -> DataFrame:
    """Customers per number of orders."""
    per_customer = sales.select(customer, "order_id").distinct().groupBy(customer).agg(F.count("*").alias("orders"))
    return per_customer.groupBy("orders").agg(F.count("*").alias("customers"))


def customers_by_state(customers: DataFrame) -> DataFrame:
    counted = customers.groupBy("customer_state").agg(F.count("*").alias("customers"))
    return _with_share(counted, "customers", "share")


def top_states_share(customers: DataFrame, n: int = 5) -> DataFrame:
    leaders = customers_by_state(customers).orderBy(F.desc("customers"), F.asc("customer_state")).limit(n)
    return leaders.agg(F.sum("share").alias("top_share"))


# --- reviews --------------------------------------------------------------------------


def score_distribution(satisfaction: DataFrame) -> DataFrame:
    reviewed = satisfaction.filter(F.col("review_score").isNotNull())
    counted = reviewed.groupBy("review_score", "nps_category").agg(F.count("*").alias("orders"))
    return _with_share(counted, "orders", "share")


def monthly_score(satisfaction: DataFrame) -> DataFrame:
    return satisfaction.groupBy(_month()).agg(F.avg("review_score").alias("avg_score"))


def monthly_nps_mix(satisfaction: DataFrame) -> DataFrame:
    """Percent of a month's orders per category; the total includes orders without review."""
    counted = satisfaction.groupBy(_month(), "nps_category").agg(F.count("*").alias("orders"))
    return _monthly_pct(counted).filter(F.col("nps_category").isNotNull())


def monthly_nps_all_orders(satisfaction: DataFrame) -> DataFrame:
    """Monthly score whose denominator is every order, reviewed or not."""
    c = F.col("nps_category")
    return satisfaction.groupBy(_month()).agg(
        (100 * _share(F.count_if(c == "promoter") - F.count_if(c == "detractor"), F.count("*"))).alias("nps")
    )


def score_by_delay(satisfaction: DataFrame) -> DataFrame:
    """Mean score, orders and percent per delay bin, and the drop from the earliest bin."""
    known = satisfaction.filter(F.col("delay_bin").isNotNull())
    bins = known.groupBy("delay_bin").agg(F.avg("review_score").alias("avg_score"), F.count("*").alias("orders"))
    early = bins.agg(F.max(F.when(F.col("delay_bin") == DELAY_BINS[0], F.col("avg_score"))).alias("_early"))
    return (
        _with_share(bins, "orders", "pct", 100)
        .crossJoin(F.broadcast(early))  # one row
        .withColumn("drop_from_early", F.col("_early") - F.col("avg_score"))
        .drop("_early")
        .withColumn("position", position_in("delay_bin", DELAY_BINS))
        .orderBy("position")
    )


def score_box_by_delay(satisfaction: DataFrame) -> DataFrame:
    """Five-number summary of the score per delay bin, from score counts."""
    known = satisfaction.filter(F.col("delay_bin").isNotNull() & F.col("review_score").isNotNull())
    counted = known.groupBy("delay_bin", "review_score").agg(F.count("*").alias("_n"))
    box = counted.groupBy("delay_bin").agg(
        F.min("review_score").alias("min_score"),
        F.expr("percentile(review_score, array(0.25, 0.5, 0.75), _n)").alias("_q"),
        F.max("review_score").alias("max_score"),
    )
    return box.select(
        "delay_bin",
        "min_score",
        F.col("_q")[0].alias("q1_score"),
        F.col("_q")[1].alias("median_score"),
        F.col("_q")[2].alias("q3_score"),
        "max_score",
    )
