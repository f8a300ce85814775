"""Reports and dashboard queries over the marts.

Roll-ups over years keep the marts' own grain on purpose: customers active in several years
count once per year, and average margins are means of the yearly means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salesloom.functions.numeric import mean, percent, ratio, zero_if_null
from salesloom.plans.marts import Marts, per_customer, per_group, yoy_names


def _total(name: str, alias: str, decimals: int = 0) -> Column:
    return F.round(F.sum(name), decimals).alias(alias)


def _mean_of(name: str, alias: str, decimals: int) -> Column:
    return mean(F.sum(name), F.count(name), decimals).alias(alias)


# --- headline figures -----------------------------------------------------------------


def headline(orders: DataFrame) -> DataFrame:
    """One row of sums over all revenue orders, summed per customer first."""
    return per_group(per_customer(orders, []), [])


def report_topline(orders: DataFrame) -> DataFrame:
    return headline(orders).select(
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.col("customers").alias("unique_customers"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        mean(F.col("margin_sum"), F.col("line_items"), 1).alias("avg_margin_pct"),
        ratio(F.col("revenue"), F.col("orders"), 2).alias("avg_order_value"),
    )


def latest_growth(monthly: DataFrame) -> DataFrame:
    """Growth of the last year on the one before; zero when there are not two years.

    A previous year without revenue counts as one unit. The window sees one row per year.
    """
    years = monthly.groupBy("year").agg(F.round(F.sum("total_revenue"), 0).alias("revenue"))
    before = F.lag("revenue").over(W.orderBy("year"))
    base = F.when(F.col("before") == 0, F.lit(1)).otherwise(F.col("before")).cast("decimal(30,0)")
    last = years.withColumn("before", before).agg(F.max_by(F.struct("before", "revenue"), "year").alias("last"))
    growth = percent(F.col("revenue") - base, base, 1)
    return last.select("last.*").select(F.coalesce(growth, F.lit(0)).cast("decimal(20,1)").alias("yoy_growth"))


def kpi_cards(orders: DataFrame, monthly: DataFrame) -> DataFrame:
    return headline(orders).select(
        zero_if_null(F.col("revenue"), 0).alias("total_revenue"),
        zero_if_null(F.col("profit"), 0).alias("total_profit"),
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce("customers", F.lit(0)).alias("unique_customers"),
        zero_if_null(F.try_divide(F.col("margin_sum"), F.col("line_items")), 1).alias("avg_margin"),
        zero_if_null(F.try_divide(F.col("revenue"), F.col("orders")), 0).alias("avg_order_value"),
        F.coalesce("units", F.lit(0)).alias("total_units"),
        latest_growth(monthly).scalar().alias("yoy_growth"),
    )


# --- one mart, projected ---------------------------------------------------------------


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "year_month", "year", "month_name", "month",
        F.round("total_revenue", 0).alias("revenue"),
        F.round("total_profit", 0).alias("profit"),
        "total_orders",
        F.round("avg_margin_pct", 1).alias("margin"),
        "unique_customers",
        F.round("avg_order_value", 0).alias("aov"),
    ).orderBy("year", "month")


def yoy_table(yoy: DataFrame, years: Sequence[int]) -> DataFrame:
    revenue, growth = yoy_names(years)
    return yoy.select("month", "month_name", *[F.round(c, 0).alias(c) for c in revenue], *growth).orderBy("month")


def campaign_list(campaigns: DataFrame) -> DataFrame:
    return campaigns.orderBy(F.desc("attributed_revenue"), "campaign_id").select(
        "campaign_name", "campaign_type", "goal",
        F.round("campaign_budget", 0).alias("budget"),
        F.round("attributed_revenue", 0).alias("revenue"),
        F.round("attributed_profit", 0).alias("profit"),
        "roi_pct",
        F.col("attributed_orders").alias("orders"),
        F.col("attributed_customers").alias("customers"),
    )


# --- one mart, rolled up ---------------------------------------------------------------


def _rollup(mart: DataFrame, key: str, *measures: Column) -> DataFrame:
    return mart.groupBy(key).agg(_total("total_revenue", "revenue"), *measures)


def _by_revenue(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.desc("revenue"), key)


def report_by_year(monthly: DataFrame) -> DataFrame:
    return _rollup(monthly, "year", F.sum("total_orders").alias("orders")).orderBy("year")


def report_by_region(regions: DataFrame) -> DataFrame:
    return _by_revenue(_rollup(regions, "region", F.sum("total_orders").alias("orders")), "region")


def report_by_segment(segments: DataFrame) -> DataFrame:
    return _by_revenue(_rollup(segments, "segment", F.sum("total_orders").alias("orders")), "segment")


def report_by_channel(channels: DataFrame) -> DataFrame:
    return _by_revenue(_rollup(channels, "channel", F.sum("total_orders").alias("orders")), "channel")


def report_by_category(categories: DataFrame) -> DataFrame:
    return _by_revenue(_rollup(categories, "category", _mean_of("avg_margin_pct", "avg_margin", 1)), "category")


def report_ltv_tiers(ltv: DataFrame) -> DataFrame:
    return (
        ltv.groupBy("ltv_tier")
        .agg(F.count(F.lit(1)).alias("customers"), _total("total_revenue", "total_revenue"))
        .orderBy(F.desc("total_revenue"), "ltv_tier")
    )


def region_rollup(regions: DataFrame) -> DataFrame:
    rolled = _rollup(
        regions,
        "region",
        _total("total_profit", "profit"),
        F.sum("total_orders").alias("orders"),
        F.sum("unique_customers").alias("customers"),
        _mean_of("avg_margin_pct", "avg_margin", 1),
    )
    return _by_revenue(rolled, "region")


def segment_rollup(segments: DataFrame) -> DataFrame:
    rolled = _rollup(
        segments,
        "segment",
        _total("total_profit", "profit"),
        F.sum("total_orders").alias("orders"),
        _mean_of("avg_margin_pct", "avg_margin", 1),
    )
    return _by_revenue(rolled, "segment")


def channel_rollup(channels: DataFrame) -> DataFrame:
    rolled = _rollup(
        channels,
        "channel",
        _total("total_profit", "profit"),
        F.sum("total_orders").alias("orders"),
        _mean_of("avg_margin_pct", "avg_margin", 1),
        _mean_of("avg_order_value", "avg_order_value", 0),
    )
    return _by_revenue(rolled, "channel")


def category_rollup(categories: DataFrame) -> DataFrame:
    rolled = _rollup(
        categories,
        "category",
        _total("total_profit", "profit"),
        _total("total_cost", "cost"),
        _mean_of("avg_margin_pct", "avg_margin", 1),
        F.sum("total_units_sold").alias("units"),
        F.sum("total_orders").alias("orders"),
    )
    return _by_revenue(rolled, "category")


def ltv_tier_stats(ltv: DataFrame) -> DataFrame:
    return (
        ltv.groupBy("ltv_tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            _total("total_revenue", "revenue"),
            _mean_of("total_orders", "avg_orders", 1),
            _mean_of("avg_order_value", "avg_order_value", 0),
        )
        .orderBy(F.desc("revenue"), "ltv_tier")
    )


# --- top k -----------------------------------------------------------------------------


def report_top_products(products: DataFrame, k: int = 5) -> DataFrame:
    return (
        products.orderBy(F.desc("total_revenue"), "product_id")
        .limit(k)
        .select("product_name", "category", "total_revenue", "avg_margin_pct", "total_units_sold")
    )


def report_top_campaigns(campaigns: DataFrame, k: int = 5) -> DataFrame:
    return (
        campaigns.orderBy(F.desc("attributed_revenue"), "campaign_id")
        .limit(k)
        .select("campaign_name", "campaign_type", "attributed_revenue", "roi_pct")
    )


def best_products(products: DataFrame, k: int = 15) -> DataFrame:
    return (
        products.orderBy(F.desc("total_revenue"), "product_id")
        .limit(k)
        .select(
            "product_name", "category", "price_band",
            F.round("total_revenue", 0).alias("revenue"),
            F.round("total_profit", 0).alias("profit"),
            F.col("avg_margin_pct").alias("margin"),
            F.col("total_units_sold").alias("units"),
            "times_ordered", "unique_buyers",
        )
    )


def best_customers(ltv: DataFrame, k: int = 10) -> DataFrame:
    return (
        ltv.orderBy(F.desc("total_revenue"), "customer_id")
        .limit(k)
        .select(
            "name", "segment", "region", "ltv_tier", "total_orders",
            F.round("total_revenue", 0).alias("revenue"),
            F.round("avg_order_value", 0).alias("avg_order_value"),
        )
    )


def ascending_by_revenue(top: DataFrame) -> DataFrame:
    """The same rows with the largest last, as a horizontal bar chart wants them."""
    return top.orderBy("revenue", "name")


def cohort_list(cohorts: DataFrame) -> DataFrame:
    """All cohorts with all their months, in order."""
    return cohorts.orderBy("cohort_month", "activity_month").select(
        "cohort_month", "activity_month", "active_customers", F.round("cohort_revenue", 0).alias("revenue")
    )


def run_reports(marts: Marts) -> dict[str, DataFrame]:
    """The nine console reports, by name."""
    return {
        "report_topline": report_topline(marts.warehouse.order_sales),
        "report_by_year": report_by_year(marts["monthly_revenue"]),
        "report_by_region": report_by_region(marts["revenue_by_region"]),
        "report_by_segment": report_by_segment(marts["revenue_by_segment"]),
        "report_top5_products": report_top_products(marts["top_products"]),
        "report_by_category": report_by_category(marts["category_performance"]),
        "report_top5_campaigns": report_top_campaigns(marts["campaign_roi"]),
        "report_ltv_tiers": report_ltv_tiers(marts["customer_ltv"]),
        "report_by_channel": report_by_channel(marts["channel_performance"]),
    }
