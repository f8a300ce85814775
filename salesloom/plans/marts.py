"""The ten KPI marts.

Distinct orders and customers never reach Spark as several DISTINCT aggregates in one query,
which would multiply every row. Rows are summed per order first, then per customer, so that
both counts become row counts. Each step is partially aggregated before its shuffle, so a
region, product or customer with a third of all rows arrives as a few rows per task.

Sums stay decimal here; `publish` turns results into doubles where they leave the library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salesloom import config
from salesloom.functions.numeric import mean, percent, ratio
from salesloom.operators.dedup import has_hot_key
from salesloom.plans.warehouse import Warehouse
from salesloom.sources.store import Store

ADDITIVE = ("line_items", "units", "revenue", "profit", "margin_sum")


def _sums(*extra: Column) -> list[Column]:
    return [F.sum(c).alias(c) for c in ADDITIVE] + list(extra)


def per_customer(orders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order rows to one row per group and customer, with the number of orders."""
    return orders.groupBy(*keys, "customer_key").agg(*_sums(F.count(F.lit(1)).alias("orders")))


def per_group(customers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Customer rows to one row per group, with the number of customers."""
    return customers.groupBy(*keys).agg(*_sums(F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("customers")))


def revenue_lines(fact: DataFrame) -> DataFrame:
    return fact.filter("is_revenue = 1")


def _line_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("line_items"),
        F.sum("quantity").alias("units"),
        F.sum("line_revenue").alias("revenue"),
        F.sum("line_profit").alias("profit"),
        F.sum("line_margin_pct").alias("margin_sum"),
    ]


def per_key(lines: DataFrame, key: str) -> DataFrame:
    """Lines to one row per product or campaign: per order, then per customer, then in all.

    Lines are dealt out once, by product. If one is hot they are dealt out by order too, so a product that one customer buys all
    the time goes to all tasks; its orders are summed up there before they meet by customer, as a row per task.
    """
    dealt = lines.repartition(key, "order_id") if has_hot_key(lines, key) else lines.repartition(key)
    orders = dealt.groupBy(key, "order_id", "customer_key").agg(*_line_sums())
    return per_group(per_customer(orders, [key]), [key])


def _measures(*names: str) -> list[Column]:
    formulas = {
        "total_orders": F.col("orders"),
        "total_line_items": F.col("line_items"),
        "total_units_sold": F.col("units"),
        "total_revenue": F.col("revenue"),
        "total_profit": F.col("profit"),
        # The plain mean of the lines' margins, not weighted by revenue.
        "avg_margin_pct": mean(F.col("margin_sum"), F.col("line_items"), 1),
        "unique_customers": F.col("customers"),
        "avg_order_value": ratio(F.col("revenue"), F.col("orders"), 2),
        "revenue_per_customer": ratio(F.col("revenue"), F.col("customers"), 2),
    }
    return [formulas[n].alias(n) for n in names]


def _on_dates(orders: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """The calendar is a small written table: Spark knows its size, and broadcasts it."""
    return orders.join(dim_date.select("date_key", *columns), "date_key")


def month_labels(dim_date: DataFrame) -> DataFrame:
    return dim_date.select("year", "month", "month_name", "year_month", "quarter").distinct()


def monthly_revenue(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    by_month = per_group(per_customer(_on_dates(orders, dim_date, "year_month"), ["year_month"]), ["year_month"])
    return (
        by_month.join(month_labels(dim_date), "year_month")
        .select(
            "year", "month", "month_name", "year_month", "quarter",
            *_measures(
                "total_orders", "total_line_items", "total_revenue", "total_profit",
                "avg_margin_pct", "unique_customers", "avg_order_value",
            ),
        )
    )


def _by_customer_attribute(
    orders: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, attribute: str, last_measure: str
) -> DataFrame:
    """Customers are summed per year before they meet their dimension: one row each, no hot keys."""
    yearly = per_customer(_on_dates(orders, dim_date, "year"), ["year"])
    joined = yearly.join(dim_customer.select("customer_key", attribute), "customer_key")
    return (
        per_group(joined, [attribute, "year"])
        .select(
            attribute, "year",
            *_measures(
                "total_orders", "unique_customers", "total_revenue", "total_profit", "avg_margin_pct", last_measure
            ),
        )
    )


def revenue_by_region(orders: DataFrame, dim_date: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return _by_customer_attribute(orders, dim_date, dim_customer, "region", "avg_order_value")


def revenue_by_segment(orders: DataFrame, dim_date: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return _by_customer_attribute(orders, dim_date, dim_customer, "segment", "revenue_per_customer")


def channel_performance(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    keys = ["channel", "year"]
    return (
        per_group(per_customer(_on_dates(orders, dim_date, "year"), keys), keys)
        .select(
            *keys,
            *_measures(
                "total_orders", "unique_customers", "total_revenue", "total_profit", "avg_margin_pct", "avg_order_value"
            ),
        )
    )


def top_products(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    products = dim_product.select("product_key", "product_id", F.col("name").alias("product_name"), "category", "price_band")
    return (
        per_key(revenue_lines(fact), "product_key")
        .join(products, "product_key")
        .select(
            "product_id", "product_name", "category", "price_band",
            *_measures("total_units_sold", "total_revenue", "total_profit", "avg_margin_pct"),
            F.col("orders").alias("times_ordered"),
            F.col("customers").alias("unique_buyers"),
        )
    )


def category_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Two narrow passes: sums and products at product grain, distinct orders on their own.

    Their results are a few rows per category and year; stacking and summing them brings both
    together without a join, and keeps products without a category as a group of their own.
    """
    lines = revenue_lines(fact).withColumnRenamed("order_year", "year")
    categories = dim_product.select("product_key", "category")
    keys = ["category", "year"]
    products = (
        lines.groupBy("product_key", "year")
        .agg(*_line_sums(), F.sum("line_cost").alias("cost"))
        .join(categories, "product_key")
        .groupBy(*keys)
        .agg(*_sums(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("products")))
    )
    orders = (
        lines.select("product_key", "year", "order_id")
        .join(categories, "product_key")
        .groupBy(*keys)
        .agg(F.count_distinct("order_id").alias("orders"))
    )
    together = products.unionByName(orders, allowMissingColumns=True)
    return (
        together.groupBy(*keys)
        .agg(*_sums(*[F.sum(c).alias(c) for c in ("cost", "products", "orders")]))
        .select(
            *keys,
            F.col("products").alias("num_products"),
            *_measures("total_units_sold", "total_revenue"),
            F.col("cost").alias("total_cost"),
            *_measures("total_profit", "avg_margin_pct", "total_orders"),
        )
    )


def campaign_roi(fact: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    campaigns = dim_campaign.select(
        "campaign_key", "campaign_id", F.col("name").alias("campaign_name"),
        F.col("type").alias("campaign_type"), "goal", "budget", "status",
    )
    return (
        per_key(revenue_lines(fact).filter("campaign_key IS NOT NULL"), "campaign_key")
        .join(campaigns, "campaign_key")
        .select(
            "campaign_id", "campaign_name", "campaign_type", "goal", "budget", "status",
            F.col("orders").alias("attributed_orders"),
            F.col("customers").alias("attributed_customers"),
            F.col("revenue").alias("attributed_revenue"),
            F.col("profit").alias("attributed_profit"),
            F.round("budget", 2).alias("campaign_budget"),
            percent(F.col("revenue") - F.col("budget"), F.col("budget"), 1).alias("roi_pct"),
        )
    )


def ltv_tier(revenue: Column, thresholds: Sequence[int]) -> Column:
    tiers = config.LTV_TIER_NAMES
    tier = F.when(revenue > thresholds[0], F.lit(tiers[0]))
    for limit, name in zip(thresholds[1:], tiers[1:]):
        tier = tier.when(revenue > limit, F.lit(name))
    return tier.otherwise(F.lit(tiers[-1]))


def customer_ltv(
    orders: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, thresholds: Sequence[int]
) -> DataFrame:
    customers = orders.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
        # Date keys sort like dates; only the two that are kept need their date looked up.
        F.min("date_key").alias("first_key"),
        F.max("date_key").alias("last_key"),
    )
    first = dim_date.select(F.col("date_key").alias("first_key"), F.col("full_date").alias("first_order_date"))
    last = dim_date.select(F.col("date_key").alias("last_key"), F.col("full_date").alias("last_order_date"))
    who = ["customer_id", "name", "region", "segment", "joined_date", "tenure_days", "loyalty_score"]
    return (
        customers.join(first, "first_key")
        .join(last, "last_key")
        .join(dim_customer.select("customer_key", *who), "customer_key")
        .select(
            *who,
            *_measures("total_orders", "total_revenue", "total_profit", "avg_order_value"),
            "first_order_date",
            "last_order_date",
            ltv_tier(F.col("revenue"), thresholds).alias("ltv_tier"),
        )
    )


def cohort_monthly(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """A customer's cohort is the month of the first purchase.

    The window runs over rows that are already summed per customer and month, so its groups
    are no longer than the calendar has months.
    """
    months = _on_dates(orders, dim_date, "year_month").groupBy("customer_key", "year_month").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit")
    )
    cohort = F.min("year_month").over(W.partitionBy("customer_key"))
    return (
        months.withColumn("cohort_month", cohort)
        .groupBy("cohort_month", F.col("year_month").alias("activity_month"))
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.sum("revenue").alias("cohort_revenue"),
            F.sum("profit").alias("cohort_profit"),
        )
    )


def yoy_names(years: Sequence[int]) -> tuple[list[str], list[str]]:
    revenue = [f"revenue_{y}" for y in years]
    growth = [f"growth_{a % 100:02d}_{b % 100:02d}_pct" for a, b in zip(years, years[1:])]
    return revenue, growth


def yoy_growth(monthly: DataFrame, years: Sequence[int]) -> DataFrame:
    """Years side by side from rows of (year, month, month_name, revenue).

    A month needs revenue in the first year to appear; later years may be missing.
    """
    revenue, growth = yoy_names(years)
    wide = (
        monthly.filter(F.col("year").isin(*years))
        .groupBy("month", "month_name")
        .agg(*[F.sum(F.when(F.col("year") == y, F.col("revenue"))).alias(n) for y, n in zip(years, revenue)])
        .filter(F.col(revenue[0]).isNotNull())
    )
    changes = [
        percent(F.col(after) - F.col(before), F.col(before), 1).alias(name)
        for before, after, name in zip(revenue, revenue[1:], growth)
    ]
    return wide.select("month", "month_name", *revenue, *changes)


def yoy_comparison(orders: DataFrame, dim_date: DataFrame, years: Sequence[int]) -> DataFrame:
    compared = orders.filter(F.col("order_year").isin(*years))  # other years' files are not read
    return yoy_growth(_on_dates(compared, dim_date, "year", "month", "month_name"), years)


# Order of the rows of each mart; a minus sign means falling. The last column breaks ties.
ROW_ORDER = {
    "monthly_revenue": ("year", "month"),
    "revenue_by_region": ("year", "-total_revenue", "region"),
    "revenue_by_segment": ("year", "-total_revenue", "segment"),
    "top_products": ("-total_revenue", "product_id"),
    "category_performance": ("year", "-total_revenue", "category"),
    "campaign_roi": ("-attributed_revenue", "campaign_id"),
    "customer_ltv": ("-total_revenue", "customer_id"),
    "cohort_monthly": ("cohort_month", "activity_month"),
    "channel_performance": ("year", "-total_revenue", "channel"),
    "yoy_comparison": ("month",),
}
MART_NAMES = tuple(ROW_ORDER)


def in_order(df: DataFrame, name: str) -> DataFrame:
    """The rows of a mart in their order; Spark drops the sort again where a report aggregates."""
    columns = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ROW_ORDER[name]]
    return df.orderBy(*columns)


class Marts:
    """The marts of one warehouse by name.

    With a store, a mart is written when first used, so that reports, exports and views share
    one computation; without, it is a plain DataFrame over the warehouse tables. It is written
    unsorted and sorted on the way out, which costs only those who want all rows in order.
    """

    def __init__(self, warehouse: Warehouse, store: Store | None = None):
        self.warehouse, self.store = warehouse, store
        self._ready: dict[str, DataFrame] = {}

    def _define(self, name: str) -> DataFrame:
        w = self.warehouse
        definitions = {
            "monthly_revenue": lambda: monthly_revenue(w.order_sales, w.dim_date),
            "revenue_by_region": lambda: revenue_by_region(w.order_sales, w.dim_date, w.dim_customer),
            "revenue_by_segment": lambda: revenue_by_segment(w.order_sales, w.dim_date, w.dim_customer),
            "top_products": lambda: top_products(w.fact_sales, w.dim_product),
            "category_performance": lambda: category_performance(w.fact_sales, w.dim_product),
            "campaign_roi": lambda: campaign_roi(w.fact_sales, w.dim_campaign),
            "customer_ltv": lambda: customer_ltv(w.order_sales, w.dim_date, w.dim_customer, w.settings.ltv_thresholds),
            "cohort_monthly": lambda: cohort_monthly(w.order_sales, w.dim_date),
            "channel_performance": lambda: channel_performance(w.order_sales, w.dim_date),
            "yoy_comparison": lambda: yoy_comparison(w.order_sales, w.dim_date, w.yoy_years),
        }
        return definitions[name]()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._ready:
            df = self._define(name)
            written = self.store.save(df, f"mart_{name}") if self.store else df
            self._ready[name] = in_order(written, name)
        return self._ready[name]

    def items(self):
        return ((name, self[name]) for name in MART_NAMES)
