"""The order-line fact, its rejects and its summaries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesloom import config
from salesloom.functions.dates import flag
from salesloom.functions.numeric import MONEY, percent

# Fixed column list.
FACT_COLUMNS = (
    "date_key", "customer_key", "product_key", "campaign_key", "order_id", "item_id",
    "channel", "payment_method", "order_status", "quantity", "unit_price", "unit_cost",
    "discount_pct", "discount_amt", "line_revenue", "line_cost", "line_profit",
    "line_margin_pct", "is_revenue",
)
# Every mart reads revenue lines only, and the year is the usual filter.
FACT_PARTITIONS = ("is_revenue", "order_year")

#: A line's own campaign id, in sources that have it.
CAMPAIGN_REFERENCE = "campaign_ref"

LINE_FIELDS = (
    "order_id", "item_id", "product_id", "quantity", "unit_price", "discount_pct", "discount_amt", "line_total",
)
LINE_AMOUNTS = ("unit_cost", "unit_price", "discount_pct", "discount_amt", "line_total")
ORDER_FIELDS = ("order_id", "customer_id", "order_date", "status", "channel", "payment_method", "is_revenue")


def with_named_campaign(lines: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    """The campaign that a line names, whatever becomes of its order; none if the source names none or an unknown one."""
    if CAMPAIGN_REFERENCE not in lines.columns:
        return lines.withColumn("campaign_key", F.lit(None).cast("bigint"))
    campaigns = dim_campaign.select(F.col("campaign_id").alias("_named"), "campaign_key")
    return lines.withColumnRenamed(CAMPAIGN_REFERENCE, "_named").join(campaigns, "_named", "left").drop("_named")


def _keyed_orders(orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, how: str) -> DataFrame:
    """Resolve customer and date once per order, before the lines multiply the rows."""
    dates = dim_date.select(F.col("full_date").alias("order_date"), "date_key")
    return (
        orders.select(*ORDER_FIELDS)
        .join(dim_customer.select("customer_id", "customer_key"), "customer_id", how)
        .join(dates, "order_date", how)
    )


def _money(col: Column) -> Column:
    """Rounded here for the first time; NULL if it is no money."""
    return F.round(col, 2).try_cast(MONEY)


def usable() -> Column:
    """Whether all numbers of a line, and what is computed from them, are money: nothing in it was set aside when it was staged."""
    cost = F.coalesce(F.col("unit_cost"), F.lit(0))
    total = _money(F.try_multiply(cost, F.col("quantity")))
    needed = [*[_money(F.col(c)) for c in ("unit_price", "discount_pct", "discount_amt", "line_total")], _money(cost), total]
    profit = (_money(F.col("line_total")) - total).try_cast(MONEY)
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in (*needed, profit)])


def with_money(lines: DataFrame) -> DataFrame:
    """The amounts of usable lines as money, zero where one is missing; eight bytes each, however they were staged."""
    zero = F.lit(0).cast(MONEY)
    return lines.withColumns({c: F.coalesce(_money(F.col(c)), zero) for c in LINE_AMOUNTS})


def with_measures(lines: DataFrame) -> DataFrame:
    """Cost, profit and margin of lines whose amounts are money; lines without revenue count as zero."""
    zero = F.lit(0).cast(MONEY)
    revenue, profit = F.col("line_revenue"), F.col("line_profit")
    sold = F.coalesce(F.col("is_revenue"), F.lit(0)) == 1
    margin = F.when(revenue > 0, percent(profit, revenue, 1)).otherwise(F.lit(0))
    return (
        lines.withColumns({"is_revenue": flag(sold), "line_revenue": F.when(sold, F.col("line_total")).otherwise(zero)})
        .withColumn(
            "line_cost",
            F.when(sold, F.round(F.col("unit_cost") * F.col("quantity"), 2).cast(MONEY)).otherwise(zero),
        )
        .withColumn("line_profit", (revenue - F.col("line_cost")).cast(MONEY))
        .withColumn("line_margin_pct", margin.cast("decimal(18,1)"))
    )


def in_money(items: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Some columns of the lines, amounts as money and NULL where one is none, so that eight bytes of each are moved."""
    return items.select(*[_money(F.col(c)).alias(c) if c in LINE_AMOUNTS else F.col(c) for c in columns])


def build_fact(
    items: DataFrame,
    orders: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_campaign: DataFrame,
) -> DataFrame:
    """One row per usable order line whose order, date, customer and product all resolve.

    Shuffles at line grain: by order, and by product and by campaign unless those dimensions are
    small enough for Spark to broadcast them. The order comes last: until then a line carries none of its
    columns, and then the lines of an order lie together, as the order summary wants them.
    """
    needed = [c for c in (*LINE_FIELDS, CAMPAIGN_REFERENCE) if c in items.columns]
    products = dim_product.select("product_id", "product_key", "unit_cost")
    usable_lines = in_money(items, needed).join(products, "product_id").filter(usable()).drop("product_id")
    lines = with_named_campaign(with_money(usable_lines), dim_campaign).join(
        _keyed_orders(orders, dim_customer, dim_date, "inner"), "order_id"
    )
    # Only a completed line belongs to the campaign it names.
    attributed = F.when(F.col("status") == config.REVENUE_STATUS, F.col("campaign_key"))
    return with_measures(lines.withColumn("campaign_key", attributed)).select(
        *[F.col("status").alias(c) if c == "order_status" else F.col(c) for c in FACT_COLUMNS],
        F.year("order_date").alias("order_year"),
    )


def lines_of_day(fact: DataFrame, dim_date: DataFrame, day: date) -> DataFrame:
    """The fact lines of one calendar day, with the day's attributes.

    The calendar's row for the day is known only when the query runs; its year then prunes the fact's partitions
    before they are read.
    """
    that_day = dim_date.filter(F.col("full_date") == F.lit(day)).select("date_key", F.col("year").alias("order_year"), "day_name", "is_weekend")
    columns = ("date_key", "day_name", "is_weekend", "order_id", "item_id", "product_key", "customer_key", "is_revenue", "line_revenue", "line_profit")
    return fact.join(that_day, ["date_key", "order_year"]).select(*columns)


def fact_rejects(
    items: DataFrame, orders: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """The lines `build_fact` leaves out, with what they lack.

    The product comes first: lines meet their order with two flags and no numbers.
    """
    keyed = _keyed_orders(orders, dim_customer, dim_date, "left").select(
        "order_id",
        F.lit(True).alias("order_found"),
        F.col("date_key").isNull().alias("no_date"),
        F.col("customer_key").isNull().alias("no_customer"),
    )
    products = dim_product.select("product_id", "product_key", "unit_cost")
    # Of these amounts it only matters whether they are money; equal values take no room in a shuffle.
    known = {c: F.when(F.col(c).isNotNull(), F.lit(0).cast(MONEY)) for c in ("unit_price", "discount_pct", "discount_amt")}
    judged = in_money(items, LINE_FIELDS).withColumns(known).join(products, "product_id", "left").select(
        "item_id",
        "order_id",
        "product_id",
        flag(F.col("product_key").isNull()).alias("missing_product"),
        flag(~usable()).alias("unusable_value"),
    )
    found = F.col("order_found").isNotNull()
    return (
        judged.join(keyed, "order_id", "left")
        .select(
            "item_id",
            "order_id",
            "product_id",
            flag(~found).alias("missing_order"),
            flag(found & F.col("no_date")).alias("missing_date"),
            flag(found & F.col("no_customer")).alias("missing_customer"),
            "missing_product",
            "unusable_value",
        )
        .filter("missing_order + missing_date + missing_customer + missing_product + unusable_value > 0")
    )


REJECT_REASONS = ("missing_order", "missing_date", "missing_customer", "missing_product", "unusable_value")


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Rejected lines per reason, zero included; a line may have several."""
    counts = rejects.agg(*[F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in REJECT_REASONS])
    return counts.unpivot([], list(REJECT_REASONS), "reason", "rows")


def fact_summary(fact: DataFrame) -> DataFrame:
    """Row counts, totals and the revenue-weighted margin."""
    sold = F.col("is_revenue") == 1
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(sold).alias("revenue_rows"),
        F.coalesce(F.sum(F.when(sold, F.col("line_revenue"))), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.sum(F.when(sold, F.col("line_profit"))), F.lit(0)).alias("total_profit"),
    ).withColumn("weighted_margin_pct", percent(F.col("total_profit"), F.col("total_revenue"), 1))


ORDER_PARTITIONS = ("order_year",)


def rebalanced(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows of one table partition in few tasks, so that few files are written for it; adaptive
    execution splits a partition that is too large for one."""
    return df.hint("rebalance", *columns)


def order_sales(fact: DataFrame) -> DataFrame:
    """Revenue lines summed to one row per order.

    An order has one customer, one date and one channel, so distinct orders become a row count
    and every mart at order grain reads this table instead of the lines.
    """
    return (
        fact.filter("is_revenue = 1")
        .groupBy("order_id", "customer_key", "date_key", "channel", "order_year")
        .agg(
            F.count(F.lit(1)).alias("line_items"),
            F.sum("quantity").alias("units"),
            F.sum("line_revenue").cast(MONEY).alias("revenue"),
            F.sum("line_profit").cast(MONEY).alias("profit"),
            F.sum("line_margin_pct").cast("decimal(18,1)").alias("margin_sum"),
        )
    )
