"""The test tables seen as raw retail sources.

They are made as untidy as real files on purpose: blanks and mixed case in labels, missing
prices and flags, repeated item ids, dates as text.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from salesloom.config import Settings
from salesloom.functions.numeric import money
from salesloom.operators.clean import campaign_rates

SETTINGS = Settings(
    as_of=date(2001, 12, 31),
    yoy_years=(1998, 1999, 2000),
    ltv_thresholds=(1_000_000, 600_000, 300_000),
)

# Line items repeat their ids; these columns say which copy comes first.
ORDER_BY = {"order_items": ("product_id", "campaign_ref", "gross_amount")}


def _pick(number: Column, *names: str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(number, F.lit(len(names))) + 1).cast("int"))


def _day_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def raw_customers(table) -> DataFrame:
    key = F.col("c_custkey")
    nation = table("nation").join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("customer_id"),
        F.concat(F.lit(" "), F.upper("c_name")).alias("name"),
        F.concat(F.col("c_name"), F.lit("@EXAMPLE.COM ")).alias("email"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("country"),
        F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("segment"),
        F.when(key % 113 == 0, F.lit("1993-02-31")).otherwise(_day_after("1993-01-01", key % 1461).cast("string")).alias("joined_date"),
        F.col("c_acctbal").alias("loyalty_score"),
        F.when(key % 10 != 0, (key % 7 != 0).cast("int")).alias("is_active"),
    )


def raw_products(table) -> DataFrame:
    key, retail = F.col("p_partkey"), money(F.col("p_retailprice"))
    price = F.round(retail * F.col("p_size"), 2).cast("double")
    return table("part").select(
        key.alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.round(retail * F.lit("0.6").cast("decimal(2,1)"), 2).cast("double").alias("unit_cost"),
        F.when(key % 97 == 0, F.lit(0.0)).when(key % 50 != 0, price).alias("unit_price"),
        F.lit(0.0).alias("margin_pct"),
        F.col("p_size").alias("stock_qty"),
        F.when(key % 10 != 0, F.lit(1)).alias("is_active"),
    )


def raw_orders(table) -> DataFrame:
    key = F.col("o_orderkey")
    lines = table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(F.col("l_shipdate").cast("date")).alias("shipped_date"), F.count(F.lit(1)).alias("num_items")
    )
    return table("orders").join(lines, "o_orderkey", "left").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(key % 101 == 0, F.lit("unknown"))
        .when(key % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        "shipped_date",
        F.when(F.col("o_orderstatus") == "F", F.lit(" completed"))
        .when(F.col("o_orderstatus") == "O", F.when(key % 4 == 0, F.lit("cancelled")).otherwise(F.lit("RETURNED ")))
        .when(key % 2 == 0, F.lit("Pending"))
        .otherwise(F.lower("o_orderstatus"))
        .alias("status"),
        F.substring_index("o_orderpriority", "-", -1).alias("channel"),
        _pick(key, "Card", "Cash", "Transfer", "Wallet", "Invoice").alias("payment_method"),
        F.col("o_totalprice").alias("order_total"),
        F.when(key % 9 != 0, F.round(money(F.col("o_totalprice")) * F.lit("0.3").cast("decimal(2,1)"), 2).cast("double"))
        .alias("order_profit"),
        "num_items",
    )


def _item_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def raw_order_items(table) -> DataFrame:
    gross, discount = money(F.col("l_extendedprice")), F.col("l_discount").cast("decimal(4,2)")
    quantity = F.col("l_quantity").cast("int")
    unit = F.round(gross / quantity, 2).cast("decimal(18,2)")
    return table("lineitem").select(
        _item_id().alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        unit.alias("unit_price"),
        (discount * 100).alias("discount_pct"),
        F.round(unit * discount, 2).alias("discount_amt"),
        F.round(gross * (1 - discount), 2).alias("line_total"),
        F.when(F.col("l_linenumber") != 3, F.round(gross * F.col("l_tax").cast("decimal(4,2)"), 2)).alias("line_profit"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("campaign_ref"),
        gross.alias("gross_amount"),
    )


def raw_campaigns(table) -> DataFrame:
    key = F.col("s_suppkey")
    kind = F.col("event_type")
    response = table("events").groupBy(F.get_json_object("props", "$.k").try_cast("bigint").alias("s_suppkey")).agg(
        F.count_if(kind == "view").alias("impressions"),
        F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "purchase").alias("conversions"),
        F.sum(F.when(kind == "purchase", money(F.col("value")))).alias("revenue_generated"),
    )
    start = _day_after("1995-01-01", key % 2000)
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("impressions", "clicks", "conversions")]
    spend = F.greatest(money(F.col("s_acctbal")), F.lit(0)) * F.lit("0.8").cast("decimal(2,1)")
    campaigns = table("supplier").join(response, "s_suppkey", "left").select(
        key.alias("campaign_id"),
        F.col("s_name").alias("name"),
        _pick(key, "Email", "Social Media", "Search Ads", "Display", "Influencer", "Event").alias("type"),
        _pick(key, "Awareness", "Lead Gen", "Conversion", "Retention").alias("goal"),
        start.cast("string").alias("start_date"),
        F.date_add(start, (F.lit(10) + key % 80).cast("int")).cast("string").alias("end_date"),
        F.col("s_acctbal").alias("budget"),
        F.round(spend, 2).cast("decimal(18,2)").alias("spend"),
        *counts,
        F.coalesce("revenue_generated", F.lit(0)).cast("decimal(18,2)").alias("revenue_generated"),
        _pick(key, "Active", "Completed", "Planned").alias("status"),
    )
    return campaign_rates(campaigns)


def first_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines without those that `ORDER_BY` puts behind another of the same id, dropped before any column is derived."""

    def table(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        if name != "lineitem":
            return rows
        first = W.partitionBy(_item_id()).orderBy("l_partkey", "l_suppkey", money(F.col("l_extendedprice")))
        return rows.repartition(_item_id()).withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")

    return raw_order_items(table)


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "campaigns": raw_campaigns,
}


def raw_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return RAW[source](lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {source: raw_source(spark, sf_dir, source) for source in RAW}
