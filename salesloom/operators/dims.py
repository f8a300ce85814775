"""Calendar, customer, product and campaign dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesloom import config
from salesloom.functions.dates import date_key, fiscal_quarter, fiscal_year, flag, year_month
from salesloom.operators.keys import dense_key
from salesloom.sources.store import Store

# Fixed column lists.
CUSTOMER_COLUMNS = (
    "customer_id", "name", "email", "region", "city", "country", "segment",
    "joined_date", "joined_year", "tenure_days", "loyalty_score", "is_active",
)
PRODUCT_COLUMNS = (
    "product_id", "name", "category", "sub_category", "unit_cost", "unit_price",
    "margin_pct", "price_band", "is_active",
)
CAMPAIGN_COLUMNS = (
    "campaign_id", "name", "type", "goal", "start_date", "end_date",
    "duration_days", "budget", "status",
)


def select_present(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Projection that leaves out columns the table does not have."""
    return df.select(*[c for c in columns if c in df.columns])


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start to end."""
    return day_attributes(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def calendar_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day of every year from the first to the last date in a column."""
    span = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return day_attributes(
        span.select(F.make_date(F.year("low"), F.lit(1), F.lit(1)).alias("start"),
                    F.make_date(F.year("high"), F.lit(12), F.lit(31)).alias("end"))
    )


def day_attributes(span: DataFrame) -> DataFrame:
    """The days between the `start` and `end` of one row, with calendar and fiscal attributes."""
    days = span.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    quarter_start = F.trunc(d, "QUARTER").cast("date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        flag(F.weekday(d) >= 5).alias("is_weekend"),
        flag(d == F.trunc(d, "MM")).alias("is_month_start"),
        flag(d == F.last_day(d)).alias("is_month_end"),
        flag(d == quarter_start).alias("is_quarter_start"),
        flag(d == F.last_day(F.add_months(quarter_start, 2))).alias("is_quarter_end"),
        fiscal_year(d).alias("fiscal_year"),
        fiscal_quarter(d).alias("fiscal_quarter"),
        year_month(d).alias("year_month"),
    )


def customer_dimension(customers: DataFrame, store: Store) -> DataFrame:
    return dense_key(select_present(customers, CUSTOMER_COLUMNS), "customer_id", "customer_key", store, "dim_customer")


def product_dimension(products: DataFrame, store: Store) -> DataFrame:
    kept = select_present(products, PRODUCT_COLUMNS).withColumn(
        "price_band", F.coalesce("price_band", F.lit(config.UNKNOWN))
    )
    return dense_key(kept, "product_id", "product_key", store, "dim_product")


def campaign_dimension(campaigns: DataFrame, store: Store) -> DataFrame:
    return dense_key(select_present(campaigns, CAMPAIGN_COLUMNS), "campaign_id", "campaign_key", store, "dim_campaign")
