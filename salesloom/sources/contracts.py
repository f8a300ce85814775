"""Raw sources, their files, required columns and staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values.
SOURCE_FILES = {
    "customers": ("customers.csv", "csv"),
    "products": ("products.csv", "csv"),
    "orders": ("orders.csv", "csv"),
    "order_items": ("order_items.csv", "csv"),
    "campaigns": ("campaigns.json", "json"),
}
REQUIRED_COLUMNS = {
    "customers": ["customer_id", "name", "email", "region", "segment", "joined_date"],
    "products": ["product_id", "name", "category", "unit_cost", "unit_price"],
    "orders": ["order_id", "customer_id", "order_date", "status", "order_total"],
    "order_items": ["item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"],
    "campaigns": ["campaign_id", "name", "type", "start_date", "end_date", "spend", "impressions"],
}
STAGING_TABLES = {
    "customers": "stg_customers",
    "products": "stg_products",
    "orders": "stg_orders",
    "order_items": "stg_order_items",
    "campaigns": "stg_campaigns",
}
CONTRACT_SCHEMA = "source string, column string, status string"


def column_contract(spark: SparkSession, sources: dict[str, DataFrame]) -> DataFrame:
    """Required columns present or missing, and additional ones; only column names are looked at."""
    findings = []
    for source, df in sources.items():
        required = REQUIRED_COLUMNS.get(source, [])
        findings += [(source, c, "present" if c in df.columns else "missing") for c in required]
        findings += [(source, c, "additional") for c in df.columns if required and c not in required]
    return spark.createDataFrame(findings, CONTRACT_SCHEMA)
