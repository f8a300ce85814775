"""Every query by name, over the test tables of one scale factor.

All queries of a session share one warehouse: its tables are written below the session's shared
folder when a query first needs them and read from then on.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom import config
from salesloom.functions.numeric import publish
from salesloom.operators import clean, fact, quality, rejects
from salesloom.operators.dedup import removed_duplicates
from salesloom.operators.quantile import exact_quantiles
from salesloom.plans import charts, pipeline, reports
from salesloom.plans.marts import MART_NAMES, Marts
from salesloom.plans.warehouse import Warehouse
from salesloom.session import fresh_folder
from salesloom.sources import contracts, files, sinks, testbed
from salesloom.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]

# Columns that readers of a mart rely on.
MART_COLUMNS = {
    "monthly_revenue": ("year", "month", "total_revenue", "total_orders"),
    "top_products": ("product_name", "total_revenue", "total_units_sold"),
    "customer_ltv": ("customer_id", "ltv_tier", "total_revenue"),
}

# Of each exported mart the columns that name a row, and a measure.
EXPORTED = {
    "monthly_revenue": ("year_month", "total_revenue"),
    "revenue_by_region": ("region", "year", "total_revenue"),
    "revenue_by_segment": ("segment", "year", "total_revenue"),
    "top_products": ("product_id", "total_revenue"),
    "category_performance": ("category", "year", "total_revenue"),
    "campaign_roi": ("campaign_id", "attributed_revenue"),
    "customer_ltv": ("customer_id", "total_revenue"),
    "cohort_monthly": ("cohort_month", "activity_month", "cohort_revenue"),
    "channel_performance": ("channel", "year", "total_revenue"),
    "yoy_comparison": ("month", "month_name", "revenue_1999"),
}

_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}
_MARTS: dict[tuple[str, str], Marts] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = new_warehouse(spark, sf_dir)
    return _WAREHOUSES[key]


def new_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(
        spark,
        Store(spark, fresh_folder(spark, "warehouse")),
        testbed.SETTINGS,
        lambda source: testbed.raw_source(spark, sf_dir, source),
        testbed.ORDER_BY,
    )


def written_marts(spark: SparkSession, sf_dir: str) -> Marts:
    """The session's marts as tables: reports, charts and checks share one computation of each."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MARTS:
        shared = warehouse(spark, sf_dir)
        _MARTS[key] = Marts(shared, shared.store)
    return _MARTS[key]


def result(df: DataFrame) -> DataFrame:
    """What a query hands out: plain doubles, and dates as yyyy-MM-dd text."""
    return sinks.dates_as_text(publish(df))


def _mart(name: str) -> Query:
    """The mart itself, computed from fact and order summary each time."""
    return lambda spark, sf_dir: result(Marts(warehouse(spark, sf_dir))[name])


def _on_marts(build: Callable[[Marts], DataFrame]) -> Query:
    return lambda spark, sf_dir: result(build(written_marts(spark, sf_dir)))


def _on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: result(build(warehouse(spark, sf_dir)))


def _on_raw(source: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: result(build(testbed.raw_source(spark, sf_dir, source)))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


MARTS: dict[str, Query] = {name: _mart(name) for name in MART_NAMES}

REPORTS: dict[str, Query] = {
    "report_topline": _on_warehouse(lambda w: reports.report_topline(w.order_sales)),
    "report_by_year": _on_marts(lambda m: reports.report_by_year(m["monthly_revenue"])),
    "report_by_region": _on_marts(lambda m: reports.report_by_region(m["revenue_by_region"])),
    "report_by_segment": _on_marts(lambda m: reports.report_by_segment(m["revenue_by_segment"])),
    "report_top5_products": _on_marts(lambda m: reports.report_top_products(m["top_products"])),
    "report_by_category": _on_marts(lambda m: reports.report_by_category(m["category_performance"])),
    "report_top5_campaigns": _on_marts(lambda m: reports.report_top_campaigns(m["campaign_roi"])),
    "report_ltv_tiers": _on_marts(lambda m: reports.report_ltv_tiers(m["customer_ltv"])),
    "report_by_channel": _on_marts(lambda m: reports.report_by_channel(m["channel_performance"])),
    "kpi_cards": _on_marts(lambda m: reports.kpi_cards(m.warehouse.order_sales, m["monthly_revenue"])),
    "monthly_trend": _on_marts(lambda m: reports.monthly_trend(m["monthly_revenue"])),
    "yoy_table": _on_marts(lambda m: reports.yoy_table(m["yoy_comparison"], m.warehouse.yoy_years)),
    "region_rollup": _on_marts(lambda m: reports.region_rollup(m["revenue_by_region"])),
    "segment_rollup": _on_marts(lambda m: reports.segment_rollup(m["revenue_by_segment"])),
    "channel_rollup": _on_marts(lambda m: reports.channel_rollup(m["channel_performance"])),
    "top15_products": _on_marts(lambda m: reports.best_products(m["top_products"])),
    "category_rollup": _on_marts(lambda m: reports.category_rollup(m["category_performance"])),
    "campaign_list": _on_marts(lambda m: reports.campaign_list(m["campaign_roi"])),
    "ltv_tier_stats": _on_marts(lambda m: reports.ltv_tier_stats(m["customer_ltv"])),
    "top10_customers": _on_marts(lambda m: reports.best_customers(m["customer_ltv"])),
    "top10_customers_ascending": _on_marts(
        lambda m: reports.ascending_by_revenue(reports.best_customers(m["customer_ltv"]))
    ),
    "cohort_list": _on_marts(lambda m: reports.cohort_list(m["cohort_monthly"])),
}


def _money_labels(m: Marts) -> DataFrame:
    cards = reports.kpi_cards(m.warehouse.order_sales, m["monthly_revenue"])
    figures = charts.long_series(
        cards.withColumn("card", F.lit("kpi")), "card", ["total_revenue", "total_profit", "avg_order_value"]
    )
    return charts.money_labels(figures, "metric", "value").unionByName(
        charts.money_labels(
            reports.region_rollup(m["revenue_by_region"]).withColumn("revenue", F.col("revenue").cast("decimal(38,2)")),
            "region",
            "revenue",
        )
    )


def _long_series(m: Marts) -> DataFrame:
    def series(df: DataFrame, entity: str, *measures: str) -> DataFrame:
        return charts.long_series(df, entity, measures).withColumn("dimension", F.lit(entity))

    return _union(
        [
            series(reports.category_rollup(m["category_performance"]), "category", "cost", "profit"),
            series(reports.region_rollup(m["revenue_by_region"]), "region", "revenue", "profit"),
            series(reports.channel_rollup(m["channel_performance"]), "channel", "revenue", "profit"),
        ]
    )


CHARTS: dict[str, Query] = {
    "cohort_matrix": _on_marts(lambda m: charts.cohort_matrix(reports.cohort_list(m["cohort_monthly"]))),
    "roi_by_type": _on_marts(lambda m: charts.roi_by_type(m["campaign_roi"])),
    "revenue_share": _on_marts(
        lambda m: charts.revenue_shares(
            reports.category_rollup(m["category_performance"]),
            reports.ltv_tier_stats(m["customer_ltv"]),
            reports.segment_rollup(m["revenue_by_segment"]),
            reports.channel_rollup(m["channel_performance"]),
        )
    ),
    "compact_money": _on_marts(_money_labels),
    "product_bubbles": _on_marts(lambda m: charts.product_bubbles(reports.best_products(m["top_products"]))),
    "campaigns_by_type": _on_marts(lambda m: charts.campaigns_by_type(reports.campaign_list(m["campaign_roi"]))),
    "cost_profit_long": _on_marts(_long_series),
}


def _line_economics(w: Warehouse) -> DataFrame:
    costs = w.staged("products").select("product_id", "unit_cost")
    lines = w.staged("order_items").join(costs, "product_id")
    return clean.line_economics(lines).select("item_id", "discount_amt", "line_total", "line_profit")


def _order_total_quantiles(w: Warehouse) -> DataFrame:
    orders = w.staged("orders")
    levels = exact_quantiles(orders, "order_total", (0.05, 0.5, 0.95))
    return levels.select("level", F.round("quantile", 4).alias("order_total"))


CLEANING: dict[str, Query] = {
    "clean_customers": _on_raw("customers", lambda raw: clean.clean_customers(raw, testbed.SETTINGS.as_of)),
    "clean_products": _on_raw("products", clean.clean_products),
    "clean_orders": _on_raw("orders", clean.clean_orders),
    "clean_order_items": _on_raw(
        "order_items", lambda raw: clean.clean_order_items(raw, testbed.ORDER_BY["order_items"])
    ),
    "clean_campaigns": _on_raw("campaigns", clean.clean_campaigns),
    "dedup_items": _on_raw("order_items", lambda raw: removed_duplicates(raw, "item_id")),
    "price_bands": _on_warehouse(lambda w: quality.value_counts(w.dim_product, "price_band")),
    "high_value_orders": _on_warehouse(
        lambda w: w.staged("orders")
        .filter("is_high_value = 1")
        .select("order_id", "customer_id", "order_date", "order_total")
    ),
    "line_economics": _on_warehouse(_line_economics),
    "order_rollup": _on_warehouse(lambda w: clean.order_rollup(w.staged("order_items"), w.staged("orders"))),
    "order_total_quantiles": _on_warehouse(_order_total_quantiles),
    "orders_summary": _on_warehouse(lambda w: clean.orders_summary(w.staged("orders"))),
}


WAREHOUSE: dict[str, Query] = {
    "dim_date": _on_warehouse(lambda w: w.dim_date),
    "dim_customer": _on_warehouse(lambda w: w.dim_customer),
    "dim_product": _on_warehouse(lambda w: w.dim_product),
    "dim_campaign": _on_warehouse(lambda w: w.dim_campaign),
    "fact_sales": _on_warehouse(lambda w: w.fact_sales.select(*fact.FACT_COLUMNS)),
    "order_sales": _on_warehouse(lambda w: w.order_sales.drop("order_year")),
    "fact_rejects": _on_warehouse(lambda w: w.fact_rejects),
    "reject_summary": _on_warehouse(lambda w: fact.reject_summary(w.fact_rejects)),
    "fact_summary": _on_warehouse(lambda w: fact.fact_summary(w.fact_sales)),
    "lines_of_day": _on_warehouse(lambda w: fact.lines_of_day(w.fact_sales, w.dim_date, date(1997, 6, 16))),
    "warehouse_counts": _on_warehouse(lambda w: pipeline.warehouse_summary(w.tables())),
    "campaign_attribution": _on_warehouse(
        lambda w: w.fact_sales.filter("campaign_key IS NOT NULL").select("item_id", "campaign_key")
    ),
}


def _references(w: Warehouse) -> list[quality.Reference]:
    customers, products = w.staged("customers"), w.staged("products")
    orders, items, sales = w.staged("orders"), w.staged("order_items"), w.fact_sales
    return [
        quality.Reference("orders -> customers", orders, customers, "customer_id"),
        quality.Reference("order_items -> orders", items, orders, "order_id"),
        quality.Reference("order_items -> products", items, products, "product_id"),
        quality.Reference("fact -> dim_date", sales, w.dim_date, "date_key"),
        quality.Reference("fact -> dim_customer", sales, w.dim_customer, "customer_key"),
        quality.Reference("fact -> dim_product", sales, w.dim_product, "product_key"),
        # Lines of orders that bring no revenue: orphans that do exist.
        quality.Reference("order_items -> revenue orders", items, orders.filter("is_revenue = 1"), "order_id"),
    ]


def _accepted_values(m: Marts) -> DataFrame:
    orders, customers = m.warehouse.staged("orders"), m.warehouse.dim_customer
    return _union(
        [
            quality.unexpected_values(orders, "status", config.ORDER_STATUSES),
            quality.unexpected_values(customers, "segment", config.SEGMENTS),
            quality.unexpected_values(customers, "region", config.REGIONS),
            quality.unexpected_values(orders, "channel", config.CHANNELS),
            quality.unexpected_values(m["customer_ltv"], "ltv_tier", config.LTV_TIER_NAMES),
        ]
    )


def _range_rules(m: Marts) -> DataFrame:
    sold = F.col("is_revenue") == 1
    return _union(
        [
            quality.broken_rules(
                m.warehouse.dim_product,
                "dim_product",
                {
                    "price_positive": F.col("unit_price") > 0,
                    "price_above_cost": F.col("unit_price") > F.col("unit_cost"),
                },
            ),
            quality.broken_rules(
                m.warehouse.fact_sales,
                "fact_sales",
                {
                    "revenue_line_positive": ~sold | (F.col("line_revenue") > 0),
                    "other_line_zero": sold | (F.col("line_revenue") == 0),
                    "profit_not_negative": F.col("line_profit") >= 0,
                },
            ),
            quality.broken_rules(
                m["monthly_revenue"], "monthly_revenue", {"revenue_not_negative": F.col("total_revenue") >= 0}
            ),
        ]
    )


def _profit_identity(w: Warehouse) -> DataFrame:
    lines = w.fact_sales.filter("is_revenue = 1")
    broken = quality.identity_breaks(lines, F.col("line_profit"), F.col("line_revenue") - F.col("line_cost"))
    count = F.count(F.lit(1))
    return lines.agg(count.alias("checked")).select("checked", broken.agg(count).scalar().alias("breaks"))


def _missing_keys(w: Warehouse) -> DataFrame:
    keys = ["date_key", "customer_key", "product_key", "campaign_key"]
    return quality.missing_values(w.fact_sales, "fact_sales", keys).unionByName(
        quality.missing_values(w.dim_customer, "dim_customer", ["customer_id"])
    )


def _expected_rows(m: Marts) -> DataFrame:
    """What each table must have follows from others: from the calendar, the staged orders and the fact."""
    w = m.warehouse
    sold = w.fact_sales.filter("is_revenue = 1")
    dated = w.staged("orders").filter("is_revenue = 1 AND order_date IS NOT NULL").select("order_id", "order_date", "channel")
    orders = dated.join(w.staged("order_items").select("order_id"), "order_id", "left_semi")
    distinct = lambda df, *columns: df.agg(F.count_distinct(*columns))
    days = w.dim_date.agg(F.datediff(F.max("full_date"), F.min("full_date")) + 1)
    month = F.date_format("order_date", "yyyy-MM")
    year = F.year("order_date")
    first_year = w.yoy_years[0]
    return quality.expected_rows(
        {
            "calendar days": (w.dim_date, days),
            "months with revenue": (m["monthly_revenue"], distinct(orders, month)),
            "months compared": (m["yoy_comparison"], distinct(orders.filter(year == first_year), month)),
            "channels": (reports.channel_rollup(m["channel_performance"]), distinct(orders, F.col("channel"))),
            "channels by year": (m["channel_performance"], distinct(orders, F.col("channel"), year)),
            "products sold": (m["top_products"], distinct(sold, F.col("product_key"))),
            "customers who bought": (m["customer_ltv"], distinct(sold, F.col("customer_key"))),
            "campaigns": (m["campaign_roi"], distinct(sold, F.col("campaign_key"))),
            "orders sold": (w.order_sales, distinct(sold, F.col("order_id"))),
        }
    )


def _date_parse_report(raw: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            quality.date_parse_report(raw["orders"], "orders", ["order_date", "shipped_date"]),
            quality.date_parse_report(raw["customers"], "customers", ["joined_date"]),
            quality.date_parse_report(raw["campaigns"], "campaigns", ["start_date", "end_date"]),
        ]
    )


def _sorted_products(m: Marts) -> DataFrame:
    """Rises from one product to the next: none of the revenue that the mart is sorted by, and many of the units that it is not."""
    products = m["top_products"]
    rows = products.agg(F.count(F.lit(1))).scalar()
    ordered = {"total_revenue": products, "total_units_sold": products.orderBy(F.desc("total_revenue"), "product_id")}
    return _union(
        [
            quality.order_inversions(df, measure).select(F.lit(measure).alias("measure"), "inversions", rows.alias("rows"))
            for measure, df in ordered.items()
        ]
    )


QUALITY: dict[str, Query] = {
    "null_report": _on_warehouse(lambda w: _union([quality.null_report(df, n) for n, df in w.staging().items()])),
    "quality_report": _on_warehouse(lambda w: quality.quality_report(w.staging(), w.settings.max_null_percent)),
    "date_parse_report": lambda spark, sf_dir: _date_parse_report(testbed.raw_sources(spark, sf_dir)),
    "orphan_checks": _on_warehouse(lambda w: quality.orphan_checks(_references(w))),
    "duplicate_keys": _on_raw("order_items", lambda raw: quality.duplicate_keys(raw, ["item_id"])),
    "missing_keys": _on_warehouse(_missing_keys),
    "accepted_values": _on_marts(_accepted_values),
    "range_rules": _on_marts(_range_rules),
    "profit_identity": _on_warehouse(_profit_identity),
    "expected_rows": _on_marts(_expected_rows),
    "sorted_products": lambda spark, sf_dir: _sorted_products(Marts(warehouse(spark, sf_dir))),
    "order_date_range": _on_warehouse(lambda w: quality.key_range(w.staged("orders"), "order_date")),
    "headline_sanity": _on_marts(
        lambda m: quality.headline_sanity(reports.kpi_cards(m.warehouse.order_sales, m["monthly_revenue"]))
    ),
    "more_items_than_orders": _on_warehouse(
        lambda w: quality.more_rows_than(w.staged("order_items"), w.staged("orders"))
    ),
    "orders_without_items": _on_warehouse(
        lambda w: quality.ids_without_match(w.staged("orders"), w.staged("order_items"), "order_id")
    ),
    "status_counts": _on_warehouse(lambda w: quality.value_counts(w.staged("orders"), "status")),
    "distinct_segments": _on_warehouse(lambda w: w.dim_customer.select("segment").distinct()),
}


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers written as CSV, read back as text and cleaned."""
    folder = fresh_folder(spark, "csv")
    sinks.write_csv(testbed.raw_source(spark, sf_dir, "customers"), folder)
    return result(clean.clean_customers(files.read_csv(spark, folder), testbed.SETTINGS.as_of))


def write_documents(records: DataFrame, folder: str, records_per_file: int = 500, broken: Column | None = None) -> None:
    """Rows with a JSON text `record` as documents, arrays of at most `records_per_file` records, one to a file.

    Files are counted in hundreds of records, so that writing, listing and reading them grows with the data and not with a file's cost.
    The records for which `broken` holds come in documents of their own, which end in the middle.
    """
    place = F.floor(F.monotonically_increasing_id() / records_per_file)
    apart = F.lit(False) if broken is None else F.coalesce(broken, F.lit(False))
    chunks = records.select("record", place.alias("_chunk"), apart.alias("_broken")).groupBy("_broken", "_chunk").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("document")
    )
    documents = chunks.select(F.when(F.col("_broken"), F.lit('[{"name": ')).otherwise(F.col("document")).alias("value"))
    documents.write.option("maxRecordsPerFile", 1).text(folder)


def json_records_roundtrip(spark: SparkSession, sf_dir: str, records_per_file: int = 500) -> DataFrame:
    """Raw campaigns written as files of wrapped records, read back and cleaned.

    A wrapped document holds a fixed number of records at most, so no group grows with the data.
    """
    folder = fresh_folder(spark, "json")
    raw = publish(testbed.raw_source(spark, sf_dir, "campaigns"))
    place = F.monotonically_increasing_id()
    chunks = raw.withColumn("_chunk", F.floor(place / records_per_file)).groupBy("_chunk").agg(
        F.to_json(F.struct(F.collect_list(F.struct(*raw.columns)).alias("records"))).alias("value")
    )
    chunks.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return result(_campaigns_of(files.read_json(spark, folder)))


def _campaigns_of(read: DataFrame) -> DataFrame:
    return clean.clean_campaigns(read.withColumn("campaign_id", F.col("campaign_id").cast("bigint")))


def json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw campaigns in a folder of arrays and of wrapped records, read back and cleaned."""
    folder = fresh_folder(spark, "json")
    raw = publish(testbed.raw_source(spark, sf_dir, "campaigns"))
    place = F.monotonically_increasing_id()
    chunks = raw.withColumn("_chunk", F.floor(place / 50)).groupBy("_chunk").agg(
        F.to_json(F.collect_list(F.struct(*raw.columns))).alias("records")
    )
    wrapped = F.when(F.col("_chunk") % 2 == 1, F.concat(F.lit('{"records": '), "records", F.lit("}")))
    documents = chunks.select(F.coalesce(wrapped, "records").alias("value"))
    documents.write.option("maxRecordsPerFile", 1).text(folder)
    return result(_campaigns_of(files.read_json(spark, folder)))


def campaigns_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts written as 12.0, amounts of three decimals and of twenty digits, all of them text."""
    raw = testbed.raw_source(spark, sf_dir, "campaigns")
    long = F.when(F.col("campaign_id") % 7 == 0, F.lit("12345678901234567890.5"))
    text = raw.withColumns(
        {
            **{c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("impressions", "clicks", "conversions")},
            "spend": F.concat(F.col("spend").cast("string"), F.lit("4")),
            "budget": F.coalesce(long, F.when(F.col("campaign_id") % 11 != 0, F.lit("7.125")), F.lit("none")),
        }
    )
    columns = ["campaign_id", "impressions", "clicks", "conversions", "spend", "budget", "cost_per_click"]
    return result(clean.clean_campaigns(text).select(*columns))


def _items_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as text; of every eleven orders five have one value that its column cannot hold, and one a quantity beyond 32 bits."""
    part = F.col("order_id") % 11
    planted = lambda name, values: reduce(lambda c, v: c.when(part == v[0], F.lit(v[1])), values[1:], F.when(part == values[0][0], F.lit(values[0][1]))).otherwise(F.col(name).cast("string"))
    return testbed.raw_source(spark, sf_dir, "order_items").withColumns(
        {
            "quantity": planted("quantity", [(3, "3000000000"), (4, "123456789012345678901"), (5, "two")]),
            "line_total": planted("line_total", [(6, "Infinity"), (7, "x1")]),
            "line_profit": planted("line_profit", [(8, "123456789012345678901234567890")]),
        }
    )


def items_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with overflows, infinities and unreadable text: what is unreadable has its default, what does not fit is NULL."""
    cleaned = clean.clean_order_items(_items_as_text(spark, sf_dir), testbed.ORDER_BY["order_items"])
    return result(cleaned.select("item_id", "quantity", "line_total", "line_profit"))


def value_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all values that cleaning could not keep, of every source."""
    raw = testbed.raw_sources(spark, sf_dir) | {"order_items": _items_as_text(spark, sf_dir)}
    return rejects.all_value_rejects(raw)


def extract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources in a folder: one good, one with a broken document after a good one, three that are not there."""
    folder = fresh_folder(spark, "raw")
    sinks.write_csv(testbed.raw_source(spark, sf_dir, "customers").drop("email"), f"{folder}/customers.csv")
    campaigns = publish(testbed.raw_source(spark, sf_dir, "campaigns"))
    records = campaigns.select(F.to_json(F.struct(*campaigns.columns)).alias("record"), "campaign_id")
    write_documents(records, f"{folder}/campaigns.json", broken=F.col("campaign_id") == 2)
    found, report = files.extract_all(spark, folder, Store(spark, fresh_folder(spark, "landed")))
    rows = sinks.row_counts(found).withColumnRenamed("table", "source")
    missing = F.when(F.col("status") == "read", F.col("detail")).otherwise("").alias("missing")
    return report.join(rows, "source", "left").select("source", "status", missing, "rows")


def json_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of a JSON source that lacks one column and has another: both come from the data."""
    folder = fresh_folder(spark, "json")
    raw = publish(testbed.raw_source(spark, sf_dir, "campaigns")).withColumnRenamed("spend", "extra_col")
    record = F.to_json(F.struct("campaign_id", "name", "type", "start_date", "end_date", "impressions", "extra_col"))
    write_documents(raw.select(record.alias("record")), folder)
    return contracts.column_contract(spark, {"campaigns": files.read_json(spark, folder)})


def pipeline_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job on raw files written from the tables: revenue by region and year, rejects."""
    folder, out = fresh_folder(spark, "raw"), fresh_folder(spark, "run")
    for source in contracts.STAGING_TABLES:
        raw = testbed.raw_source(spark, sf_dir, source)
        if source == "campaigns":
            record = F.to_json(F.struct(*publish(raw).columns))
            write_documents(publish(raw).select(record.alias("record")), f"{folder}/campaigns.json")
        else:
            if source == "order_items":
                # Of lines with one id the binding's first is written, as it is staged: text columns would sort otherwise.
                raw = clean.with_clean_values(testbed.first_order_items(spark, sf_dir))
            sinks.write_csv(raw, f"{folder}/{source}.csv", compression="gzip")
    run = pipeline.run_pipeline(spark, folder, out, testbed.SETTINGS, csv_copies=False)
    shape = lambda name, label, value: run.reports[name].select(
        F.lit(name).alias("report"), F.col(label).cast("string").alias("label"), F.col(value).cast("double").alias("value")
    )
    parts = [
        shape("report_by_region", "region", "revenue"), shape("report_by_year", "year", "revenue"),
        shape("report_ltv_tiers", "ltv_tier", "customers"), shape("rejects", "reason", "rows"),
        shape("staging_counts", "table", "rows"), shape("warehouse", "table", "rows"),
    ]
    return _union(parts)


def tables_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of the marts and the columns that readers of the marts rely on."""
    marts = written_marts(spark, sf_dir)
    names = pipeline.register_views(marts)
    found = quality.tables_present(spark, [*names, "vw_unknown"])
    lacking = [(f"vw_{name}", len(quality.missing_columns(df, MART_COLUMNS.get(name, ())))) for name, df in marts.items()]
    lacks = spark.createDataFrame(lacking, "name string, missing_columns bigint")
    return found.join(lacks, "name", "left")


def staging_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads all five staging tables into a new folder and counts them there."""
    shared = warehouse(spark, sf_dir)
    cleaned = {source: shared.staged(source) for source in contracts.STAGING_TABLES}
    return sinks.load_all(cleaned, Store(spark, fresh_folder(spark, "staging")))[1]


def mart_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports the ten marts as CSV and takes from the files their rows, a digest of their keys, and the sum of a measure."""
    folder = fresh_folder(spark, "export")
    paths = pipeline.export_marts(written_marts(spark, sf_dir), folder)
    found = []
    for name, path in paths.items():
        *keys, measure = EXPORTED[name]
        hashed = F.conv(F.substring(F.md5(F.concat_ws("|", *keys).cast("binary")), 1, 8), 16, 10).cast("bigint")
        found.append(
            spark.read.option("header", True).csv(path).agg(
                F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows"), F.sum(hashed).alias("keys_digest"),
                F.sum(F.col(measure).cast("double").cast("decimal(28,2)")).cast("double").alias("measure_sum"),
            )
        )
    return _union(found)


def column_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testbed.raw_sources(spark, sf_dir)
    rows = sinks.row_counts(raw).withColumnRenamed("table", "source")
    return contracts.column_contract(spark, raw).join(rows, "source")


def mart_views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the named mart views."""
    pipeline.register_views(written_marts(spark, sf_dir))
    return spark.sql(
        """
        SELECT r.year, COUNT(*) AS regions, CAST(SUM(CAST(r.total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue, MAX(m.months) AS months
        FROM vw_revenue_by_region r
        JOIN (SELECT year, COUNT(*) AS months FROM vw_monthly_revenue GROUP BY year) m ON r.year = m.year
        GROUP BY r.year
        """
    )


def scan_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "part", "orders", "lineitem", "supplier", "events")
    profiles = [files.scan_profile(spark.read.parquet(f"{sf_dir}/{n}.parquet"), n) for n in names]
    return _union(profiles).withColumn("has_bytes", F.col("bytes") > 0).drop("bytes")


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as JSON records, parsed again."""
    mart = written_marts(spark, sf_dir)["channel_performance"]
    records = sinks.json_records(mart)
    return records.select(F.from_json("record", result(mart).schema).alias("r")).select("r.*")


READING_WRITING: dict[str, Query] = {
    "csv_roundtrip": csv_roundtrip,
    "json_records_roundtrip": json_records_roundtrip,
    "json_array_roundtrip": json_array_roundtrip,
    "campaigns_from_text": campaigns_from_text,
    "items_from_text": items_from_text,
    "value_rejects": value_rejects,
    "extract_report": extract_report,
    "json_contract": json_contract,
    "pipeline_reports": pipeline_reports,
    "tables_present": tables_present,
    "staging_load_counts": staging_load_counts,
    "mart_csv_export": mart_csv_export,
    "column_contract": column_contract,
    "mart_views_sql": mart_views_sql,
    "scan_profile": scan_profile,
    "json_records": json_records,
}


def queries() -> dict[str, Query]:
    return {**MARTS, **REPORTS, **CHARTS, **CLEANING, **WAREHOUSE, **QUALITY, **READING_WRITING}
