"""What the physical plans must look like, and that hot keys do not change results."""

from datetime import date

import pytest
from conftest import SF_DIR, plan_of, rows
from pyspark.sql import functions as F

from salesloom.operators import clean, fact, quality
from salesloom.operators.dedup import has_hot_key, keep_first
from salesloom.plans import catalog, marts, reports
from salesloom.plans.marts import MART_NAMES, Marts
from salesloom.plans.warehouse import Warehouse
from salesloom.sources import testbed
from salesloom.sources.store import Store


@pytest.mark.parametrize("name", MART_NAMES)
def test_marts_avoid_row_multiplication_and_python(sample, name):
    plan = plan_of(Marts(sample)[name])
    for operator in ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in plan, operator


@pytest.mark.parametrize("name", ["top_products", "category_performance", "campaign_roi"])
def test_line_marts_read_revenue_partitions_only(sample, name):
    plan = plan_of(Marts(sample)[name])
    scans = [line for line in plan.splitlines() if line.startswith("PartitionFilters") and "is_revenue" in line]
    assert scans and all("(is_revenue" in s and "= 1)" in s for s in scans)
    assert "payment_method" not in plan


def test_reports_do_not_sort_the_mart_they_aggregate(sample, store):
    plan = plan_of(reports.report_ltv_tiers(Marts(sample, store)["customer_ltv"]), "simple")
    assert plan.count("rangepartitioning") <= 1
    top = plan_of(reports.best_customers(Marts(sample, store)["customer_ltv"]), "simple")
    assert "TakeOrderedAndProject" in top and "rangepartitioning" not in top


def test_deduplication_drops_copies_before_the_shuffle(spark, sample):
    raw = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines = plan_of(keep_first(raw, "l_orderkey", ["l_linenumber"]), "simple").splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[shuffle + 1:])


def _lines_with_copies(spark, item):
    figures = ("unit_price", "discount_pct", "discount_amt", "line_total", "line_profit")
    return spark.range(30_000, numPartitions=3).select(
        item.alias("item_id"), F.col("id").alias("v"), F.lit(1).alias("quantity"), *[(F.col("id") % 100).alias(c) for c in figures]
    )


@pytest.mark.parametrize("hot", [False, True])
def test_lines_are_sorted_in_shuffle_partitions_unless_a_key_is_hot(spark, hot):
    """An input split of any size is not sorted as a whole; copies of a hot key, here NULL, are still dropped before the shuffle."""
    spread = F.col("id") % 20_000
    raw = _lines_with_copies(spark, F.when(F.col("id") % 100 > 0, spread) if hot else spread)
    assert has_hot_key(raw, "item_id") == hot
    cleaned = clean.clean_order_items(raw, ["v"])
    lines = plan_of(cleaned, "simple").splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("Sort" in line for line in lines[shuffle + 1 :]) == hot
    first = raw.groupBy("item_id").agg(F.min("v").alias("v"))
    assert rows(cleaned.select("item_id", "v").orderBy("item_id")) == rows(first.orderBy("item_id"))


def test_a_table_without_rows_has_no_hot_key(spark):
    empty = _lines_with_copies(spark, F.col("id")).limit(0)
    assert not has_hot_key(empty, "item_id") and clean.clean_order_items(empty).count() == 0


def test_cleaning_stays_in_generated_code(spark):
    raw = spark.createDataFrame([("a", "b")], "status string, channel string")
    df = raw.select(clean.clean_label(F.col("status")), clean.clean_label(F.col("channel")))
    assert "lambda" not in plan_of(df, "simple").lower()


def test_a_hot_key_changes_nothing(spark):
    """A third of the rows share one item, order, product and customer."""
    n = 9000
    hot = F.col("id") % 3 == 0
    raw = spark.range(n).select(
        F.when(hot, F.lit(-1)).otherwise(F.col("id")).alias("item_id"),
        F.when(hot, F.lit(-1)).otherwise(F.col("id") % 500).alias("order_id"),
        F.col("id").alias("v"),
    )
    kept = keep_first(raw, "item_id", ["v"])
    assert kept.count() == n - n // 3 + 1
    assert rows(kept.filter("item_id = -1").select("v")) == [(0,)]
    parents = spark.range(0, 400).select(F.col("id").alias("order_id"))
    got = rows(quality.orphan_checks([quality.Reference("x", raw, parents, "order_id")]))
    expected = sum(1 for i in range(n) if i % 3 == 0 or i % 500 >= 400)
    assert got == [("x", expected, f"{expected} orphans")]


def test_each_child_is_read_once_for_all_its_references(sample):
    """Both sides meet on the partitioning that they were counted with."""
    plan = plan_of(quality.orphan_checks(catalog._references(sample)), "simple")
    reads = [line for line in plan.splitlines() if "FileScan" in line]
    for columns in (("date_key", "customer_key", "product_key"), ("order_id", "product_id")):
        assert sum(all(f"{c}#" in line for c in columns) for line in reads) == 1
    assert len(reads) == 3 + 7  # three children; orders are a parent twice, once with a condition
    assert plan.count("Exchange hashpartitioning") == 2


def test_distinct_counts_with_a_hot_product(spark):
    lines = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, 1L, id % 40) AS product_key", "CONCAT('O', id % 700) AS order_id", "id % 700 % 90 AS customer_key",
        "1 AS quantity", "1.00BD AS line_revenue", "0.50BD AS line_profit", "50.0BD AS line_margin_pct",
    )
    got = {r.product_key: (r.orders, r.customers, r.line_items) for r in marts.per_key(lines, "product_key").collect()}
    plain = lines.groupBy("product_key").agg(
        F.count_distinct("order_id"), F.count_distinct("customer_key"), F.count("*")
    )
    assert got == {r[0]: (r[1], r[2], r[3]) for r in plain.collect()}


def test_a_hot_product_of_a_hot_customer_is_dealt_out(spark):
    """A third of all lines are of one product and one customer: no partition of any step has twice the median's rows."""
    lines = spark.range(0, 60_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 1L, id % 997) AS product_key", "CONCAT('O', id) AS order_id", "IF(id % 3 = 0, 1L, id % 991) AS customer_key",
        "1 AS quantity", "1.00BD AS line_revenue", "0.50BD AS line_profit", "50.0BD AS line_margin_pct",
    )
    found = marts.per_key(lines, "product_key")
    got = {r.product_key: (r.orders, r.customers, r.line_items) for r in found.collect()}
    plain = lines.groupBy("product_key").agg(F.count_distinct("order_id"), F.count_distinct("customer_key"), F.count("*"))
    assert got == {r[0]: (r[1], r[2], r[3]) for r in plain.collect()}
    dealt = [line for line in plan_of(found).splitlines() if "hashpartitioning(" in line]
    assert {("order_id" in d, "customer_key" in d) for d in dealt} == {(True, False), (False, True), (False, False)}
    orders = lines.repartition(8, "product_key", "order_id").groupBy("product_key", "order_id", "customer_key").count()
    by_task = orders.groupBy(F.spark_partition_id().alias("task"))
    sizes = sorted(r[1] for r in by_task.count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_a_day_prunes_the_years_of_the_fact(spark, sample):
    day = sample.fact_sales.join(sample.dim_date, "date_key").agg(F.min("full_date")).first()[0]
    found = fact.lines_of_day(sample.fact_sales, sample.dim_date, day)
    expected = sample.fact_sales.join(sample.dim_date, "date_key").filter(F.col("full_date") == F.lit(day))
    assert sorted(r.item_id for r in found.collect()) == sorted(r.item_id for r in expected.collect()) != []
    assert "dynamicpruning" in plan_of(found) and rows(fact.lines_of_day(sample.fact_sales, sample.dim_date, date(1900, 1, 1))) == []


def test_skewed_join_is_split_at_run_time(spark):
    """With thresholds at test size, the fact's kind of join splits the hot partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(0, 60_000, 1, 16).selectExpr("IF(id % 3 = 0, -1L, id % 5000) AS order_id", "id AS item_id")
        orders = spark.range(-1, 5000).selectExpr("id AS order_id", "id * 2 AS w")
        joined = lines.join(orders, "order_id")
        got = joined.collect()
        assert len(got) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_are_dropped_before_cleaning_widens_them(spark):
    """Where the order does not ask for what cleaning changes, nothing of it is sorted or shuffled."""
    raw = testbed.raw_source(spark, SF_DIR, "order_items")
    for cleaned, late in (
        (clean.clean_order_items(raw, testbed.ORDER_BY["order_items"]), "effective_unit_price"),
        (clean.clean_order_items(raw), "effective_unit_price"),
        (clean.clean_orders(testbed.raw_source(spark, SF_DIR, "orders")), "fulfillment_days"),
    ):
        lines = plan_of(cleaned, "simple").splitlines()
        window = next(i for i, line in enumerate(lines) if "Window" in line)
        assert not any(late in line for line in lines[window:])


def test_the_fact_is_not_moved_once_more_to_be_written(spark, folder):
    saved = {}

    class Watched(Store):
        def save(self, df, name, partition_by=()):
            saved[name] = df
            return super().save(df, name, partition_by)

    built = Warehouse(spark, Watched(spark, folder), testbed.SETTINGS, lambda s: testbed.raw_source(spark, SF_DIR, s), testbed.ORDER_BY)
    assert built.fact_sales.count() > 0
    assert "Exchange rebalance" not in (plan := plan_of(saved["fact_sales"], "simple")) and "REBALANCE" not in plan.upper()
