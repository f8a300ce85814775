"""Which rows deduplication moves, and which lines the batch job's files hold."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from salesloom.operators import clean, dedup
from salesloom.plans import marts
from salesloom.sources import files, sinks, testbed


def _keyed(spark, key):
    return spark.range(20_000, numPartitions=4).select(F.expr(key).alias("k"), F.col("id").alias("v"), F.lit("x").alias("text"))


@pytest.mark.parametrize("key, repeated", [("CONCAT('a', id)", 0), ("IF(id % 100 = 0, NULL, id)", 1), ("id - id % 50 % 2", 400), ("id % 15000", None)])
def test_only_rows_of_repeated_keys_are_moved(spark, monkeypatch, key, repeated):
    monkeypatch.setattr(dedup, "LEAST_ROWS", 20_000)
    df = _keyed(spark, key)
    found = dedup.repeated_keys(df, "k")
    if repeated in (0, 1, None):
        assert found is None if repeated is None else len(found) == repeated
    kept = dedup.keep_first_of(df, "k", ["v"], found)
    assert sorted(rows(kept), key=str) == sorted(rows(dedup.keep_first(df, "k", ["v"])), key=str)
    assert ("Exchange hashpartitioning" in plan_of(kept, "simple")) == (repeated != 0)
    monkeypatch.setattr(dedup, "MOST_REPEATED", 0)
    assert dedup.repeated_keys(df, "k") == ([] if repeated == 0 else None)
    monkeypatch.setattr(dedup, "LEAST_ROWS", 20_001)
    assert dedup.repeated_keys(df, "k") is None


def _raw_lines(spark, rows_of_a_key):
    figures = ("unit_price", "discount_pct", "discount_amt", "line_total", "line_profit")
    item = (F.col("id") - F.col("id") % rows_of_a_key).alias("item_id")
    return spark.range(10_000).select(item, F.lit("2").alias("quantity"), *[(F.col("id") % 100).cast("string").alias(c) for c in figures])


def test_lines_with_one_row_an_id_are_cleaned_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(dedup, "LEAST_ROWS", 10_000)
    plan = plan_of(clean.clean_order_items(_raw_lines(spark, 1)), "simple")
    assert "Exchange" not in plan and "Window" not in plan
    assert clean.clean_order_items(_raw_lines(spark, 1)).count() == 10_000
    assert clean.clean_order_items(_raw_lines(spark, 4)).count() == 2_500


def test_lines_without_a_hot_product_are_dealt_out_once(spark):
    lines = spark.range(60_000).selectExpr(
        "id % 5000 AS product_key", "CONCAT('O', id % 20011) AS order_id", "id % 20011 % 997 AS customer_key",
        "1 AS quantity", "1.00BD AS line_revenue", "0.50BD AS line_profit", "50.0BD AS line_margin_pct",
    )
    found = marts.per_key(lines, "product_key")
    assert plan_of(found, "simple").count("Exchange hashpartitioning") == 1
    plain = lines.groupBy("product_key").agg(F.count_distinct("order_id"), F.count_distinct("customer_key"), F.count("*"))
    assert {r.product_key: (r.orders, r.customers, r.line_items) for r in found.collect()} == {r[0]: tuple(r[1:]) for r in plain.collect()}


def test_first_lines_are_those_that_staging_keeps(spark, folder):
    """Ids of the base table that are equal as text are one line, whatever is NULL in them."""
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    lines = [(1, 9, 1, 1, 2.0, 20.0, 0.1, 0.0), (1, 8, 2, 1, 2.0, 30.0, 0.1, 0.0), (None, 7, 1, 5, 1.0, 5.0, 0.0, 0.1), (5, 6, 1, None, 1.0, 6.0, 0.0, 0.1), (2, 5, 1, 3, None, 1.0, None, None)]
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    staged = clean.clean_order_items(testbed.raw_source(spark, folder, "order_items"), testbed.ORDER_BY["order_items"])
    first = clean.with_clean_values(testbed.first_order_items(spark, folder))
    assert plan_of(first, "simple").count("Exchange") == 1
    assert first.columns == staged.columns and [f.dataType for f in first.schema] == [f.dataType for f in staged.schema]
    assert sorted(rows(first), key=str) == sorted(rows(staged), key=str) and first.count() == 3


def test_compressed_files_hold_the_same_rows(spark, folder):
    df = spark.createDataFrame([(1, 'a "b"\nc'), (2, None)], "id int, name string")
    sinks.write_csv(df, f"{folder}/x.csv", compression="gzip")
    names = [f.rsplit("/", 1)[1] for f in spark.read.text(f"{folder}/x.csv").inputFiles()]
    assert names and all(n.endswith(".csv.gz") for n in names)
    assert sorted(rows(files.read_csv(spark, f"{folder}/x.csv"))) == [("1", 'a "b"\nc'), ("2", None)]
