from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesloom.config import Settings
from salesloom.operators import dims, fact
from salesloom.operators.keys import dense_key


def test_calendar_has_every_day_once(spark):
    days = dims.calendar(spark, date(2022, 1, 1), date(2024, 12, 31))
    assert len(days.columns) == 18
    assert rows(days.agg(F.count("*"), F.count_distinct("date_key"), F.min("date_key"), F.max("date_key"))) == [
        (1096, 1096, 20220101, 20241231),
    ]


def test_calendar_attributes_equal_the_standard_library(spark):
    for r in dims.calendar(spark, date(2022, 12, 1), date(2024, 4, 30)).collect():
        d = r.full_date
        week, weekday = d.isocalendar()[1:]
        fiscal = d.year if d.month >= 4 else d.year - 1
        tomorrow = date.fromordinal(d.toordinal() + 1)
        assert (r.date_key, r.year, r.month, r.day_of_month) == (int(d.strftime("%Y%m%d")), d.year, d.month, d.day)
        assert (r.month_name, r.day_name, r.year_month) == (d.strftime("%B"), d.strftime("%A"), d.strftime("%Y-%m"))
        assert (r.week, r.day_of_week, r.is_weekend) == (week, weekday, int(weekday >= 6))
        assert (r.quarter, r.fiscal_year, r.fiscal_quarter) == ((d.month + 2) // 3, fiscal, (d.month - 4) % 12 // 3 + 1)
        assert r.is_month_start == int(d.day == 1) and r.is_month_end == int(tomorrow.day == 1)
        assert r.is_quarter_start == int(d.day == 1 and d.month % 3 == 1)
        assert r.is_quarter_end == int(tomorrow.day == 1 and d.month % 3 == 0)


def test_calendar_covering_whole_years(spark):
    df = spark.sql("SELECT DATE '2023-05-05' AS d UNION ALL SELECT DATE '2024-02-01'")
    assert rows(dims.calendar_covering(df, "d").agg(F.count("*"), F.min("date_key"))) == [(731, 20230101)]


def test_calendar_size_is_bounded():
    with pytest.raises(ValueError):
        Settings(calendar_start=date(1, 1, 1), calendar_end=date(2024, 1, 1))


@pytest.mark.parametrize("partitions", [1, 5, 64])
def test_dense_keys_follow_the_id_order(spark, store, partitions):
    ids = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("id"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = dense_key(ids.repartition(partitions), "id", "key", store, "t")
        got = rows(keyed.select("key", "id").orderBy("key"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert keyed.columns == ["key", "id", "v"]
    assert [k for k, _ in got] == list(range(1, 5001))
    assert [i for _, i in got] == sorted(i for _, i in got)


def test_absent_columns_are_left_out(spark, store):
    df = spark.createDataFrame([("P1", None)], "product_id string, price_band string")
    assert rows(dims.product_dimension(df, store)) == [(1, "P1", "Unknown")]


@pytest.fixture
def star(spark, store):
    items = spark.sql(
        "SELECT * FROM VALUES ('I1', 'O1', 'P1', 2, 100.00BD, 10.00BD, 10.00BD, 180.00BD), "
        "('I2', 'O1', 'P2', 1, 50.00BD, 0.00BD, 0.00BD, 50.00BD), ('I3', 'O2', 'P1', 1, 100.00BD, 0.00BD, 0.00BD, 100.00BD), "
        "('I4', 'O9', 'P1', 1, 1.00BD, 0.00BD, 0.00BD, 1.00BD), ('I5', 'O1', 'P9', 1, 1.00BD, 0.00BD, 0.00BD, 1.00BD), "
        "('I6', 'O3', 'P1', 1, 1.00BD, 0.00BD, 0.00BD, 1.00BD), ('I7', 'O4', 'P1', 1, 1.00BD, 0.00BD, 0.00BD, 1.00BD), "
        "('I8', 'O1', 'P1', 1, 0.00BD, 0.00BD, 0.00BD, 0.00BD), "
        "('I9', NULL, 'P1', 1, 1.00BD, 0.00BD, 0.00BD, 1.00BD) "
        "AS t(item_id, order_id, product_id, quantity, unit_price, discount_pct, discount_amt, line_total)"
    )
    orders = spark.sql(
        "SELECT * FROM VALUES ('O1', 'C1', DATE '2023-01-02', 'Completed', 'Online', 'Card', 1), "
        "('O2', 'C1', DATE '2023-01-03', 'Cancelled', 'Online', 'Card', 0), "
        "('O3', 'C9', DATE '2023-01-03', 'Completed', 'Online', 'Card', 1), "
        "('O4', 'C1', DATE '1999-01-03', 'Completed', 'Online', 'Card', 1) "
        "AS t(order_id, customer_id, order_date, status, channel, payment_method, is_revenue)"
    )
    customers = spark.createDataFrame([("C0",), ("C1",)], "customer_id string")
    products = spark.sql("SELECT 'P1' AS product_id, 60.00BD AS unit_cost, 'Budget' AS price_band UNION ALL SELECT 'P2', NULL, NULL")
    campaigns = spark.createDataFrame([(f"K{i}",) for i in range(3)], "campaign_id string")
    return {
        "items": items,
        "orders": orders,
        "dim_date": dims.calendar(spark, date(2023, 1, 1), date(2023, 12, 31)),
        "dim_customer": dims.customer_dimension(customers, store),
        "dim_product": dims.product_dimension(products, store),
        "dim_campaign": dims.campaign_dimension(campaigns, store),
    }


def test_lines_that_are_no_money_are_rejected_and_the_rest_goes_on(spark, star):
    lines = {k: star[k] for k in ("items", "orders", "dim_date", "dim_customer", "dim_product")}
    more = spark.sql(
        "SELECT * FROM VALUES ('B1', 'O1', 'P1', NULL, 1.00BD, 0.00BD, 0.00BD, 1.00BD), ('B2', 'O1', 'P1', 1, 1.00BD, 0.00BD, 0.00BD, NULL), "
        "('B3', 'O1', 'P1', 1, 12345678901234567890.00BD, 0.00BD, 0.00BD, 1.00BD), ('B4', 'O1', 'P1', 9000000000000000000L, 1.00BD, 0.00BD, 0.00BD, 1.00BD), "
        "('G1', 'O1', 'P1', 3000000000L, 1.00BD, 0.00BD, 0.00BD, 1.00BD) "
        "AS t(item_id, order_id, product_id, quantity, unit_price, discount_pct, discount_amt, line_total)"
    )
    items = star["items"].unionByName(more)
    got = {r.item_id: r for r in fact.build_fact(**{**star, "items": items}).collect()}
    assert sorted(got) == ["G1", "I1", "I2", "I3", "I8"]
    assert (got["G1"].quantity, got["G1"].line_cost) == (3_000_000_000, 180_000_000_000)
    rejected = fact.fact_rejects(**{**lines, "items": items})
    assert sorted(rows(rejected.filter("unusable_value = 1").select("item_id"))) == [("B1",), ("B2",), ("B3",), ("B4",)]
    assert rejected.count() + len(got) == items.count()


def test_fact_measures(star):
    got = {r.item_id: r for r in fact.build_fact(**star).collect()}
    assert sorted(got) == ["I1", "I2", "I3", "I8"]
    one = got["I1"]
    assert (one.date_key, one.customer_key, one.product_key, one.campaign_key) == (20230102, 2, 1, None)
    assert (one.line_revenue, one.line_cost, one.line_profit, one.line_margin_pct) == (
        Decimal("180.00"), Decimal("120.00"), Decimal("60.00"), Decimal("33.3"),
    )
    assert (got["I2"].unit_cost, got["I2"].line_cost, got["I2"].line_margin_pct) == (0, 0, Decimal("100.0"))
    cancelled = got["I3"]
    assert (cancelled.line_revenue, cancelled.line_cost, cancelled.line_profit, cancelled.line_margin_pct) == (0, 0, 0, 0)
    assert (cancelled.unit_price, cancelled.order_status, cancelled.is_revenue) == (Decimal("100.00"), "Cancelled", 0)
    assert (got["I8"].line_profit, got["I8"].line_margin_pct) == (Decimal("-60.00"), 0)


def test_rejects_and_fact_share_out_all_lines(star):
    lines = {k: v for k, v in star.items() if k != "dim_campaign"}
    got = {r[0]: r[3:] for r in rows(fact.fact_rejects(**lines))}
    assert got == {
        "I4": (1, 0, 0, 0, 0), "I5": (0, 0, 0, 1, 0), "I6": (0, 0, 1, 0, 0), "I7": (0, 1, 0, 0, 0), "I9": (1, 0, 0, 0, 0),
    }
    built = fact.build_fact(**star)
    assert sorted(list(got) + [r[0] for r in rows(built.select("item_id"))]) == [f"I{i}" for i in range(1, 10)]


def test_reject_summary_has_every_reason(spark, star):
    lines = {k: v for k, v in star.items() if k != "dim_campaign"}
    rejects = fact.fact_rejects(**lines)
    assert dict(rows(fact.reject_summary(rejects))) == {
        "missing_order": 2, "missing_date": 1, "missing_customer": 1, "missing_product": 1, "unusable_value": 0,
    }
    assert dict(rows(fact.reject_summary(rejects.limit(0)))) == dict.fromkeys(fact.REJECT_REASONS, 0)


def test_completed_lines_get_the_campaign_they_name(star):
    named = star["items"].withColumn("campaign_ref", F.when(F.col("item_id") == "I2", "K9").when(F.col("item_id") != "I8", "K1"))
    got = dict(rows(fact.build_fact(**{**star, "items": named}).select("item_id", "campaign_key")))
    # I2 names one that does not exist, I3 is cancelled, I8 names none.
    assert got == {"I1": 2, "I2": None, "I3": None, "I8": None}


def test_settings_from_the_command_line():
    from salesloom.__main__ import parse

    given, settings = parse(["raw", "out", "etl", "--calendar-start", "2022-01-01", "--calendar-end", "2022-12-31", "--yoy-years", "2020,2021,2022"])
    assert (given.raw, given.out, given.phase) == ("raw", "out", "etl")
    assert settings == Settings(date(2022, 1, 1), date(2022, 12, 31), yoy_years=(2020, 2021, 2022))
    assert parse(["raw", "out"])[1] == Settings()


def test_summary_and_order_grain(star):
    built = fact.build_fact(**star)
    assert rows(fact.fact_summary(built)) == [(4, 3, Decimal("230.00"), Decimal("50.00"), Decimal("21.7"))]
    got = rows(fact.order_sales(built).select("order_id", "line_items", "units", "revenue", "profit", "margin_sum"))
    assert got == [("O1", 3, 4, Decimal("230.00"), Decimal("50.00"), Decimal("133.3"))]


def test_empty_fact_summary(star):
    empty = fact.build_fact(**{**star, "items": star["items"].limit(0)})
    assert rows(fact.fact_summary(empty)) == [(0, 0, 0, 0, None)]


def test_built_warehouse_keeps_its_promises(sample):
    sales = sample.fact_sales
    # Every line is sold or rejected, and the binding has orders without a readable date.
    assert sales.count() + sample.fact_rejects.count() == sample.staged("order_items").count()
    assert not sample.fact_rejects.filter("missing_date = 1").isEmpty()
    assert sales.filter("is_revenue = 1 AND line_revenue <= 0").isEmpty()
    assert sales.filter("is_revenue = 0 AND (line_revenue <> 0 OR line_profit <> 0)").isEmpty()
    keys = sample.dim_customer.agg(F.min("customer_key"), F.max("customer_key"), F.count("*"), F.count_distinct("customer_key"))
    low, high, count, distinct = rows(keys)[0]
    assert low == 1 and high == count == distinct


def test_unknown_source_is_reported(spark, store):
    from salesloom.plans.warehouse import Warehouse

    with pytest.raises(LookupError):
        Warehouse(spark, store, Settings()).staged("orders")
