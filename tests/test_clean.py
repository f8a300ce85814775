from datetime import date
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from salesloom.config import Settings
from salesloom.functions.dates import parse_date
from salesloom.operators import clean, rejects
from salesloom.operators.dedup import keep_first, removed_duplicates

AS_OF = date(2024, 1, 1)


def customers(spark):
    return spark.createDataFrame(
        [
            (" CUST00001", "alice smith", "Alice@EXAMPLE.COM", "north", "enterprise", "2022-01-15", 1, "8.5"),
            ("CUST00002", "BOB JONES", "bob@example.com", "South", "SMB", "2023-06-20", None, "7.2"),
            ("CUST00001", "alice smith", "Alice@EXAMPLE.COM", "north", "enterprise", "2022-01-15", 1, "8.5"),
            ("CUST00003", None, None, None, None, "soon", 0, "x"),
            ("CUST00004", "eve", "e@x", "east", "startup", "2030-01-01", 1, None),
        ],
        "customer_id string, name string, email string, region string, segment string, joined_date string, "
        "is_active int, loyalty_score string",
    )


def test_customers(spark):
    got = {r.customer_id: r for r in clean.clean_customers(customers(spark), AS_OF).collect()}
    assert sorted(got) == ["CUST00001", "CUST00002", "CUST00003", "CUST00004"]
    alice = got["CUST00001"]
    assert (alice.name, alice.email, alice.region, alice.segment) == (
        "Alice Smith", "alice@example.com", "North", "Enterprise",
    )
    assert (alice.joined_year, alice.joined_month, alice.tenure_days) == (2022, 1, 716)
    assert alice.loyalty_score == 8.5
    assert got["CUST00002"].is_active == 1 and got["CUST00002"].segment == "Smb"
    unknown = got["CUST00003"]
    assert (unknown.name, unknown.joined_date, unknown.tenure_days, unknown.loyalty_score) == (None, None, None, None)
    assert got["CUST00004"].tenure_days == 0


def test_products(spark):
    df = spark.createDataFrame(
        [
            ("P1", "electronics", "30000", "55000", 45.4, 1),
            ("P2", "stationery ", "50", "99", 49.5, None),
            ("P3", "x", "10.01", None, 0.0, 1),
            ("P4", "x", "10", "0", 0.0, 1),
            ("P5", None, "bad", "-5", 0.0, 1),
            ("P6", None, "bad", "bad", 0.0, 1),
        ],
        "product_id string, category string, unit_cost string, unit_price string, margin_pct double, is_active int",
    )
    got = {r.product_id: r for r in clean.clean_products(df).collect()}
    assert (got["P1"].price_band, got["P1"].margin_pct, got["P1"].category) == ("Enterprise", Decimal("45.5"), "Electronics")
    assert (got["P2"].price_band, got["P2"].category, got["P2"].is_active) == ("Budget", "Stationery", 1)
    assert (got["P3"].unit_price, got["P3"].margin_pct) == (Decimal("15.02"), Decimal("33.4"))
    assert (got["P4"].price_band, got["P4"].margin_pct, got["P4"].is_active) == (None, None, 0)
    assert (got["P5"].is_active, got["P5"].price_band, got["P5"].category) == (0, None, None)
    assert (got["P6"].unit_price, got["P6"].is_active) == (None, 1)


def orders(spark):
    return spark.createDataFrame(
        [
            ("O1", "C1", "2023-03-31", "2023-04-02", " completed", "online", "100", "40", "2"),
            ("O2", "C2", "bad-date", None, "Cancelled", "sales rep", "0", None, None),
            ("O3", "C1", "2023-01-02", "2023-01-01", "INVALID_STATUS", "Direct", "x", "5", "3.9"),
            ("O1", "C1", "2023-03-31", "2023-04-02", " completed", "online", "100", "40", "2"),
            ("O4", "C1", "2024-12-30", "2024-12-30", None, None, "5000", "5", "1"),
        ],
        "order_id string, customer_id string, order_date string, shipped_date string, status string, channel string, "
        "order_total string, order_profit string, num_items string",
    )


def test_orders(spark):
    got = {r.order_id: r for r in clean.clean_orders(orders(spark)).collect()}
    assert sorted(got) == ["O1", "O2", "O3", "O4"]
    first = got["O1"]
    assert (first.status, first.is_revenue, first.fulfillment_days, first.channel) == ("Completed", 1, 2, "Online")
    assert (first.order_year, first.order_month, first.order_quarter, first.order_dow, first.order_week) == (
        2023, 3, 1, "Friday", 13,
    )
    assert (got["O2"].order_date, got["O2"].has_zero_total, got["O2"].num_items, got["O2"].channel) == (None, 1, 1, "Sales Rep")
    assert (got["O3"].status, got["O3"].fulfillment_days, got["O3"].order_total, got["O3"].num_items) == (
        "Unknown", None, Decimal("0.00"), 3,
    )
    assert (got["O4"].status, got["O4"].order_week, got["O4"].fulfillment_days) == ("Unknown", 1, 0)
    # The mark compares with all five rows: 95 % lies between 100 and 5000.
    assert [got[o].is_high_value for o in ("O1", "O2", "O3", "O4")] == [0, 0, 0, 1]


def test_approximate_threshold_is_an_option(spark):
    got = clean.clean_orders(orders(spark), exact=False)
    assert got.count() == 4 and "is_high_value" in got.columns


def test_order_items(spark):
    df = spark.createDataFrame(
        [
            ("I1", "O1", "2", "100", "10", "10.00", "180", "80"),
            ("I2", "O1", "0", "50.55", None, None, "-3", None),
            ("I3", "O1", "2.7", "x", "0", "0", "5", "1"),
            ("I1", "O1", "2", "100", "10", "10.00", "181", "80"),
        ],
        "item_id string, order_id string, quantity string, unit_price string, discount_pct string, discount_amt string, "
        "line_total string, line_profit string",
    )
    got = {r.item_id: r for r in clean.clean_order_items(df).collect()}
    assert (got["I1"].quantity, got["I1"].effective_unit_price, got["I1"].line_total) == (2, Decimal("90.00"), Decimal("180.00"))
    assert (got["I2"].quantity, got["I2"].line_total, got["I2"].effective_unit_price) == (1, Decimal("0.00"), Decimal("50.55"))
    assert (got["I3"].quantity, got["I3"].unit_price) == (2, Decimal("0.00"))


def test_campaigns(spark):
    df = spark.createDataFrame(
        [
            ("K1", "2023-01-01", "2023-01-31", "1000", "800", "10000", "400", "20", "1600", 4.00049, 5.0005, 100.005),
            ("K2", "2023-01-01", "never", None, "0", "0", "0", "0", None, None, None, None),
        ],
        "campaign_id string, start_date string, end_date string, budget string, spend string, impressions string, "
        "clicks string, conversions string, revenue_generated string, ctr double, conversion_rate double, roi double",
    )
    one, two = sorted(clean.clean_campaigns(df).collect(), key=lambda r: r.campaign_id)
    assert (one.duration_days, one.cost_per_click, one.cost_per_conv, one.roas) == (
        30, Decimal("2.00"), Decimal("40.00"), Decimal("2.00"),
    )
    assert (one.ctr, one.conversion_rate, one.roi) == (Decimal("4.000"), Decimal("5.001"), Decimal("100.01"))
    assert (two.duration_days, two.budget, two.cost_per_click, two.roas, two.ctr) == (None, Decimal("0.00"), None, None, None)


def test_text_figures_lose_nothing(spark):
    df = spark.createDataFrame(
        [("K1", "1000.0", "12.0", "3.0", "10000", "99999999999999999.9"), ("K2", "x", None, "-1.7", "0.004", "nan")],
        "campaign_id string, impressions string, clicks string, conversions string, spend string, budget string",
    )
    one, two = sorted(clean.clean_campaigns(df).collect(), key=lambda r: r.campaign_id)
    assert (one.impressions, one.clicks, one.conversions, one.cost_per_click) == (1000, 12, 3, Decimal("833.33"))
    assert (one.budget, two.spend, two.budget) == (Decimal("99999999999999999.9"), Decimal("0.004"), 0)
    assert (two.impressions, two.clicks, two.conversions) == (0, 0, -1)
    products = spark.createDataFrame([("P1", "1000.004", "1", "1", "c")], "product_id string, unit_price string, unit_cost string, is_active string, category string")
    assert clean.clean_products(products).first().price_band == "Mid-Range"
    # What does not fit is set aside, and not taken for a missing price.
    large = clean.clean_products(products.withColumn("unit_price", F.lit("1e30"))).first()
    assert (large.unit_price, large.unit_cost, large.price_band) == (None, 1, None)


def test_numbers_that_do_not_fit_are_null_and_never_others(spark):
    names = "item_id string, quantity string, unit_price string, discount_pct string, discount_amt string, line_total string, line_profit string"
    texts = [
        ("I1", "3000000000", "1", "0", "0", "12345678901234567890.5", "-1e3"),
        ("I2", "9223372036854775808", "inf", "0", "0", "Infinity", "1" * 30),
        ("I3", "two", "NaN", None, "", " 7 ", "x"),
        ("I4", "-4", "1e400", "0", "0", "-Infinity", "0.00005"),
    ]
    df = spark.createDataFrame(texts, names)
    got = {r[0]: tuple(r)[1:] for r in rows(clean.clean_order_items(df).select("item_id", "quantity", "unit_price", "line_total", "line_profit"))}
    assert got["I1"] == (3_000_000_000, 1, Decimal("12345678901234567890.5"), -1000)
    assert got["I2"] == (None, None, None, None)
    assert got["I3"] == (1, 0, 7, 0)
    assert got["I4"] == (1, None, None, Decimal("0.0001"))
    found = {tuple(r)[1:] for r in rows(rejects.value_rejects("order_items", df))}
    out = "out of range"
    assert found == {
        ("I2", "quantity", "9223372036854775808", out), ("I2", "unit_price", "inf", out), ("I2", "line_total", "Infinity", out),
        ("I2", "line_profit", "1" * 30, out), ("I3", "quantity", "two", "unreadable"), ("I3", "line_profit", "x", "unreadable"),
        ("I4", "unit_price", "1e400", out), ("I4", "line_total", "-Infinity", out),
    }


def test_rejects_of_dates_counts_and_typed_columns(spark):
    df = spark.createDataFrame(
        [("K1", "2024-02-30", "12.7", "1e30", float("inf")), ("K2", None, "", "2", float("nan")), (None, "2024-01-01", "x", "3", 1.5)],
        "campaign_id string, start_date string, clicks string, impressions string, spend double",
    )
    found = rows(rejects.value_rejects("campaigns", df).select("key", "column", "raw_text", "reason"))
    assert sorted(found, key=str) == sorted(
        [
            ("K1", "start_date", "2024-02-30", "unreadable"), ("K1", "impressions", "1e30", "out of range"),
            ("K1", "spend", "Infinity", "out of range"), (None, "clicks", "x", "unreadable"),
        ],
        key=str,
    )
    assert rows(rejects.value_rejects("campaigns", df.limit(0))) == []
    assert sorted(rows(rejects.value_reject_summary(rejects.value_rejects("campaigns", df)))) == [
        ("campaigns", "clicks", "unreadable", 1), ("campaigns", "impressions", "out of range", 1),
        ("campaigns", "spend", "out of range", 1), ("campaigns", "start_date", "unreadable", 1),
    ]


def test_dates_with_a_time_of_day(spark):
    df = spark.createDataFrame([("2024-01-05 10:30:00",), ("2024-01-05T10:30:00",), ("2024-01-05",), ("2024-01-05 x",), ("20240105",)], "d string")
    assert [str(r[0]) for r in df.select(parse_date(df, "d")).collect()] == ["2024-01-05"] * 3 + ["None"] * 2


def test_campaign_rates_are_zero_without_a_base(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1000L, 50L, 5L, 150.00BD, 100.00BD), (0L, 0L, 0L, 0.00BD, 0.00BD) "
        "AS t(impressions, clicks, conversions, revenue_generated, spend)"
    )
    got = rows(clean.campaign_rates(df).select("ctr", "conversion_rate", "roi"))
    assert got == [(Decimal("5.000"), Decimal("10.000"), Decimal("50.00")), (0, 0, 0)]


def test_line_economics_and_order_rollup(spark):
    lines = spark.sql(
        "SELECT * FROM VALUES ('O1', 99.99BD, 60.00BD, 2, 5.00BD), ('O1', 10.00BD, 12.00BD, 1, 0.00BD), "
        "('O2', 10.00BD, 1.00BD, 3, 20.00BD) AS t(order_id, unit_price, unit_cost, quantity, discount_pct)"
    )
    priced = clean.line_economics(lines)
    assert rows(priced.select("discount_amt", "line_total", "line_profit")) == [
        (Decimal("5.00"), Decimal("189.98"), Decimal("69.98")),
        (Decimal("0.00"), Decimal("10.00"), Decimal("-2.00")),
        (Decimal("2.00"), Decimal("24.00"), Decimal("21.00")),
    ]
    heads = spark.createDataFrame([("O1", "Completed"), ("O2", "Returned"), ("O3", "Pending")], "order_id string, status string")
    got = {r.order_id: (r.order_total, r.order_profit, r.num_items) for r in clean.order_rollup(priced, heads).collect()}
    assert got == {"O1": (Decimal("199.98"), Decimal("67.98"), 2), "O2": (0, 0, 1), "O3": (0, 0, 0)}


def test_keep_first_is_independent_of_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 1000).alias("v"))
    expected = sorted(rows(keep_first(df, "k", ["v"])))
    for n in (1, 16):
        assert sorted(rows(keep_first(df.repartition(n), "k", ["v"]))) == expected


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, v int")
    assert sorted(rows(keep_first(df, "k")), key=str) == [("a", 3), (None, 1)]
    assert rows(removed_duplicates(df, "k")) == [(3, 2, 1)]


def test_absent_sources_are_left_out(spark):
    assert list(clean.transform_all({"customers": customers(spark)}, Settings())) == ["customers"]
    summary = clean.orders_summary(clean.clean_orders(orders(spark)))
    assert rows(summary) == [(4, 1, Decimal("100.00"))]
