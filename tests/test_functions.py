from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesloom import config
from salesloom.functions.binning import bin_label
from salesloom.functions.dates import date_key, fiscal_quarter, fiscal_year, parse_date
from salesloom.functions.numeric import (
    bubble_size, coerce_int, compact_money, compact_number, money, percent, publish, ratio, zero_if_null,
)
from salesloom.functions.text import clean_email, clean_label, short_label, title_case


def apply(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in rows(df.select(expression(F.col("x"))))]


def test_title_case_starts_after_every_non_letter(spark):
    texts = ["sales-rep o'brien 2nd smb", "ABC def", "  x", "éTÉ-été", "Customer#000000001", "", None]
    assert apply(spark, texts, "string", title_case) == [
        "Sales-Rep O'Brien 2Nd Smb", "Abc Def", "  X", "Été-Été", "Customer#000000001", "", None,
    ]


def test_title_case_agrees_with_pythons(spark):
    texts = ["north", "SMB", "a1b2", "they're bill's", "x_y z", "north-EAST  region", "3com", "o'NEIL-mc"]
    assert apply(spark, texts, "string", title_case) == [t.title() for t in texts]


def test_labels_and_emails_are_trimmed(spark):
    assert apply(spark, [" completed", "RETURNED "], "string", clean_label) == ["Completed", "Returned"]
    assert apply(spark, [" Alice@EXAMPLE.COM "], "string", clean_email) == ["alice@example.com"]
    assert apply(spark, ["Laptop Pro Max", "Desk"], "string", short_label) == ["Laptop Pro", "Desk"]


def test_price_bands_are_closed_on_the_right(spark):
    prices = [-1.0, 0.0, 0.01, 1000.0, 1000.01, 5000.0, 20000.0, 20000.5, 100000.0, 100001.0, None]
    bands = apply(
        spark, prices, "double", lambda c: bin_label(c, config.PRICE_BAND_EDGES, config.PRICE_BAND_LABELS)
    )
    assert bands == [
        None, None, "Budget", "Budget", "Mid-Range", "Mid-Range", "Premium", "Enterprise", "Enterprise", "Luxury", None,
    ]


def test_bins_reject_bad_edges():
    with pytest.raises(ValueError):
        bin_label(None, [0, 0], ["a", "b"])


def test_money_coerces_text_and_rejects_what_is_no_number(spark):
    assert apply(spark, ["12.345", " 7 ", "1e3", "abc", "NaN", "", None], "string", money) == [
        Decimal("12.35"), Decimal("7.00"), Decimal("1000.00"), None, None, None, None,
    ]
    assert apply(spark, [1.005, float("nan"), float("inf")], "double", money) == [Decimal("1.01"), None, None]


def test_whole_numbers_drop_the_fraction(spark):
    assert apply(spark, ["2.9", "-2.9", "x", "nan", None], "string", coerce_int) == [2, -2, None, None, None]


def test_ratio_and_percent(spark):
    df = spark.createDataFrame([(Decimal("1.00"), 8), (Decimal("-1.00"), 8), (Decimal("5.00"), 0)], "a decimal(18,2), b int")
    got = rows(df.select(ratio(F.col("a"), F.col("b"), 2), percent(F.col("a"), F.col("b"), 1)))
    assert got == [(Decimal("0.13"), Decimal("12.5")), (Decimal("-0.13"), Decimal("-12.5")), (None, None)]


def test_publish_turns_decimals_into_doubles(spark):
    df = publish(spark.sql("SELECT CAST(1.10 AS DECIMAL(18,2)) AS a, 1 AS b, 'x' AS c"))
    assert df.dtypes == [("a", "double"), ("b", "int"), ("c", "string")]
    assert rows(df) == [(1.1, 1, "x")]


def test_zero_if_null(spark):
    assert apply(spark, [None, 2.345], "double", lambda c: zero_if_null(c.cast("decimal(9,3)"), 1)) == [
        Decimal("0.0"), Decimal("2.3"),
    ]


@pytest.mark.parametrize(
    "amount, long, short",
    [
        (123456789.0, "₹12.3 Cr", "12.3Cr"),
        (10_000_000.0, "₹1.0 Cr", "1.0Cr"),
        (9_999_999.0, "₹100.0L", "100.0L"),
        (250_000.0, "₹2.5L", "2.5L"),
        (99_999.5, "₹99,999.5", "99,999.5"),
        (1_234.0, "₹1,234", "1,234"),
        (7.125, "₹7.125", "7.125"),
        (0.0, "₹0", "0"),
        (-1_234_567.25, "₹-12,34,567.25", "-12,34,567.25"),
    ],
)
def test_compact_money(spark, amount, long, short):
    assert apply(spark, [amount], "double", compact_money) == [long]
    assert apply(spark, [amount], "double", compact_number) == [short]


def test_bubble_size_has_a_floor(spark):
    assert apply(spark, [0, None, 100, 1], "bigint", bubble_size) == [8.0, 8.0, 15.0, 8.0]


def test_dates(spark):
    df = spark.createDataFrame([("2023-04-01",), ("2023-03-31",), ("bad-date",), (None,)], "d string")
    d = parse_date(df, "d")
    assert rows(df.select(d, date_key(d), fiscal_year(d), fiscal_quarter(d))) == [
        (date(2023, 4, 1), 20230401, 2023, 1), (date(2023, 3, 31), 20230331, 2022, 4),
        (None, None, None, None), (None, None, None, None),
    ]


def test_typed_dates_pass_through(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2023-04-01 23:59:59' AS t, DATE '2023-04-02' AS d")
    assert rows(df.select(parse_date(df, "t"), parse_date(df, "d"))) == [(date(2023, 4, 1), date(2023, 4, 2))]
