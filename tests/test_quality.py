from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from salesloom.operators import quality


def test_null_report_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    assert rows(quality.null_report(df, "t")) == [("t", "b", 2, Decimal("66.7"))]


def test_quality_report(spark):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "a int, b string")
    repeated = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "b")], "a int, b string")
    empty = spark.createDataFrame([], "a int")
    got = rows(quality.quality_report({"good": good, "repeated": repeated, "empty": empty}))
    assert sorted(got) == [
        ("TOTAL", 6, None, None, None), ("empty", 0, None, 0, "PASS"), ("good", 2, Decimal("0.0"), 0, "PASS"),
        ("repeated", 4, Decimal("12.5"), 2, "CHECK"),
    ]


def test_only_datasets_with_repeated_hashes_are_read_again(spark, folder, monkeypatch):
    again = []
    copies = quality.full_row_copies
    monkeypatch.setattr(quality, "full_row_copies", lambda df: again.append(df.columns) or copies(df))
    once = spark.range(100).selectExpr("id AS a")
    twice = spark.range(100).selectExpr("id % 60 AS b", "IF(id % 60 = 3, NULL, 'x') AS `c d`")
    got = {r.dataset: tuple(r)[1:] for r in quality.quality_report({"once": once, "twice": twice}).collect()}
    assert again == [["b", "c d"]]
    assert got["once"] == (100, Decimal("0.0"), 0, "PASS")
    assert got["twice"] == (100, Decimal("1.0"), 40, "CHECK")


def test_dates_unreadable_and_missing(spark):
    df = spark.createDataFrame([("2023-01-01",), ("bad",), (None,)], "d string")
    assert rows(quality.date_parse_report(df, "orders", ["d"])) == [("orders", "d", 1, 1, 2)]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    ref = quality.Reference("child -> parent", child, parent, "k", "id")
    assert sorted(rows(quality.orphan_keys(ref)), key=str) == [(9, 2), (None, 1)]
    fine = quality.Reference("fine", parent, parent, "id")
    assert rows(quality.orphan_checks([ref, fine])) == [("child -> parent", 3, "3 orphans"), ("fine", 0, "OK")]


def test_orphans_of_several_columns_and_parents(spark):
    """One column against two parents, two columns of one child, NULL keys on both sides, repeated parents, an empty parent."""
    child = spark.createDataFrame([(1, 10), (1, 20), (2, None), (None, 30), (9, 10), (9, 40)], "k int, m bigint")
    first = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    second = spark.createDataFrame([(2,), (9,)], "id int")
    third = spark.createDataFrame([(10,), (20,), (30,)], "m int")
    checks = [
        quality.Reference("k -> first", child, first, "k"),
        quality.Reference("m -> third", child, third, "m"),
        quality.Reference("k -> second", child, second, "k", "id"),
        quality.Reference("second -> first", second, first, "id", "k"),
        quality.Reference("m -> nothing", child, third.limit(0), "m"),
    ]
    got = [(r.check, r.orphans, r.status) for r in quality.orphan_checks(checks).collect()]
    assert got == [
        ("k -> first", 3, "3 orphans"), ("m -> third", 2, "2 orphans"), ("k -> second", 3, "3 orphans"),
        ("second -> first", 1, "1 orphans"), ("m -> nothing", 6, "6 orphans"),
    ]


def test_orphans_with_text_keys(spark):
    child = spark.createDataFrame([("a", 1), ("b", 2), ("b", 7)], "k string, n int")
    checks = [
        quality.Reference("text", child, spark.createDataFrame([("a",)], "k string"), "k"),
        quality.Reference("number", child, spark.createDataFrame([(1,), (2,)], "n bigint"), "n"),
    ]
    assert rows(quality.orphan_checks(checks)) == [("text", 2, "2 orphans"), ("number", 1, "1 orphans")]


def test_duplicate_keys_and_missing_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(quality.missing_values(df, "t", ["k", "v"])) == [("t", "k", 0), ("t", "v", 2)]


def test_accepted_values_and_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert sorted(rows(quality.unexpected_values(df, "v", ["a"])), key=str) == [("v", "b", 2), ("v", None, 1)]
    assert sorted(rows(quality.value_counts(df, "v")), key=str) == [("a", 1), ("b", 2), (None, 1)]


def test_broken_rules_count_unknown_as_broken(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    assert rows(quality.broken_rules(df, "t", {"positive": F.col("v") > 0})) == [("t", "positive", 2)]


def test_identity_with_tolerance(spark):
    df = spark.sql("SELECT * FROM VALUES (10.00BD, 10.94BD), (10.00BD, 11.00BD), (10.00BD, 8.90BD) AS t(a, b)")
    assert rows(quality.identity_breaks(df, F.col("a"), F.col("b")).select("b")) == [(Decimal("11.00"),), (Decimal("8.90"),)]


def test_expected_rows(spark):
    wanted = {"three": (spark.range(3), spark.sql("SELECT 3")), "four": (spark.range(3), spark.sql("SELECT 4"))}
    got = rows(quality.expected_rows(wanted))
    assert got == [("three", 3, 3, True), ("four", 3, 4, False)]


def test_inversions_are_found_inside_and_between_partitions(spark):
    falling = spark.range(1000).select((1000 - F.col("id")).alias("v"))
    assert rows(quality.order_inversions(falling, "v")) == [(0,)]
    assert rows(quality.order_inversions(falling.orderBy(F.desc("v")), "v")) == [(0,)]
    rising = spark.range(0, 100, 1, 4).select(F.col("id").alias("v"))
    assert rows(quality.order_inversions(rising, "v")) == [(99,)]


def test_ranges_and_ids(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    assert rows(quality.key_range(left, "k")) == [(1, 2)]
    assert rows(quality.more_rows_than(left, right)) == [(3, 1, True)]
    assert rows(quality.ids_without_match(left, right, "k")) == [(2,)]
    assert quality.missing_columns(left, ["k", "x"]) == ["x"]


def test_presence_of_tables(spark):
    spark.range(1).createOrReplaceTempView("present_view")
    got = dict(rows(quality.tables_present(spark, ["present_view", "absent_view"])))
    assert got == {"present_view": True, "absent_view": False}


def test_headline_sanity(spark):
    cards = spark.sql(
        "SELECT 100.0 AS total_revenue, 120.0 AS total_profit, 41.0 AS avg_margin, 3 AS total_orders, "
        "2 AS unique_customers, 0 AS total_units"
    )
    broken = {r.rule for r in quality.headline_sanity(cards).collect() if r.violations}
    assert broken == {"profit_below_revenue", "units_positive"}
