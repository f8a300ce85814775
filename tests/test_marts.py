from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from salesloom.operators import fact
from salesloom.plans import catalog, marts
from salesloom.plans.marts import Marts

# Published sample figures, revenue of three years by month and both growth rates.
YOY = [
    (1, "January", "11886077.96", "11414747.19", "14640119.90", -4.0, 28.3),
    (2, "February", "9139571.82", "9808597.91", "10147386.75", 7.3, 3.5),
    (3, "March", "13315242.10", "15509577.18", "13573456.63", 16.5, -12.5),
    (4, "April", "11161310.57", "15747994.72", "16734323.25", 41.1, 6.3),
    (5, "May", "8457676.50", "10487104.87", "12667883.85", 24.0, 20.8),
    (6, "June", "6454728.18", "8490293.13", "9640063.80", 31.5, 13.5),
    (7, "July", "9326761.79", "10327962.41", "9513419.63", 10.7, -7.9),
    (8, "August", "9445947.51", "9847947.21", "14504240.88", 4.3, 47.3),
    (9, "September", "11092594.97", "10057519.51", "12653210.78", -9.3, 25.8),
    (10, "October", "10632891.52", "11724543.56", "11063124.44", 10.3, -5.6),
    (11, "November", "12915428.99", "10382739.80", "12797340.04", -19.6, 23.3),
    (12, "December", "12935431.93", "10168530.62", "15166459.77", -21.4, 49.2),
]


def monthly(spark, values):
    return spark.createDataFrame(
        [(y, m, n, Decimal(r)) for y, m, n, r in values], "year int, month int, month_name string, revenue decimal(28,2)"
    )


def test_yoy_growth_of_the_published_sample(spark):
    values = [(y, m, n, r) for m, n, *rs in YOY for y, r in zip((2022, 2023, 2024), rs[:3])]
    got = rows(marts.in_order(marts.yoy_growth(monthly(spark, values), (2022, 2023, 2024)), "yoy_comparison"))
    assert [(r[0], r[1], *map(str, r[2:5]), float(r[5]), float(r[6])) for r in got] == YOY


def test_yoy_needs_the_first_year_only(spark):
    values = [(2022, 1, "January", "10.00"), (2024, 1, "January", "5.00"), (2023, 2, "February", "1.00"),
              (2022, 3, "March", "0.00"), (2023, 3, "March", "7.00"), (2021, 1, "January", "99.00")]
    got = rows(marts.in_order(marts.yoy_growth(monthly(spark, values), (2022, 2023, 2024)), "yoy_comparison"))
    assert got == [
        (1, "January", Decimal("10.00"), None, Decimal("5.00"), None, None),
        (3, "March", Decimal("0.00"), Decimal("7.00"), None, None, None),
    ]


def test_tiers_start_above_their_threshold(spark):
    df = spark.createDataFrame([(500000.01,), (500000.0,), (200000.0,), (50000.01,), (50000.0,), (0.0,)], "r double")
    tiers = [r[0] for r in rows(df.select(marts.ltv_tier(F.col("r"), (500_000, 200_000, 50_000))))]
    assert tiers == ["Platinum", "Gold", "Silver", "Silver", "Bronze", "Bronze"]


def brute_force_lines(sample):
    """The revenue lines as plain Python rows."""
    names = ["order_id", "customer_key", "product_key", "campaign_key", "date_key", "channel", "quantity",
             "line_revenue", "line_profit", "line_margin_pct"]
    return [r.asDict() for r in sample.fact_sales.filter("is_revenue = 1").select(*names).collect()]


def half_up(value, digits):
    from decimal import ROUND_HALF_UP

    return value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def test_monthly_revenue_against_brute_force(sample):
    groups = defaultdict(list)
    for line in brute_force_lines(sample):
        groups[line["date_key"] // 100].append(line)
    got = rows(Marts(sample)["monthly_revenue"].select(
        "year", "month", "total_orders", "total_line_items", "total_revenue", "total_profit", "avg_margin_pct",
        "unique_customers", "avg_order_value"))
    expected = []
    for key, lines in sorted(groups.items()):
        revenue, orders = sum(line["line_revenue"] for line in lines), len({line["order_id"] for line in lines})
        expected.append((
            key // 100, key % 100, orders, len(lines), revenue, sum(line["line_profit"] for line in lines),
            half_up(sum(line["line_margin_pct"] for line in lines) / len(lines), 1),
            len({line["customer_key"] for line in lines}), half_up(revenue / orders, 2),
        ))
    assert got == expected


def test_products_and_campaigns_against_brute_force(sample):
    for name, key, columns in (
        ("top_products", "product_key", ("times_ordered", "unique_buyers", "total_revenue")),
        ("campaign_roi", "campaign_key", ("attributed_orders", "attributed_customers", "attributed_revenue")),
    ):
        groups = defaultdict(list)
        for line in brute_force_lines(sample):
            if line[key] is not None:
                groups[line[key]].append(line)
        expected = sorted(
            (len({x["order_id"] for x in g}), len({x["customer_key"] for x in g}), sum(x["line_revenue"] for x in g))
            for g in groups.values()
        )
        assert sorted(rows(Marts(sample)[name].select(*columns))) == expected


def test_cohorts_against_brute_force(sample):
    lines = brute_force_lines(sample)
    first = {}
    for line in lines:
        month = line["date_key"] // 100
        first[line["customer_key"]] = min(month, first.get(line["customer_key"], month))
    active, revenue = defaultdict(set), defaultdict(Decimal)
    for line in lines:
        pair = (first[line["customer_key"]], line["date_key"] // 100)
        active[pair].add(line["customer_key"])
        revenue[pair] += line["line_revenue"]
    label = lambda month: f"{month // 100}-{month % 100:02d}"
    expected = [(label(c), label(a), len(active[c, a]), revenue[c, a]) for c, a in sorted(active)]
    got = rows(Marts(sample)["cohort_monthly"].select("cohort_month", "activity_month", "active_customers", "cohort_revenue"))
    assert got == expected


def test_every_mart_shares_out_the_same_revenue(sample):
    total = sample.order_sales.agg(F.sum("revenue")).first()[0]
    all_marts = Marts(sample)
    for name, column in (
        ("monthly_revenue", "total_revenue"), ("revenue_by_region", "total_revenue"), ("revenue_by_segment", "total_revenue"),
        ("channel_performance", "total_revenue"), ("category_performance", "total_revenue"), ("top_products", "total_revenue"),
        ("customer_ltv", "total_revenue"), ("cohort_monthly", "cohort_revenue"),
    ):
        assert all_marts[name].agg(F.sum(column)).first()[0] == total, name


def test_a_category_without_a_name_stays_in(spark):
    sales = spark.sql(
        "SELECT * FROM VALUES (1L, 'O1', 1L, 1, 2, 2023, 5.00BD, 2.00BD, 3.00BD, 60.0BD), "
        "(2L, 'O1', 1L, 1, 1, 2023, 7.00BD, 2.00BD, 5.00BD, 71.4BD) "
        "AS t(product_key, order_id, customer_key, is_revenue, quantity, order_year, line_revenue, line_cost, line_profit, line_margin_pct)"
    )
    products = spark.createDataFrame([(1, None), (2, "A")], "product_key bigint, category string")
    got = rows(marts.category_performance(sales, products).select("category", "year", "num_products", "total_orders"))
    assert sorted(got, key=str) == [("A", 2023, 1, 1), (None, 2023, 1, 1)]


@pytest.mark.parametrize("partitions", [1, 16])
def test_results_do_not_depend_on_partitioning(spark, sample, partitions):
    """Rows in another order, in another number of partitions, through another number of shuffle partitions."""
    reference = {name: rows(df) for name, df in Marts(sample).items()}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        shuffled = sample.fact_sales.orderBy(F.rand(5)).repartition(partitions)
        orders = fact.order_sales(shuffled)
        s, d = sample.settings, sample.dim_date
        again = {
            "monthly_revenue": marts.monthly_revenue(orders, d),
            "revenue_by_region": marts.revenue_by_region(orders, d, sample.dim_customer),
            "top_products": marts.top_products(shuffled, sample.dim_product),
            "category_performance": marts.category_performance(shuffled, sample.dim_product),
            "campaign_roi": marts.campaign_roi(shuffled, sample.dim_campaign),
            "customer_ltv": marts.customer_ltv(orders, d, sample.dim_customer, s.ltv_thresholds),
            "cohort_monthly": marts.cohort_monthly(orders, d),
        }
        for name, df in again.items():
            assert rows(marts.in_order(df, name)) == reference[name], name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_entry_and_registry():
    import __spark_entry__ as entry

    assert len(entry.queries()) >= 80
    assert set(catalog.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert catalog.queries().keys() <= entry.queries().keys()


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns
    assert catalog.warehouse(spark, SF_DIR) is catalog.warehouse(spark, SF_DIR)
