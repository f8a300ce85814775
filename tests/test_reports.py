from decimal import Decimal

import pytest
from conftest import rows

from salesloom.plans import charts, reports
from salesloom.plans.marts import Marts

# Published sample figures by region and year.
REGIONS = [
    ("East", 2022, 244, 108, "35109268.76", "15401442.06", "41.5"), ("West", 2022, 251, 111, "32731593.86", "14196686.59", "40.5"),
    ("North", 2022, 244, 109, "32404652.56", "14153543.07", "40.8"), ("South", 2022, 224, 100, "26518148.66", "11369366.68", "40.9"),
    ("West", 2023, 256, 109, "36231416.54", "15745320.59", "41.3"), ("North", 2023, 246, 112, "34389495.12", "14864435.00", "40.5"),
    ("South", 2023, 240, 101, "32511254.14", "14058970.05", "40.5"), ("East", 2023, 228, 103, "30835392.31", "13425672.25", "40.8"),
    ("North", 2024, 279, 114, "41085173.93", "17893895.57", "41.0"), ("East", 2024, 278, 112, "40490035.81", "17755542.06", "41.2"),
    ("South", 2024, 265, 105, "38078847.60", "16712202.79", "41.6"), ("West", 2024, 269, 111, "33446972.38", "14440126.83", "41.1"),
]
# Published sample revenue by category and year.
CATEGORIES = {
    "Electronics": ("68948855.70", "71569090.92", "85886283.53"), "Software": ("36476503.09", "40387566.69", "43545620.96"),
    "Furniture": ("18960092.95", "19794152.04", "20868177.74"), "Accessories": ("2121433.25", "2005517.23", "2517242.71"),
    "Stationery": ("256778.85", "211231.23", "283704.78"),
}


@pytest.fixture
def regions(spark):
    return spark.createDataFrame(
        [(r, y, o, c, Decimal(t), Decimal(p), Decimal(m)) for r, y, o, c, t, p, m in REGIONS],
        "region string, year int, total_orders bigint, unique_customers bigint, total_revenue decimal(28,2), "
        "total_profit decimal(28,2), avg_margin_pct decimal(18,1)",
    )


def test_region_rollup_of_the_published_sample(regions):
    got = rows(reports.region_rollup(regions))
    assert [r[0] for r in got] == ["North", "East", "West", "South"]
    assert got[0][1:] == (Decimal("107879322"), Decimal("46911874"), 769, 335, Decimal("40.8"))
    assert sum(r[3] for r in got) == 3024
    # Customers count once per year: 1,295 of them where there are 498.
    assert sum(r[4] for r in got) == 1295


def test_electronics_share_of_the_published_sample(spark):
    df = spark.createDataFrame(
        [(c, sum(map(Decimal, v))) for c, v in CATEGORIES.items()], "category string, revenue decimal(28,2)"
    )
    shares = {r.label: r.pct for r in charts.share_of_total(df, "category", "category", "revenue").collect()}
    assert shares["Electronics"] == Decimal("54.7")
    assert abs(sum(shares.values()) - 100) < Decimal("0.3")


def months(spark, values):
    return spark.createDataFrame([(y, Decimal(r)) for y, r in values], "year int, total_revenue decimal(28,2)")


@pytest.mark.parametrize(
    "values, growth",
    [
        ([(2022, "99.00"), (2023, "133967558.11"), (2024, "153101029.72")], "14.3"),
        ([(2023, "50.00"), (2023, "50.00"), (2024, "80.00")], "-20.0"),
        ([(2023, "0.00"), (2024, "3.00")], "200.0"),
        ([(2024, "80.00")], "0.0"),
        ([], "0.0"),
    ],
)
def test_growth_of_the_last_year(spark, values, growth):
    assert rows(reports.latest_growth(months(spark, values))) == [(Decimal(growth),)]


def test_cards_without_sales_are_zero(sample):
    nothing = sample.order_sales.limit(0)
    cards = reports.kpi_cards(nothing, Marts(sample)["monthly_revenue"].limit(0)).first().asDict()
    assert cards and all(v == 0 for v in cards.values())


def test_mean_return_counts_missing_ones_as_zero(spark):
    df = spark.createDataFrame(
        [("Email", Decimal("10.0")), ("Email", None), ("Event", Decimal("4.0"))], "campaign_type string, roi_pct decimal(38,1)"
    )
    assert rows(charts.roi_by_type(df)) == [("Email", Decimal("5.0")), ("Event", Decimal("4.0"))]


def test_cohort_matrix(spark):
    listed = spark.createDataFrame(
        [("2022-01", "2022-01", 5.0), ("2022-01", "2022-03", 2.0), ("2022-02", "2022-02", 7.0), ("2022-03", "2022-03", 1.0)],
        "cohort_month string, activity_month string, revenue double",
    )
    got = charts.cohort_matrix(listed, cohorts=2, month_count=2)
    assert got.columns == ["cohort_month", "2022-01", "2022-02"]
    assert rows(got) == [("2022-01", 5.0, None), ("2022-02", None, 7.0)]
    fixed = charts.cohort_matrix(listed, months=["2022-03"])
    assert rows(fixed) == [("2022-01", 2.0), ("2022-02", None), ("2022-03", 1.0)]


def test_top_lists_are_sorted_and_cut(sample):
    m = Marts(sample)
    top = rows(reports.best_products(m["top_products"]).select("revenue"))
    assert len(top) == 15 and top == sorted(top, reverse=True)
    customers = reports.best_customers(m["customer_ltv"])
    assert customers.count() == 10
    ascending = [r.revenue for r in reports.ascending_by_revenue(customers).collect()]
    assert ascending == sorted(ascending)
    listed = rows(reports.cohort_list(m["cohort_monthly"]).select("cohort_month", "activity_month"))
    assert len(listed) == m["cohort_monthly"].count() and listed == sorted(listed)


def test_long_series(spark):
    df = spark.createDataFrame([("A", 1, 2)], "category string, cost int, profit int")
    assert sorted(rows(charts.long_series(df, "category", ["cost", "profit"]))) == [("A", "cost", 1), ("A", "profit", 2)]


def test_all_reports_have_rows(sample):
    results = reports.run_reports(Marts(sample))
    assert len(results) == 9
    for name, df in results.items():
        assert df.count() > 0, name


def test_campaign_series_keep_every_campaign(sample):
    campaigns = reports.campaign_list(Marts(sample)["campaign_roi"])
    assert charts.campaigns_by_type(campaigns).count() == campaigns.count()
