import json
from datetime import date
from pathlib import Path

import pytest
from conftest import rows

from salesloom.config import Settings
from salesloom.plans import pipeline
from salesloom.plans.marts import MART_NAMES, Marts
from salesloom.session import fresh_folder, shared_root
from salesloom.sources import files
from salesloom.sources.store import VersionedStore

SETTINGS = Settings(as_of=date(2024, 12, 31))


@pytest.fixture
def raw_folder(folder):
    raw = Path(folder) / "raw"
    raw.mkdir()
    (raw / "customers.csv").write_text(
        "customer_id,name,email,phone,city,region,country,segment,joined_date,is_active,loyalty_score\n"
        "CUST00001,alice smith,Alice@EXAMPLE.COM,1,Delhi,north,India,enterprise,2022-01-15,1,8.5\n"
        "CUST00002,BOB JONES,bob@example.com,2,Mumbai,South,India,SMB,2023-06-20,,7.2\n"
        "CUST00001,alice smith,Alice@EXAMPLE.COM,1,Delhi,north,India,enterprise,2022-01-15,1,8.5\n"
    )
    (raw / "products.csv").write_text(
        "product_id,name,category,sub_category,unit_cost,unit_price,margin_pct,stock_qty,is_active,launch_date\n"
        "PROD0001,Laptop Pro,electronics,electronics,30000,55000,45.4,100,1,2021-01-01\n"
        "PROD0002,Notebook,stationery,stationery,50,99,49.5,200,1,2020-06-15\n"
    )
    (raw / "orders.csv").write_text(
        "order_id,customer_id,order_date,shipped_date,status,channel,payment_method,order_total,order_profit,num_items\n"
        "ORD0000001,CUST00001,2022-03-01,2022-03-04,Completed,Online,Card,110000,50000,1\n"
        "ORD0000002,CUST00002,2023-03-05,,Cancelled,Partner,Cash,0,0,1\n"
        "ORD0000003,CUST00002,2023-03-07,2023-03-08,completed,Direct,Cash,198,98,1\n"
        "ORD0000004,CUST00001,bad-date,,INVALID_STATUS,Direct,Cash,1,1,1\n"
    )
    (raw / "order_items.csv").write_text(
        "item_id,order_id,product_id,quantity,unit_price,discount_pct,discount_amt,line_total,line_profit,campaign_ref\n"
        "ITEM1,ORD0000001,PROD0001,2,55000,0,0,110000,50000,CAMP0001\n"
        "ITEM2,ORD0000002,PROD0002,1,99,0,0,99,49,\n"
        "ITEM3,ORD0000003,PROD0002,2,99,0,0,198,98,CAMP0001\n"
        "ITEM4,ORD0000004,PROD0002,1,99,0,0,99,49,\n"
    )
    campaign = {
        "campaign_id": "CAMP0001", "name": "Email Campaign 01", "type": "Email", "goal": "Awareness", "start_date": "2022-01-01",
        "end_date": "2022-02-01", "budget": 1000.0, "spend": 900.0, "impressions": 1000, "clicks": 10, "conversions": 1,
        "revenue_generated": 1800.0, "ctr": 1.0, "conversion_rate": 10.0, "roi": 100.0, "status": "Completed",
    }
    (raw / "campaigns.json").write_text(json.dumps({"records": [campaign]}, indent=1))
    return str(raw)


def test_whole_run(spark, folder, raw_folder):
    run = pipeline.run_pipeline(spark, raw_folder, f"{folder}/out", SETTINGS)
    assert {r.status for r in run.reports["extracted"].collect()} == {"read"}
    counts = {r.table: r.rows for r in run.reports["staging_counts"].collect()}
    assert counts == {"stg_customers": 2, "stg_products": 2, "stg_orders": 4, "stg_order_items": 4, "stg_campaigns": 1}
    assert {r.status for r in run.reports["orphans"].collect()} == {"OK"}
    tables = {r.table: (r.kind, r.rows) for r in run.reports["warehouse"].collect()}
    # The line of the order without a date has no place in the fact.
    assert tables == {
        "dim_date": ("DIM", 730), "dim_customer": ("DIM", 2), "dim_product": ("DIM", 2), "dim_campaign": ("DIM", 1),
        "fact_sales": ("FACT", 3), "TOTAL": ("TOTAL", 738),
    }
    assert {r.reason: r.rows for r in run.reports["rejects"].collect()} == {
        "missing_order": 0, "missing_date": 1, "missing_customer": 0, "missing_product": 0, "unusable_value": 0,
    }
    assert rows(VersionedStore(spark, f"{folder}/out").load("fact_rejects").select("item_id")) == [("ITEM4",)]
    top = run.reports["report_topline"].first()
    assert (top.total_orders, top.unique_customers, float(top.total_revenue), float(top.total_profit)) == (2, 2, 110198, 50098)
    assert rows(spark.sql("SELECT year, total_revenue FROM vw_monthly_revenue ORDER BY year")) == [(2022, 110000.0), (2023, 198.0)]
    assert rows(spark.sql("SELECT campaign_id, attributed_revenue, roi_pct FROM vw_campaign_roi")) == [
        ("CAMP0001", 110198.0, 10919.8),
    ]
    assert set(run.exports) == set(MART_NAMES)
    header = next(Path(run.exports["yoy_comparison"]).glob("*.csv")).read_text().splitlines()[0]
    assert header == "month,month_name,revenue_2021,revenue_2022,revenue_2023,growth_21_22_pct,growth_22_23_pct"


def test_orders_of_any_year_are_sold(spark, folder, raw_folder):
    """The calendar follows the orders: one of 2026 is in the fact and in the marts."""
    path = Path(raw_folder) / "orders.csv"
    path.write_text(path.read_text().replace("2023-03-07", "2026-03-07 18:30:00"))
    run = pipeline.run_pipeline(spark, raw_folder, f"{folder}/out", SETTINGS, csv_copies=False)
    assert {r.year: float(r.revenue) for r in run.reports["report_by_year"].collect()} == {2022: 110000, 2026: 198}
    assert VersionedStore(spark, f"{folder}/out").load("fact_sales").filter("date_key = 20260307").count() == 1


def test_a_value_that_does_not_fit_is_set_aside(spark, folder, raw_folder):
    """The run goes on, line by line as well, and what was there is in `value_rejects`."""
    path = Path(raw_folder) / "order_items.csv"
    path.write_text(path.read_text().replace("ITEM3,ORD0000003,PROD0002,2,99,0,0,198", "ITEM3,ORD0000003,PROD0002,2,99,0,0,1" + "0" * 30))
    settings = Settings(as_of=date(2024, 12, 31), single_line=("order_items", "customers"))
    run = pipeline.run_pipeline(spark, raw_folder, f"{folder}/out", settings, csv_copies=False)
    assert float(run.reports["report_topline"].first().total_revenue) == 110000
    assert {r.reason: r.rows for r in run.reports["rejects"].collect()}["unusable_value"] == 1
    found = rows(VersionedStore(spark, f"{folder}/out").load("value_rejects").orderBy("source"))
    assert found == [
        ("order_items", "ITEM3", "line_total", "1" + "0" * 30, "out of range"), ("orders", "ORD0000004", "order_date", "bad-date", "unreadable"),
    ]


def test_the_raw_folder_is_read_once(spark, folder, raw_folder, monkeypatch):
    """After a source has landed, no plan of the first phase reads its files."""
    landed = []
    real = files.extract_all

    def extract(*args):
        out = real(*args)
        for path in Path(raw_folder).iterdir():
            path.write_text("")
        landed.append(out)
        return out

    monkeypatch.setattr(files, "extract_all", extract)
    run = pipeline.run_pipeline(spark, raw_folder, f"{folder}/out", SETTINGS, csv_copies=False)
    assert landed and run.reports["report_topline"].first().total_orders == 2


def test_phases_run_one_after_the_other(spark, folder, raw_folder):
    out = f"{folder}/out"
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, raw_folder, out, SETTINGS, only="warehouse")
    first = pipeline.run_pipeline(spark, raw_folder, out, SETTINGS, only="etl")
    assert not first.exports and Path(out, "csv/orders_clean").is_dir()
    second = pipeline.run_pipeline(spark, "/nowhere", out, SETTINGS, only="warehouse")
    assert second.reports["report_topline"].first().total_orders == 2
    with pytest.raises(ValueError):
        pipeline.run_pipeline(spark, raw_folder, out, SETTINGS, only="gen")


def test_a_calendar_without_any_order_gives_empty_marts(spark, folder, raw_folder):
    early = Settings(calendar_start=date(2010, 1, 1), calendar_end=date(2010, 12, 31))
    run = pipeline.run_pipeline(spark, raw_folder, f"{folder}/out", early, csv_copies=False)
    assert run.reports["report_topline"].first().total_orders == 0
    assert all(spark.table(f"vw_{name}").isEmpty() for name in MART_NAMES)


def test_missing_sources_do_not_stop_the_first_phase(spark, folder, raw_folder):
    incomplete = Path(folder) / "incomplete"
    incomplete.mkdir()
    (incomplete / "orders.csv").write_text((Path(raw_folder) / "orders.csv").read_text())
    run = pipeline.run_pipeline(spark, str(incomplete), f"{folder}/out", SETTINGS, only="etl")
    assert {r.table: r.rows for r in run.reports["staging_counts"].collect()} == {"stg_orders": 4}
    assert "orphans" not in run.reports


def test_tables_of_an_earlier_run_are_not_mixed_in(spark, folder, raw_folder):
    out = f"{folder}/out"
    pipeline.run_pipeline(spark, raw_folder, out, SETTINGS, only="etl")
    later = Path(folder) / "later"
    later.mkdir()
    (later / "orders.csv").write_text((Path(raw_folder) / "orders.csv").read_text())
    pipeline.run_pipeline(spark, str(later), out, SETTINGS, only="etl")
    with pytest.raises(LookupError, match="customers"):
        pipeline.run_pipeline(spark, raw_folder, out, SETTINGS, only="warehouse")


def test_views_are_replaced(spark, sample):
    names = pipeline.register_views(Marts(sample))
    again = pipeline.register_views(Marts(sample))
    assert names == again and len(names) == 10
    assert spark.table("vw_yoy_comparison").count() == 12


def test_shared_folder_comes_from_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert shared_root(spark) == before.rstrip("/")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    assert fresh_folder(spark, "x").startswith(shared_root(spark))
