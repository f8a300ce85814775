import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesloom.operators import quality
from salesloom.plans import catalog
from salesloom.sources import files, sinks
from salesloom.sources.contracts import SOURCE_FILES, column_contract
from salesloom.sources.files import SourceError
from salesloom.sources.store import Store, VersionedStore

CAMPAIGN = {"campaign_id": "K1", "name": "A", "type": "Email", "start_date": "2023-01-01", "end_date": "2023-02-01",
            "spend": 10.5, "impressions": 7}


def write(folder, name, text):
    path = Path(folder) / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_text_named_by_its_header(spark, folder):
    path = write(folder, "a.csv", 'b,a\n1,"x, ""y"""\n,NA\nnull,None\n" 2 ",z\n3\n')
    df = files.read_csv(spark, path)
    assert df.dtypes == [("b", "string"), ("a", "string")]
    assert sorted(rows(df), key=str) == sorted(
        [("1", 'x, "y"'), (None, None), (None, None), (" 2 ", "z"), ("3", None)], key=str
    )


def test_csv_line_breaks_inside_quotes(spark, folder):
    path = write(folder, "a.csv", 'a,b\n"x\ny",1\n')
    assert rows(files.read_csv(spark, path)) == [("x\ny", "1")]


def test_csv_files_with_other_columns_are_refused(spark, folder):
    raw = Path(folder) / "c.csv"
    raw.mkdir()
    write(raw, "1.csv", "customer_id,name\nC1,Ann\n")
    write(raw, "2.csv", "name,customer_id\nBob,C2\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(raw)).collect()


def test_json_folder_of_both_shapes_keeps_every_record(spark, folder):
    raw = Path(folder) / "c.json"
    raw.mkdir()
    write(raw, "1.json", json.dumps([{**CAMPAIGN, "clicks": 2.0, "extra": "x"}] * 3))
    write(raw, "2.json", json.dumps({"records": [CAMPAIGN, CAMPAIGN]}))
    df = files.read_json(spark, str(raw))
    assert df.count() == 5 and df.filter("campaign_id = 'K1'").count() == 5
    assert rows(df.select("clicks", "extra").distinct().orderBy("clicks")) == [(None, None), ("2.0", "x")]
    write(raw, "3.json", '{"rows": []}')
    with pytest.raises(SourceError):
        files.read_json(spark, str(raw))


def test_a_broken_later_file_is_reported(spark, folder, store):
    raw = Path(folder) / "campaigns.json"
    raw.mkdir()
    write(raw, "1.json", json.dumps([CAMPAIGN]))
    write(raw, "2.json", '[{"campaign_id": ')
    found, report = files.extract_all(spark, folder, store)
    assert not found and {r.status for r in report.collect()} == {"failed"}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("wrapped", [False, True])
def test_json_array_and_wrapped_records(spark, folder, wrapped, indent):
    records = [CAMPAIGN, {**CAMPAIGN, "campaign_id": "K2", "goal": "Awareness"}]
    data = {"records": records} if wrapped else records
    df = files.read_json(spark, write(folder, "c.json", json.dumps(data, indent=indent)))
    assert sorted(rows(df.select("campaign_id", "goal", "spend", "impressions"))) == [
        ("K1", None, "10.5", "7"), ("K2", "Awareness", "10.5", "7"),
    ]


@pytest.mark.parametrize("text", ['{"rows": []}', '"x"', ""])
def test_json_of_another_shape_is_rejected(spark, folder, text):
    with pytest.raises(SourceError):
        files.read_json(spark, write(folder, "c.json", text))


def test_extract_reports_missing_and_broken_sources(spark, folder, store):
    write(folder, "customers.csv", "customer_id,name,extra\nC1,a,b\n")
    write(folder, "campaigns.json", '[{"campaign_id": ')
    found, report = files.extract_all(spark, folder, store)
    assert list(found) == ["customers"]
    got = {r.source: (r.status, r.detail) for r in report.collect()}
    assert set(got) == set(SOURCE_FILES)
    assert got["customers"] == ("read", "missing columns: email, region, segment, joined_date")
    assert all(got[s][0] == "failed" for s in SOURCE_FILES if s != "customers")


def test_sources_are_read_once(spark, folder, tmp_path_factory):
    """What was landed stays whole when the raw files are gone: nothing reads them again."""
    write(folder, "orders.csv", 'order_id,customer_id,order_date,status,order_total\nO1,C1,2024-01-01,"a\nb",5\nO2,C1,NA,x,1e3\n')
    nested = [CAMPAIGN, {**CAMPAIGN, "campaign_id": "K2", "goal": {"a": [1, 2.50]}}]
    write(folder, "campaigns.json", json.dumps(nested))
    store = Store(spark, str(tmp_path_factory.mktemp("landed")))
    found, _ = files.extract_all(spark, folder, store)
    for name in ("orders.csv", "campaigns.json"):
        write(folder, name, "")
    assert sorted(rows(found["orders"])) == [("O1", "C1", "2024-01-01", "a\nb", "5"), ("O2", "C1", None, "x", "1e3")]
    assert sorted(rows(found["campaigns"].select("campaign_id", "spend", "goal"))) == [("K1", "10.5", None), ("K2", "10.5", '{"a":[1,2.5]}')]
    assert set(found["campaigns"].dtypes) == {(c, "string") for c in (*CAMPAIGN, "goal")}
    assert all(folder not in str(df.inputFiles()) for df in found.values())


def test_single_line_sources_are_split_and_checked(spark, folder, store):
    head = "order_id,customer_id,order_date,status,order_total\n"
    lines = "".join(f'O{i},"C, ""{i}""",2024-01-01,x,{i}\n' for i in range(20_000))
    write(folder, "orders.csv", head + lines)
    write(folder, "customers.csv", 'customer_id,name\nC1,"a\nb"\n')
    products = Path(folder) / "products.csv"
    products.mkdir()
    write(products, "1.csv", "product_id,name\nP1,a\n\nP2,NA\n")
    write(products, "2.csv", "name,product_id\na,P3\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        found, report = files.extract_all(spark, folder, store, ("orders", "customers", "products"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found["orders"].inputFiles()) > 4 and found["orders"].count() == 20_000
    assert found["orders"].filter("order_id = 'O7'").first()[:2] == ("O7", 'C, "7"')
    assert sorted(rows(found["orders"])) == sorted(rows(files.read_csv(spark, f"{folder}/orders.csv")))
    detail = {r.source: (r.status, r.detail) for r in report.collect()}
    assert list(found) == ["orders"]
    assert "line breaks in values" in detail["customers"][1] and "2 files with 1 headers" in detail["products"][1]
    write(products, "2.csv", "product_id,name\nP3,\n")
    assert sorted(rows(files.land_csv_lines(spark, str(products), store, "again"))) == [("P1", "a"), ("P2", None), ("P3", None)]


def test_column_contract(spark):
    df = spark.createDataFrame([("P1", "x")], "product_id string, colour string")
    got = {(c, s) for _, c, s in rows(column_contract(spark, {"products": df}))}
    assert ("product_id", "present") in got and ("unit_cost", "missing") in got and ("colour", "additional") in got


def test_scan_profile_sums_over_files(spark, folder):
    path = f"{folder}/t"
    spark.range(100).repartition(4).write.parquet(path)
    size = sum(p.stat().st_size for p in Path(path).glob("*.parquet"))
    assert rows(files.scan_profile(spark.read.parquet(path), "t")) == [("t", 100, 1, 4, size)]


def test_load_replaces_and_counts(spark, store):
    frames = {"customers": spark.range(3).selectExpr("id AS customer_id"), "orders": spark.range(5).selectExpr("id AS order_id")}
    sinks.load_all(frames, store)
    tables, counts = sinks.load_all({"customers": frames["customers"].limit(2), "orders": frames["orders"]}, store)
    assert sorted(tables) == ["stg_customers", "stg_orders"]
    assert dict(rows(counts)) == {"stg_customers": 2, "stg_orders": 5}


def test_load_notices_lost_rows(spark, store, monkeypatch):
    real = store.save
    monkeypatch.setattr(store, "save", lambda df, name: real(df, name).limit(1))
    with pytest.raises(sinks.LoadError):
        sinks.load_table(spark.range(3).toDF("id"), "stg_orders", store)


def test_load_notices_changed_values(spark, store, monkeypatch):
    real = store.save
    monkeypatch.setattr(store, "save", lambda df, name: real(df, name).selectExpr("IF(id = 1, 9, id) AS id"))
    with pytest.raises(sinks.LoadError, match="other values"):
        sinks.load_table(spark.range(3).toDF("id"), "stg_orders", store)
    monkeypatch.undo()
    assert sinks.load_table(spark.range(0).toDF("id"), "stg_orders", store).count() == 0


def test_csv_keeps_blanks_and_writes_dates_as_text(spark, folder):
    df = spark.sql("SELECT ' a ' AS s, DATE '2023-01-05' AS d, 1.50BD AS m")
    sinks.write_csv(df, f"{folder}/out", single_file=True)
    written = files.read_csv(spark, f"{folder}/out")
    assert rows(written) == [(" a ", "2023-01-05", "1.5")]
    assert len(list(Path(f"{folder}/out").glob("*.csv"))) == 1


def test_json_sinks_keep_nulls(spark, folder):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, 2.50BD AS m, DATE '2023-01-05' AS d")
    expected = {"a": 1, "b": None, "m": 2.5, "d": "2023-01-05"}
    assert [json.loads(r[0]) for r in rows(sinks.json_records(df))] == [expected]
    sinks.write_json(df, f"{folder}/out")
    text = "".join(p.read_text() for p in Path(f"{folder}/out").glob("*.json"))
    assert json.loads(text) == expected


def test_target_is_chosen_by_its_address(spark, folder, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: calls.append(
        (url, table, mode, properties)))
    df = spark.range(2).toDF("id")
    sinks.write_target(df, "jdbc:postgresql://db/x", "dim_date", user="u")
    assert calls == [("jdbc:postgresql://db/x", "dim_date", "overwrite", {"user": "u"})]
    sinks.write_target(df, folder, "dim_date")
    assert spark.read.parquet(f"{folder}/dim_date").count() == 2
    with pytest.raises(ValueError):
        sinks.write_relational(df, "sqlite:///x", "t")


def test_table_existence(spark, store):
    spark.range(1).createOrReplaceTempView("known_view")
    assert rows(quality.tables_present(spark, ["known_view", "unknown_view"])) == [("known_view", True), ("unknown_view", False)]
    assert not store.exists("t")
    store.save(spark.range(1).toDF("id"), "t")
    assert store.exists("t")


def test_a_failed_write_leaves_the_last_table(spark, folder):
    store = VersionedStore(spark, folder)
    assert not store.exists("t") and store.current("t") is None
    with pytest.raises(LookupError):
        store.load("t")
    first = store.save(spark.range(3).toDF("id"), "t")
    broken = spark.range(5).selectExpr("IF(id = 4, raise_error('lost'), id) AS id")
    with pytest.raises(Exception, match="lost"):
        store.save(broken.repartition(5), "t")
    assert sorted(rows(store.load("t"))) == [(0,), (1,), (2,)]
    store.save(spark.range(7).selectExpr("id", "CAST(id % 2 AS INT) AS year"), "t", ["year"])
    assert store.load("t").count() == 7 and first.count() == 3  # who reads the old one goes on
    store.save(store.load("t").filter("id < 2"), "t")  # a table can be made of itself
    assert store.load("t").count() == 2 and VersionedStore(spark, folder).exists("t")


def test_a_partitioned_table_without_rows_can_be_read(spark, store):
    empty = spark.range(0).selectExpr("id", "CAST(id AS INT) AS year")
    saved = store.save(empty, "t", ["year"])
    assert saved.columns == ["id", "year"] and saved.count() == 0
    filled = store.save(spark.range(3).selectExpr("CAST(id AS INT) AS year", "id"), "t", ["year"])
    assert filled.dtypes == [("year", "int"), ("id", "bigint")] and filled.count() == 3


def test_documents_hold_hundreds_of_records(spark, folder, monkeypatch):
    """1,200 campaigns are a few files, not 1,200."""
    tables, documents = f"{folder}/tables", f"{folder}/documents"
    spark.range(1200).selectExpr("id AS s_suppkey", "CONCAT('S', id) AS s_name", "0 AS s_nationkey", "id / 4 AS s_acctbal").write.parquet(f"{tables}/supplier.parquet")
    spark.range(1).selectExpr("id AS event_id", "'view' AS event_type", "1.0D AS value", "'{\"k\": 7}' AS props").write.parquet(f"{tables}/events.parquet")
    monkeypatch.setattr(catalog, "fresh_folder", lambda spark, label: documents)
    contract = {r.column: r.status for r in catalog.json_contract(spark, tables).collect()}
    assert (contract["spend"], contract["extra_col"], contract["name"]) == ("missing", "additional", "present")
    assert len(list(Path(documents).glob("part-*"))) <= 3 + 8
    assert sorted(int(r.campaign_id) for r in files.read_json(spark, documents).collect()) == list(range(1200))


def test_broken_records_have_documents_of_their_own(spark, folder):
    records = spark.range(0, 1000, 1, 1).select(F.to_json(F.struct(F.col("id").alias("campaign_id"))).alias("record"), "id")
    catalog.write_documents(records, f"{folder}/x", broken=F.col("id") == 2)
    texts = sorted(p.read_text().strip() for p in Path(f"{folder}/x").glob("part-*"))
    assert len(texts) == 3 and texts[-1] == '[{"name":'
    assert sorted(len(json.loads(t)) for t in texts[:-1]) == [499, 500]
