"""The batch job: clean and stage, build the warehouse, publish marts and reports."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesloom.config import Settings
from salesloom.functions.numeric import publish
from salesloom.operators import clean, fact, quality, rejects
from salesloom.plans.marts import Marts
from salesloom.plans.reports import run_reports
from salesloom.plans.warehouse import Warehouse
from salesloom.sources import files, sinks
from salesloom.sources.contracts import STAGING_TABLES, column_contract
from salesloom.sources.store import Store, VersionedStore

log = logging.getLogger(__name__)

PHASES = ("etl", "warehouse")
#: The staging tables of the last run and their rows.
MANIFEST, MANIFEST_SCHEMA = "staging_manifest", "table string, rows bigint"

@dataclass
class Run:
    """What a run has produced, by name."""

    seconds: float = 0.0
    reports: dict[str, DataFrame] = field(default_factory=dict)
    exports: dict[str, str] = field(default_factory=dict)


def register_views(marts: Marts, prefix: str = "vw_") -> list[str]:
    """The marts as temporary views; a changed definition replaces the old one."""
    names = []
    for name, df in marts.items():
        publish(df).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def export_marts(marts: Marts, folder: str) -> dict[str, str]:
    """Every mart as CSV, in its order."""
    paths = {}
    for name, df in marts.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        sinks.write_csv(df, paths[name])
    return paths


def warehouse_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table with its kind, and a TOTAL row."""
    counts = sinks.row_counts(tables).rollup("table").agg(F.sum("rows").alias("rows"))
    kind = F.when(F.col("table").isNull(), "TOTAL").when(F.col("table").startswith("fact"), "FACT").otherwise("DIM")
    return counts.select(kind.alias("kind"), F.coalesce("table", F.lit("TOTAL")).alias("table"), "rows")


def staging_references(staging: dict[str, DataFrame]) -> list[quality.Reference]:
    edges = (
        ("orders -> customers", "stg_orders", "stg_customers", "customer_id"),
        ("order_items -> orders", "stg_order_items", "stg_orders", "order_id"),
        ("order_items -> products", "stg_order_items", "stg_products", "product_id"),
    )
    return [
        quality.Reference(label, staging[child], staging[parent], key)
        for label, child, parent, key in edges
        if child in staging and parent in staging
    ]


def run_etl(
    spark: SparkSession, raw_folder: str, store: Store, settings: Settings, csv_copies: bool = True
) -> dict[str, DataFrame]:
    """Read, clean, stage and check; returns the reports of the phase.

    `csv_copies` writes every staging table once more as CSV, for inspection.
    """
    # From here on everything works on the landed copy of each source.
    raw, extracted = files.extract_all(spark, raw_folder, store, settings.single_line)
    cleaned = clean.transform_all(raw, settings)
    # Nothing counts as staged until all of this run's tables are.
    store.save(spark.createDataFrame([], MANIFEST_SCHEMA), MANIFEST)
    staging, counts = sinks.load_all(cleaned, store)
    store.save(counts, MANIFEST)
    # Everything after loading reads the staged copy instead of cleaning again.
    for source, table in STAGING_TABLES.items():
        if csv_copies and table in staging:
            sinks.write_csv(staging[table], store.path(f"csv/{source}_clean"))
    results = {
        "extracted": extracted,
        "column_contract": column_contract(spark, raw),
        "staging_counts": counts,
    }
    if raw:
        set_aside = store.save(rejects.all_value_rejects(raw), "value_rejects")
        results["value_rejects"] = rejects.value_reject_summary(set_aside)
    if staging:
        results["quality"] = quality.quality_report(staging, settings.max_null_percent)
    references = staging_references(staging)
    if references:
        results["orphans"] = quality.orphan_checks(references)
    return results


def run_warehouse(spark: SparkSession, store: Store, settings: Settings) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Dimensions, fact, marts, views, reports and exports from what `run_etl` has staged.

    Tables that an earlier run has left, and the last one has not replaced, are not used.
    """
    known = {row["table"] for row in store.load(MANIFEST).select("table").collect()}
    absent = [source for source, table in STAGING_TABLES.items() if table not in known]
    if absent:
        raise LookupError(f"the last run has not staged {', '.join(absent)} in {store.root}")
    staged = {source: store.load(table) for source, table in STAGING_TABLES.items()}
    warehouse = Warehouse.over_staging(spark, store, settings, staged)
    results = {
        "warehouse": warehouse_summary(warehouse.tables()),
        "rejects": fact.reject_summary(warehouse.fact_rejects),
    }
    marts = Marts(warehouse, store)
    register_views(marts)
    results.update(run_reports(marts))
    return results, export_marts(marts, store.path("export"))


def run_pipeline(
    spark: SparkSession,
    raw_folder: str,
    out_folder: str,
    settings: Settings | None = None,
    only: str | None = None,
    csv_copies: bool = True,
) -> Run:
    """Both phases, or one of them over what the other has left in the output folder."""
    if only is not None and only not in PHASES:
        raise ValueError(f"unknown phase {only!r}, expected one of {PHASES}")
    settings = settings or Settings()
    store = VersionedStore(spark, out_folder)
    run, start = Run(), time.monotonic()
    try:
        if only in (None, "etl"):
            run.reports.update(run_etl(spark, raw_folder, store, settings, csv_copies))
        if only in (None, "warehouse"):
            results, run.exports = run_warehouse(spark, store, settings)
            run.reports.update(results)
    except Exception:
        log.exception("pipeline failed after %.1f s", time.monotonic() - start)
        raise
    run.seconds = time.monotonic() - start
    log.info("pipeline complete in %.1f s", run.seconds)
    return run
