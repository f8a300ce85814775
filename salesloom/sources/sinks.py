"""Table and file sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from salesloom.functions.numeric import publish
from salesloom.sources.contracts import STAGING_TABLES
from salesloom.sources.store import Store


class LoadError(RuntimeError):
    """A written table does not hold the rows it was given."""


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, counted in one job."""
    counts = [df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def content(df: DataFrame) -> list[Column]:
    """The rows of a table and the sum of their hashes, which no order of rows changes."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).alias("digest")]


def load_table(df: DataFrame, name: str, store: Store) -> DataFrame:
    """Replace a staging table and check that what was written reads back as the same rows.

    They are counted and hashed while they are written; the table is not computed twice.
    """
    watch = Observation()
    written = store.save(df.observe(watch, *content(df)), name)
    sent, stored = watch.get, written.agg(*content(written)).first()
    if sent["rows"] != stored["rows"]:
        raise LoadError(f"{name}: wrote {sent['rows']} rows, found {stored['rows']}")
    if sent["digest"] != stored["digest"]:
        raise LoadError(f"{name}: {stored['rows']} rows read back with other values")
    return written


def load_all(cleaned: dict[str, DataFrame], store: Store) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load every cleaned source that is present; returns the tables and their row counts."""
    tables = {
        staging: load_table(cleaned[source], staging, store)
        for source, staging in STAGING_TABLES.items()
        if source in cleaned
    }
    return tables, row_counts(tables)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as yyyy-MM-dd for text formats and targets without a date type."""
    return df.select(
        *[
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False, compression: str = "none") -> None:
    """CSV with a header. `single_file` is for results known to be small, such as marts by month."""
    out = dates_as_text(publish(df))
    out = out.coalesce(1) if single_file else out
    out.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression
    ).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line."""
    dates_as_text(publish(df)).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_records(df: DataFrame) -> DataFrame:
    """The rows as JSON text, nulls included."""
    shaped = dates_as_text(publish(df))
    record = F.to_json(F.struct(*shaped.columns), {"ignoreNullFields": "false"})
    return shaped.select(record.alias("record"))


def write_relational(df: DataFrame, url: str, table: str, mode: str = "overwrite", **properties: str) -> None:
    """Replace a table of the database named by a JDBC address."""
    if not url.startswith("jdbc:"):
        raise ValueError(f"not a JDBC address: {url}")
    dates_as_text(publish(df)).write.jdbc(url, table, mode=mode, properties=properties)


def write_target(df: DataFrame, target: str, table: str, **properties: str) -> None:
    """Replace `table` in a database (JDBC address) or in a folder of Parquet tables."""
    if target.startswith("jdbc:"):
        write_relational(df, target, table, **properties)
    else:
        Store(df.sparkSession, target).save(df, table)
