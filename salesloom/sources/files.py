"""CSV and JSON sources, landed as tables of text.

A source is read once: `land` writes its records, as text, to a table and validates them while they pass; schema,
cleaning, thresholds and reports work on that columnar copy. So a broken file in the middle of a folder is found before
anything uses the source, and no raw file is parsed twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from salesloom.sources.contracts import REQUIRED_COLUMNS, SOURCE_FILES
from salesloom.sources.store import Store

# The texts a CSV reader takes for a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

EXTRACT_SCHEMA = "source string, path string, status string, detail string"


class SourceError(ValueError):
    """A source that exists but cannot be read as what it should be."""


CSV_QUOTES = {"escape": '"'}


def _without_missing_tokens(raw: DataFrame, columns: list[str]) -> DataFrame:
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING_TOKENS), F.col(f"`{c}`")).alias(c) for c in columns])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header; cleaning coerces the types.

    Inferring types would read everything once more, and a bad value would change a column's
    type. Line breaks inside quotes are part of a value, so a file is read by one task; `land_csv_lines` reads
    files in as many tasks as they have blocks. A folder whose files do not all have the
    same header is refused when it is read.
    """
    raw = spark.read.options(header=True, multiLine=True, enforceSchema=False, **CSV_QUOTES).csv(path)
    return _without_missing_tokens(raw, raw.columns)


def land_csv_lines(spark: SparkSession, path: str, store: Store, name: str) -> DataFrame:
    """A CSV source whose values hold no line breaks, read line by line and written as a table.

    That it holds none is checked while the lines pass: a value that goes on in the next line leaves an odd number of
    quotes in its own. The header must stand once in every file. Otherwise the source is refused.
    """
    lines = spark.read.text(path)
    files, header = len(lines.inputFiles()), lines.first()
    if header is None:
        raise SourceError(f"no header in {path}")
    columns = spark.read.options(header=True, **CSV_QUOTES).csv(path).columns
    text = F.col("value")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    watch = Observation()
    seen = lines.observe(
        watch, F.count_if(quotes % 2 == 1).alias("broken"), F.count_if(text == header[0]).alias("headers")
    )
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    parsed = seen.filter((text != header[0]) & (F.trim(text) != "")).select(F.from_csv(text, schema, CSV_QUOTES).alias("r"))
    landed = store.save(_without_missing_tokens(parsed.select("r.*"), columns), name)
    if watch.get["broken"]:
        raise SourceError(f"{watch.get['broken']} lines end inside quotes: {path} has line breaks in values")
    if watch.get["headers"] != files:
        raise SourceError(f"{files} files with {watch.get['headers']} headers like the first: {path}")
    return landed


def _json_records(documents: DataFrame) -> DataFrame:
    """A row `record` (name to text) per record. Reading fails at a document that is neither an array of records nor an object
    with one under `records`, and at one that is broken."""
    first, strict = F.regexp_extract("value", r"^\s*(\S)", 1), {"mode": "FAILFAST"}
    array = F.from_json("value", "array<map<string,string>>", strict)
    wrapped = F.from_json("value", "struct<records:array<map<string,string>>>", strict)["records"]
    records = F.coalesce(F.when(first == "[", array).when(first == "{", wrapped), F.raise_error(F.lit("neither a JSON array nor an object with `records`")))
    return documents.select(F.explode(records).alias("record"))


def _documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).filter("trim(value) <> ''")


def _columns_of(records: DataFrame) -> DataFrame:
    """Records with the columns that the data has: as many names as it has are collected."""
    names = [r[0] for r in records.select(F.explode(F.map_keys("record")).alias("name")).distinct().orderBy("name").collect()]
    return records.select(*[F.col("record")[name].alias(name) for name in names])


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Top-level arrays of records, or objects with the array under `records`; a folder may hold both.

    The columns are those of the data, all as text, nested ones as JSON: a number may be written as
    2 or 2.0, and cleaning coerces either. One such document cannot be split, so large exports
    should come as many files. The data are read twice, once for the columns; `land` reads them once.
    """
    documents = _documents(spark, path)
    if documents.isEmpty():
        raise SourceError(f"no JSON document in {path}")
    try:
        return _columns_of(_json_records(documents))
    except PySparkException as error:
        raise SourceError(f"{_reason(error)}: {path}") from error


def land_json(spark: SparkSession, path: str, store: Store, name: str) -> DataFrame:
    """A JSON source written as a table of records, and read from there with its columns."""
    watch = Observation()
    documents = _documents(spark, path).observe(watch, F.count(F.lit(1)).alias("documents"))
    landed = store.save(_json_records(documents), name)
    if not watch.get["documents"]:
        raise SourceError(f"no JSON document in {path}")
    return _columns_of(landed)


def _reason(error: Exception) -> str:
    text = error.java_exception.getMessage() if isinstance(error, Py4JJavaError) else str(error)
    return str(text).splitlines()[0]


def extract_all(spark: SparkSession, folder: str, store: Store, single_line: Sequence[str] = ()) -> tuple[dict[str, DataFrame], DataFrame]:
    """All readable sources, landed in `store`, and a report with one row per source; broken ones are left out.

    A source counts as read once all of it has been parsed and written: a broken file in the middle of a folder
    is found here, and not in the step that would use it. CSV sources named in `single_line` are read line by line.
    """
    found: dict[str, DataFrame] = {}
    report = []
    for source, (filename, kind) in SOURCE_FILES.items():
        path, name = f"{folder.rstrip('/')}/{filename}", f"raw_{source}"
        try:
            if kind == "json":
                df = land_json(spark, path, store, name)
            elif source in single_line:
                df = land_csv_lines(spark, path, store, name)
            else:
                df = store.save(read_csv(spark, path), name)
        except (PySparkException, Py4JJavaError, SourceError) as error:
            report.append((source, path, "failed", _reason(error)))
            continue
        found[source] = df
        missing = [c for c in REQUIRED_COLUMNS[source] if c not in df.columns]
        report.append((source, path, "read", f"missing columns: {', '.join(missing)}" if missing else ""))
    return found, spark.createDataFrame(report, EXTRACT_SCHEMA)


def scan_profile(df: DataFrame, source: str) -> DataFrame:
    """Rows, columns and bytes of a table that is read directly from files."""
    files = df.groupBy("_metadata.file_path").agg(
        F.count(F.lit(1)).alias("file_rows"), F.max("_metadata.file_size").alias("file_bytes")
    )
    return files.agg(
        F.lit(source).alias("source"),
        F.coalesce(F.sum("file_rows"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("bytes"),
    )
