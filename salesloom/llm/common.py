"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom.session import fresh_folder
from salesloom.sources.store import Store

#: Java and Spark patterns of the two word rules.
SPACES = r"[\x20\x09-\x0D]+"
NOT_LETTERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written below the cluster's shared folder and read back: lineage ends there, and a
    lost executor loses none of them."""
    spark = df.sparkSession
    return Store(spark, fresh_folder(spark, label)).save(df, "rows")


_SHIPPED: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """The same rows, once the executors can import this package: Python functions are sent to them by name.

    The archive is served by the driver as long as the application lives, so it is not deleted.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="salesloom-code-")) / "salesloom.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return df


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, between: str) -> Column:
    """Words of a text, which must not be NULL, as an array."""
    return F.filter(F.split(text, between), lambda w: w != "")




#: Bits of the table that `among` broadcasts.
SLOTS = 1 << 24


def among(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key, a bigint, is among those of `wanted`, which has a column of that name; some others may pass.

    The keys wanted are hashed to the bits of a table of fixed size, which is broadcast however many keys there are. So the
    wide rows of a small share of all keys can be told before they are moved. The more keys than bits, the more rows pass.
    """
    slot = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(SLOTS))
    at, bit = F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))
    seen = wanted.select(at.alias("_at"), bit.alias("_bit")).groupBy("_at").agg(F.bit_or("_bit").alias("_bits"))
    marked = df.withColumns({"_at": at, "_bit": bit}).join(F.broadcast(seen), "_at")
    return marked.filter(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*df.columns)


def parameter_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Rows given by the caller as a local relation: the planner knows its size, and broadcasts it
    if that is below the session's threshold. A table made of Python rows has no size for it."""
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns))
