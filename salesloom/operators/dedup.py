"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F


#: A key is hot if it has more than one row in so many.
HOT_SHARE = 1000
#: Rows with repeated keys are looked for in tables of so many rows, if at most one row in so many seems to be a copy, and so many keys at most.
LEAST_ROWS, COPY_SHARE, MOST_REPEATED = 100_000, 20, 100_000


def has_hot_key(df: DataFrame, key: str) -> bool:
    """Whether a key, NULL included, has more than its share of the rows; in a small table any key has.

    One pass over the key's column into a mergeable sketch of the most frequent hashes; nothing else is moved. The sketch
    names every key that it is sure of, to about one row in 4,000, so no hot key is missed.
    """
    hashed = df.select(F.xxhash64(key).alias("hashed"))
    found = hashed.agg(F.count(F.lit(1)).alias("rows"), F.expr("approx_top_k(hashed, 1, 10000)").alias("top")).first()
    return bool(found["top"]) and found["top"][0]["count"] * HOT_SHARE > found["rows"]


def dealt_by_key(df: DataFrame, key: str) -> DataFrame:
    """The rows as `keep_first` should get them if there are very many: dealt out by key, unless a key is hot.

    `keep_first` sorts the rows of a task before the shuffle, to drop copies; a large input split does not fit a task's
    memory then and is spilled whole. Rows dealt out by key are sorted once, in the shuffle's partitions, which are small.
    """
    return df if has_hot_key(df, key) else df.repartition(key)


def repeated_keys(df: DataFrame, key: str) -> list[int] | None:
    """The hashes that the keys of more than one row have; None if they are many, or the table is so small that its rows may as well be moved.

    One pass over the key's column tells about how many copies there are. If there are few, a hash per row is shuffled, and not the rows.
    """
    hashed = df.select(F.xxhash64(key).alias("hashed"))
    seen = hashed.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("hashed", 0.01).alias("keys")).first()
    if seen["rows"] < LEAST_ROWS or (seen["rows"] - seen["keys"]) * COPY_SHARE > seen["rows"]:
        return None
    copies = hashed.repartition("hashed").groupBy("hashed").agg(F.count(F.lit(1)).alias("copies"))
    found = copies.filter("copies > 1").select("hashed").limit(MOST_REPEATED + 1).collect()
    return [r[0] for r in found] if len(found) <= MOST_REPEATED else None


def keep_first_of(df: DataFrame, key: str, order_by: Sequence[str] | None, repeated: Sequence[int] | None) -> DataFrame:
    """`keep_first` where the keys that more than one row has may be known by their hashes: no other row is moved then."""
    if repeated is None:
        return keep_first(df, key, order_by)
    if not repeated:
        return df
    hashes = F.broadcast(df.sparkSession.createDataFrame(pa.table({"_hashed": pa.array(repeated, pa.int64())})))
    same = F.xxhash64(key) == F.col("_hashed")
    copies = keep_first(df.join(hashes, same, "left_semi"), key, order_by)
    return df.join(hashes, same, "left_anti").unionByName(copies)


def keep_first(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of every key; NULL keys count as one group.

    Distributed rows have no file order, so "first" is defined by `order_by`, by default all
    other columns: only equal rows can tie. Filtering on the row number lets Spark drop all but
    one row per key and task before the shuffle, so a key with a third of all rows stays cheap.
    """
    order = list(order_by) if order_by else [c for c in df.columns if c != key]
    window = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def removed_duplicates(df: DataFrame, key: str) -> DataFrame:
    """How many rows `keep_first` drops, without running it."""
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("kept"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("removed"),
    )
