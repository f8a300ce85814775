"""Dense surrogate keys without a single-task numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from salesloom.sources.store import Store

# monotonically_increasing_id packs the task's number above 33 bits of row position.
ROW_BITS = 33


def dense_key(df: DataFrame, id_column: str, key_column: str, store: Store, name: str) -> DataFrame:
    """Number the rows 1..n in the order of `id_column`.

    The rows are range-partitioned by id (ids are unique here, so the ranges are even), sorted
    within their partition and written with their partition number and position. The written copy fixes
    both, so a lost executor cannot renumber anything. Row counts per partition, one row per
    task, then give each partition its offset.
    """
    ordered = df.repartitionByRange(id_column).sortWithinPartitions(id_column)
    placed = store.save(ordered.withColumn("_place", F.monotonically_increasing_id()), f"{name}_placed")
    part = F.shiftright("_place", ROW_BITS)
    position = F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + position + 1).alias(key_column), *df.columns)
    )
