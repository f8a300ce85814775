"""Sharding by bytes: the minimax contiguous partition of atomic groups.

Documents of equal text form a group that is never cut. Groups are ordered by a hash of their text,
and cut into contiguous shards whose largest is as small as possible: a binary search over the
capacity, checked greedily. The sizes stay in Spark. The driver sees a histogram over 4,096 ranges of
the hash. If ranges of several groups could be cut anywhere, the least capacity would be a lower bound, as is the
largest group; those ranges that its cuts fall into, one a shard at most, are counted again in 64 finer
ranges each, until no cut falls within a range of several groups. Then the bound is a partition of whole groups, and the
optimum. So a round collects 64 rows a shard at most, whatever the data's size and its groups', and there are few
rounds for each level of the hash that it takes to tell two groups apart.

Places within a shard come from a range partitioning, written once, and one offset per task and
shard. Defined cases: a NULL text counts as empty; repeated rows are documents of their own in
one group; there may be empty shards; columns besides id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from salesloom.llm.common import kept
from salesloom.operators.keys import ROW_BITS

#: Bits of the hash that name a range, at first and in each finer histogram.
FIRST_BITS, MORE_BITS, ALL_BITS = 12, 6, 64


def greedy_cuts(ends: np.ndarray, shards: int, capacity: int) -> list[int]:
    """Cells in the first shard, the first two, and so on, each filled as far as the capacity allows; `ends`
    are running sums of the cells' sizes."""
    cuts, done = [], 0
    for _ in range(shards):
        at = int(np.searchsorted(ends, done + capacity, side="right"))
        done = int(ends[at - 1]) if at else 0
        cuts.append(at)
    return cuts


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The least capacity with which `shards` contiguous shards hold all cells."""
    ends = np.cumsum(sizes)
    low = max(int(sizes.max(initial=0)), -(-int(sizes.sum()) // shards))
    high = int(sizes.sum())
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ends, shards, middle)[-1] == len(sizes):
            high = middle
        else:
            low = middle + 1
    return low


#: A range of keys: the first key, bytes, groups, and the bits that name it.
Cell = tuple[int, int, int, int]


def _histogram(groups: DataFrame, cells: list[Cell], bits: int) -> list[Cell]:
    """The finer ranges of some cells, by so many more bits; a row for each that has groups."""
    cell, place = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for i, (first, _, _, own) in enumerate(cells):
        inside = F.shiftright("key", ALL_BITS - own) == F.lit(first >> (ALL_BITS - own)) if own else F.lit(True)
        cell = F.when(inside, F.lit(i)).otherwise(cell)
        place = F.when(inside, F.shiftright("key", ALL_BITS - min(ALL_BITS, own + bits))).otherwise(place)
    counted = groups.select(cell.alias("cell"), place.alias("range"), "bytes").filter("cell IS NOT NULL")
    rows = counted.groupBy("cell", "range").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()
    named = [(r["range"], min(ALL_BITS, cells[r["cell"]][3] + bits), r["bytes"], r["n"]) for r in rows]
    return [(place << (ALL_BITS - own), size, n, own) for place, own, size, n in named]


def relaxed_cuts(ends: np.ndarray, whole: np.ndarray, shards: int, capacity: int) -> list[tuple[int, bool]] | None:
    """Where greedy shards end if all cells but the `whole` ones can be cut anywhere, as (cell, whether within it); None if
    the shards do not hold all cells."""
    cuts, done = [], 0
    for _ in range(shards):
        at = int(np.searchsorted(ends, done + capacity, side="right"))
        if at == len(ends):
            return cuts
        start = int(ends[at - 1]) if at else 0
        inside = not whole[at] and done + capacity > start
        done = done + capacity if inside else start
        cuts.append((at, inside))
    return None


def cut_keys(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """The first key of each shard but the first, and the capacity. `groups` has (key, bytes), a row per group."""
    largest = groups.agg(F.max("bytes")).first()[0]
    if largest is None:
        return [], 0
    cells = sorted(_histogram(groups, [(0, 0, 0, 0)], FIRST_BITS))
    while True:
        ends = np.cumsum(np.array([c[1] for c in cells], np.int64))
        whole = np.array([c[2] == 1 or c[3] == ALL_BITS for c in cells])
        low, high = max(int(largest), -(-int(ends[-1]) // shards)), int(ends[-1])
        while low < high:
            middle = (low + high) // 2
            if relaxed_cuts(ends, whole, shards, middle) is None:
                low = middle + 1
            else:
                high = middle
        cuts = relaxed_cuts(ends, whole, shards, low)
        within = sorted({at for at, inside in cuts if inside})
        if not within:
            keys = [cells[at][0] for at, _ in cuts]
            return keys + [None] * (shards - 1 - len(keys)), low
        finer = _histogram(groups, [cells[i] for i in within], MORE_BITS)
        cells = sorted([c for i, c in enumerate(cells) if i not in set(within)] + finer)


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot."""
    text = F.coalesce(text_column, F.lit(""))
    sized = kept(
        docs.select(
            F.col(id_column).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("key"),
        ),
        "sized",
    )
    groups = kept(sized.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    cuts, _ = cut_keys(groups, shards)
    shard = F.lit(0)
    for key in cuts:
        if key is not None:
            shard = shard + (F.col("key") >= F.lit(key)).cast("int")
    ordered = sized.withColumn("shard", shard).repartitionByRange("shard", "id", "key").sortWithinPartitions("shard", "id", "key")
    placed = kept(ordered.withColumn("place", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("place", ROW_BITS)
    before = W.partitionBy("shard").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    # A row per task and shard in it: at most tasks + shards rows, as the tasks' ranges follow each other.
    offsets = (
        placed.groupBy("shard", task.alias("task"))
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .select("shard", "task", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    return (
        placed.withColumn("task", task)
        .join(F.broadcast(offsets), ["shard", "task"])
        .select(F.col("id").alias(id_column), "size", "text_crc32", "shard", (F.col("place") - F.col("first") + F.col("offset")).alias("slot"))
    )


def sharding_report(docs: DataFrame, shards: int = 16) -> DataFrame:
    return shard_by_bytes(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
