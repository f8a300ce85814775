"""Questions about single words or windows of all documents, asked by the batch.

A question such as "how often does this word occur anywhere" or "is this window in an earlier
document" has as many keys as the corpus has words. Rows of one key each would cost more than
the work itself. Here documents are dealt into batches of a few megabytes of text; a batch asks once
for each of its distinct keys, packed into one row per range of keys; a range answers each
batch in one row; and the batch, met again by a cogroup, finishes its documents.

A key that a third of all documents hold is one entry per batch, not one per document, so no hot
key exists. Batches and ranges are bounded in bytes and grow in number with the data. The documents are
shuffled once: both readings of the batches share that exchange.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import shipped

BATCH_BYTES, RANGE_BYTES = 4 << 20, 16 << 20


def in_batches(docs: DataFrame, text: Column, spread: Column, **columns: Column) -> tuple[DataFrame, int]:
    """The documents with a batch number, dealt out by it, and the number of key ranges to use."""
    total = shipped(docs).agg(F.sum(F.octet_length(text))).first()[0] or 0
    batches, ranges = (max(1, -(-total // size)) for size in (BATCH_BYTES, RANGE_BYTES))
    batch = F.pmod(F.xxhash64(spread), F.lit(batches)).alias("batch")
    dealt = docs.select(batch, text.alias("text"), *[c.alias(n) for n, c in columns.items()]).repartition("batch")
    return dealt, int(ranges)


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def by_range(to: np.ndarray) -> dict[int, np.ndarray]:
    """The places of each range's keys, in their order; one sort, however many ranges there are."""
    order = np.argsort(to, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(to[order])) + 1)
    return {int(to[part[0]]): part for part in parts if len(part)}


def packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Integers as bytes: differences if they ascend, then byte by byte of all, compressed."""
    if ascending and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    values = np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if ascending else values
