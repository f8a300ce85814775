"""Best-fit packing of tokenised documents by bin completion.

Documents are tokenised where they are read; one that is longer than a sequence is cut from its
end, so that only its first piece is short. Which pieces share a sequence depends on their
lengths alone, and there are no more lengths than tokens in a sequence: the driver sees the number of
pieces of each length, whatever the data's size. It packs this histogram by branch and bound: around the
largest piece left, fillings that no other filling dominates are tried, the fullest first; a filling
is repeated as often as its pieces last; branches are cut by a bound on the waste; best-fit decreasing is the
first incumbent. The result is a list of fillings with their counts.

A piece then needs its rank among the pieces of its length: its place in the task that made it
plus an offset per task and length, both fixed by a written table. The rank says which sequence, and which
place in it, is the piece's. Defined cases: a NULL text is empty and gives the closing token alone;
repeated rows are packed one by one; columns besides id and text are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from salesloom.llm.common import kept, shipped

CAPACITY, END = 2048, 0
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"

Filling = dict[int, int]


class Encoder:
    """Token ids of a byte-level BPE vocabulary. `tiktoken` reads the same vocabulary several times as
    fast as `tokenizers` and gives the same ids (tests compare them); a text with the name of a special token goes
    to `tokenizers`, which treats it as that token."""

    def __init__(self, tokenizer: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        self.path = public_tokenizers.path(tokenizer)
        with open(public_tokenizers.path(ranks), "rb") as lines:
            vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.whole = None

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            return np.asarray(self.fast.encode_ordinary(text), "<u4")
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


def _tokenized(tokenizer: str, ranks: str, capacity: int, end: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, made = Encoder(tokenizer, ranks), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            owner, piece, start, length, crc, rank = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encoder.ids(text or ""), np.uint32(end)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for k, a in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[a : first if k == 0 else a + capacity]
                    owner.append(i), piece.append(k), start.append(a), length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes())), rank.append(int(made[len(part)]))
                    made[len(part)] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(owner), pa.int32()), pa.array(rank, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )

    return pieces


def best_fit(counts: Filling, capacity: int) -> list[tuple[int, Filling]]:
    """Best-fit decreasing on a histogram: each size goes into the fullest sequences that take it."""
    open_bins: dict[int, list[tuple[int, Filling]]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in open_bins if r >= size):
            bins = open_bins.pop(room)
            while bins and left:
                n, filling = bins.pop()
                each = room // size
                full, rest = divmod(left, each)
                for number, take in ((min(n, full), each), (1 if full < n and rest else 0, rest)):
                    if number:
                        open_bins.setdefault(room - take * size, []).append((number, filling | {size: take}))
                        left -= number * take
                        n -= number
                if n:
                    bins.append((n, filling))
                    break
            if bins:
                open_bins.setdefault(room, []).extend(bins)
            if not left:
                break
        each = capacity // size
        for number, take in ((left // each, each), (1 if left % each else 0, left % each)):
            if number:
                open_bins.setdefault(capacity - take * size, []).append((number, {size: take}))
    return [b for bins in open_bins.values() for b in bins]


def fillings(counts: Filling, sizes: list[int], capacity: int, width: int, steps: int) -> list[Filling]:
    """Fillings around the largest size, the fullest first. `sizes` are those left, ascending. Each size is tried as often
    as it fits and any less. A filling is left out if a piece that is left still fits in, or if a larger one
    could stand for one of its pieces, as that one dominates it."""
    largest = sizes[-1]
    found: list[tuple[int, int, Filling]] = []
    budget = steps

    def grow(room: int, below: int, chosen: Filling) -> bool:
        """True once a perfect filling is found."""
        nonlocal budget
        budget -= 1
        at = bisect_right(sizes, min(room, below)) - 1
        if at < 0 or room == 0:
            found.append((room, sum(chosen.values()), dict(chosen)))
            return room == 0
        tried = 0
        while at >= 0 and budget > 0 and tried < width:
            size = sizes[at]
            already = chosen.get(size, 0)
            most = min(counts[size] - already, room // size)
            if most > 0:
                tried += 1
                # Fewer of the smallest size only leave room for more of it.
                for take in range(most, 0 if at else most - 1, -1):
                    if budget <= 0:
                        break
                    chosen[size] = already + take
                    if grow(room - take * size, size - 1, chosen):
                        return True
                if already:
                    chosen[size] = already
                else:
                    del chosen[size]
            at -= 1
        return False

    grow(capacity - largest, largest, {largest: 1})

    def dominated(room: int, filling: Filling) -> bool:
        if any(counts[size] > filling.get(size, 0) for size in sizes[: bisect_right(sizes, room)]):
            return True
        for size in filling:
            if size == largest:
                continue
            larger = bisect_right(sizes, size + room) - 1
            if larger >= 0 and sizes[larger] > size and counts[sizes[larger]] > filling.get(sizes[larger], 0):
                return True
        return False

    best = sorted((f for f in found if not dominated(f[0], f[2])), key=lambda f: f[:2]) or sorted(found, key=lambda f: f[:2])
    return [f for _, _, f in best[:width]]


def bin_completion(counts: Filling, capacity: int = CAPACITY, width: int = 4, steps: int = 400, nodes: int = 6000) -> list[tuple[int, Filling]]:
    """(how often, filling) of a packing into few sequences. `nodes` bounds the search, which returns its
    best packing so far when they are used up."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    fewest = sum(n for n, _ in best)
    least = -(-sum(s * n for s, n in counts.items()) // capacity)
    left, sizes = dict(counts), sorted(counts)
    total, used, path, choices = sum(s * n for s, n in counts.items()), 0, [], []
    choices.append(fillings(left, sizes, capacity, width, steps)[::-1])
    while choices and fewest > least and nodes > 0:
        if not choices[-1]:
            choices.pop()
            if path:
                often, filling = path.pop()
                used -= often
                for s, n in filling.items():
                    total += s * n * often
                    if not left[s]:
                        sizes.insert(bisect_right(sizes, s), s)
                    left[s] += n * often
            continue
        nodes -= 1
        filling = choices[-1].pop()
        often = min(left[s] // n for s, n in filling.items())
        for s, n in filling.items():
            left[s] -= n * often
            total -= s * n * often
            if not left[s]:
                sizes.remove(s)
        used += often
        path.append((often, filling))
        if used + -(-total // capacity) >= fewest:
            choices.append([])  # too much is wasted already
        elif sizes:
            choices.append(fillings(left, sizes, capacity, width, steps)[::-1])
        else:
            fewest, best = used, list(path)
            choices.append([])
    return best


def _allotments(packing: list[tuple[int, Filling]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, pieces per sequence, offset of the first) by rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: Filling = {}
    sequence = 0
    for often, filling in packing:
        offset = 0
        for size in sorted(filling, reverse=True):
            rank = taken.get(size, 0)
            rows.setdefault(size, []).append((rank, sequence, filling[size], offset))
            taken[size] = rank + filling[size] * often
            offset += size * filling[size]
        sequence += often
    return {size: np.array(r, np.int64) for size, r in rows.items()}


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, end: int = END, tokenizer: str = TOKENIZER, ranks: str = RANKS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"
    source = shipped(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    pieces = kept(source.mapInArrow(_tokenized(tokenizer, ranks, capacity, end), schema), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    allotments = _allotments(bin_completion(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length).tolist():
                mine, rows = np.flatnonzero(length == size), allotments[size]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
                many, place_in = np.divmod(rank[mine] - row[:, 0], row[:, 2])
                sequence[mine], offset[mine] = row[:, 1] + many, row[:, 3] + place_in * size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[id_column, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(offsets, ["length", "task"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")
    )
    out = f"`{id_column}` {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, out)
