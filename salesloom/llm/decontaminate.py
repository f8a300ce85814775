"""Benchmark decontamination by winnowing.

Documents and benchmark items are cut into word k-grams; of every `span` consecutive words the
k-gram with the smallest hash is kept. Two texts that share a window of `span` words choose the
same k-gram in it, so joining the fingerprints finds every shared window. A hit carries the words
around its k-gram, as many as a window can reach: it is confirmed and extended where it was
found, and no text is moved at all. Items shorter than a window count as one window of their own
length; documents then offer all their grams of that length.

A table of the first bits of the items' fingerprints, of fixed size, keeps grams that cannot match from
leaving their task; it only prunes, and a benchmark of any size is joined the same way. Spark broadcasts
the items while they are small and otherwise shuffles both sides, splitting hot fingerprints.

Defined cases: NULL texts have no words; items without words are never found; repeated
documents are judged one by one, repeated items count once; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import shipped
from salesloom.llm.words import LETTERS, Words, find_words, slices

SPAN, GRAM = 10, 5
PRUNING_BITS = 20
_SHORT = np.uint64(0xA24BAED4963EE407)
_GRAMS = pa.schema(
    [
        ("key", pa.int64()), ("place", pa.int64()), ("gram", pa.string()),
        ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())),
    ]
)


def winnow(words: Words, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the chosen k-grams: in every `span` words of one text the smallest, the first of equals."""
    grams, _ = words.runs(k)
    _, windows = words.runs(span)
    least = np.full(len(windows), np.iinfo(np.uint64).max, np.uint64)
    width = span - k + 1
    for j in range(width):
        least = np.minimum(least, grams[j : j + len(windows)])
    chosen, found = np.zeros(len(grams), bool), ~windows
    for j in range(width):
        new = ~found & (grams[j : j + len(windows)] == least)
        chosen[j : j + len(windows)][new] = True
        found |= new
    places = np.flatnonzero(chosen)
    return places, grams[places]


def _whole_grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams, with hashes that no winnowed gram has."""
    grams, inside = words.runs(n)
    places = np.flatnonzero(inside)
    return places, grams[places] ^ (_SHORT * np.uint64(n))


def _rows(words: Words, places: np.ndarray, hashes: np.ndarray, length: int, reach: int) -> list[np.ndarray | list]:
    """The owner of each gram, and the columns of _GRAMS."""
    owner = words.owner
    first, own = words.first, owner[places] if len(places) else np.zeros(0, np.int64)
    low, high = first[own], first[own] + words.counts[own]
    grams, before, after = [], [], []
    for p, a, b in zip(places.tolist(), low.tolist(), high.tolist(), strict=True):
        grams.append(words.text(p, p + length))
        before.append(words.text(max(a, p - reach), p).split(" ")[::-1] if p > a and reach else [])
        after.append(words.text(p + length, min(b, p + length + reach)).split(" ") if p + length < b and reach else [])
    return [own, hashes.view(np.int64), places - low, grams, before, after]


def _item_grams(span: int, k: int):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = find_words(part.column("text"), LETTERS, lower=True)
                short = words.counts < span
                found = [(_rows(words, *winnow(words, span, k), k, span - k), k, span)]
                for n in np.unique(words.counts[short & (words.counts > 0)]).tolist():
                    places, hashes = _whole_grams(words, n)
                    mine = words.counts[words.owner[places]] == n
                    found.append((_rows(words, places[mine], hashes[mine], n, 0), n, n))
                for (own, *columns), length, need in found:
                    arrays = [part.column("item").take(pa.array(own)), *[pa.array(c, f.type) for c, f in zip(columns, _GRAMS, strict=True)]]
                    sizes = [pa.array(np.full(len(own), x, np.int64)) for x in (length, need)]
                    yield pa.RecordBatch.from_arrays(arrays + sizes, names=["item", *_GRAMS.names, "length", "need"])

    return grams


def _document_grams(span: int, k: int, short: list[int], pruning: np.ndarray):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(pruning).astype(bool)
        for batch in batches:
            for part in slices(batch, "text"):
                words = find_words(part.column("text"), LETTERS, lower=True)
                found = [(*winnow(words, span, k), k, span - k)] + [(*_whole_grams(words, n), n, 0) for n in short]
                # The document itself, with a key of its own so that these rows spread.
                rows = np.frombuffer(part.column("row").cast(pa.int64()).to_numpy().tobytes(), np.int64)
                nothing = [[None] * len(rows)] * 3
                groups = [[np.arange(len(rows)), rows, np.full(len(rows), -1, np.int64), *nothing]]
                for places, hashes, length, reach in found:
                    maybe = known[(hashes >> np.uint64(64 - PRUNING_BITS)).astype(np.int64)]
                    groups.append(_rows(words, places[maybe], hashes[maybe], length, reach))
                for own, *columns in groups:
                    ids = [part.column(c).take(pa.array(own)) for c in ("row", "id")]
                    n_words = pa.array(words.counts[own].astype(np.int64))
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, _GRAMS, strict=True)]
                    yield pa.RecordBatch.from_arrays([*ids, n_words, *arrays], names=["row", "id", "n_words", *_GRAMS.names])

    return grams


def _common(a: str, b: str) -> Column:
    """How many leading elements of two arrays are equal."""
    equal = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(equal, False)
    return F.when(differs == 0, F.size(equal)).otherwise(differs - 1)


def _covered(spans: Column) -> Column:
    """Words in the union of (start, stop) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.array_sort(spans),
        start,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["stop"]).alias("end"),
        ),
        lambda a: a["n"],
    )


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = GRAM,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
) -> DataFrame:
    """One row per document: id, n_words, n_hit, `spans` of hit words and the `items` found, sorted."""
    types = "key bigint, place bigint, gram string, before array<string>, after array<string>"
    named = shipped(benchmark).select(F.col(item_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    items = named.mapInArrow(_item_grams(span, k), f"item string, {types}, length bigint, need bigint")
    facts = items.select(F.shiftrightunsigned("key", 64 - PRUNING_BITS).alias("bits"), F.when(F.col("need") < span, F.col("need")).alias("short"))
    # At most 2^PRUNING_BITS x span rows, however large the benchmark is.
    seen = facts.distinct().toPandas()
    table = np.zeros(1 << PRUNING_BITS, bool)
    table[seen["bits"].to_numpy(np.int64)] = True
    short = sorted({int(n) for n in seen["short"].dropna()})
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    grams = rows.mapInArrow(_document_grams(span, k, short, np.packbits(table)), f"row bigint, id {id_type}, n_words bigint, {types}")
    other = items.select("item", "length", "need", *[F.col(n).alias(f"i_{n}") for n in _GRAMS.names])
    joined = grams.join(other, (F.col("key") == F.col("i_key")) & (F.col("place") >= 0) & (F.col("gram") == F.col("i_gram")), "left")
    left, right = _common("before", "i_before"), _common("after", "i_after")
    hits = joined.withColumns({"start": F.col("place") - left, "stop": F.col("place") + F.col("length") + right}).filter(
        (F.col("place") < 0) | (F.col("stop") - F.col("start") >= F.col("need"))
    )
    is_hit = F.col("place") >= 0
    return (
        hits.groupBy("row", "id", "n_words")
        .agg(
            F.collect_set(F.when(is_hit, F.struct("start", "stop"))).alias("spans"),
            F.array_sort(F.collect_set(F.when(is_hit, F.col("item")))).alias("items"),
        )
        .select(F.col("id").alias(id_column), "n_words", _covered(F.col("spans")).alias("n_hit"), "spans", "items")
    )


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark window; ids are taken to be unique, rows without an id are kept."""
    leaked = find_leaks(docs, benchmark).filter("n_hit > 0").select("doc_id")
    # Dealt out by id at every size, as a large corpus must be.
    return docs.join(leaked.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
