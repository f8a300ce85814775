"""Periodic runs of words: every maximal stretch that repeats itself, by descending-LCP Kruskal.

A run is a stretch of consecutive words of one document with smallest period q and length at least
max(`least`, 2q) that no neighbouring word extends keeping that period. Its first word i and the word i + q
begin suffixes that agree in length - q >= least / 2 words, and no word between begins one that agrees as far. So:

1. Suffixes are sorted by prefix doubling, as far as they share their first least / 2 words with another suffix of
   the document; all others are classes by themselves at every level that matters. The ranks of each doubling also
   give the common prefix (LCP) of neighbours in the sorted order.
2. Those neighbours are edges of a path. By decreasing LCP a union-find unites their classes; a class is an ordered set
   of positions, and the smaller set goes into the larger.
3. Two positions that become neighbours in a set at level l, and whose distance d is at most l, are the seed of a run
   of period d and l + d words. It counts if the words before the two differ (else the run begins further
   left) and if they still are neighbours once the whole level is united (else the period is a smaller one).

Everything happens within a document, so documents stay where they are read: no shuffle, and no group. A piece of
four megabytes of texts is sorted at once in numpy; a longer text is a piece by itself. The work is
n log n for n words of a text, whatever it repeats.

Defined cases: a NULL or empty text has no words, no runs and an empty kept text; repeated rows and rows with NULL ids are judged
one by one; an empty table gives no rows; columns besides id and text are not looked at, whatever their names.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import SPACES, shipped, split_words
from salesloom.llm.words import SPACED, Words, find_words, mix, slices

LEAST = 12


class _Suffixes:
    """The suffixes of all texts that share their first `gram` words with another one of their text, in sorted order.
    Positions count all words of a piece, with one place before each text and after the last that holds no word."""

    def __init__(self, words: Words, gram: int):
        owner = words.owner
        self.laid = np.zeros(len(words.hashes) + len(words.counts) + gram + 1, np.uint64)
        self.laid[np.arange(len(owner)) + owner + 1] = words.hashes
        self.base = words.first + np.arange(len(words.counts)) + 1
        runs, inside = words.runs(gram)
        starts = np.flatnonzero(inside)
        keys = mix(runs[starts] + owner[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        starts = starts[order[np.r_[same, False] | np.r_[False, same]]]
        shared = starts + owner[starts] + 1
        self.levels: list[tuple[int, np.ndarray]] = []
        self.sorted = self._sort(np.unique(np.r_[shared, shared + gram]), gram)

    def _sort(self, places: np.ndarray, gram: int) -> np.ndarray:
        """Positions in the order of their suffixes. A level's rank is the first place of the class that shares so many words."""
        texts = np.searchsorted(self.base, places, side="right")
        columns = [self.laid[places + j] for j in range(gram)]
        order = np.lexsort((*columns[::-1], texts))
        new = np.zeros(len(places), bool)
        for column in (texts, *columns):
            new[1:] |= np.diff(column[order]) != 0
        new[:1] = True
        # What is not sorted shares nothing: a rank of its own.
        rank = -1 - np.arange(len(self.laid))
        rank[places[order]] = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
        length, open_places = gram, places[order][~new | np.r_[~new[1:], False]]
        while True:
            self.levels.append((length, rank))
            if not len(open_places):
                return places[np.argsort(rank[places])]
            first, second = rank[open_places], rank[open_places + length]
            order = np.lexsort((second, first))
            first, second, open_places = first[order], second[order], open_places[order]
            opens = np.r_[True, np.diff(first) != 0]
            new = opens | np.r_[True, np.diff(second) != 0]
            at = np.arange(len(first))
            within = at - np.maximum.accumulate(np.where(opens, at, 0))
            rank = rank.copy()
            rank[open_places] = first + np.maximum.accumulate(np.where(new, at, 0)) - at + within
            open_places, length = open_places[~new | np.r_[~new[1:], False]], 2 * length

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in the sorted order whose suffix shares a gram with the next one's, and how many words it shares."""
        gram, classes = self.levels[0]
        at = np.flatnonzero(classes[self.sorted[:-1]] == classes[self.sorted[1:]]) if len(self.sorted) else np.zeros(0, np.int64)
        one, two = self.sorted[at], self.sorted[at + 1]
        shared = np.zeros(len(at), np.int64)
        for length, rank in reversed(self.levels):
            shared += np.where(rank[one + shared] == rank[two + shared], length, 0)
        more = np.ones(len(at), bool)
        for _ in range(gram - 1):
            word = self.laid[one + shared]
            more &= (word == self.laid[two + shared]) & (word != 0)
            shared += more
        return at, shared


def _seeds(places: list[int], before: dict[int, int], edges: list[int], shared: list[int]) -> list[tuple[int, int, int]]:
    """(first position, its next neighbour, level) of each run; the edges come by decreasing level."""
    parent, members = list(range(len(places))), [[p] for p in places]
    found: list[tuple[int, int, int]] = []
    waiting: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def settle(level: int) -> None:
        for node, i, j in waiting:
            own = members[root(node)]
            if own[bisect_left(own, i) + 1] == j:
                found.append((i, j, level))
        waiting.clear()

    level = 0
    for edge, at in zip(edges, shared, strict=True):
        if at != level:
            settle(level)
            level = at
        a, b = root(edge), root(edge + 1)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        parent[b], large, small = a, members[a], members[b]
        members[b] = []
        if 8 * len(small) < len(large) or len(small) == 1:
            for x in small:
                k = bisect_left(large, x)
                if k and x - large[k - 1] <= level and before[x] != before[large[k - 1]]:
                    waiting.append((a, large[k - 1], x))
                if k < len(large) and large[k] - x <= level and before[x] != before[large[k]]:
                    waiting.append((a, x, large[k]))
                large.insert(k, x)
        else:
            moved = set(small)
            large += small
            large.sort()
            for i, j in zip(large, large[1:]):
                if j - i <= level and (i in moved) != (j in moved) and before[i] != before[j]:
                    waiting.append((a, i, j))
    settle(level)
    return found


def find_runs(words: Words, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run, by text, start and period."""
    suffixes = _Suffixes(words, max(1, least // 2))
    at, shared = suffixes.edges()
    order = np.argsort(-shared, kind="stable")
    places = suffixes.sorted
    before = dict(zip(places.tolist(), suffixes.laid[places - 1].tolist(), strict=True))
    seeds = np.array(_seeds(places.tolist(), before, at[order].tolist(), shared[order].tolist()), np.int64).reshape(-1, 3)
    first, period = seeds[:, 0], seeds[:, 1] - seeds[:, 0]
    length = seeds[:, 2] + period
    text = np.searchsorted(suffixes.base, first, side="right") - 1
    start = first - suffixes.base[text] if len(first) else first
    order = np.lexsort((period, start, text))
    order = order[length[order] >= least]
    return text[order], start[order], length[order], period[order]


def _kept_text(text: bytes, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words joined by a space, of each run only the first period."""
    words = text.split()  # at the same six bytes that SPACED leaves out
    if not len(start):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _runs_of(least: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = find_words(part.column("text"), SPACED, lower=False)
                text, start, length, period = find_runs(words, least)
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
                kept = [
                    _kept_text((t or "").encode(), start[a:b], length[a:b], period[a:b])
                    for t, a, b in zip(part.column("text").to_pylist(), cuts[:-1], cuts[1:], strict=True)
                ]
                fields = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(words.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), fields), pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["id", "n_words", "runs", "kept_text"],
                )

    return runs


def periodic_runs(docs: DataFrame, least: int = LEAST, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period; by start and period) and kept_text, the words of
    which of each run only the first period is left."""
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"id {id_type}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept_text string"
    source = shipped(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(_runs_of(least), schema).withColumnRenamed("id", id_column)


def with_planted_runs(text: Column, key: Column) -> Column:
    """The text, of a tenth of all keys with a period planted: each word i >= a becomes the word a + (i - a) % p. A NULL key plants none."""
    h = F.crc32(F.encode(key.cast("string"), "UTF-8"))
    g, words = F.floor(h / 10), split_words(text, SPACES)
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), planted).otherwise(text)


def runs_report(docs: DataFrame) -> DataFrame:
    """Figures and digests of the runs of each document, a tenth of which have one planted."""
    planted = docs.select("doc_id", with_planted_runs(F.col("text"), F.col("doc_id")).alias("text"))
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    sha256 = lambda x: F.sha2(F.encode(x, "UTF-8"), 256)
    return (
        periodic_runs(planted)
        .withColumn("best", longest)
        .select(
            "doc_id", F.size(runs).cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
            (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
            sha256(F.array_join(F.transform(runs, line), "")).alias("runs_sha256"), sha256(F.col("kept_text")).alias("collapsed_sha256"),
        )
    )
