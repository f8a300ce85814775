"""Removal of text that repeats across documents, word by word.

`remove_repeats` judges every window of `length` words of all documents: a window that an earlier
document (one with a smaller id) holds too is removed, and so is each word in it. Windows are
hashed in numpy; a batch of documents asks, for each distinct window, whether a smaller id has
it elsewhere (see exchange.py); within a batch the smallest id is known anyway. A window is told
apart by 64 bits and the range it falls into, whose number grows with the data.

`remove_reference` removes what a bounded reference holds: the reference is cut into shards, a
suffix automaton of each is broadcast, documents stream through it for their matching
statistics, and maximal spans of `length` words or more are removed. This is the method meant for
the whole operator. Against itself a corpus cannot use it: every document would stream past the automata
of all shards, work that grows with the square of the corpus (figures in the README).

Defined cases: a NULL text has no words; a NULL id counts as the largest, and so never as
the earlier one; rows with the same id keep what only they share; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import shipped
from salesloom.llm.exchange import by_range, in_batches, packed, range_of, unpacked
from salesloom.llm.words import SPACED, Words, find_words, slices

LENGTH = 13
NO_ID = np.iinfo(np.int64).max
REFERENCE_WORDS, SHARD_WORDS = 2_000_000, 250_000


def _windows(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, list[Words], np.ndarray]:
    """Hashes of all windows of a batch by ascending document id, the document of each, the words, the ids."""
    ids = table.column("id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    rows = table.take(pa.array(order)).combine_chunks()
    hashes, owners, words, done = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], 0
    for part in slices(rows, "text"):
        found = find_words(part.column("text"), SPACED, lower=False)
        own, inside = found.runs(length)
        hashes.append(own[inside])
        owners.append(done + found.owner[: len(inside)][inside])
        words.append(found)
        done += part.num_rows
    return np.concatenate(hashes), np.concatenate(owners), words, ids[order]


def _ask(length: int, ranges: int):
    def ask(table: pa.Table) -> pa.Table:
        hashes, owners, _, ids = _windows(table, length)
        keys, first = np.unique(hashes, return_index=True)
        to, holder = range_of(keys * np.uint64(0x9FB21C651E98DF25) ^ (keys >> np.uint64(29)), ranges), owners[first]
        rows = []
        for r, places in by_range(to).items():
            # Only the ids that hold one of these keys, so that a row is bounded by its keys.
            own, holders = np.unique(holder[places], return_inverse=True)
            rows.append((r, packed(keys[places], True), packed(holders.astype(np.uint32)), packed(ids[own], True)))
        batch = table.column("batch")[0].as_py()
        return pa.table(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([batch] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary()),
            ],
            names=["range", "batch", "keys", "holders", "ids"],
        )

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """For each batch the windows whose smallest holder is elsewhere and smaller than the batch's own."""
    batches = table.column("batch").to_pylist()
    keys = [unpacked(k, np.uint64, True) for k in table.column("keys").to_pylist()]
    ids = [
        unpacked(i, np.int64, True)[unpacked(h, np.uint32)]
        for h, i in zip(table.column("holders").to_pylist(), table.column("ids").to_pylist(), strict=True)
    ]
    sizes = [len(k) for k in keys]
    all_keys, all_ids = np.concatenate(keys), np.concatenate(ids)
    order = np.argsort(all_keys, kind="stable")
    ordered = all_keys[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    least = np.minimum.reduceat(all_ids[order], starts)
    earlier = np.empty(len(order), bool)
    earlier[order] = np.repeat(least, np.diff(np.r_[starts, len(order)])) < all_ids[order]
    ends = np.cumsum(sizes)
    found = [(b, k[earlier[e - n : e]]) for b, k, n, e in zip(batches, keys, sizes, ends, strict=True)]
    found = [(b, packed(k, True)) for b, k in found if len(k)]
    return pa.table(
        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], names=["batch", "keys"]
    )


def _kept_text(words: Words, covered: np.ndarray) -> list[str]:
    data, places = words.data.tobytes(), list(zip(words.start.tolist(), words.end.tolist(), strict=True))
    keep, out, at = (~covered).tolist(), [], 0
    for n in words.counts.tolist():
        out.append(b" ".join(data[a:b] for a, b in compress(places[at : at + n], keep[at : at + n])).decode())
        at += n
    return out


def _cover(starts: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n words lie in spans of that length from those starts."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:n]) > 0


def _finish(length: int, id_type: pa.DataType):
    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, owners, all_words, ids = _windows(table, length)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        least = ids[owners[first]]
        for data in answers.column("keys").to_pylist():
            least[np.searchsorted(keys, unpacked(data, np.uint64, True))] = np.iinfo(np.int64).min
        repeated = least[inverse] < ids[owners]
        n_words, n_removed, texts, at = [], [], [], 0
        for words in all_words:
            inside = words.runs(length)[1]
            starts = np.flatnonzero(inside)[repeated[at : at + int(inside.sum())]]
            at += int(inside.sum())
            covered = _cover(starts, length, len(words.hashes))
            n_words.append(words.counts)
            n_removed.append(np.bincount(words.owner[covered], minlength=len(words.counts)))
            texts += _kept_text(words, covered)
        return pa.table(
            [
                pa.array(ids, pa.int64(), mask=ids == NO_ID).cast(id_type), pa.array(np.concatenate(n_words).astype(np.int64)),
                pa.array(np.concatenate(n_removed).astype(np.int64)), pa.array(texts, pa.string()),
            ],
            names=["id", "n_words", "n_removed", "kept_text"],
        )

    return finish


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed and kept_text, its other words joined by a space."""
    key = F.col(id_column).cast("long")
    batches, ranges = in_batches(docs, F.coalesce(text_column, F.lit("")), F.struct(key, F.col(text_column)), id=key)
    questions = batches.groupBy("batch").applyInArrow(
        _ask(length, ranges), "range bigint, batch bigint, keys binary, holders binary, ids binary"
    )
    answers = questions.groupBy("range").applyInArrow(_answer, "batch bigint, keys binary")
    out = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _finish(length, pa.int64()), "id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
    return out.select(F.col("id").cast(docs.schema[id_column].dataType).alias(id_column), "n_words", "n_removed", "kept_text")


class SuffixAutomaton:
    """All word sequences of some texts. A state is a set of end places; `longest` its longest sequence."""

    def __init__(self, texts: list[list[int]]):
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        for text in texts:
            last = 0
            for word in text:
                last = self._extend(last, word)

    def _state(self, steps: dict[int, int], link: int, longest: int) -> int:
        self.steps.append(steps), self.link.append(link), self.longest.append(longest)
        return len(self.link) - 1

    def _split(self, before: int, word: int, known: int) -> int:
        copy = self._state(dict(self.steps[known]), self.link[known], self.longest[before] + 1)
        self.link[known] = copy
        while before >= 0 and self.steps[before].get(word) == known:
            self.steps[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.steps[last].get(word)
        if known is not None:
            return known if self.longest[known] == self.longest[last] + 1 else self._split(last, word, known)
        new, before = self._state({}, 0, self.longest[last] + 1), last
        while before >= 0 and word not in self.steps[before]:
            self.steps[before][word] = new
            before = self.link[before]
        if before >= 0:
            known = self.steps[before][word]
            self.link[new] = known if self.longest[known] == self.longest[before] + 1 else self._split(before, word, known)
        return new

    def matching(self, text: list[int]) -> np.ndarray:
        """For each word, how many words up to it are a sequence of the texts."""
        state, length, out = 0, 0, np.zeros(len(text), np.int64)
        for i, word in enumerate(text):
            while state and word not in self.steps[state]:
                state = self.link[state]
                length = self.longest[state]
            if word in self.steps[state]:
                state, length = self.steps[state][word], length + 1
            out[i] = length
        return out


def remove_reference(docs: DataFrame, reference: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As `remove_repeats`, for what stands in a reference of at most REFERENCE_WORDS words; `docs` lose it all."""
    n_words = F.size(F.split(F.coalesce(text_column, F.lit("")), r"[\x20\x09-\x0D]+"))
    total = reference.agg(F.sum(n_words)).first()[0] or 0
    if total > REFERENCE_WORDS:
        raise ValueError(f"the reference has {total} words, and its automata may be broadcast up to {REFERENCE_WORDS}")
    spark, shards = docs.sparkSession, [[]]
    for row in reference.select(text_column).toLocalIterator():
        words = find_words(pa.array([row[0]], pa.string()), SPACED, lower=False).hashes.tolist()
        if sum(map(len, shards[-1])) > SHARD_WORDS:
            shards.append([])
        shards[-1].append(words)
    automata = [spark.sparkContext.broadcast(SuffixAutomaton(shard)) for shard in shards]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = find_words(part.column("text"), SPACED, lower=False)
                ends, lengths, at = [], [], 0
                for n in words.counts.tolist():
                    own = words.hashes[at : at + n].tolist()
                    longest = np.max([a.value.matching(own) for a in automata], axis=0)
                    found = np.flatnonzero(longest >= length)
                    ends += (found + at + 1).tolist()
                    lengths += longest[found].tolist()
                    at += n
                size = np.array(lengths, np.int64)
                covered = _cover(np.array(ends, np.int64) - size, size, len(words.hashes))
                removed = np.bincount(words.owner[covered], minlength=len(words.counts)).astype(np.int64)
                columns = [part.column("id"), pa.array(words.counts.astype(np.int64)), pa.array(removed), pa.array(_kept_text(words, covered))]
                yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_words", "n_removed", "kept_text"])

    id_type = docs.schema[id_column].dataType.simpleString()
    source = shipped(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(stream, f"`{id_column}` {id_type}, n_words bigint, n_removed bigint, kept_text string")


def repeats_report(docs: DataFrame) -> DataFrame:
    kept = remove_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
