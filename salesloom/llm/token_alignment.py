"""Alignment of two tokenizers over the same text, by divide and conquer at shared cuts.

Both tokenizers spell the same bytes; an offset where tokens of both end is a shared cut. A text is one interval, which
ends at a cut. In every interval a shared cut near its middle is located: the middle token of A, and if no token of B
ends with it, those around it by growing distance, each looked up in B's ends by bisection. The interval is split there
and both halves go on; an interval without a cut inside is a leaf, and one group of the alignment. All intervals
of a piece of texts go one level down at once, in numpy, so there are as many rounds as levels.

A link is a pair of tokens, one of each side, whose bytes share a group; the count of a pair of ids is the number of documents
that hold it linked. Texts are tokenised once: a piece of four megabytes writes its documents' distinct pairs, as places in
the sorted list of its own pairs, and asks with one row per range of pairs (exchange.py) how many documents hold them. Ranges
answer with the counts over all pieces, and the highest count of each A id is kept in a table
bounded by the vocabulary (50,257 numbers). A pair that all documents hold is one entry per piece.

Defined cases: texts that are NULL, empty, or that a tokenizer does not spell byte by byte (as one that holds U+2581) have no tokens: zeros
and an empty text of groups. Repeated rows count as documents of their own; NULL ids pass through; an empty table gives
no rows; a very long text is a piece by itself; other columns are not looked at, whatever their names. In a
group of many tokens equal pairs are counted, not listed, so memory grows with its distinct pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import kept, shipped
from salesloom.llm.exchange import by_range, packed, range_of, unpacked
from salesloom.llm.words import mix, slices

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Bits of a B id in a pair; more than either vocabulary needs.
B_BITS = np.uint64(20)
PIECE_BYTES, RANGE_BYTES = 4 << 20, 16 << 20
#: Tokens of a group beyond which its ids are counted before they are paired.
LONG_GROUP = 64


class ByteLevel:
    """A: a byte-level BPE over a space and the text. Special tokens' names are plain text."""

    def __init__(self, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, rank in vocabulary.items():
            self.spelled[rank] = token

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """B: pieces of a model that puts a space before the text by itself."""

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        self.spelled = [self._bytes(i) for i in range(self.model.vocab_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places in A of all tokens that end with a token of B. Tokens first..last of each text end at a cut; ends ascend over all texts."""
    cuts = [last]
    low, high = first, last  # the tokens of an interval; the last one ends at its cut
    while len(low):
        open_ones = high > low
        low, high = low[open_ones], high[open_ones]
        middle = (low + high - 1) // 2
        found, waiting, away = np.full(len(low), -1), np.arange(len(low)), 0
        while len(waiting):
            still = np.zeros(len(waiting), bool)
            for step in {away, -away}:
                at = middle[waiting] + step
                inside = (at >= low[waiting]) & (at < high[waiting])
                still |= inside
                ask = np.flatnonzero(inside & (found[waiting] < 0))
                ends = a_ends[at[ask]]
                there = b_ends[np.minimum(np.searchsorted(b_ends, ends), len(b_ends) - 1)] == ends
                found[waiting[ask[there]]] = at[ask[there]]
            waiting, away = waiting[still & (found[waiting] < 0)], away + 1
        split = found >= 0
        cuts.append(found[split])
        low, high = np.r_[low[split], found[split] + 1], np.r_[found[split], high[split]]
    return np.sort(np.concatenate(cuts))


def _spelled_ends(ids: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """Where each token ends, counting on over all texts."""
    return np.cumsum(lengths[np.concatenate(ids)]) if ids else np.zeros(0, np.int64)


class Aligned:
    """The tokens of texts that both tokenizers spell, and their groups."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_lengths: np.ndarray, b_lengths: np.ndarray):
        none = [np.zeros(0, np.int64)]
        self.a, self.b = np.concatenate(a or none), np.concatenate(b or none)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        a_ends, b_ends = _spelled_ends(a, a_lengths), _spelled_ends(b, b_lengths)
        last = np.cumsum(self.n_a) - 1
        self.a_stop = shared_cuts(a_ends, b_ends, last - self.n_a + 1, last) + 1
        self.b_stop = np.searchsorted(b_ends, a_ends[self.a_stop - 1]) + 1
        self.a_size, self.b_size = np.diff(np.r_[0, self.a_stop]), np.diff(np.r_[0, self.b_stop])
        text_stop = np.searchsorted(self.a_stop, last + 1) + 1
        self.n_groups = np.diff(np.r_[0, text_stop])
        self.text = np.repeat(np.arange(len(a)), self.n_groups)

    def links(self) -> np.ndarray:
        return np.bincount(self.text, weights=self.a_size * self.b_size, minlength=len(self.n_a)).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair of ids, how often) of all links, by text and pair."""
        long = (self.a_size > LONG_GROUP) & (self.b_size > LONG_GROUP)
        short = np.flatnonzero(~long)
        n = (self.a_size * self.b_size)[short]
        group = np.repeat(short, n)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        i = self.a_stop[group] - self.a_size[group] + nth // self.b_size[group]
        j = self.b_stop[group] - self.b_size[group] + nth % self.b_size[group]
        texts, codes, often = [self.text[group]], [self.a[i].astype(np.uint64) << B_BITS | self.b[j].astype(np.uint64)], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(long).tolist():
            a, n_a = np.unique(self.a[self.a_stop[g] - self.a_size[g] : self.a_stop[g]], return_counts=True)
            b, n_b = np.unique(self.b[self.b_stop[g] - self.b_size[g] : self.b_stop[g]], return_counts=True)
            codes.append((a.astype(np.uint64)[:, None] << B_BITS | b.astype(np.uint64)).ravel())
            often.append((n_a[:, None] * n_b).ravel()), texts.append(np.full(len(codes[-1]), self.text[g]))
        text, code, times = np.concatenate(texts), np.concatenate(codes), np.concatenate(often)
        order = np.lexsort((code, text))
        text, code, times = text[order], code[order], times[order]
        new = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (code[1:] != code[:-1])]) if len(text) else np.zeros(0, np.int64)
        return text[new], code[new], np.add.reduceat(times, new) if len(new) else times

    def written(self) -> list[bytes]:
        """For each text its groups as `a1,a2|b1;a3|b2,b3`."""
        where = np.r_[np.arange(len(self.a)) + np.repeat(self.b_stop - self.b_size, self.a_size), np.arange(len(self.b)) + np.repeat(self.a_stop, self.b_size)]
        after_a, after_b = np.full(len(self.a), ord(","), np.uint8), np.full(len(self.b), ord(","), np.uint8)
        after_a[self.a_stop - 1], after_b[self.b_stop - 1] = ord("|"), ord(";")
        ids, after = np.empty(len(where), np.int64), np.empty(len(where), np.uint8)
        ids[where], after[where] = np.r_[self.a, self.b], np.r_[after_a, after_b]
        digits = len(str(int(ids.max(initial=0))))
        signs = np.empty((len(ids), digits + 1), np.uint8)
        for k in range(digits):
            signs[:, digits - 1 - k] = ord("0") + ids // 10**k % 10
        signs[:, digits] = after
        shown = np.ones(signs.shape, bool)
        for k in range(1, digits):
            shown[:, digits - 1 - k] = ids >= 10**k
        stops = np.cumsum(shown.sum(1))[np.cumsum(self.n_a + self.n_b) - 1].tolist()
        data = signs[shown].tobytes()
        # Without the mark after the last group.
        return [data[i : j - 1] for i, j in zip([0, *stops], stops)]


def _spells(table: list[bytes], ids: list[int], whole: bytes) -> bool:
    return b"".join([table[i] for i in ids]) == whole


def align(texts: list[str | None], one: ByteLevel, two: Pieces) -> tuple[np.ndarray, Aligned]:
    """Which texts both tokenizers spell, and their alignment."""
    wholes = [(" " + t).encode() if t else b"" for t in texts]
    asked = [i for i, w in enumerate(wholes) if w]
    a, b = (side.ids([texts[i] for i in asked]) for side in (one, two))
    good = [k for k, i in enumerate(asked) if _spells(one.spelled, a[k], wholes[i]) and _spells(two.spelled, b[k], wholes[i])]
    lengths = [np.array([len(x) for x in side.spelled], np.int64) for side in (one, two)]
    arrays = ([np.array(side[k], np.int64) for k in good] for side in (a, b))
    return np.array([asked[k] for k in good], np.int64), Aligned(*arrays, *lengths)


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _align(ranks: str, pieces: str, ranges: int):
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of documents, and of each piece's questions (with a range)."""
        one, two, number, task = ByteLevel(ranks), Pieces(pieces), 0, TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, "text", PIECE_BYTES):
                good, found = align(part.column("text").to_pylist(), one, two)
                text, code, times = found.pairs()
                asked, place = np.unique(code, return_inverse=True)
                holders = np.bincount(place, minlength=len(asked)).astype(np.uint32)
                cuts = np.searchsorted(text, np.arange(len(good) + 1)).tolist()
                figures = np.zeros((len(FIGURES), part.num_rows), np.int64)
                figures[:, good] = found.n_a, found.n_b, found.n_groups, found.links()
                written, places, often = [""] * part.num_rows, [None] * part.num_rows, [None] * part.num_rows
                for i, w, x, y in zip(good.tolist(), found.written(), cuts, cuts[1:]):
                    written[i], places[i], often[i] = hashlib.sha256(w).hexdigest(), packed(place[x:y].astype(np.uint32), True), packed(times[x:y].astype(np.uint32))
                name = task << 32 | number
                number += 1
                n = part.num_rows
                questions = [(r, packed(asked[at], True), packed(holders[at])) for r, at in by_range(range_of(mix(asked), ranges)).items()]
                m = len(questions)
                both = lambda mine, of_questions, kind: pa.concat_arrays([pa.array(mine, kind), pa.array(of_questions, kind)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (n + m), pa.int64()), both([None] * n, [q[0] for q in questions], pa.int64()),
                        pa.concat_arrays([part.column("id"), pa.nulls(m, part.column("id").type)]),
                        *[both(f, [None] * m, pa.int64()) for f in figures.tolist()], both(written, [None] * m, pa.string()),
                        both(places, [q[1] for q in questions], pa.binary()), both(often, [q[2] for q in questions], pa.binary()),
                    ],
                    names=["batch", "range", "id", *FIGURES, "groups_sha256", "pairs", "times"],
                )

    return documents


def _answer(table: pa.Table) -> pa.Table:
    """For one range of pairs: each piece's counts over all pieces, and (batch NULL) the highest count of each A id."""
    pairs = [unpacked(x, np.uint64, True) for x in table.column("pairs").to_pylist()]
    holders = np.concatenate([unpacked(x, np.uint32) for x in table.column("times").to_pylist()])
    distinct, place = np.unique(np.concatenate(pairs), return_inverse=True)
    counts = np.bincount(place, weights=holders, minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(p) for p in pairs])
    answers = [packed(counts[place[e - len(p) : e]]) for p, e in zip(pairs, ends, strict=True)]
    first = np.flatnonzero(np.r_[True, np.diff(distinct >> B_BITS) != 0])
    ids, highest = (distinct[first] >> B_BITS).astype(np.int64), np.maximum.reduceat(counts, first)
    at = table.column("range")[0].as_py()
    return pa.table(
        [
            pa.array([*table.column("batch").to_pylist(), None], pa.int64()), pa.array([at] * (len(answers) + 1), pa.int64()),
            pa.array([*table.column("pairs").to_pylist(), None], pa.binary()), pa.array([*answers, None], pa.binary()),
            pa.array([*[None] * len(answers), ids.tolist()], pa.list_(pa.int64())),
            pa.array([*[None] * len(answers), highest.tolist()], pa.list_(pa.int64())),
        ],
        names=["batch", "range", "pairs", "counts", "a", "highest"],
    )


def _judge(highest: np.ndarray, ranges: int):
    def judge(documents: pa.Table, answers: pa.Table) -> pa.Table:
        """The documents of a piece with the counts of their links."""
        asked = [unpacked(x, np.uint64, True) for x in answers.column("pairs").to_pylist()]
        told = [unpacked(x, np.int64) for x in answers.column("counts").to_pylist()]
        pairs, counts = np.concatenate([np.zeros(0, np.uint64), *asked]), np.concatenate([np.zeros(0, np.int64), *told])
        order = np.argsort(pairs)
        pairs, counts = pairs[order], counts[order]
        best = counts == highest[(pairs >> B_BITS).astype(np.int64)]
        n_best, count_sum = np.zeros(documents.num_rows, np.int64), np.zeros(documents.num_rows, np.int64)
        for i, (places, often) in enumerate(zip(documents.column("pairs").to_pylist(), documents.column("times").to_pylist(), strict=True)):
            if places is not None:
                at, times = unpacked(places, np.uint32, True), unpacked(often, np.uint32).astype(np.int64)
                n_best[i], count_sum[i] = times[best[at]].sum(), (times * counts[at]).sum()
        columns = [documents.column(c) for c in ("id", *FIGURES)]
        return pa.table([*columns, pa.array(n_best), pa.array(count_sum), documents.column("groups_sha256")], names=["id", *FIGURES, "n_best", "count_sum", "groups_sha256"])

    return judge


def align_tokens(docs: DataFrame, ranks: str = RANKS, pieces: str = PIECES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    id_type = docs.schema[id_column].dataType.simpleString()
    source = shipped(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    ranges = max(1, -(-(source.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES))
    numbers = ", ".join(f"{f} bigint" for f in FIGURES)
    schema = f"batch bigint, range bigint, id {id_type}, {numbers}, groups_sha256 string, pairs binary, times binary"
    aligned = kept(source.mapInArrow(_align(ranks, pieces, ranges), schema), "aligned")
    questions = aligned.filter("range IS NOT NULL").select("batch", "range", "pairs", "times")
    answers = kept(
        questions.repartition(ranges, "range").groupBy("range")
        .applyInArrow(_answer, "batch bigint, range bigint, pairs binary, counts binary, a array<bigint>, highest array<bigint>"),
        "answers",
    )
    of_a = answers.filter("batch IS NULL").select(F.explode(F.arrays_zip("a", "highest")).alias("x"))
    # A row per id of A's vocabulary at most.
    best = of_a.groupBy("x.a").agg(F.max("x.highest").alias("highest")).collect()
    highest = np.zeros(max([0, *(r["a"] for r in best)]) + 1, np.int64)
    for r in best:
        highest[r["a"]] = r["highest"]
    told = answers.filter("batch IS NOT NULL").select("batch", "range", "pairs", "counts")
    figures = f"id {id_type}, {numbers}, n_best bigint, count_sum bigint, groups_sha256 string"
    return (
        aligned.filter("range IS NULL")
        .groupBy("batch")
        .cogroup(told.groupBy("batch"))
        .applyInArrow(_judge(highest, ranges), figures)
        .withColumnRenamed("id", id_column)
    )
