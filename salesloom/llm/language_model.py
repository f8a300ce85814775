"""Scoring by a log-bilinear language model, trained in numpy with noise-contrastive estimation.

Counts of all words come from the whole training part, asked for by the batch (exchange.py): a
batch gets back the counts of its own words only, so no vocabulary is ever held anywhere.

The model predicts word classes: the most frequent words and the end of a text are classes of their own, and
every other word belongs to one of a fixed number of classes by its last two bytes. The two classes before a
word are added up as vectors, and the sum is multiplied with each class's own vector. Every task trains on its
share of all training texts, from the same start, against noise drawn from the class frequencies; the
parameters are then averaged, weighted by tokens. For scoring, the matrix product of all distinct
contexts of a batch with all classes gives normalised probabilities; within a class a word has its
smoothed share of the class's training tokens, and one more share is left for all unseen words, so that the
probabilities of all words add up to one.

Defined cases: a NULL text is empty and has the end alone; a NULL id belongs to the training part; repeated
rows count as often as they occur; without training tokens every word is unseen and scores are
those of the uniform start. Columns besides id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import kept
from salesloom.llm.exchange import by_range, in_batches, packed, range_of, unpacked
from salesloom.llm.words import SPACED, Words, find_words, mix, slices

SMOOTHING = 0.1
HELD_OUT_OF = 10


@dataclass(frozen=True)
class Shape:
    """`words`: frequent words with a class of their own. `suffixes`: classes of the rest. `size`: of a vector.
    `noise`: noise classes a minibatch shares. `minibatch`: tokens; `rate`: of the adaptive gradient."""

    words: int = 127
    suffixes: int = 128
    size: int = 16
    noise: int = 64
    minibatch: int = 4096
    rate: float = 0.1

    @property
    def end(self) -> int:
        return self.words + self.suffixes

    @property
    def classes(self) -> int:
        return self.end + 1

    @property
    def before(self) -> int:
        """What stands before a text."""
        return self.classes


def _suffixes(words: Words, shape: Shape) -> np.ndarray:
    last = words.data[words.end - 1].astype(np.uint64)
    second = words.data[np.maximum(words.end - 2, words.start)].astype(np.uint64)
    return (mix(last * np.uint64(256) + second) % np.uint64(shape.suffixes)).astype(np.uint8)


def _batch_words(table: pa.Table, shape: Shape):
    """Words of a batch: hashes, suffix classes, number per text and whether each text trains."""
    hashes, suffixes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for part in slices(table, "text"):
        words = find_words(part.column("text"), SPACED, lower=True)
        hashes.append(words.hashes), suffixes.append(_suffixes(words, shape)), counts.append(words.counts)
    trains = table.column("trains").to_numpy().astype(bool)
    return np.concatenate(hashes), np.concatenate(suffixes), np.concatenate(counts), trains


def _keys(hashes: np.ndarray, ranges: int):
    keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return keys, first, inverse, range_of(mix(keys), ranges)


def _ask(shape: Shape, ranges: int):
    def ask(table: pa.Table) -> pa.Table:
        hashes, suffixes, counts, trains = _batch_words(table, shape)
        keys, first, inverse, to = _keys(hashes, ranges)
        own = np.bincount(inverse, weights=np.repeat(trains, counts), minlength=len(keys)).astype(np.uint32)
        batch = table.column("batch")[0].as_py()
        rows = [(r, packed(keys[at], True), packed(own[at]), suffixes[first[at]].tobytes()) for r, at in by_range(to).items()]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        return pa.table([columns[0], pa.array([batch] * len(rows), pa.int64()), *columns[1:]], names=["range", "batch", "keys", "counts", "suffixes"])

    return ask


def _answer(shape: Shape):
    def answer(table: pa.Table) -> pa.Table:
        """Each batch gets the totals of its keys; one row with batch NULL has the range's statistics."""
        batches, at = table.column("batch").to_pylist(), table.column("range")[0].as_py()
        keys = [unpacked(k, np.uint64, True) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([unpacked(c, np.uint32) for c in table.column("counts").to_pylist()])
        suffixes = np.concatenate([np.frombuffer(s, np.uint8) for s in table.column("suffixes").to_pylist()])
        distinct, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        totals = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
        suffix = suffixes[first]
        top = np.lexsort((distinct, -totals))[: shape.words]
        top = top[totals[top] > 0]
        ends = np.cumsum([len(k) for k in keys])
        answers = [packed(totals[inverse[e - len(k) : e]]) for k, e in zip(keys, ends, strict=True)]
        seen = totals > 0
        n = np.bincount(suffix, weights=totals, minlength=shape.suffixes).astype(np.int64)
        v = np.bincount(suffix[seen], minlength=shape.suffixes).astype(np.int64)
        none = [None] * len(batches)
        lists = lambda own: pa.array([*none, own.tolist()], pa.list_(pa.int64()))
        return pa.table(
            [
                pa.array([*batches, None], pa.int64()), pa.array([at] * (len(batches) + 1), pa.int64()), pa.array([*answers, None], pa.binary()),
                lists(n), lists(v), lists(distinct[top].view(np.int64)), lists(totals[top]), lists(suffix[top].astype(np.int64)),
            ],
            names=["batch", "range", "totals", "n", "v", "top", "top_n", "top_suffix"],
        )

    return answer


@dataclass(frozen=True)
class Vocabulary:
    """What all tasks know of the training part: a few hundred numbers, however large it is."""

    top: np.ndarray
    tokens: int
    types: int
    texts: int
    class_tokens: np.ndarray
    class_types: np.ndarray

    def classes(self, hashes: np.ndarray, suffixes: np.ndarray, shape: Shape) -> np.ndarray:
        out = suffixes.astype(np.int64) + shape.words
        if len(self.top):
            order = np.argsort(self.top)
            at = np.minimum(np.searchsorted(self.top, hashes, sorter=order), len(self.top) - 1)
            own = order[at]
            out = np.where(self.top[own] == hashes, own, out)
        return out


def _vocabulary(answers: DataFrame, texts: int, shape: Shape) -> Vocabulary:
    facts = answers.filter("batch IS NULL")
    sums = facts.select(F.posexplode(F.arrays_zip("n", "v"))).groupBy("pos").agg(F.sum("col.n").alias("n"), F.sum("col.v").alias("v"))
    n, v = np.zeros(shape.classes, np.int64), np.zeros(shape.classes, np.int64)
    for row in sums.collect():
        n[shape.words + row["pos"]], v[shape.words + row["pos"]] = row["n"], row["v"]
    tokens, types = int(n.sum()) + texts, int(v.sum()) + (texts > 0)
    best = facts.select(F.explode(F.arrays_zip("top", "top_n", "top_suffix")).alias("w")).select("w.*")
    top = best.orderBy(F.desc("top_n"), "top").limit(shape.words).collect()
    for i, row in enumerate(top):
        suffix = shape.words + row["top_suffix"]
        n[i], v[i], n[suffix], v[suffix] = row["top_n"], 1, n[suffix] - row["top_n"], v[suffix] - 1
    n[shape.end], v[shape.end] = texts, int(texts > 0)
    return Vocabulary(np.array([r["top"] for r in top], np.int64).view(np.uint64), tokens, types, texts, n, v)


def _contexts(classes: np.ndarray, counts: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Target, and the classes one and two places before it, of all tokens of texts that each close with the end."""
    ends = np.cumsum(counts + 1) - 1
    target = np.full(len(classes) + len(counts), shape.end, np.int64)
    inner = np.ones(len(target), bool)
    inner[ends] = False
    target[inner] = classes
    one, two = np.full(len(target), shape.before, np.int64), np.full(len(target), shape.before, np.int64)
    one[1:], two[2:] = target[:-1], target[:-2]
    starts = ends - counts
    one[starts], two[starts] = shape.before, shape.before
    two[(starts + 1)[counts > 0]] = shape.before
    return target, one, two


class LogBilinear:
    """Vectors of the class one place before, of the one two places before, and of the class to come, and its bias."""

    def __init__(self, shape: Shape, frequencies: np.ndarray):
        random = np.random.default_rng(7)
        vectors = lambda n: random.normal(0, 0.1, (n, shape.size))
        self.shape, self.frequencies = shape, frequencies
        self.parts = [vectors(shape.classes + 1), vectors(shape.classes + 1), vectors(shape.classes), np.log(frequencies)[:, None]]
        self.squares = [np.full(p.shape, 1e-6) for p in self.parts]
        self.random = random

    def _step(self, i: int, rows: np.ndarray, gradients: np.ndarray) -> None:
        width = gradients.shape[1]
        cells = (rows[:, None] * width + np.arange(width)).ravel()
        total = np.bincount(cells, weights=gradients.ravel(), minlength=self.parts[i].size).reshape(self.parts[i].shape)
        self.squares[i] += total**2
        self.parts[i] -= self.shape.rate * total / np.sqrt(self.squares[i])

    def learn(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """One step of noise-contrastive estimation: tell the targets from noise that the whole minibatch shares."""
        first, second, coming, bias = self.parts
        noise = self.random.choice(self.shape.classes, self.shape.noise, p=self.frequencies)
        expected = np.log(self.shape.noise * self.frequencies)
        context = first[one] + second[two]
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        wrong = (sigmoid((context * coming[target]).sum(1) + bias[target, 0] - expected[target]) - 1) / len(target)
        noisy = sigmoid(context @ coming[noise].T + bias[noise, 0] - expected[noise]) / len(target)
        to_context = wrong[:, None] * coming[target] + noisy @ coming[noise]
        rows = np.concatenate([target, noise])
        self._step(2, rows, np.concatenate([wrong[:, None] * context, noisy.T @ context]))
        self._step(3, rows, np.concatenate([wrong, noisy.sum(0)])[:, None])
        self._step(0, one, to_context)
        self._step(1, two, to_context)

    def log_probabilities(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, most: int = 8192) -> np.ndarray:
        """Natural logarithms, normalised over all classes; each distinct context is computed once."""
        first, second, coming, bias = (p.astype(np.float32) for p in self.parts)
        width = self.shape.classes + 1
        contexts, inverse = np.unique(one * width + two, return_inverse=True)
        out, order = np.empty(len(target)), np.argsort(inverse, kind="stable")
        cut = np.searchsorted(inverse[order], np.arange(0, len(contexts) + most, most))
        for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            part = contexts[i * most : (i + 1) * most]
            scores = (first[part // width] + second[part % width]) @ coming.T + bias[:, 0]
            scores -= scores.max(1, keepdims=True)
            scores -= np.log(np.exp(scores).sum(1, keepdims=True))
            mine = order[a:b]
            out[mine] = scores[inverse[mine] - i * most, target[mine]]
        return out


def _frequencies(vocabulary: Vocabulary) -> np.ndarray:
    share = vocabulary.class_tokens + 1.0
    return share / share.sum()


def _train(vocabulary: Vocabulary, shape: Shape):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = LogBilinear(shape, _frequencies(vocabulary)), 0
        for batch in batches:
            for part in slices(batch, "text"):
                words = find_words(part.column("text"), SPACED, lower=True)
                tokens = _contexts(vocabulary.classes(words.hashes, _suffixes(words, shape), shape), words.counts, shape)
                # Tokens of one minibatch come from all over the piece of text.
                order = model.random.permutation(len(tokens[0]))
                for at in range(0, len(order), shape.minibatch):
                    model.learn(*(t[order[at : at + shape.minibatch]] for t in tokens))
                seen += len(order)
        if seen:
            for i, part in enumerate(model.parts):
                cells = part.size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(cells, i)), pa.array(np.arange(cells)), pa.array(np.full(cells, float(seen))), pa.array(part.ravel())],
                    names=["part", "cell", "weight", "value"],
                )

    return train


def train_model(docs: DataFrame, vocabulary: Vocabulary, shape: Shape) -> LogBilinear:
    """Trains in every task of `docs` (text) and averages: a few thousand numbers a task are shuffled."""
    each = docs.mapInArrow(_train(vocabulary, shape), "part bigint, cell bigint, weight double, value double")
    mean = (F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("value")
    averaged = each.groupBy("part", "cell").agg(mean).toPandas()
    model = LogBilinear(shape, _frequencies(vocabulary))
    for i, part in enumerate(model.parts):
        own = averaged[averaged["part"] == i]
        if len(own):
            part.ravel()[own["cell"].to_numpy()] = own["value"].to_numpy()
    return model


def _score(vocabulary: Vocabulary, parts: list[np.ndarray], shape: Shape, ranges: int):
    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, suffixes, counts, trains = _batch_words(table, shape)
        keys, _, inverse, to = _keys(hashes, ranges)
        totals, places = np.zeros(len(keys), np.int64), by_range(to)
        for at, data in zip(answers.column("range").to_pylist(), answers.column("totals").to_pylist(), strict=True):
            totals[places[at]] = unpacked(data, np.int64)
        classes = vocabulary.classes(hashes, suffixes, shape)
        target, one, two = _contexts(classes, counts, shape)
        occurs = np.full(len(target), vocabulary.texts, np.int64)
        occurs[np.delete(np.arange(len(target)), np.cumsum(counts + 1) - 1)] = totals[inverse]
        whole = vocabulary.tokens + SMOOTHING * (vocabulary.types + 1)
        base = np.log10((occurs + SMOOTHING) / whole)
        model = LogBilinear(shape, _frequencies(vocabulary))
        model.parts = parts
        share = np.zeros(len(target))
        shared = (target >= shape.words) & (target != shape.end)
        size, kinds = vocabulary.class_tokens[target[shared]], vocabulary.class_types[target[shared]]
        share[shared] = np.log10((occurs[shared] + SMOOTHING) / (size + SMOOTHING * (kinds + 1)))
        scores = model.log_probabilities(target, one, two) / np.log(10) + share
        starts = np.cumsum(counts + 1) - (counts + 1)
        add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        n = len(counts)
        return pa.table(
            [
                table.column("id"), pa.array(~trains), pa.array(counts + 1), pa.array(add((occurs > 0).astype(np.int64)).astype(np.int64)),
                pa.array(np.full(n, vocabulary.tokens, np.int64)), pa.array(add(base)), pa.array(add(scores)),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return score


def score_texts(docs: DataFrame, shape: Shape | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    shape = shape or Shape()
    own = F.col(id_column).cast("string")
    trains = F.coalesce(F.crc32(F.encode(own, "UTF-8")) % HELD_OUT_OF != 0, F.lit(True))
    text = F.coalesce(text_column, F.lit(""))
    batches, ranges = in_batches(docs, text, F.struct(own, F.col(text_column)), id=F.col(id_column), trains=trains)
    questions = batches.groupBy("batch").applyInArrow(
        _ask(shape, ranges), "range bigint, batch bigint, keys binary, counts binary, suffixes binary"
    )
    statistics = "n array<bigint>, v array<bigint>, top array<bigint>, top_n array<bigint>, top_suffix array<bigint>"
    answers = kept(
        questions.groupBy("range").applyInArrow(_answer(shape), f"batch bigint, range bigint, totals binary, {statistics}"), "totals"
    )
    training = docs.filter(trains).select(text.alias("text"))
    vocabulary = _vocabulary(answers, training.count(), shape)
    model = train_model(training, vocabulary, shape)
    id_type = docs.schema[id_column].dataType.simpleString()
    figures = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    scored = (
        batches.groupBy("batch")
        .cogroup(answers.filter("batch IS NOT NULL").select("batch", "range", "totals").groupBy("batch"))
        .applyInArrow(_score(vocabulary, model.parts, shape, ranges), f"id {id_type}, {figures}")
    )
    return scored.withColumnRenamed("id", id_column)
