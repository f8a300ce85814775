"""Periodic runs against trying every period."""

import random

import pyarrow as pa
import pytest

from salesloom.llm import periodic_runs
from salesloom.llm.words import SPACED, find_words

from . import brute
from .conftest import TEXTS


def found_in(texts, least=12):
    out = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in periodic_runs.find_runs(find_words(pa.array(texts, pa.string()), SPACED, lower=False), least)), strict=True):
        out[text].append(tuple(run))
    return out


def periodic(generator, letters, n):
    """Random letters with periods planted into periods."""
    words = [str(generator.randrange(letters)) for _ in range(n)]
    for _ in range(generator.randrange(3)):
        a, p = generator.randrange(n + 1), generator.randrange(1, n + 1)
        end = generator.randrange(a, n + 1)
        words[a:end] = [words[a + (i - a) % p] for i in range(a, end)]
    return words


@pytest.mark.parametrize("least", [2, 7, 12])
def test_all_runs_of_small_alphabets(least):
    generator = random.Random(least)
    texts = [periodic(generator, generator.choice([1, 2, 3, 9]), generator.randrange(1, 80)) for _ in range(400)]
    assert found_in([" ".join(t) for t in texts], least) == [brute.runs(t, least) for t in texts]


def test_nested_runs_of_fibonacci_words_and_long_texts():
    one, two = "a", "b"
    while len(two) < 300:
        one, two = two, two + one
    assert found_in([" ".join(two)]) == [brute.runs(list(two))]
    n = 60_000
    assert found_in(["x " * n, "x y z " * n]) == [[(0, n, 1)], [(0, 3 * n, 3)]]
    assert found_in([None, "", "x " * 11, "x " * 12]) == [[], [], [], [(0, 12, 1)]]


def test_runs_do_not_cross_texts():
    assert found_in(["a b c d e f", "a b c d e f", "a b c d e f"]) == [[], [], []]


def test_kept_text_and_clashing_columns(docs, repeated):
    expected = {}
    for i, text in enumerate(TEXTS):
        words = brute.planted_words(None, text)
        expected[i] = (len(words), brute.runs(words) if len(words) < 1000 else None, words)
    for df in (docs, repeated):
        rows = periodic_runs.periodic_runs(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            n, own, words = expected[3 if r["doc_id"] is None else r["doc_id"]]
            own = [tuple(x) for x in r["runs"]] if own is None else own
            assert r["n_words"] == n and [tuple(x) for x in r["runs"]] == own and r["kept_text"] == brute.collapsed(words, own)


def test_report_over_planted_periods(spark, sample, docs):
    table, rows = sample
    many = [(i, t if len(t or "") < 9000 else t[:9000]) for i, t in rows] + [(None, "a " * 20), (9_000_001, None)]
    found = periodic_runs.runs_report(spark.createDataFrame(many, "doc_id bigint, text string")).collect()
    by_key = {r["doc_id"]: r for r in found}
    assert len(found) == len(many)
    planted = 0
    for i, text in many:
        words = brute.planted_words(i, text)
        own = brute.runs(words)
        planted += bool(own)
        best = max(own, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if own else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        assert tuple(by_key[i]) == (i, len(own), *best, milli, brute.sha(lines), brute.sha(brute.collapsed(words, own)))
    assert planted > len(many) // 20
