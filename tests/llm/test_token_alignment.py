"""Alignment of two tokenizers against looking at every offset."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.llm import token_alignment

from . import brute
from .conftest import TEXTS

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    "▁ is a space to one of them", "<0x41> <s> </s> <unk> <|endoftext|>", "日本語のテキスト 😀👩‍👩‍👧 naïve ﬁne", "=" * 700 + "-" * 333 + "=-" * 200,
    "x" * 5000, " leading and  double   spaces \n\n\t tabs ", "0123456789" * 50, "é" * 300 + "é" * 40, " ", "\n", "a\r\nb",
]


def compare(found, rows):
    expected = brute.alignments(rows)
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[n] for n in NAMES) == expected[r["doc_id"]], r["doc_id"]


@pytest.fixture
def small(monkeypatch):
    """Many pieces and ranges, as a large corpus has."""
    monkeypatch.setattr(token_alignment, "PIECE_BYTES", 2_000)
    monkeypatch.setattr(token_alignment, "RANGE_BYTES", 3_000)


@pytest.mark.parametrize("long_group", [0, 64])
def test_every_text_and_count(spark, small, monkeypatch, long_group):
    monkeypatch.setattr(token_alignment, "LONG_GROUP", long_group)
    rows = [(i, t if t is None else t[:3000]) for i, t in enumerate([*TEXTS, *ODD])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"batch": F.lit(1), "range": F.lit(2), "pairs": F.lit("x"), "id": F.lit(3)})
    compare(token_alignment.align_tokens(df.repartition(3)).collect(), rows)


def test_the_test_table(sample):
    df, rows = sample
    rows = [(i, t) for i, t in rows if len(t or "") < 20_000]
    compare(token_alignment.align_tokens(df.filter(F.length("text") < 20_000)).collect(), rows)


def test_repeated_rows_and_null_ids_count_each(spark, docs):
    text = TEXTS[3]
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "")], "doc_id bigint, text string")
    found = token_alignment.align_tokens(df).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "2", "None"]
    assert all(r["count_sum"] == 3 * r["n_links"] == 3 * r["n_best"] > 0 for r in found if r["doc_id"] != 2)
    assert token_alignment.align_tokens(docs).count() == len(TEXTS)


def test_cuts_are_all_shared_ends():
    generator = random.Random(7)
    for _ in range(300):
        stops, a_ends, b_ends, firsts, lasts = 0, [], [], [], []
        for _ in range(generator.randrange(1, 5)):
            n = generator.randrange(1, 60)
            one, two = ({n, *(x for x in range(1, n) if generator.random() < share)} for share in (generator.random(), generator.random()))
            firsts.append(len(a_ends))
            a_ends += sorted(stops + x for x in one)
            b_ends += sorted(stops + x for x in two)
            lasts.append(len(a_ends) - 1)
            stops += n
        cuts = token_alignment.shared_cuts(*(np.array(x) for x in (a_ends, b_ends, firsts, lasts)))
        assert cuts.tolist() == [i for i, end in enumerate(a_ends) if end in set(b_ends)]
