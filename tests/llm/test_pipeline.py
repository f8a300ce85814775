"""The corpus pipeline against its plain version."""

import random
import re

import corpus_pipeline
from salesloom.llm import quality_rules

from . import brute
from .conftest import KEY, SF
from .test_operators import check_packing


def test_stages_and_their_columns():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "packing"]


def redacted(text):
    """The base spans, merged where they overlap, as marks."""
    spans = [tuple(map(int, s.split(":")[1:])) for s in brute.secrets(text)[3].split(",") if s]
    out, at = "", 0
    for a, b in spans:
        out += text[at:a] + "[SECRET]" if a >= at else ""
        at = max(at, b)
    return out + text[at:]


def test_documents_and_texts_that_reach_the_end(spark, sample, folder):
    df, rows = sample
    generator = random.Random(12)
    prose = lambda: " ".join(f"p{generator.randrange(10**5)}" for _ in range(80))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    base = prose()
    planted = [
        f"{prose()} password = 'abc123XYZ9' {KEY} {prose()}", f"{prose()} {'0af3' * 8} end", base, base, base + " one more word", f"{prose()} {item}",
        "too short", ("again and again and so on " * 20),
    ]
    first = 10_000
    more = spark.createDataFrame([(first + i, t, "en", "planted", len(t)) for i, t in enumerate(planted)], df.schema)
    df.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    kept = {r["doc_id"]: r["text"] for r in quality_rules.apply_quality(docs).collect()}
    clean = {i for i, t in [*rows, *enumerate(planted, first)] if not brute.quality(t)[-1]}
    assert set(kept) <= clean and len(kept) > 0.95 * len(clean)
    near = brute.near(list(kept.items()), 5, 80)
    kept = {i: t for i, t in kept.items() if near[i][1] == i}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not brute.leaks(t, items)[1]}
    texts = {i: redacted(t) for i, t in kept.items()}
    assert {i - first for i in texts if i >= first} == {0, 1, 2}
    assert not re.search(r"AKIA|abc123|0af30af3", texts[first] + texts[first + 1])

    found = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]
    assert {r["doc_id"] for r in found} == set(texts)
    check_packing(found, list(texts.items()), 2048)


def test_each_stage_takes_no_rows(spark, folder, sample):
    df, _ = sample
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs = df.filter("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.collect() == []
        if name != "packing":
            assert out.columns == df.columns


def test_each_stage_takes_awkward_and_repeated_rows(spark, folder, repeated):
    """Every stage but the last hands on all columns, also those named like its own, and drops no clean row."""
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, repeated, folder)
        assert out.count() > 0
        if name != "packing":
            assert out.columns == repeated.columns
