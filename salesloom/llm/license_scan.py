"""License scans by diagonal voting.

All rolling word bigrams of the documents are joined, by hash, to the bigrams of the license
templates. A template that stands in a document at word d matches along the diagonal
(place in the document) - (place in the template) = d; so hits are counted per diagonal,
neighbouring diagonals are merged (words put in or left out move the rest of a template by a few
places), and a span counts if it covers enough of the template. Where copies of a notice, or words that repeat one of
its bigrams, chain up a span of more than twice the template, each of its diagonals is verified with those up to half
a template's length beside it, and of overlapping ones the best covered is the span. The join compares the words
themselves besides their hash, so a vote is never a collision.

A bigram of two function words alone would hit everywhere: it does not vote, and is not
counted in a template's length. Hits of one document meet in one partition; a document is the largest group
there is. Only DataFrame functions are used.

Defined cases: a NULL text has no words; repeated rows are scanned one by one; columns besides id
and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from salesloom.llm.common import NOT_LETTERS, ascii_lower, parameter_table, split_words

# Phrases of the contract, and well-known license notices.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "cc-by-nc": "licensed under cc by nc",
    "apache-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "mit-notice": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software.""",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "bsd-notice": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer.""",
}
FUNCTION_WORDS = frozenset("a an and any as at be by for from in is it not of on or that the this to with you".split())


@dataclass(frozen=True)
class Voting:
    """`gap`: most words put in or left out at one place. `coverage`: share of a notice's bigrams in a span."""

    gap: int = 8
    coverage: float = 0.7


def _words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text.lower()).split()


UNITS = 1_000_000
TEMPLATE_COLUMNS = ["label", "exact", "words", "votes", "t_place", "t_pair"]


def template_rows(phrases=None, notices=None) -> list[tuple]:
    """Bigrams of all templates with their places; a phrase is exact, a notice needs coverage only."""
    rows = []
    for exact, texts in ((True, phrases or BASE_PHRASES), (False, {v: k for k, v in (notices or TEMPLATES).items()})):
        for text, label in texts.items():
            words = _words(text)
            pairs = [(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:], strict=False))]
            voting = [x for x in pairs if exact or not {x[1], x[2]} <= FUNCTION_WORDS]
            rows += [(label, exact, len(words), len(voting), i, f"{a} {b}") for i, a, b in voting]
    return rows


def template_table(spark: SparkSession, phrases=None, notices=None) -> DataFrame:
    rows = template_rows(phrases, notices)
    return parameter_table(spark, rows, TEMPLATE_COLUMNS).withColumn("t_hash", F.xxhash64("t_pair"))


def _apart(anchors: Column, words: Column) -> Column:
    """Of the spans around diagonals those that cover most, one for each copy: copies begin a template's length apart."""
    ordered = F.array_sort(anchors)

    def add(found: Column, anchor: Column) -> Column:
        last = F.get(found, F.size(found) - 1)
        return (
            F.when(last.isNull() | (anchor["diagonal"] - last["diagonal"] >= words), F.concat(found, F.array(anchor)))
            .when(anchor["span"]["coverage"] > last["span"]["coverage"], F.concat(F.slice(found, F.lit(1), F.size(found) - 1), F.array(anchor)))
            .otherwise(found)
        )

    return F.transform(F.aggregate(ordered, F.slice(ordered, 1, 0), add), lambda a: a["span"])


def find_licenses(docs: DataFrame, templates: DataFrame, voting: Voting | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_words, and `spans`, an array of (label, exact, start, stop, coverage)."""
    voting = voting or Voting()
    words = split_words(ascii_lower(F.coalesce(text_column, F.lit(""))), NOT_LETTERS)
    rest = F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0)))
    # The last word has no successor: its pair is NULL, and stands for the document itself below.
    pairs = F.zip_with("words", rest, lambda a, b: F.concat(a, F.lit(" "), b))
    places = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), words.alias("words"))
        .select("row", "id", F.size("words").cast("long").alias("n_words"), pairs.alias("pairs"))
        .select("row", "id", "n_words", F.posexplode_outer("pairs").alias("place", "pair"))
        .withColumn("hash", F.xxhash64("pair"))
    )
    same = (F.col("hash") == F.col("t_hash")) & (F.col("pair") == F.col("t_pair"))
    hits = places.join(templates, same, "left").filter("label IS NOT NULL OR pair IS NULL")
    template = ["row", "id", "n_words", "label", "exact", "words", "votes"]
    # All that follows groups by the row first: one shuffle, and a document is a group's bound.
    diagonals = (
        hits.repartition("row")
        .groupBy(*template, (F.col("place") - F.col("t_place")).alias("diagonal"))
        .agg(F.collect_set("t_place").alias("matched"), F.min("place").alias("low"), F.max("place").alias("high"))
    )
    along = W.partitionBy(*template).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    # A phrase must stand as it is: its diagonals are never merged.
    starts = F.when(F.col("exact") | apart.isNull() | (apart > voting.gap), 1).otherwise(0)
    in_span = [*template, "span"]
    whole = W.partitionBy(*in_span)
    # Half a template's words to either side, in units that do not depend on the template.
    beside = whole.orderBy(F.floor(F.col("diagonal") * (2 * UNITS) / F.col("words"))).rangeBetween(-UNITS, UNITS)
    within = lambda column: F.when(F.col("long"), column)
    chained = (
        diagonals.withColumn("span", F.sum(starts).over(along.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("long", ~F.col("exact") & (F.max("high").over(whole) + 2 - F.min("low").over(whole) > 2 * F.col("words")))
        .withColumns(
            {
                "found_beside": F.size(F.array_distinct(F.flatten(F.collect_list(within(F.col("matched"))).over(beside)))),
                "low_beside": F.min(within(F.col("low"))).over(beside),
                "high_beside": F.max(within(F.col("high"))).over(beside),
            }
        )
    )
    struct = lambda start, high, found: F.struct(
        "label", "exact", start.cast("long").alias("start"), (high + 2).cast("long").alias("stop"), (found / F.col("votes")).alias("coverage")
    )
    by_anchor = F.struct("diagonal", struct(F.col("low_beside"), F.col("high_beside"), F.col("found_beside")).alias("span"))
    covered = F.col("found_beside") >= voting.coverage * F.col("votes")
    merged = chained.groupBy(*in_span, "long").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("matched")))).alias("found"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.collect_list(F.when(F.col("long") & covered, by_anchor)).alias("anchors"),
    )
    verified = F.when(F.col("exact"), F.col("found") == F.col("votes")).otherwise(F.col("found") / F.col("votes") >= voting.coverage)
    one = F.when(verified, F.array(struct(F.col("low"), F.col("high"), F.col("found")))).otherwise(F.array())
    merged = merged.withColumn("spans", F.when(F.col("long"), _apart(F.col("anchors"), F.col("words"))).otherwise(one))
    return merged.groupBy("row", "id", "n_words").agg(F.flatten(F.collect_list("spans")).alias("spans")).select(
        F.col("id").alias(id_column), "n_words", "spans"
    )


def _labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def license_report(docs: DataFrame) -> DataFrame:
    found = find_licenses(docs, template_table(docs.sparkSession))
    base = F.filter("spans", lambda s: s["exact"])
    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )
