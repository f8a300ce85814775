"""Quality rules of documents, with cross-document line frequency per host.

One pass over the texts computes every figure that a document has by itself, and a hash and word
count for each of its lines; it is written to the shared folder, and everything else works on
that table, some fifth of the texts' size. Lines are normalised (spaces collapsed, lower case), hashed, and
counted per host over distinct texts, so that exact copies of one document do not turn its lines
into boilerplate. A line above the limit of its host is removed; a document is rejected if
what remains of it is too little. Only DataFrame functions are used.

Skew: counts are pre-aggregated before each shuffle, and the frequent lines of a host are at most
(mean lines of its texts) / share many, so a host's list is small however large the host is.

Defined cases: a NULL text has no words and fails the base rule; a NULL host is the host ''; repeated rows are
judged one by one and count as one text; an empty table gives no rows; a very long text is one row like any other, its lines
as hashes; columns with other names pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import SPACES, kept, split_words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Limits:
    """`line_share`: a line of more than this share of a host's texts is boilerplate, if at least
    `line_texts` texts have it.
    A document is depleted if under `least_words` words or under `least_percent` of them remain.
    `spare_copies`: texts that the lines above the limit would deplete are near copies, and no evidence of boilerplate."""

    least_words: int = 10
    repeat_percent: int = 20
    line_texts: int = 20
    line_share: float = 0.4
    least_percent: int = 30
    spare_copies: bool = False


# What the corpus pipeline strips, and what the report judges by: there a line of few texts counts as well, as hosts may be small.
BOILERPLATE = Limits(line_share=0.03, spare_copies=True)
REPORTED = Limits(line_share=0.03, line_texts=5, spare_copies=True)


def _measured(docs: DataFrame, text: Column, host: Column) -> DataFrame:
    """The columns of `docs` and their figures, all named `_q_…`."""
    words = split_words(F.col("_q_text"), SPACES)
    lines = F.filter(F.split(F.col("_q_text"), "\n"), lambda line: line.rlike(_WORD))
    normal = lambda line: F.trim(F.regexp_replace(F.lower(line), SPACES, " "))
    hashes = F.col("_q_hashes")
    window = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)])
    starts = F.col("_q_starts")
    repeats = F.size(F.array_distinct(starts)) < F.size(starts)
    by_hash = F.array_sort(F.transform(starts, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = F.col("_q_ordered")
    again = F.filter(
        ordered,
        lambda x, i: (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]),
    )
    covered = F.aggregate(
        F.array_sort(F.transform(again, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + WINDOW - F.greatest(F.lit(0), a["end"] - i)).alias("n"), (i + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    plain = F.col("_q_text")
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    symbols = F.length("_q_text") - F.length(plain)
    spaces = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    return (
        docs.withColumns({"_q_text": F.coalesce(text, F.lit("")), "_q_host": F.coalesce(host, F.lit(""))})
        .withColumns({"_q_words": words, "_q_lines": lines})
        .withColumns(
            {
                "_q_n_words": F.size("_q_words").cast("long"),
                "_q_hashes": F.transform("_q_words", lambda w: F.xxhash64(w)),
                "_q_word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
                "_q_n_symbols": symbols.cast("long"),
                "_q_n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
                # The words of a normalised line stand one space apart.
                "_q_line_hashes": F.transform(
                    F.transform("_q_lines", normal),
                    lambda x: F.struct(F.xxhash64(x).alias("h"), (spaces(x) + 1).alias("w")),
                ),
                "_q_text_hash": F.xxhash64("_q_text"),
            }
        )
        .withColumn(
            "_q_starts",
            F.when(
                F.size("_q_hashes") >= WINDOW,
                F.transform(F.sequence(F.lit(0), F.size("_q_hashes") - WINDOW), window),
            ).otherwise(F.array().cast("array<bigint>")),
        )
        .withColumn("_q_ordered", F.when(repeats, by_hash))
        .withColumn("_q_n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_q_text", "_q_words", "_q_lines", "_q_hashes", "_q_starts", "_q_ordered")
    )


def _of_frequent(field: str) -> Column:
    return F.transform(F.filter("_q_line_hashes", lambda x: F.array_contains("_q_frequent", x["h"])), lambda x: x[field])


def _removed() -> Column:
    """Words of the lines in `_q_frequent`; 0 if it is NULL."""
    removed = F.aggregate(_of_frequent("w"), F.lit(0).cast("long"), lambda total, w: total + w)
    return F.when(F.col("_q_frequent").isNull(), F.lit(0).cast("long")).otherwise(removed)


def _enough(left: Column, limits: Limits) -> Column:
    return (left >= limits.least_words) & (100 * left >= limits.least_percent * F.col("_q_n_words"))


def frequent_lines(measured: DataFrame, limits: Limits) -> DataFrame:
    """Per host, the hashes of its lines above the limit; hosts without any are left out."""
    totals = measured.select("_q_host", "_q_text_hash").distinct().groupBy("_q_host").agg(F.count("*").alias("texts"))

    def above(docs: DataFrame, hashes: Column, name: str) -> DataFrame:
        lines = docs.select("_q_host", "_q_text_hash", F.explode(F.array_distinct(hashes)).alias("h")).distinct()
        counted = lines.groupBy("_q_host", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= limits.line_texts)
        over = counted.join(totals, "_q_host").filter(F.col("n") > limits.line_share * F.col("texts"))
        # Written, so that the planner knows how small it is and does not deal the documents out by host.
        return kept(over.groupBy("_q_host").agg(F.collect_set("h").alias("_q_frequent")), name)

    frequent = above(measured, F.col("_q_line_hashes.h"), "frequent")
    if not limits.spare_copies:
        return frequent
    # Near copies share nearly all their lines, which are counted again over the texts that keep enough of their own.
    others = measured.join(frequent, "_q_host").filter(_enough(F.col("_q_n_words") - _removed(), limits))
    return above(others, _of_frequent("h"), "boilerplate")


def judge_quality(
    docs: DataFrame, text_column: str = "text", host_column: str = "source", limits: Limits | None = None
) -> DataFrame:
    """The rows of `docs` with their figures and verdicts in columns named `_q_…`, and `_q_frequent`, the hashes of
    the lines that its host may not keep (NULL: none)."""
    limits = limits or Limits()
    measured = kept(_measured(docs, F.col(text_column), F.col(host_column)), "quality")
    n = F.col("_q_n_words")
    left = n - F.col("_q_removed_words")
    return (
        measured.join(frequent_lines(measured, limits), "_q_host", "left")
        .withColumn("_q_removed_words", _removed())
        .withColumn("_q_base_failed", (n < limits.least_words) | (100 * F.col("_q_n_repeat_words") > limits.repeat_percent * n))
        .withColumn("_q_kept", ~F.col("_q_base_failed") & _enough(left, limits))
    )


def without_frequent_lines(text: Column) -> Column:
    """The text without the lines in `_q_frequent`; the same text if it has none of them."""
    normal = lambda line: F.trim(F.regexp_replace(F.lower(line), SPACES, " "))
    kept_lines = F.filter(
        F.split(text, "\n"), lambda x: ~(x.rlike(_WORD) & F.array_contains("_q_frequent", F.xxhash64(normal(x))))
    )
    return F.when(F.col("_q_removed_words") > 0, F.array_join(kept_lines, "\n")).otherwise(text)


def apply_quality(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Documents that pass, without the lines their host repeats; `n_chars` follows the text."""
    judged = judge_quality(docs, limits=limits or BOILERPLATE).filter("_q_kept")
    changed = judged.withColumn("text", without_frequent_lines(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.when(F.col("_q_removed_words") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        changed = changed.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))
    return changed.select(*docs.columns)


def quality_report(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """The base figures and the verdict of every document, and the words of its lines that are boilerplate of its host."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")
    return judge_quality(docs.select("doc_id", "text", "source"), limits=limits or REPORTED).select(
        "doc_id", *[F.col(f"_q_{name}").alias(name) for name in names]
    )
