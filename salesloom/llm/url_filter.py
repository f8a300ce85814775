"""URL rules by host and path: expand, join on short digests, confirm, let the longest win.

Every URL becomes all pairs of a host suffix and a directory prefix of its path, no deeper than
the deepest rule (deeper ones could fit none). The pairs meet the rules in an equi-join on the
first eight hex digits of their SHA-256; the full digest, and the part of a rule's path after its
last slash, are compared afterwards. The rules are an ordinary table: Spark broadcasts them
while they are small and shuffles both sides otherwise, splitting hot suffixes such as `com`.

Defined cases: a URL that is NULL or has no `://` has an empty host and path, which only a rule with both empty
would fit; an empty path fits no rule whose path begins with a slash. Repeated
rows are judged one by one. Of rules of equal length the one with the longer host wins, then `block`.
Columns besides id and url are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom.llm.common import ascii_lower, parameter_table

SHORT_DIGITS = 8
#: The rules of the registered query: verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return parameter_table(spark, list(rules), ["verdict", "host", "path"])


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _suffixes(host: Column, most_labels: Column | int) -> Column:
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most_labels))),
        lambda i: F.array_join(F.slice(labels, n - i + 1, i), "."),
    )


def _directories(path: Column, most_slashes: Column | int) -> Column:
    """'' and every prefix that ends in one of the first slashes."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most_slashes))),
        lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """One row per page: id, host, path, the rule that decides (or NULL) and the verdict."""
    directory = F.regexp_extract("path", "^(?s:.*)/", 0)
    judged = rules.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"),
        F.sha2(F.concat(ascii_lower(F.col("host")), directory), 256).alias("r_digest"),
        F.size(F.split("host", r"\.")).alias("labels"), (F.size(F.split("path", "/")) - 1).alias("slashes"),
    )
    deepest = judged.agg(F.max("labels"), F.max("slashes")).first()
    labels, slashes = deepest[0] or 1, deepest[1] or 0
    rule = judged.select("r_host", "r_path", "r_verdict", "r_digest", F.substring("r_digest", 1, SHORT_DIGITS).alias("r_short"))
    host, path = host_and_path(F.col(url_column))
    urls = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), host.alias("host"), path.alias("path")
    )
    expressions = urls.withColumn("suffix", F.explode(_suffixes(F.col("host"), labels))).withColumn(
        "digest", F.explode(F.transform(_directories(F.col("path"), slashes), lambda d: F.sha2(F.concat("suffix", d), 256)))
    )
    fits = (
        (F.substring("digest", 1, SHORT_DIGITS) == F.col("r_short"))
        & (F.col("digest") == F.col("r_digest"))
        & F.startswith(F.col("path"), F.col("r_path"))
    )
    weight = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), "r_verdict")
    best = F.max(F.when(F.col("r_digest").isNotNull(), F.struct(weight.alias("weight"), F.concat("r_host", "r_path").alias("rule"))))
    return (
        expressions.join(rule, fits, "left")
        .groupBy("row", "id", "host", "path")
        .agg(best.alias("best"))
        .select(
            F.col("id").alias(id_column), "host", "path", F.col("best.rule").alias("rule"),
            F.coalesce(F.col("best.weight.r_verdict"), F.lit(otherwise)).alias("verdict"),
        )
    )

