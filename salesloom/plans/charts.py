"""Chart data: pivots, shares, labels and long series over the report tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from salesloom.functions.numeric import bubble_size, compact_money, compact_number, mean, percent
from salesloom.functions.text import short_label


def cohort_matrix(
    listed: DataFrame, cohorts: int = 12, months: Sequence[str] | None = None, month_count: int = 24
) -> DataFrame:
    """First cohorts by first activity months of a cohort list; a missing pair is NULL.

    A heat map shows so many `cohorts` and so many months; the months become columns, so their
    labels, at most `month_count`, are looked up unless given.
    """
    if months is None:
        labels = listed.select("activity_month").distinct().orderBy("activity_month").limit(month_count)
        months = [row[0] for row in labels.collect()]
    kept = listed.select("cohort_month").distinct().orderBy("cohort_month").limit(cohorts)
    return (
        listed.join(F.broadcast(kept), "cohort_month")
        .groupBy("cohort_month")
        .pivot("activity_month", list(months))
        .agg(F.max("revenue"))
        .orderBy("cohort_month")
    )


def roi_by_type(campaigns: DataFrame) -> DataFrame:
    """Mean return per campaign type; a campaign without one counts as zero, not as absent."""
    return (
        campaigns.groupBy("campaign_type")
        .agg(mean(F.sum(F.coalesce("roi_pct", F.lit(0))), F.count(F.lit(1)), 1).alias("avg_roi"))
        .orderBy(F.desc("avg_roi"), "campaign_type")
    )


def share_of_total(df: DataFrame, dimension: str, label: str, measure: str) -> DataFrame:
    """Each label's value and its percentage of all labels together."""
    shaped = df.select(
        F.lit(dimension).alias("dimension"),
        F.lit(measure).alias("measure"),
        F.col(label).alias("label"),
        F.col(measure).cast("decimal(38,2)").alias("value"),
    )
    total = F.sum("value").over(W.partitionBy("dimension", "measure"))
    return shaped.withColumn("pct", percent(F.col("value"), total, 1))


def revenue_shares(
    categories: DataFrame, tiers: DataFrame, segments: DataFrame, channels: DataFrame
) -> DataFrame:
    parts = [
        share_of_total(categories, "category", "category", "revenue"),
        share_of_total(tiers, "ltv_tier", "ltv_tier", "revenue"),
        share_of_total(tiers, "ltv_tier", "ltv_tier", "customers"),
        share_of_total(segments, "segment", "segment", "revenue"),
        share_of_total(channels, "channel", "channel", "revenue"),
    ]
    return reduce(DataFrame.unionByName, parts)


def money_labels(df: DataFrame, label: str, measure: str) -> DataFrame:
    return df.select(
        F.col(label).alias("label"),
        F.col(measure).alias("amount"),
        compact_money(F.col(measure)).alias("display"),
        compact_number(F.col(measure)).alias("display_short"),
    )


def product_bubbles(products: DataFrame) -> DataFrame:
    return products.select(
        "product_name",
        short_label(F.col("product_name")).alias("label"),
        "category", "revenue", "margin",
        bubble_size(F.col("units")).alias("bubble_size"),
    )


def campaigns_by_type(campaigns: DataFrame) -> DataFrame:
    """One series per campaign type, as rows: a series can be as long as there are campaigns."""
    return campaigns.select("campaign_type", "campaign_name", "budget", "revenue").orderBy(
        "campaign_type", F.desc("revenue"), "campaign_name"
    )


def long_series(df: DataFrame, entity: str, measures: Sequence[str]) -> DataFrame:
    """Wide figures to rows of (entity, metric, value), for stacked and grouped bars."""
    numbers = [F.col(m).cast("decimal(38,2)").alias(m) for m in measures]
    return df.select(F.col(entity).alias("entity"), *numbers).unpivot("entity", list(measures), "metric", "value")
