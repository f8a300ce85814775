"""Values that a column cannot hold, set aside with their text.

Cleaning gives a missing or unreadable value its default and leaves a number beyond its column's type NULL. Either
way the text that was there is a row here, so nothing is rewritten unseen and no value stops a run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions.dates import parse_date
from salesloom.functions.numeric import AMOUNT, is_number, whole

UNREADABLE, OUT_OF_RANGE = "unreadable", "out of range"

#: Columns that are not text, by source, and what they hold.
KINDS = {
    "customers": {"joined_date": "date", "is_active": "int", "loyalty_score": "double"},
    "products": {"unit_cost": AMOUNT, "unit_price": AMOUNT, "is_active": "int"},
    "orders": {"order_date": "date", "shipped_date": "date", "order_total": AMOUNT, "order_profit": AMOUNT, "num_items": "bigint"},
    "order_items": {
        "quantity": "bigint", "unit_price": AMOUNT, "discount_pct": AMOUNT, "discount_amt": AMOUNT, "line_total": AMOUNT,
        "line_profit": AMOUNT,
    },
    "campaigns": {
        "start_date": "date", "end_date": "date", "budget": AMOUNT, "spend": AMOUNT, "revenue_generated": AMOUNT,
        "impressions": "bigint", "clicks": "bigint", "conversions": "bigint", "ctr": "decimal(18,6)",
        "conversion_rate": "decimal(18,6)", "roi": "decimal(18,6)",
    },
}
KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "item_id", "campaigns": "campaign_id"}


def _held(df: DataFrame, name: str, kind: str) -> Column:
    """The value as cleaning reads it, NULL if it does not."""
    if kind == "date":
        return parse_date(df, name)
    return whole(F.col(name), kind) if kind in ("int", "bigint") else F.col(name).try_cast(kind)


def value_rejects(source: str, raw: DataFrame) -> DataFrame:
    """(source, key, column, raw_text, reason) of every value that is there and that its column cannot hold.

    One pass without a shuffle. A value is there if it is neither NULL, blank nor NaN. Infinity, and a number too
    large for its column, are out of range; what is no number or no date is unreadable.
    """
    findings = []
    for name, kind in KINDS[source].items():
        if name not in raw.columns:
            continue
        text = F.trim(F.col(name).cast("string"))
        there = (text != "") & (F.lower(text) != "nan")
        fits = F.col(name).try_cast("double").isNotNull() & ~text.rlike("(?i)inf") if kind == "double" else _held(raw, name, kind).isNotNull()
        reason = F.lit(UNREADABLE) if kind == "date" else F.when(is_number(F.col(name)), F.lit(OUT_OF_RANGE)).otherwise(F.lit(UNREADABLE))
        finding = F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("raw_text"), reason.alias("reason"))
        findings.append(F.when(there & ~fits, finding))
    found = F.filter(F.array(*findings), lambda x: x.isNotNull())
    return raw.select(F.lit(source).alias("source"), F.col(KEYS[source]).cast("string").alias("key"), F.inline(found))


def all_value_rejects(raw: dict[str, DataFrame]) -> DataFrame:
    """The rejects of all sources that are there and have their key."""
    return reduce(DataFrame.unionByName, [value_rejects(source, df) for source, df in raw.items() if KEYS[source] in df.columns])


def value_reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("source", "column", "reason").agg(F.count(F.lit(1)).alias("values"))
