"""Cleaning and enrichment of the five raw sources.

Each function takes a raw table (text or typed columns alike), keeps unknown columns and
returns the cleaned table with one row per business key. A number that does not fit its column is
NULL, and a row of `value_rejects` (rejects.py).
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesloom import config
from salesloom.functions.binning import bin_label
from salesloom.functions.dates import flag, parse_date
from salesloom.functions.numeric import AMOUNT, MONEY, amount, coerce_int, coerce_number, filled, percent, ratio, whole
from salesloom.functions.text import clean_email, clean_label
from salesloom.operators.dedup import dealt_by_key, keep_first, keep_first_of, repeated_keys
from salesloom.operators.quantile import approximate_quantile, exact_quantile


def _trimmed_id(df: DataFrame, name: str) -> Column:
    """Text ids lose outer blanks; numeric ids stay numbers, which join faster."""
    return F.trim(name) if isinstance(df.schema[name].dataType, T.StringType) else F.col(name)


def _source_order(df: DataFrame, key: str) -> list[str]:
    """The source's own columns decide between repeated ids; derived ones follow from them."""
    return [c for c in df.columns if c != key]


def _one_per_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    changed: Collection[str],
    clean: Callable[[DataFrame], DataFrame],
    repeated: Sequence[int] | None,
) -> DataFrame:
    """`keep_first_of` the cleaned rows, where `clean` adds or replaces the columns in `changed`.

    Unless the order asks for one of these, rows are dropped before they are made wider: narrow rows are sorted and
    shuffled, and only those that stay are cleaned.
    """
    if set(changed).isdisjoint({key, *order_by}):
        return clean(keep_first_of(df, key, order_by, repeated))
    return keep_first_of(clean(df), key, order_by, repeated)


def _active(col: Column) -> Column:
    return F.coalesce(coerce_int(col), F.lit(1))


def _amount(name: str) -> Column:
    """An amount, zero if it is missing or unreadable; NULL if it does not fit."""
    return filled(amount(F.col(name)), F.col(name), F.lit(0).cast(AMOUNT))


def _count(name: str, default: int) -> Column:
    return filled(whole(F.col(name)), F.col(name), F.lit(default).cast("bigint"))


def price_band(price: Column) -> Column:
    return bin_label(price, config.PRICE_BAND_EDGES, config.PRICE_BAND_LABELS)


def accepted_or_unknown(col: Column, accepted: Sequence[str]) -> Column:
    """Values outside the accepted set, NULL included, become Unknown."""
    return F.when(F.coalesce(col.isin(*accepted), F.lit(False)), col).otherwise(F.lit(config.UNKNOWN))


def clean_customers(df: DataFrame, as_of: date | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    joined = parse_date(df, "joined_date")
    until = F.current_date() if as_of is None else F.lit(as_of)
    tenure = F.datediff(until, F.col("joined_date"))
    scores = {"loyalty_score": coerce_number(F.col("loyalty_score"))} if "loyalty_score" in df.columns else {}
    cleaned = df.withColumns(
        {
            **scores,
            "customer_id": _trimmed_id(df, "customer_id"),
            "name": clean_label(F.col("name")),
            "email": clean_email(F.col("email")),
            "region": clean_label(F.col("region")),
            "segment": clean_label(F.col("segment")),
            "is_active": _active(F.col("is_active")),
            "joined_date": joined,
        }
    ).withColumns(
        {
            "joined_year": F.year("joined_date"),
            "joined_month": F.month("joined_date"),
            "tenure_days": F.when(tenure < 0, F.lit(0)).otherwise(tenure),
        }
    )
    return keep_first(cleaned, "customer_id", order_by or _source_order(df, "customer_id"))


def clean_products(
    df: DataFrame, price_fallback_factor: str = "1.5", order_by: Sequence[str] | None = None
) -> DataFrame:
    price, cost = F.col("unit_price"), F.col("unit_cost")
    fallback = F.round(amount(cost) * F.lit(price_fallback_factor).cast("decimal(6,3)"), 2).try_cast(AMOUNT)
    cleaned = (
        df.withColumns({"unit_cost": amount(cost), "unit_price": filled(amount(price), price, fallback)})
        .withColumns(
            {
                "margin_pct": percent(price - cost, price, 1),
                "price_band": price_band(price),
                "category": clean_label(F.col("category")),
                "is_active": F.when(price <= 0, F.lit(0)).otherwise(_active(F.col("is_active"))),
            }
        )
    )
    return keep_first(cleaned, "product_id", order_by or _source_order(df, "product_id"))


def clean_orders(
    df: DataFrame,
    high_value_quantile: float = 0.95,
    exact: bool = True,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """The high-value mark compares with the quantile of all rows, repeated ids included."""
    parsed = df.withColumns(
        {
            "order_date": parse_date(df, "order_date"),
            "shipped_date": parse_date(df, "shipped_date"),
            "order_total": _amount("order_total"),
            "order_profit": _amount("order_profit"),
            "num_items": _count("num_items", 1),
            "status": accepted_or_unknown(clean_label(F.col("status")), config.ORDER_STATUSES),
            "channel": clean_label(F.col("channel")),
        }
    )
    quantile = exact_quantile if exact else approximate_quantile
    threshold = quantile(parsed, "order_total", high_value_quantile).scalar()
    day, lag = F.col("order_date"), F.datediff("shipped_date", "order_date")
    derived = {
        "order_year": F.year(day),
        "order_month": F.month(day),
        "order_quarter": F.quarter(day),
        "order_dow": F.date_format(day, "EEEE"),
        "order_week": F.weekofyear(day),
        "fulfillment_days": F.when(lag >= 0, lag),
        "is_revenue": flag(F.col("status") == config.REVENUE_STATUS),
        "is_high_value": flag(F.col("order_total").cast("double") > threshold),
        "has_zero_total": flag(F.col("order_total") == 0),
    }
    order = order_by or _source_order(df, "order_id")
    return _one_per_key(
        parsed, "order_id", order, derived, lambda rows: rows.withColumns(derived), repeated_keys(df, "order_id")
    )


def _line_values() -> tuple[dict[str, Column], dict[str, Column], dict[str, Column]]:
    """What cleaning makes of a line's columns, in three steps."""
    amounts = {name: _amount(name) for name in ("unit_price", "discount_pct", "discount_amt", "line_total", "line_profit")}
    quantity, total = _count("quantity", 0), F.col("line_total")
    coerced = {**amounts, "quantity": F.when(quantity < 1, F.lit(1)).otherwise(quantity)}
    floored = {"line_total": F.when(total < 0, F.lit(0).cast(AMOUNT)).otherwise(total)}
    return coerced, floored, {"effective_unit_price": F.col("unit_price") - F.col("discount_amt")}


def with_clean_values(lines: DataFrame) -> DataFrame:
    """Order lines with their values cleaned, for sources known to have one line per id."""
    for step in _line_values():
        lines = lines.withColumns(step)
    return lines


def clean_order_items(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    coerced, floored, price = _line_values()
    order = order_by or _source_order(df, "item_id")
    repeated = repeated_keys(df, "item_id")
    df = dealt_by_key(df, "item_id") if repeated is None else df
    if not set(price).isdisjoint(order):
        return keep_first_of(df.withColumns(coerced).withColumns({**floored, **price}), "item_id", order, repeated)
    kept = _one_per_key(
        df, "item_id", order, {**coerced, **floored}, lambda rows: rows.withColumns(coerced).withColumns(floored), repeated
    )
    return kept.withColumns(price)


CAMPAIGN_FIGURES = (
    "start_date", "end_date", "budget", "spend", "revenue_generated", "impressions", "clicks", "conversions",
    "ctr", "conversion_rate", "roi",
)


def clean_campaigns(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Figures that the source does not have at all, which the column contract reports, count as missing."""
    df = df.withColumns({c: F.lit(None).cast("string") for c in CAMPAIGN_FIGURES if c not in df.columns})
    amounts = {name: _amount(name) for name in ("budget", "spend", "revenue_generated")}
    counts = {name: _count(name, 0) for name in ("impressions", "clicks", "conversions")}
    rates = {
        name: F.round(F.col(name).try_cast("decimal(18,6)"), digits)
        for name, digits in (("ctr", 3), ("conversion_rate", 3), ("roi", 2))
    }
    cleaned = df.withColumns(
        {
            "start_date": parse_date(df, "start_date"),
            "end_date": parse_date(df, "end_date"),
            **amounts,
            **counts,
            **rates,
        }
    ).withColumns({"duration_days": F.datediff("end_date", "start_date"), **campaign_efficiency()})
    return keep_first(cleaned, "campaign_id", order_by or _source_order(df, "campaign_id"))


def campaign_efficiency() -> dict[str, Column]:
    """Cost per click and conversion, return on spend; NULL where the divisor is zero."""
    spend = F.col("spend")
    return {
        "cost_per_click": ratio(spend, F.col("clicks"), 2),
        "cost_per_conv": ratio(spend, F.col("conversions"), 2),
        "roas": ratio(F.col("revenue_generated"), spend, 2),
    }


def campaign_rates(df: DataFrame) -> DataFrame:
    """Click and conversion rates and return on investment from the raw counts; 0 without a base."""
    spend = F.col("spend")
    zero = F.lit(0)
    return df.withColumns(
        {
            "ctr": F.coalesce(percent(F.col("clicks"), F.col("impressions"), 3), zero),
            "conversion_rate": F.coalesce(percent(F.col("conversions"), F.col("clicks"), 3), zero),
            "roi": F.coalesce(percent(F.col("revenue_generated") - spend, spend, 2), zero),
        }
    )


def line_economics(lines: DataFrame) -> DataFrame:
    """Discount, total and profit of a line from price, cost, quantity and discount percent."""
    price, net = F.col("unit_price"), F.col("unit_price") - F.col("discount_amt")
    return lines.withColumn("discount_amt", F.round(price * F.col("discount_pct") / 100, 2).cast(MONEY)).withColumns(
        {
            "line_total": F.round(net * F.col("quantity"), 2).cast(MONEY),
            "line_profit": F.round((net - F.col("unit_cost")) * F.col("quantity"), 2).cast(MONEY),
        }
    )


def order_rollup(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order totals from their lines; cancelled and returned orders are worth nothing.

    Lines are summed before they meet the orders, so an order with very many lines is one row
    by the time it is joined.
    """
    sums = lines.groupBy("order_id").agg(
        F.sum("line_total").alias("lines_total"),
        F.sum("line_profit").alias("lines_profit"),
        F.count(F.lit(1)).alias("num_items"),
    )
    void = F.col("status").isin("Cancelled", "Returned")

    def worth(name: str) -> Column:
        return F.when(void, F.lit(0)).otherwise(F.coalesce(F.col(name), F.lit(0))).cast("decimal(28,2)")

    return orders.select("order_id", "status").join(sums, "order_id", "left").select(
        "order_id",
        "status",
        worth("lines_total").alias("order_total"),
        worth("lines_profit").alias("order_profit"),
        F.coalesce("num_items", F.lit(0)).alias("num_items"),
    )


def orders_summary(orders: DataFrame) -> DataFrame:
    completed = F.col("status") == config.REVENUE_STATUS
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(completed).alias("completed_orders"),
        F.coalesce(F.sum(F.when(completed, F.col("order_total"))), F.lit(0)).alias("completed_total"),
    )


def transform(
    source: str, raw: DataFrame, settings: config.Settings, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Clean one source by its name."""
    if source == "customers":
        return clean_customers(raw, settings.as_of, order_by)
    if source == "products":
        return clean_products(raw, settings.price_fallback_factor, order_by)
    if source == "orders":
        return clean_orders(raw, settings.high_value_quantile, order_by=order_by)
    if source == "order_items":
        return clean_order_items(raw, order_by)
    if source == "campaigns":
        return clean_campaigns(raw, order_by)
    raise LookupError(f"unknown source '{source}'")


def transform_all(raw: dict[str, DataFrame], settings: config.Settings) -> dict[str, DataFrame]:
    """Clean every source that is present; absent ones are left out."""
    return {source: transform(source, df, settings) for source, df in raw.items()}
