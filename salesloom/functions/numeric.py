"""Money, ratios and rounding.

Amounts as they come are DECIMAL(24,4): twenty digits before the point, and nothing is rounded
before the reference would round. What the warehouse computes from them is money,
DECIMAL(18,2): an eight-byte value whose sums do not depend on the order of partitions. A
number that does not fit is NULL, never another number, and a row of `value_rejects`. Rounding is half away from zero and always happens
on decimals, because binary doubles round differently from engine to engine. Results turn into
doubles once, in `publish`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = "decimal(18,2)"
AMOUNT = "decimal(24,4)"


def money(col: Column) -> Column:
    """Coerce to money; anything unreadable (text, NaN) becomes NULL."""
    return col.try_cast(MONEY)


def amount(col: Column) -> Column:
    """Coerce to an amount; anything unreadable (text, NaN) and a number of more than twenty digits become NULL."""
    return col.try_cast(AMOUNT)


def is_number(col: Column) -> Column:
    """Whether a value reads as a number, of whatever size; never NULL."""
    number = col.try_cast("double")
    return number.isNotNull() & ~F.isnan(number)


def filled(value: Column, col: Column, default: Column) -> Column:
    """`value`, which `col` was coerced to, or the default if `col` is missing or unreadable. A number that did not fit stays NULL."""
    return F.when(value.isNotNull() | is_number(col), value).otherwise(default)


def whole(col: Column, kind: str = "bigint") -> Column:
    """Coerce to a whole number, dropping a fraction such as that of 12.0; one that does not fit becomes NULL."""
    return F.coalesce(col.try_cast(kind), col.try_cast("decimal(38,10)").try_cast(kind))


def coerce_number(col: Column) -> Column:
    """Coerce to double; anything unreadable (text, NaN) becomes NULL."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def coerce_int(col: Column) -> Column:
    """Coerce to a whole number of 32 bits, dropping the fraction."""
    return whole(col, "int")


def zero_if_null(col: Column, decimals: int) -> Column:
    """NULL becomes zero, then round: the display default of a missing figure."""
    return F.round(F.coalesce(col, F.lit(0)), decimals)


def ratio(numerator: Column, denominator: Column, decimals: int) -> Column:
    """Rounded quotient of exact numbers; NULL when the denominator is zero."""
    return F.round(F.try_divide(numerator, denominator), decimals)


def percent(part: Column, whole: Column, decimals: int) -> Column:
    return ratio(part * F.lit(100), whole, decimals)


def mean(total: Column, count: Column, decimals: int) -> Column:
    """Average from an exact sum, independent of the order in which rows arrive."""
    return ratio(total, count, decimals)


def publish(df: DataFrame) -> DataFrame:
    """Hand results out: decimals become doubles, everything else stays."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _grouped_digits(whole: Column) -> Column:
    """Indian digit grouping: the last three digits, then pairs."""
    return F.regexp_replace(whole, r"(\d)(?=(\d\d)+\d$)", "$1,")


def _indian_locale(amount: Column) -> Column:
    """Grouped number with up to three decimals and no trailing zeros."""
    text = F.round(amount, 3).cast("decimal(38,3)").cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.ltrim(text, F.lit("-"))
    whole = F.substring_index(digits, ".", 1)
    fraction = F.rtrim(F.substring_index(digits, ".", -1), F.lit("0"))
    return F.concat(
        sign,
        _grouped_digits(whole),
        F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
    )


def compact_money(amount: Column, symbol: str = "₹", crore_suffix: str = " Cr") -> Column:
    """₹1.2 Cr from ten million, ₹3.4L from a hundred thousand, grouped digits below."""
    amount = amount.cast("decimal(38,3)")

    def scaled(unit: int) -> Column:
        return F.round(amount / F.lit(unit), 1).cast("decimal(38,1)").cast("string")

    return (
        F.when(amount >= 10_000_000, F.concat(F.lit(symbol), scaled(10_000_000), F.lit(crore_suffix)))
        .when(amount >= 100_000, F.concat(F.lit(symbol), scaled(100_000), F.lit("L")))
        .otherwise(F.concat(F.lit(symbol), _indian_locale(amount)))
    )


def compact_number(amount: Column) -> Column:
    """The short form of `compact_money`: no symbol, no space."""
    return compact_money(amount, symbol="", crore_suffix="Cr")


def bubble_size(units: Column) -> Column:
    """Marker size: grows with the root of the units, never below eight."""
    effective = F.when(F.coalesce(units, F.lit(0)) == 0, F.lit(1)).otherwise(units)
    return F.greatest(F.lit(8.0), F.sqrt(effective.cast("double")) * F.lit(1.5))
