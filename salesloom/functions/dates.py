"""Dates and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def parse_date(df: DataFrame, name: str) -> Column:
    """ISO text, with a time of day or without, to a date; unreadable text to NULL; typed dates and
    timestamps pass through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.col(name)
        # A format that does not fit costs an exception, so a text with a time of day is read as what it is first.
        plain, timed = F.try_to_date(text, "yyyy-MM-dd"), F.try_to_timestamp(text).cast("date")
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]"), F.coalesce(timed, plain)).otherwise(plain)
    return F.col(name).cast("date")


def date_key(col: Column) -> Column:
    return (F.year(col) * 10_000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def fiscal_year(col: Column) -> Column:
    """April to March, named after the year it starts in."""
    return F.year(F.add_months(col, -3))


def fiscal_quarter(col: Column) -> Column:
    return F.quarter(F.add_months(col, -3))


def flag(condition: Column) -> Column:
    return condition.cast("int")
