"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# A private-use character that marks where a blank was put in.
_MARK = "\ue000"


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    `initcap` only starts a word after a blank, so `sales-rep` would become `Sales-rep`. A
    marked blank in front of every run of letters makes it start words after hyphens, quotes
    and digits too, without leaving built-in string functions.
    """
    spaced = F.regexp_replace(col, r"(?<=\P{L})(?=\p{L})", f"{_MARK} ")
    return F.replace(F.initcap(spaced), F.lit(f"{_MARK} "), F.lit(""))


def clean_label(col: Column) -> Column:
    return title_case(F.trim(col))


def clean_email(col: Column) -> Column:
    return F.lower(F.trim(col))


def short_label(col: Column, words: int = 2) -> Column:
    return F.substring_index(col, " ", words)
