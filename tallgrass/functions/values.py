"""Coercion of raw text: numbers, dates, volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date formats that whole columns are tried against, in this order.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd", "yyyyMM", "MM-dd-yyyy", "yyyy/MM/dd")


def number(value: Column) -> Column:
    """A double; thousands separators go; anything else that is no number is NULL, NaN included."""
    d = F.regexp_replace(F.trim(value.cast("string")), ",", "").try_cast("double")
    return F.when(~F.isnan(d), d)


def volume(df: DataFrame, name: str | None) -> Column:
    """The column ``name`` as a volume; NULL where the source lacks it."""
    return number(F.col(name)) if name and name in df.columns else F.lit(None).cast("double")


def present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first of ``candidates`` that ``df`` has, in any case and with any blanks around."""
    have = {c.strip().lower(): c for c in reversed(df.columns)}
    return next((have[c.lower()] for c in candidates if c.lower() in have), None)


def first_of_month(year: Column, month: Column, low: int = 1, high: int = 9999) -> Column:
    """First day of the month; NULL where year or month is no number or out of range."""
    y, m = (c.cast("string").try_cast("double").try_cast("int") for c in (year, month))
    text = F.when(y.between(low, high) & m.between(1, 12), F.format_string("%04d-%02d-01", y, m))
    return F.try_to_date(text, "yyyy-MM-dd")


def parsed_date(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Dates of a text column in the one format that parses most of it (the earlier of equals), as first of month."""
    tries = [F.try_to_date(F.trim(F.col(name)), f) for f in formats]
    hits = df.agg(*(F.count(t).alias(str(i)) for i, t in enumerate(tries))).first()
    return F.trunc(tries[max(range(len(formats)), key=lambda i: (hits[i], -i))], "month")
