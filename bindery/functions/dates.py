"""Dates of issues, deletions and lists. Time stamps are UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bindery.functions.ids import col


def partial_date(text: Column | str) -> Column:
    """``d.m.Y`` or a year alone (its 1 January); null for anything else."""
    text = col(text)
    full = F.when(
        text.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.try_to_date(text, "d.M.yyyy")
    )
    year = F.when(text.rlike(r"^\d{4}$"), F.try_to_date(text, "yyyy"))
    found = F.coalesce(full, year)
    return F.when(F.year(found) >= 1, found)


def utc_midnight(from_date: str) -> Column:
    """Start of a ``YYYY-MM-DD`` day in UTC, the inclusive threshold of listings."""
    return F.to_timestamp(F.lit(f"{from_date}T00:00:00Z"))


def since(datestamp: Column | str, from_date: str | None) -> Column:
    """At or after the start of the given day; always true without one."""
    if from_date is None:
        return F.lit(True)
    return col(datestamp) >= utc_midnight(from_date)


def within(date: Column | str, start: str | None, end: str | None) -> Column:
    """Inclusive, open-ended range; rows without a date are out.

    The bounds are given in the same forms as issue dates.
    """
    date = col(date)
    kept = date.isNotNull()
    if start:
        kept = kept & (date >= _bound(start))
    if end:
        kept = kept & (date <= _bound(end))
    return kept


def _bound(text: str) -> Column:
    return F.coalesce(
        partial_date(F.lit(text)),
        F.raise_error(F.lit(f"not a date: {text}")).cast("date"),
    )
