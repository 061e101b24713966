"""Months and day counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    """First day of the month: a 4-byte grouping key, cheaper to hash and shuffle than its text form."""
    return F.trunc(c, "MM")


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def prev_month_key(c: Column) -> Column:
    """Calendar month before a ``YYYY-MM`` key, whether or not that month has rows."""
    return month_key(F.add_months(F.to_date(F.concat(c, F.lit("-01"))), -1))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)
