"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from niimble.functions.columns import col, ratio
from niimble.functions.constants import DAY_COUNT_BASIS


def month_starts(first: date | Column, months: int) -> Column:
    """Array of ``months`` consecutive month-first dates."""
    start = first if isinstance(first, Column) else F.lit(first)
    start = F.trunc(start, "MM")
    return F.sequence(start, F.add_months(start, months - 1), F.expr("interval 1 month"))


def month_of(c: str | Column) -> Column:
    return F.trunc(col(c).cast("date"), "MM")


def month_text(c: str | Column) -> Column:
    """The month as zero-padded text, e.g. ``2026-01-01``."""
    return F.date_format(col(c), "yyyy-MM-dd")


def days_in_month(c: str | Column) -> Column:
    return F.dayofmonth(F.last_day(col(c)))


def day_count_fraction(c: str | Column, basis: int = DAY_COUNT_BASIS) -> Column:
    """Days of the month over the year basis."""
    return ratio(days_in_month(c), F.lit(basis))
