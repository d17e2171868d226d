"""Calendar helpers with the conventions the analyses use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(col) -> Column:
    return _c(col).cast("date")


def week_of_year_sun0(col) -> Column:
    """Week number with weeks starting on Sunday, 0-53.

    Days before the year's first Sunday are week 0 (the C ``%U`` convention).
    ISO ``weekofyear`` differs around new year, so it is not used.
    """
    d = _c(col)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def day_of_week_sun1(col) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_c(col))


def whole_minutes(start, end) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def days_between(later, earlier) -> Column:
    """Calendar days from ``earlier`` to ``later`` (dates of the values)."""
    return F.datediff(_c(later), _c(earlier))


def month_start(col) -> Column:
    return F.trunc(_c(col), "month")


def in_year(col: str, year: int, col_type: str = "date") -> Column:
    """``year(col) = year`` as a range on the raw column, which the parquet
    scan can use to skip row groups (a function of the column cannot)."""
    lo = F.lit(f"{year:04d}-01-01").cast(col_type)
    hi = F.lit(f"{year + 1:04d}-01-01").cast(col_type)
    return (F.col(col) >= lo) & (F.col(col) < hi)


def after_year(col: str, year: int, col_type: str = "date") -> Column:
    """``year(col) > year`` as a range on the raw column (pushed to the scan)."""
    return F.col(col) >= F.lit(f"{year + 1:04d}-01-01").cast(col_type)
