"""Column expressions that turn raw text into typed values without raising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the feed's format.
DATE_FORMAT = "dd-MMM-yyyy"
DATE_PATTERN = r"\A[0-9]{2}-[A-Za-z]{3}-[0-9]{4}\z"
SERIES_PATTERN = r"\AFXR[A-Z0-9]+\z"
NON_FINITE_WORDS = ("NAN", "INFINITY", "+INFINITY", "-INFINITY", "INF", "+INF", "-INF")


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trim spaces; blank text becomes NULL."""
    return F.nullif(F.trim(_column(c)), F.lit(""))


def has_format(c: Column | str, pattern: str) -> Column:
    """Whole-text pattern test that is FALSE, never NULL, for missing text."""
    return F.coalesce(_column(c).rlike(pattern), F.lit(False))


def in_calendar(day: Column) -> Column:
    """The day, or NULL where its year is 0."""
    return F.when(F.year(day) >= 1, day)


def parse_date(c: Column | str, fmt: str = DATE_FORMAT, pattern: str = DATE_PATTERN) -> Column:
    """Calendar date, or NULL.  Text must match `pattern`; year 0 is no date."""
    text = _column(c)
    return in_calendar(F.try_to_date(F.when(has_format(text, pattern), text), fmt))


def is_non_finite(c: Column | str) -> Column:
    return F.coalesce(F.upper(_column(c)).isin(*NON_FINITE_WORDS), F.lit(False))


def parse_decimal(c: Column | str, precision: int = 20, scale: int = 8) -> Column:
    """Decimal of the given size, or NULL for anything that does not fit it.

    Non-finite words are no decimals, so the safe cast excludes them too.
    """
    return _column(c).try_cast(f"decimal({precision},{scale})")
