"""Numeric expressions. Every division is guarded: ANSI mode raises on zero."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import VALUE

# Texts the publishers use for "no data".
MISSING_TOKENS = ["", "-", "–", "—", "...", "na", "n/a", "null"]


def dbl(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def exact(column) -> Column:
    """Fixed-point copy of a value, so that sums do not depend on row order."""
    return (F.col(column) if isinstance(column, str) else column).cast(VALUE)


def rounded(column, digits: int = 6) -> Column:
    return F.round(dbl(column), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    return dbl(numerator) / F.nullif(dbl(denominator), F.lit(0.0))


def is_finite(column: Column) -> Column:
    value = dbl(column)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def safe_percent_change(value: Column, previous: Column) -> Column:
    """Percent change against the size of the previous value; NULL when that is zero."""
    return 100 * dbl(value - previous) / F.nullif(dbl(F.abs(previous)), F.lit(0.0))


def growth_percent(value: Column, previous: Column) -> Column:
    """Signed growth: a negative previous value flips the sign; zero, and what is not finite, give NULL."""
    growth = (dbl(value) / F.nullif(dbl(previous), F.lit(0.0)) - 1) * 100
    return F.when(is_finite(growth), growth)


def numeric_token(text: Column) -> Column:
    """Number text to double; a missing token gives NULL (see `numeric_token_issue`)."""
    cleaned = F.trim(text)
    missing = F.lower(cleaned).isin(MISSING_TOKENS)
    number = F.when(~missing & ~F.contains(cleaned, F.lit(",")), cleaned).try_cast("double")
    return F.when(is_finite(number), number)


def numeric_token_issue(text: Column) -> Column:
    cleaned = F.trim(text)
    number = cleaned.try_cast("double")
    return (
        F.when(text.isNull() | F.lower(cleaned).isin(MISSING_TOKENS), None)
        .when(F.contains(cleaned, F.lit(",")), "ambiguous_format")
        .when(number.isNull(), "not_numeric")
        .when(~is_finite(number), "not_finite")
    )
