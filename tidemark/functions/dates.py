"""Calendar expressions on date columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_start(column) -> Column:
    return F.trunc(column, "YEAR")


def month_start(column) -> Column:
    return F.trunc(column, "MM")


def whole_units(unit: str, start, end) -> Column:
    """Complete years, months or hours between two moments."""
    return F.timestamp_diff(unit, start, end)


def date_id(column: Column) -> Column:
    return (F.year(column) * 10000 + F.month(column) * 100 + F.day(column)).cast("int")


def local_date(utc: Column, zone: str) -> Column:
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def iso_local_date(text: Column) -> Column:
    """Date part of an ISO stamp as written; the offset is dropped, not applied. NULL for a text that is no stamp."""
    return F.try_to_date(F.substring(F.trim(text), 1, 10), "yyyy-MM-dd")


def last_complete_month_end(today: Column) -> Column:
    return F.date_sub(F.trunc(today, "MM"), 1)


def shift_seconds(stamp: Column, seconds: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds), stamp)
