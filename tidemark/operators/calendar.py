"""Complete calendars per series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERIODS = {"month": "MM", "year": "YEAR"}
STEPS = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "year": "INTERVAL 1 YEAR"}


def calendar_slots(frame: DataFrame, keys: list[str], date: str, step: str) -> DataFrame:
    """One row per slot between the first and last date of every series.

    Slots without an observation carry NULLs. Each row fills the slots up to the next date of
    its series, so no join and no second pass over the data are needed. Rows off the calendar and rows
    that share a date stay as they are; the slots after them start at the next first day of a
    period. A row without a date stays too, and fills nothing.
    """
    following = F.lead(date).over(Window.partitionBy(*keys).orderBy(date))
    others = [c for c in frame.columns if c not in keys and c != date]
    period = F.col(date) if step == "day" else F.trunc(date, PERIODS[step])
    first, last = period + F.expr(STEPS[step]), F.date_sub("__next", 1)
    empty = F.when(first.cast("date") <= last, F.sequence(first.cast("date"), last, F.expr(STEPS[step])))
    own = F.array(F.struct(F.col(date).alias("at"), F.lit(True).alias("seen")))
    filled = F.transform(F.coalesce(empty, F.array().cast("array<date>")), lambda at: F.struct(at.alias("at"), F.lit(False).alias("seen")))
    slots = frame.withColumn("__next", following).withColumn("__slot", F.explode(F.concat(own, filled)))
    return slots.select(
        *keys, F.col("__slot.at").alias(date),
        *(F.when(F.col("__slot.seen"), F.col(c)).alias(c) for c in others),
    )


def missing_slots(frame: DataFrame, keys: list[str], date: str, step: str) -> DataFrame:
    """The slots of the complete calendar that no row covers."""
    marked = frame.select(*keys, date, F.lit(True).alias("__seen"))
    return calendar_slots(marked, keys, date, step).where(F.col("__seen").isNull()).select(*keys, date)


def off_calendar(date, step: str):
    """True for a date that is not the first day of its period."""
    return F.trunc(date, PERIODS[step]) != F.col(date)
