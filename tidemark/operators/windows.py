"""Per-series windows. A series holds one row per calendar slot, so its size is bounded by
the calendar, not by the volume of the raw data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.dates import whole_units
from tidemark.functions.numbers import dbl, growth_percent


def series_window(keys: list[str], date: str = "observation_date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date)


def neighbours(frame: DataFrame, keys: list[str], columns: dict[str, str], date: str = "observation_date",
               following: bool = True) -> DataFrame:
    """Add `previous_<name>` and, if asked for, `next_<name>` of the given columns."""
    spec = series_window(keys, date)
    added = {f"previous_{name}": F.lag(column).over(spec) for column, name in columns.items()}
    if following:
        added |= {f"next_{name}": F.lead(column).over(spec) for column, name in columns.items()}
    return frame.withColumns(added)


def rolling_mean(value: str, keys: list[str], rows: int = 3, date: str = "observation_date") -> Column:
    """Mean over the last rows (not calendar slots); the head of a series uses what it has."""
    spec = series_window(keys, date).rowsBetween(-(rows - 1), 0)
    return dbl(F.sum(value).over(spec)) / dbl(F.count(value).over(spec))


def consecutive(previous: str, current: str, unit: str = "YEAR") -> Column:
    return whole_units(unit, F.col(previous), F.col(current)) == 1


def gaps(frame: DataFrame, keys: list[str], unit: str, date: str = "observation_date") -> DataFrame:
    """Rows followed by a hole, with both ends and the number of missing periods."""
    following = F.lead(date).over(series_window(keys, date))
    distance = whole_units(unit, F.col(date), F.col("period_after_gap"))
    return (
        frame.withColumn("period_after_gap", following)
        .withColumn("period_gap", distance)
        .where(F.col("period_gap") > 1)
        .select(*keys, F.col(date).alias("period_before_gap"), "period_after_gap", "period_gap",
                (F.col("period_gap") - 1).alias("missing_period_count"))
    )


def latest_per_group(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the given ascending total order.

    One aggregate instead of a window: candidates are compared map-side, so a hot group
    sends one row per task into the shuffle. Use `newest` for descending moments.
    """
    rest = [c for c in frame.columns if c not in keys]
    best = frame.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__best"))
    return best.select(*keys, *(F.col(f"__best.{c}").alias(c) for c in rest))


def newest(column: str) -> Column:
    """Sort key that puts the latest moment first."""
    return -F.unix_micros(F.col(column).cast("timestamp"))


def checked_growth(frame: DataFrame, keys: Sequence[str], date: str, columns: Sequence[str]) -> DataFrame:
    """One row per series and date with the growth of every column in percent, `copies` and an `issue`.

    A date with several rows is `duplicate_date`, a row without a date `missing_date`; such a row and the one after
    it have no growth. Rows are counted by key and date first, so that the window holds one row per date at most.
    """
    alone = F.count(F.lit(1)) == 1
    dated = frame.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("copies"), *(F.when(alone, F.max(c)).alias(c) for c in columns))
    issue = F.when(F.col(date).isNull(), "missing_date").when(F.col("copies") > 1, "duplicate_date")
    spec = Window.partitionBy(*keys).orderBy(date)
    clean = F.col("issue").isNull() & F.lag("issue").over(spec).isNull()
    return dated.withColumn("issue", issue).select(
        *keys, date, "copies", "issue", *columns, *(F.when(clean, growth_percent(F.col(c), F.lag(c).over(spec))).alias(f"{c}_growth_percent") for c in columns)
    )
