"""Filters, paging and series summaries of the read interface."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl, safe_percent_change


def optional_filters(frame: DataFrame, **values) -> DataFrame:
    """Equality filters for the arguments that are given; absent ones leave no trace in the plan."""
    for column, value in values.items():
        if value is not None:
            frame = frame.where(F.col(column) == value)
    return frame


def year_range(frame: DataFrame, start_year: int | None = None, end_year: int | None = None,
               date: str = "observation_date") -> DataFrame:
    """Open-ended year bounds as plain date bounds, which reach the file scan."""
    if start_year is not None:
        frame = frame.where(F.col(date) >= F.lit(f"{start_year:04d}-01-01").cast("date"))
    if end_year is not None:
        frame = frame.where(F.col(date) <= F.lit(f"{end_year:04d}-12-31").cast("date"))
    return frame


def page(frame: DataFrame, order: list, number: int = 1, size: int = 20) -> DataFrame:
    """One page in a total order, with the item and page totals on every row.

    The order keeps only offset+limit rows per task; the totals are a second, counting pass.
    """
    if number < 1 or not 1 <= size <= 100:
        raise ValueError("pages start at 1 and hold 1 to 100 rows")
    total = frame.count()
    items = frame.orderBy(*order).offset((number - 1) * size).limit(size)
    return items.withColumns({
        "total_items": F.lit(total).cast("long"), "total_pages": F.lit(-(-total // size)).cast("long")
    })


def series_summary(frame: DataFrame, keys: list[str], value: str = "value", date: str = "observation_date") -> DataFrame:
    """Latest and previous value, change, percent change, minimum and maximum per series.

    One aggregate: the latest two points come from bounded top-two lists.
    """
    top = frame.groupBy(*keys).agg(
        F.max(F.struct(date, value)).alias("l"),
        F.min(value).alias("minimum"), F.max(value).alias("maximum"),
    )
    second = (
        frame.join(top.select(*keys, F.col(f"l.{date}").alias("__last")), keys)
        .where(F.col(date) < F.col("__last")).groupBy(*keys).agg(F.max(F.struct(date, value)).alias("p"))
    )
    latest, previous = F.col(f"l.{value}"), F.col(f"p.{value}")
    return top.join(second, keys, "left").select(
        *keys, F.col(f"l.{date}").alias("latest_date"), latest.alias("latest_value"), previous.alias("previous_value"),
        (latest - previous).alias("absolute_change"), safe_percent_change(latest, previous).alias("percent_change"),
        "minimum", "maximum",
    )


def kpi_change(unit: Column, absolute: Column, percent: Column) -> Column:
    """Percent units show the absolute change, all others the percent change."""
    return F.when(F.contains(F.lower(unit), F.lit("percent")), dbl(absolute)).otherwise(dbl(percent))
