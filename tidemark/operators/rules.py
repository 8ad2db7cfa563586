"""Predicates that turn into findings: blanks, ranges, formats, duplicates."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def missing_mandatory(frame: DataFrame, columns: list[str], expected: dict[str, str] | None = None,
                      extra: list[Column] | None = None) -> DataFrame:
    """Rows with a NULL or blank mandatory field, or a field that must hold a fixed value."""
    tests = [blank(c) for c in columns]
    tests += [F.coalesce(F.col(c) != v, F.lit(True)) for c, v in (expected or {}).items()]
    return frame.where(reduce(or_, tests + (extra or [])))


def out_of_range(frame: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows that break the rule of their indicator.

    Rules meet rows on source_code, an equality; the pattern is checked on the few rules of
    that source only.
    """
    value = F.col("value").cast("double")
    too_low = F.when(F.col("low_open"), value <= F.col("low")).otherwise(value < F.col("low"))
    broken = F.coalesce(too_low, F.lit(False)) | F.coalesce(value > F.col("high"), F.lit(False))
    return (
        frame.join(rules, "source_code")
        .where(F.rlike("indicator_code", F.col("pattern")) & broken)
    )


def bad_codes(frame: DataFrame, pattern: str, level: str, parent_known: Column) -> DataFrame:
    """Distinct regions whose code, level or parent is not as declared."""
    columns = ["region_code", "region_name", "region_level", "parent_region_code"]
    wrong = ~F.col("region_code").rlike(pattern) | (F.col("region_level") != level) | ~F.coalesce(parent_known, F.lit(False))
    return frame.where(wrong).select(*columns).distinct()


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with how many."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def uncovered(frame: DataFrame, periods: DataFrame, keys: list[str], date: str = "observation_date",
              start: str = "period_start", end: str = "period_end") -> DataFrame:
    """Distinct key and date pairs that no validity period covers."""
    dates = frame.select(*keys, date).distinct()
    spans = periods.select(*(F.col(k).alias(f"__{k}") for k in keys), start, end)
    match = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col(date).between(F.col(start), F.col(end))]
    return dates.join(spans, match, "left_anti")


def set_difference(expected: DataFrame, actual: DataFrame, column: str) -> DataFrame:
    """Codes on one side only, labelled `missing` or `unexpected`."""
    both = (
        expected.select(column, F.lit(1).alias("e"), F.lit(0).alias("a"))
        .unionByName(actual.select(column, F.lit(0).alias("e"), F.lit(1).alias("a")))
        .groupBy(column).agg(F.max("e").alias("e"), F.max("a").alias("a"))
    )
    return both.where("e <> a").select(column, F.when(F.col("e") == 1, "missing").otherwise("unexpected").alias("status"))
