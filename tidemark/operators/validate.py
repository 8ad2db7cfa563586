"""Data contracts. Each returns findings; raising is the caller's choice."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import is_finite
from tidemark.operators.rules import blank
from tidemark.schema import FREQUENCIES, NATURAL_KEY, REGION_LEVELS, REQUIRED, TEXT_COLUMNS
from tidemark.session import settle


def missing_columns(frame: DataFrame, required: list[str] = REQUIRED) -> list[str]:
    return sorted(set(required) - set(frame.columns))


def _row_rules(frame: DataFrame) -> dict[str, Column]:
    date = F.col("observation_date")
    annual = F.col("frequency") == "annual"
    parent = blank("parent_region_code") if "parent_region_code" in frame.columns else F.lit(False)
    return {
        "null_field": reduce(or_, (F.col(c).isNull() for c in REQUIRED)),
        "blank_text": reduce(or_, (F.trim(c) == "" for c in TEXT_COLUMNS)),
        "unknown_frequency": ~F.col("frequency").isin(FREQUENCIES),
        "unknown_region_level": ~F.col("region_level").isin(REGION_LEVELS),
        "annual_not_january_first": annual & ((F.month(date) != 1) | (F.day(date) != 1)),
        "value_not_finite": ~is_finite(F.col("value")),
        "province_without_parent": (F.col("region_level") == "province") & parent,
    }


def with_issue(frame: DataFrame) -> DataFrame:
    """The rows with `issue`: the first row rule of the contract that each breaks, null for none."""
    lacking = missing_columns(frame)
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    named = (F.when(F.coalesce(test, F.lit(False)), name) for name, test in _row_rules(frame).items())
    return frame.withColumn("issue", F.coalesce(*named))


def _inconsistent(frame: DataFrame, code: str, attributes: list[str]) -> DataFrame:
    return (
        frame.select(code, *attributes).distinct().groupBy(code).count().where("count > 1")
        .agg(F.count(F.lit(1)).alias("violations"))
    )


def validate_observations(frame: DataFrame) -> DataFrame:
    """(rule, violations) for every rule of the observation contract, zero included.

    Row rules share one pass; the three group rules are one aggregate each, all over one derivation.
    """
    lacking = missing_columns(frame)
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    frame = settle(frame)
    rules = _row_rules(frame)
    counts = frame.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("empty_dataset"),
        *(F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in rules.items()),
    )
    names = ["empty_dataset", *rules]
    row_part = counts.select(F.inline(F.array(*(
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names
    ))))
    duplicates = frame.groupBy(*NATURAL_KEY).count().where("count > 1").agg(F.count(F.lit(1)).alias("violations"))
    region_attributes = ["region_name", "region_level"] + [c for c in ["parent_region_code"] if c in frame.columns]
    groups = {
        "duplicate_observation": duplicates,
        "inconsistent_indicator": _inconsistent(frame, "indicator_code", ["indicator_name", "unit", "frequency"]),
        "inconsistent_region": _inconsistent(frame, "region_code", region_attributes),
    }
    for name, part in groups.items():
        row_part = row_part.unionByName(part.select(F.lit(name).alias("rule"), "violations"))
    return row_part


def require_valid(frame: DataFrame) -> DataFrame:
    """The frame itself, or an error that names the broken rules."""
    broken = validate_observations(frame).where("violations > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{r.rule}: {r.violations}" for r in sorted(broken)))
    return frame


# The columns of the metadata contract.
METADATA_COLUMNS = [
    "indicator_code", "source_code", "indicator_name", "unit", "definition_text", "notes", "source_variable_id",
    "derived_variable_id", "derived_period_id", "metadata_hash", "period_start", "period_end", "observed_at",
]


def validate_metadata(metadata: DataFrame, frame: DataFrame) -> DataFrame:
    """(rule, violations) for a snapshot of series metadata against its observations."""
    columns = [c for c in METADATA_COLUMNS if c in metadata.columns]
    tests = {
        "null_field": reduce(or_, (F.col(c).isNull() for c in columns)),
        "bad_hash": ~F.col("metadata_hash").rlike("^[0-9a-f]{64}$"),
        "period_order": F.col("period_start") > F.col("period_end"),
    }
    counts = metadata.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("empty_dataset"),
        *(F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()),
    )
    part = counts.select(F.inline(F.array(*(
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in ["empty_dataset", *tests]
    ))))
    repeated = metadata.groupBy("indicator_code").count().where("count > 1").agg(F.count(F.lit(1)).alias("violations"))
    scope = (
        metadata.select("indicator_code", F.lit(1).alias("m"), F.lit(0).alias("d"))
        .unionByName(frame.select("indicator_code", F.lit(0).alias("m"), F.lit(1).alias("d")))
        .groupBy("indicator_code").agg(F.max("m").alias("m"), F.max("d").alias("d"))
        .where("m <> d").agg(F.count(F.lit(1)).alias("violations"))
    )
    for name, extra in {"repeated_series": repeated, "scope_differs": scope}.items():
        part = part.unionByName(extra.select(F.lit(name).alias("rule"), "violations"))
    return part
