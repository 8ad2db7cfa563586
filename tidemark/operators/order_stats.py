"""Ranks, medians and quantiles that never sort a whole group in one task.

Rows are first combined to one tally per distinct value, map-side. Tallies are then running-
summed in value order, slice by slice: approximate quantiles of all tallies cut every group at
the same values, each slice is summed by itself and offset by the slices below it, so the largest
unit of work is one slice of one group. Where the cuts fall does not change the results, which
are exact. One plan serves every size; `slices` is the only setting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settle

SLICES = 64


def running_tallies(frame: DataFrame, groups: Sequence[str], value: str, slices: int = SLICES, rows: str | None = None) -> DataFrame:
    """Distinct values per group with `ties`, `upto` (rows at or below) and `total`; `rows` names a column that counts rows already combined."""
    groups = list(groups)
    ties = F.sum(rows) if rows else F.count(F.lit(1))
    tallies = settle(frame.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(ties.alias("ties")))
    cuts = tallies.agg(F.percentile_approx(value, [i / slices for i in range(1, slices)])).first()[0] or []
    # The cuts are a short literal list, so a row's slice is an expression of its value.
    literal = F.array(*(F.lit(c) for c in sorted(set(cuts)))).cast(T.ArrayType(tallies.schema[value].dataType))
    sliced = tallies.withColumn("__slice", F.size(F.filter(literal, lambda cut: cut < F.col(value))))
    group = Window.partitionBy(*groups)
    below = group.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy(*groups, "__slice").agg(F.sum("ties").alias("__rows")).select(
        *groups, "__slice", F.coalesce(F.sum("__rows").over(below), F.lit(0)).alias("__below"),
        F.sum("__rows").over(group).alias("total"),
    )
    within = Window.partitionBy(*groups, "__slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    summed = sliced.withColumn("__upto", F.sum("ties").over(within))
    return _join_groups(summed, offsets, [*groups, "__slice"]).select(
        *groups, value, "ties", (F.col("__upto") + F.col("__below")).alias("upto"), "total"
    )


def _join_groups(rows: DataFrame, per_group: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join a table with one row per group, NULL keys included; Spark broadcasts it only when its size allows."""
    renamed = per_group.select(*(F.col(k).alias(f"__k_{k}") for k in keys), *(c for c in per_group.columns if c not in keys))
    condition = [rows[k].eqNullSafe(renamed[f"__k_{k}"]) for k in keys]
    return rows.join(renamed, condition, how).drop(*(f"__k_{k}" for k in keys))


def cross_section(
    frame: DataFrame, groups: Sequence[str], value: str, slices: int = SLICES
) -> DataFrame:
    """Add group mean, value count, descending rank and ascending percent rank to every row.

    `frame` should be settled: it is read twice. The join back is on (group, value), where the
    tally side has a single row, so a value shared by very many rows is left to the skew-join
    handling of adaptive execution. Rows without a value stay, unranked.
    """
    groups = list(groups)
    tallies = running_tallies(frame, groups, value, slices)
    sums = tallies.groupBy(*groups).agg(
        F.sum(F.col(value) * F.col("ties").cast("decimal(12,0)")).alias("__sum"),
        F.sum("ties").alias("group_count"),
    )
    mean = F.col("__sum").cast("double") / F.col("group_count").cast("double")
    first = F.col("upto") - F.col("ties") + 1
    ranked = tallies.select(
        *groups, value,
        (F.col("total") - F.col("upto") + 1).cast("int").alias("rank_desc"),
        F.when(F.col("total") > 1, (first - 1).cast("double") / (F.col("total") - 1).cast("double"))
        .otherwise(0.0).alias("percent_rank"),
    )
    with_rank = _join_groups(frame, ranked, [*groups, value], "left")
    return _join_groups(with_rank, sums.select(*groups, mean.alias("group_mean"), "group_count"), groups, "left")


def quantiles(
    frame: DataFrame, groups: Sequence[str], value: str, probabilities: dict[str, float],
    slices: int = SLICES,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per probability."""
    groups = list(groups)
    tallies = running_tallies(frame, groups, value, slices)
    number = F.col(value).cast("double")
    aggregates = []
    for name, p in probabilities.items():
        place = (F.col("total") - 1).cast("double") * p
        for side, index in (("low", F.floor(place)), ("high", F.ceil(place))):
            holds = (F.col("upto") > index) & (F.col("upto") - F.col("ties") <= index)
            aggregates.append(F.max(F.when(holds, number)).alias(f"__{name}_{side}"))
        aggregates.append(F.max(place - F.floor(place)).alias(f"__{name}_part"))
    summary = tallies.groupBy(*groups).agg(*aggregates, F.max("total").alias("non_null_count"))
    columns = [
        (F.col(f"__{n}_low") + (F.col(f"__{n}_high") - F.col(f"__{n}_low")) * F.col(f"__{n}_part")).alias(n)
        for n in probabilities
    ]
    return summary.select(*groups, "non_null_count", *columns)


def average_ranks(frame: DataFrame, groups: Sequence[str], value: str, name: str,
                  slices: int = SLICES) -> DataFrame:
    """Ascending rank per group with ties sharing their mean rank."""
    groups = list(groups)
    tallies = running_tallies(frame, groups, value, slices)
    middle = F.col("upto").cast("double") - (F.col("ties") - 1).cast("double") / 2
    return _join_groups(frame, tallies.select(*groups, value, middle.alias(name)), [*groups, value], "left")
