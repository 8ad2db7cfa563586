"""Descriptive statistics, outliers and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl
from tidemark.operators.order_stats import average_ranks, quantiles, running_tallies
from tidemark.session import settle


def melt(frame: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form: one row per (ids, variable) with a double value."""
    pairs = F.array(*(F.struct(F.lit(c).alias("variable"), dbl(c).alias("value")) for c in columns))
    return frame.select(*ids, F.inline(pairs))


def describe_columns(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max and missing count; one row per column."""
    long = melt(settle(frame.select(*columns)), [], columns)  # the wide rows are kept, not one copy a column
    moments = long.groupBy("variable").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("missing_count"),
    )
    quarters = quantiles(long, ["variable"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quarters.drop("non_null_count"), "variable", "left")


def profile_columns(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column (all, if none are named): type, filled, missing, missing percent and distinct values.

    Values meet as (column, text) pairs, so distinct counting is one two-step aggregate for
    all columns together. An empty table gives a row per column without a percent.
    """
    types = dict(frame.dtypes)
    columns = frame.columns if columns is None else columns
    pairs = F.array(*(
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(f"`{c}`").cast("string").alias("text"))
        for c in columns
    ))
    tallies = frame.select(F.inline(pairs)).groupBy("column", "dtype", "text").agg(F.count(F.lit(1)).alias("n"))
    named = frame.sparkSession.createDataFrame([(c, types[c], None, 0) for c in columns], "column string, dtype string, text string, n long")
    filled = F.coalesce(F.sum(F.when(F.col("text").isNotNull(), F.col("n"))), F.lit(0))
    missing = F.coalesce(F.sum(F.when(F.col("text").isNull(), F.col("n"))), F.lit(0))
    return tallies.unionByName(named).groupBy("column", "dtype").agg(
        filled.alias("non_null_count"), missing.alias("missing_count"),
        (100 * dbl(missing) / F.nullif(dbl(F.sum("n")), F.lit(0.0))).alias("missing_percent"), F.count("text").alias("unique_count"),
    )


def dataset_inventory(datasets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dataset: rows, columns, first and last date, missing cells."""
    parts = []
    for name, (frame, date) in datasets.items():
        missing = sum((F.count_if(F.col(c).isNull()) for c in frame.columns), F.lit(0))
        parts.append(frame.agg(
            F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"),
            F.lit(len(frame.columns)).alias("column_count"), F.min(date).alias("period_start"),
            F.max(date).alias("period_end"), missing.cast("long").alias("missing_cells"),
        ))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def iqr_outliers(frame: DataFrame, ids: Sequence[str], columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Values outside the quartiles by more than `reach` spreads, per variable."""
    long = melt(settle(frame.select(*dict.fromkeys([*ids, *columns]))), ids, columns).where(F.col("value").isNotNull())
    bounds = quantiles(long, ["variable"], "value", {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * reach
    bounds = bounds.select("variable", (F.col("q1") - spread).alias("lower_bound"), (F.col("q3") + spread).alias("upper_bound"))
    low, high = F.col("value") < F.col("lower_bound"), F.col("value") > F.col("upper_bound")
    return long.join(bounds, "variable").where(low | high).withColumn("direction", F.when(low, "low").otherwise("high"))


def pearson(left: Column, right: Column, minimum: int = 2) -> Column:
    """Aggregate: correlation over rows where both are present; NULL if too few or constant."""
    both = left.isNotNull() & right.isNotNull()
    a, b = F.when(both, dbl(left)), F.when(both, dbl(right))
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(F.count_if(both) >= minimum, r)


def correlation_pairs(frame: DataFrame, columns: Sequence[str], minimum: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Upper triangle with diagonal: (left_variable, right_variable, correlation, overlap).

    A row becomes one entry per column pair and is combined map-side at once, so the shuffle
    carries one partial result per pair and task.
    """
    pairs = F.array(*(
        F.struct(F.lit(a).alias("left_variable"), F.lit(b).alias("right_variable"), dbl(a).alias("x"), dbl(b).alias("y"))
        for a, b in combinations_with_replacement(columns, 2)
    ))
    x, y = F.col("x"), F.col("y")
    return frame.select(*by, F.inline(pairs)).groupBy(*by, "left_variable", "right_variable").agg(
        pearson(x, y, minimum).alias("correlation"), F.count_if(x.isNotNull() & y.isNotNull()).alias("overlap")
    )


def correlation_matrix(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Both triangles of a pair table; each pair is mirrored in its row, so the table is derived once."""
    def entry(left, right):
        return F.struct(F.col(left).alias("left_variable"), F.col(right).alias("right_variable"), "correlation", "overlap")

    same = F.col("left_variable") == F.col("right_variable")
    both = F.when(same, F.array(entry("left_variable", "right_variable"))).otherwise(
        F.array(entry("left_variable", "right_variable"), entry("right_variable", "left_variable"))
    )
    return pairs.select(*by, F.inline(both))


def spearman(frame: DataFrame, row_key: Sequence[str], left: str, right: str, minimum: int = 3) -> DataFrame:
    """Rank correlation of two columns on the rows where both are present."""
    both = settle(
        frame.where(F.col(left).isNotNull() & F.col(right).isNotNull())
        .select(*row_key, F.lit("all").alias("__all"), dbl(left).alias("__a"), dbl(right).alias("__b"))
    )
    ranked = average_ranks(average_ranks(both, ["__all"], "__a", "__ra"), ["__all"], "__b", "__rb")
    return ranked.agg(
        F.lit(left).alias("left_variable"), F.lit(right).alias("right_variable"),
        pearson(F.col("__ra"), F.col("__rb"), minimum).alias("correlation"), F.count(F.lit(1)).alias("overlap"),
    )


def spearman_pairs(frame: DataFrame, columns: Sequence[str], minimum: int = 3) -> DataFrame:
    """Upper triangle with diagonal of rank correlations, each on the pair's complete rows: (left_variable, right_variable, correlation, overlap).

    NaN counts as missing. Rows are combined to one cell per pair and two values, map-side; the ranks of all
    pairs come from one table of tallies keyed by (pair, side), in the slices of `running_tallies`, and go back
    to the cells by (pair, value). Ranks are taken from their known mean, so the sums hold no large terms.
    Every pair is in the result, also one without a complete row.
    """
    pair = ["left_variable", "right_variable"]
    number = {c: F.nanvl(dbl(F.col(c)), F.lit(None).cast("double")) for c in columns}
    entries = F.array(*(
        F.struct(F.lit(a).alias(pair[0]), F.lit(b).alias(pair[1]), number[a].alias("x"), number[b].alias("y"))
        for a, b in combinations_with_replacement(columns, 2)
    ))
    cells = settle(frame.select(F.inline(entries)).groupBy(*pair, "x", "y").agg(F.count(F.lit(1)).alias("rows")).where("x IS NOT NULL AND y IS NOT NULL"))
    sides = F.array(F.struct(F.lit("x").alias("side"), F.col("x").alias("value")), F.struct(F.lit("y").alias("side"), F.col("y").alias("value")))
    tallies = running_tallies(cells.select(*pair, "rows", F.inline(sides)), [*pair, "side"], "value", rows="rows")
    middle = F.col("upto").cast("double") - (F.col("ties") - 1).cast("double") / 2 - (F.col("total") + 1).cast("double") / 2
    ranks = settle(tallies.select(*pair, "side", "value", middle.alias("rank")))

    def ranks_of(side: str) -> DataFrame:
        return ranks.where(F.col("side") == side).select(*pair, F.col("value").alias(side), F.col("rank").alias(f"rank_{side}"))

    a, b, n = F.col("rank_x"), F.col("rank_y"), F.col("rows").cast("double")
    sums = cells.join(ranks_of("x"), [*pair, "x"]).join(ranks_of("y"), [*pair, "y"]).groupBy(*pair).agg(
        F.sum(n * a * b).alias("both"), F.sum(n * a * a).alias("left"), F.sum(n * b * b).alias("right"), F.sum("rows").alias("overlap")
    )
    listed = frame.sparkSession.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(x).alias(pair[0]), F.lit(y).alias(pair[1])) for x, y in combinations_with_replacement(columns, 2)
    ))))
    r = F.try_divide(F.col("both"), F.sqrt("left") * F.sqrt("right"))
    return listed.join(sums, pair, "left").select(
        *pair, F.when(F.col("overlap") >= minimum, r).alias("correlation"), F.coalesce("overlap", F.lit(0)).alias("overlap")
    )


def lagged_correlation(frame: DataFrame, by: Sequence[str], time: str, target: str, feature: str,
                       lags: Sequence[int], minimum: int = 6) -> DataFrame:
    """Correlation of the target with the feature `lag` rows earlier (negative: later)."""
    spec = Window.partitionBy(*by).orderBy(time)
    shifted = frame.select(*by, F.col(target).alias("__y"), *(
        F.lag(feature, lag).over(spec).alias(f"__x{i}") for i, lag in enumerate(lags)
    ))
    aggregates = []
    for i in range(len(lags)):
        present = F.col("__y").isNotNull() & F.col(f"__x{i}").isNotNull()
        aggregates += [pearson(F.col("__y"), F.col(f"__x{i}"), minimum).alias(f"r{i}"), F.count_if(present).alias(f"n{i}")]
    rows = F.array(*(
        F.struct(F.lit(lag).alias("lag"), F.col(f"r{i}").alias("correlation"), F.col(f"n{i}").alias("observation_count"))
        for i, lag in enumerate(lags)
    ))
    return shifted.groupBy(*by).agg(*aggregates).select(*by, F.inline(rows))


def aligned(long: DataFrame, by: Sequence[str], date: str, series: str, value: str, names: dict[str, str]) -> DataFrame:
    """Wide rows for the dates on which every one of the listed series (code → column) has a value."""
    cells = [F.max(F.when(F.col(series) == code, F.col(value))).alias(name) for code, name in names.items()]
    wide = long.where(F.col(series).isin(list(names))).groupBy(*by, date).agg(*cells)
    return wide.dropna(how="any", subset=list(names.values()))


def error_metrics(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """MAE, RMSE, MAPE and interval coverage of (actual, prediction, lower_bound, upper_bound)."""
    miss = F.col("actual") - F.col("prediction")
    relative = F.when(F.col("actual") != 0, F.abs(miss) / F.abs("actual"))
    inside = F.when(
        F.col("lower_bound").isNotNull(),
        F.when(F.col("actual").between(F.col("lower_bound"), F.col("upper_bound")), 1.0).otherwise(0.0),
    )
    return frame.groupBy(*by).agg(
        F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"),
        (F.avg(relative) * 100).alias("mape_percent"), (F.avg(inside) * 100).alias("interval_coverage_percent"),
        F.count(F.lit(1)).alias("test_observations"), F.min("observation_date").alias("test_start"),
        F.max("observation_date").alias("test_end"),
    )
