"""Rolling-median anomaly candidates on calendar-complete series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl
from tidemark.operators.calendar import calendar_slots, off_calendar
from tidemark.operators.windows import series_window
from tidemark.session import settle

# Fixed value: turns a median absolute deviation into a robust z-score.
ROBUST_SCALE = 0.67448975


def bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body uses it.

    The optimizer copies column definitions into pushed-down filters; a bound lambda variable
    keeps such copies cheap.
    """
    return F.get(F.transform(F.array(value), body), 0)


def array_median(values: Column) -> Column:
    def middle(ordered):
        n = F.size(ordered)
        low, high = F.floor((n + 1) / 2).cast("int"), (F.floor(n / 2) + 1).cast("int")
        return F.when(n > 0, (F.get(ordered, low - 1) + F.get(ordered, high - 1)) / 2)

    return bound(F.array_sort(values), middle)


def median_and_mad(values: Column) -> Column:
    return bound(array_median(values), lambda m: F.struct(
        m.alias("median"), array_median(F.transform(values, lambda x: F.abs(x - m))).alias("mad")
    ))


def scored_changes(
    frame: DataFrame, keys: Sequence[str], value: str, *, step: str = "month", window: int = 24,
    date: str = "observation_date", revisions: DataFrame | None = None,
) -> DataFrame:
    """Every calendar slot with its change, the history behind it, median, MAD and score.

    The history is at most `window` numbers per row, taken by a frame of the ordered window.
    """
    keys = list(keys)
    series = calendar_slots(frame.select(*keys, date, dbl(value).alias("observed_value")), keys, date, step)
    if revisions is None:
        series = series.withColumn("revision", F.lit(None).cast("string"))
    else:
        series = series.join(revisions.select(*keys, date, F.col("reason").alias("revision")), [*keys, date], "left")
    order = series_window(keys, date)
    usable = F.when(F.col("revision").isNull(), F.col("change"))
    series = series.withColumn("change", F.col("observed_value") - F.lag("observed_value").over(order))
    series = series.withColumn("history", F.collect_list(usable).over(order.rowsBetween(-window, -1)))
    series = series.withColumn("__m", median_and_mad(F.col("history")))
    series = series.withColumns({"median": F.col("__m.median"), "mad": F.col("__m.mad")}).drop("__m")
    deviation = F.col("change") - F.col("median")
    return series.withColumn("score", ROBUST_SCALE * deviation / F.nullif(F.col("mad"), F.lit(0.0)))


def rolling_mad_anomalies(
    frame: DataFrame, keys: Sequence[str], value: str, *, step: str = "month", window: int = 24,
    minimum_history: int = 12, threshold: float = 3.5, date: str = "observation_date",
    revisions: DataFrame | None = None,
) -> DataFrame:
    """Events: `missing_value`, `source_revision` or `economic_anomaly`, each with a reason."""
    if not 1 <= minimum_history <= window or threshold <= 0:
        raise ValueError("need 1 <= minimum_history <= window and a positive threshold")
    scored = scored_changes(frame, keys, value, step=step, window=window, date=date, revisions=revisions)
    judged = F.col("change").isNotNull() & (F.size("history") >= minimum_history)
    flat = (F.col("mad") == 0) & (F.col("change") != F.col("median"))
    far = F.abs("score") >= threshold
    kind = (
        F.when(F.col("observed_value").isNull(), "missing_value")
        .when(F.col("revision").isNotNull(), "source_revision")
        .when(judged & (flat | F.coalesce(far, F.lit(False))), "economic_anomaly")
    )
    is_anomaly = F.col("anomaly_type") == "economic_anomaly"
    method = (
        F.when(is_anomaly, "rolling_mad_first_difference")
        .when(F.col("anomaly_type") == "source_revision", "source_revision_metadata")
        .otherwise("calendar_continuity")
    )
    score_text = F.when(F.col("mad") == 0, F.lit("undefined")).otherwise(F.format_string("%.3f", "score"))
    reason = (
        F.when(is_anomaly, F.concat(
            F.format_string("change %.6f against median %.6f; mad %.6f; score ", "change", "median", "mad"),
            score_text, F.lit(f"; threshold {threshold:.3f}"),
        ))
        .when(F.col("anomaly_type") == "source_revision", F.concat(F.lit("confirmed revision: "), F.col("revision")))
        .otherwise(F.concat(F.lit("no value for "), F.col(date).cast("string")))
    )
    return scored.withColumn("anomaly_type", kind).where(F.col("anomaly_type").isNotNull()).select(
        *keys, date, "observed_value", "change",
        F.when(is_anomaly, F.col("score")).alias("score"), F.lit(threshold).alias("threshold"),
        "anomaly_type", method.alias("method"), reason.alias("reason"),
    )


def input_issues(
    frame: DataFrame, keys: Sequence[str], value: str, *, step: str = "month", date: str = "observation_date", revisions: DataFrame | None = None,
) -> DataFrame:
    """Why a series cannot be scored: keys, date, `copies` (its observations on that date) and one `issue` a row.

    `missing_date`, `duplicate_date`, `off_calendar` (not the first day of its period), `not_finite` (NaN or infinite), and for
    revisions `revision_without_reason`, `repeated_revision` and `revision_outside_series` (before its first or after its last
    observation). Observations and revisions become one row per key and date first, so the window holds a calendar at most.
    """
    keys = list(keys)
    number = dbl(value)
    odd = F.isnan(number) | (F.abs(number) == float("inf"))
    told = frame.select(*keys, date, F.lit(False).alias("__revised"), F.coalesce(odd, F.lit(False)).alias("__odd"))
    if revisions is not None:
        blank = F.coalesce(F.trim("reason") == "", F.lit(True))
        told = told.unionByName(revisions.select(*keys, date, F.lit(True).alias("__revised"), blank.alias("__odd")))
    slots = told.groupBy(*keys, date).agg(
        F.count_if(~F.col("__revised")).alias("copies"), F.count_if("__revised").alias("__revisions"),
        F.count_if(F.col("__odd") & ~F.col("__revised")).alias("__odd"), F.count_if(F.col("__odd") & F.col("__revised")).alias("__blank"),
    )
    series = Window.partitionBy(*keys)
    observed = F.when(F.col("copies") > 0, F.col(date))
    outside = F.coalesce(~F.col(date).between(F.min(observed).over(series), F.max(observed).over(series)), F.lit(True))
    found = {
        "missing_date": F.col(date).isNull(),
        "duplicate_date": F.col(date).isNotNull() & (F.col("copies") > 1),
        "off_calendar": off_calendar(date, step) if step != "day" else F.lit(False),
        "not_finite": F.col("__odd") > 0,
        "revision_without_reason": F.col("__blank") > 0,
        "repeated_revision": F.col("__revisions") > 1,
        "revision_outside_series": F.col(date).isNotNull() & (F.col("__revisions") > 0) & outside,
    }
    issues = F.array_compact(F.array(*(F.when(held, name) for name, held in found.items())))
    return slots.select(*keys, date, "copies", issues.alias("issues")).select(*keys, date, "copies", F.explode("issues").alias("issue"))


def checked_anomalies(
    frame: DataFrame, keys: Sequence[str], value: str, *, step: str = "month", date: str = "observation_date", revisions: DataFrame | None = None, **limits,
) -> DataFrame:
    """The events of `rolling_mad_anomalies` for series without an input issue; of the others a `refused_input` row per issue.

    No event of a series with an issue is given, since one repeated or misplaced date makes false changes after it.
    """
    keys = list(keys)
    frame = settle(frame)
    issues = settle(input_issues(frame, keys, value, step=step, date=date, revisions=revisions))
    bad = issues.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    good = frame.join(bad, same, "left_anti")
    noted = revisions if revisions is None else revisions.join(bad, same, "left_anti")
    events = rolling_mad_anomalies(good, keys, value, step=step, date=date, revisions=noted, **limits)
    refused = issues.select(*keys, date, F.lit("refused_input").alias("anomaly_type"), F.lit("input_check").alias("method"), F.col("issue").alias("reason"))
    return events.unionByName(refused, allowMissingColumns=True)
