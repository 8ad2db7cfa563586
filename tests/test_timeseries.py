"""Calendars, as-of joins, anomalies, backtests and forecasts."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import forecast as fc
from tidemark.operators.anomaly import checked_anomalies, input_issues, rolling_mad_anomalies
from tidemark.operators.asof import asof_join
from tidemark.operators.calendar import calendar_slots, missing_slots
from tidemark.operators.stats import error_metrics


def month(i, year=2020):
    return date(year + i // 12, i % 12 + 1, 1)


def series(spark, values, key="s"):
    rows = [(key, month(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, observation_date date, value double")


def test_missing_month_is_an_event(spark):
    frame = series(spark, [1, 2, 3]).where(F.month("observation_date") != 2)
    (row,) = rolling_mad_anomalies(frame, ["k"], "value", window=6, minimum_history=3).collect()
    assert (row.anomaly_type, row.observation_date, row.observed_value) == ("missing_value", date(2020, 2, 1), None)
    assert missing_slots(frame, ["k"], "observation_date", "month").count() == 1


def test_confirmed_revision_is_no_anomaly(spark):
    revisions = spark.createDataFrame([("s", month(7), "rebased")], "k string, observation_date date, reason string")
    values = [0, 1, 2, 3, 4, 5, 6, 70, 8, 9]
    events = rolling_mad_anomalies(series(spark, values), ["k"], "value", window=6, minimum_history=3, revisions=revisions).collect()
    assert events[0].anomaly_type == "source_revision" and "rebased" in events[0].reason
    assert all(e.observation_date >= month(7) for e in events)


def test_one_spike_is_the_one_anomaly(spark):
    changes = [100] + [1, -1, 2, -2, 1, -1, 2, -2, 1, -1, 2, -2, 1, -1] + [30]
    values, total = [], 0
    for change in changes:
        total += change
        values.append(total)
    (row,) = rolling_mad_anomalies(series(spark, values), ["k"], "value", window=12, minimum_history=8).collect()
    assert row.change == 30 and row.anomaly_type == "economic_anomaly" and row.score > 3.5


def test_flat_history_gives_anomaly_without_score(spark):
    (row,) = rolling_mad_anomalies(series(spark, [5] * 10 + [6]), ["k"], "value", window=6, minimum_history=3).collect()
    assert row.score is None and "undefined" in row.reason


def test_anomaly_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        rolling_mad_anomalies(series(spark, [1]), ["k"], "value", window=2, minimum_history=3)


def test_calendar_slots_fill_years(spark):
    frame = spark.createDataFrame([("a", date(2020, 1, 1), 1.0), ("a", date(2023, 1, 1), 4.0), ("b", date(2021, 1, 1), 2.0)], "k string, d date, v double")
    rows = calendar_slots(frame, ["k"], "d", "year").orderBy("k", "d").collect()
    assert [(r.k, r.d.year, r.v) for r in rows] == [("a", 2020, 1.0), ("a", 2021, None), ("a", 2022, None), ("a", 2023, 4.0), ("b", 2021, 2.0)]


@pytest.mark.parametrize("chunk", ["DAY", "YEAR"])
def test_asof_join_equals_brute_force_with_a_hot_key(spark, chunk):
    left = spark.range(900).select(
        F.when(F.col("id") < 600, "hot").otherwise("cold").alias("k"), "id", F.date_add(F.lit(date(2020, 1, 1)), ((F.col("id") * 53) % 700).cast("int")).alias("d")
    )
    right = spark.range(60).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"), F.date_add(F.lit(date(2020, 3, 1)), ((F.col("id") * 31) % 500).cast("int")).alias("e"), F.col("id").alias("v")
    )
    marks = [tuple(r) for r in right.collect()]
    for row in asof_join(left, right, ["k"], "d", "e", "v", chunk).collect():
        seen = [(e, v) for k, e, v in marks if k == row.k and e <= row.d]
        assert row.v == (max(v for e, v in seen if e == max(e for e, _ in seen)) if seen else None)


def test_naive_backtest(spark):
    rows = fc.naive_predictions(series(spark, [1, 3, 2, 5, 4, 7, 6, 9]), ["k"], "value", [1], 3).orderBy("observation_date").collect()
    assert [r.prediction for r in rows] == [4, 7, 6]
    metrics = error_metrics(fc.naive_predictions(series(spark, [1, 3, 2, 5, 4, 7, 6, 9]), ["k"], "value", [1], 3), ["k"]).first()
    assert metrics.mae == pytest.approx(7 / 3) and metrics.test_start == month(5)


def test_zero_actual_leaves_mape_to_the_others(spark):
    metrics = error_metrics(fc.naive_predictions(series(spark, [1, 2, 3, 0, 5]), ["k"], "value", [1], 2), ["k"]).first()
    assert metrics.mape_percent == pytest.approx(100)


def test_short_series_is_not_evaluated(spark):
    assert fc.naive_predictions(series(spark, [1, 2, 3]), ["k"], "value", [1], 2).count() == 0


def test_irregular_series_are_routed_out(spark):
    good, gap = series(spark, range(6), "good"), series(spark, range(6), "gap").where(F.month("observation_date") != 3)
    double, empty = series(spark, [1, 2], "double"), series(spark, [1, None, 3], "empty")
    frame = good.unionByName(gap).unionByName(double).unionByName(double).unionByName(empty)
    issues = {r.k: r.issues for r in fc.series_issues(frame, ["k"], "value").collect()}
    assert issues == {"good": "", "gap": "missing_periods", "double": "duplicate_dates", "empty": "null_values"}
    assert {r.k for r in fc.regular_series(frame, ["k"], "value").select("k").distinct().collect()} == {"good"}


def trend_and_season(n=72):
    return [14000 + 15 * i + 80 * math.sin(2 * math.pi * i / 12) for i in range(n)]


def ima_sum(values, theta, train):
    u = w = uu = uw = ww = 0.0
    for i in range(2, train + 1):
        u, w = values[i - 1] - values[i - 2] - theta * u, i - theta * w
        uu, uw, ww = uu + u * u, uw + u * w, ww + w * w
    return uu - uw * uw / ww


def seasonal_sum(values, theta, seasonal, train):
    e = [0.0] * 13
    total = 0.0
    for i in range(13, train):
        r = values[i] - values[i - 1] - values[i - 12] + values[i - 13] - theta * e[0] - seasonal * e[11] - theta * seasonal * e[12]
        e, total = [r, *e[:12]], total + r * r
    return total


def simulated(seed, theta, seasonal, n=96):
    """Series of known parameters: differences at lags 1 and 12 are a moving average of noise."""
    rng = random.Random(seed)
    noise = [rng.gauss(0, 10) for _ in range(n + 13)]
    values = [1000.0 + 5 * i for i in range(13)]
    for t in range(13, n):
        step = noise[t] + theta * noise[t - 1] + seasonal * noise[t - 12] + theta * seasonal * noise[t - 13]
        values.append(values[-1] + values[-12] - values[-13] + step)
    return values


@pytest.mark.parametrize("seed", range(4))
def test_ima_fit_is_the_least_sum(spark, seed):
    rng = random.Random(seed)
    theta = (-0.7, -0.2, 0.3, 0.6)[seed]
    noise = [rng.gauss(0, 10) for _ in range(60)]
    values = [100.0]
    for i in range(1, 60):
        values.append(values[-1] + 0.05 * i + noise[i] + theta * noise[i - 1])
    fitted = fc.ima_fit(fc.series_arrays(series(spark, values), ["k"], "value"), F.lit(50)).first()
    least = min(ima_sum(values, -0.99 + 0.001 * k, 50) for k in range(1981))
    assert fitted.converged and abs(fitted.theta - theta) < 0.3
    assert fitted.fit.sse == pytest.approx(ima_sum(values, fitted.theta, 50)) and fitted.fit.sse <= least * (1 + 1e-9)


@pytest.mark.parametrize(("seed", "theta", "seasonal"), [(1, -0.4, -0.5), (2, 0.5, -0.3), (3, -0.6, 0.4)])
def test_seasonal_fit_is_the_least_sum(spark, seed, theta, seasonal):
    values = simulated(seed, theta, seasonal)
    fitted = fc.seasonal_fit(fc.series_arrays(series(spark, values), ["k"], "value"), F.lit(90)).first()
    grid = [-0.98 + 0.07 * k for k in range(29)]
    least = min(seasonal_sum(values, a, b, 90) for a in grid for b in grid)
    around = [seasonal_sum(values, fitted.theta + x, fitted.seasonal + y, 90) for x, y in [(1e-3, 0), (-1e-3, 0), (0, 1e-3), (0, -1e-3)]]
    assert fitted.converged and fitted.fit.sse == pytest.approx(seasonal_sum(values, fitted.theta, fitted.seasonal, 90))
    assert fitted.fit.sse <= min(least, *around)


def test_fits_at_the_bound_have_not_converged(spark):
    """Noise about a level is over-differenced: the best theta lies at the bound or beyond."""
    frame = None
    for seed in range(6):
        rng = random.Random(seed)
        rows = series(spark, [500 + rng.gauss(0, 10) for _ in range(60)]).withColumn("k", F.lit(f"s{seed}"))
        frame = rows if frame is None else frame.unionByName(rows)
    arrays = fc.series_arrays(frame, ["k"], "value")
    fits = fc.ima_fit(arrays, F.lit(48), "c").collect()
    assert any(abs(r.theta) == fc.BOUND for r in fits) and all(not r.converged for r in fits if abs(r.theta) == fc.BOUND)
    held = {r.k: {r.converged} for r in fits}
    assert {r.k: {r.converged} for r in fc.ima_predictions(arrays, ["k"], 12, "c").collect()} == held


def test_a_constant_series_is_fitted(spark):
    fitted = fc.ima_fit(fc.series_arrays(series(spark, [7.0] * 40), ["k"], "value"), F.lit(30)).first()
    assert fitted.fit.sse == 0 and fitted.converged and fitted.slope == 0


def test_seasonal_model_covers_its_holdout(spark):
    arrays = fc.series_arrays(series(spark, trend_and_season()), ["k"], "value")
    rows = fc.seasonal_predictions(arrays, ["k"], 12).collect()
    assert len(rows) == 12 and all(abs(r.actual - r.prediction) < 5 for r in rows)
    assert all(r.lower_bound <= r.prediction <= r.upper_bound for r in rows)


@pytest.mark.parametrize("model", [fc.ima_forecast, fc.seasonal_forecast])
def test_forecasts_follow_the_series(spark, model):
    arrays = fc.series_arrays(series(spark, trend_and_season()), ["k"], "value")
    rows = model(arrays, ["k"], 6).orderBy("step").collect()
    assert [r.forecast_date for r in rows] == [month(72 + i) for i in range(6)]
    widths = [r.upper_bound - r.lower_bound for r in rows]
    assert all(r.lower_bound <= r.point_forecast <= r.upper_bound for r in rows) and widths == sorted(widths)
    if model is fc.seasonal_forecast:
        truth = trend_and_season(78)[72:]
        assert [r.point_forecast for r in rows] == pytest.approx(truth, abs=5)


def gate(spark, candidate):
    columns = "k string, model_name string, family string, mae double, rmse double, mape_percent double, interval_coverage_percent double, converged boolean"
    rows = [("s", "naive_lag_1", "baseline", 100.0, 120.0, 2.0, None, True), ("s", "naive_lag_12", "baseline", 120.0, 130.0, 3.0, None, True), candidate]
    return fc.quality_gate(spark.createDataFrame(rows, columns), ["k"]).first()


def test_gate_passes_a_better_model(spark):
    row = gate(spark, ("s", "m", "arima", 85.0, 90.0, 1.0, 95.0, True))
    assert (row.quality_status, row.baseline_model_name, row.mae_improvement_percent, row.reasons) == ("passed", "naive_lag_1", 15.0, [])


def test_gate_lists_all_reasons(spark):
    row = gate(spark, ("s", "m", "arima", 98.0, 99.0, 6.0, 60.0, False))
    assert row.quality_status == "failed"
    assert row.reasons == ["not_converged", "improvement_below_minimum", "mape_above_maximum", "coverage_below_minimum"]


def test_faulty_series_are_refused(spark):
    months = [date(2020 + i // 12, i % 12 + 1, 1) for i in range(24)]
    rows = [(k, at, 10.0 + i % 3 + (50 if i == 20 else 0)) for k in ("good", "nan", "twice", "late", "off", None) for i, at in enumerate(months)]
    rows += [("twice", months[3], 1.0), ("off", date(2020, 5, 9), None), (None, None, 2.0), ("nan", date(2022, 1, 1), float("nan")), ("nan", date(2022, 2, 1), float("-inf"))]
    frame = spark.createDataFrame(rows, "k string, observation_date date, v double")
    noted = spark.createDataFrame([("late", date(2023, 1, 1), " "), ("late", date(2023, 1, 1), "x"), ("good", months[4], "rebased"), ("unseen", months[4], "x")], "k string, observation_date date, reason string")
    found = {(r.k, r.observation_date, r.copies, r.issue) for r in input_issues(frame, ["k"], "v", revisions=noted).collect()}
    assert found == {
        ("twice", months[3], 2, "duplicate_date"), ("off", date(2020, 5, 9), 1, "off_calendar"), (None, None, 1, "missing_date"),
        ("nan", date(2022, 1, 1), 1, "not_finite"), ("nan", date(2022, 2, 1), 1, "not_finite"), ("unseen", months[4], 0, "revision_outside_series"),
        *(("late", date(2023, 1, 1), 0, issue) for issue in ("revision_without_reason", "repeated_revision", "revision_outside_series")),
    }
    events = checked_anomalies(frame, ["k"], "v", revisions=noted, minimum_history=6, window=12).collect()
    assert {(r.k, r.anomaly_type) for r in events if r.anomaly_type != "refused_input"} == {("good", "source_revision"), ("good", "economic_anomaly")}
    assert sum(r.anomaly_type == "refused_input" for r in events) == 9
    none = checked_anomalies(frame.limit(0), ["k"], "v", revisions=noted.limit(0))
    assert none.collect() == []
