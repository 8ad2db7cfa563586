"""Backtests and forecasts for many series at once.

A series is one row with an array of values: at most one value per calendar slot, which
`regular_series` enforces before anything is collected. Models are fitted with `aggregate()` folds
inside that row, so there is one shuffle by series and no Python.

Moving-average models are fitted by conditional sum of squares on the training part: from the best of a few
starts, Gauss-Newton steps follow the residuals' derivatives, which one fold carries along with the residuals. A step that
makes the sum larger is cut to a quarter. Parameters stay within `BOUND`; a fit has converged
where the next step is below `TOLERANCE` and no parameter lies on the bound. The holdout is
then predicted one step ahead without refitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl, is_finite
from tidemark.functions.dates import whole_units
from tidemark.operators.windows import series_window

# Fixed value: two-sided 95 percent point of the normal distribution.
Z95 = 1.959963984540054
BOUND, TOLERANCE, ROUNDS = 0.99, 1e-5, 50
# A step this small is not taken, and ends a fit.
STILL = 1e-7
STARTS, SEASONAL_STARTS = [-0.8, -0.4, 0.0, 0.4, 0.8], [-0.7, -0.2, 0.4]
# A sum this little larger is rounding, not a worse fit.
SLACK = 1.0000000001
SEASON = 12


def series_issues(frame: DataFrame, keys: Sequence[str], value: str, step: str = "month",
                  date: str = "observation_date") -> DataFrame:
    """One row per series with its counts and the reasons it is not a regular series."""
    unit = {"month": "MONTH", "year": "YEAR", "day": "DAY"}[step]
    start = {"month": "MM", "year": "YEAR", "day": "DAY"}[step]
    off = F.to_date(F.date_trunc(start, F.col(date))) != F.col(date)
    per_date = frame.groupBy(*keys, date).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(value).isNull()).alias("nulls"),
        F.count_if(F.col(value).isNotNull() & ~is_finite(F.col(value))).alias("non_finite"),
    )
    counts = per_date.groupBy(*keys).agg(
        F.sum("rows").alias("observation_count"), F.min(date).alias("period_start"), F.max(date).alias("period_end"),
        F.count_if(F.col("rows") > 1).alias("duplicate_dates"), F.sum("nulls").alias("null_values"),
        F.sum("non_finite").alias("non_finite_values"), F.count_if(off).alias("unexpected_dates"),
        F.count_if(~off).alias("__slots"),
    )
    expected = whole_units(unit, F.col("period_start"), F.col("period_end")) + 1
    counts = counts.withColumn("missing_periods", F.greatest(expected - F.col("__slots"), F.lit(0))).drop("__slots")
    reasons = F.array_compact(F.array(*(
        F.when(F.col(c) > 0, c)
        for c in ("duplicate_dates", "null_values", "non_finite_values", "unexpected_dates", "missing_periods")
    )))
    return counts.withColumn("issues", F.array_join(reasons, ","))


def regular_series(frame: DataFrame, keys: Sequence[str], value: str, step: str = "month") -> DataFrame:
    """Rows of the regular series only; the others are reported by `series_issues`."""
    good = series_issues(frame, keys, value, step).where("issues = ''").select(*keys)
    return frame.join(good, list(keys), "left_semi")


def naive_predictions(frame: DataFrame, keys: Sequence[str], value: str, lags: Sequence[int], test_periods: int,
                      date: str = "observation_date") -> DataFrame:
    """Last-value and seasonal-naive one-step predictions over the last `test_periods` rows."""
    order = series_window(list(keys), date)
    back = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    rows = frame.where(F.col(value).isNotNull()).select(*keys, date, dbl(value).alias("actual"))
    numbered = rows.select(
        "*", F.row_number().over(back).alias("from_end"), F.row_number().over(order).alias("from_start"),
        *(F.lag("actual", k).over(order).alias(f"__p{k}") for k in lags),
    )
    pairs = F.array(*(
        F.struct(F.lit(f"naive_lag_{k}").alias("model_name"), F.lit(k).alias("prediction_lag"), F.col(f"__p{k}").alias("prediction"))
        for k in lags
    ))
    long = numbered.where(F.col("from_end") <= test_periods).select(
        *keys, date, "actual", "from_end", "from_start", F.inline(pairs)
    )
    # A series must be longer than holdout plus lag, else it is not evaluated.
    enough = F.col("from_start") + F.col("from_end") - 1 > test_periods + F.col("prediction_lag")
    return long.where(enough & F.col("prediction").isNotNull()).select(
        *keys, "model_name", F.lit("baseline").alias("family"), date, "actual", "prediction",
        F.lit(None).cast("double").alias("lower_bound"), F.lit(None).cast("double").alias("upper_bound"),
    )


def series_arrays(frame: DataFrame, keys: Sequence[str], value: str, date: str = "observation_date") -> DataFrame:
    """One row per series: `dates` and `values` in date order, and their number `n`."""
    pair = F.struct(F.col(date).alias("d"), dbl(value).alias("v"))
    rows = frame.groupBy(*keys).agg(F.array_sort(F.collect_list(pair)).alias("__p"))
    return rows.select(
        *keys, F.transform("__p", lambda p: p["d"]).alias("dates"), F.transform("__p", lambda p: p["v"]).alias("values"),
        F.size("__p").alias("n"),
    )


def _zero() -> Column:
    return F.lit(0.0)


def _difference_steps(trend: str) -> Column:
    """Array of (d, x): first differences and the trend regressor at the same position."""
    position = F.sequence(F.lit(2), F.col("n"))
    regressor = {"t": lambda i: i.cast("double"), "c": lambda i: F.lit(1.0), "n": lambda i: F.lit(0.0)}[trend]
    return F.transform(position, lambda i: F.struct(
        (F.get("values", i - 1) - F.get("values", i - 2)).alias("d"), regressor(i).alias("x")
    ))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ratio(above: Column, below: Column) -> Column:
    return F.coalesce(above / F.nullif(below, _zero()), _zero())


def _outward(parameter: Column, step: Column) -> Column:
    return ((parameter >= BOUND) & (step > 0)) | ((parameter <= -BOUND) & (step < 0))


def _descend(starts: Column, trial, steps: tuple[str, ...], rounds: int = ROUNDS) -> Column:
    """The best point from the best of `starts`; `trial(point, scale)` is the point a scaled step away, in the fields `steps`.

    Points are structs whose first field is their sum of squares, `sse`.
    """

    def step(acc, _):
        def judged(new):
            kept = F.struct(new.alias("point"), F.least(F.lit(1.0), 2 * acc["scale"]).alias("scale"))
            cut = F.struct(acc["point"].alias("point"), (acc["scale"] * 0.25).alias("scale"))
            return F.when(new["sse"] <= acc["point"]["sse"] * SLACK, kept).otherwise(cut)

        ended = F.greatest(*(F.abs(acc["point"][name]) for name in steps), _zero()) < STILL
        return F.when(ended, acc).otherwise(_let(trial(acc["point"], acc["scale"]), judged))

    first = F.struct(F.array_min(starts).alias("point"), F.lit(1.0).alias("scale"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, step, lambda acc: acc["point"])


def _moved(parameter: Column, step: Column, scale: Column) -> Column:
    return F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), parameter + scale * step))


def _ima_point(steps: Column, theta: Column) -> Column:
    """Sum of squares, best slope and Gauss-Newton step at theta. u and w are the filtered differences and trend, p and q their derivatives."""
    sums = ("uu", "uw", "ww", "up", "uq", "wp", "wq", "pp", "pq", "qq")

    def push(acc, s):
        def added(x):
            return F.struct(*(x[k].alias(k) for k in "uwpq"), *((acc[ab] + x[ab[0]] * x[ab[1]]).alias(ab) for ab in sums))

        return _let(F.struct(
            (s["d"] - theta * acc["u"]).alias("u"), (s["x"] - theta * acc["w"]).alias("w"),
            (_zero() - acc["u"] - theta * acc["p"]).alias("p"), (_zero() - acc["w"] - theta * acc["q"]).alias("q"),
        ), added)

    def solved(f):
        def point(line):
            s = line["s"]
            cross = f["wp"] - s * f["wq"]
            gradient = f["up"] - s * f["uq"] - s * f["wp"] + s * s * f["wq"]
            curve = f["pp"] - 2 * s * f["pq"] + s * s * f["qq"] - _ratio(cross, f["ww"]) * cross
            step = _zero() - _ratio(gradient, curve)
            return F.struct(
                (f["uu"] - s * f["uw"]).alias("sse"), theta.alias("theta"), s.alias("slope"), f["u"].alias("u"), f["w"].alias("w"),
                F.when(_outward(theta, step), _zero()).otherwise(step).alias("step"),
            )

        return _let(F.struct(_ratio(f["uw"], f["ww"]).alias("s")), point)

    start = F.struct(*(_zero().alias(n) for n in ("u", "w", "p", "q", *sums)))
    return _let(F.aggregate(steps, start, push), solved)


def ima_fit(arrays: DataFrame, train: Column, trend: str = "t") -> DataFrame:
    """Fit y' = slope·trend + e + theta·e(-1) on the first `train` values of every series: theta, slope, sigma, last_residual, converged."""
    part = F.slice(F.col("steps"), F.lit(1), F.col("train") - 1)
    starts = F.transform(F.lit(STARTS), lambda theta: _ima_point(part, theta))
    best = _descend(starts, lambda p, scale: _let(_moved(p["theta"], p["step"], scale), lambda theta: _ima_point(part, theta)), ("step",))
    fitted = arrays.withColumn("train", train).withColumn("steps", _difference_steps(trend)).withColumn("fit", best)
    return fitted.withColumns({
        "theta": F.col("fit.theta"), "slope": F.col("fit.slope"),
        "sigma": F.sqrt(F.greatest(F.col("fit.sse"), _zero()) / (F.col("train") - 1)),
        "last_residual": F.col("fit.u") - F.col("fit.slope") * F.col("fit.w"),
        "converged": (F.abs("fit.step") < TOLERANCE) & (F.abs("fit.theta") < BOUND),
    })


def ima_predictions(arrays: DataFrame, keys: Sequence[str], test_periods: int, trend: str = "t",
                    name: str = "ima_011_drift") -> DataFrame:
    """One-step predictions over the holdout: the filter runs on, the parameters stay."""
    fitted = ima_fit(arrays.where(F.col("n") > test_periods + 3), F.col("n") - test_periods, trend)
    start = F.struct(F.col("fit.u").alias("u"), F.col("fit.w").alias("w"), F.array().cast("array<double>").alias("e"))

    def push(acc, s):
        u, w = s["d"] - F.col("theta") * acc["u"], s["x"] - F.col("theta") * acc["w"]
        return F.struct(u.alias("u"), w.alias("w"), F.array_append(acc["e"], u - F.col("slope") * w).alias("e"))

    errors = F.aggregate(F.slice("steps", F.col("train"), F.lit(test_periods)), start, push, lambda a: a["e"])
    return _holdout_rows(fitted.withColumn("errors", errors), keys, test_periods, name, "arima")


def _holdout_rows(fitted: DataFrame, keys: Sequence[str], test_periods: int, name: str, family: str) -> DataFrame:
    first = F.col("n") - test_periods
    rows = F.transform(F.col("errors"), lambda e, i: F.struct(
        F.get("dates", first + i).alias("observation_date"), F.get("values", first + i).alias("actual"),
        (F.get("values", first + i) - e).alias("prediction"),
    ))
    margin = Z95 * F.col("sigma")
    # The outer form keeps the optimizer from testing the array, which would fit the model twice.
    return fitted.select(*keys, "sigma", "converged", F.inline_outer(rows)).select(
        *keys, F.lit(name).alias("model_name"), F.lit(family).alias("family"), "observation_date", "actual", "prediction",
        (F.col("prediction") - margin).alias("lower_bound"), (F.col("prediction") + margin).alias("upper_bound"), "converged",
    )


def _seasonal_steps() -> Column:
    """Differences at lag 1 and lag 12 of the values."""
    at = lambda i: F.get("values", i)
    return F.transform(
        F.sequence(F.lit(SEASON + 1), F.col("n") - 1),
        lambda i: at(i) - at(i - 1) - at(i - SEASON) + at(i - SEASON - 1),
    )


def _seasonal_residual(w: Column, e: Column, theta: Column, seasonal: Column) -> Column:
    """Next residual from the last 13, newest first."""
    return w - theta * F.get(e, 0) - seasonal * F.get(e, SEASON - 1) - theta * seasonal * F.get(e, SEASON)


def _seasonal_point(steps: Column, theta: Column, seasonal: Column) -> Column:
    """Sum of squares, the last residuals and the Gauss-Newton step; f and g are the residuals' derivatives by theta and seasonal."""
    sums = ("ee", "ff", "fg", "gg", "ef", "eg")

    def push(acc, w):
        at = lambda k: F.get(acc["last"], k)
        one, twelve, thirteen = at(0), at(SEASON - 1), at(SEASON)
        new = F.struct(
            (w - theta * one["e"] - seasonal * twelve["e"] - theta * seasonal * thirteen["e"]).alias("e"),
            (_zero() - one["e"] - seasonal * thirteen["e"] - theta * one["f"] - seasonal * twelve["f"] - theta * seasonal * thirteen["f"]).alias("f"),
            (_zero() - twelve["e"] - theta * thirteen["e"] - theta * one["g"] - seasonal * twelve["g"] - theta * seasonal * thirteen["g"]).alias("g"),
        )
        return _let(new, lambda x: F.struct(
            F.slice(F.array_prepend(acc["last"], x), 1, SEASON + 1).alias("last"),
            *((acc[ab] + x[ab[0]] * x[ab[1]]).alias(ab) for ab in sums),
        ))

    def solved(f):
        det = f["ff"] * f["gg"] - f["fg"] * f["fg"]
        both = F.struct(
            (_zero() - _ratio(f["gg"] * f["ef"] - f["fg"] * f["eg"], det)).alias("a"),
            (_zero() - _ratio(f["ff"] * f["eg"] - f["fg"] * f["ef"], det)).alias("b"),
        )

        def point(d):
            held_a, held_b = _outward(theta, d["a"]), _outward(seasonal, d["b"])
            # A parameter held at the bound leaves the other its own step.
            step_a = F.when(held_a, _zero()).when(held_b, _zero() - _ratio(f["ef"], f["ff"])).otherwise(d["a"])
            step_b = F.when(held_b, _zero()).when(held_a, _zero() - _ratio(f["eg"], f["gg"])).otherwise(d["b"])
            return F.struct(
                f["ee"].alias("sse"), theta.alias("theta"), seasonal.alias("seasonal"), step_a.alias("step"), step_b.alias("seasonal_step"),
                F.transform(f["last"], lambda x: x["e"]).alias("e"),
            )

        return _let(both, point)

    nothing = F.array_repeat(F.struct(*(_zero().alias(k) for k in "efg")), SEASON + 1)
    start = F.struct(nothing.alias("last"), *(_zero().alias(n) for n in sums))
    return _let(F.aggregate(steps, start, push), solved)


def seasonal_fit(arrays: DataFrame, train: Column) -> DataFrame:
    """Fit a (0,1,1)(0,1,1,12) model on the first `train` values of every series: theta, seasonal, sigma, converged."""
    part = F.slice(F.col("steps"), F.lit(1), F.col("train") - (SEASON + 1))
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in SEASONAL_STARTS for b in SEASONAL_STARTS))
    starts = F.transform(pairs, lambda pair: _seasonal_point(part, pair["a"], pair["b"]))

    def trial(p, scale):
        to = F.struct(_moved(p["theta"], p["step"], scale).alias("a"), _moved(p["seasonal"], p["seasonal_step"], scale).alias("b"))
        return _let(to, lambda pair: _seasonal_point(part, pair["a"], pair["b"]))

    fitted = arrays.withColumn("train", train).withColumn("steps", _seasonal_steps()).withColumn("fit", _descend(starts, trial, ("step", "seasonal_step")))
    still = (F.abs("fit.step") < TOLERANCE) & (F.abs("fit.seasonal_step") < TOLERANCE)
    return fitted.withColumns({
        "theta": F.col("fit.theta"), "seasonal": F.col("fit.seasonal"),
        "sigma": F.sqrt(F.col("fit.sse") / (F.col("train") - (SEASON + 1))),
        "converged": still & (F.abs("fit.theta") < BOUND) & (F.abs("fit.seasonal") < BOUND),
    })


def seasonal_predictions(arrays: DataFrame, keys: Sequence[str], test_periods: int,
                         name: str = "seasonal_ima_011_011_12") -> DataFrame:
    fitted = seasonal_fit(arrays.where(F.col("n") > test_periods + SEASON + 1), F.col("n") - test_periods)
    start = F.struct(F.col("fit.e").alias("e"), F.array().cast("array<double>").alias("out"))

    def push(acc, w):
        r = _seasonal_residual(w, acc["e"], F.col("theta"), F.col("seasonal"))
        return F.struct(F.slice(F.array_prepend(acc["e"], r), 1, SEASON + 1).alias("e"),
                        F.array_append(acc["out"], r).alias("out"))

    holdout = F.slice("steps", F.col("train") - SEASON, F.lit(test_periods))
    errors = F.aggregate(holdout, start, push, lambda a: a["out"])
    return _holdout_rows(fitted.withColumn("errors", errors), keys, test_periods, name, "sarima")


def optimum_check(fitted: DataFrame, keys: Sequence[str], name: str, distance: float = 0.001) -> DataFrame:
    """Per fitted series: its parameters, whether it converged, and how many points at `distance` in one parameter have a smaller sum."""
    ends = F.array(F.lit(-distance), F.lit(distance))
    if "seasonal" in fitted.columns:
        part = F.slice(F.col("steps"), F.lit(1), F.col("train") - (SEASON + 1))
        first = F.transform(ends, lambda x: _seasonal_point(part, F.col("theta") + x, F.col("seasonal"))["sse"])
        second = F.transform(ends, lambda x: _seasonal_point(part, F.col("theta"), F.col("seasonal") + x)["sse"])
        around = F.concat(first, second)
    else:
        part = F.slice(F.col("steps"), F.lit(1), F.col("train") - 1)
        around = F.transform(ends, lambda x: _ima_point(part, F.col("theta") + x)["sse"])
    smaller = F.size(F.filter(around, lambda sse: sse < F.col("fit.sse")))
    seasonal = F.col("seasonal") if "seasonal" in fitted.columns else F.lit(None).cast("double")
    return fitted.select(*keys, F.lit(name).alias("model_name"), "theta", seasonal.alias("seasonal"), "converged", smaller.alias("smaller_neighbours"))


def _forecast_rows(frame: DataFrame, keys: Sequence[str], points: Column, name: str) -> DataFrame:
    """Points to rows; the variance at step h is sigma²(1 + (h-1)(1+theta)²)."""
    rows = frame.select(*keys, "theta", "sigma", F.get("dates", F.col("n") - 1).alias("data_end"),
                        F.posexplode_outer(points).alias("__h", "point_forecast"))
    spread = F.sqrt(1 + F.col("__h") * (1 + F.col("theta")) * (1 + F.col("theta")))
    margin = Z95 * F.col("sigma") * spread
    return rows.select(
        *keys, F.lit(name).alias("model_name"), (F.col("__h") + 1).alias("step"),
        F.add_months("data_end", F.col("__h") + 1).alias("forecast_date"), "point_forecast",
        (F.col("point_forecast") - margin).alias("lower_bound"), (F.col("point_forecast") + margin).alias("upper_bound"),
    )


def ima_forecast(arrays: DataFrame, keys: Sequence[str], horizon: int, trend: str = "t",
                 name: str = "ima_011_drift") -> DataFrame:
    """Refit on the whole series and go `horizon` steps beyond its end."""
    fitted = ima_fit(arrays, F.col("n"), trend)
    slope_at = {"t": lambda h: F.col("n") + h, "c": lambda h: F.lit(1), "n": lambda h: F.lit(0)}[trend]
    drift = lambda h: F.aggregate(
        F.sequence(F.lit(1), h), _zero(), lambda acc, k: acc + F.col("slope") * slope_at(k)
    )
    base = F.get("values", F.col("n") - 1) + F.col("theta") * F.col("last_residual")
    points = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda h: base + drift(h))
    return _forecast_rows(fitted, keys, points, name)


def seasonal_forecast(arrays: DataFrame, keys: Sequence[str], horizon: int,
                      name: str = "seasonal_ima_011_011_12") -> DataFrame:
    if horizon > SEASON:
        raise ValueError("the variance formula holds for at most one season")
    fitted = seasonal_fit(arrays.where(F.col("n") > SEASON + 2), F.col("n"))
    e = lambda k: F.get("fit.e", k)  # noqa: E731  (newest first)

    def push(acc, h):
        innovation = (
            F.when(h == 1, F.col("theta") * e(F.lit(0))).otherwise(0.0)
            + F.col("seasonal") * e(SEASON - h)
            + F.col("theta") * F.col("seasonal") * e(SEASON + 1 - h)
        )
        size = F.size(acc)
        point = innovation + F.get(acc, size - 1) + F.get(acc, size - SEASON) - F.get(acc, size - SEASON - 1)
        return F.array_append(acc, point)

    recent = F.slice("values", F.col("n") - SEASON, F.lit(SEASON + 1))
    points = F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), recent, push), SEASON + 2, horizon)
    return _forecast_rows(fitted, keys, points, name)


def quality_gate(evaluations: DataFrame, keys: Sequence[str], *, minimum_improvement: float = 5.0,
                 maximum_mape: float = 5.0, minimum_coverage: float = 70.0) -> DataFrame:
    """Per series: best candidate against best baseline, and the reasons not to publish.

    `evaluations` has keys, model_name, family, mae, rmse, mape_percent,
    interval_coverage_percent, converged.
    """
    finite = evaluations.where(is_finite(F.col("mae")))
    entry = F.struct("mae", "model_name", "family", "rmse", "mape_percent", "interval_coverage_percent", "converged")
    base = F.col("family") == "baseline"
    picked = finite.groupBy(*keys).agg(
        F.min(F.when(base, entry)).alias("b"), F.min(F.when(~base, entry)).alias("s")
    ).where(F.col("b").isNotNull() & F.col("s").isNotNull())
    improvement = 100 * (F.col("b.mae") - F.col("s.mae")) / F.nullif(F.col("b.mae"), F.lit(0.0))
    mape, coverage = F.col("s.mape_percent"), F.col("s.interval_coverage_percent")
    reasons = F.array_compact(F.array(
        F.when(F.col("b.mae") == 0, "baseline_mae_zero"),
        F.when(~F.col("s.converged"), "not_converged"),
        F.when(improvement < minimum_improvement, "improvement_below_minimum"),
        F.when(~is_finite(mape) | (mape > maximum_mape), "mape_above_maximum"),
        F.when(~is_finite(coverage) | (coverage < minimum_coverage), "coverage_below_minimum"),
    ))
    return picked.withColumn("reasons", reasons).select(
        *keys, F.col("s.model_name").alias("selected_model_name"), F.col("s.family").alias("selected_model_family"),
        F.col("b.model_name").alias("baseline_model_name"), F.col("s.mae").alias("selected_mae"),
        F.col("s.rmse").alias("selected_rmse"), mape.alias("selected_mape_percent"), F.col("b.mae").alias("baseline_mae"),
        F.col("b.rmse").alias("baseline_rmse"), F.col("b.mape_percent").alias("baseline_mape_percent"),
        improvement.alias("mae_improvement_percent"), coverage.alias("interval_coverage_percent"), "reasons",
        F.when(F.size("reasons") == 0, "passed").otherwise("failed").alias("quality_status"),
    )
