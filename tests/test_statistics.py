"""Hand-computed statistics."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import growth_percent, numeric_token, numeric_token_issue, safe_percent_change
from tidemark.operators import readers, stats
from tidemark.operators.order_stats import average_ranks, cross_section, quantiles
from tidemark.operators.windows import checked_growth, series_window
from tidemark.plans.q_aggregates import fingerprints, monthly_seasonality


def test_profile(spark):
    frame = spark.createDataFrame([(1, 1.0), (2, None)], "complete int, partial double")
    rows = {r.column: r for r in stats.profile_columns(frame, ["complete", "partial"]).collect()}
    assert (rows["complete"].missing_count, rows["partial"].missing_count, rows["partial"].missing_percent) == (0, 1, 50.0)
    assert (rows["complete"].unique_count, rows["partial"].unique_count) == (2, 1)


def test_growth_keeps_order_and_skips_zero_base(spark):
    frame = spark.createDataFrame([("a", 2022, 12.0), ("a", 2020, 0.0), ("a", 2021, 10.0)], "s string, y int, v double")
    growth = growth_percent(F.col("v"), F.lag("v").over(series_window(["s"], "y")))
    rows = frame.select("y", growth.alias("g")).orderBy("y").collect()
    assert rows[0].g is None and rows[1].g is None and rows[2].g == pytest.approx(20)


def test_iqr_finds_the_one_high_value(spark):
    values = [10, 10, 11, 9, 10, 11, 10, 100]
    frame = spark.createDataFrame([(date(2020 + i, 1, 1), float(v)) for i, v in enumerate(values)], "d date, v double")
    (row,) = stats.iqr_outliers(frame, ["d"], ["v"]).collect()
    assert (row.value, row.direction, row.d) == (100.0, "high", date(2027, 1, 1))


def test_seasonality(spark):
    rows = [(date(2020, 1, 1), 10.0), (date(2021, 1, 1), 14.0), (date(2020, 2, 1), 20.0), (date(2021, 2, 1), 24.0), (date(2022, 2, 1), None)]
    result = {r.calendar_month: r for r in monthly_seasonality(spark.createDataFrame(rows, "d date, v double"), "d", "v").collect()}
    assert (result[1].observation_count, result[1].mean, result[2].median) == (2, 12.0, 22.0)


def test_pairwise_correlation_counts_overlap(spark):
    frame = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 8.0, 5.0)], "a double, b double, c double")
    pairs = {(r.left_variable, r.right_variable): r for r in stats.correlation_pairs(frame, ["a", "b", "c"]).collect()}
    assert pairs["a", "b"].correlation == pytest.approx(1) and pairs["a", "b"].overlap == 3
    assert pairs["a", "c"].correlation is None


def test_spearman_shares_ranks_on_ties(spark):
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate([(1, 10), (2, 10), (2, 30), (4, 40), (5, 35)])]
    (row,) = stats.spearman(spark.createDataFrame(rows, "i int, a double, b double"), ["i"], "a", "b").collect()
    ranks_a, ranks_b = [1, 2.5, 2.5, 4, 5], [1.5, 1.5, 3, 5, 4]
    mean = 3
    top = sum((x - mean) * (y - mean) for x, y in zip(ranks_a, ranks_b))
    expected = top / math.sqrt(sum((x - mean) ** 2 for x in ranks_a) * sum((y - mean) ** 2 for y in ranks_b))
    assert row.correlation == pytest.approx(expected) and row.overlap == 5


def test_spearman_pairs_rank_complete_rows_only(spark):
    rows = [(1.0, 10.0, 3.0, None), (2.0, 10.0, 3.0, 1.0), (2.0, 30.0, 3.0, None), (None, 5.0, 3.0, 2.0), (4.0, 40.0, 3.0, None), (5.0, 35.0, 3.0, float("nan"))]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    pairs = {(r.left_variable, r.right_variable): (r.correlation, r.overlap) for r in stats.spearman_pairs(frame, ["a", "b", "c", "d"]).collect()}
    (one,) = stats.spearman(frame.withColumn("i", F.monotonically_increasing_id()), ["i"], "a", "b").collect()
    assert len(pairs) == 10 and pairs["a", "b"] == (pytest.approx(one.correlation), 5)
    assert pairs["a", "a"] == (pytest.approx(1), 5) and pairs["b", "b"] == (pytest.approx(1), 6)
    assert pairs["a", "c"] == (None, 5) and pairs["a", "d"] == (None, 1) and pairs["d", "d"] == (None, 2)
    empty = stats.spearman_pairs(frame.limit(0), ["a", "b"]).collect()
    assert sorted((r.left_variable, r.right_variable, r.correlation, r.overlap) for r in empty) == [("a", "a", None, 0), ("a", "b", None, 0), ("b", "b", None, 0)]


def test_growth_refuses_repeated_dates(spark):
    rows = [("a", 1, 10.0), ("a", 2, 15.0), ("a", 3, 1.0), ("a", 3, 2.0), ("a", 4, 30.0), ("a", 5, 60.0), ("b", None, 5.0), ("b", 1, 5.0), ("b", 2, None)]
    frame = spark.createDataFrame(rows, "s string, d int, v double")
    got = {(r.s, r.d): (r.copies, r.issue, r.v_growth_percent) for r in checked_growth(frame, ["s"], "d", ["v"]).collect()}
    assert got == {
        ("a", 1): (1, None, None), ("a", 2): (1, None, pytest.approx(50)), ("a", 3): (2, "duplicate_date", None), ("a", 4): (1, None, None),
        ("a", 5): (1, None, pytest.approx(100)), ("b", None): (1, "missing_date", None), ("b", 1): (1, None, None), ("b", 2): (1, None, None),
    }


def test_lagged_correlation(spark):
    feature = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0]
    rows = [("s", 2000 + i, feature[i], feature[i - 1] if i else None) for i in range(10)]
    frame = spark.createDataFrame(rows, "s string, y int, x double, t double")
    result = {r.lag: r for r in stats.lagged_correlation(frame, ["s"], "y", "t", "x", [1, 8]).collect()}
    assert result[1].correlation == pytest.approx(1) and result[1].observation_count == 9
    assert result[8].correlation is None and result[8].observation_count == 2


def test_series_summary(spark):
    rows = [("s", date(2020 + i, 1, 1), v) for i, v in enumerate([90.0, 100.0, 120.0])] + [("one", date(2020, 1, 1), 5.0)]
    frame = spark.createDataFrame(rows, "s string, observation_date date, value double")
    result = {r.s: r for r in readers.series_summary(frame, ["s"]).collect()}
    assert (result["s"].absolute_change, result["s"].percent_change, result["s"].minimum, result["s"].maximum) == (20, 20, 90, 120)
    assert result["one"].previous_value is None and result["one"].absolute_change is None


def test_aligned_keeps_common_dates(spark):
    rows = [("g", date(2022, 1, 1), "A", 1.0), ("g", date(2023, 1, 1), "A", 2.0), ("g", date(2021, 1, 1), "B", 3.0), ("g", date(2023, 1, 1), "B", 4.0)]
    frame = spark.createDataFrame(rows, "g string, d date, code string, v double")
    (row,) = stats.aligned(frame, ["g"], "d", "code", "v", {"A": "a", "B": "b"}).collect()
    assert (row.d, row.a, row.b) == (date(2023, 1, 1), 2.0, 4.0)


def test_constant_pearson_is_null(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert frame.agg(stats.pearson(F.col("a"), F.col("b"))).first()[0] is None


def test_error_metrics(spark):
    columns = "observation_date date, actual double, prediction double, lower_bound double, upper_bound double, k int"
    rows = [(date(2020, 1, 1), 10.0, 8.0, 9.0, 11.0, 1), (date(2020, 2, 1), 20.0, 24.0, 21.0, 25.0, 1), (date(2020, 1, 1), 0.0, 5.0, None, None, 2)]
    result = {r.k: r for r in stats.error_metrics(spark.createDataFrame(rows, columns), ["k"]).collect()}
    assert (result[1].mae, result[1].mape_percent, result[1].interval_coverage_percent) == (3, 20, 50)
    assert result[1].rmse == pytest.approx(math.sqrt(10))
    assert result[2].mape_percent is None and result[2].interval_coverage_percent is None


def test_percent_changes_differ_in_sign(spark):
    frame = spark.createDataFrame([(5.0, -10.0), (5.0, 0.0)], "v double, p double")
    rows = frame.select(safe_percent_change(F.col("v"), F.col("p")).alias("a"), growth_percent(F.col("v"), F.col("p")).alias("b")).collect()
    assert (rows[0].a, rows[0].b) == (150.0, -150.0) and rows[1].a is None and rows[1].b is None


def test_numeric_tokens(spark):
    texts = ["", "-", "–", "—", "...", "NA", "n/a", "null", "1,5", "abc", "inf", "nan", " 2.5 ", "-3"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select(numeric_token(F.col("t")).alias("n"), numeric_token_issue(F.col("t")).alias("i")).collect()
    assert [r.n for r in rows] == [None] * 12 + [2.5, -3.0]
    assert [r.i for r in rows][8:12] == ["ambiguous_format", "not_numeric", "not_finite", "not_finite"]
    assert all(r.i is None for r in rows[:8])


def skewed(spark):
    """One group holds most rows, and one value most of that group."""
    return spark.range(6000).select(
        F.when(F.col("id") < 5000, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"), "id",
        F.when(F.col("id") < 2000, 7).otherwise((F.col("id") * 37) % 1009).cast("decimal(24,6)").alias("v"),
    )


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_cross_section_equals_window_functions_under_skew(spark, slices):
    frame = skewed(spark)
    frame.createOrReplaceTempView("skewed_rows")
    expected = spark.sql("""
        SELECT id, rank() OVER (PARTITION BY g ORDER BY v DESC) r, percent_rank() OVER (PARTITION BY g ORDER BY v) p,
               avg(cast(v AS double)) OVER (PARTITION BY g) m, count(*) OVER (PARTITION BY g) n FROM skewed_rows""")
    ours = cross_section(frame, ["g"], "v", slices).select("id", "rank_desc", "percent_rank", "group_mean", "group_count")
    for a, b in zip(sorted(map(tuple, ours.collect())), sorted(map(tuple, expected.collect())), strict=True):
        assert a == pytest.approx(b)


@pytest.mark.parametrize("slices", [2, 64])
def test_quantiles_equal_exact_percentiles(spark, slices):
    frame = skewed(spark)
    expected = {r.g: r for r in frame.groupBy("g").agg(F.percentile("v", 0.25).alias("a"), F.percentile("v", 0.9).alias("b")).collect()}
    for row in quantiles(frame, ["g"], "v", {"a": 0.25, "b": 0.9}, slices).collect():
        assert (row.a, row.b) == pytest.approx((expected[row.g].a, expected[row.g].b))


def test_average_ranks(spark):
    frame = spark.createDataFrame([("g", 1, 5.0), ("g", 2, 5.0), ("g", 3, 1.0), ("g", 4, None)], "g string, i int, v double")
    assert {r.i: r.k for r in average_ranks(frame, ["g"], "v", "k").collect()} == {1: 2.5, 2: 2.5, 3: 1.0, 4: None}


def test_cross_section_keeps_rows_without_value_or_group(spark):
    frame = spark.createDataFrame([("g", 1, 5.0), ("g", 2, None), (None, 3, 2.0), ("e", 4, None)], "g string, i int, v double").withColumn("v", F.col("v").cast("decimal(24,6)"))
    rows = {r.i: (r.rank_desc, r.group_mean) for r in cross_section(frame, ["g"], "v").collect()}
    assert rows == {1: (1, 5.0), 2: (None, 5.0), 3: (1, 2.0), 4: (None, None)}


def test_profile_of_all_columns_and_of_nothing(spark):
    frame = spark.createDataFrame([(1, "a", [1, 2], None), (2, "a", [1, 2], None), (None, "b", None, None)], "`a.b` int, text string, list array<int>, n double")
    got = {r.column: (r.dtype, r.non_null_count, r.missing_count, r.unique_count) for r in stats.profile_columns(frame).collect()}
    assert got == {"a.b": ("int", 2, 1, 2), "text": ("string", 3, 0, 2), "list": ("array<int>", 2, 1, 1), "n": ("double", 0, 3, 0)}
    empty = {(r.column, r.non_null_count, r.missing_percent) for r in stats.profile_columns(frame.limit(0)).collect()}
    assert empty == {(c, 0, None) for c in got}


def test_fingerprints_refuse_repeated_dates(spark):
    frame = spark.createDataFrame([("a", "2020-02-01", 1.5), ("a", "2020-01-01", None), ("b", "2020-01-01", 2.0)], "k string, observation_date string, value double")
    again = fingerprints(frame.orderBy("value"), ["k"]).collect()
    assert sorted(again) == sorted(fingerprints(frame, ["k"]).collect()) and len({r.data_fingerprint for r in again}) == 2
    assert fingerprints(frame.limit(0), ["k"]).collect() == []
    with pytest.raises(Exception, match="duplicate_date b 2020-01-01"):
        fingerprints(frame.union(frame.where("k = 'b'")), ["k"]).collect()
