"""The read interface: pages, overviews, comparisons and dashboard views."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl
from tidemark.operators import readers, stats
from tidemark.operators.order_stats import cross_section, quantiles
from tidemark.operators.rules import set_difference
from tidemark.operators.windows import latest_per_group, newest
from tidemark.plans import marts, panels
from tidemark.plans.q_aggregates import SUMMARY_SQL, indicator_catalog, region_catalog, span
from tidemark.plans.q_joins import timeline
from tidemark.plans.q_marts import MONETARY_SQL, OVERVIEW_SQL
from tidemark.plans.q_windows import page_sql, run_table
from tidemark.plans.registry import query
from tidemark.session import settle
from tidemark.sources import reference_tables as ref

FOCUS = ref.FOCUS_REGION


@query("overview", OVERVIEW_SQL.replace("FROM mart_overview", "FROM mart_overview ORDER BY observation_date DESC LIMIT 1"))
def _(lake):
    rows = marts.national_overview(panels.staged(lake, "ledger_annual", regions=[FOCUS]))
    return rows.orderBy(F.col("observation_date").desc()).limit(1)


@query("overview_monthly", MONETARY_SQL.replace("FROM mart_monetary", f"FROM mart_monetary WHERE region_code = '{FOCUS}' ORDER BY observation_date DESC LIMIT 1"))
def _(lake):
    rows = panels.staged(lake, "ledger_monthly", regions=[FOCUS])
    return marts.monetary_conditions(rows).orderBy(F.col("observation_date").desc()).limit(1)


CATALOG = """SELECT i.indicator_code, i.indicator_name, i.unit, i.frequency, string_agg(DISTINCT s.source_code, ',' ORDER BY s.source_code) AS source_codes,
count(f.value) AS observation_count, count(DISTINCT f.region_id) AS region_count, min(observation_date) AS period_start, max(observation_date) AS period_end
FROM d_indicator i LEFT JOIN f_all f USING (indicator_id) LEFT JOIN d_source s ON s.source_id = f.source_id WHERE i.frequency = 'annual' GROUP BY 1, 2, 3, 4"""


@query("indicators", page_sql(CATALOG, "indicator_code", 1, 5))
def _(lake):
    return readers.page(settle(indicator_catalog(lake, frequency="annual")), ["indicator_code"], 1, 5)


SERIES = f"SELECT observation_date, R(value) AS value, source_code, ingested_at FROM stg_monthly WHERE indicator_code = 'M.RATE' AND region_code = '{FOCUS}' AND observation_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"


@query("indicator_series", page_sql(SERIES, "observation_date, source_code", 2, 20))
def _(lake):
    rows = readers.optional_filters(panels.staged(lake, "ledger_monthly", indicators=["M.RATE"], regions=[FOCUS], years=(1996, 1999)), indicator_code="M.RATE", region_code=FOCUS)
    rows = readers.year_range(rows, 1996, 1999).select("observation_date", "value", "source_code", "ingested_at")
    return readers.page(settle(rows), ["observation_date", "source_code"], 2, 20)


REGIONS = """SELECT r.region_code, r.region_name, r.region_level, r.parent_region_code, count(DISTINCT indicator_id) AS indicator_count, count(f.value) AS observation_count,
min(observation_date) AS period_start, max(observation_date) AS period_end FROM d_region r LEFT JOIN f_all f USING (region_id) WHERE r.region_level = 'province' GROUP BY ALL"""


@query("regions", page_sql(REGIONS, "region_level, region_code", 2, 50))
def _(lake):
    return readers.page(settle(region_catalog(lake, region_level="province")), ["region_level", "region_code"], 2, 50)


LATEST = f"""SELECT indicator_code, indicator_name, unit, frequency, source_code, observation_date, R(value) AS value, ingested_at FROM (
SELECT *, row_number() OVER (PARTITION BY indicator_code ORDER BY observation_date DESC, ingested_at DESC, source_code) AS rn FROM stg_all WHERE region_code = '{FOCUS}' AND observation_date <= DATE '2000-12-31') WHERE rn = 1"""


def latest_values(rows, keys):
    """Latest value per key: newest date, then newest ingest, then source name."""
    return latest_per_group(rows, keys, [newest("observation_date"), newest("ingested_at"), F.col("source_code")])


@query("region_overview", page_sql(LATEST, "indicator_code", 1, 20))
def _(lake):
    rows = panels.star_join(panels.facts(lake, regions=[FOCUS], years=(None, 2000)), panels.regions(lake)).where(F.col("region_code") == FOCUS)
    rows = readers.year_range(rows, end_year=2000).select(
        "indicator_code", "indicator_name", "unit", "frequency", "source_code", "observation_date", "value", "ingested_at"
    )
    return readers.page(settle(latest_values(rows, ["indicator_code"])), ["indicator_code"], 1, 20)


@query("asean_comparison", """
SELECT region_code, region_name, member_since, I(was_member_during_period) AS was_member_during_period, observation_date, R(value) AS value, R(group_average) AS group_average,
       R(difference_from_group_average) AS difference_from_group_average, country_coverage, value_rank_desc, R(value_percentile) AS value_percentile
FROM mart_group WHERE indicator_code = 'A.REVENUE' AND observation_year = (SELECT max(observation_year) FROM mart_group WHERE indicator_code = 'A.REVENUE') ORDER BY value_rank_desc, region_code
""")
def _(lake):
    return group_of_year(lake, "A.REVENUE")


def group_of_year(lake, indicator_code, year=None):
    """The ranked members in one year, by default the latest."""
    staged = panels.staged(lake, "ledger_annual", indicators=[indicator_code], regions=[code for code, _ in ref.MEMBERS])
    rows = settle(marts.group_comparison(staged, ref.members(lake.spark)))
    if year is None:
        chosen = rows.join(F.broadcast(rows.agg(F.max("observation_year").alias("observation_year"))), "observation_year", "left_semi")
    else:
        chosen = rows.where(F.col("observation_year") == year)
    return chosen.select(
        "region_code", "region_name", "member_since", "was_member_during_period", "observation_date", "value", "group_average",
        "difference_from_group_average", "country_coverage", "value_rank_desc", "value_percentile",
    ).orderBy("value_rank_desc", "region_code")


RUNS = "SELECT run_id, source_code, started_at, completed_at, status, rows_loaded, I(length(coalesce(error_message, '')) > 0) AS has_error FROM run_table WHERE status = 'failed'"


@query("run_history", page_sql(RUNS, "started_at DESC, run_id DESC", 2, 25))
def _(lake):
    rows = readers.optional_filters(run_table(lake), source_code=None, status="failed")
    flag = F.length(F.coalesce("error_message", F.lit(""))) > 0
    rows = settle(rows.withColumn("has_error", flag).drop("error_message"))
    return readers.page(rows, [F.col("started_at").desc(), F.col("run_id").desc()], 2, 25)


@query("entity_lookup", f"""
SELECT 'region' AS kind, region_code AS code, region_name AS name FROM d_region WHERE region_code = '{FOCUS}' UNION ALL SELECT 'indicator', indicator_code, indicator_name FROM d_indicator WHERE indicator_code = 'M.RATE'
""")
def _(lake):
    region = panels.regions(lake).where(F.col("region_code") == FOCUS).select(F.lit("region").alias("kind"), F.col("region_code").alias("code"), F.col("region_name").alias("name"))
    indicator = ref.indicators(lake.spark).where("indicator_code = 'M.RATE'").select(F.lit("indicator"), "indicator_code", "indicator_name")
    return region.union(indicator)


@query("regional_cross_section", """
SELECT region_code, region_name, R(value) AS value, value_rank, R(median) AS median, R(hi - lo) AS spread FROM (
  SELECT *, rank() OVER (ORDER BY value DESC) AS value_rank, quantile_cont(value::DOUBLE, 0.5) OVER () AS median, max(value) OVER () AS hi, min(value) OVER () AS lo FROM (
    SELECT *, row_number() OVER (PARTITION BY region_code ORDER BY observation_date DESC, ingested_at DESC, source_code) AS rn FROM stg_regional WHERE indicator_code = 'R.543.TV0.TP0') WHERE rn = 1)
""")
def _(lake):
    rows = panels.staged(lake, "ledger_regional").where("indicator_code = 'R.543.TV0.TP0'")
    latest = settle(latest_values(rows, ["indicator_code", "region_code"]).select("indicator_code", "region_code", "region_name", "value"))
    middle = quantiles(latest, ["indicator_code"], "value", {"median": 0.5})
    ends = latest.groupBy("indicator_code").agg((F.max("value") - F.min("value")).alias("spread"))
    ranked = cross_section(latest, ["indicator_code"], "value")
    return ranked.join(middle, "indicator_code").join(ends, "indicator_code").select(
        "region_code", "region_name", "value", F.col("rank_desc").alias("value_rank"), "median", "spread"
    )


@query("kpi_cards", """
SELECT indicator_code, latest_date, latest_value, previous_value, minimum, maximum, R(CASE WHEN unit = 'percent' THEN absolute_change ELSE percent_change END) AS shown_change FROM (""" + SUMMARY_SQL.format(
    keys="indicator_code, unit", table=f"(SELECT * FROM stg_annual WHERE region_code = '{FOCUS}' AND observation_date >= DATE '1999-01-01')") + ")")
def _(lake):
    rows = panels.staged(lake, "ledger_annual", regions=[FOCUS])
    summary = readers.series_summary(settle(readers.year_range(rows, start_year=1999)), ["indicator_code", "unit"])
    shown = readers.kpi_change(F.col("unit"), F.col("absolute_change"), F.col("percent_change"))
    return summary.select("indicator_code", "latest_date", "latest_value", "previous_value", "minimum", "maximum", shown.alias("shown_change"))


DRIVERS = {"A.ORDERS": "target", "A.REVENUE": "d1", "A.DISCOUNT": "d2", "A.CUSTOMERS": "d3", "A.QUANTITY": "d4"}
DRIVER_ROWS = "SELECT region_code, observation_date, " + ", ".join(f"max(value::DOUBLE) FILTER (indicator_code = '{c}') AS {n}" for c, n in DRIVERS.items()) + " FROM stg_annual GROUP BY 1, 2"


@query("driver_analysis", "SELECT driver, R(correlation) AS correlation, observation_count FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS driver, covar_pop(target, {n}) / nullif(stddev_pop(target) * stddev_pop({n}), 0) AS correlation, count(*) AS observation_count FROM ({DRIVER_ROWS}) WHERE d1 + d2 + d3 + d4 + target IS NOT NULL"
    for n in list(DRIVERS.values())[1:]) + ") ORDER BY abs(correlation) DESC, driver")
def _(lake):
    rows = stats.aligned(panels.staged(lake, "ledger_annual"), ["region_code"], "observation_date", "indicator_code", "value", DRIVERS)
    pairs = stats.correlation_pairs(rows, list(DRIVERS.values()), minimum=2).where("left_variable = 'target' AND right_variable <> 'target'")
    return pairs.select(F.col("right_variable").alias("driver"), "correlation", F.col("overlap").alias("observation_count")).orderBy(
        F.abs("correlation").desc(), "driver"
    )


@query("driver_pairs", f"SELECT region_code, observation_date, R(target) AS target, R(d1) AS d1 FROM ({DRIVER_ROWS}) WHERE target IS NOT NULL AND d1 IS NOT NULL")
def _(lake):
    return stats.aligned(panels.staged(lake, "ledger_annual"), ["region_code"], "observation_date", "indicator_code", "value", {"A.ORDERS": "target", "A.REVENUE": "d1"})


@query("default_filters", """
SELECT indicator_code, frequency, observation_count, I(indicator_code = (SELECT min(indicator_code) FROM stg_all)) AS is_default, I(greatest(y - 9, x)) AS start_year, I(y) AS end_year
FROM (SELECT indicator_code, frequency, count(*) AS observation_count, max(observation_year) AS y, min(observation_year) AS x FROM stg_all GROUP BY 1, 2)
""")
def _(lake):
    catalog = indicator_catalog(lake).where("observation_count > 0")
    first = F.min("indicator_code").over(Window.partitionBy(F.lit(1)))  # the catalog is a fixed list
    last = F.year("period_end")
    return catalog.select(
        "indicator_code", "frequency", "observation_count", (F.col("indicator_code") == first).alias("is_default"),
        F.greatest(last - 9, F.year("period_start")).alias("start_year"), last.alias("end_year"),
    )


@query("verify_provincial", """
SELECT s.indicator_code, count(DISTINCT s.region_code) AS regions_present, (SELECT count(*) FROM supplier) AS regions_expected, count(*) AS observation_count, min(observation_date) AS period_start, max(observation_date) AS period_end
FROM stg_regional s GROUP BY 1
""")
def _(lake):
    rows = settle(panels.staged(lake, "ledger_regional"))
    present = rows.groupBy("indicator_code").agg(F.count_distinct("region_code").alias("regions_present"))
    expected = lake.supplier.count()
    return span(rows, ["indicator_code"]).join(present, "indicator_code").withColumn("regions_expected", F.lit(expected).cast("long"))


@query("verify_monthly", """
SELECT region_code, max(e) FILTER (indicator_code = 'M.POLICY') = max(e) FILTER (indicator_code = 'M.RATE') AS x, I(max(e) = min(e)) AS same_end, sum(n)::BIGINT AS observation_count FROM (
SELECT region_code, indicator_code, max(observation_date) AS e, count(*) AS n FROM stg_monthly GROUP BY 1, 2) GROUP BY 1
""".replace("max(e) FILTER (indicator_code = 'M.POLICY') = max(e) FILTER (indicator_code = 'M.RATE') AS x, ", ""))
def _(lake):
    spans = span(panels.staged(lake, "ledger_monthly"), ["region_code", "indicator_code"])
    return spans.groupBy("region_code").agg(
        (F.max("period_end") == F.min("period_end")).alias("same_end"), F.sum("observation_count").alias("observation_count")
    )


@query("region_code_reconcile", """
SELECT a.code AS region_code, 'missing' AS status FROM (SELECT DISTINCT s_suppkey::VARCHAR AS code FROM supplier) a
WHERE code NOT IN (SELECT region_code FROM stg_regional WHERE value > 2000 AND observation_date = DATE '2001-01-01')
""")
def _(lake):
    official = panels.staged(lake, "ledger_regional").where("value > 2000 AND observation_date = DATE'2001-01-01'")
    configured = lake.supplier.select(F.col("s_suppkey").cast("string").alias("region_code"))
    return set_difference(configured, official, "region_code")


@query("forecast_timeline", """
SELECT region_code, observation_date, R(actual) AS actual, R(estimate) AS estimate, R(band) AS band FROM (
  SELECT region_code, observation_date, y AS actual, CASE WHEN i = n THEN y END AS estimate, NULL AS band FROM series_rows
  UNION ALL SELECT region_code, forecast_date, NULL, point_forecast, upper_bound - lower_bound FROM all_future WHERE model_name = 'ima_011_drift')
""")
def _(lake):
    from tidemark.operators.forecast import ima_forecast, regular_series, series_arrays
    from tidemark.plans.q_aggregates import month_series

    regular = settle(regular_series(settle(month_series(lake)), ["region_code"], "value"))
    forecast = ima_forecast(series_arrays(regular, ["region_code"], "value"), ["region_code"], 6)
    history = regular.select("region_code", "observation_date", dbl("value").alias("actual"))
    points = forecast.select("region_code", F.col("forecast_date").alias("observation_date"), F.col("point_forecast").alias("estimate"), "lower_bound", "upper_bound")
    return timeline(history, points, ["region_code"])
