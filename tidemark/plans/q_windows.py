"""Window functions, ordering and top-k, set operations."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl, growth_percent
from tidemark.operators import ops, readers, stats
from tidemark.operators.anomaly import checked_anomalies, input_issues, rolling_mad_anomalies, scored_changes
from tidemark.operators.calendar import calendar_slots
from tidemark.operators.forecast import naive_predictions
from tidemark.operators.order_stats import cross_section, running_tallies
from tidemark.operators.rules import set_difference
from tidemark.operators.windows import checked_growth, gaps, latest_per_group, neighbours, newest, rolling_mean, series_window
from tidemark.plans import marts, panels
from tidemark.plans.oracle_tables import TABLES
from tidemark.plans.q_aggregates import SEVEN, month_series, monthly_seasonality
from tidemark.plans.q_filters import CUSTOMER_YEARS, customer_years
from tidemark.plans.q_joins import correlation_dataset
from tidemark.plans.registry import query
from tidemark.session import settle
from tidemark.sources import reference_tables as ref

KEYS = ["indicator_code", "region_code"]


@query("lag_lead", f"""
SELECT o_custkey, observation_date, R(value) AS value, lag(observation_date) OVER w AS previous_date, R(lag(value) OVER w) AS previous_value,
       lead(observation_date) OVER w AS next_date, R(lead(value) OVER w) AS next_value
FROM ({CUSTOMER_YEARS}) WINDOW w AS (PARTITION BY o_custkey ORDER BY observation_date)
""")
def _(lake):
    return neighbours(customer_years(lake), ["o_custkey"], {"observation_date": "date", "value": "value"})


@query("rolling_mean_3", f"""
SELECT o_custkey, observation_date, R(sum(value) OVER w::DOUBLE / count(value) OVER w::DOUBLE) AS rolling_mean
FROM ({CUSTOMER_YEARS}) WINDOW w AS (PARTITION BY o_custkey ORDER BY observation_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def _(lake):
    return customer_years(lake).select("o_custkey", "observation_date", rolling_mean("value", ["o_custkey"]).alias("rolling_mean"))


def customer_sections(lake):
    """Every customer's yearly value against all customers of the year."""
    return cross_section(settle(customer_years(lake)), ["observation_date"], "value")


@query("group_mean_dev", f"""
SELECT o_custkey, observation_date, R(m) AS group_mean, R(value::DOUBLE - m) AS difference, n AS group_count
FROM (SELECT *, sum(value) OVER w::DOUBLE / count(value) OVER w::DOUBLE AS m, count(*) OVER w AS n FROM ({CUSTOMER_YEARS}) WINDOW w AS (PARTITION BY observation_date))
""")
def _(lake):
    return customer_sections(lake).select(
        "o_custkey", "observation_date", "group_mean", (dbl("value") - F.col("group_mean")).alias("difference"), "group_count"
    )


@query("rank_desc", f"SELECT o_custkey, observation_date, rank() OVER (PARTITION BY observation_date ORDER BY value DESC) AS value_rank FROM ({CUSTOMER_YEARS})")
def _(lake):
    return customer_sections(lake).select("o_custkey", "observation_date", F.col("rank_desc").alias("value_rank"))


@query("percent_rank", f"SELECT o_custkey, observation_date, R(percent_rank() OVER (PARTITION BY observation_date ORDER BY value)) AS value_percentile FROM ({CUSTOMER_YEARS})")
def _(lake):
    return customer_sections(lake).select("o_custkey", "observation_date", F.col("percent_rank").alias("value_percentile"))


@query("rank_sliced", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, R(l_extendedprice) AS price, rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice::DECIMAL(24,6) DESC) AS price_rank FROM lineitem
""")
def _(lake):
    # Three groups for the whole table: each is cut into value slices.
    rows = lake.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(24,6)").alias("price"))
    ranked = cross_section(rows, ["l_returnflag"], "price", slices=16)
    return ranked.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price", F.col("rank_desc").alias("price_rank"))


@query("period_over_period", """
SELECT region_code, observation_date, R(policy_rate_change_pp) AS policy_rate_change_pp, R(exchange_rate_mom_change) AS exchange_rate_mom_change, R(exchange_rate_mom_percent_change) AS exchange_rate_mom_percent_change FROM mart_monetary
""")
def _(lake):
    rows = marts.monetary_conditions(panels.staged(lake, "ledger_monthly"))
    return rows.select("region_code", "observation_date", "policy_rate_change_pp", "exchange_rate_mom_change", "exchange_rate_mom_percent_change")


@query("gap_detection", f"""
SELECT o_custkey, observation_date AS period_before_gap, n AS period_after_gap, date_sub('year', observation_date, n) AS period_gap, date_sub('year', observation_date, n) - 1 AS missing_period_count
FROM (SELECT *, lead(observation_date) OVER (PARTITION BY o_custkey ORDER BY observation_date) AS n FROM ({CUSTOMER_YEARS})) WHERE date_sub('year', observation_date, n) > 1
""")
def _(lake):
    return gaps(customer_years(lake), ["o_custkey"], "YEAR")


@query("gap_detection_monthly", """
SELECT o_custkey, m AS period_before_gap, n AS period_after_gap, date_sub('month', m, n) AS period_gap, date_sub('month', m, n) - 1 AS missing_period_count
FROM (SELECT o_custkey, m, lead(m) OVER (PARTITION BY o_custkey ORDER BY m) AS n FROM (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate)::DATE AS m FROM orders)) WHERE date_sub('month', m, n) > 1
""")
def _(lake):
    months = lake.orders.select("o_custkey", F.trunc("o_orderdate", "MM").alias("observation_date")).distinct()
    return gaps(months, ["o_custkey"], "MONTH")


@query("latest_per_group", """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def _(lake):
    rows = lake.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return latest_per_group(rows, ["o_custkey"], [newest("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderkey")])


TABLES["run_events"] = """
SELECT user_id || ':' || ts::DATE::VARCHAR AS run_id, 'u' || user_id AS source_code, ts AS "at",
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' ELSE 'running' END AS status,
       CASE WHEN event_type = 'purchase' THEN I(floor(value)) END AS rows_loaded, CASE WHEN event_type = 'error' THEN CASE WHEN value > 20 THEN props ELSE '' END END AS error_message
FROM events
"""
TABLES["run_table"] = """
SELECT s.run_id, s.source_code, s.started_at, f."at" AS completed_at, coalesce(f.status, 'running') AS status, f.rows_loaded, f.error_message
FROM (SELECT run_id, source_code, min("at") AS started_at FROM run_events WHERE status = 'running' GROUP BY 1, 2) s
LEFT JOIN (SELECT e.*, row_number() OVER (PARTITION BY e.run_id ORDER BY e."at") AS rn FROM run_events e
  JOIN (SELECT run_id, min("at") AS started_at FROM run_events WHERE status = 'running' GROUP BY 1) b ON b.run_id = e.run_id AND e."at" >= b.started_at WHERE status <> 'running') f
  ON f.run_id = s.run_id AND f.rn = 1
"""


def run_events(lake):
    """User actions as run events: errors fail a user's run of the day, purchases complete it."""
    kind = F.col("event_type")
    return lake.events.select(
        F.concat_ws(":", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("run_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_code"), F.col("ts").alias("at"),
        F.when(kind == "error", "failed").when(kind == "purchase", "success").otherwise("running").alias("status"),
        F.when(kind == "purchase", F.floor("value")).alias("rows_loaded"),
        F.when(kind == "error", F.when(F.col("value") > 20, F.col("props")).otherwise("")).alias("error_message"),
    )


def run_table(lake):
    return ops.run_states(run_events(lake))


@query("run_ledger", "SELECT run_id, source_code, started_at, completed_at, status, rows_loaded, error_message FROM run_table")
def _(lake):
    return run_table(lake)


FAILURE_SQL = """
SELECT source_code, run_id, started_at, completed_at, status, rows_loaded, error_message FROM (
  SELECT *, row_number() OVER (PARTITION BY source_code ORDER BY started_at DESC, run_id DESC) AS rn FROM run_table) WHERE rn = 1 AND status = 'failed'
"""


@query("latest_failed_run", FAILURE_SQL)
def _(lake):
    return ops.latest_failures(run_table(lake))


@query("latest_success", "SELECT source_code, max(completed_at) AS last_success_at FROM run_table WHERE status = 'success' AND completed_at IS NOT NULL GROUP BY 1")
def _(lake):
    return ops.latest_success(run_table(lake))


@query("growth_rates", """
SELECT region_code, observation_date, R(orders) AS orders, """ + ", ".join(f"R(({c}::DOUBLE / nullif(lag({c}) OVER w::DOUBLE, 0) - 1) * 100) AS {c}_growth_percent" for c in marts.OVERVIEW_COLUMNS.values()) + """
FROM mart_overview_all WINDOW w AS (PARTITION BY region_code ORDER BY observation_date)
""")
def _(lake):
    rows = marts.national_overview(panels.staged(lake, "ledger_annual"), None)
    spec = series_window(["region_code"])
    return rows.select("region_code", "observation_date", "orders", *(
        growth_percent(F.col(c), F.lag(c).over(spec)).alias(f"{c}_growth_percent") for c in marts.OVERVIEW_COLUMNS.values()
    ))


@query("growth_rates_checked", """
SELECT region_code, observation_date, CASE WHEN year(observation_date) = 1995 THEN 2 ELSE 1 END::BIGINT AS copies, CASE WHEN year(observation_date) = 1995 THEN 'duplicate_date' END AS issue,
       CASE WHEN year(observation_date) <> 1995 THEN R(orders) END AS orders,
       CASE WHEN year(observation_date) <> 1995 AND coalesce(year(lag(observation_date) OVER w), 0) <> 1995 THEN R((orders::DOUBLE / nullif(lag(orders) OVER w::DOUBLE, 0) - 1) * 100) END AS orders_growth_percent
FROM mart_overview_all WINDOW w AS (PARTITION BY region_code ORDER BY observation_date)
""")
def _(lake):
    rows = marts.national_overview(panels.staged(lake, "ledger_annual"), None)
    copies = F.explode(F.sequence(F.lit(1), F.when(F.year("observation_date") == 1995, 2).otherwise(1)))
    return checked_growth(rows.select("region_code", "observation_date", "orders", copies.alias("copy")), ["region_code"], "observation_date", ["orders"])


LAGS = [-3, -2, -1, 0, 1, 2, 3]
TABLES["lag_corr"] = " UNION ALL ".join(
    f"SELECT region_code, {lag} AS lag, CASE WHEN count(x) FILTER (y IS NOT NULL) >= 6 THEN covar_pop(y, x) / nullif(stddev_pop(y) FILTER (x IS NOT NULL) * stddev_pop(x) FILTER (y IS NOT NULL), 0) END AS correlation, "
    f"count(x) FILTER (y IS NOT NULL) AS observation_count FROM (SELECT region_code, exchange_rate::DOUBLE AS y, "
    f"{'lag' if lag >= 0 else 'lead'}(policy_rate_percent::DOUBLE, {abs(lag)}) OVER (PARTITION BY region_code ORDER BY observation_date) AS x FROM mart_monetary) GROUP BY 1"
    for lag in LAGS
)


def lagged(lake):
    rows = marts.monetary_conditions(panels.staged(lake, "ledger_monthly"))
    return stats.lagged_correlation(rows, ["region_code"], "observation_date", "exchange_rate", "policy_rate_percent", LAGS)


@query("lagged_correlation", "SELECT region_code, I(lag) AS lag, R(correlation) AS correlation, observation_count FROM lag_corr")
def _(lake):
    return lagged(lake)


@query("best_lag", """
SELECT region_code, I(lag) AS lag, R(correlation) AS correlation, observation_count FROM (
  SELECT *, row_number() OVER (PARTITION BY region_code ORDER BY abs(correlation) DESC, lag) AS rn FROM lag_corr WHERE correlation IS NOT NULL) WHERE rn = 1
""")
def _(lake):
    rows = lagged(lake).where("correlation IS NOT NULL")
    return latest_per_group(rows, ["region_code"], [-F.abs("correlation"), F.col("lag")])


@query("first_difference", """
SELECT nation_key, observation_date, R(rate - lag(rate) OVER (PARTITION BY nation_key ORDER BY observation_date)) AS change FROM month_grid LEFT JOIN month_rate USING (nation_key, observation_date)
""")
def _(lake):
    full = calendar_slots(panels.monthly_rates(lake), ["nation_key"], "observation_date", "month")
    change = F.col("rate") - F.lag("rate").over(series_window(["nation_key"]))
    return full.select("nation_key", "observation_date", change.alias("change"))


TABLES["mad_scores"] = """
SELECT *, 0.67448975::DOUBLE * (change - med) / nullif(mad, 0) AS score FROM (
  SELECT *, list_aggregate(list_transform(h, lambda x: abs(x - med)), 'median') AS mad FROM (
    SELECT *, list_aggregate(h, 'median') AS med FROM (
      SELECT *, list_filter(list(CASE WHEN NOT revised THEN change END) OVER (PARTITION BY region_code ORDER BY observation_date ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), lambda x: x IS NOT NULL) AS h
      FROM (SELECT region_code, observation_date, observed, revised, observed - lag(observed) OVER (PARTITION BY region_code ORDER BY observation_date) AS change
            FROM (SELECT 'N' || lpad(g.nation_key::VARCHAR, 2, '0') AS region_code, g.observation_date, r.rate::DOUBLE AS observed, coalesce(days <= 2, false) AS revised
                  FROM month_grid g LEFT JOIN month_rate r USING (nation_key, observation_date)
                  LEFT JOIN (SELECT nation_key, date_trunc('month', day)::DATE AS observation_date, count(*) AS days FROM daily GROUP BY 1, 2) d USING (nation_key, observation_date))))))
"""
TABLES["anomaly_events"] = """
SELECT region_code, observation_date, observed AS observed_value, change, CASE WHEN kind = 'economic_anomaly' THEN score END AS score, 3.5::DOUBLE AS threshold, kind AS anomaly_type,
       CASE kind WHEN 'economic_anomaly' THEN 'rolling_mad_first_difference' WHEN 'source_revision' THEN 'source_revision_metadata' ELSE 'calendar_continuity' END AS "method",
       CASE kind WHEN 'economic_anomaly' THEN printf('change %.6f against median %.6f; mad %.6f; score ', change, med, mad) || CASE WHEN mad = 0 THEN 'undefined' ELSE printf('%.3f', score) END || '; threshold 3.500'
                 WHEN 'source_revision' THEN 'confirmed revision: thin month' ELSE 'no value for ' || observation_date::VARCHAR END AS reason
FROM (SELECT *, CASE WHEN observed IS NULL THEN 'missing_value' WHEN revised THEN 'source_revision'
        WHEN change IS NOT NULL AND len(h) >= 12 AND ((mad = 0 AND change <> med) OR abs(score) >= 3.5) THEN 'economic_anomaly' END AS kind FROM mad_scores)
WHERE kind IS NOT NULL
"""


def revisions(lake):
    """Months with at most two priced days count as revised by the publisher."""
    days = panels.daily_rates(lake).groupBy(
        panels.country_code("nation_key").alias("region_code"), F.trunc("day", "MM").alias("observation_date")
    ).agg(F.count(F.lit(1)).alias("days"))
    return days.where("days <= 2").select("region_code", "observation_date", F.lit("thin month").alias("reason"))


def anomaly_events(lake):
    return rolling_mad_anomalies(month_series(lake), ["region_code"], "value", revisions=revisions(lake))


@query("rolling_mad", """
SELECT region_code, observation_date, R(change) AS change, coalesce(len(h), 0) AS history_size, R(med) AS median, R(mad) AS mad, R(score) AS score FROM mad_scores
""")
def _(lake):
    rows = scored_changes(month_series(lake), ["region_code"], "value", revisions=revisions(lake))
    return rows.select("region_code", "observation_date", "change", F.size("history").alias("history_size"), "median", "mad", "score")


@query("rolling_mad_anomalies", """
SELECT region_code, observation_date, R(observed_value) AS observed_value, R(change) AS change, R(score) AS score, threshold, anomaly_type, "method", reason FROM anomaly_events
""")
def _(lake):
    return anomaly_events(lake)


TABLES["series_faults"] = """
SELECT region_code, observation_date, count(*) FILTER (NOT revised) AS copies, list(issue) AS planted, count(*) FILTER (revised) AS n_revised FROM (
  SELECT region_code, CASE WHEN region_code = 'N02' AND month(observation_date) = 5 THEN (observation_date + INTERVAL 1 DAY)::DATE ELSE observation_date END AS observation_date, false AS revised,
         CASE WHEN region_code = 'N03' AND year(observation_date) = 1997 THEN 'not_finite' WHEN region_code = 'N02' AND month(observation_date) = 5 THEN 'off_calendar' END AS issue FROM month_series
  UNION ALL SELECT region_code, observation_date, false, 'duplicate_date' FROM month_series WHERE region_code = 'N01' AND year(observation_date) = 1995
  UNION ALL SELECT DISTINCT region_code, DATE '1980-01-01', true, 'revision_outside_series' FROM month_series WHERE region_code IN ('N04', 'N05')
  UNION ALL SELECT DISTINCT region_code, DATE '1980-01-01', true, 'repeated_revision' FROM month_series WHERE region_code = 'N05')
GROUP BY 1, 2
"""
TABLES["series_issues"] = """
SELECT region_code, observation_date, copies, unnest(list_filter(planted, lambda x: x IS NOT NULL)) AS issue FROM series_faults
"""


def faulty_series(lake):
    """The monthly series and their revisions with faults planted in five countries: repeated months, shifted days, NaN, revisions before the series."""
    rows, at, region = month_series(lake), F.col("observation_date"), F.col("region_code")
    copies = F.when((region == "N01") & (F.year(at) == 1995), 2).otherwise(1)
    rows = rows.select(
        "region_code", F.when((region == "N02") & (F.month(at) == 5), F.date_add(at, 1)).otherwise(at).alias("observation_date"),
        F.when((region == "N03") & (F.year(at) == 1997), F.lit(float("nan"))).otherwise(F.col("value").cast("double")).alias("value"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")
    early = rows.where("region_code IN ('N04', 'N05')").select("region_code").distinct().select(
        "region_code", F.lit("1980-01-01").cast("date").alias("observation_date"), F.lit("rebased").alias("reason")
    )
    return rows, revisions(lake).unionByName(early).unionByName(early.where("region_code = 'N05'"))


@query("anomaly_input_issues", "SELECT region_code, observation_date, copies, issue FROM series_issues")
def _(lake):
    rows, noted = faulty_series(lake)
    return input_issues(rows, ["region_code"], "value", revisions=noted)


@query("rolling_mad_checked", """
SELECT region_code, observation_date, R(observed_value) AS observed_value, R(change) AS change, R(score) AS score, threshold, anomaly_type, "method", reason FROM anomaly_events
WHERE region_code NOT IN (SELECT region_code FROM series_issues)
UNION ALL SELECT region_code, observation_date, NULL, NULL, NULL, NULL, 'refused_input', 'input_check', issue FROM series_issues
""")
def _(lake):
    rows, noted = faulty_series(lake)
    return checked_anomalies(rows, ["region_code"], "value", revisions=noted)


@query("naive_lag_k", "SELECT region_code, model_name, observation_date, R(actual) AS actual, R(prediction) AS prediction FROM naive_pred")
def _(lake):
    rows = naive_predictions(month_series(lake), ["region_code"], "value", [1, 12], 24)
    return rows.select("region_code", "model_name", "observation_date", "actual", "prediction")


@query("time_holdout", """
SELECT region_code, max(CASE WHEN r > 24 THEN observation_date END) AS train_end, min(CASE WHEN r <= 24 THEN observation_date END) AS test_start,
       count(*) FILTER (r > 24) AS training_observations, count(*) FILTER (r <= 24) AS test_observations
FROM (SELECT *, row_number() OVER (PARTITION BY region_code ORDER BY observation_date DESC) AS r FROM month_series) GROUP BY 1
""")
def _(lake):
    return time_holdout(month_series(lake), ["region_code"], 24)


def time_holdout(frame, keys, test_periods):
    """Chronological split: the last rows of every series are the test part."""
    from_end = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("observation_date").desc()))
    rows = frame.withColumn("__test", from_end <= test_periods)
    test, date = F.col("__test"), F.col("observation_date")
    return rows.groupBy(*keys).agg(
        F.max(F.when(~test, date)).alias("train_end"), F.min(F.when(test, date)).alias("test_start"),
        F.count_if(~test).alias("training_observations"), F.count_if(test).alias("test_observations"),
    )


@query("latest_year_rows", """
SELECT indicator_code, region_code, observation_date, R(value) AS value FROM (SELECT *, max(observation_year) OVER (PARTITION BY indicator_code) AS y FROM stg_regional)
WHERE observation_year = y ORDER BY indicator_code, value DESC, region_code
""")
def _(lake):
    rows = settle(panels.staged(lake, "ledger_regional"))
    latest = rows.groupBy("indicator_code").agg(F.max("observation_year").alias("observation_year"))
    chosen = rows.join(latest, ["indicator_code", "observation_year"], "left_semi")
    return chosen.select("indicator_code", "region_code", "observation_date", "value").orderBy("indicator_code", F.col("value").desc(), "region_code")


@query("focus_latest_per_indicator", f"""
SELECT indicator_code, indicator_name, unit, I(observation_year) AS observation_year, R(value) AS value, R(group_average) AS group_average,
       R(difference_from_group_average) AS difference_from_group_average, country_coverage, value_rank_desc
FROM (SELECT *, row_number() OVER (PARTITION BY indicator_code ORDER BY observation_year DESC) AS rn FROM mart_group WHERE region_code = '{ref.FOCUS_REGION}') WHERE rn = 1
""")
def _(lake):
    rows = marts.group_comparison(panels.staged(lake, "ledger_annual", regions=[code for code, _ in ref.MEMBERS]), ref.members(lake.spark)).where(F.col("region_code") == ref.FOCUS_REGION)
    rows = rows.select("indicator_code", "indicator_name", "unit", "observation_year", "value", "group_average",
                       "difference_from_group_average", "country_coverage", "value_rank_desc")
    return latest_per_group(rows, ["indicator_code"], [-F.col("observation_year")])


PAGE_SQL = "SELECT *, {total} AS total_items, I(ceil({total} / {size}.0)) AS total_pages FROM ({body} ORDER BY {order} LIMIT {size} OFFSET {offset})"


def page_sql(body, order, number=1, size=20):
    return PAGE_SQL.format(body=body, order=order, size=size, offset=(number - 1) * size, total=f"(SELECT count(*) FROM ({body}))")


@query("page", page_sql("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'", "o_orderdate DESC, o_orderkey", 3, 20))
def _(lake):
    rows = lake.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderdate")
    return readers.page(rows, [F.col("o_orderdate").desc(), "o_orderkey"], 3, 20)


@query("latest_row", "SELECT o_orderkey, o_custkey, o_orderdate, R(o_totalprice) AS o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def _(lake):
    return lake.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(1)


_SERIES = [*marts.IDENTITY, *marts.WHEN]
PROFILED = {
    "group": ("mart_group", [*_SERIES, "member_since", "was_member_during_period", "value", "group_average", "difference_from_group_average", "country_coverage",
                             "value_rank_desc", "value_percentile", "ingested_at"]),
    "monetary": ("mart_monetary", ["region_code", *marts.WHEN, "observation_quarter", "observation_month", "policy_rate_percent", "policy_rate_change_pp", "exchange_rate",
                                   "exchange_rate_mom_change", "exchange_rate_mom_percent_change", "exchange_rate_rolling_3_month_average", "indicator_coverage", "ingested_at"]),
    "national": ("mart_overview_all", ["region_code", "region_name", *marts.WHEN, *marts.OVERVIEW_COLUMNS.values(), "indicator_coverage", "last_ingested_at"]),
    "regional": ("mart_regional", [*_SERIES, "value", "previous_observation_date", "previous_value", "yoy_absolute_change", "yoy_percent_change", "province_average",
                                   "difference_from_province_average", "province_coverage", "value_rank_desc", "value_percentile", "ingested_at"]),
    "trends": ("mart_trends", [*_SERIES, "value", "previous_observation_date", "previous_value", "next_observation_date", "next_value", "rolling_3_period_average",
                               "yoy_absolute_change", "yoy_percent_change", "ingested_at"]),
}


@query("top_missing", "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS dataset, '{c}' AS "column", count(*) - count({c}) AS missing_count, R(100 * (count(*) - count({c}))::DOUBLE / count(*)::DOUBLE) AS missing_percent FROM {table}"""
    for name, (table, columns) in PROFILED.items() for c in columns
) + """) ORDER BY missing_percent DESC, dataset, "column" LIMIT 20""")
def _(lake):
    """The 20 columns with most gaps, of all columns of all marts; one aggregate a mart."""
    annual = panels.staged(lake, "ledger_annual")
    frames = {
        "group": marts.group_comparison(annual, ref.members(lake.spark)), "monetary": marts.monetary_conditions(panels.staged(lake, "ledger_monthly")),
        "national": marts.national_overview(annual, None), "regional": marts.regional_analysis(panels.staged(lake, "ledger_regional")), "trends": marts.indicator_trends(annual),
    }
    parts = []
    for name, frame in frames.items():
        counts = frame.agg(F.count(F.lit(1)).alias("__all"), *(F.count(c).alias(c) for c in PROFILED[name][1]))
        cells = F.array(*(F.struct(F.lit(c).alias("column"), (F.col("__all") - F.col(c)).alias("missing_count")) for c in PROFILED[name][1]))
        parts.append(counts.select(F.lit(name).alias("dataset"), "__all", F.inline(cells)))
    rows = reduce(DataFrame.unionByName, parts)
    percent = F.round(100 * dbl("missing_count") / F.nullif(dbl("__all"), F.lit(0.0)), 6)
    rows = rows.select("dataset", "column", "missing_count", percent.alias("missing_percent"))
    return rows.orderBy(F.col("missing_percent").desc(), "dataset", "column").limit(20)


@query("strongest_pair", """
SELECT left_variable, right_variable, R(correlation) AS correlation, overlap FROM corr_pairs WHERE left_variable <> right_variable AND correlation IS NOT NULL
ORDER BY abs(correlation) DESC, left_variable, right_variable LIMIT 1
""")
def _(lake):
    pairs = stats.correlation_pairs(correlation_dataset(lake), SEVEN).where("left_variable <> right_variable AND correlation IS NOT NULL")
    return pairs.orderBy(F.abs("correlation").desc(), "left_variable", "right_variable").limit(1)


@query("peak_month", """
SELECT I(month(day)) AS calendar_month, count(*) AS observation_count, R(sum(rate)::DOUBLE / count(*)::DOUBLE) AS mean FROM daily GROUP BY 1 ORDER BY mean DESC, calendar_month LIMIT 1
""")
def _(lake):
    rows = monthly_seasonality(panels.daily_rates(lake).select("day", "rate"), "day", "rate")
    return rows.select("calendar_month", "observation_count", "mean").orderBy(F.col("mean").desc(), "calendar_month").limit(1)


@query("region_ranking", """
SELECT region_code, region_name, R(value) AS value, row_number() OVER (ORDER BY value DESC, region_code) AS position FROM (
  SELECT * FROM stg_regional WHERE indicator_code = 'R.1975.TV0.TP0' AND observation_date = (SELECT max(observation_date) FROM stg_regional))
""")
def _(lake):
    rows = settle(panels.staged(lake, "ledger_regional"))
    last = rows.agg(F.max("observation_date").alias("observation_date"))
    latest = settle(
        rows.where("indicator_code = 'R.1975.TV0.TP0'").join(F.broadcast(last), "observation_date", "left_semi")
        .select("region_code", "region_name", "value")
    )
    # Regions above, from the tallies of all values; regions of one value are numbered by code.
    tallies = running_tallies(latest, [], "value").select("value", (F.col("total") - F.col("upto")).alias("above"))
    among_equals = F.row_number().over(Window.partitionBy("value").orderBy("region_code"))
    return latest.join(tallies, "value").select("region_code", "region_name", "value", (F.col("above") + among_equals).alias("position"))


@query("literal_union", "SELECT region_code, member_since FROM d_member WHERE region_code IN (SELECT region_code FROM stg_annual)")
def _(lake):
    present = panels.staged(lake, "ledger_annual").select("region_code")
    return ref.members(lake.spark).join(present, "region_code", "left_semi")


@query("union_violations", """
SELECT o_orderkey, 'price_not_positive' AS violation FROM orders WHERE o_totalprice <= 1000
UNION ALL SELECT l_orderkey, 'shipped_before_order' FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate
UNION ALL SELECT o_orderkey, 'no_lines' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def _(lake):
    lines = lake.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    label = lambda f, name: f.select("o_orderkey", F.lit(name).alias("violation"))
    return (
        label(lake.orders.where("o_totalprice <= 1000"), "price_not_positive")
        .unionByName(label(lines.join(lake.orders, "o_orderkey").where("l_shipdate < o_orderdate"), "shipped_before_order"))
        .unionByName(label(lake.orders.join(lines, "o_orderkey", "left_anti"), "no_lines"))
    )


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(lake):
    return lake.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("required_set_check", """
SELECT observation_date, I(count(DISTINCT indicator_code) = 2) AS has_all, count(DISTINCT region_code) FILTER (indicator_code = 'M.POLICY') AS policy_regions,
       count(DISTINCT region_code) FILTER (indicator_code = 'M.RATE') AS rate_regions FROM stg_monthly GROUP BY 1
""")
def _(lake):
    rows = panels.staged(lake, "ledger_monthly")
    regions = lambda code: F.count_distinct(F.when(F.col("indicator_code") == code, F.col("region_code")))
    return rows.groupBy("observation_date").agg(
        (F.count_distinct("indicator_code") == 2).alias("has_all"), regions("M.POLICY").alias("policy_regions"), regions("M.RATE").alias("rate_regions")
    )


@query("metadata_scope_check", """
SELECT region_code, 'missing' AS status FROM (SELECT DISTINCT region_code FROM stg_monthly WHERE indicator_code = 'M.POLICY') WHERE region_code NOT IN (SELECT region_code FROM d_member)
""")
def _(lake):
    series = panels.staged(lake, "ledger_monthly").where("indicator_code = 'M.POLICY'")
    return set_difference(series, ref.members(lake.spark), "region_code")


@query("best_model", """
SELECT region_code, model_name, R(mae) AS mae FROM (SELECT *, row_number() OVER (PARTITION BY region_code ORDER BY mae, model_name) AS rn FROM naive_metrics) WHERE rn = 1
""")
def _(lake):
    metrics = stats.error_metrics(naive_predictions(month_series(lake), ["region_code"], "value", [1, 12], 24), ["region_code", "model_name"])
    return latest_per_group(metrics.select("region_code", "model_name", "mae"), ["region_code"], [F.col("mae"), F.col("model_name")])

