"""Marts and the star join under them."""

from pyspark.sql import functions as F

from tidemark.plans import marts, panels
from tidemark.plans.oracle_tables import TABLES
from tidemark.plans.registry import query
from tidemark.sources import reference_tables as ref

STG_SQL = """
SELECT indicator_code, indicator_name, unit, frequency, region_code, region_name, region_level, parent_region_code,
       source_code, source_name, observation_date, I(observation_year) AS observation_year,
       I(observation_quarter) AS observation_quarter, I(observation_month) AS observation_month, R(value) AS value, ingested_at
FROM {table}
"""


@query("stage_star_join", STG_SQL.format(table="stg_annual"))
def _(lake):
    return panels.staged(lake, "ledger_annual")


@query("stage_star_join_regional", STG_SQL.format(table="stg_regional"))
def _(lake):
    return panels.staged(lake, "ledger_regional")


@query("stage_star_join_monthly", STG_SQL.format(table="stg_monthly"))
def _(lake):
    return panels.staged(lake, "ledger_monthly")


@query("scan_star", "SELECT source_code, indicator_code, region_level, count(*) AS observation_count, R(sum(value)) AS value_sum FROM stg_all GROUP BY ALL")
def _(lake):
    rows = panels.star_join(panels.facts(lake), panels.regions(lake))
    return rows.groupBy("source_code", "indicator_code", "region_level").agg(
        F.count(F.lit(1)).alias("observation_count"), F.sum("value").alias("value_sum")
    )


TABLES["mart_overview_all"] = """
SELECT region_code, region_name, observation_date, observation_year,
       max(value) FILTER (indicator_code = 'A.ORDERS') AS orders, max(value) FILTER (indicator_code = 'A.REVENUE') AS revenue,
       max(value) FILTER (indicator_code = 'A.DISCOUNT') AS discount_percent, max(value) FILTER (indicator_code = 'A.CUSTOMERS') AS customers,
       max(value) FILTER (indicator_code = 'A.QUANTITY') AS quantity, count(DISTINCT indicator_code) AS indicator_coverage, max(ingested_at) AS last_ingested_at
FROM stg_annual WHERE region_level = 'country' GROUP BY ALL
"""
TABLES["mart_overview"] = f"SELECT * FROM mart_overview_all WHERE region_code = '{ref.FOCUS_REGION}'"
OVERVIEW_SQL = """
SELECT region_code, region_name, observation_date, I(observation_year) AS observation_year, R(orders) AS orders, R(revenue) AS revenue,
       R(discount_percent) AS discount_percent, R(customers) AS customers, R(quantity) AS quantity, indicator_coverage, last_ingested_at
FROM mart_overview
"""


@query("mart_national_overview", OVERVIEW_SQL)
def _(lake):
    return marts.national_overview(panels.staged(lake, "ledger_annual", regions=[ref.FOCUS_REGION]))


@query("conditional_pivot", OVERVIEW_SQL.replace("FROM mart_overview", "FROM mart_overview_all"))
def _(lake):
    return marts.national_overview(panels.staged(lake, "ledger_annual"), region_code=None)


TABLES["mart_trends"] = """
SELECT *, CASE WHEN frequency = 'annual' AND date_sub('year', previous_observation_date, observation_date) = 1
               THEN value - previous_value END AS yoy_absolute_change,
       CASE WHEN frequency = 'annual' AND date_sub('year', previous_observation_date, observation_date) = 1
            THEN 100 * (value - previous_value)::DOUBLE / nullif(abs(previous_value)::DOUBLE, 0) END AS yoy_percent_change
FROM (SELECT *, lag(observation_date) OVER w AS previous_observation_date, lag(value) OVER w AS previous_value,
             lead(observation_date) OVER w AS next_observation_date, lead(value) OVER w AS next_value,
             sum(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE
               / count(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE AS rolling_3_period_average
      FROM stg_annual WINDOW w AS (PARTITION BY indicator_code, region_code ORDER BY observation_date))
"""


@query("mart_indicator_trends", """
SELECT indicator_code, indicator_name, unit, frequency, region_code, region_name, observation_date, I(observation_year) AS observation_year,
       R(value) AS value, previous_observation_date, R(previous_value) AS previous_value, next_observation_date, R(next_value) AS next_value,
       R(rolling_3_period_average) AS rolling_3_period_average, R(yoy_absolute_change) AS yoy_absolute_change,
       R(yoy_percent_change) AS yoy_percent_change, ingested_at
FROM mart_trends
""")
def _(lake):
    return marts.indicator_trends(panels.staged(lake, "ledger_annual"))


TABLES["mart_group"] = """
SELECT g.*, value::DOUBLE - group_average AS difference_from_group_average FROM (
SELECT s.*, m.member_since, CASE WHEN observation_date >= member_since THEN 1 ELSE 0 END AS was_member_during_period,
       sum(value) OVER g::DOUBLE / count(value) OVER g::DOUBLE AS group_average, count(*) OVER g AS country_coverage,
       rank() OVER (g ORDER BY value DESC) AS value_rank_desc, percent_rank() OVER (g ORDER BY value) AS value_percentile
FROM stg_annual s JOIN d_member m USING (region_code) WINDOW g AS (PARTITION BY indicator_code, observation_date)) g
"""


@query("mart_asean_comparison", """
SELECT indicator_code, indicator_name, unit, frequency, region_code, region_name, member_since,
       I(was_member_during_period) AS was_member_during_period, observation_date, I(observation_year) AS observation_year, R(value) AS value,
       R(group_average) AS group_average, R(difference_from_group_average) AS difference_from_group_average,
       country_coverage, value_rank_desc, R(value_percentile) AS value_percentile, ingested_at
FROM mart_group
""")
def _(lake):
    return marts.group_comparison(panels.staged(lake, "ledger_annual", regions=[code for code, _ in ref.MEMBERS]), ref.members(lake.spark))


TABLES["mart_regional"] = """
SELECT *, value::DOUBLE - province_average AS difference_from_province_average, CASE WHEN date_sub('year', previous_observation_date, observation_date) = 1 THEN value - previous_value END AS yoy_absolute_change,
       CASE WHEN date_sub('year', previous_observation_date, observation_date) = 1
            THEN 100 * (value - previous_value)::DOUBLE / nullif(abs(previous_value)::DOUBLE, 0) END AS yoy_percent_change
FROM (SELECT *, lag(observation_date) OVER w AS previous_observation_date, lag(value) OVER w AS previous_value,
             sum(value) OVER g::DOUBLE / count(value) OVER g::DOUBLE AS province_average, count(*) OVER g AS province_coverage,
             rank() OVER (g ORDER BY value DESC) AS value_rank_desc, percent_rank() OVER (g ORDER BY value) AS value_percentile
      FROM stg_regional WINDOW w AS (PARTITION BY indicator_code, region_code ORDER BY observation_date),
                              g AS (PARTITION BY indicator_code, observation_date))
"""


@query("mart_regional_analysis", """
SELECT indicator_code, indicator_name, unit, frequency, region_code, region_name, observation_date, I(observation_year) AS observation_year,
       R(value) AS value, previous_observation_date, R(previous_value) AS previous_value, R(yoy_absolute_change) AS yoy_absolute_change,
       R(yoy_percent_change) AS yoy_percent_change, R(province_average) AS province_average,
       R(value::DOUBLE - province_average) AS difference_from_province_average, province_coverage, value_rank_desc,
       R(value_percentile) AS value_percentile, ingested_at
FROM mart_regional
""")
def _(lake):
    return marts.regional_analysis(panels.staged(lake, "ledger_regional"))


TABLES["mart_monetary"] = """
SELECT *, policy_rate_percent - lag(policy_rate_percent) OVER w AS policy_rate_change_pp,
       exchange_rate - lag(exchange_rate) OVER w AS exchange_rate_mom_change,
       100 * (exchange_rate - lag(exchange_rate) OVER w)::DOUBLE / nullif(abs(lag(exchange_rate) OVER w)::DOUBLE, 0) AS exchange_rate_mom_percent_change,
       sum(exchange_rate) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE
         / nullif(count(exchange_rate) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE, 0) AS exchange_rate_rolling_3_month_average
FROM (SELECT region_code, observation_date, observation_year, observation_quarter, observation_month,
             max(value) FILTER (indicator_code = 'M.POLICY') AS policy_rate_percent, max(value) FILTER (indicator_code = 'M.RATE') AS exchange_rate,
             count(DISTINCT indicator_code) AS indicator_coverage, max(ingested_at) AS ingested_at
      FROM stg_monthly WHERE frequency = 'monthly' GROUP BY ALL)
WINDOW w AS (PARTITION BY region_code ORDER BY observation_date)
"""
MONETARY_SQL = """
SELECT region_code, observation_date, I(observation_year) AS observation_year, I(observation_quarter) AS observation_quarter,
       I(observation_month) AS observation_month, R(policy_rate_percent) AS policy_rate_percent, R(policy_rate_change_pp) AS policy_rate_change_pp,
       R(exchange_rate) AS exchange_rate, R(exchange_rate_mom_change) AS exchange_rate_mom_change,
       R(exchange_rate_mom_percent_change) AS exchange_rate_mom_percent_change,
       R(exchange_rate_rolling_3_month_average) AS exchange_rate_rolling_3_month_average, indicator_coverage, ingested_at
FROM mart_monetary
"""


@query("mart_monetary_conditions", MONETARY_SQL)
def _(lake):
    return marts.monetary_conditions(panels.staged(lake, "ledger_monthly"))


@query("economic_growth", """
SELECT region_name, observation_date, R(value) AS growth_percent, R(lag(value) OVER w) AS previous_period,
       R(value - lag(value) OVER w) AS percentage_point_change
FROM stg_annual WHERE indicator_code = 'A.DISCOUNT' WINDOW w AS (PARTITION BY indicator_code, region_code ORDER BY observation_date)
ORDER BY region_name, observation_date
""")
def _(lake):
    return marts.economic_growth(panels.staged(lake, "ledger_annual", indicators=["A.DISCOUNT"]), "A.DISCOUNT").orderBy("region_name", "observation_date")
