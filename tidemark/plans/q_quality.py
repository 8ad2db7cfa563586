"""Registered quality checks and their roll-up."""

import re

from pyspark.sql import functions as F

from tidemark.plans import quality_suite as suite
from tidemark.plans.oracle_tables import TABLES
from tidemark.plans.q_filters import RANGE_SQL
from tidemark.plans.q_windows import FAILURE_SQL
from tidemark.plans.registry import ORACLES, query


def grain_sql(table, keys):
    return f"SELECT {keys}, count(*) AS duplicate_count FROM {table} GROUP BY {keys} HAVING count(*) > 1"


def mandatory_sql(table, more):
    blanks = " OR ".join(f"{c} IS NULL OR trim({c}::VARCHAR) = ''" for c in suite.MANDATORY)
    return f"SELECT indicator_code, region_code, observation_date, source_code FROM {table} WHERE {blanks}{more}"


NATURAL = "indicator_code, region_code, source_code, observation_date"
SERIES = "indicator_code, region_code, observation_date"
GAPS = """
SELECT indicator_code, region_code, observation_date AS period_before_gap, n AS period_after_gap, date_sub('{unit}', observation_date, n) - {less} AS {name}
FROM (SELECT *, lead(observation_date) OVER (PARTITION BY indicator_code, region_code ORDER BY observation_date) AS n FROM {table}) WHERE date_sub('{unit}', observation_date, n) > 1
"""
SQL = {
    "check_duplicates": grain_sql("stg_all", NATURAL),
    "check_missing_mandatory_fields": mandatory_sql("stg_annual", ""),
    "check_value_ranges": RANGE_SQL.format(table="stg_annual"),
    "check_latest_run_failure": FAILURE_SQL,
    "check_stg_annual_grain": grain_sql("stg_annual", NATURAL),
    "check_stg_regional_grain": grain_sql("stg_regional", NATURAL),
    "check_stg_monthly_grain": grain_sql("stg_monthly", NATURAL),
    "check_regional_missing_mandatory_fields": mandatory_sql("stg_regional", " OR region_level <> 'province' OR parent_region_code IS NULL OR source_code <> 'ledger_regional'"),
    "check_regional_region_codes": "SELECT DISTINCT region_code, region_name, region_level, parent_region_code FROM stg_regional WHERE NOT regexp_full_match(region_code, '[0-9]{4}')",
    "check_regional_metadata_history": """
SELECT DISTINCT indicator_code, observation_date FROM stg_regional s WHERE indicator_code LIKE 'R.543%' AND observation_date > (SELECT max(observation_date) - INTERVAL 1 YEAR FROM stg_regional WHERE indicator_code LIKE 'R.543%')
""",
    "check_regional_value_ranges": RANGE_SQL.format(table="stg_regional"),
    "check_monthly_missing_mandatory_fields": mandatory_sql("stg_monthly", " OR frequency <> 'monthly' OR region_level <> 'country' OR day(observation_date) <> 1"),
    "check_monthly_value_ranges": RANGE_SQL.format(table="stg_monthly"),
    "check_monthly_coverage": """
SELECT region_code, observation_date, count(DISTINCT indicator_code) AS indicator_coverage FROM stg_monthly GROUP BY 1, 2
HAVING count(DISTINCT indicator_code) <> 2 OR count(*) FILTER (indicator_code = 'M.POLICY') <> 1 OR count(*) FILTER (indicator_code = 'M.RATE') <> 1
""",
    "check_mart_national_overview_grain": grain_sql("mart_overview_all", "region_code, observation_date"),
    "check_mart_indicator_trends_grain": grain_sql("mart_trends", SERIES),
    "check_mart_asean_comparison_grain": grain_sql("mart_group", SERIES),
    "check_mart_regional_analysis_grain": grain_sql("mart_regional", SERIES),
    "check_mart_monetary_conditions_grain": grain_sql("mart_monetary", "region_code, observation_date"),
    "check_forecast_integrity": """
SELECT run_key, forecast_date, 'forecast_bounds_invalid' AS violation FROM run_forecasts WHERE lower_bound > point_forecast OR point_forecast > upper_bound
UNION ALL SELECT run_key, NULL, 'passed_gate_wrong_horizon' FROM runs LEFT JOIN run_forecasts USING (run_key) WHERE quality_status = 'passed' GROUP BY run_key, forecast_horizon HAVING count(forecast_date) <> forecast_horizon
""",
    "check_anomaly_integrity": """
SELECT run_key, observation_date, anomaly_type, 'invalid_anomaly_event' AS violation FROM run_anomalies
WHERE trim(reason) = '' OR reason IS NULL OR (anomaly_type = 'missing_value' AND observed_value IS NOT NULL) OR (anomaly_type <> 'missing_value' AND observed_value IS NULL)
""",
    "check_data_freshness": """
SELECT source_code, max(ingested_at) AS last_ingested_at, max(observation_date) AS latest_observation_date, date_sub('hour', max(ingested_at), TIMESTAMP '2002-01-01') AS age_hours FROM stg_all GROUP BY 1
""",
    "check_missing_periods": GAPS.format(unit="year", table="stg_annual", less=1, name="missing_period_count"),
    "check_regional_missing_periods": GAPS.format(unit="year", table="stg_regional", less=1, name="missing_period_count"),
    "check_monthly_missing_periods": GAPS.format(unit="month", table="stg_monthly", less=0, name="period_gap"),
    "check_latest_forecast_run": "SELECT region_code, selected_model_name, baseline_model_name, quality_status, R(mae_improvement_percent) AS mae_improvement_percent, data_end, generated_at FROM runs",
}

for _name, _region in (("annual", "'N0{n}'"), ("regional", "'{n}'"), ("monthly", "'N0{n}'")):
    _at = {n: f"region_code = {_region.format(n=n)}" for n in (5, 6, 8)}
    _rows = f"SELECT * REPLACE (CASE WHEN {_at[6]} THEN ' ' ELSE unit END AS unit) FROM stg_{_name} WHERE NOT ({_at[8]} AND observation_year = 1998)"
    TABLES[f"faulty_{_name}"] = f"{_rows} UNION ALL SELECT * FROM ({_rows}) WHERE {_at[5]} AND observation_year % 2 = 0"
TABLES["faulty_all"] = "SELECT * FROM faulty_annual UNION ALL SELECT * FROM faulty_regional UNION ALL SELECT * FROM faulty_monthly"
for _name in ("overview_all", "trends", "group", "regional", "monetary"):
    TABLES[f"faulty_mart_{_name}"] = f"SELECT * FROM mart_{_name} UNION ALL SELECT * FROM mart_{_name} WHERE observation_year % 2 = 0"


def faulty(name: str) -> str:
    """The SQL of a check over the tables with faults."""
    if name == "check_forecast_integrity":
        return ORACLES["forecast_integrity"]
    if name == "check_anomaly_integrity":
        return ORACLES["anomaly_integrity"]
    if name == "check_regional_metadata_history":  # the metadata periods follow the faulty table, and end as before
        return SQL[name].replace("stg_regional", "faulty_regional")
    return re.sub(r"\bmart_(overview_all|trends|group|regional|monetary)\b", r"faulty_mart_\1", re.sub(r"\bstg_(annual|regional|monthly|all)\b", r"faulty_\1", SQL[name]))


# Each check alone runs over tables with faults; the suite and its roll-up run over the tables as they are.
for _check in suite.CHECKS:
    query(_check.name, faulty(_check.name))(lambda lake, check=_check: check.findings(suite.FaultyTables(lake)))

TABLES["suite_counts"] = " UNION ALL ".join(
    f"SELECT '{c.name}' AS name, {int(c.blocking)}::BIGINT AS blocking, count(*) AS finding_count FROM ({SQL[c.name]})" for c in suite.CHECKS
)


@query("quality_suite", """
SELECT name, blocking, finding_count, CASE WHEN blocking = 0 THEN 'info' WHEN finding_count > 0 THEN 'failed' ELSE 'passed' END AS status FROM suite_counts
""")
def _(lake):
    return suite.with_status(suite.quality_suite(lake))


@query("quality_rollup", """
SELECT CASE WHEN blocking_failures > 0 THEN 'degraded' ELSE 'healthy' END AS status, I(blocking_failures) AS blocking_failures, I(informational_findings) AS informational_findings, passed_checks, blocking_checks
FROM (SELECT coalesce(sum(finding_count) FILTER (blocking = 1), 0) AS blocking_failures, coalesce(sum(finding_count) FILTER (blocking = 0), 0) AS informational_findings,
  count(*) FILTER (blocking = 1 AND finding_count = 0) AS passed_checks, count(*) FILTER (blocking = 1) AS blocking_checks FROM suite_counts)
""")
def _(lake):
    return suite.rollup(suite.quality_suite(lake))


@query("data_quality_page", """
SELECT name, blocking, finding_count, CASE WHEN blocking = 0 THEN 'info' WHEN finding_count > 0 THEN 'failed' ELSE 'passed' END AS status FROM suite_counts ORDER BY blocking DESC, name
""")
def _(lake):
    return suite.with_status(suite.quality_suite(lake)).orderBy(F.col("blocking").desc(), "name")
