"""Small fixed tables. Each is a literal relation, so its size is known to the optimizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Indicator catalog (id, code, name, unit, frequency).
INDICATORS = [
    (1, "A.ORDERS", "Orders placed", "orders", "annual"),
    (2, "A.REVENUE", "Order value", "current USD", "annual"),
    (3, "A.DISCOUNT", "Mean line discount", "percent", "annual"),
    (4, "A.CUSTOMERS", "Buying customers", "people", "annual"),
    (5, "A.QUANTITY", "Units ordered", "units", "annual"),
    (6, "R.543.TV0.TP0", "Mean line tax", "percent", "annual"),
    (7, "R.1975.TV0.TP0", "Units shipped", "units", "annual"),
    (8, "M.POLICY", "Decision rate at month end", "percent", "monthly"),
    (9, "M.RATE", "Mean daily order value", "IDR per USD", "monthly"),
]
INDICATOR_COLUMNS = "indicator_id int, indicator_code string, indicator_name string, unit string, frequency string"

# The three publishers (id, code, name, url).
SOURCES = [
    (1, "ledger_annual", "Annual country ledger", "https://example.org/annual"),
    (2, "ledger_regional", "Annual supplier ledger", "https://example.org/regional"),
    (3, "ledger_monthly", "Monthly country ledger", "https://example.org/monthly"),
]
SOURCE_COLUMNS = "source_id int, source_code string, source_name string, source_url string"
SOURCE_IDS = {code: source_id for source_id, code, _, _ in SOURCES}

FOCUS_REGION = "N07"

# Members of the comparison group and the day each joined.
MEMBERS = [
    ("N01", "1967-08-08"), ("N03", "1967-08-08"), ("N05", "1984-01-07"), ("N07", "1967-08-08"),
    ("N09", "1995-07-28"), ("N11", "1997-07-23"), ("N13", "1997-07-23"), ("N15", "1999-04-30"),
    ("N17", "1967-08-08"), ("N19", "1967-08-08"), ("N21", "2025-10-26"),
]
MEMBER_COLUMNS = "region_code string, member_since string"

# Value rules (id, source, code pattern, low, high, low open, rule text).
VALUE_RULES = [
    (1, "ledger_annual", r"^A\.DISCOUNT$", 0.0, 5.0, False, "expected 0..5 percent"),
    (2, "ledger_annual", r"^A\.ORDERS$", 0.0, None, True, "expected value above zero"),
    (3, "ledger_annual", r"^A\.CUSTOMERS$", 40.0, None, False, "expected at least 40"),
    (4, "ledger_annual", r"^A\.REVENUE$", 0.0, None, False, "expected non-negative value"),
    (5, "ledger_regional", r"^R[.]543[.]", 0.0, 4.2, False, "expected 0..4.2 percent"),
    (6, "ledger_regional", r"^R[.]1975[.]", 0.0, None, True, "expected value above zero"),
    (7, "ledger_monthly", r"^M\.POLICY$", 0.0, 45.0, False, "expected 0..45 percent"),
    (8, "ledger_monthly", r"^M\.RATE$", 1.0, 1000000.0, False, "expected 1..1000000"),
]
RULE_COLUMNS = "rule_id int, source_code string, pattern string, low double, high double, low_open boolean, violated_rule string"

# Per source, limits for age and lag, cadence and run-after month and day.
SCHEDULES = [
    ("click", "annual", 7, 15, 48, 1),
    ("error", "monthly", None, 5, 20, 60),
    ("purchase", "monthly", None, 5, 48, 60),
    ("signup", "annual", 1, 20, 9000, 730),
    ("view", "monthly", None, 28, 1080, 75),
    ("refund", "annual", 11, 15, 9000, 730),
]
SCHEDULE_COLUMNS = (
    "source_code string, frequency string, run_after_month int, run_after_day int, "
    "max_ingestion_age_hours int, max_observation_lag_days int"
)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return f"{value}D" if isinstance(value, float) else str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    names = [part.split()[0] for part in columns.split(",")]
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    raw = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return raw.selectExpr(*(f"CAST({n} AS {t}) AS {n}" for n, t in (p.split() for p in columns.split(","))))


def indicators(spark: SparkSession) -> DataFrame:
    return literal_table(spark, INDICATORS, INDICATOR_COLUMNS)


def sources(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SOURCES, SOURCE_COLUMNS)


def members(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MEMBERS, MEMBER_COLUMNS).selectExpr(
        "region_code", "CAST(member_since AS DATE) AS member_since"
    )


def value_rules(spark: SparkSession) -> DataFrame:
    return literal_table(spark, VALUE_RULES, RULE_COLUMNS)


def schedules(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SCHEDULES, SCHEDULE_COLUMNS)


def date_dimension(dates: DataFrame, date: str = "full_date") -> DataFrame:
    """One row for each date that occurs, whatever its year."""
    return dates.where(F.col(date).isNotNull()).select(F.col(date).alias("full_date")).distinct().selectExpr(
        "CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INT) AS date_id",
        "full_date", "year(full_date) AS year", "quarter(full_date) AS quarter", "month(full_date) AS month",
    )
