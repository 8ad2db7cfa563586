"""The quality suite: 21 blocking and 5 informational checks over staged tables, marts and runs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ops, rules
from tidemark.operators.windows import gaps
from tidemark.plans import marts, panels
from tidemark.plans.q_models import anomaly_findings, broken_anomalies, broken_forecasts, integrity_findings, latest_runs, run_tables
from tidemark.plans.q_windows import run_table
from tidemark.schema import NATURAL_KEY, SERIES_KEY
from tidemark.session import settle
from tidemark.sources import reference_tables as ref
from tidemark.sources.lake import Lake

MANDATORY = ["indicator_code", "indicator_name", "unit", "frequency", "region_code", "region_name", "observation_date", "value", "source_code", "ingested_at"]
MONTHLY_CODES = ["M.POLICY", "M.RATE"]


class Tables:
    """The tables the checks read. Each is derived once and written to the shared folder."""

    def __init__(self, lake: Lake):
        self.lake = lake

    @cached_property
    def annual(self) -> DataFrame:
        return settle(panels.staged(self.lake, "ledger_annual"))

    @cached_property
    def regional(self) -> DataFrame:
        return settle(panels.staged(self.lake, "ledger_regional"))

    @cached_property
    def monthly(self) -> DataFrame:
        return settle(panels.staged(self.lake, "ledger_monthly"))

    @cached_property
    def everything(self) -> DataFrame:
        return self.annual.unionByName(self.regional).unionByName(self.monthly)

    @cached_property
    def history(self) -> DataFrame:
        """Metadata periods: one span per series, which for the tax series ends a year early."""
        last = F.when(F.col("indicator_code") == "R.543.TV0.TP0", F.add_months(F.max("observation_date"), -12)).otherwise(F.max("observation_date"))
        return self.regional.groupBy("indicator_code", "source_code").agg(
            F.min("observation_date").alias("period_start"), last.alias("period_end")
        )

    @cached_property
    def runs(self):
        return run_tables(self.lake)

    def mart(self, name: str) -> DataFrame:
        return {
            "national_overview": lambda: marts.national_overview(self.annual, None), "indicator_trends": lambda: marts.indicator_trends(self.annual),
            "asean_comparison": lambda: marts.group_comparison(self.annual, ref.members(self.lake.spark)),
            "regional_analysis": lambda: marts.regional_analysis(self.regional), "monetary_conditions": lambda: marts.monetary_conditions(self.monthly),
        }[name]()


class FaultyTables(Tables):
    """The same tables with faults put in by rule, so that each check alone has something to find.

    Region 5 (N05, or supplier 5) is there twice in even years, region 6 has a blank unit, and region 8 lacks 1998.
    Marts have their rows of even years twice; runs have the broken forecasts and anomalies of the integrity queries.
    """

    def _faulty(self, rows: DataFrame) -> DataFrame:
        region = lambda n: F.col("region_code").isin(f"N{n:02d}", str(n))
        rows = rows.where(~(region(8) & (F.col("observation_year") == 1998)))
        rows = rows.withColumn("unit", F.when(region(6), " ").otherwise(F.col("unit")))
        return settle(rows.unionByName(rows.where(region(5) & (F.col("observation_year") % 2 == 0))))

    @cached_property
    def annual(self) -> DataFrame:
        return self._faulty(panels.staged(self.lake, "ledger_annual"))

    @cached_property
    def regional(self) -> DataFrame:
        return self._faulty(panels.staged(self.lake, "ledger_regional"))

    @cached_property
    def monthly(self) -> DataFrame:
        return self._faulty(panels.staged(self.lake, "ledger_monthly"))

    @cached_property
    def runs(self):
        runs, forecasts, anomalies, *rest = run_tables(self.lake)
        return runs, broken_forecasts(forecasts), broken_anomalies(anomalies), *rest

    def mart(self, name: str) -> DataFrame:
        rows = settle(Tables(self.lake).mart(name))
        return rows.unionByName(rows.where(F.col("observation_year") % 2 == 0))


@dataclass(frozen=True)
class Check:
    name: str
    blocking: bool
    findings: object


def _grain(table, keys):
    return lambda t: rules.duplicate_keys(table(t), keys)


def _mandatory(table, expected, extra=()):
    return lambda t: rules.missing_mandatory(table(t), MANDATORY, expected, list(extra()) if callable(extra) else list(extra)).select(
        "indicator_code", "region_code", "observation_date", "source_code"
    )


def _ranges(table):
    return lambda t: rules.out_of_range(table(t), ref.value_rules(t.lake.spark)).select(
        "indicator_code", "region_code", "observation_date", "value", "violated_rule"
    )


def _monthly_coverage(t):
    one = lambda code: F.count_if(F.col("indicator_code") == code)
    rows = t.monthly.groupBy("region_code", "observation_date").agg(
        F.count_distinct("indicator_code").alias("indicator_coverage"), *(one(c).alias(f"n{i}") for i, c in enumerate(MONTHLY_CODES))
    )
    return rows.where("indicator_coverage <> 2 OR n0 <> 1 OR n1 <> 1").select("region_code", "observation_date", "indicator_coverage")


def _region_codes(t):
    countries = t.lake.nation.select(panels.country_code("n_nationkey").alias("parent_region_code"), F.lit(True).alias("known"))
    rows = t.regional.join(countries, "parent_region_code", "left")
    return rules.bad_codes(rows, "^[0-9]{4}$", "province", F.col("known"))


def _latest_runs(t):
    return latest_runs(t.runs[0]).drop("run_key")


annual, regional, monthly, everything = (lambda t: t.annual), (lambda t: t.regional), (lambda t: t.monthly), (lambda t: t.everything)
SERIES_DATE = [*SERIES_KEY, "observation_date"]

CHECKS = [
    Check("check_duplicates", True, _grain(everything, NATURAL_KEY)),
    Check("check_missing_mandatory_fields", True, _mandatory(annual, {})),
    Check("check_value_ranges", True, _ranges(annual)),
    Check("check_latest_run_failure", True, lambda t: ops.latest_failures(run_table(t.lake))),
    Check("check_stg_annual_grain", True, _grain(annual, NATURAL_KEY)),
    Check("check_stg_regional_grain", True, _grain(regional, NATURAL_KEY)),
    Check("check_stg_monthly_grain", True, _grain(monthly, NATURAL_KEY)),
    Check("check_regional_missing_mandatory_fields", True, _mandatory(regional, {"region_level": "province", "source_code": "ledger_regional"},
                                                                    lambda: [F.col("parent_region_code").isNull()])),
    Check("check_regional_region_codes", True, _region_codes),
    Check("check_regional_metadata_history", True, lambda t: rules.uncovered(t.regional, t.history, ["indicator_code", "source_code"]).drop("source_code")),
    Check("check_regional_value_ranges", True, _ranges(regional)),
    Check("check_monthly_missing_mandatory_fields", True, _mandatory(monthly, {"frequency": "monthly", "region_level": "country"},
                                                                   lambda: [F.day("observation_date") != 1])),
    Check("check_monthly_value_ranges", True, _ranges(monthly)),
    Check("check_monthly_coverage", True, _monthly_coverage),
    Check("check_mart_national_overview_grain", True, _grain(lambda t: t.mart("national_overview"), ["region_code", "observation_date"])),
    Check("check_mart_indicator_trends_grain", True, _grain(lambda t: t.mart("indicator_trends"), SERIES_DATE)),
    Check("check_mart_asean_comparison_grain", True, _grain(lambda t: t.mart("asean_comparison"), SERIES_DATE)),
    Check("check_mart_regional_analysis_grain", True, _grain(lambda t: t.mart("regional_analysis"), SERIES_DATE)),
    Check("check_mart_monetary_conditions_grain", True, _grain(lambda t: t.mart("monetary_conditions"), ["region_code", "observation_date"])),
    Check("check_forecast_integrity", True, lambda t: integrity_findings(*t.runs[:2])),
    Check("check_anomaly_integrity", True, lambda t: anomaly_findings(t.runs[2])),
    Check("check_data_freshness", False, lambda t: ops.source_freshness(t.everything, F.lit("2002-01-01").cast("timestamp_ntz"))),
    Check("check_missing_periods", False, lambda t: gaps(t.annual.where("frequency = 'annual'"), SERIES_KEY, "YEAR").drop("period_gap")),
    Check("check_regional_missing_periods", False, lambda t: gaps(t.regional, SERIES_KEY, "YEAR").drop("period_gap")),
    Check("check_monthly_missing_periods", False, lambda t: gaps(t.monthly, SERIES_KEY, "MONTH").drop("missing_period_count")),
    Check("check_latest_forecast_run", False, _latest_runs),
]


def quality_suite(lake: Lake) -> DataFrame:
    """(name, blocking, finding_count) of every check, as one union of counts."""
    tables, result = Tables(lake), None
    for check in CHECKS:
        part = check.findings(tables).agg(
            F.lit(check.name).alias("name"), F.lit(check.blocking).alias("blocking"), F.count(F.lit(1)).alias("finding_count")
        )
        result = part if result is None else result.unionByName(part)
    return result


def with_status(suite: DataFrame) -> DataFrame:
    failed = F.when(F.col("finding_count") > 0, "failed").otherwise("passed")
    return suite.withColumn("status", F.when(F.col("blocking"), failed).otherwise("info"))


def rollup(suite: DataFrame) -> DataFrame:
    """One row: overall status, findings by class, and the share of blocking checks passed."""
    blocking, n = F.col("blocking"), F.col("finding_count")
    totals = suite.agg(
        F.sum(F.when(blocking, n).otherwise(0)).alias("blocking_failures"), F.sum(F.when(~blocking, n).otherwise(0)).alias("informational_findings"),
        F.count_if(blocking & (n == 0)).alias("passed_checks"), F.count_if(blocking).alias("blocking_checks"),
    )
    return totals.withColumn("status", F.when(F.col("blocking_failures") > 0, "degraded").otherwise("healthy"))
