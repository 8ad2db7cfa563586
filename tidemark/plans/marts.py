"""Marts: staged observations to analysis tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl, safe_percent_change
from tidemark.operators.order_stats import cross_section
from tidemark.operators.windows import consecutive, neighbours, rolling_mean
from tidemark.schema import SERIES_KEY
from tidemark.session import settle
from tidemark.sources import reference_tables as ref

IDENTITY = ["indicator_code", "indicator_name", "unit", "frequency", "region_code", "region_name"]
WHEN = ["observation_date", "observation_year"]
OVERVIEW_COLUMNS = {
    "A.ORDERS": "orders", "A.REVENUE": "revenue", "A.DISCOUNT": "discount_percent",
    "A.CUSTOMERS": "customers", "A.QUANTITY": "quantity",
}
MONETARY_COLUMNS = {"M.POLICY": "policy_rate_percent", "M.RATE": "exchange_rate"}


def _pivot(staged: DataFrame, keys: list[str], columns: dict[str, str], ingested: str) -> DataFrame:
    """One row per key with a column per listed indicator, the coverage and the latest ingest."""
    cells = [F.max(F.when(F.col("indicator_code") == code, F.col("value"))).alias(name) for code, name in columns.items()]
    return staged.groupBy(*keys).agg(
        *cells, F.count_distinct("indicator_code").alias("indicator_coverage"), F.max("ingested_at").alias(ingested)
    )


def national_overview(staged: DataFrame, region_code: str | None = ref.FOCUS_REGION) -> DataFrame:
    """Region × date with one column per headline indicator; one region, or all of them."""
    rows = staged.where(F.col("region_level") == "country")
    if region_code:
        rows = rows.where(F.col("region_code") == region_code)
    return _pivot(rows, ["region_code", "region_name", *WHEN], OVERVIEW_COLUMNS, "last_ingested_at")


def indicator_trends(staged: DataFrame) -> DataFrame:
    """Series × date with neighbours, rolling mean and guarded year-over-year changes."""
    rows = neighbours(staged, SERIES_KEY, {"observation_date": "observation_date", "value": "value"})
    rows = rows.withColumn("rolling_3_period_average", rolling_mean("value", SERIES_KEY))
    guard = (F.col("frequency") == "annual") & consecutive("previous_observation_date", "observation_date")
    return rows.select(
        *IDENTITY, *WHEN, "value", "previous_observation_date", "previous_value", "next_observation_date",
        "next_value", "rolling_3_period_average",
        F.when(guard, F.col("value") - F.col("previous_value")).alias("yoy_absolute_change"),
        F.when(guard, safe_percent_change(F.col("value"), F.col("previous_value"))).alias("yoy_percent_change"),
        "ingested_at",
    )


def group_comparison(staged: DataFrame, members: DataFrame) -> DataFrame:
    """Members only, each against the group of its indicator and date.

    The member list is a fixed table, so every (indicator, date) group is at most that long
    and plain windows over one shared partitioning are enough.
    """
    group = Window.partitionBy("indicator_code", "observation_date")
    ordered = group.orderBy("value")
    rows = staged.join(members, "region_code").withColumns({
        "group_average": dbl(F.sum("value").over(group)) / dbl(F.count("value").over(group)),
        "country_coverage": F.count(F.lit(1)).over(group),
        "value_rank_desc": F.rank().over(group.orderBy(F.col("value").desc())),
        "value_percentile": F.percent_rank().over(ordered),
    })
    return rows.select(
        *IDENTITY, "member_since",
        F.when(F.col("observation_date") >= F.col("member_since"), 1).otherwise(0).alias("was_member_during_period"),
        *WHEN, "value", "group_average", (dbl("value") - F.col("group_average")).alias("difference_from_group_average"),
        "country_coverage", "value_rank_desc", "value_percentile", "ingested_at",
    )


def regional_analysis(staged: DataFrame, slices: int | None = None) -> DataFrame:
    """Provinces: year-over-year change per series, mean and rank per indicator and date.

    The number of provinces per date is unbounded, so ranks come from running tallies, not
    from a window over the whole cross-section.
    """
    rows = settle(staged)
    options = {} if slices is None else {"slices": slices}
    ranked = cross_section(rows, ["indicator_code", "observation_date"], "value", **options)
    changed = neighbours(ranked, SERIES_KEY, {"observation_date": "observation_date", "value": "value"}, following=False)
    guard = consecutive("previous_observation_date", "observation_date")
    return changed.select(
        *IDENTITY, *WHEN, "value", "previous_observation_date", "previous_value",
        F.when(guard, F.col("value") - F.col("previous_value")).alias("yoy_absolute_change"),
        F.when(guard, safe_percent_change(F.col("value"), F.col("previous_value"))).alias("yoy_percent_change"),
        F.col("group_mean").alias("province_average"),
        (dbl("value") - F.col("group_mean")).alias("difference_from_province_average"),
        F.col("group_count").alias("province_coverage"), F.col("rank_desc").alias("value_rank_desc"),
        F.col("percent_rank").alias("value_percentile"), "ingested_at",
    )


def monetary_conditions(staged: DataFrame) -> DataFrame:
    """Region × month with both monthly indicators and their month-over-month changes."""
    rows = staged.where((F.col("frequency") == "monthly") & F.col("indicator_code").isin(list(MONETARY_COLUMNS)))
    keys = ["region_code", *WHEN, "observation_quarter", "observation_month"]
    months = _pivot(rows, keys, MONETARY_COLUMNS, "ingested_at")
    months = neighbours(months, ["region_code"], {c: c for c in MONETARY_COLUMNS.values()}, following=False)
    months = months.withColumn("exchange_rate_rolling_3_month_average", rolling_mean("exchange_rate", ["region_code"]))
    return months.select(
        *keys, "policy_rate_percent",
        (F.col("policy_rate_percent") - F.col("previous_policy_rate_percent")).alias("policy_rate_change_pp"),
        "exchange_rate", (F.col("exchange_rate") - F.col("previous_exchange_rate")).alias("exchange_rate_mom_change"),
        safe_percent_change(F.col("exchange_rate"), F.col("previous_exchange_rate")).alias("exchange_rate_mom_percent_change"),
        "exchange_rate_rolling_3_month_average", "indicator_coverage", "ingested_at",
    )


def economic_growth(staged: DataFrame, indicator_code: str) -> DataFrame:
    """Value, previous value and point change of one indicator for every region."""
    rows = neighbours(staged.where(F.col("indicator_code") == indicator_code), SERIES_KEY, {"value": "period"}, following=False)
    return rows.select(
        "region_name", "observation_date", F.col("value").alias("growth_percent"), "previous_period",
        (F.col("value") - F.col("previous_period")).alias("percentage_point_change"),
    )
