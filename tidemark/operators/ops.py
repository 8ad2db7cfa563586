"""Operations data: run ledger, freshness findings, alerts, schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import local_date, whole_units
from tidemark.functions.text import key_hash


def run_states(events: DataFrame) -> DataFrame:
    """Current state per run from append-only (run_id, source_code, status, at, rows, message).

    Only a started run can finish, and its first finishing event from then on counts.
    """
    starts = events.where("status = 'running'").groupBy("run_id", "source_code").agg(F.min("at").alias("started_at"))
    finishes = (
        events.where("status <> 'running'").join(starts, ["run_id", "source_code"]).where("at >= started_at")
        .groupBy("run_id", "source_code").agg(F.min(F.struct("at", "status", "rows_loaded", "error_message")).alias("f"))
    )
    return starts.join(finishes, ["run_id", "source_code"], "left").select(
        "run_id", "source_code", "started_at", F.col("f.at").alias("completed_at"),
        F.coalesce("f.status", F.lit("running")).alias("status"), "f.rows_loaded", "f.error_message",
    )


def latest_failures(runs: DataFrame) -> DataFrame:
    """The latest run of every source, where that run failed."""
    rest = [c for c in runs.columns if c != "source_code"]
    latest = runs.groupBy("source_code").agg(F.max_by(F.struct(*rest), F.struct("started_at", "run_id")).alias("r"))
    return latest.where(F.col("r.status") == "failed").select("source_code", *(F.col(f"r.{c}").alias(c) for c in rest))


def latest_success(runs: DataFrame) -> DataFrame:
    done = runs.where((F.col("status") == "success") & F.col("completed_at").isNotNull())
    return done.groupBy("source_code").agg(F.max("completed_at").alias("last_success_at"))


def source_freshness(observations: DataFrame, now: Column) -> DataFrame:
    """Latest ingest and observation per source, and the age in complete hours."""
    return observations.groupBy("source_code").agg(
        F.max("ingested_at").alias("last_ingested_at"), F.max("observation_date").alias("latest_observation_date"),
    ).withColumn("age_hours", whole_units("HOUR", F.col("last_ingested_at"), now))


def freshness_findings(schedules: DataFrame, successes: DataFrame, freshness: DataFrame, now: Column) -> DataFrame:
    """One row per finding; limits are strict, and missing observations end the assessment."""
    rows = schedules.join(successes, "source_code", "left").join(freshness, "source_code", "left")
    no_data = F.col("last_ingested_at").isNull() | F.col("latest_observation_date").isNull()
    age = F.timestamp_diff("SECOND", F.col("last_ingested_at"), now) / 3600.0
    lag = F.date_diff(F.to_date(now), "latest_observation_date")

    def finding(kind: str, severity: str, message: Column) -> Column:
        return F.struct(F.lit(kind).alias("alert_type"), F.lit(severity).alias("severity"), message.alias("message"))

    limit_hours, limit_days = F.col("max_ingestion_age_hours"), F.col("max_observation_lag_days")
    found = F.array_compact(F.array(
        F.when(F.col("last_success_at").isNull(), finding("missing_successful_run", "critical", F.lit("no successful run"))),
        F.when(no_data, finding("missing_observations", "critical", F.lit("no observations"))),
        F.when(~no_data & (age > limit_hours), finding(
            "stale_ingestion", "warning", F.concat(F.lit("older than "), limit_hours.cast("string"), F.lit(" hours")))),
        F.when(~no_data & (lag > limit_days), finding(
            "stale_observation", "warning", F.concat(F.lit("behind by "), lag.cast("string"), F.lit(" days")))),
    ))
    return rows.select("source_code", "last_success_at", "last_ingested_at", "latest_observation_date", F.inline(found))


def merge_alerts(alerts: DataFrame, findings: DataFrame, checked: DataFrame, now: Column) -> DataFrame:
    """Alert table after one check: found alerts open, unfound ones of checked sources resolved."""
    new = findings.select(
        key_hash(F.col("source_code"), F.col("alert_type")).alias("alert_key"), "source_code", "alert_type", "severity",
        "message",
    )
    old = alerts.select(*(F.col(c).alias(f"o_{c}") for c in alerts.columns))
    seen = checked.select(F.col("source_code").alias("c_source")).distinct()
    both = old.join(new, F.col("o_alert_key") == F.col("alert_key"), "full_outer").join(
        seen, F.coalesce("source_code", "o_source_code") == F.col("c_source"), "left"
    )
    found, was_checked = F.col("alert_key").isNotNull(), F.col("c_source").isNotNull()
    pick = lambda c: F.coalesce(c, f"o_{c}").alias(c)
    return both.select(
        pick("alert_key"), pick("source_code"), pick("alert_type"), pick("severity"), pick("message"),
        F.coalesce("o_first_detected_at", now).alias("first_detected_at"),
        F.when(found, now).otherwise(F.col("o_last_detected_at")).alias("last_detected_at"),
        F.when(found, None).when(was_checked, F.coalesce("o_resolved_at", now)).otherwise(F.col("o_resolved_at"))
        .cast("timestamp_ntz").alias("resolved_at"),
    )


def due_sources(schedules: DataFrame, successes: DataFrame, now: Column, zone: str = "Asia/Jakarta") -> DataFrame:
    """Which sources are due, judged by local dates, and the label of the period they would load."""
    rows = schedules.join(successes, "source_code", "left").select(
        "*", local_date(now, zone).alias("today"), local_date(F.col("last_success_at"), zone).alias("done")
    )
    boundary = F.make_date(F.year("today"), F.col("run_after_month"), F.col("run_after_day"))
    monthly = (F.day("today") >= F.col("run_after_day")) & (
        F.col("done").isNull() | (F.trunc("done", "MM") < F.trunc("today", "MM"))
    )
    annual = (F.col("today") >= boundary) & (F.col("done").isNull() | (F.col("done") < boundary))
    is_monthly = F.col("frequency") == "monthly"
    return rows.select(
        "source_code", "frequency", "last_success_at",
        F.when(is_monthly, monthly).otherwise(F.coalesce(annual, F.lit(False))).alias("is_due"),
        F.when(is_monthly, F.trunc("today", "MM")).otherwise(F.trunc("today", "YEAR")).alias("scheduled_period"),
    )
