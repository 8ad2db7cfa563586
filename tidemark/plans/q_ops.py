"""Freshness, alerts, schedules and the streams."""

from pyspark.sql import functions as F

from tidemark.functions.text import key_hash
from tidemark.operators import ops
from tidemark.plans.oracle_tables import TABLES
from tidemark.plans.q_aggregates import event_observations, now
from tidemark.plans.registry import query
from tidemark.session import work_folder
from tidemark.sources import reference_tables as ref
from tidemark.streaming import event_windows, stream_ingest

TABLES["event_success"] = "SELECT event_type AS source_code, max(ts) AS last_success_at FROM events WHERE value >= 340 GROUP BY 1"
TABLES["findings"] = """
SELECT source_code, last_success_at, last_ingested_at, latest_observation_date, unnest(kinds)[1] AS alert_type, unnest(kinds)[2] AS severity, unnest(kinds)[3] AS message FROM (
SELECT *, list_filter([CASE WHEN last_success_at IS NULL THEN ['missing_successful_run', 'critical', 'no successful run'] END,
  CASE WHEN last_ingested_at IS NULL THEN ['missing_observations', 'critical', 'no observations'] END,
  CASE WHEN epoch(TIMESTAMP '2024-02-01' - last_ingested_at) / 3600 > max_ingestion_age_hours THEN ['stale_ingestion', 'warning', 'older than ' || max_ingestion_age_hours || ' hours'] END,
  CASE WHEN DATE '2024-02-01' - latest_observation_date > max_observation_lag_days THEN ['stale_observation', 'warning', 'behind by ' || (DATE '2024-02-01' - latest_observation_date) || ' days'] END], lambda x: x IS NOT NULL) AS kinds
FROM d_schedule LEFT JOIN event_success USING (source_code)
LEFT JOIN (SELECT event_type AS source_code, max(ts) AS last_ingested_at, max(ts)::DATE AS latest_observation_date FROM events GROUP BY 1) USING (source_code))
"""


def successes(lake):
    return lake.events.where("value >= 340").groupBy(F.col("event_type").alias("source_code")).agg(F.max("ts").alias("last_success_at"))


def findings(lake):
    freshness = ops.source_freshness(event_observations(lake), now())
    return ops.freshness_findings(ref.schedules(lake.spark), successes(lake), freshness, now())


@query("freshness_findings", "SELECT source_code, last_success_at, last_ingested_at, latest_observation_date, alert_type, severity, message FROM findings")
def _(lake):
    return findings(lake)


@query("alert_lifecycle", """
SELECT coalesce(o.alert_key, n.alert_key) AS alert_key, coalesce(n.source_code, o.source_code) AS source_code, coalesce(n.alert_type, o.alert_type) AS alert_type, coalesce(n.severity, o.severity) AS severity,
       coalesce(n.message, o.message) AS message, coalesce(o.first_detected_at, TIMESTAMP '2024-02-01') AS first_detected_at, CASE WHEN n.alert_key IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE o.last_detected_at END AS last_detected_at,
       CASE WHEN n.alert_key IS NOT NULL THEN NULL WHEN coalesce(n.source_code, o.source_code) IN (SELECT source_code FROM d_schedule) THEN TIMESTAMP '2024-02-01' ELSE NULL END AS resolved_at
FROM (SELECT sha256(source_code || ':stale_ingestion') AS alert_key, source_code, 'stale_ingestion' AS alert_type, 'warning' AS severity, 'old' AS message, first_detected_at, last_detected_at FROM (
        SELECT event_type AS source_code, min(ts) AS first_detected_at, max(ts) AS last_detected_at FROM events GROUP BY 1
        UNION ALL SELECT 'user' || user_id, min(ts), max(ts) FROM events GROUP BY user_id)) o
FULL JOIN (SELECT sha256(source_code || ':' || alert_type) AS alert_key, * FROM findings) n ON n.alert_key = o.alert_key
""")
def _(lake):
    # Stored alerts: one per event type, and one per user, whose sources this check does not cover.
    by_type = lake.events.groupBy(F.col("event_type").alias("source_code"))
    by_user = lake.events.groupBy(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("source_code"))
    seen = [g.agg(F.min("ts").alias("first_detected_at"), F.max("ts").alias("last_detected_at")) for g in (by_type, by_user)]
    kind = F.lit("stale_ingestion")
    alerts = seen[0].unionByName(seen[1]).select(
        key_hash(F.col("source_code"), kind).alias("alert_key"), "source_code", kind.alias("alert_type"), F.lit("warning").alias("severity"),
        F.lit("old").alias("message"), "first_detected_at", "last_detected_at", F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
    )
    return ops.merge_alerts(alerts, findings(lake), ref.schedules(lake.spark), now())


DUE_SQL = """
SELECT source_code, frequency, last_success_at, I(coalesce(CASE WHEN frequency = 'monthly' THEN day(today) >= run_after_day AND (done IS NULL OR date_trunc('month', done) < date_trunc('month', today))
  ELSE today >= edge AND (done IS NULL OR done < edge) END, false)) AS is_due, CASE WHEN frequency = 'monthly' THEN date_trunc('month', today)::DATE ELSE date_trunc('year', today)::DATE END AS scheduled_period
FROM (SELECT *, DATE '2024-02-05' AS today, (last_success_at + INTERVAL 7 HOUR)::DATE AS done, CASE WHEN run_after_month IS NOT NULL THEN make_date(2024, run_after_month, run_after_day) END AS edge FROM d_schedule LEFT JOIN event_success USING (source_code))
"""


def due(lake):
    return ops.due_sources(ref.schedules(lake.spark), successes(lake), F.lit("2024-02-04 20:00:00").cast("timestamp_ntz"))


@query("due_sources", DUE_SQL)
def _(lake):
    return due(lake)


@query("scheduled_period", f"SELECT source_code, scheduled_period FROM ({DUE_SQL})")
def _(lake):
    return due(lake).select("source_code", "scheduled_period")


def _stream_folders(lake):
    root = work_folder(lake.spark)
    return f"{root}/table", f"{root}/rejects", f"{root}/checkpoint"


@query("stream_freshness", """
SELECT event_type, date_trunc('day', ts) AS window_start, count(*) AS event_count, R(sum(value::DECIMAL(24,6))::DOUBLE / count(*)::DOUBLE) AS mean_value FROM events
GROUP BY 1, 2 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
""")
def _(lake):
    return event_windows.run_event_windows(lake.spark, f"{lake.folder}/events.parquet", *_stream_folders(lake)[::2])


@query("stream_ingest_upsert", """
SELECT event_type AS indicator_code, 'u' || user_id AS region_code, ts::DATE AS observation_date, R(arg_max(value, (ts, value))) AS value FROM events GROUP BY 1, 2, 3
""")
def _(lake):
    return stream_ingest.run_event_upsert(lake.spark, f"{lake.folder}/events.parquet", *_stream_folders(lake))


@query("stream_rejects", """
SELECT I(event_id) AS event_id, CASE WHEN value IS NULL OR event_id % 10 = 3 THEN 'null_field' WHEN user_id % 10 = 4 THEN 'blank_text' WHEN event_type = 'click' AND event_id % 10 = 5 THEN 'unknown_frequency' WHEN event_id % 10 = 6 THEN 'value_not_finite'
  ELSE 'province_without_parent' END AS issue, 'rejected' AS status FROM events
WHERE value IS NULL OR event_id % 10 IN (3, 6, 7) OR user_id % 10 = 4 OR event_type = 'click' AND event_id % 10 = 5
UNION ALL SELECT I(count(*)), 'none', 'accepted' FROM (SELECT DISTINCT event_type, user_id, ts::DATE FROM events
  WHERE NOT (value IS NULL OR event_id % 10 IN (3, 6, 7) OR user_id % 10 = 4 OR event_type = 'click' AND event_id % 10 = 5))
""")
def _(lake):
    """Events with planted faults, by id, user and type: what the ingest puts aside, and how many keys it takes."""
    table, quarantine, checkpoint = _stream_folders(lake)
    last = F.col("event_id") % 10

    def planted(rows):
        return rows.withColumns({
            "value": F.when(last == 3, None).when(last == 6, float("inf")).otherwise(F.col("value")),
            "region_name": F.when(F.col("region_code").endswith("4"), " ").otherwise(F.col("region_name")),
            "frequency": F.when((F.col("indicator_code") == "click") & (last == 5), "hourly").otherwise(F.col("frequency")),
            "region_level": F.when(last == 7, "province").otherwise(F.col("region_level")),
        })

    stream_ingest.run_event_ingest(lake.spark, f"{lake.folder}/events.parquet", table, quarantine, checkpoint, planted)
    found = stream_ingest.rejected(lake.spark, quarantine).select("event_id", "issue", F.lit("rejected").alias("status"))
    taken = stream_ingest.current(lake.spark, table, stream_ingest.EVENT_KEYS, "retrieved_at").agg(F.count(F.lit(1)).alias("event_id"))
    return found.unionByName(taken.select("event_id", F.lit("none").alias("issue"), F.lit("accepted").alias("status")))
