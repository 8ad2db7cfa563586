"""Contracts, merges, operations, streams and segmentation."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import ops, segment, upsert, validate
from tidemark.streaming import event_windows, stream_ingest


def observation(**changes):
    row = {
        "indicator_code": "X", "indicator_name": "x", "unit": "percent", "frequency": "annual", "region_code": "A", "region_name": "a",
        "region_level": "country", "parent_region_code": None, "observation_date": date(2020, 1, 1), "value": None, "source_code": "s",
        "source_name": "s", "source_url": "u", "retrieved_at": datetime(2021, 1, 1),
    }
    from decimal import Decimal

    row["value"] = Decimal(1)
    return tuple((row | changes)[n] for n in schema.OBSERVATION.names)


def broken(spark, *rows):
    frame = spark.createDataFrame(list(rows), schema.OBSERVATION)
    return {r.rule for r in validate.validate_observations(frame).where("violations > 0").collect()}


def test_contract(spark):
    assert broken(spark, observation()) == set()
    assert broken(spark) == {"empty_dataset"}
    assert broken(spark, observation(), observation()) == {"duplicate_observation"}
    assert broken(spark, observation(unit=" ", frequency="weekly", region_level="moon")) == {"blank_text", "unknown_frequency", "unknown_region_level"}
    assert broken(spark, observation(observation_date=date(2020, 2, 1))) == {"annual_not_january_first"}
    assert broken(spark, observation(region_level="province")) == {"province_without_parent"}
    assert broken(spark, observation(), observation(unit="usd", region_name="b", observation_date=date(2021, 1, 1))) == {"inconsistent_indicator", "inconsistent_region"}
    with pytest.raises(ValueError, match="duplicate_observation"):
        validate.require_valid(spark.createDataFrame([observation(), observation()], schema.OBSERVATION))
    with pytest.raises(ValueError, match="missing columns"):
        validate.validate_observations(spark.createDataFrame([observation()], schema.OBSERVATION).drop("unit"))


def test_not_finite_value(spark):
    frame = spark.createDataFrame([observation()], schema.OBSERVATION).withColumn("value", F.lit(float("inf")))
    assert validate.validate_observations(frame).where("rule = 'value_not_finite'").first().violations == 1


def test_upsert_is_idempotent_and_batch_wins(spark):
    columns = "k string, v int, at timestamp_ntz"
    old = spark.createDataFrame([("a", 1, datetime(2024, 1, 9)), ("b", 2, datetime(2024, 1, 1))], columns)
    batch = spark.createDataFrame([("a", 5, datetime(2024, 1, 2)), ("a", 4, datetime(2024, 1, 1)), ("c", 3, datetime(2024, 1, 1))], columns)
    once = upsert.upsert(old, batch, ["k"], "at")
    twice = upsert.upsert(once, batch, ["k"], "at")
    assert {r.k: r.v for r in once.collect()} == {"a": 5, "b": 2, "c": 3}
    assert sorted(once.collect()) == sorted(twice.collect())


def test_history_widens_and_versions(spark):
    columns = ("indicator_code string, source_code string, metadata_hash string, unit string, period_start date, period_end date, "
               "first_observed_at timestamp_ntz, last_observed_at timestamp_ntz")
    row = lambda h, unit, a, b, day: ("X", "s", h, unit, date(a, 1, 1), date(b, 1, 1), datetime(2024, 1, day), datetime(2024, 1, day))
    history = spark.createDataFrame([row("h1", "old", 2001, 2005, 1)], columns)
    batch = spark.createDataFrame([row("h1", "new", 2000, 2003, 2), row("h2", "kg", 2006, 2007, 2)], columns)
    merged = {r.metadata_hash: r for r in upsert.merge_metadata_history(history, batch).collect()}
    assert len(merged) == 2 and merged["h1"].unit == "new"
    assert (merged["h1"].period_start.year, merged["h1"].period_end.year) == (2000, 2005)
    assert (merged["h1"].first_observed_at.day, merged["h1"].last_observed_at.day) == (1, 2)


def test_children_are_replaced_per_parent(spark):
    parents = spark.createDataFrame([("r1", 1), ("r2", 1)], "run_key string, v int")
    children = spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", 1)], "run_key string, step int")
    new_parents, new_children = spark.createDataFrame([("r1", 9)], "run_key string, v int"), spark.createDataFrame([("r1", 7)], "run_key string, step int")
    merged, kept = upsert.replace_children(parents, new_parents, children, new_children, "run_key")
    assert {tuple(r) for r in merged.collect()} == {("r1", 9), ("r2", 1)} and {tuple(r) for r in kept.collect()} == {("r1", 7), ("r2", 1)}


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert.write_snapshot(spark.range(1), root, "001")
    upsert.write_snapshot(spark.range(2), root, "002")
    assert upsert.read_latest_snapshot(spark, root).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        upsert.write_snapshot(spark.range(3), root, "002")


def test_run_states(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    rows = [("r1", "s", "running", at(1), None, None), ("r1", "s", "success", at(2), 5, None), ("r1", "s", "failed", at(3), None, "late"),
            ("r2", "s", "failed", at(1), None, "early"), ("r2", "s", "running", at(4), None, None), ("r3", "s", "failed", at(5), None, "never started")]
    runs = {r.run_id: r for r in ops.run_states(spark.createDataFrame(rows, "run_id string, source_code string, status string, at timestamp_ntz, rows_loaded int, error_message string")).collect()}
    assert set(runs) == {"r1", "r2"} and (runs["r1"].status, runs["r1"].rows_loaded) == ("success", 5)
    assert (runs["r2"].status, runs["r2"].completed_at) == ("running", None)


NOW = datetime(2026, 9, 11, 12)


def freshness(spark, success, ingested, observed):
    schedule = spark.createDataFrame([("s", "monthly", None, 5, 48, 60)], "source_code string, frequency string, run_after_month int, run_after_day int, max_ingestion_age_hours int, max_observation_lag_days int")
    successes = spark.createDataFrame([("s", success)], "source_code string, last_success_at timestamp_ntz").where("last_success_at IS NOT NULL")
    fresh = spark.createDataFrame([("s", ingested, observed)], "source_code string, last_ingested_at timestamp_ntz, latest_observation_date date")
    return ops.freshness_findings(schedule, successes, fresh, F.lit(NOW).cast("timestamp_ntz"))


def test_freshness(spark):
    kinds = lambda *a: {r.alert_type for r in freshness(spark, *a).collect()}
    assert kinds(NOW, datetime(2026, 9, 11), date(2026, 9, 1)) == set()
    assert kinds(None, None, None) == {"missing_successful_run", "missing_observations"}
    assert kinds(NOW, datetime(2026, 9, 8, 12), date(2026, 1, 1)) == {"stale_ingestion", "stale_observation"}


def test_alert_lifecycle(spark):
    checked = spark.createDataFrame([("s",)], "source_code string")
    stale = freshness(spark, NOW, datetime(2026, 9, 8), date(2026, 9, 1))
    columns = "alert_key string, source_code string, alert_type string, severity string, message string, first_detected_at timestamp_ntz, last_detected_at timestamp_ntz, resolved_at timestamp_ntz"
    at = lambda day: F.lit(datetime(2026, 9, day)).cast("timestamp_ntz")
    first = ops.merge_alerts(spark.createDataFrame([], columns), stale, checked, at(11))
    second = ops.merge_alerts(first, stale, checked, at(12)).collect()
    assert len(second) == 1 and (second[0].first_detected_at.day, second[0].last_detected_at.day, second[0].resolved_at) == (11, 12, None)
    healed = ops.merge_alerts(spark.createDataFrame(second, columns), stale.where("false"), checked, at(13)).collect()
    assert (healed[0].resolved_at.day, healed[0].last_detected_at.day) == (13, 12)
    again = ops.merge_alerts(spark.createDataFrame(healed, columns), stale, checked, at(14)).first()
    assert again.resolved_at is None and again.first_detected_at.day == 11
    other = ops.merge_alerts(spark.createDataFrame(second, columns), stale.where("false"), checked.where("false"), at(13)).first()
    assert other.resolved_at is None


@pytest.mark.parametrize(("frequency", "month", "day", "now", "done", "due"), [
    ("monthly", None, 5, "2026-09-04 16:00", None, 0), ("monthly", None, 5, "2026-09-04 18:00", None, 1), ("monthly", None, 5, "2026-09-11 12:00", "2026-09-06 00:00", 0),
    ("monthly", None, 5, "2026-09-11 12:00", "2026-08-06 00:00", 1), ("annual", 7, 15, "2026-07-14 12:00", None, 0), ("annual", 7, 15, "2026-07-14 18:00", None, 1),
    ("annual", 7, 15, "2026-09-11 12:00", "2026-07-20 00:00", 0), ("annual", 7, 15, "2026-09-11 12:00", "2025-07-20 00:00", 1),
])
def test_due(spark, frequency, month, day, now, done, due):
    schedule = spark.createDataFrame([("s", frequency, month, day)], "source_code string, frequency string, run_after_month int, run_after_day int")
    success = spark.sql(f"SELECT 's' AS source_code, TIMESTAMP_NTZ '{done}' AS last_success_at") if done else spark.sql("SELECT 's' AS source_code, CAST(NULL AS TIMESTAMP_NTZ) AS last_success_at")
    row = ops.due_sources(schedule, success, F.lit(now).cast("timestamp_ntz")).first()
    assert row.is_due == bool(due)
    assert row.scheduled_period == (date(2026, int(now[5:7]), 1) if frequency == "monthly" else date(2026, 1, 1))


def test_stream_drops_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    rows = lambda *hours: spark.createDataFrame([(datetime(2024, 1, 1) if h < 0 else datetime(2024, 1, 1 + h // 24, h % 24), "a", 1.0) for h in hours], "ts timestamp_ntz, event_type string, value double")
    schema_ = rows(1).schema
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for batch in ((1, 2, 50), (3,), (80,), (100,)):
        rows(*batch).coalesce(1).write.mode("append").parquet(str(folder))
        frame = event_windows.event_windows(spark.readStream.schema(schema_).parquet(str(folder)))
        frame.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    counts = {r.window_start.day: r.event_count for r in spark.read.parquet(out).collect()}
    assert counts[1] == 2 and counts[3] == 1


def test_ingest_resumes_and_latest_wins(spark, tmp_path):
    folder, root, state = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state")
    columns = "k string, v int, at timestamp_ntz"
    for i, batch in enumerate(([("a", 1), ("b", 1)], [("a", 2)], [])):
        if batch:
            spark.createDataFrame([(k, v, datetime(2024, 1, 1 + i)) for k, v in batch], columns).write.mode("append").parquet(folder)
        stream_ingest.run_ingest(spark.readStream.schema(columns).parquet(folder), root, state, ["k"], "at")
    assert {r.k: r.v for r in stream_ingest.current(spark, root, ["k"], "at").collect()} == {"a": 2, "b": 1}
    stream_ingest.compact(spark, root, str(tmp_path / "compacted"), ["k"], "at")
    assert stream_ingest.current(spark, str(tmp_path / "compacted"), ["k"], "at").count() == 2


def regions(spark):
    values = {"A": (10, 2), "B": (11, 2.5), "C": (12, 2.2), "D": (40, 8), "E": (42, 8.5), "F": (41, 7.8)}
    rows = [(2024, c, r, float(v)) for r, pair in values.items() for c, v in zip(("x", "y"), pair)] + [(2025, "x", "A", 1.0)]
    return spark.createDataFrame(rows, "observation_year int, indicator_code string, region_code string, value double")


def test_features_come_from_the_latest_usable_year(spark):
    features = segment.regional_features(regions(spark))
    assert {r.observation_year for r in features.collect()} == {2024} and segment.feature_matrix(features, ["x", "y"]).count() == 6


def test_clusters_separate_the_two_groups(spark):
    matrix = segment.feature_matrix(segment.regional_features(regions(spark)), ["x", "y"])
    rows = segment.regional_clusters(matrix, ["x", "y"], starts=2).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.cluster, set()).add(r.region_code)
    assert 2 <= rows[0].cluster_count <= 5
    assert all(g <= set("ABC") or g <= set("DEF") for g in groups.values())


def test_ingest_puts_bad_rows_aside_and_replays_change_nothing(spark, tmp_path):
    columns = "k string, v int, at timestamp, id long"
    check = lambda frame: frame.withColumn("issue", F.when(F.col("v") < 0, "negative"))
    root, aside = str(tmp_path / "table"), str(tmp_path / "aside")
    write = stream_ingest.write_batches(root, ["k"], "at", check, aside)
    at = lambda minute: datetime(2024, 1, 1, 0, minute)
    batches = [[("a", 1, at(1), 1), ("a", -5, at(2), 2), ("b", 2, at(1), 3)], [("a", 7, at(3), 4), ("c", -1, at(4), 5)]]
    for _ in range(2):  # the second time is a replay
        for number, rows in enumerate(batches):
            write(spark.createDataFrame(rows, columns), number)
        assert {r.k: r.v for r in stream_ingest.current(spark, root, ["k"], "at").collect()} == {"a": 7, "b": 2}
        assert sorted((r.id, r.issue, r.batch) for r in stream_ingest.rejected(spark, aside).collect()) == [(2, "negative", 0), (5, "negative", 1)]
    strict = stream_ingest.write_batches(str(tmp_path / "strict"), ["k"], "at", check)
    with pytest.raises(Exception, match="negative"):
        strict(spark.createDataFrame(batches[0], columns), 0)


def test_rows_seen_before_are_not_taken_again_in_a_later_batch(spark, tmp_path):
    columns = "k string, v int, at timestamp, id long"
    files, root, state = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state")
    at = lambda minute: datetime(2024, 1, 1, 0, minute)
    for rows in ([("a", 1, at(1), 1), ("b", 2, at(2), 2)], [("a", 9, at(1), 1), ("c", 3, at(3), 3)]):
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(files)
        stream = stream_ingest.first_seen(spark.readStream.schema(columns).parquet(files), ["id"], "at", "1 hour")
        stream_ingest.run_ingest(stream, root, state, ["k"], "at")
    assert {r.k: r.v for r in stream_ingest.current(spark, root, ["k"], "at").collect()} == {"a": 1, "b": 2, "c": 3}
