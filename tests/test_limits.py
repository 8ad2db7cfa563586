"""Rows that a cap, a calendar or a lost fault would hide."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import growth_percent
from tidemark.operators import segment, upsert
from tidemark.operators.calendar import calendar_slots
from tidemark.plans import panels
from tidemark.session import settle
from tidemark.sources import reference_tables as ref
from tidemark.sources.lake import Lake


def test_facts_of_any_year_stay_in_the_star(spark):
    days = [date(1885, 1, 1), date(2000, 1, 1), date(2131, 1, 1)]
    facts = spark.createDataFrame([(1, 7, 1, d, 1, None) for d in days], "indicator_id int, region_id long, source_id int, observation_date date, value int, ingested_at string")
    regions = spark.createDataFrame([(7, "N07", "n", "country", "R1")], "region_id long, region_code string, region_name string, region_level string, parent_region_code string")
    rows = panels.star_join(facts, regions, "ledger_annual").collect()
    assert sorted((r.observation_date, r.observation_year, r.observation_quarter) for r in rows) == [(d, d.year, 1) for d in days]
    assert sorted(r.date_id for r in ref.date_dimension(facts, "observation_date").collect()) == [18850101, 20000101, 21310101]


def test_calendar_keeps_odd_rows(spark):
    rows = [(date(2020, 1, 1), 1), (date(2020, 1, 1), 2), (date(2020, 1, 31), 3), (date(2020, 4, 1), 4), (None, 5)]
    frame = spark.createDataFrame([("a", *r) for r in rows], "k string, d date, v int")
    got = [(r.d, r.v) for r in calendar_slots(frame, ["k"], "d", "month").collect()]
    assert sorted(got, key=str) == sorted([*rows, (date(2020, 2, 1), None), (date(2020, 3, 1), None)], key=str)


def test_growth_is_finite(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (float("inf"), 1.0), (1.0, 0.0), (float("nan"), 1.0)], "v double, p double")
    assert [r.g for r in frame.select(growth_percent(F.col("v"), F.col("p")).alias("g")).collect()] == [-50.0, None, None, None]


@pytest.mark.parametrize("shared", [True, False])
def test_intermediate_tables(spark, tmp_path, monkeypatch, shared):
    """Written to the shared folder where one is set; kept by Spark, and nowhere else, where none is."""
    plain = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: (str(tmp_path) if shared else None) if key == "spark.checkpoint.dir" else plain(self, key, *default))
    kept = settle(spark.range(5))
    assert kept.count() == 5 and len(list(tmp_path.glob("*/_SUCCESS"))) == shared and kept.storageLevel.useDisk != shared
    kept.unpersist()


def test_newest_version_is_found_by_folder(spark, tmp_path):
    for version in ("2024-01", "2024-03", "2024-02"):
        upsert.write_snapshot(spark.range(1).select(F.lit(version).alias("v")), str(tmp_path), version)
    (tmp_path / "version=2024-09").mkdir()
    assert [r.v for r in upsert.read_latest_snapshot(spark, str(tmp_path)).collect()] == ["2024-03"]


def test_duplicate_cells_are_refused(spark):
    rows = [("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("b", "y", 4.0), ("b", "z", 5.0)]
    frame = spark.createDataFrame(rows, "region_code string, indicator_code string, value double")
    assert segment.feature_matrix(frame, ["x", "y"]).count() == 2
    with pytest.raises(Exception, match="duplicate cell a x"):
        segment.feature_matrix(frame.union(frame.where("region_code = 'a' AND indicator_code = 'x'")), ["x", "y"]).collect()


def test_limits_leave_what_they_do_not_name(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    key = ["indicator_code", "region_code", "observation_date", "value"]
    whole = panels.staged(lake, "ledger_annual").select(*key)
    part = panels.staged(lake, "ledger_annual", indicators=["A.ORDERS", "A.REVENUE"], regions=["N07", "N03"], years=(1994, 1996)).select(*key)
    want = whole.where("indicator_code IN ('A.ORDERS', 'A.REVENUE') AND region_code IN ('N07', 'N03') AND year(observation_date) BETWEEN 1994 AND 1996")
    assert part.exceptAll(want).count() == 0 and want.exceptAll(part).count() == 0 and part.count() > 0
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "GreaterThanOrEqual(o_orderdate" in plan
