"""Contracts, keyed merges and history."""

from pyspark.sql import functions as F

from tidemark.functions.numbers import exact
from tidemark.functions.text import content_hash
from tidemark.operators import upsert as up
from tidemark.operators.rules import out_of_range
from tidemark.operators.validate import validate_metadata, validate_observations
from tidemark.plans import landed_payloads as payloads
from tidemark.plans import panels
from tidemark.plans.oracle_tables import TABLES
from tidemark.plans.registry import query
from tidemark.session import settle, work_folder
from tidemark.sources import landed
from tidemark.sources import reference_tables as ref
from tidemark.sources.sinks import labelled


def canonical(lake):
    """Order lines as observation rows, faults of the raw table included."""
    rows = lake.lineitem.select(
        F.concat(F.lit("L."), "l_returnflag").alias("indicator_code"), F.lit("Line value").alias("indicator_name"),
        F.when(F.col("l_linestatus") == "F", "usd").otherwise("eur").alias("unit"),
        F.when(F.col("l_linenumber") == 7, "weekly").otherwise("annual").alias("frequency"),
        F.col("l_suppkey").cast("string").alias("region_code"), F.when(F.col("l_quantity") > 1, "supplier").otherwise(" ").alias("region_name"),
        F.lit("province").alias("region_level"), F.when(F.col("l_suppkey") > 3, "N00").alias("parent_region_code"),
        F.to_date("l_shipdate").alias("observation_date"), exact("l_extendedprice").alias("value"),
        F.col("l_orderkey").cast("string").alias("source_code"), F.lit("orders").alias("source_name"), F.lit("https://example.org").alias("source_url"),
        F.when(F.col("l_tax") > 0, F.col("l_shipdate")).alias("retrieved_at"),
    )
    return rows


@query("validate_observations", """
SELECT unnest(['empty_dataset', 'null_field', 'blank_text', 'unknown_frequency', 'unknown_region_level', 'annual_not_january_first', 'value_not_finite',
               'province_without_parent', 'duplicate_observation', 'inconsistent_indicator', 'inconsistent_region']) AS rule,
       unnest([0, (SELECT count(*) FROM lineitem WHERE NOT coalesce(l_tax > 0, false)), (SELECT count(*) FROM lineitem WHERE l_quantity <= 1), (SELECT count(*) FROM lineitem WHERE l_linenumber = 7), 0,
               (SELECT count(*) FROM lineitem WHERE l_linenumber <> 7 AND (month(l_shipdate) <> 1 OR day(l_shipdate) <> 1)), 0,
               (SELECT count(*) FROM lineitem WHERE l_suppkey <= 3),
               (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_returnflag, l_suppkey, l_orderkey, l_shipdate::DATE HAVING count(*) > 1)),
               (SELECT count(*) FROM (SELECT l_returnflag FROM lineitem GROUP BY 1 HAVING count(DISTINCT (l_linestatus = 'F', l_linenumber = 7)) > 1)),
               (SELECT count(*) FROM (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_quantity > 1) > 1))]) AS violations
""")
def _(lake):
    return validate_observations(canonical(lake))


TABLES["series_meta"] = """
SELECT indicator_code, 'ledger_regional' AS source_code, any_value(indicator_name) AS indicator_name, any_value(unit) AS unit, 'Sum of line quantities' AS definition_text, '' AS notes,
       '1975' AS source_variable_id, split_part(split_part(indicator_code, '.TV', 2), '.', 1) AS derived_variable_id, split_part(indicator_code, '.TP', 2) AS derived_period_id,
       min(observation_date) AS period_start, max(observation_date) AS period_end FROM cube_obs GROUP BY 1
"""


def series_metadata(lake):
    """Metadata of every provincial series, with the hash of the fields that make a version."""
    rows = landed.normalize_cube(payloads.cube_payloads(lake), payloads.series_prefixes(lake.spark))
    fields = ["definition_text", "derived_period_id", "derived_variable_id", "indicator_name", "notes", "source_variable_id", "unit"]
    meta = rows.groupBy("indicator_code", *fields).agg(
        F.min("observation_date").alias("period_start"), F.max("observation_date").alias("period_end")
    )
    return meta.withColumns({
        "source_code": F.lit("ledger_regional"), "metadata_hash": content_hash(*(F.col(f) for f in fields)),
        "observed_at": F.col("period_end").cast("timestamp_ntz"),
    })


@query("metadata_hash", """
SELECT indicator_code, sha256('{"definition_text":"' || definition_text || '","derived_period_id":"' || derived_period_id || '","derived_variable_id":"' || derived_variable_id || '","indicator_name":"' || indicator_name
  || '","notes":"","source_variable_id":"1975","unit":"units"}') AS metadata_hash, period_start, period_end FROM series_meta
""")
def _(lake):
    return series_metadata(lake).select("indicator_code", "metadata_hash", "period_start", "period_end")


@query("validate_metadata", """
SELECT unnest(['empty_dataset', 'null_field', 'bad_hash', 'period_order', 'repeated_series', 'scope_differs']) AS rule,
       unnest([0, 0, (SELECT count(*) FROM series_meta WHERE derived_period_id = '2'), 0, 0, (SELECT count(*) FROM series_meta WHERE derived_variable_id = '3')]) AS violations
""")
def _(lake):
    meta = settle(series_metadata(lake))
    faulty = meta.withColumn("metadata_hash", F.when(F.col("derived_period_id") == "2", "none").otherwise(F.col("metadata_hash")))
    return validate_metadata(faulty, meta.where("derived_variable_id <> '3'"))


@query("validate_ranges", """
SELECT violated_rule, count(*) AS violations FROM stg_all s JOIN d_rule r ON r.source_code = s.source_code AND regexp_matches(s.indicator_code, r.pattern)
WHERE (CASE WHEN low_open THEN s.value::DOUBLE <= low ELSE s.value::DOUBLE < low END) OR s.value::DOUBLE > high GROUP BY 1
""")
def _(lake):
    rows = panels.star_join(panels.facts(lake), panels.regions(lake))
    return out_of_range(rows, ref.value_rules(lake.spark)).groupBy("violated_rule").agg(F.count(F.lit(1)).alias("violations"))


@query("upsert_dimensions", """
SELECT coalesce(n.c, o.c) AS region_code, coalesce(n.name, o.name) AS region_name, coalesce(n.bal, o.bal) AS balance FROM
  (SELECT c_custkey AS c, c_name AS name, R(c_acctbal) AS bal FROM customer WHERE c_mktsegment <> 'MACHINERY') o
  FULL JOIN (SELECT c_custkey AS c, upper(c_name) AS name, R(c_acctbal + 1) AS bal FROM customer WHERE c_acctbal > 0) n ON n.c = o.c
""")
def _(lake):
    rows = lake.customer.select(F.col("c_custkey").alias("region_code"), F.col("c_name").alias("region_name"), F.col("c_acctbal").alias("balance"), "c_mktsegment")
    current = rows.where("c_mktsegment <> 'MACHINERY'").drop("c_mktsegment")
    batch = rows.where("balance > 0").drop("c_mktsegment").withColumns({"region_name": F.upper("region_name"), "balance": F.col("balance") + 1})
    return up.upsert(current, batch, ["region_code"])


TABLES["fact_versions"] = """
SELECT o_custkey, o_orderdate::DATE AS observation_date, o_totalprice::DECIMAL(24,6) AS value, o_orderdate + to_seconds(o_orderkey) AS ingested_at, o_orderpriority < '3' AS is_batch FROM orders
"""
FACT_SQL = """
SELECT o_custkey, observation_date, R(value) AS value, ingested_at FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, observation_date ORDER BY is_batch DESC, ingested_at DESC, value DESC) AS rn FROM fact_versions) WHERE rn = 1
"""


def fact_versions(lake):
    stamp = F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate"))
    rows = lake.orders.select(
        "o_custkey", F.to_date("o_orderdate").alias("observation_date"), exact("o_totalprice").alias("value"), stamp.alias("ingested_at"), "o_orderpriority"
    )
    return rows.where("o_orderpriority >= '3'").drop("o_orderpriority"), rows.where("o_orderpriority < '3'").drop("o_orderpriority")


@query("upsert_facts", FACT_SQL)
def _(lake):
    current, batch = fact_versions(lake)
    return up.upsert(current, batch, ["o_custkey", "observation_date"], "ingested_at")


@query("snapshot_upsert", FACT_SQL)
def _(lake):
    """Version 1 of a table is written, a batch merged into what is read back, version 2 written and the newest read."""
    current, batch = fact_versions(lake)
    root = work_folder(lake.spark)
    up.write_snapshot(current, root, "000001")
    up.write_snapshot(up.upsert(up.read_latest_snapshot(lake.spark, root), batch, ["o_custkey", "observation_date"], "ingested_at"), root, "000002")
    return up.read_latest_snapshot(lake.spark, root)


@query("upsert_facts_twice", FACT_SQL)
def _(lake):
    current, batch = fact_versions(lake)
    once = up.upsert(current, batch, ["o_custkey", "observation_date"], "ingested_at")
    return up.upsert(once, batch, ["o_custkey", "observation_date"], "ingested_at")


@query("merge_metadata_history", """
SELECT p_brand AS indicator_code, 'catalog' AS source_code, sha256(p_type) AS metadata_hash, arg_max(p_name, (date_seen, p_name)) AS indicator_name, min(date_seen) AS period_start, max(date_seen) AS period_end,
       min(date_seen)::TIMESTAMP AS first_observed_at, max(date_seen)::TIMESTAMP AS last_observed_at
FROM (SELECT p_brand, p_type, p_name, l_shipdate::DATE AS date_seen FROM lineitem JOIN part ON p_partkey = l_partkey) GROUP BY 1, 2, 3
""")
def _(lake):
    # One sighting per shipped line; lines of one part and day are one sighting.
    lines = lake.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("seen"), "l_returnflag").distinct()
    rows = lines.join(lake.part.select("p_partkey", "p_brand", "p_type", "p_name"), "p_partkey").select(
        F.col("p_brand").alias("indicator_code"), F.lit("catalog").alias("source_code"), F.sha2("p_type", 256).alias("metadata_hash"),
        F.col("p_name").alias("indicator_name"), F.col("seen").alias("period_start"), F.col("seen").alias("period_end"),
        F.col("seen").cast("timestamp_ntz").alias("first_observed_at"), F.col("seen").cast("timestamp_ntz").alias("last_observed_at"), "l_returnflag",
    )
    return up.merge_metadata_history(rows.where("l_returnflag = 'A'").drop("l_returnflag"), rows.where("l_returnflag <> 'A'").drop("l_returnflag"))


@query("date_dimension", """
SELECT DISTINCT I(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)) AS date_id, o_orderdate::DATE AS full_date, I(year(o_orderdate)) AS year, I(quarter(o_orderdate)) AS quarter, I(month(o_orderdate)) AS month FROM orders
""")
def _(lake):
    return ref.date_dimension(lake.orders.select(F.to_date("o_orderdate").alias("full_date")))


@query("sink_labels", """SELECT s_suppkey AS "Supplier id", s_name AS "Name, full", R(s_acctbal) AS "Balance" FROM supplier""")
def _(lake):
    return labelled(lake.supplier, {"s_suppkey": "Supplier id", "s_name": "Name, full", "s_acctbal": "Balance"})
