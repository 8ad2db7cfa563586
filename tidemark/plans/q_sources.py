"""Sources, sinks and the normalisers behind them."""

from pyspark.sql import functions as F

from tidemark.functions.text import series_code, series_name
from tidemark.operators.rules import set_difference
from tidemark.operators.stats import dataset_inventory
from tidemark.plans import landed_payloads as payloads
from tidemark.plans import marts, panels
from tidemark.plans.oracle_tables import TABLES
from tidemark.plans.registry import query
from tidemark.sources import landed, sinks
from tidemark.sources import reference_tables as ref


@query("read_indicator_json", """
SELECT indicator_code, region_code, region_name, observation_year::VARCHAR AS period, R(value) AS value FROM stg_annual
UNION ALL SELECT indicator_code, region_code, region_name, (max(observation_year) + 1)::VARCHAR, NULL FROM stg_annual GROUP BY 1, 2, 3
""")
def _(lake):
    return landed.indicator_records(payloads.indicator_envelopes(lake)).drop("file")


@query("normalize_records", """
SELECT indicator_code, indicator_name, unit, frequency, region_code, region_name, observation_date, R(value) AS value FROM stg_annual
""")
def _(lake):
    records = landed.indicator_records(payloads.indicator_envelopes(lake))
    return landed.normalize_records(records, ref.indicators(lake.spark).drop("indicator_id"))


@query("unknown_codes", "SELECT 'A.' || upper(event_type) AS indicator_code FROM events WHERE event_type <> 'orders' GROUP BY ALL")
def _(lake):
    records = lake.events.select(F.concat(F.lit("A."), F.upper("event_type")).alias("indicator_code"))
    return landed.unknown_codes(records, ref.indicators(lake.spark))


@query("read_paginated_json", """
SELECT 'N' || lpad(c_nationkey::VARCHAR, 2, '0') AS request, I(floor(c_custkey / 20) + 1) AS page, c_custkey::VARCHAR AS domain_id, c_name AS domain_name FROM customer
""")
def _(lake):
    rows = landed.paginated_records(payloads.region_pages(lake))
    return rows.select("request", "page", F.col("row")["domain_id"].alias("domain_id"), F.col("row")["domain_name"].alias("domain_name"))


@query("page_completeness", """
SELECT 'N' || lpad(c_nationkey::VARCHAR, 2, '0') AS request, 'incomplete' AS issue FROM customer
GROUP BY c_nationkey HAVING count(DISTINCT floor(c_custkey / 20)) <> max(floor(c_custkey / 20)) + 1
""")
def _(lake):
    return landed.page_issues(payloads.region_pages(lake))


TABLES["cube"] = """
SELECT year(l_shipdate) AS y, 1100 + s_nationkey AS region, l_returnflag AS rf, l_linestatus AS ls, sum(l_quantity::DECIMAL(24,6)) AS qty
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL
"""
TABLES["cube_obs"] = """
SELECT 'R.1975.TV' || CASE rf WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END || '.TP' || CASE ls WHEN 'F' THEN 1 ELSE 2 END AS indicator_code,
       'Units shipped — ' || CASE rf WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' ELSE 'returned' END
         || CASE ls WHEN 'F' THEN '' ELSE ' — open' END AS indicator_name,
       'units' AS unit, region::VARCHAR AS region_code, make_date(y, 1, 1) AS observation_date, qty::DOUBLE AS value FROM cube
"""


@query("read_cube_json", """
SELECT region::VARCHAR || '1975' || CASE rf WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END || (y - 1900) || CASE ls WHEN 'F' THEN 1 ELSE 2 END AS key,
       R(qty) AS value FROM cube
UNION ALL SELECT '99991975' || CASE rf WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END || (y - 1900) || CASE ls WHEN 'F' THEN 1 ELSE 2 END, R(count(*))
FROM cube GROUP BY y, rf, ls
UNION ALL SELECT DISTINCT region || '19759' || (y - 1900) || '1', NULL FROM cube
""")
def _(lake):
    return landed.cube_cells(payloads.cube_payloads(lake)).select("key", F.col("text").try_cast("double").alias("value"))


@query("normalize_cube", "SELECT indicator_code, indicator_name, unit, region_code, observation_date, R(value) AS value FROM cube_obs")
def _(lake):
    rows = landed.normalize_cube(payloads.cube_payloads(lake), payloads.series_prefixes(lake.spark))
    return rows.select("indicator_code", "indicator_name", "unit", "region_code", "observation_date", "value")


@query("cube_drift", """
SELECT y - 1900 || '' AS file, region || '1975' || CASE rf WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END || (y - 1900) || CASE ls WHEN 'F' THEN 1 ELSE 2 END AS key,
       'unmapped_region' AS issue FROM cube WHERE region >= 1120
UNION ALL SELECT DISTINCT y - 1900 || '', region || '19759' || (y - 1900) || '1', 'unmapped_region' FROM cube WHERE region >= 1120
""")
def _(lake):
    known = lake.nation.where("n_nationkey < 20").select((F.col("n_nationkey") + 1100).cast("string").alias("region_code"))
    return landed.cube_issues(payloads.cube_payloads(lake), known)


@query("cube_key_drift", """
SELECT y - 1900 || '' AS file, region || '1975' || tv || (y - 1900) || tp AS key, 'ambiguous_key' AS issue FROM (
  SELECT y, region, CASE rf WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS tv, CASE ls WHEN 'F' THEN 1 ELSE 2 END AS tp FROM cube UNION SELECT y, 9999, CASE rf WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, CASE ls WHEN 'F' THEN 1 ELSE 2 END FROM cube)
WHERE y % 2 = 1 AND y < 2000 AND tv = 1
UNION ALL SELECT DISTINCT y - 1900 || '', 'odd' || (y - 1900), 'unknown_key' FROM cube WHERE y % 2 = 0
""")
def _(lake):
    """Cubes with planted faults: in odd years an id that makes other cuts of a key possible, in even years a key of no listed ids."""
    payload, year = F.col("payload"), F.col("file").cast("int")
    item = lambda name, val: F.concat(F.lit(f'"{name}":[{{"val":"'), val, F.lit('","label":"odd"},'))
    two = F.replace(F.replace(payload, F.lit('"turvar":['), item("turvar", F.lit("19"))), F.lit('"tahun":['), item("tahun", F.substring("file", 2, 1)))
    none = F.replace(payload, F.lit('"datacontent":{'), F.concat(F.lit('"datacontent":{"odd'), F.col("file"), F.lit('":"1",')))
    known = lake.nation.select((F.col("n_nationkey") + 1100).cast("string").alias("region_code"))
    return landed.cube_issues(payloads.cube_payloads(lake).withColumn("payload", F.when(year % 2 == 1, two).otherwise(none)), known)


@query("series_identity", """
SELECT DISTINCT 'P.' || p_brand || '.TV' || p_size || '.TP' || p_type AS series_code,
       p_name || CASE WHEN lower(p_brand) NOT IN ('-', lower(p_name)) THEN ' — ' || p_brand ELSE '' END
         || CASE WHEN lower(p_type) <> 'annual' THEN ' — ' || p_type ELSE '' END AS series_name FROM part
""")
def _(lake):
    prefix = F.concat(F.lit("P."), F.col("p_brand"))
    return lake.part.select(
        series_code(prefix, F.col("p_size").cast("string"), F.col("p_type")).alias("series_code"),
        series_name(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("series_name"),
    ).distinct()


@query("read_rate_xml", "SELECT 'N' || lpad(nation_key::VARCHAR, 2, '0') AS link, day AS observation_date, R(rate) AS value FROM daily")
def _(lake):
    return landed.normalize_rates(landed.xml_rate_records(payloads.rate_documents(lake)))


@query("rate_rules", """
SELECT unnest(['missing_field', 'unexpected_field', 'currency', 'denomination', 'buy_differs_from_sell', 'bad_stamp', 'outside_dates', 'not_positive', 'repeated_date']) AS issue,
       unnest([0, 0, 0, 0, 0, 0, (SELECT count(*) FROM daily WHERE day NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'), 0, 0]) AS violations
""")
def _(lake):
    records = landed.xml_rate_records(payloads.rate_documents(lake))
    return landed.rate_issues(records, "1996-01-01", "2000-12-31")


@query("record_rejects", """
SELECT CASE WHEN region_code = 'N03' THEN 'X.' || indicator_code ELSE indicator_code END AS indicator_code, CASE WHEN region_code = 'N04' THEN ' ' ELSE region_code END AS region_code,
       CASE WHEN observation_year = 1995 THEN 'FY1995' ELSE observation_year::VARCHAR END AS period,
       CASE WHEN region_code = 'N03' THEN 'unknown_code' WHEN observation_year = 1995 THEN 'bad_period' ELSE 'no_region' END AS issue
FROM stg_annual WHERE region_code IN ('N03', 'N04') OR observation_year = 1995
""")
def _(lake):
    """Records with planted faults: a code outside the catalog, a year that is none, no region."""
    records = landed.indicator_records(payloads.indicator_envelopes(lake))
    region = F.col("region_code")
    faulty = records.withColumns({
        "indicator_code": F.when(region == "N03", F.concat(F.lit("X."), F.col("indicator_code"))).otherwise(F.col("indicator_code")),
        "region_code": F.when(region == "N04", " ").otherwise(region),
        "period": F.when(F.col("period") == "1995", "FY1995").otherwise(F.col("period")),
    })
    checked = landed.checked_records(faulty, ref.indicators(lake.spark).drop("indicator_id"))
    return landed.rejects(checked).select("indicator_code", "region_code", "period", "issue")


@query("rate_rejects", """
SELECT 'N' || lpad(nation_key::VARCHAR, 2, '0') AS link, CASE WHEN nation_key = 3 THEN 'day ' || day ELSE day || 'T00:00:00+07:00' END AS stamp,
       CASE WHEN nation_key = 3 THEN 'bad_stamp' WHEN nation_key = 4 THEN 'bad_value' ELSE 'denomination' END AS issue FROM daily WHERE nation_key IN (3, 4) OR day(day) = 1
""")
def _(lake):
    """Rate records with planted faults: a stamp that is no date, a rate that is no number, another denomination."""
    records = landed.xml_rate_records(payloads.rate_documents(lake))
    link, stamp = F.col("lnk_subkursasing"), F.col("tgl_subkursasing")
    faulty = records.withColumns({
        "nil_subkursasing": F.when(F.substring(stamp, 9, 2) == "01", "100").otherwise(F.col("nil_subkursasing")),
        "tgl_subkursasing": F.when(link == "N03", F.concat(F.lit("day "), F.substring(stamp, 1, 10))).otherwise(stamp),
        "beli_subkursasing": F.when(link == "N04", F.lit("n.a.")).otherwise(F.col("beli_subkursasing")),
    })
    return landed.rejects(landed.checked_rates(faulty)).select("link", "stamp", "issue")


@query("rate_field_rejects", """
SELECT 'N' || lpad(nation_key::VARCHAR, 2, '0') AS link, day || 'T00:00:00+07:00' AS stamp, CASE WHEN nation_key = 5 THEN 'missing_field' ELSE 'unexpected_field:note,source' END AS issue
FROM daily WHERE nation_key = 5 OR nation_key = 6 AND day(day) <= 9
""")
def _(lake):
    """Rate records with a tag too few (one country) or two too many (early days of another) in their text."""
    text, early = F.col("payload"), r"(<tgl_subkursasing>[0-9]{4}-[0-9]{2}-0)"
    faulty = (
        F.when(text.contains("<lnk_subkursasing>N05<"), F.regexp_replace(text, "<mts_subkursasing>.*?</mts_subkursasing>", ""))
        .when(text.contains("<lnk_subkursasing>N06<"), F.regexp_replace(text, early, "<source>s</source><note>n</note>$1")).otherwise(text)
    )
    records = landed.xml_rate_records(payloads.rate_documents(lake).withColumn("payload", faulty))
    return landed.rejects(landed.checked_rates(records)).select("link", "stamp", "issue")


@query("record_drift", """
SELECT indicator_code || '-' || region_code AS file, unnest(CASE WHEN region_code = 'N05' THEN ['missing:date', 'unexpected:period'] WHEN region_code = 'N06' THEN ['type:value']
  WHEN region_code = 'N07' THEN ['not_an_object'] ELSE ['type:country', 'unexpected:note'] END) AS issue, I(count(*)) AS records
FROM (SELECT indicator_code, region_code FROM stg_annual UNION ALL SELECT DISTINCT indicator_code, region_code FROM stg_annual) WHERE region_code IN ('N05', 'N06', 'N07', 'N08') GROUP BY 1, 2
""")
def _(lake):
    """Indicator records whose fields are renamed, of another type, no objects, or more than agreed, each in one country's files."""
    payload, file = F.col("payload"), F.col("file")
    renamed = F.regexp_replace(payload, '"date":', '"period":')
    quoted = F.regexp_replace(payload, '"value":(null|-?[0-9.E]+)', '"value":"$1"')
    listed = F.regexp_replace(payload, r'\{"indicator":.*?"value":(?:null|-?[0-9.E]+)\}', "7")
    more = F.regexp_replace(payload, r'"country":\{[^}]*\}', '"note":1,"country":"a name"')
    faulty = F.when(file.endswith("-N05"), renamed).when(file.endswith("-N06"), quoted).when(file.endswith("-N07"), listed).when(file.endswith("-N08"), more).otherwise(payload)
    drift = landed.record_drift(payloads.indicator_envelopes(lake).withColumn("payload", faulty))
    return drift.groupBy("file", "issue").agg(F.count(F.lit(1)).alias("records"))


@query("cube_rejects", """
SELECT indicator_code, region_code, R(value) AS value, CASE WHEN y % 2 = 0 THEN 'bad_year' ELSE 'unmapped_region' END AS issue
FROM (SELECT *, year(observation_date) AS y FROM cube_obs) WHERE y % 2 = 0 OR region_code::INT >= 1120
""")
def _(lake):
    """Cube cells with planted faults: labels of even years without the year, and regions outside the list."""
    odd_label = F.regexp_replace("payload", "Year [0-9]{3}([02468])", "Year of the $1")
    known = lake.nation.where("n_nationkey < 20").select((F.col("n_nationkey") + 1100).cast("string").alias("region_code"))
    faulty = payloads.cube_payloads(lake).withColumn("payload", odd_label)
    checked = landed.checked_cube(faulty, payloads.series_prefixes(lake.spark), regions=known)
    return landed.rejects(checked).select("indicator_code", "region_code", "value", "issue")


@query("read_decision_table", """
SELECT 'N' || lpad(nation_key::VARCHAR, 2, '0') AS file, day AS effective_date, R(decision) AS rate FROM daily WHERE decision IS NOT NULL
""")
def _(lake):
    return landed.decisions(payloads.decision_rows(lake))


@query("decision_table_drift", "SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS file, 'header_drift' AS issue FROM nation")
def _(lake):
    rows = payloads.decision_rows(lake)
    return landed.decision_issues(rows.withColumn("rate_text", F.replace("rate_text", F.lit("BI-Rate"), F.lit("Rate"))))


@query("read_floating_tables", """
SELECT 'N' || lpad(nation_key::VARCHAR, 2, '0') AS file, day AS effective_date, R(decision) AS rate FROM daily WHERE decision IS NOT NULL
""")
def _(lake):
    return landed.decision_tables(payloads.decision_tables(lake))


@query("floating_table_rejects", """
SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS file, ['header_missing', 'header_repeated', 'header_ambiguous', 'half_parsed_row', 'unparsed_row', 'open_quote'][n_nationkey % 7] AS issue,
       1::BIGINT AS row_count FROM nation WHERE n_nationkey % 7 > 0
""")
def _(lake):
    files, fault = payloads.decision_tables(lake), F.substring("file", 2, 2).cast("int") % 7
    spare = F.repeat(F.lit(","), F.substring("file", 2, 2).cast("int") % 4)
    added = F.element_at(F.array(*(F.concat(spare, F.lit(end)) for end in ("Tanggal,,BI-Rate", "", "3 Mei 2001,,n/a", "soon,,n/a", '3 Mei 2001,,"5,00 %'))), fault - 1)
    faulty = (
        F.when(fault == 0, F.col("payload")).when(fault == 1, F.replace("payload", F.lit("BI-Rate"), F.lit("Rate")))
        .when(fault == 3, F.replace("payload", F.lit('a ""remark""'), F.lit("Periode"))).otherwise(F.concat("payload", added))
    )
    return landed.rejects(landed.checked_decision_tables(files.select("file", faulty.alias("payload")))).groupBy("file", "issue").agg(F.count(F.lit(1)).alias("row_count"))


@query("snapshot_manifest", """
SELECT doc_id::VARCHAR AS file, octet_length(encode(text)) AS byte_count, sha256(text) AS sha256 FROM documents
UNION ALL SELECT 'p' || page_id, octet_length(encode(html)), sha256(html) FROM pages
""")
def _(lake):
    files = lake.documents.select(F.concat(F.lit("landing/"), F.col("doc_id").cast("string")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    more = lake.pages.select(F.concat(F.lit("landing/p"), F.col("page_id").cast("string")).alias("path"), F.encode("html", "UTF-8").alias("content"))
    return landed.snapshot_manifest(files.unionByName(more))


@query("static_reference", """
SELECT m.region_code, m.member_since, r.region_name, i.indicator_code, count(v.value) AS observation_count
FROM d_member m JOIN d_region r USING (region_code) JOIN stg_annual v USING (region_code) JOIN d_indicator i ON i.indicator_code = v.indicator_code
GROUP BY ALL
""")
def _(lake):
    rows = panels.staged(lake, "ledger_annual").join(ref.members(lake.spark), "region_code")
    return rows.groupBy("region_code", "member_since", "region_name", "indicator_code").agg(F.count("value").alias("observation_count"))


def csv_text(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches(coalesce({column}::VARCHAR, ''), '[\",\\r\\n]') THEN '\"' || replace({column}::VARCHAR, '\"', '\"\"') || '\"' "
        f"ELSE coalesce({column}::VARCHAR, '') END"
    )


@query("sink_csv", f"SELECT doc_id::VARCHAR || ',' || {csv_text('text')} || ',' || {csv_text('lang')} AS line FROM documents")
def _(lake):
    return sinks.csv_lines(lake.documents, ["doc_id", "text", "lang"])


@query("load_panels", """
SELECT 'national' AS panel, count(*) AS row_count, min(observation_date) AS period_start, max(observation_date) AS period_end FROM mart_overview_all
UNION ALL SELECT 'trends', count(*), min(observation_date), max(observation_date) FROM mart_trends
UNION ALL SELECT 'group', count(*), min(observation_date), max(observation_date) FROM mart_group
UNION ALL SELECT 'monetary', count(*), min(observation_date), max(observation_date) FROM mart_monetary
UNION ALL SELECT 'regional', count(*), min(observation_date), max(observation_date) FROM mart_regional
""")
def _(lake):
    annual = panels.staged(lake, "ledger_annual")
    frames = {
        "national": marts.national_overview(annual, None), "trends": marts.indicator_trends(annual),
        "group": marts.group_comparison(annual, ref.members(lake.spark)),
        "monetary": marts.monetary_conditions(panels.staged(lake, "ledger_monthly")),
        "regional": marts.regional_analysis(panels.staged(lake, "ledger_regional")),
    }
    inventory = dataset_inventory({n: (f, "observation_date") for n, f in frames.items()})
    return inventory.select(F.col("dataset").alias("panel"), "row_count", "period_start", "period_end")


@query("set_reconcile", """
SELECT coalesce(a.code, b.code) AS region_code, CASE WHEN b.code IS NULL THEN 'missing' ELSE 'unexpected' END AS status
FROM (SELECT DISTINCT p_size::VARCHAR AS code FROM part WHERE p_brand <> 'Brand#1') a
FULL JOIN (SELECT DISTINCT c_custkey::VARCHAR AS code FROM customer) b ON a.code = b.code WHERE a.code IS NULL OR b.code IS NULL
""")
def _(lake):
    configured = lake.part.where("p_brand <> 'Brand#1'").select(F.col("p_size").cast("string").alias("region_code"))
    official = lake.customer.select(F.col("c_custkey").cast("string").alias("region_code"))
    return set_difference(configured, official, "region_code")
