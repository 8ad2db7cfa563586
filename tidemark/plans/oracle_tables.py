"""Common table expressions for the checking SQL, written against the raw tables."""

from tidemark.sources import reference_tables as ref


def _sql(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def _values(rows, names: str, casts: dict[str, str] | None = None) -> str:
    body = ", ".join("(" + ", ".join(map(_sql, row)) + ")" for row in rows)
    columns = ", ".join(f"CAST({n} AS {casts[n]}) AS {n}" if casts and n in casts else n for n in names.split(", "))
    return f"SELECT {columns} FROM (VALUES {body}) v({names})"


STAGED = """
SELECT i.indicator_code, i.indicator_name, i.unit, i.frequency, r.region_code, r.region_name, r.region_level,
       r.parent_region_code, s.source_code, s.source_name, f.observation_date, year(f.observation_date) AS observation_year,
       quarter(f.observation_date) AS observation_quarter, month(f.observation_date) AS observation_month, f.value, f.ingested_at
FROM {facts} f JOIN d_indicator i USING (indicator_id) JOIN d_region r USING (region_id)
JOIN d_source s ON s.source_id = f.source_id
"""

TABLES = {
    "d_indicator": _values(ref.INDICATORS, "indicator_id, indicator_code, indicator_name, unit, frequency"),
    "d_source": _values(ref.SOURCES, "source_id, source_code, source_name, source_url"),
    "d_member": _values(ref.MEMBERS, "region_code, member_since", {"member_since": "DATE"}),
    "d_rule": _values(ref.VALUE_RULES, "rule_id, source_code, pattern, low, high, low_open, violated_rule",
                      {"low": "DOUBLE", "high": "DOUBLE"}),
    "d_schedule": _values(ref.SCHEDULES, "source_code, frequency, run_after_month, run_after_day, max_ingestion_age_hours, max_observation_lag_days"),
    "d_region": """
SELECT n_nationkey::BIGINT AS region_id, 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS region_code, n_name AS region_name,
       'country' AS region_level, 'R' || n_regionkey AS parent_region_code FROM nation
UNION ALL
SELECT 1000 + s_suppkey, s_suppkey::VARCHAR, s_name, 'province', 'N' || lpad(s_nationkey::VARCHAR, 2, '0') FROM supplier
""",
    "line_sums": """
SELECT l_orderkey, sum(l_discount::DECIMAL(24,6)) AS disc, count(*) AS lines, sum(l_quantity::DECIMAL(24,6)) AS qty
FROM lineitem GROUP BY l_orderkey
""",
    "annual": """
SELECT c_nationkey AS nation_key, date_trunc('year', o_orderdate)::DATE AS observation_date, count(*) AS orders,
       sum(o_totalprice::DECIMAL(24,6)) AS revenue, sum(disc) AS disc, sum(lines) AS lines, sum(qty) AS quantity,
       count(DISTINCT o_custkey) AS customers, max(o_orderdate) AS ingested_at
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN line_sums ON l_orderkey = o_orderkey
GROUP BY 1, 2
""",
    "f_annual": """
SELECT * FROM (
SELECT 1 AS indicator_id, nation_key::BIGINT AS region_id, 1 AS source_id, observation_date, orders::DECIMAL(24,6) AS value, ingested_at FROM annual
UNION ALL SELECT 2, nation_key, 1, observation_date, revenue::DECIMAL(24,6), ingested_at FROM annual
UNION ALL SELECT 3, nation_key, 1, observation_date, round(100 * disc::DOUBLE / lines::DOUBLE, 6)::DECIMAL(24,6), ingested_at FROM annual
UNION ALL SELECT 4, nation_key, 1, observation_date, customers::DECIMAL(24,6), ingested_at FROM annual
UNION ALL SELECT 5, nation_key, 1, observation_date, quantity::DECIMAL(24,6), ingested_at FROM annual
) WHERE value IS NOT NULL
""",
    "regional": """
SELECT l_suppkey, date_trunc('year', l_shipdate)::DATE AS observation_date, sum(l_tax::DECIMAL(24,6)) AS tax, count(*) AS lines,
       sum(l_quantity::DECIMAL(24,6)) AS quantity, max(l_shipdate) AS ingested_at
FROM lineitem GROUP BY 1, 2
""",
    "f_regional": """
SELECT 6 AS indicator_id, 1000 + l_suppkey AS region_id, 2 AS source_id, observation_date,
       round(100 * tax::DOUBLE / lines::DOUBLE, 6)::DECIMAL(24,6) AS value, ingested_at FROM regional
UNION ALL SELECT 7, 1000 + l_suppkey, 2, observation_date, quantity::DECIMAL(24,6), ingested_at FROM regional
""",
    "daily": """
SELECT c_nationkey AS nation_key, o_orderdate::DATE AS day,
       round(sum(o_totalprice::DECIMAL(24,6))::DOUBLE / count(*)::DOUBLE, 6)::DECIMAL(24,6) AS rate, max(o_orderdate) AS ingested_at,
       round((max(o_totalprice::DECIMAL(24,6)) FILTER (o_orderpriority = '1-URGENT'))::DOUBLE / 10000, 2)::DECIMAL(24,6) AS decision
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
""",
    "month_grid": """
SELECT nation_key, unnest(generate_series(min(date_trunc('month', day)), max(date_trunc('month', day)), INTERVAL 1 MONTH))::DATE AS observation_date
FROM daily GROUP BY nation_key
""",
    "month_rate": """
SELECT nation_key, date_trunc('month', day)::DATE AS observation_date, (floor(sum(rate)::DOUBLE / count(*)::DOUBLE * 100 + 0.5) / 100)::DECIMAL(24,6) AS rate,
       max(ingested_at) AS ingested_at FROM daily GROUP BY 1, 2
""",
    "f_monthly": """
SELECT 9 AS indicator_id, nation_key::BIGINT AS region_id, 3 AS source_id, observation_date, rate AS value, ingested_at FROM month_rate
UNION ALL
SELECT 8, g.nation_key, 3, g.observation_date, d.decision, (SELECT max(x.ingested_at) FROM month_rate x WHERE x.nation_key = g.nation_key AND x.observation_date <= g.observation_date)
FROM month_grid g ASOF JOIN (SELECT * FROM daily WHERE decision IS NOT NULL) d
  ON d.nation_key = g.nation_key AND d.day <= last_day(g.observation_date)
""",
    "f_all": "SELECT * FROM f_annual UNION ALL SELECT * FROM f_regional UNION ALL SELECT * FROM f_monthly",
    "stg_annual": STAGED.format(facts="f_annual"),
    "stg_regional": STAGED.format(facts="f_regional"),
    "stg_monthly": STAGED.format(facts="f_monthly"),
    "stg_all": STAGED.format(facts="f_all"),
}
