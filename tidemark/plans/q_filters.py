"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from tidemark.functions import numbers, text
from tidemark.operators import readers, rules
from tidemark.operators.windows import consecutive, neighbours
from tidemark.plans import marts, panels
from tidemark.plans.registry import query
from tidemark.sources import reference_tables as ref

TOKENS = """
CASE user_id % 7 WHEN 0 THEN '' WHEN 1 THEN ' N/A ' WHEN 2 THEN replace(value::VARCHAR, '.', ',') WHEN 3 THEN 'inf'
     WHEN 4 THEN event_type ELSE ' ' || value::VARCHAR || ' ' END
"""


@query("parse_numeric_token", f"""
SELECT event_id, token, CASE WHEN user_id % 7 >= 5 THEN R(value) END AS number,
       CASE WHEN user_id % 7 = 2 THEN CASE WHEN contains(token, ',') THEN 'ambiguous_format' END
            WHEN user_id % 7 = 3 THEN 'not_finite' WHEN user_id % 7 = 4 THEN 'not_numeric' END AS issue
FROM (SELECT event_id, user_id, value, {TOKENS} AS token FROM events)
""")
def _(lake):
    plain = F.col("value").cast("string")
    kind = F.col("user_id") % 7
    token = (
        F.when(kind == 0, "").when(kind == 1, " N/A ").when(kind == 2, F.translate(plain, ".", ",")).when(kind == 3, "inf")
        .when(kind == 4, F.col("event_type")).otherwise(F.concat(F.lit(" "), plain, F.lit(" ")))
    )
    rows = lake.events.select("event_id", token.alias("token"))
    return rows.select("event_id", "token", numbers.numeric_token(F.col("token")).alias("number"),
                       numbers.numeric_token_issue(F.col("token")).alias("issue"))


@query("optional_filters", "SELECT o_orderkey, o_orderpriority, R(o_totalprice) AS o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def _(lake):
    rows = readers.optional_filters(lake.orders, o_orderstatus="F", o_orderpriority="2-HIGH", o_custkey=None)
    return rows.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("date_range_filter", "SELECT o_orderkey, o_orderdate, R(o_totalprice) AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31'")
def _(lake):
    return readers.year_range(lake.orders, 1996, 1997, "o_orderdate").select("o_orderkey", "o_orderdate", "o_totalprice")


@query("mandatory_fields", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders LEFT JOIN line_sums ON l_orderkey = o_orderkey
WHERE o_orderkey IS NULL OR qty IS NULL OR trim(o_orderpriority) = '' OR o_orderpriority IS NULL OR o_orderstatus NOT IN ('F', 'O')
""")
def _(lake):
    lines = lake.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("quantity"))
    rows = lake.orders.join(lines, "o_orderkey", "left")
    found = rules.missing_mandatory(
        rows, ["o_orderkey", "quantity", "o_orderpriority"], extra=[~F.col("o_orderstatus").isin("F", "O")]
    )
    return found.select("o_orderkey", "o_custkey", "o_orderstatus")


RANGE_SQL = """
SELECT s.indicator_code, s.region_code, s.observation_date, R(s.value) AS value, r.violated_rule
FROM {table} s JOIN d_rule r ON r.source_code = s.source_code AND regexp_matches(s.indicator_code, r.pattern)
WHERE (CASE WHEN low_open THEN s.value::DOUBLE <= low ELSE s.value::DOUBLE < low END) OR s.value::DOUBLE > high
"""
RANGE_COLUMNS = ["indicator_code", "region_code", "observation_date", "value", "violated_rule"]


def ranges(lake, source):
    return rules.out_of_range(panels.staged(lake, source), ref.value_rules(lake.spark)).select(*RANGE_COLUMNS)


@query("value_range_rules", RANGE_SQL.format(table="stg_all"))
def _(lake):
    rows = panels.star_join(panels.facts(lake), panels.regions(lake))
    return rules.out_of_range(rows, ref.value_rules(lake.spark)).select(*RANGE_COLUMNS)


@query("code_format", """
SELECT DISTINCT region_code, region_name, region_level, parent_region_code FROM stg_regional
WHERE NOT regexp_full_match(region_code, '[0-9]{2}') OR region_level <> 'province' OR parent_region_code IN ('N00', 'N01')
""")
def _(lake):
    known = ~F.col("parent_region_code").isin("N00", "N01")
    return rules.bad_codes(panels.staged(lake, "ledger_regional"), "^[0-9]{2}$", "province", known)


@query("membership_flag", """
SELECT s.indicator_code, s.region_code, s.observation_date, I(CASE WHEN observation_date >= member_since THEN 1 ELSE 0 END) AS was_member_during_period
FROM stg_annual s JOIN d_member m USING (region_code)
""")
def _(lake):
    rows = marts.group_comparison(panels.staged(lake, "ledger_annual"), ref.members(lake.spark))
    return rows.select("indicator_code", "region_code", "observation_date", "was_member_during_period")


CUSTOMER_YEARS = """
SELECT o_custkey, date_trunc('year', o_orderdate)::DATE AS observation_date, sum(o_totalprice::DECIMAL(24,6)) AS value
FROM orders GROUP BY 1, 2
"""


def customer_years(lake):
    """Customer × year order value: a sparse panel with many gaps, as long as the customer list."""
    return lake.orders.groupBy("o_custkey", F.trunc("o_orderdate", "YEAR").alias("observation_date")).agg(
        F.sum(numbers.exact("o_totalprice")).alias("value")
    )


@query("contiguity_guard", f"""
SELECT o_custkey, observation_date, R(value) AS value, R(CASE WHEN date_sub('year', p, observation_date) = 1 THEN value - v END) AS yoy_absolute_change
FROM (SELECT *, lag(observation_date) OVER w AS p, lag(value) OVER w AS v FROM ({CUSTOMER_YEARS}) WINDOW w AS (PARTITION BY o_custkey ORDER BY observation_date))
""")
def _(lake):
    rows = neighbours(customer_years(lake), ["o_custkey"], {"observation_date": "date", "value": "value"}, following=False)
    change = F.when(consecutive("previous_date", "observation_date"), F.col("value") - F.col("previous_value"))
    return rows.select("o_custkey", "observation_date", "value", change.alias("yoy_absolute_change"))


@query("safe_percent_change", f"""
SELECT o_custkey, observation_date, R(100 * (value - v)::DOUBLE / nullif(abs(v)::DOUBLE, 0)) AS percent_change
FROM (SELECT *, lag(value) OVER w AS v FROM ({CUSTOMER_YEARS}) WINDOW w AS (PARTITION BY o_custkey ORDER BY observation_date))
""")
def _(lake):
    rows = neighbours(customer_years(lake), ["o_custkey"], {"value": "value"}, following=False)
    change = numbers.safe_percent_change(F.col("value"), F.col("previous_value"))
    return rows.select("o_custkey", "observation_date", change.alias("percent_change"))


@query("has_error_flag", "SELECT event_id, I(event_type = 'error' AND value > 50) AS has_error FROM events")
def _(lake):
    message = F.when(F.col("event_type") == "error", F.when(F.col("value") > 50, F.col("props")).otherwise(""))
    return lake.events.select("event_id", (F.length(F.coalesce(message, F.lit(""))) > 0).alias("has_error"))


# The checking engine's expressions cannot look ahead: what the last pattern looks at is matched and put back.
REDACT = "text"
for _pattern in text.SECRET_PATTERNS:
    _body, _, _ahead = _pattern.removeprefix("(?i)").partition("(?=")
    REDACT = f"regexp_replace({REDACT}, '{_body}{_ahead.removesuffix(')')}', '\\1[REDACTED]{_ahead.removesuffix(')')}', 'gi')"


@query("redact_text", f"SELECT doc_id, sha256({REDACT}) AS redacted_hash, I(text <> {REDACT}) AS was_masked FROM documents")
def _(lake):
    masked = text.redact(F.col("text"))
    return lake.documents.select("doc_id", F.sha2(masked, 256).alias("redacted_hash"), (F.col("text") != masked).alias("was_masked"))


@query("kpi_change_choice", """
SELECT indicator_code, region_code, observation_date,
       R(CASE WHEN contains(lower(unit), 'percent') THEN (value - previous_value)::DOUBLE ELSE 100 * (value - previous_value)::DOUBLE / nullif(abs(previous_value)::DOUBLE, 0) END) AS shown_change
FROM mart_trends
""")
def _(lake):
    rows = neighbours(panels.staged(lake, "ledger_annual"), ["indicator_code", "region_code"], {"value": "value"}, following=False)
    value, previous = F.col("value"), F.col("previous_value")
    shown = readers.kpi_change(F.col("unit"), value - previous, numbers.safe_percent_change(value, previous))
    return rows.select("indicator_code", "region_code", "observation_date", shown.alias("shown_change"))
