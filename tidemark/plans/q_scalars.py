"""Scalar functions, each over whole columns of the tables."""

from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.plans import panels
from tidemark.plans.registry import query


@query("blank_text", "SELECT doc_id, I(trim(source) = '' OR trim(text) = '') AS is_blank FROM documents")
def _(lake):
    return lake.documents.select("doc_id", ((F.trim("source") == "") | (F.trim("text") == "")).alias("is_blank"))


@query("pattern_match", "SELECT p_partkey, I(regexp_matches(p_brand, '^Brand#[0-9]$')) AS one_digit, I(NOT regexp_matches(p_type, '^E')) AS not_economy FROM part")
def _(lake):
    return lake.part.select("p_partkey", F.col("p_brand").rlike("^Brand#[0-9]$").alias("one_digit"), (~F.col("p_type").rlike("^E")).alias("not_economy"))


@query("normalize_label", r"""
SELECT doc_id, sha256(lower(trim(regexp_replace(replace(replace('  ' || text || chr(8203), chr(160), ' '), chr(8203), ''), '[ \t\n\x0B\f\r]+', ' ', 'g')))) AS label_hash FROM documents
""")
def _(lake):
    noisy = F.concat(F.lit("  "), F.col("text"), F.lit("\u200b"))
    return lake.documents.select("doc_id", F.sha2(text.normalize_label(noisy), 256).alias("label_hash"))


@query("year_in_label", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE I(year(o_orderdate)) END AS year FROM orders
""")
def _(lake):
    year = F.year("o_orderdate").cast("string")
    label = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("id 1"), year)).when(
        F.col("o_orderkey") % 3 == 1, F.concat(F.lit("Tahun "), year, F.lit(" (12345)"))
    ).otherwise(F.concat(year, F.lit("*")))
    return lake.orders.select("o_orderkey", text.year_in_label(label).alias("year"))


@query("named_month_date", "SELECT o_orderkey, o_orderdate::DATE AS parsed FROM orders")
def _(lake):
    month = F.initcap(F.get(F.lit(text.MONTH_NAMES), F.month("o_orderdate") - 1))
    label = F.concat_ws("  ", F.day("o_orderdate").cast("string"), month, F.year("o_orderdate").cast("string"))
    return lake.orders.select("o_orderkey", text.named_month_date(label).alias("parsed"))


@query("rate_text", "SELECT event_id, CASE WHEN event_type <> 'error' THEN R(value) END AS rate FROM events")
def _(lake):
    label = F.concat(F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")), F.lit(" %"))
    label = F.when(F.col("event_type") == "error", F.lit("rate unknown")).otherwise(label)
    return lake.events.select("event_id", text.rate_text(label).alias("rate"))


@query("iso_local_date", "SELECT event_id, ts::DATE AS local_day FROM events")
def _(lake):
    stamp = F.concat(F.to_date("ts").cast("string"), F.lit("T23:30:00+07:00"))
    return lake.events.select("event_id", dates.iso_local_date(stamp).alias("local_day"))


@query("whole_units", """
SELECT o_orderkey, l_linenumber, l_shipdate, I(trunc(m * side / 12.0)) AS years, m * side AS months, I(trunc(epoch(l_shipdate - o_orderdate) / 3600)) AS hours
FROM (SELECT *, CASE WHEN l_shipdate < o_orderdate THEN -1 ELSE 1 END AS side,
        (year(b) - year(a)) * 12 + month(b) - month(a) - CASE WHEN day(b) < day(a) THEN 1 ELSE 0 END AS m
      FROM (SELECT *, least(o_orderdate, l_shipdate) AS a, greatest(o_orderdate, l_shipdate) AS b FROM lineitem JOIN orders ON o_orderkey = l_orderkey))
""")
def _(lake):
    rows = lake.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate").join(lake.orders, "o_orderkey")
    return rows.select("o_orderkey", "l_linenumber", "l_shipdate", *(
        dates.whole_units(u, F.col("o_orderdate"), F.col("l_shipdate")).alias(n) for u, n in (("YEAR", "years"), ("MONTH", "months"), ("HOUR", "hours"))
    ))


@query("day_rules", "SELECT o_orderkey, I(day(o_orderdate) = 1) AS first_of_month, I(day(o_orderdate) = 1 AND month(o_orderdate) = 1) AS first_of_year FROM orders")
def _(lake):
    first = F.day("o_orderdate") == 1
    return lake.orders.select("o_orderkey", first.alias("first_of_month"), (first & (F.month("o_orderdate") == 1)).alias("first_of_year"))


@query("month_bounds", """
SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month_start, last_day(o_orderdate) AS month_end, (date_trunc('month', o_orderdate) - INTERVAL 1 DAY)::DATE AS last_complete_month_end FROM orders
""")
def _(lake):
    return lake.orders.select(
        "o_orderkey", dates.month_start("o_orderdate").alias("month_start"), F.last_day("o_orderdate").alias("month_end"),
        dates.last_complete_month_end(F.col("o_orderdate")).alias("last_complete_month_end"),
    )


@query("date_parts", "SELECT o_orderkey, I(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)) AS date_id, I(year(o_orderdate)) AS year, I(quarter(o_orderdate)) AS quarter, I(month(o_orderdate)) AS month FROM orders")
def _(lake):
    day = F.to_date("o_orderdate")
    return lake.orders.select("o_orderkey", dates.date_id(day).alias("date_id"), F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"))


@query("local_date", "SELECT event_id, (ts + INTERVAL 7 HOUR)::DATE AS local_day FROM events")
def _(lake):
    return lake.events.select("event_id", dates.local_date(F.col("ts"), "Asia/Jakarta").alias("local_day"))


@query("shift_timestamps", "SELECT event_id, ts - INTERVAL 25200 SECOND AS corrected FROM events")
def _(lake):
    return lake.events.select("event_id", dates.shift_seconds(F.col("ts"), -25200).alias("corrected"))


@query("guarded_arithmetic", """
SELECT c_custkey, R(abs(c_acctbal)) AS size, R(100 / nullif(round(c_acctbal, -3), 0)) AS share, CASE WHEN c_acctbal < 0 THEN 'debit' ELSE 'credit' END AS side, coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, 'none') AS segment FROM customer
""")
def _(lake):
    balance = F.col("c_acctbal")
    return lake.customer.select(
        "c_custkey", F.abs(balance).alias("size"), numbers.ratio(F.lit(100), F.round(balance, -3)).alias("share"),
        F.when(balance < 0, "debit").otherwise("credit").alias("side"),
        F.coalesce(F.when(balance > 0, F.col("c_mktsegment")), F.lit("none")).alias("segment"),
    )


@query("least_greatest", "SELECT o_custkey, least(min(o_orderdate), TIMESTAMP '1996-01-01') AS widened_start, greatest(max(o_orderdate), TIMESTAMP '2001-01-01') AS widened_end FROM orders GROUP BY 1")
def _(lake):
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    return lake.orders.groupBy("o_custkey").agg(
        F.least(F.min("o_orderdate"), at("1996-01-01")).alias("widened_start"), F.greatest(F.max("o_orderdate"), at("2001-01-01")).alias("widened_end")
    )


@query("text_hash", "SELECT doc_id, sha256(text) AS text_hash, sha256(doc_id || ':' || lang) AS key_hash FROM documents")
def _(lake):
    return lake.documents.select("doc_id", F.sha2("text", 256).alias("text_hash"), text.key_hash(F.col("doc_id").cast("string"), F.col("lang")).alias("key_hash"))


@query("finite_check", "SELECT event_id, I(user_id % 3 = 0 OR (user_id % 3 = 2 AND value IS NOT NULL)) AS is_finite FROM events")
def _(lake):
    kind = F.col("user_id") % 3
    value = F.when(kind == 1, F.when(F.col("value") > 10, float("inf")).otherwise(float("nan"))).otherwise(F.col("value"))
    return lake.events.select("event_id", numbers.is_finite(value).alias("is_finite"))


@query("ordered_text_list", "SELECT l_suppkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, I(len(string_split(string_agg(DISTINCT l_returnflag, ','), ','))) AS flag_count FROM lineitem GROUP BY 1")
def _(lake):
    flags = lake.lineitem.groupBy("l_suppkey").agg(F.listagg_distinct("l_returnflag", F.lit(",")).alias("raw"))
    ordered = F.array_join(F.array_sort(F.split("raw", ",")), ",")
    return flags.select("l_suppkey", ordered.alias("flags"), F.size(F.split("raw", ",")).alias("flag_count"))


@query("year_to_date", "SELECT o_orderkey, date_trunc('year', o_orderdate)::DATE AS annual_date FROM orders")
def _(lake):
    return lake.orders.select("o_orderkey", F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("annual_date"))


@query("display_value", """
SELECT indicator_code, region_code, observation_date, CASE WHEN unit = 'percent' THEN t || '%' WHEN unit = 'current USD' THEN 'US$' || t ELSE t END AS shown FROM (
  SELECT *, translate(CASE WHEN f LIKE '%.00' THEN left(f, len(f) - 3) WHEN f LIKE '%0' THEN left(f, len(f) - 1) ELSE f END, ',.', '.,') AS t FROM (
    SELECT *, format('{:,.2f}', value::DOUBLE) AS f FROM stg_annual))
""")
def _(lake):
    rows = panels.staged(lake, "ledger_annual")
    return rows.select("indicator_code", "region_code", "observation_date", text.display_value(F.col("value"), F.col("unit")).alias("shown"))


@query("signed_text", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '+' ELSE '' END || translate(CASE WHEN f LIKE '%.00' THEN left(f, len(f) - 3) WHEN f LIKE '%0' THEN left(f, len(f) - 1) ELSE f END, ',.', '.,') || ' pp' AS shown
FROM (SELECT *, format('{:,.2f}', c_acctbal) AS f FROM customer)
""")
def _(lake):
    return lake.customer.select("c_custkey", text.signed_text(F.col("c_acctbal"), " pp").alias("shown"))


@query("reason_text", "SELECT event_id, printf('change %.6f; threshold %.3f', value, value / 2) AS reason FROM events")
def _(lake):
    return lake.events.select("event_id", F.format_string("change %.6f; threshold %.3f", "value", F.col("value") / 2).alias("reason"))


@query("json_reasons", """
SELECT event_id, I(len(CASE WHEN event_type = 'error' THEN ['k', 'type'] ELSE [] END)) AS reason_count, R((props->>'k')::DOUBLE) AS k_threshold, I(event_type <> 'view') AS is_valid FROM events
""")
def _(lake):
    reasons = F.when(F.col("event_type") == "error", F.array(F.lit("k"), F.lit("type"))).otherwise(F.array().cast("array<string>"))
    document = F.to_json(F.struct(reasons.alias("reasons"), F.from_json("props", "map<string,double>").alias("thresholds")))
    document = F.when(F.col("event_type") == "view", F.concat(F.lit('{"thresholds":'), F.col("props"), F.lit("}"))).otherwise(document)
    parsed = F.from_json(document, "struct<reasons:array<string>,thresholds:map<string,double>>")
    return lake.events.select(
        "event_id", F.size(F.coalesce(parsed["reasons"], F.array().cast("array<string>"))).alias("reason_count"),
        parsed["thresholds"]["k"].alias("k_threshold"), (parsed["reasons"].isNotNull() & parsed["thresholds"].isNotNull()).alias("is_valid"),
    )
