"""Aggregations."""

from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl, exact
from tidemark.functions.text import content_hash
from tidemark.operators import ops, readers, rules, stats
from tidemark.operators.forecast import naive_predictions
from tidemark.operators.order_stats import quantiles
from tidemark.plans import marts, panels
from tidemark.plans.oracle_tables import TABLES
from tidemark.plans.q_joins import annualized, correlation_dataset
from tidemark.plans.registry import query
from tidemark.session import settle

MEASURES = ["orders", "revenue", "discount_percent", "customers", "quantity"]
SEVEN = [*MEASURES, "policy_annual_average", "exchange_annual_average"]


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(lake):
    return rules.duplicate_keys(lake.lineitem, ["l_orderkey", "l_linenumber"])


@query("distinct_coverage", "SELECT o_custkey, count(DISTINCT o_orderpriority) AS priority_coverage FROM orders GROUP BY 1")
def _(lake):
    return lake.orders.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("priority_coverage"))


@query("boolean_sum_check", """
SELECT o_orderdate::DATE AS day, count(DISTINCT o_orderpriority) AS coverage FROM orders GROUP BY 1
HAVING count(DISTINCT o_orderpriority) <> 5 OR count(*) FILTER (o_orderpriority = '1-URGENT') <> 1 OR count(*) FILTER (o_orderpriority = '5-LOW') <> 1
""")
def _(lake):
    rows = lake.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count_distinct("o_orderpriority").alias("coverage"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"),
    )
    return rows.where("coverage <> 5 OR urgent <> 1 OR low <> 1").select("day", "coverage")


@query("daily_to_monthly_mean", "SELECT nation_key, observation_date, R(rate) AS rate FROM month_rate")
def _(lake):
    return panels.monthly_rates(lake)


@query("source_freshness", """
SELECT event_type AS source_code, max(ts) AS last_ingested_at, max(ts)::DATE AS latest_observation_date, date_sub('hour', max(ts), TIMESTAMP '2024-02-01') AS age_hours
FROM events GROUP BY 1
""")
def _(lake):
    return ops.source_freshness(event_observations(lake), now())


def now():
    """The fixed clock the freshness checks are judged by."""
    return F.lit("2024-02-01").cast("timestamp_ntz")


def event_observations(lake):
    return lake.events.select(F.col("event_type").alias("source_code"), F.col("ts").alias("ingested_at"), F.to_date("ts").alias("observation_date"))


@query("indicator_catalog", """
SELECT i.indicator_code, i.indicator_name, i.unit, i.frequency, string_agg(DISTINCT s.source_code, ',' ORDER BY s.source_code) AS source_codes,
       count(f.value) AS observation_count, count(DISTINCT f.region_id) AS region_count, min(observation_date) AS period_start, max(observation_date) AS period_end
FROM d_indicator i LEFT JOIN f_all f USING (indicator_id) LEFT JOIN d_source s ON s.source_id = f.source_id GROUP BY 1, 2, 3, 4
""")
def _(lake):
    return indicator_catalog(lake)


def indicator_catalog(lake, source_code=None, frequency=None):
    """Every catalog entry with its sources, counts and period; entries without data stay."""
    from tidemark.sources import reference_tables as ref

    per_region = panels.facts(lake).groupBy("indicator_id", "source_id", "region_id").agg(
        F.count("value").alias("n"), F.min("observation_date").alias("s"), F.max("observation_date").alias("e")
    )
    facts = per_region.join(ref.sources(lake.spark).select("source_id", "source_code"), "source_id")
    catalog = readers.optional_filters(ref.indicators(lake.spark), frequency=frequency)
    rows = readers.optional_filters(catalog.join(facts, "indicator_id", "left"), source_code=source_code)
    return rows.groupBy("indicator_code", "indicator_name", "unit", "frequency").agg(
        F.array_join(F.array_sort(F.collect_set("source_code")), ",").alias("source_codes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("observation_count"), F.count_distinct("region_id").alias("region_count"),
        F.min("s").alias("period_start"), F.max("e").alias("period_end"),
    )


@query("region_catalog", """
SELECT r.region_code, r.region_name, r.region_level, r.parent_region_code, count(DISTINCT indicator_id) AS indicator_count, count(f.value) AS observation_count,
       min(observation_date) AS period_start, max(observation_date) AS period_end
FROM d_region r LEFT JOIN f_all f USING (region_id) GROUP BY ALL
""")
def _(lake):
    return region_catalog(lake)


def region_catalog(lake, region_level=None):
    """Every region with its indicator and observation counts; regions without data stay."""
    per_region = panels.facts(lake).groupBy("region_id").agg(
        F.count_distinct("indicator_id").alias("i"), F.count("value").alias("n"),
        F.min("observation_date").alias("period_start"), F.max("observation_date").alias("period_end"),
    )
    regions = readers.optional_filters(panels.regions(lake), region_level=region_level)
    return regions.join(per_region, "region_id", "left").select(
        "region_code", "region_name", "region_level", "parent_region_code", F.coalesce("i", F.lit(0)).alias("indicator_count"),
        F.coalesce("n", F.lit(0)).alias("observation_count"), "period_start", "period_end",
    )


@query("annualize", """
SELECT region_code, I(observation_year) AS observation_year, R(sum(policy_rate_percent)::DOUBLE / count(policy_rate_percent)::DOUBLE) AS policy_annual_average,
       R(sum(exchange_rate)::DOUBLE / nullif(count(exchange_rate)::DOUBLE, 0)) AS exchange_annual_average, count(observation_date) AS monetary_month_count
FROM mart_monetary GROUP BY 1, 2
""")
def _(lake):
    return annualized(marts.monetary_conditions(panels.staged(lake, "ledger_monthly")))


@query("monthly_seasonality", """
SELECT I(month(day)) AS calendar_month, count(*) AS observation_count, R(sum(rate)::DOUBLE / count(*)::DOUBLE) AS mean, R(quantile_cont(rate::DOUBLE, 0.5)) AS median,
       R(min(rate)) AS min, R(max(rate)) AS max FROM daily GROUP BY 1
""")
def _(lake):
    return monthly_seasonality(panels.daily_rates(lake).select("day", "rate"), "day", "rate")


def monthly_seasonality(frame, date, value):
    """Count, mean, median, minimum and maximum per calendar month; NULLs left out."""
    rows = settle(frame.where(F.col(value).isNotNull()).select(F.month(date).alias("calendar_month"), exact(value).alias("v")))
    simple = rows.groupBy("calendar_month").agg(
        F.count("v").alias("observation_count"), (dbl(F.sum("v")) / dbl(F.count("v"))).alias("mean"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    middle = quantiles(rows, ["calendar_month"], "v", {"median": 0.5}).drop("non_null_count")
    return simple.join(middle, "calendar_month")


@query("describe_columns", """
SELECT variable, count(value) AS count, R(avg(value)) AS mean, R(stddev_samp(value)) AS std, R(min(value)) AS min, R(max(value)) AS max,
       count(*) - count(value) AS missing_count, R(quantile_cont(value, 0.25)) AS p25, R(quantile_cont(value, 0.5)) AS p50, R(quantile_cont(value, 0.75)) AS p75
FROM (SELECT 'l_quantity' AS variable, l_quantity AS value FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem
      UNION ALL SELECT 'l_tax', CASE WHEN l_returnflag = 'R' THEN l_tax END FROM lineitem) GROUP BY 1
""")
def _(lake):
    frame = lake.lineitem.select("l_quantity", "l_discount", F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("l_tax"))
    return stats.describe_columns(frame, ["l_quantity", "l_discount", "l_tax"])


@query("profile_columns", """
SELECT "column", dtype, count(t) AS non_null_count, count(*) - count(t) AS missing_count, R(100 * (count(*) - count(t))::DOUBLE / count(*)::DOUBLE) AS missing_percent, count(DISTINCT t) AS unique_count
FROM (SELECT 'c_custkey' AS "column", 'bigint' AS dtype, c_custkey::VARCHAR AS t FROM customer
      UNION ALL SELECT 'c_mktsegment', 'string', c_mktsegment FROM customer
      UNION ALL SELECT 'c_nationkey', 'int', c_nationkey::VARCHAR FROM customer
      UNION ALL SELECT 'credit', 'double', CASE WHEN c_acctbal > 0 THEN c_acctbal::VARCHAR END FROM customer) GROUP BY 1, 2
""")
def _(lake):
    frame = lake.customer.withColumn("credit", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    return stats.profile_columns(frame, ["c_custkey", "c_mktsegment", "c_nationkey", "credit"])


EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
_profile = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {kind} AS dtype, count({c}) AS non_null_count, count(*) - count({c}) AS missing_count, "
    f"R(100 * (count(*) - count({c}))::DOUBLE / count(*)::DOUBLE) AS missing_percent, count(DISTINCT {c}) AS unique_count FROM events"
    for c, kind in ((c, f"'{kind}'") for c, kind in EVENT_TYPES.items())
)


@query("profile_table", _profile)
def _(lake):
    return stats.profile_columns(lake.events).withColumn("dtype", F.replace("dtype", F.lit("timestamp_ntz"), F.lit("timestamp")))


INVENTORY_SQL = """
SELECT 'orders' AS dataset, count(*) AS row_count, I(6) AS column_count, min(o_orderdate) AS period_start, max(o_orderdate) AS period_end, I(0) AS missing_cells FROM orders
UNION ALL SELECT 'lineitem', count(*), 11, min(l_shipdate), max(l_shipdate), 0 FROM lineitem
UNION ALL SELECT 'events', count(*), 6, min(ts), max(ts), 0 FROM events
UNION ALL SELECT 'paid', count(*), 2, min(ts), max(ts), count(*) - count(CASE WHEN event_type = 'purchase' THEN value END) FROM events
"""


@query("dataset_inventory", INVENTORY_SQL)
def _(lake):
    paid = lake.events.select("ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("paid"))
    return stats.dataset_inventory({
        "orders": (lake.orders, "o_orderdate"), "lineitem": (lake.lineitem, "l_shipdate"), "events": (lake.events, "ts"), "paid": (paid, "ts"),
    })


@query("complete_row_count", """
SELECT count(*) AS row_count, count(*) FILTER (policy_rate_percent IS NOT NULL AND exchange_rate IS NOT NULL AND exchange_rate_mom_change IS NOT NULL) AS complete_rows FROM mart_monetary
""")
def _(lake):
    rows = marts.monetary_conditions(panels.staged(lake, "ledger_monthly"))
    present = F.col("policy_rate_percent").isNotNull() & F.col("exchange_rate").isNotNull() & F.col("exchange_rate_mom_change").isNotNull()
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(present).alias("complete_rows"))


TABLES["corr_data"] = """
SELECT n.region_code, n.observation_year, orders::DOUBLE AS orders, revenue::DOUBLE AS revenue, discount_percent::DOUBLE AS discount_percent,
       customers::DOUBLE AS customers, quantity::DOUBLE AS quantity, m.policy_annual_average, m.exchange_annual_average
FROM mart_overview_all n LEFT JOIN (
  SELECT region_code, observation_year, sum(policy_rate_percent)::DOUBLE / count(policy_rate_percent)::DOUBLE AS policy_annual_average,
         sum(exchange_rate)::DOUBLE / nullif(count(exchange_rate)::DOUBLE, 0) AS exchange_annual_average
  FROM mart_monetary GROUP BY 1, 2) m USING (region_code, observation_year)
"""
_PAIRS = [(a, b) for i, a in enumerate(SEVEN) for b in SEVEN[i:]]
TABLES["corr_pairs"] = " UNION ALL ".join(
    f"SELECT '{a}' AS left_variable, '{b}' AS right_variable, CASE WHEN count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) >= 3 "
    f"THEN covar_pop({a}, {b}) / nullif(stddev_pop({a}) FILTER ({b} IS NOT NULL) * stddev_pop({b}) FILTER ({a} IS NOT NULL), 0) END AS correlation, "
    f"count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS overlap FROM corr_data" for a, b in _PAIRS
)


@query("pairwise_correlation", """
SELECT left_variable, right_variable, R(correlation) AS correlation, overlap FROM corr_pairs
UNION ALL SELECT right_variable, left_variable, R(correlation), overlap FROM corr_pairs WHERE left_variable <> right_variable
""")
def _(lake):
    return stats.correlation_matrix(stats.correlation_pairs(correlation_dataset(lake), SEVEN))


@query("pairwise_overlap", "SELECT left_variable, right_variable, overlap FROM corr_pairs")
def _(lake):
    return stats.correlation_pairs(correlation_dataset(lake), SEVEN).drop("correlation")


@query("correlation_panel", "SELECT left_variable, right_variable, R(correlation) AS correlation, overlap FROM corr_pairs WHERE left_variable < right_variable OR left_variable > right_variable")
def _(lake):
    pairs = stats.correlation_pairs(correlation_dataset(lake), SEVEN)
    return pairs.where("left_variable <> right_variable")


@query("spearman_correlation", """
SELECT 'l_quantity' AS left_variable, 'l_extendedprice' AS right_variable, R(corr(ra, rb)) AS correlation, count(*) AS overlap FROM (
  SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS ra,
         rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS rb FROM lineitem)
""")
def _(lake):
    return stats.spearman(lake.lineitem, ["l_orderkey", "l_linenumber"], "l_quantity", "l_extendedprice")


TABLES["rank_pairs"] = " UNION ALL ".join(
    f"SELECT '{a}' AS left_variable, '{b}' AS right_variable, CASE WHEN count(*) >= 3 THEN covar_pop(ra, rb) / nullif(stddev_pop(ra) * stddev_pop(rb), 0) END AS correlation, "
    f"count(*) AS overlap FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0::DOUBLE AS ra, "
    f"rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0::DOUBLE AS rb FROM corr_data WHERE {a} IS NOT NULL AND {b} IS NOT NULL)" for a, b in _PAIRS
)


@query("spearman_matrix", """
SELECT left_variable, right_variable, R(correlation) AS correlation, overlap FROM rank_pairs
UNION ALL SELECT right_variable, left_variable, R(correlation), overlap FROM rank_pairs WHERE left_variable <> right_variable
""")
def _(lake):
    return stats.correlation_matrix(stats.spearman_pairs(correlation_dataset(lake), SEVEN))


LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("spearman_matrix_lines", " UNION ALL ".join(
    f"SELECT '{a}' AS left_variable, '{b}' AS right_variable, R(corr(ra, rb)) AS correlation, count(*) AS overlap FROM (SELECT "
    + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS r{s}" for c, s in ((a, "a"), (b, "b")))
    + " FROM lineitem)" for a in LINE_MEASURES for b in LINE_MEASURES
))
def _(lake):
    return stats.correlation_matrix(stats.spearman_pairs(lake.lineitem, LINE_MEASURES))


@query("listwise_correlation", """
SELECT region_code, R(CASE WHEN count(*) >= 2 THEN covar_pop(a, b) / nullif(stddev_pop(a) * stddev_pop(b), 0) END) AS correlation, count(*) AS overlap FROM (
  SELECT region_code, observation_date, max(value::DOUBLE) FILTER (indicator_code = 'M.POLICY') AS a, max(value::DOUBLE) FILTER (indicator_code = 'M.RATE') AS b
  FROM stg_monthly GROUP BY 1, 2) WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1
""")
def _(lake):
    rows = stats.aligned(panels.staged(lake, "ledger_monthly"), ["region_code"], "observation_date", "indicator_code", "value",
                         {"M.POLICY": "a", "M.RATE": "b"})
    return rows.groupBy("region_code").agg(stats.pearson(F.col("a"), F.col("b")).alias("correlation"), F.count(F.lit(1)).alias("overlap"))


TABLES["order_lines"] = """
SELECT l_orderkey AS o_orderkey, sum(l_extendedprice::DECIMAL(24,6))::DOUBLE AS line_revenue, count(*)::DOUBLE AS line_count FROM lineitem GROUP BY 1
"""


@query("iqr_outliers", """
SELECT o_orderkey, variable, R(value) AS value, R(q1 - 1.5 * (q3 - q1)) AS lower_bound, R(q3 + 1.5 * (q3 - q1)) AS upper_bound,
       CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN 'low' ELSE 'high' END AS direction
FROM (SELECT o_orderkey, variable, value, quantile_cont(value, 0.25) OVER v AS q1, quantile_cont(value, 0.75) OVER v AS q3
      FROM (SELECT o_orderkey, 'line_revenue' AS variable, line_revenue AS value FROM order_lines UNION ALL SELECT o_orderkey, 'line_count', line_count FROM order_lines)
      WINDOW v AS (PARTITION BY variable))
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
""")
def _(lake):
    rows = lake.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(exact("l_extendedprice")).alias("line_revenue"), F.count(F.lit(1)).alias("line_count")
    )
    return stats.iqr_outliers(rows, ["o_orderkey"], ["line_revenue", "line_count"])


@query("median_value", "SELECT indicator_code, observation_date, R(quantile_cont(value::DOUBLE, 0.5)) AS median, count(*) AS non_null_count FROM stg_regional GROUP BY 1, 2")
def _(lake):
    return quantiles(panels.staged(lake, "ledger_regional"), ["indicator_code", "observation_date"], "value", {"median": 0.5})


TABLES["month_series"] = "SELECT 'N' || lpad(nation_key::VARCHAR, 2, '0') AS region_code, observation_date, rate AS value FROM month_rate"
TABLES["naive_pred"] = """
SELECT region_code, 'naive_lag_' || k AS model_name, observation_date, actual, prediction FROM (
  SELECT region_code, observation_date, value::DOUBLE AS actual, unnest([1, 12]) AS k,
         unnest([lag(value::DOUBLE, 1) OVER w, lag(value::DOUBLE, 12) OVER w]) AS prediction,
         row_number() OVER (PARTITION BY region_code ORDER BY observation_date DESC) AS from_end, count(*) OVER (PARTITION BY region_code) AS n
  FROM month_series WINDOW w AS (PARTITION BY region_code ORDER BY observation_date))
WHERE from_end <= 24 AND n > 24 + k AND prediction IS NOT NULL
"""
TABLES["naive_metrics"] = """
SELECT region_code, model_name, avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse,
       avg(CASE WHEN actual <> 0 THEN abs(actual - prediction) / abs(actual) END) * 100 AS mape_percent,
       count(*) AS test_observations, min(observation_date) AS test_start, max(observation_date) AS test_end
FROM naive_pred GROUP BY 1, 2
"""


def month_series(lake):
    """Monthly mean rate per country, as the long series the models work on."""
    return panels.monthly_rates(lake).select(
        panels.country_code("nation_key").alias("region_code"), "observation_date", F.col("rate").alias("value")
    )


@query("error_metrics", """
SELECT region_code, model_name, R(mae) AS mae, R(rmse) AS rmse, R(mape_percent) AS mape_percent, test_observations, test_start, test_end FROM naive_metrics
""")
def _(lake):
    predictions = naive_predictions(month_series(lake), ["region_code"], "value", [1, 12], 24)
    return stats.error_metrics(predictions, ["region_code", "model_name"]).drop("interval_coverage_percent")


@query("interval_coverage", """
SELECT region_code, model_name, R(avg(CASE WHEN actual BETWEEN prediction - 50000 AND prediction + 50000 THEN 1.0::DOUBLE ELSE 0 END) * 100) AS interval_coverage_percent
FROM naive_pred GROUP BY 1, 2
""")
def _(lake):
    predictions = naive_predictions(month_series(lake), ["region_code"], "value", [1, 12], 24)
    banded = predictions.withColumns({"lower_bound": F.col("prediction") - 50000, "upper_bound": F.col("prediction") + 50000})
    return stats.error_metrics(banded, ["region_code", "model_name"]).select("region_code", "model_name", "interval_coverage_percent")


SUMMARY_SQL = """
SELECT {keys}, observation_date AS latest_date, R(value) AS latest_value, R(p) AS previous_value, R(value - p) AS absolute_change,
       R(100 * (value - p)::DOUBLE / nullif(abs(p)::DOUBLE, 0)) AS percent_change, R(lo) AS minimum, R(hi) AS maximum
FROM (SELECT *, lag(value) OVER (PARTITION BY {keys} ORDER BY observation_date) AS p, row_number() OVER (PARTITION BY {keys} ORDER BY observation_date DESC) AS rn,
             min(value) OVER (PARTITION BY {keys}) AS lo, max(value) OVER (PARTITION BY {keys}) AS hi FROM {table}) WHERE rn = 1
"""


@query("series_summary", SUMMARY_SQL.format(keys="indicator_code, region_code", table="stg_annual"))
def _(lake):
    return readers.series_summary(settle(panels.staged(lake, "ledger_annual")), ["indicator_code", "region_code"])


@query("cross_section_spread", """
SELECT indicator_code, observation_date, R(max(value) - min(value)) AS spread, max_by(region_name, (value, region_code)) AS highest_region, min_by(region_name, (value, region_code)) AS lowest_region
FROM stg_regional GROUP BY 1, 2
""")
def _(lake):
    order = F.struct("value", "region_code")
    return panels.staged(lake, "ledger_regional").groupBy("indicator_code", "observation_date").agg(
        (F.max("value") - F.min("value")).alias("spread"), F.max_by("region_name", order).alias("highest_region"),
        F.min_by("region_name", order).alias("lowest_region"),
    )


@query("full_coverage_periods", """
SELECT indicator_code, min(observation_date) AS first_complete_date, count(*) AS complete_periods FROM (
  SELECT indicator_code, observation_date FROM stg_regional JOIN supplier ON s_suppkey::VARCHAR = region_code GROUP BY 1, 2
  HAVING count(DISTINCT region_code) = (SELECT count(*) FROM supplier)) GROUP BY 1
""")
def _(lake):
    rows, expected = panels.staged(lake, "ledger_regional"), panels.regions(lake).where("region_level = 'province'")
    return full_coverage(rows, expected)


def full_coverage(rows, expected):
    """Per series the first date on which every expected region reports, and how many such dates."""
    listed = rows.join(expected.select("region_code"), "region_code", "left_semi")
    periods = listed.groupBy("indicator_code", "observation_date").agg(F.count_distinct("region_code").alias("have"))
    complete = periods.where(F.col("have") == F.lit(expected.count()))
    return complete.groupBy("indicator_code").agg(
        F.min("observation_date").alias("first_complete_date"), F.count(F.lit(1)).alias("complete_periods")
    )


@query("series_span", "SELECT indicator_code, region_code, count(*) AS observation_count, min(observation_date) AS period_start, max(observation_date) AS period_end FROM stg_monthly GROUP BY 1, 2")
def _(lake):
    return span(panels.staged(lake, "ledger_monthly"), ["indicator_code", "region_code"])


def span(frame, keys):
    return frame.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observation_count"), F.min("observation_date").alias("period_start"), F.max("observation_date").alias("period_end")
    )


@query("metadata_period", "SELECT indicator_code, min(observation_date) AS period_start, max(observation_date) AS period_end FROM cube_obs GROUP BY 1")
def _(lake):
    from tidemark.plans import landed_payloads as payloads
    from tidemark.sources import landed

    rows = landed.normalize_cube(payloads.cube_payloads(lake), payloads.series_prefixes(lake.spark))
    return span(rows, ["indicator_code"]).drop("observation_count")


TABLES["fingerprints"] = """
SELECT region_code, sha256('[' || string_agg('{"date":"' || observation_date::VARCHAR || '","value":"' || value::VARCHAR || '"}', ',' ORDER BY observation_date) || ']') AS data_fingerprint
FROM month_series GROUP BY 1
"""


def fingerprints(frame, keys, value="value", date="observation_date"):
    """SHA-256 of the ordered (date, value) list of every series; values as exact decimal text.

    Rows are counted by date first, so a list is as long as the calendar at most; a repeated date ends the job with its name.
    """
    dated = frame.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("copies"), F.max(exact(value)).alias("exact"))
    text = F.col(date).cast("string")
    refused = F.raise_error(F.concat_ws(" ", F.lit("duplicate_date"), *(F.col(k).cast("string") for k in keys), text)).cast("string")
    point = F.struct(F.when(F.col("copies") == 1, text).otherwise(refused).alias("date"), F.col("exact").cast("string").alias("value"))
    return dated.groupBy(*keys).agg(F.sha2(F.to_json(F.array_sort(F.collect_list(point))), 256).alias("data_fingerprint"))


@query("series_fingerprint", "SELECT region_code, data_fingerprint FROM fingerprints")
def _(lake):
    return fingerprints(month_series(lake), ["region_code"])


@query("last_updated", "SELECT indicator_code, max(ingested_at) AS last_updated_at FROM stg_annual WHERE indicator_code IN ('A.ORDERS', 'A.REVENUE') GROUP BY 1")
def _(lake):
    rows = panels.staged(lake, "ledger_annual", indicators=["A.ORDERS", "A.REVENUE"])
    return rows.groupBy("indicator_code").agg(F.max("ingested_at").alias("last_updated_at"))


@query("row_content_hash", """
SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}') AS content_hash FROM customer
""")
def _(lake):
    return lake.customer.select("c_custkey", content_hash(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")).alias("content_hash"))
