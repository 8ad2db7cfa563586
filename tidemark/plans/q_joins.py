"""Joins."""

from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl, exact
from tidemark.operators.asof import asof_join
from tidemark.operators.calendar import calendar_slots, missing_slots
from tidemark.operators.rules import uncovered
from tidemark.operators.stats import aligned
from tidemark.plans import marts, panels
from tidemark.plans.registry import query
from tidemark.session import settle
from tidemark.sources import reference_tables as ref


@query("member_join", "SELECT region_code, region_name, member_since, indicator_code, observation_date, R(value) AS value FROM stg_annual JOIN d_member USING (region_code)")
def _(lake):
    rows = panels.staged(lake, "ledger_annual").join(ref.members(lake.spark), "region_code")
    return rows.select("region_code", "region_name", "member_since", "indicator_code", "observation_date", "value")


@query("catalog_left_join", """
SELECT c_custkey, c_name, count(o_orderkey) AS order_count, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2
""")
def _(lake):
    per_customer = lake.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("order_count"), F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
    return lake.customer.join(per_customer, "c_custkey", "left").select(
        "c_custkey", "c_name", F.coalesce("order_count", F.lit(0)).alias("order_count"), "first_order", "last_order"
    )


@query("child_count_mismatch", """
SELECT o_orderkey, max(want) AS expected_children, count(l_orderkey) AS actual_children
FROM (SELECT o_orderkey, I(left(o_orderpriority, 1)) AS want FROM orders) LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey HAVING count(l_orderkey) <> max(want)
""")
def _(lake):
    children = lake.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    parents = lake.orders.select("o_orderkey", F.left("o_orderpriority", F.lit(1)).cast("bigint").alias("expected_children"))
    joined = parents.join(children, "o_orderkey", "left").withColumn("actual_children", F.coalesce("n", F.lit(0)))
    return joined.where("actual_children <> expected_children").drop("n")


@query("uncovered_by_validity", """
SELECT DISTINCT o_custkey, o_orderdate::DATE AS day FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM (
  SELECT o_custkey AS k, min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) p
  WHERE p.k = o.o_custkey AND o.o_orderdate::DATE BETWEEN s AND e)
""")
def _(lake):
    rows = lake.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    periods = rows.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min("day").alias("period_start"), F.max("day").alias("period_end"))
    return uncovered(rows, periods, ["o_custkey"], "day")


@query("asof_month_end", """
SELECT g.nation_key, g.observation_date, R(d.decision) AS decision
FROM month_grid g ASOF LEFT JOIN (SELECT * FROM daily WHERE decision IS NOT NULL) d ON d.nation_key = g.nation_key AND d.day <= last_day(g.observation_date)
""")
def _(lake):
    daily = panels.daily_rates(lake)
    months = daily.groupBy("nation_key", F.trunc("day", "MM").alias("observation_date")).agg(F.lit(1).alias("x")).drop("x")
    months = calendar_slots(months, ["nation_key"], "observation_date", "month")
    months = months.withColumn("month_end", F.last_day("observation_date"))
    joined = asof_join(months, daily.where("decision IS NOT NULL"), ["nation_key"], "month_end", "day", "decision", chunk="YEAR")
    return joined.select("nation_key", "observation_date", "decision")


@query("asof_events", """
SELECT e.event_id, e.user_id, R(p.value) AS last_purchase FROM events e
ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON p.user_id = e.user_id AND p.ts <= e.ts
""")
def _(lake):
    purchases = lake.events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("paid_at"), F.col("value").alias("last_purchase"))
    joined = asof_join(lake.events.select("user_id", "event_id", "ts"), purchases, ["user_id"], "ts", "paid_at", "last_purchase")
    return joined.select("event_id", "user_id", "last_purchase")


@query("calendar_complete", """
SELECT nation_key, observation_date, R(rate) AS rate, I(rate IS NULL) AS is_missing FROM month_grid LEFT JOIN month_rate USING (nation_key, observation_date)
""")
def _(lake):
    full = calendar_slots(panels.monthly_rates(lake), ["nation_key"], "observation_date", "month")
    return full.withColumn("is_missing", F.col("rate").isNull())


CUSTOMER_GRID = """
(SELECT o_custkey, unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH))::DATE AS month FROM (SELECT o_custkey, date_trunc('month', o_orderdate) AS m FROM orders) GROUP BY 1)
"""


@query("missing_calendar_slots", f"""
SELECT g.o_custkey, g.month FROM {CUSTOMER_GRID} g
ANTI JOIN (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month FROM orders) x USING (o_custkey, month)
""")
def _(lake):
    months = lake.orders.select("o_custkey", F.trunc("o_orderdate", "MM").alias("month")).distinct()
    return missing_slots(months, ["o_custkey"], "month", "month")


@query("annual_monthly_join", """
SELECT n.region_code, n.observation_date, I(n.observation_year) AS observation_year, R(n.orders) AS orders, R(n.revenue) AS revenue,
       R(n.discount_percent) AS discount_percent, R(n.customers) AS customers, R(n.quantity) AS quantity,
       R(m.rate) AS policy_annual_average, R(m.fx) AS exchange_annual_average, m.months AS monetary_month_count
FROM mart_overview_all n LEFT JOIN (
  SELECT region_code, observation_year, sum(policy_rate_percent)::DOUBLE / count(policy_rate_percent)::DOUBLE AS rate,
         sum(exchange_rate)::DOUBLE / nullif(count(exchange_rate)::DOUBLE, 0) AS fx, count(observation_date) AS months
  FROM mart_monetary GROUP BY 1, 2) m USING (region_code, observation_year)
""")
def _(lake):
    return correlation_dataset(lake)


def annualized(months):
    """Yearly means of both monthly indicators and the number of months, per region."""
    return months.groupBy("region_code", "observation_year").agg(
        (dbl(F.sum("policy_rate_percent")) / F.nullif(dbl(F.count("policy_rate_percent")), F.lit(0.0))).alias("policy_annual_average"),
        (dbl(F.sum("exchange_rate")) / F.nullif(dbl(F.count("exchange_rate")), F.lit(0.0))).alias("exchange_annual_average"),
        F.count("observation_date").alias("monetary_month_count"),
    )


def correlation_dataset(lake):
    """Annual panel with the annualised monthly panel: one to one, as both sides are grouped by the key."""
    annual = marts.national_overview(panels.staged(lake, "ledger_annual"), None)
    monthly = annualized(marts.monetary_conditions(panels.staged(lake, "ledger_monthly")))
    return annual.join(monthly, ["region_code", "observation_year"], "left").drop("region_name", "indicator_coverage", "last_ingested_at")


@query("align_series", """
SELECT region_code, observation_date, R(a) AS a, R(b) AS b FROM (
  SELECT region_code, observation_date, max(value) FILTER (indicator_code = 'M.POLICY') AS a, max(value) FILTER (indicator_code = 'M.RATE') AS b
  FROM stg_monthly GROUP BY 1, 2) WHERE a IS NOT NULL AND b IS NOT NULL
""")
def _(lake):
    rows = aligned(panels.staged(lake, "ledger_monthly"), ["region_code"], "observation_date", "indicator_code", "value", {"M.POLICY": "a", "M.RATE": "b"})
    return rows.select("region_code", "observation_date", "a", "b")


@query("dim_id_lookup", """
SELECT DISTINCT i.indicator_id, r.region_id, s.source_id, x.indicator_code, x.region_code, x.source_code FROM stg_all x
JOIN d_indicator i USING (indicator_code) JOIN d_region r USING (region_code) JOIN d_source s USING (source_code)
""")
def _(lake):
    codes = panels.star_join(panels.facts(lake), panels.regions(lake)).select("indicator_code", "region_code", "source_code").distinct()
    ids = codes.join(ref.indicators(lake.spark).select("indicator_id", "indicator_code"), "indicator_code")
    ids = ids.join(panels.regions(lake).select("region_id", "region_code"), "region_code")
    return ids.join(ref.sources(lake.spark).select("source_id", "source_code"), "source_code")


@query("code_to_id_map", """
SELECT region_id, indicator_id, observation_date, R(value) AS value FROM cube_obs JOIN d_region ON d_region.region_code = 'N' || lpad((cube_obs.region_code::INT - 1100)::VARCHAR, 2, '0')
JOIN d_indicator ON d_indicator.indicator_code = 'R.1975.TV0.TP0'
""")
def _(lake):
    from tidemark.plans import landed_payloads as payloads
    from tidemark.sources import landed

    rows = landed.normalize_cube(payloads.cube_payloads(lake), payloads.series_prefixes(lake.spark))
    rows = rows.select(
        panels.country_code(F.col("region_code").cast("int") - 1100).alias("region_code"),
        F.lit("R.1975.TV0.TP0").alias("indicator_code"), "observation_date", "value",
    )
    mapped = rows.join(panels.regions(lake).select("region_id", "region_code"), "region_code")
    ids = ref.indicators(lake.spark).select("indicator_id", F.col("indicator_code").alias("known_code"))
    return mapped.join(ids, F.col("indicator_code") == F.col("known_code")).select(
        "region_id", "indicator_id", "observation_date", "value"
    )


@query("attach_names", """
SELECT l_suppkey, s_name, sum(l_quantity) AS quantity FROM lineitem LEFT JOIN (SELECT DISTINCT s_suppkey, s_name FROM supplier) ON s_suppkey = l_suppkey GROUP BY 1, 2
""")
def _(lake):
    totals = lake.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    names = lake.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name").dropDuplicates(["l_suppkey"])
    return totals.join(names, "l_suppkey", "left").select("l_suppkey", "s_name", "quantity")


@query("distinct_metadata_join", """
SELECT m.p_brand, m.p_type, count(*) AS line_count, R(sum(l_quantity)) AS quantity FROM lineitem JOIN part p ON p.p_partkey = l_partkey
JOIN (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size > 10) m ON m.p_brand = p.p_brand AND m.p_type = p.p_type GROUP BY 1, 2
""")
def _(lake):
    listed = lake.part.where("p_size > 10").select("p_brand", "p_type").distinct()
    per_part = lake.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(exact("l_quantity")).alias("q")
    )
    rows = per_part.join(lake.part.select("p_partkey", "p_brand", "p_type"), "p_partkey").join(listed, ["p_brand", "p_type"])
    return rows.groupBy("p_brand", "p_type").agg(F.sum("n").alias("line_count"), F.sum("q").alias("quantity"))


@query("correlated_count", """
SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS pending_count FROM customer
""")
def _(lake):
    pending = lake.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return lake.customer.join(pending, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("pending_count"))


@query("correlated_latest", """
SELECT o_custkey, o_orderkey, o_orderdate, R(o_totalprice) AS o_totalprice FROM orders o WHERE o_orderkey = (
  SELECT l.o_orderkey FROM orders l WHERE l.o_custkey = o.o_custkey ORDER BY l.o_orderdate DESC, l.o_orderkey DESC LIMIT 1)
""")
def _(lake):
    best = lake.orders.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderkey", "o_orderdate", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("b")
    )
    return best.select("o_custkey", "b.*")


@query("history_forecast_timeline", """
SELECT nation_key, observation_date, R(actual) AS actual, R(CASE WHEN observation_date = (max(observation_date) FILTER (actual IS NOT NULL) OVER (PARTITION BY nation_key)) THEN actual ELSE estimate END) AS estimate, R(band) AS band
FROM (SELECT coalesce(h.nation_key, f.nation_key) AS nation_key, coalesce(h.observation_date, f.d) AS observation_date, h.rate AS actual, f.rate AS estimate, 2 * abs(f.rate - h2.rate) AS band
  FROM (SELECT * FROM month_rate WHERE observation_date < DATE '2001-01-01') h
  FULL JOIN (SELECT nation_key, observation_date AS d, rate FROM month_rate WHERE observation_date >= DATE '2000-12-01') f ON f.nation_key = h.nation_key AND f.d = h.observation_date
  LEFT JOIN (SELECT nation_key, observation_date, rate FROM month_rate WHERE observation_date = DATE '2000-12-01') h2 ON h2.nation_key = f.nation_key)
""")
def _(lake):
    rates = settle(panels.monthly_rates(lake))
    history = rates.where("observation_date < DATE'2001-01-01'").withColumnRenamed("rate", "actual")
    base = rates.where("observation_date = DATE'2000-12-01'").select("nation_key", F.col("rate").alias("base"))
    later = rates.where("observation_date >= DATE'2000-12-01'").join(base, "nation_key", "left")
    gap = F.abs(F.col("rate") - F.col("base"))
    forecast = later.select("nation_key", "observation_date", F.col("rate").alias("estimate"),
                            (F.col("base") - gap).alias("lower_bound"), (F.col("base") + gap).alias("upper_bound"))
    return timeline(history, forecast, ["nation_key"])


def timeline(history, forecast, keys):
    """History and forecast on one date axis, joined at the last actual; band = upper − lower."""
    from pyspark.sql import Window

    rows = history.join(forecast, [*keys, "observation_date"], "full_outer")
    last = F.max(F.when(F.col("actual").isNotNull(), F.col("observation_date"))).over(Window.partitionBy(*keys))
    rows = rows.withColumn("__last", last)
    return rows.select(
        *keys, "observation_date", "actual",
        F.when(F.col("observation_date") == F.col("__last"), F.col("actual")).otherwise(F.col("estimate")).alias("estimate"),
        (F.col("upper_bound") - F.col("lower_bound")).alias("band"),
    )
