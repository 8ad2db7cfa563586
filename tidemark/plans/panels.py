"""Indicator panels derived from the order tables, and the star they are stored in.

Three publishers: annual values per country (nation), annual values per province (supplier)
and monthly values per country. Every derivation aggregates on the fine key first
(customer, supplier), so a key holding a third of all rows is combined map-side and only
one row per key and period goes into the next shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start, year_start
from tidemark.functions.numbers import dbl, exact
from tidemark.operators.asof import asof_last
from tidemark.operators.calendar import calendar_slots
from tidemark.schema import VALUE
from tidemark.sources import reference_tables as ref
from tidemark.sources.lake import Lake

SUPPLIER_BASE = 1000


def country_code(nation_key: str | Column) -> Column:
    key = F.col(nation_key) if isinstance(nation_key, str) else nation_key
    return F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))


def millionths(column: str) -> Column:
    """Line measures in whole millionths, the precision of VALUE: their sums are exact and stay cheap longs."""
    return F.round(F.col(column) * 1_000_000).cast("bigint")


def from_millionths(column: str) -> Column:
    return F.col(column).cast("decimal(22,0)") * F.lit(Decimal("0.000001"))


def order_day() -> Column:
    return F.to_date("o_orderdate").alias("day")


def nation_keys(regions: Sequence[str] | None) -> list[int] | None:
    """The nations among some region codes; None stands for all."""
    return None if regions is None else [int(code[1:]) for code in regions if re.fullmatch(r"N\d+", code)]


def customer_nation(lake: Lake, regions: Sequence[str] | None = None) -> DataFrame:
    rows = lake.customer
    if regions is not None:
        rows = rows.where(F.col("c_nationkey").isin(nation_keys(regions)))
    return rows.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_key"))


def orders_of(lake: Lake, regions: Sequence[str] | None, years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """The orders of some regions and whole years: bounds on the raw date reach the scan, and orders of
    other customers are gone before anything is joined or summed."""
    rows, (first, last) = lake.orders, years
    if first is not None:
        rows = rows.where(F.col("o_orderdate") >= F.lit(date(first, 1, 1)))
    if last is not None:
        rows = rows.where(F.col("o_orderdate") < F.lit(date(last + 1, 1, 1)))
    return rows if regions is None else rows.join(customer_nation(lake, regions), "o_custkey", "left_semi")


LINE_CELLS = {3, 5}


def _no_lines(orders: DataFrame) -> DataFrame:
    return orders.withColumns({c: F.lit(None).cast("bigint") for c in ("discount_sum", "line_count", "quantity")})


def annual_wide(lake: Lake, regions: Sequence[str] | None = None, years: tuple[int | None, int | None] = (None, None), with_lines: bool = True) -> DataFrame:
    """Nation × year: orders, revenue, discount sum and count, customers, units. Without lines, lineitem is not read."""
    lines = lake.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(millionths("l_discount")).alias("discount_sum"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum(millionths("l_quantity")).alias("quantity"),
    )
    orders = orders_of(lake, regions, years).select("o_orderkey", "o_custkey", year_start("o_orderdate").alias("observation_date"),
                                                   exact("o_totalprice").alias("price"), "o_orderdate")
    per_customer = (
        (orders.join(lines, "o_orderkey", "left") if with_lines else _no_lines(orders))
        .groupBy("o_custkey", "observation_date")
        .agg(
            F.count(F.lit(1)).alias("orders"), F.sum("price").alias("revenue"),
            F.sum("discount_sum").alias("discount_sum"), F.sum("line_count").alias("line_count"),
            F.sum("quantity").alias("quantity"), F.max("o_orderdate").alias("ingested_at"),
        )
    )
    return (
        per_customer.join(customer_nation(lake, regions), "o_custkey")
        .groupBy("nation_key", "observation_date")
        .agg(
            F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"),
            F.sum("discount_sum").alias("discount_sum"), F.sum("line_count").alias("line_count"),
            F.count(F.lit(1)).alias("customers"), F.sum("quantity").alias("quantity"),
            F.max("ingested_at").alias("ingested_at"),
        )
    )


def _long(wide: DataFrame, region_id: Column, source: str, cells: dict[int, Column]) -> DataFrame:
    entries = F.array(*(
        F.struct(F.lit(i).alias("indicator_id"), F.lit(ref.SOURCE_IDS[source]).alias("source_id"), c.cast(VALUE).alias("value"))
        for i, c in cells.items()
    ))
    return (
        wide.select(region_id.cast("long").alias("region_id"), "observation_date", "ingested_at",
                    F.explode(entries).alias("cell"))
        .where(F.col("cell.value").isNotNull())
        .select(F.col("cell.indicator_id").alias("indicator_id"), "region_id",
                F.col("cell.source_id").alias("source_id"), "observation_date",
                F.col("cell.value").alias("value"), "ingested_at")
    )


def _wanted(cells: dict[int, Column], indicators: Sequence[str] | None) -> dict[int, Column]:
    ids = {code: i for i, code, *_ in ref.INDICATORS}
    return cells if indicators is None else {i: c for i, c in cells.items() if i in {ids[code] for code in indicators}}


def annual_facts(lake: Lake, indicators: Sequence[str] | None = None, regions: Sequence[str] | None = None,
                 years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    discount = F.round(100 * dbl(from_millionths("discount_sum")) / dbl("line_count"), 6)
    cells = _wanted({
        1: F.col("orders"), 2: F.col("revenue"), 3: discount, 4: F.col("customers"), 5: from_millionths("quantity"),
    }, indicators)
    wide = annual_wide(lake, regions, years, with_lines=bool(LINE_CELLS & set(cells)))
    return _long(wide, F.col("nation_key"), "ledger_annual", cells)


def regional_facts(lake: Lake, indicators: Sequence[str] | None = None, regions: Sequence[str] | None = None,
                   years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    lines, (first, last) = lake.lineitem, years
    if regions is not None:
        lines = lines.where(F.col("l_suppkey").isin([int(code) for code in regions if code.isdigit()]))
    if first is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(date(first, 1, 1)))
    if last is not None:
        lines = lines.where(F.col("l_shipdate") < F.lit(date(last + 1, 1, 1)))
    wide = lines.groupBy("l_suppkey", year_start("l_shipdate").alias("observation_date")).agg(
        F.sum(millionths("l_tax")).alias("tax_sum"), F.count(F.lit(1)).alias("line_count"),
        F.sum(millionths("l_quantity")).alias("quantity"), F.max("l_shipdate").alias("ingested_at"),
    )
    tax = F.round(100 * dbl(from_millionths("tax_sum")) / dbl("line_count"), 6)
    return _long(wide, SUPPLIER_BASE + F.col("l_suppkey"), "ledger_regional", _wanted({6: tax, 7: from_millionths("quantity")}, indicators))


def daily_rates(lake: Lake, regions: Sequence[str] | None = None) -> DataFrame:
    """Nation × day mean order value, exact to six digits."""
    per_customer = orders_of(lake, regions).groupBy("o_custkey", order_day()).agg(
        F.sum(exact("o_totalprice")).alias("price"), F.count(F.lit(1)).alias("orders"),
        F.max("o_orderdate").alias("ingested_at"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", exact("o_totalprice"))).alias("urgent"),
    )
    return per_customer.join(customer_nation(lake, regions), "o_custkey").groupBy("nation_key", "day").agg(
        F.round(dbl(F.sum("price")) / dbl(F.sum("orders")), 6).cast(VALUE).alias("rate"),
        F.max("ingested_at").alias("ingested_at"),
        F.round(dbl(F.max("urgent")) / 10000, 2).cast(VALUE).alias("decision"),
    )


def mean_rate() -> Column:
    """Aggregate: mean of the available daily rates, rounded half up to the cent."""
    cents = dbl(F.sum("rate")) / dbl(F.count("rate")) * 100
    return (F.floor(cents + 0.5).cast("double") / 100).cast(VALUE)


def monthly_rates(lake: Lake) -> DataFrame:
    return daily_rates(lake).groupBy("nation_key", month_start("day").alias("observation_date")).agg(mean_rate().alias("rate"))


def monthly_wide(lake: Lake, regions: Sequence[str] | None = None) -> DataFrame:
    """Nation × month: mean of the daily rates, and the decision in force at month end."""
    daily = daily_rates(lake, regions)
    months = daily.groupBy("nation_key", month_start("day").alias("observation_date")).agg(
        mean_rate().alias("rate"), F.max("ingested_at").alias("ingested_at"),
        F.max_by("decision", F.when(F.col("decision").isNotNull(), F.col("day"))).alias("decision"),
    )
    full = calendar_slots(months, ["nation_key"], "observation_date", "month")
    return asof_last(full, ["nation_key"], "observation_date", {"decision": "policy", "ingested_at": "seen_at"})


def monthly_facts(lake: Lake, indicators: Sequence[str] | None = None, regions: Sequence[str] | None = None,
                  years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """The decision in force may be older than the first year, so years are cut after it is carried on."""
    wide, (first, last) = monthly_wide(lake, regions).withColumn("ingested_at", F.col("seen_at")), years
    if first is not None:
        wide = wide.where(F.year("observation_date") >= first)
    if last is not None:
        wide = wide.where(F.year("observation_date") <= last)
    return _long(wide, F.col("nation_key"), "ledger_monthly", _wanted({8: F.col("policy"), 9: F.col("rate")}, indicators))


FACTS = {"ledger_annual": annual_facts, "ledger_regional": regional_facts, "ledger_monthly": monthly_facts}


def facts(lake: Lake, **limits) -> DataFrame:
    """Facts of all publishers; `indicators`, `regions` (codes) and `years` (first, last) limit what is read and summed."""
    return annual_facts(lake, **limits).unionByName(regional_facts(lake, **limits)).unionByName(monthly_facts(lake, **limits))


def regions(lake: Lake) -> DataFrame:
    countries = lake.nation.select(
        F.col("n_nationkey").cast("long").alias("region_id"), country_code("n_nationkey").alias("region_code"),
        F.col("n_name").alias("region_name"), F.lit("country").alias("region_level"),
        F.concat(F.lit("R"), F.col("n_regionkey")).alias("parent_region_code"),
    )
    provinces = lake.supplier.select(
        (SUPPLIER_BASE + F.col("s_suppkey")).alias("region_id"), F.col("s_suppkey").cast("string").alias("region_code"),
        F.col("s_name").alias("region_name"), F.lit("province").alias("region_level"),
        country_code("s_nationkey").alias("parent_region_code"),
    )
    return countries.unionByName(provinces)


def star_join(fact: DataFrame, region: DataFrame, source: str | None = None) -> DataFrame:
    """Facts with the attributes of all four dimensions; one publisher, or all of them."""
    spark = fact.sparkSession
    source_dim = ref.sources(spark)
    if source:
        fact = fact.where(F.col("source_id") == ref.SOURCE_IDS[source])
        source_dim = source_dim.where(F.col("source_code") == source)
    return (
        fact.join(ref.indicators(spark), "indicator_id")
        .join(region, "region_id")
        .join(source_dim, "source_id")
        .select(
            "indicator_code", "indicator_name", "unit", "frequency", "region_code", "region_name",
            "region_level", "parent_region_code", "source_code", "source_name", "observation_date",
            F.year("observation_date").alias("observation_year"), F.quarter("observation_date").alias("observation_quarter"),
            F.month("observation_date").alias("observation_month"), "value", "ingested_at",
        )
    )


def staged(lake: Lake, source: str, **limits) -> DataFrame:
    """The star of one publisher; limits as in `facts`."""
    return star_join(FACTS[source](lake, **limits), regions(lake), source)
