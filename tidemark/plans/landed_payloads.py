"""Publisher payloads written by Spark from the panels, one text per request.

They have the shapes of the landed files, so the parsers can be checked on data that grows
with the tables. Every request covers one series or one period and is bounded by the calendar
or the country list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import MONTH_NAMES, normalize_label
from tidemark.plans import panels
from tidemark.sources import reference_tables as ref
from tidemark.sources.lake import Lake

PAGE_ROWS = 20


def indicator_envelopes(lake: Lake) -> DataFrame:
    """`[metadata, records]` per indicator and country, with one empty record at the end."""
    rows = panels.staged(lake, "ledger_annual")

    def record(date, value):
        return F.struct(
            F.struct(F.col("indicator_code").alias("id"), F.col("indicator_name").alias("value")).alias("indicator"),
            F.struct(F.col("region_code").alias("id"), F.col("region_name").alias("value")).alias("country"),
            F.col("region_code").alias("countryiso3code"), date.alias("date"), value.alias("value"),
        )

    filled = rows.select("indicator_code", "region_code", record(F.col("observation_year").cast("string"), F.col("value").cast("double")).alias("r"))
    empty = rows.groupBy("indicator_code", "indicator_name", "region_code", "region_name").agg(
        (F.max("observation_year") + 1).alias("y")
    ).select("indicator_code", "region_code", record(F.col("y").cast("string"), F.lit(None).cast("double")).alias("r"))
    requests = filled.unionByName(empty).groupBy("indicator_code", "region_code").agg(F.collect_list("r").alias("records"))
    meta = F.to_json(F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"), F.size("records").alias("total")))
    body = F.to_json("records", {"ignoreNullFields": "false"})
    return requests.select(
        F.concat(F.lit("["), meta, F.lit(","), body, F.lit("]")).alias("payload"),
        F.concat_ws("-", "indicator_code", "region_code").alias("file"),
    )


def region_pages(lake: Lake) -> DataFrame:
    """Pages of the customer directory of every country, at most `PAGE_ROWS` rows each.

    Pages are cut by key range, so no group is numbered or collected as a whole.
    """
    rows = lake.customer.select(
        panels.country_code("c_nationkey").alias("request"), F.col("c_custkey").cast("string").alias("domain_id"),
        F.col("c_name").alias("domain_name"), F.floor(F.col("c_custkey") / PAGE_ROWS).alias("bucket"),
    )
    pages = rows.groupBy("request", "bucket").agg(F.collect_list(F.struct("domain_id", "domain_name")).alias("rows"))
    last = pages.groupBy("request").agg((F.max("bucket") + 1).cast("int").alias("pages"))
    pages = pages.join(last, "request")
    meta = F.to_json(F.struct(
        (F.col("bucket") + 1).alias("page"), "pages", F.lit(PAGE_ROWS).alias("per_page"), F.size("rows").alias("count"),
        F.lit(0).alias("total"),
    ))
    payload = F.concat(
        F.lit('{"status":"OK","data-availability":"available","data":['), meta, F.lit(","), F.to_json("rows"), F.lit("]}")
    )
    return pages.select("request", (F.col("bucket") + 1).alias("requested_page"), F.col("request").alias("file"), payload.alias("payload"))


def cube_payloads(lake: Lake) -> DataFrame:
    """One sparse cube per variable and year: supplier country × return flag × line status.

    Each has a national total (code 9999) and a missing-value text for empty flags.
    """
    supplier = lake.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    cells = (
        lake.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("year"), "l_returnflag", "l_linestatus")
        .agg(F.sum(F.col("l_quantity").cast("decimal(24,6)")).alias("quantity"))
        .join(supplier, "l_suppkey").groupBy("year", "nation", "l_returnflag", "l_linestatus").agg(F.sum("quantity").alias("quantity"))
    )
    flag = F.array_position(F.lit(["A", "N", "R"]), F.col("l_returnflag"))
    status = F.array_position(F.lit(["F", "O"]), F.col("l_linestatus"))
    year_id = F.col("year") - 1900
    keyed = cells.select(
        "year", (F.col("nation") + 1100).cast("string").alias("region"), flag.cast("string").alias("tv"),
        status.cast("string").alias("tp"), F.col("quantity").cast("double").cast("string").alias("text"), year_id.cast("string").alias("yid"),
    )
    total = keyed.groupBy("year", "yid", "tv", "tp").agg(F.count(F.lit(1)).cast("string").alias("text")).withColumn("region", F.lit("9999"))
    gaps = keyed.select("year", "yid", "region", F.lit("9").alias("tv"), F.lit("1").alias("tp"), F.lit("...").alias("text")).distinct()
    entries = keyed.unionByName(total).unionByName(gaps).groupBy("year", "yid").agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.concat("region", F.lit("1975"), "tv", "yid", "tp"), "text"
        ))).alias("datacontent"), F.collect_set("region").alias("regions"),
    )
    item = lambda v, label: F.struct(v.alias("val"), label.alias("label"))
    fixed = lambda pairs: F.array(*(item(F.lit(v), F.lit(t)) for v, t in pairs))
    variable = F.struct(F.lit("1975").alias("val"), F.lit("Units shipped").alias("label"), F.lit("units").alias("unit"),
                        F.lit("Sum of line quantities").alias("def"), F.lit("").alias("note"))
    return entries.select(
        F.col("yid").alias("file"),
        F.to_json(F.struct(
            F.array(variable).alias("var"), fixed([("1", "accepted"), ("2", "none"), ("3", "returned"), ("9", "-")]).alias("turvar"),
            F.lit("Provinsi").alias("labelvervar"), F.transform("regions", lambda r: item(r, r)).alias("vervar"),
            F.array(item(F.col("yid"), F.concat(F.lit("Year "), F.col("year").cast("string")))).alias("tahun"),
            fixed([("1", "Tahunan"), ("2", "open")]).alias("turtahun"), "datacontent",
        )).alias("payload"),
    )


def rate_documents(lake: Lake) -> DataFrame:
    """An XML text per country and month with the daily rates."""
    stamp = F.concat(F.col("day").cast("string"), F.lit("T00:00:00+07:00"))
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    rate = F.col("rate").cast("string")
    table = tag("Table", F.concat(
        tag("id_subkursasing", F.date_format("day", "yyyyMMdd")), tag("lnk_subkursasing", panels.country_code("nation_key")),
        tag("nil_subkursasing", F.lit("1.00")), tag("beli_subkursasing", rate), tag("jual_subkursasing", rate),
        tag("tgl_subkursasing", stamp), tag("mts_subkursasing", F.lit("USD  ")),
    ))
    return panels.daily_rates(lake).select("nation_key", F.trunc("day", "MM").alias("month"), table.alias("t")).groupBy(
        "nation_key", "month"
    ).agg(F.concat(F.lit("<NewDataSet>"), F.array_join(F.collect_list("t"), ""), F.lit("</NewDataSet>")).alias("payload"))


def decision_rows(lake: Lake) -> DataFrame:
    """Decision table rows as texts, one file per country, each with a header row."""
    month = F.initcap(F.get(F.lit(MONTH_NAMES), F.month("day") - 1))
    rows = panels.daily_rates(lake).where(F.col("decision").isNotNull()).select(
        panels.country_code("nation_key").alias("file"),
        F.concat_ws(" ", F.day("day").cast("string"), month, F.year("day").cast("string")).alias("date_text"),
        F.concat(F.replace(F.col("decision").cast("decimal(10,2)").cast("string"), F.lit("."), F.lit(",")), F.lit(" %")).alias("rate_text"),
    )
    header = lake.nation.select(
        panels.country_code("n_nationkey").alias("file"), F.lit(" Tanggal ").alias("date_text"), F.lit("BI-Rate").alias("rate_text")
    )
    return rows.unionByName(header)


def decision_tables(lake: Lake) -> DataFrame:
    """Decision tables as whole files, one per country: title lines, spare columns in front and behind, and the header in a line and columns of its own."""
    place = F.substring("file", 2, 2).cast("int")
    spare, quoted = F.repeat(F.lit('"note, kept",'), place % 4), F.concat(F.lit('"'), F.col("rate_text"), F.lit('"'))
    titles = F.repeat(F.lit("Report of the board\r\n\r\n"), place % 5)
    rows = decision_rows(lake).withColumn("is_header", normalize_label(F.col("date_text")) == "tanggal")
    line = F.concat(spare, F.col("date_text"), F.lit(",,"), quoted, F.lit(',"a ""remark"""'))
    header = F.max(F.when(F.col("is_header"), F.concat(titles, line)))
    body = F.array_join(F.array_sort(F.collect_list(F.when(~F.col("is_header"), line))), "\n")
    return rows.groupBy("file").agg(F.concat(header, F.lit("\n"), body, F.lit("\n")).alias("payload"))


def series_prefixes(spark) -> DataFrame:
    return ref.literal_table(spark, [("1975", "R.1975"), ("543", "R.543")], "variable_id string, code_prefix string")
