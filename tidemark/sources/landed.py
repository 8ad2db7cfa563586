"""Landed publisher files: envelopes and records to typed rows.

Readers return a frame with a `payload` text column and the `file` it came from; parsers turn
payloads into records, and `*_issues` list what breaks the expected shape. All parsing is
`from_json` / `from_xml` with declared schemas.

`checked_*` functions return every row with an `issue` (NULL: clean). `rejects` keeps the others,
and `require_clean` takes the clean ones and ends the job if there is any other, so no record is
lost without a word. The `normalize_*` functions require clean input.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_local_date
from tidemark.functions.numbers import numeric_token, numeric_token_issue
from tidemark.functions.text import (
    named_month_date, normalize_label, rate_text, series_code, series_name, year_in_label,
)


def require_clean(checked: DataFrame, *shown: str) -> DataFrame:
    """The rows without an issue. The first one with an issue raises, with the columns `shown` in the message."""
    about = F.concat_ws(" ", F.col("issue"), *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in shown))
    # A filter, since a column that nobody reads would be pruned with its error.
    return checked.where(F.when(F.col("issue").isNull(), F.lit(True)).otherwise(F.raise_error(about).cast("boolean"))).drop("issue")


def rejects(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("issue").isNotNull())


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_name").alias("file")
    )


def snapshot_manifest(files: DataFrame) -> DataFrame:
    """file, byte count and SHA-256 of binary rows (`path`, `content`)."""
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.octet_length("content").cast("long").alias("byte_count"),
        F.sha2("content", 256).alias("sha256"),
    )


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


RECORD = (
    "array<struct<indicator:struct<id:string,value:string>,country:struct<id:string,value:string>,"
    "countryiso3code:string,date:string,value:double>>"
)


# The fields of one indicator record with their types, and those that may be there besides.
RECORD_SHAPE = {"indicator": ["OBJECT"], "country": ["OBJECT"], "countryiso3code": ["STRING"], "date": ["STRING"], "value": ["BIGINT", "DECIMAL", "DOUBLE", "VOID"]}
RECORD_OPTIONAL = ["unit", "obs_status", "decimal"]


def shape_issues(record: Column, shape: dict[str, list[str]], optional: list[str]) -> Column:
    """What a VARIANT has that its shape does not: `not_an_object`, or `missing:`, `unexpected:` and `type:` with the field, sorted.

    An empty list in `shape` allows every type.
    """
    expected = F.lit(list(shape))

    def listed(entries: Column) -> Column:
        keys = F.map_keys(entries)
        missing = F.transform(F.array_except(expected, keys), lambda f: F.concat(F.lit("missing:"), f))
        extra = F.transform(F.array_except(keys, F.lit([*shape, *optional])), lambda f: F.concat(F.lit("unexpected:"), f))
        wrong = F.array_compact(F.array(*(
            F.when(~F.regexp_extract(F.schema_of_variant(entries[f]), "^[A-Z]+", 0).isin(kinds), f"type:{f}")
            for f, kinds in shape.items() if kinds
        )))
        return F.array_sort(F.concat(missing, extra, wrong))

    entries = F.transform(F.array(record), lambda r: r.try_cast("map<string,variant>"))
    return F.get(F.transform(entries, lambda e: F.when(e.isNull(), F.array(F.lit("not_an_object"))).otherwise(listed(e))), F.lit(0))


def record_drift(payloads: DataFrame) -> DataFrame:
    """file, at (position in its list) and issue: every record whose fields or their types are not those of RECORD_SHAPE."""
    parts = _split_envelope(payloads).where(F.coalesce(_good_envelope(), F.lit(False)))
    records = F.try_variant_get(F.try_parse_json(F.get("__parts", F.lit(1))), F.lit("$"), "array<variant>")
    each = parts.select("file", F.posexplode(records).alias("at", "record"))
    return each.select("file", "at", F.explode(shape_issues(F.col("record"), RECORD_SHAPE, RECORD_OPTIONAL)).alias("issue"))


def _split_envelope(payloads: DataFrame) -> DataFrame:
    parts = F.from_json("payload", "array<string>")
    return payloads.withColumn("__parts", F.when(F.col("payload").startswith("["), parts))


def _good_envelope():
    return (
        (F.size("__parts") == 2) & F.coalesce(F.get("__parts", 0), F.lit("")).startswith("{")
        & F.coalesce(F.get("__parts", 1), F.lit("")).startswith("[")
    )


def indicator_records(payloads: DataFrame) -> DataFrame:
    """Records of the two-part envelopes `[metadata, records]`; a payload of another shape raises."""
    split = _split_envelope(payloads).select("file", "__parts", F.when(~F.coalesce(_good_envelope(), F.lit(False)), "bad_envelope").alias("issue"))
    good = require_clean(split, "file")
    return good.select("file", F.explode(F.from_json(F.get("__parts", 1), RECORD)).alias("r")).select(
        "file", F.col("r.indicator.id").alias("indicator_code"), F.col("r.countryiso3code").alias("region_code"),
        F.col("r.country.value").alias("region_name"), F.col("r.date").alias("period"), F.col("r.value").alias("value"),
    )


def envelope_issues(payloads: DataFrame) -> DataFrame:
    return _split_envelope(payloads).where(~F.coalesce(_good_envelope(), F.lit(False))).select("file", F.lit("bad_envelope").alias("issue"))


def checked_records(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Records with a value and their catalog entry, the year text as 1 January, and what is wrong with them."""
    year = F.when(F.col("period").rlike("^[0-9]{4}$"), F.col("period").try_cast("int"))
    value = F.col("value").try_cast("decimal(24,6)")
    issue = (
        F.when(F.col("indicator_name").isNull(), "unknown_code").when(year.isNull() | (year < 1), "bad_period")
        .when(F.isnull("region_code") | (F.trim("region_code") == ""), "no_region").when(value.isNull(), "bad_value")
    )
    return records.where(F.col("value").isNotNull()).join(catalog, "indicator_code", "left").select(
        "indicator_code", "indicator_name", "unit", "frequency", "region_code", "region_name", "period",
        F.when(year >= 1, F.make_date(year, F.lit(1), F.lit(1))).alias("observation_date"), value.alias("value"), issue.alias("issue"),
    )


def normalize_records(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Drop empty values, attach the catalog entry, year text to 1 January; any bad record raises."""
    return require_clean(checked_records(records, catalog), "indicator_code", "region_code", "period").drop("period")


def unknown_codes(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Indicator codes the catalog does not list."""
    return records.select("indicator_code").distinct().join(catalog, "indicator_code", "left_anti")


PAGE = "struct<status:string,`data-availability`:string,data:array<string>>"
PAGE_META = "struct<page:int,pages:int,per_page:int,count:int,total:int>"


def _pages(payloads: DataFrame) -> DataFrame:
    parsed = payloads.withColumn("__p", F.from_json("payload", PAGE))
    return parsed.select(
        "request", "requested_page", "file", F.col("__p.status").alias("status"),
        F.col("__p.data-availability").alias("availability"),
        F.from_json(F.get("__p.data", 0), PAGE_META).alias("meta"), F.get("__p.data", 1).alias("rows_text"),
    )


def paginated_records(payloads: DataFrame) -> DataFrame:
    """Rows of all pages as maps. Needs columns request, requested_page, file, payload. A bad page, or one that was not asked for, raises."""
    rows = F.from_json("rows_text", "array<map<string,string>>")
    pages = _pages(payloads).select(F.col("meta.page").alias("page"), "request", "requested_page", rows.alias("rows"), F.when(~_good_page(), "bad_page").alias("issue"))
    return require_clean(pages, "request", "requested_page").select("request", "page", F.explode("rows").alias("row"))


def _good_page() -> Column:
    good = (
        (F.upper("status") == "OK") & (F.col("availability") == "available") & F.col("meta").isNotNull()
        & F.col("meta.page").between(1, F.col("meta.pages")) & (F.col("meta.page") == F.col("requested_page"))
    )
    return F.coalesce(good, F.lit(False))


def page_issues(payloads: DataFrame) -> DataFrame:
    """Bad pages, and requests whose pages do not make up the announced number."""
    checked = _pages(payloads).withColumn("valid", _good_page())
    bad = checked.where(~F.col("valid")).select("request", F.lit("bad_page").alias("issue"))
    counts = checked.groupBy("request").agg(
        F.count_distinct(F.when(F.col("valid"), F.col("meta.page"))).alias("have"), F.max("meta.pages").alias("want")
    )
    short = counts.where(~F.col("have").eqNullSafe(F.col("want"))).select("request", F.lit("incomplete").alias("issue"))
    return bad.unionByName(short)


_ITEM = "array<struct<val:string,label:string>>"
CUBE = (
    "struct<var:array<struct<val:string,label:string,unit:string,def:string,note:string>>,"
    f"turvar:{_ITEM},labelvervar:string,vervar:{_ITEM},tahun:{_ITEM},turtahun:{_ITEM},datacontent:map<string,string>>"
)


def _cubes(payloads: DataFrame) -> DataFrame:
    cube = payloads.select("file", F.from_json("payload", CUBE).alias("c"))
    default = lambda name, label: F.when(
        F.size(f"c.{name}") > 0, F.col(f"c.{name}")
    ).otherwise(F.array(F.struct(F.lit("0").alias("val"), F.lit(label).alias("label"))))
    return cube.select(
        "file", F.get("c.var", 0).alias("var"), default("turvar", "").alias("turvar"), F.col("c.vervar").alias("vervar"),
        F.col("c.tahun").alias("tahun"), default("turtahun", "Tahun").alias("turtahun"), F.col("c.datacontent").alias("content"),
    )


CUBE_DIMENSIONS = ["vervar", "var", "turvar", "tahun", "turtahun"]


def _by_id(items: Column) -> Column:
    """A dimension list as a map of its first item by id."""
    ids = F.array_distinct(F.filter(F.transform(items, lambda x: x["val"]), lambda v: v.isNotNull()))
    return F.map_from_arrays(ids, F.transform(ids, lambda v: F.get(F.filter(items, lambda x: x["val"] == v), F.lit(0))))


def _readings(key: Column) -> Column:
    """All ways to cut a key into one listed id of each dimension: ids in the order of CUBE_DIMENSIONS.

    The cuts grow dimension by dimension, and only lengths that a dimension's ids have are tried, so a
    key costs its own few cuts, not the product of the lists.
    """
    cuts = F.array(F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("ids")))

    def longer(cut: Column, name: str) -> Column:
        piece = lambda n: F.substring(key, cut["at"], n)
        fitting = F.filter(F.col(f"__{name}_sizes"), lambda n: F.map_contains_key(F.col(f"__{name}"), piece(n)))
        return F.transform(fitting, lambda n: F.struct((cut["at"] + n).alias("at"), F.array_append(cut["ids"], piece(n)).alias("ids")))

    for name in CUBE_DIMENSIONS:
        grown = partial(longer, name=name)
        cuts = F.flatten(F.transform(cuts, lambda cut: grown(cut)))  # noqa: B023  (called at once)
    whole = F.filter(cuts, lambda cut: cut["at"] == F.length(key) + 1)
    return F.transform(whole, lambda cut: cut["ids"])


def cube_keys(payloads: DataFrame) -> DataFrame:
    """file, key and text of every filled cell of a sparse cube whose keys concatenate five ids, and `n_readings`, how many ways
    the key can be cut into listed ids; with just one, the items of the five dimensions.

    Each file's filled keys are read in its own row, and leave it with their own items only.
    """
    rows = _cubes(payloads).withColumn("var", F.array("var"))
    for name in CUBE_DIMENSIONS:
        rows = rows.withColumn(f"__{name}", _by_id(F.col(name)))
        rows = rows.withColumn(f"__{name}_sizes", F.array_distinct(F.transform(F.map_keys(f"__{name}"), F.length)))

    def cell(entry):
        def read(found):
            item = lambda name, i: F.when(F.size(found) == 1, F.try_element_at(F.col(f"__{name}"), F.get(F.get(found, F.lit(0)), F.lit(i)))).alias(name)
            return F.struct(
                entry["key"].alias("key"), entry["value"].alias("text"), F.size(found).alias("n_readings"),
                *(item(name, i) for i, name in enumerate(CUBE_DIMENSIONS)),
            )

        return F.get(F.transform(F.array(_readings(entry["key"])), read), F.lit(0))

    return rows.select("file", F.inline(F.transform(F.map_entries("content"), cell)))


def cube_cells(payloads: DataFrame) -> DataFrame:
    """The cells whose key has one reading."""
    return cube_keys(payloads).where("n_readings = 1").drop("n_readings")


def checked_cube(payloads: DataFrame, prefixes: DataFrame, national_code: str = "9999", regions: DataFrame | None = None) -> DataFrame:
    """Cube cells as observations, with what is wrong with them. Missing texts and the national total are skipped.

    A key of two readings is a row without dimensions; keys of none are left to `cube_issues`.
    """
    rows = cube_keys(payloads).where("n_readings > 0").where(F.coalesce(F.col("vervar.val") != national_code, F.lit(True)))
    rows = rows.join(prefixes, F.col("var.val") == F.col("variable_id"), "left")
    if regions is not None:
        rows = rows.join(regions.select(F.col("region_code").alias("__known")).distinct(), F.col("vervar.val") == F.col("__known"), "left")
    year, number = year_in_label(F.col("tahun.label")), numeric_token(F.col("text"))
    issue = F.coalesce(
        F.when(F.col("n_readings") > 1, "ambiguous_key"), F.when(F.col("code_prefix").isNull(), "unknown_variable"), F.when(year.isNull(), "bad_year"), numeric_token_issue(F.col("text")),
        F.when(F.col("__known").isNull(), "unmapped_region") if regions is not None else F.lit(None).cast("string"),
    )
    present = number.isNotNull() | numeric_token_issue(F.col("text")).isNotNull()
    return rows.where(present).select(
        series_code(F.col("code_prefix"), F.col("turvar.val"), F.col("turtahun.val")).alias("indicator_code"),
        series_name(F.trim("var.label"), F.trim("turvar.label"), F.trim("turtahun.label")).alias("indicator_name"),
        F.trim("var.unit").alias("unit"), F.col("vervar.val").alias("region_code"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("observation_date"),
        number.alias("value"), F.col("var.val").alias("source_variable_id"),
        F.col("turvar.val").alias("derived_variable_id"), F.col("turtahun.val").alias("derived_period_id"),
        F.coalesce(F.trim("var.def"), F.lit("")).alias("definition_text"), F.coalesce(F.trim("var.note"), F.lit("")).alias("notes"),
        F.col("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"), issue.alias("issue"),
    )


def normalize_cube(payloads: DataFrame, prefixes: DataFrame, national_code: str = "9999", regions: DataFrame | None = None) -> DataFrame:
    """The observations of `checked_cube`; an unknown variable, region or year, or a text that is no number, raises."""
    return require_clean(checked_cube(payloads, prefixes, national_code, regions), "key", "text").drop("key", "text")


def cube_issues(payloads: DataFrame, regions: DataFrame, period_ids: list[str] | None = None,
                national_code: str = "9999") -> DataFrame:
    """Drift: keys of no reading or of several, unmapped regions, unlisted periods, texts that are no numbers. One parse, one row an issue."""
    known = regions.select(F.col("region_code").alias("__known")).distinct()
    cells = cube_keys(payloads).join(known, F.col("vervar.val") == F.col("__known"), "left")
    found = F.array_compact(F.array(
        F.when(F.col("n_readings") == 0, "unknown_key"), F.when(F.col("n_readings") > 1, "ambiguous_key"),
        F.when((F.col("vervar.val") != national_code) & F.col("__known").isNull(), "unmapped_region"),
        F.when(F.col("n_readings") == 1, numeric_token_issue(F.col("text"))),
        F.when(~F.col("tahun.val").isin(period_ids), "unlisted_period") if period_ids is not None else F.lit(None).cast("string"),
    ))
    return cells.select("file", "key", F.explode(found).alias("issue"))


# The exact field set of one daily rate record.
RATE_FIELDS = [
    "id_subkursasing", "lnk_subkursasing", "nil_subkursasing", "beli_subkursasing", "jual_subkursasing",
    "tgl_subkursasing", "mts_subkursasing",
]
RATE_SCHEMA = "struct<Table:array<struct<" + ",".join(f"{f}:string" for f in RATE_FIELDS) + ">>>"


def read_rate_xml(spark: SparkSession, path: str) -> DataFrame:
    """Raw records of landed XML files. Files are cut at the ends of records, so a large one is read by many tasks."""
    cut = spark.read.option("lineSep", "</Table>").text(path).select(F.col("value").alias("chunk"))
    frame = F.regexp_replace("chunk", r"(?s)<\?.*?\?>|</?NewDataSet[^>]*>|\s", "")
    record = F.concat(F.lit("<NewDataSet>"), F.regexp_extract("chunk", "(?s)<Table.*", 0), F.lit("</Table></NewDataSet>"))
    # What is neither a record nor the frame around records is a record without fields.
    text = F.when(F.col("chunk").contains("<Table"), record).otherwise("<NewDataSet><Table></Table></NewDataSet>")
    return xml_rate_records(cut.where(frame != "").select(text.alias("payload")))


def xml_rate_records(payloads: DataFrame) -> DataFrame:
    """Raw records of XML texts in a `payload` column, each with the tags it has beyond RATE_FIELDS (`unexpected`).

    Values are read by the declared schema, field names from the same text as VARIANT.
    """
    tables = F.expr("variant_get(from_xml(payload, 'variant'), '$.Table', 'variant')")
    several = F.try_variant_get(tables, F.lit("$"), "array<variant>")
    shapes = F.when(F.schema_of_variant(tables).startswith("ARRAY"), several).otherwise(F.array(tables))
    keys = F.transform(shapes, lambda record: F.map_keys(record.try_cast("map<string,variant>")))
    zipped = F.arrays_zip(F.from_xml("payload", RATE_SCHEMA)["Table"].alias("t"), keys.alias("k"))
    each = payloads.select(F.explode(zipped).alias("z"))
    extra = F.array_sort(F.array_except(F.coalesce("z.k", F.array().cast("array<string>")), F.lit(RATE_FIELDS)))
    return each.select(*(F.col(f"z.t.{f}").alias(f) for f in RATE_FIELDS), extra.alias("unexpected"))


def unexpected_fields(records: DataFrame) -> DataFrame:
    """field, records: tags of rate records that are not in the exact field set."""
    return records.select(F.explode("unexpected").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("records"))


def checked_rates(records: DataFrame, currency: str = "USD") -> DataFrame:
    """link, observation_date, value of every record, and the first thing wrong with it; offsets in stamps are not applied."""
    day = iso_local_date(F.col("tgl_subkursasing"))
    value = F.trim("beli_subkursasing").try_cast("decimal(24,6)")
    number = lambda c: F.trim(c).try_cast("double")
    issue = (
        F.when(F.exists(F.array(*RATE_FIELDS), lambda f: f.isNull()), "missing_field")
        .when(F.size("unexpected") > 0, F.concat(F.lit("unexpected_field:"), F.array_join("unexpected", ","))).when(day.isNull(), "bad_stamp").when(value.isNull(), "bad_value")
        .when(F.trim("mts_subkursasing") != currency, "currency").when(~number("nil_subkursasing").eqNullSafe(F.lit(1.0)), "denomination")
        .when(~number("beli_subkursasing").eqNullSafe(number("jual_subkursasing")), "buy_differs_from_sell").when(value <= 0, "not_positive")
    )
    return records.select(F.trim("lnk_subkursasing").alias("link"), day.alias("observation_date"), value.alias("value"), F.col("tgl_subkursasing").alias("stamp"), issue.alias("issue"))


def normalize_rates(records: DataFrame) -> DataFrame:
    """region-free daily rates (observation_date, value); a bad record raises."""
    return require_clean(checked_rates(records), "link", "stamp").drop("stamp")


def rate_issues(records: DataFrame, start: str, end: str, currency: str = "USD") -> DataFrame:
    """(issue, violations) over all records."""
    number = lambda c: F.trim(c).try_cast("double")
    day = iso_local_date(F.col("tgl_subkursasing"))
    tests = {
        "missing_field": F.exists(F.array(*RATE_FIELDS), lambda f: f.isNull()),
        "unexpected_field": F.size("unexpected") > 0,
        "currency": F.trim("mts_subkursasing") != currency,
        "denomination": number("nil_subkursasing") != 1,
        "buy_differs_from_sell": number("beli_subkursasing") != number("jual_subkursasing"),
        "bad_stamp": day.isNull(),
        "outside_dates": day.isNotNull() & ~day.between(F.lit(start).cast("date"), F.lit(end).cast("date")),
        "not_positive": ~(number("beli_subkursasing") > 0),
    }
    counts = records.agg(*(F.count_if(F.coalesce(t, F.lit(True))).alias(n) for n, t in tests.items()))
    rows = counts.select(F.inline(F.array(*(
        F.struct(F.lit(n).alias("issue"), F.col(n).alias("violations")) for n in tests
    ))))
    repeated = (
        records.groupBy("lnk_subkursasing", day.alias("day")).count().where("count > 1")
        .agg(F.lit("repeated_date").alias("issue"), F.count(F.lit(1)).alias("violations"))
    )
    return rows.unionByName(repeated)


# Accepted column labels of the decision table.
DECISION_DATE_LABELS = ["tanggal", "periode"]
DECISION_RATE_LABELS = ["bi-7day-rr", "bi-rate"]


def _is_header():
    return normalize_label(F.col("date_text")).isin(DECISION_DATE_LABELS) & normalize_label(F.col("rate_text")).isin(DECISION_RATE_LABELS)


def read_decision_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("date_text string, rate_text string").csv(path).select(
        "date_text", "rate_text", F.col("_metadata.file_name").alias("file")
    )


def checked_decisions(rows: DataFrame) -> DataFrame:
    """Rows with a date or a rate, but for the header; a row with one of the two has an issue. Title rows have neither and are no decisions."""
    date, rate = named_month_date(F.col("date_text")), rate_text(F.col("rate_text"))
    parsed = rows.where(~F.coalesce(_is_header(), F.lit(False))).select(
        "file", date.alias("effective_date"), rate.alias("rate"), "date_text", "rate_text", F.when(date.isNull() != rate.isNull(), "half_parsed_row").alias("issue")
    )
    return parsed.where(F.col("effective_date").isNotNull() | F.col("rate").isNotNull())


def decisions(rows: DataFrame) -> DataFrame:
    """Dated rates below the header; a half-parsed row raises."""
    return require_clean(checked_decisions(rows), "file", "date_text", "rate_text").drop("date_text", "rate_text")


def decision_issues(rows: DataFrame) -> DataFrame:
    """Files without exactly one known header row, and half-parsed rows."""
    header = F.coalesce(_is_header(), F.lit(False))
    date, rate = named_month_date(F.col("date_text")), rate_text(F.col("rate_text"))
    counts = rows.groupBy("file").agg(
        F.count_if(header).alias("headers"), F.count_if(~header & (date.isNull() != rate.isNull())).alias("half_parsed")
    )
    return counts.where("headers <> 1 OR half_parsed > 0").select(
        "file", F.when(F.col("headers") != 1, "header_drift").otherwise("half_parsed_row").alias("issue")
    )


def table_cells(line: Column) -> Column:
    """Cells of one line of comma-separated text; quoted cells lose their quotes. A comma is put in front, so that every cell is matched with one."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), 1)
    return F.transform(found, lambda cell: F.when(
        cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1), F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    ).otherwise(cell))


def _positions(cells: Column, labels: list[str]) -> Column:
    """0-based places of the cells that carry one of the labels."""
    return F.filter(F.transform(cells, lambda cell, at: F.when(normalize_label(cell).isin(labels), at)), lambda at: at.isNotNull())


def decision_grid(payloads: DataFrame) -> DataFrame:
    """file, lines and headers of whole files; nothing is shuffled.

    A line is its number and its cells. A header is a line with one date label or rate label or more; it is
    `usable` if it has exactly one of each, wherever they stand.
    """
    lines = F.transform(F.split("payload", "\r\n|\n|\r"), lambda line, at: F.struct(
        (at + 1).alias("line"), table_cells(line).alias("cells"), (F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1).alias("open_quote")
    ))
    marked = F.transform(F.col("lines"), lambda row: F.struct(
        row["line"].alias("line"), _positions(row["cells"], DECISION_DATE_LABELS).alias("dates"), _positions(row["cells"], DECISION_RATE_LABELS).alias("rates")
    ))
    headers = F.filter(F.col("marked"), lambda row: (F.size(row["dates"]) > 0) & (F.size(row["rates"]) > 0))
    return payloads.select("file", F.coalesce(lines, F.array()).alias("lines")).withColumn("marked", marked).select(
        "file", "lines", headers.alias("headers")
    )


def _table_issue() -> Column:
    """What is wrong with the header of a file."""
    doubled = F.exists("headers", lambda row: (F.size(row["dates"]) > 1) | (F.size(row["rates"]) > 1))
    return F.when(F.size("headers") == 0, "header_missing").when(F.size("headers") > 1, "header_repeated").when(doubled, "header_ambiguous")


def checked_decision_tables(payloads: DataFrame) -> DataFrame:
    """Dated rates of files whose header may stand in any line and column, each with an issue.

    Cells are taken from the header's columns, below the header; other columns may hold anything. A line with
    a date or a rate alone is `half_parsed_row`, one whose quotes do not close `open_quote`, and one with text in
    both columns that is neither `unparsed_row`. A line empty in both columns is none. A file without exactly one
    header, or with a label twice in it, gives one row with that issue and no rates.
    """
    grid = decision_grid(payloads).withColumn("issue", _table_issue())
    broken = F.array(F.struct(F.lit(None).cast("int").alias("line"), F.lit("").alias("date_text"), F.lit("").alias("rate_text"), F.lit(False).alias("open_quote")))
    header = F.get("headers", F.lit(0))
    below = F.transform(F.filter("lines", lambda row: row["line"] > header["line"]), lambda row: F.struct(
        row["line"].alias("line"), F.coalesce(F.get(row["cells"], header["dates"][0]), F.lit("")).alias("date_text"),
        F.coalesce(F.get(row["cells"], header["rates"][0]), F.lit("")).alias("rate_text"), row["open_quote"].alias("open_quote"),
    ))
    rows = grid.select("file", F.col("issue").alias("__file_issue"), F.inline(F.when(F.col("issue").isNull(), below).otherwise(broken)))
    rows = rows.withColumn("effective_date", named_month_date(F.col("date_text"))).withColumn("rate", rate_text(F.col("rate_text")))
    no_date, no_rate = F.col("effective_date").isNull(), F.col("rate").isNull()
    issue = (
        F.when(F.col("__file_issue").isNotNull(), F.col("__file_issue")).when(F.col("open_quote"), "open_quote")
        .when(no_date & no_rate, "unparsed_row").when(no_date | no_rate, "half_parsed_row")
    )
    empty = (F.trim("date_text") == "") & (F.trim("rate_text") == "") & ~F.col("open_quote") & F.col("__file_issue").isNull()
    return rows.where(~empty).select("file", "line", "effective_date", "rate", "date_text", "rate_text", issue.alias("issue"))


def decision_tables(payloads: DataFrame) -> DataFrame:
    """Dated rates of clean files; the first issue raises."""
    clean = require_clean(checked_decision_tables(payloads), "file", "line", "date_text", "rate_text")
    return clean.select("file", "effective_date", "rate")
