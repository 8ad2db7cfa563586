"""Landed files: JSON, XML, CSV and binary, with drift."""

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.sources import landed, sinks


def record(year, value):
    return {"indicator": {"id": "X", "value": "x"}, "country": {"id": "ID", "value": "Land"}, "countryiso3code": "LND", "date": year, "value": value}


def test_indicator_files(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps([{"page": 1}, [record("2023", 5.05), record("2021", 3.7), record("2022", None)]]))
    for i, bad in enumerate([{}, [], [{"page": 1}], [{}, None]]):
        (tmp_path / f"bad{i}.json").write_text(json.dumps(bad))
    payloads = landed.read_payloads(spark, str(tmp_path))
    assert {r.file for r in landed.envelope_issues(payloads).collect()} == {f"bad{i}.json" for i in range(4)}
    with pytest.raises(Exception, match="bad_envelope"):
        landed.indicator_records(payloads).select("period").collect()
    payloads = payloads.where("file = 'good.json'")
    catalog = spark.createDataFrame([("X", "Growth", "percent", "annual")], "indicator_code string, indicator_name string, unit string, frequency string")
    rows = landed.normalize_records(landed.indicator_records(payloads), catalog).orderBy("observation_date").collect()
    assert [(r.observation_date, r.value, r.unit) for r in rows] == [(date(2021, 1, 1), Decimal("3.700000"), "percent"), (date(2023, 1, 1), Decimal("5.050000"), "percent")]
    assert landed.unknown_codes(landed.indicator_records(payloads), catalog.where("false")).count() == 1
    with pytest.raises(Exception, match="unknown_code"):
        landed.normalize_records(landed.indicator_records(payloads), catalog.where("false")).collect()


def page(number, pages, rows, status="OK"):
    return json.dumps({"status": status, "data-availability": "available", "data": [{"page": number, "pages": pages, "per_page": 1, "count": len(rows), "total": pages}, rows]})


def test_pages(spark):
    rows = [("a", 1, page(1, 2, [{"domain_id": "1100"}])), ("a", 2, page(2, 2, [{"domain_id": "1200"}])), ("b", 1, page(1, 2, [{"domain_id": "1"}])), ("c", 1, page(2, 2, []))]
    payloads = spark.createDataFrame([(r, p, r, t) for r, p, t in rows], "request string, requested_page int, file string, payload string")
    with pytest.raises(Exception, match="bad_page c 1"):
        landed.paginated_records(payloads).collect()
    found = {(r.request, r.row["domain_id"]) for r in landed.paginated_records(payloads.where("request <> 'c'")).collect()}
    assert found == {("a", "1100"), ("a", "1200"), ("b", "1")}
    assert {tuple(r) for r in landed.page_issues(payloads).collect()} == {("b", "incomplete"), ("c", "bad_page"), ("c", "incomplete")}


def cube(**changes):
    item = lambda *pairs: [{"val": v, "label": t} for v, t in pairs]
    base = {
        "var": [{"val": 543, "label": "Rate", "unit": "percent", "def": "d", "note": ""}], "turvar": [], "labelvervar": "Provinsi",
        "vervar": item((1100, "A"), (1200, "B"), (9999, "Total")), "tahun": item((101, "2023")), "turtahun": item((0, "Tahun")),
        "datacontent": {"110054301010": 5.25, "120054301010": "4.75", "999954301010": 5},
    }
    return json.dumps(base | changes)


def test_cube(spark):
    payloads = spark.createDataFrame([("f", cube())], "file string, payload string")
    prefixes = spark.createDataFrame([("543", "S.543")], "variable_id string, code_prefix string")
    rows = landed.normalize_cube(payloads, prefixes).orderBy("region_code").collect()
    assert [(r.indicator_code, r.indicator_name, r.region_code, r.observation_date, r.value) for r in rows] == [
        ("S.543.TV0.TP0", "Rate", "1100", date(2023, 1, 1), 5.25), ("S.543.TV0.TP0", "Rate", "1200", date(2023, 1, 1), 4.75)]


def test_cube_drift(spark):
    content = {"110054301010": "1,5", "120054301010": "-", "7": 1}
    payloads = spark.createDataFrame([("f", cube(datacontent=content))], "file string, payload string")
    regions = spark.createDataFrame([("1100",)], "region_code string")
    issues = {(r.key, r.issue) for r in landed.cube_issues(payloads, regions, ["100"]).collect()}
    assert issues == {("7", "unknown_key"), ("120054301010", "unmapped_region"), ("110054301010", "ambiguous_format"),
                      ("110054301010", "unlisted_period"), ("120054301010", "unlisted_period")}
    prefixes = spark.createDataFrame([("543", "S.543")], "variable_id string, code_prefix string")
    assert [(r.key, r.issue) for r in landed.rejects(landed.checked_cube(payloads, prefixes, regions=regions)).collect()] == [("110054301010", "ambiguous_format")]
    with pytest.raises(Exception, match="ambiguous_format 110054301010 1,5"):
        landed.normalize_cube(payloads, prefixes).select("notes").collect()


def test_cube_keys_of_several_readings(spark):
    """Ids of one and two digits: 1|2|31 and 12|... cut the same key, and a key may have no cut or one only by backtracking."""
    items = lambda *ids: [{"val": i, "label": f"year 20{i[:2].zfill(2)}"} for i in ids]
    content = {"1512341": "1", "1152341": "2", "9999999": "3", "151234": "4", "11523441": "5"}
    payload = json.dumps({"var": [{"val": "5", "label": "v", "unit": "u"}], "turvar": items("1", "12", "2"), "vervar": items("1", "11"), "tahun": items("23", "3", "34"), "turtahun": items("41", "4", "1"), "datacontent": content})
    cells = landed.cube_keys(spark.createDataFrame([("f", payload)], "file string, payload string")).collect()
    ids = {k: [x["val"] for x in items(*v)] for k, v in {"vervar": ("1", "11"), "var": ("5",), "turvar": ("1", "12", "2"), "tahun": ("23", "3", "34"), "turtahun": ("41", "4", "1")}.items()}
    product = [""]
    for name in landed.CUBE_DIMENSIONS:
        product = [p + i for p in product for i in ids[name]]
    assert {r.key: r.n_readings for r in cells} == {k: product.count(k) for k in content}
    assert max(r.n_readings for r in cells) > 1 and all((r.vervar is None) == (r.n_readings != 1) for r in cells)


def rate(day, value, extra=""):
    return (f"<Table><id_subkursasing>1</id_subkursasing><lnk_subkursasing>23</lnk_subkursasing><nil_subkursasing>1.00</nil_subkursasing><beli_subkursasing>{value}</beli_subkursasing>"
            f"<jual_subkursasing>{value}</jual_subkursasing><tgl_subkursasing>{day}T00:00:00+07:00</tgl_subkursasing><mts_subkursasing>USD  </mts_subkursasing>{extra}</Table>")


def test_rate_files(spark, tmp_path):
    days = [("2024-05-03", 101), ("2024-05-31", 107), ("2024-06-04", 90.5), ("2024-06-28", 91.5)]
    (tmp_path / "r.xml").write_text("<NewDataSet>" + "".join(rate(*d) for d in days) + "</NewDataSet>")
    records = landed.read_rate_xml(spark, str(tmp_path))
    rows = landed.normalize_rates(records).groupBy(F.month("observation_date").alias("m")).agg(F.avg("value").alias("v")).orderBy("m").collect()
    assert [float(r.v) for r in rows] == [104, 91]
    assert {r.issue: r.violations for r in landed.rate_issues(records, "2024-05-01", "2024-06-30").collect() if r.violations} == {}
    assert {r.issue: r.violations for r in landed.rate_issues(records, "2024-05-01", "2024-06-15").collect() if r.violations} == {"outside_dates": 1}
    odd = spark.createDataFrame([("<NewDataSet>" + rate("no date", 1) + rate("2024-05-06", "x") + rate("2024-05-07", 2, "<note>n</note>") + "</NewDataSet>",)], "payload string")
    assert [r.issue for r in landed.checked_rates(landed.xml_rate_records(odd)).collect()] == ["bad_stamp", "bad_value", "unexpected_field:note"]
    assert [(r.field, r.records) for r in landed.unexpected_fields(landed.xml_rate_records(odd)).collect()] == [("note", 1)]
    assert {r.issue for r in landed.rate_issues(landed.xml_rate_records(odd), "2024-01-01", "2024-12-31").collect() if r.violations} >= {"bad_stamp"}


def test_rate_files_with_odd_records(spark, tmp_path):
    """One record, a tag too many, a tag too few, attributes, and text that is no record."""
    (tmp_path / "one.xml").write_text('<?xml version="1.0"?>\n<NewDataSet>\n' + rate("2024-05-03", 1) + "\n</NewDataSet>\n")
    less = rate("2024-05-04", 2).replace("<nil_subkursasing>1.00</nil_subkursasing>", "")
    (tmp_path / "two.xml").write_text("<NewDataSet>" + rate("2024-05-05", 3, "<a>1</a><b/>") + less + "stray words</NewDataSet>")
    checked = landed.checked_rates(landed.read_rate_xml(spark, str(tmp_path))).collect()
    assert sorted((r.issue or "") for r in checked) == ["", "missing_field", "missing_field", "unexpected_field:a,b"]
    with pytest.raises(Exception, match="unexpected_field:a,b|missing_field"):
        landed.normalize_rates(landed.read_rate_xml(spark, str(tmp_path))).collect()


def test_record_shapes(spark):
    good = '{"indicator":{"id":"i"},"country":{"id":"c"},"countryiso3code":"ABC","date":"2000","value":1.5,"unit":""}'
    rows = [good, good.replace("1.5", "null"), good.replace('"2000"', "2000"), good.replace('"date"', '"day"'), "[]", "3", "null", good.replace('{"id":"c"}', "null")]
    payload = spark.createDataFrame([("f", '[{"page":1},[' + ",".join(rows) + "]]")], "file string, payload string")
    found = {}
    for r in landed.record_drift(payload).collect():
        found.setdefault(r["at"], []).append(r.issue)
    assert found == {2: ["type:date"], 3: ["missing:date", "unexpected:day"], 4: ["not_an_object"], 5: ["not_an_object"], 6: ["not_an_object"], 7: ["type:country"]}


def test_decision_file(spark, tmp_path):
    (tmp_path / "d.csv").write_text('Report,\nTanggal,BI-Rate\n17 Desember 2025,5.75 %\n19 Februari 2026,"5,50 %"\n')
    rows = landed.read_decision_csv(spark, str(tmp_path))
    assert [(r.effective_date, float(r.rate)) for r in landed.decisions(rows).orderBy("effective_date").collect()] == [(date(2025, 12, 17), 5.75), (date(2026, 2, 19), 5.5)]
    assert landed.decision_issues(rows).count() == 0
    assert landed.decision_issues(rows.where("date_text <> 'Tanggal'")).first().issue == "header_drift"


def test_floating_table(spark):
    good = 'Title,,\r\n\r\nno,"x, y",Periode,z,BI-7Day-RR\r\n1,,3 Mei 2001,"q ""r""","7,25 %"\r\n,,,,\r\n2,,9 Juni 2001,,6.5 %'
    cases = {
        "good": good, "none": good.replace("Periode", "Hari"), "two": good + "\nPeriode,BI-Rate", "double": good.replace("no,", "Tanggal,"),
        "half": good.replace("6.5 %", "?"), "odd": good.replace("9 Juni 2001", "later").replace("6.5 %", "?"), "short": good.replace(",,6.5 %", ""),
        "quote": good.replace("6.5 %", '"6.5 %'), "empty": "", "null": None, "header": "Tanggal,BI-Rate",
    }
    rows = spark.createDataFrame([(k, v, "own") for k, v in cases.items()], "file string, payload string, rate string")
    checked = landed.checked_decision_tables(rows)
    found = {(r.file, r.line, r.issue) for r in landed.rejects(checked).collect()}
    assert found == {
        ("none", None, "header_missing"), ("two", None, "header_repeated"), ("double", None, "header_ambiguous"), ("half", 6, "half_parsed_row"),
        ("odd", 6, "unparsed_row"), ("short", 6, "half_parsed_row"), ("quote", 6, "open_quote"), ("empty", None, "header_missing"), ("null", None, "header_missing"),
    }
    clean = landed.decision_tables(rows.where("file IN ('good', 'header')")).orderBy("effective_date").collect()
    assert [(r.file, r.effective_date, float(r.rate)) for r in clean] == [("good", date(2001, 5, 3), 7.25), ("good", date(2001, 6, 9), 6.5)]
    with pytest.raises(Exception, match="half_parsed_row half 6"):
        landed.decision_tables(rows.where("file = 'half'")).collect()


def test_manifest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    row = landed.snapshot_manifest(landed.read_binary(spark, str(tmp_path))).first()
    assert (row.file, row.byte_count, row.sha256[:8]) == ("a.bin", 3, "ba7816bf")


def test_csv_cells_and_file(spark, tmp_path):
    frame = spark.createDataFrame([("North, upper", 'the "old" mill', None)], "a string, b string, c string")
    line = '"North, upper","the ""old"" mill",'
    assert sinks.csv_lines(frame, ["a", "b", "c"]).first().line == line
    sinks.write_csv(frame.coalesce(1), str(tmp_path / "out"), {"a": "Region, name", "b": "Source", "c": "Note"})
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text().splitlines() == ['"Region, name",Source,Note', line]


def test_documents_nest_children(spark, tmp_path):
    runs = spark.createDataFrame([("r1", "ok"), ("r2", "ok")], "run_key string, status string")
    children = spark.createDataFrame([("r1", 2), ("r1", 1)], "run_key string, step int")
    documents = sinks.run_documents(runs, "run_key", {"points": children})
    assert {json.loads(r.document)["run_key"]: json.loads(r.document)["points"] for r in documents.collect()} == {"r1": [{"step": 1}, {"step": 2}], "r2": []}
    sinks.write_documents(documents, str(tmp_path / "docs"))
    assert spark.read.text(str(tmp_path / "docs")).count() == 2


@pytest.mark.parametrize(("raw", "masked"), [
    ("token = abc,next", "token = [REDACTED],next"), ("GET /key/123/x?y", "GET /key/[REDACTED]/x?y"),
    ("Authorization: Bearer xyz end", "Authorization: [REDACTED] end"), ("db://user:pw@host", "db://user:[REDACTED]@host"), ("plain", "plain"),
])
def test_redaction(spark, raw, masked):
    assert spark.createDataFrame([(raw,)], "t string").select(text.redact(F.col("t"))).first()[0] == masked


def test_labels_and_dates(spark):
    rows = spark.createDataFrame([("31 Februari 2024",), (" 1  MEI 2020 ",), ("1 May 2020",)], "t string")
    assert [r[0] for r in rows.select(text.named_month_date(F.col("t"))).collect()] == [None, date(2020, 5, 1), None]
