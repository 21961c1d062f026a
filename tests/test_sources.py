"""Sheets, pages, landed files and exports."""

from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from daybook.sinks import export
from daybook.sources import landed, pages, sheet

HEADER = "Case Number,Date/Time Reported,Date/Time Occurred,Nature,Incident Narrative,Campus,Location,Disposition"
SHEET = f'﻿"Town Daily Crime Log, September 2026",,,,,,,\r\n{HEADER}\r\nNUPD 26-1, 9/1/26 10:00 ,9/1/26,Theft,text,Main ,hall,Open\r\n,,,,,,,\r\nNUPD 26-1,9/2/26 10:00,9/1/26,Theft,text,Main,hall,Open\r\nshort,9/3/26 1:00\r\n'


def test_sheet(spark, tmp_path):
    files = spark.createDataFrame([("f", bytearray(SHEET.encode())), ("bad", bytearray(b"<html>")), ("none", None)], "source_file_id string, content binary")
    rows = sheet.parse_sheets(files)
    assert sorted(r.source_file_id for r in rows.filter("error IS NOT NULL").collect()) == ["bad", "none"]
    keyed = {r.source_row_index: r for r in sheet.key_records(rows).collect()}
    assert sorted(keyed) == [3, 5, 6] and keyed[3].source_month == "September 2026" and keyed[3].campus_raw == "Main"
    assert keyed[3].flags == keyed[5].flags == "near_duplicate" and keyed[6].flags == "" and keyed[6].disposition_raw == ""
    assert keyed[3].incident_uid != keyed[5].incident_uid
    (tmp_path / "a.csv").write_bytes(SHEET.encode())
    sheet.register(spark)
    assert spark.read.format("monthly_sheet").load(str(tmp_path)).count() == 3 and sheet.read_sheets(spark, str(tmp_path)).count() == 3
    for folder, name in (("1aB", "2026-10-01.csv"), ("1aB", "2026-10-01.2.csv"), ("2c D+", "2026-10-02.csv")):
        (tmp_path / "raw" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / folder / name).write_bytes(SHEET.encode())
    (tmp_path / "raw" / "1aB" / "2026-10-01.headers.json").write_text("{}")
    expected = {("1aB", "2026-10-01", 1), ("1aB", "2026-10-01", 2), ("2c D+", "2026-10-02", 1)}
    for found in (spark.read.format("monthly_sheet").load(str(tmp_path / "raw")), spark.read.format("monthly_sheet").load(f"file://{tmp_path}/raw"), sheet.read_sheets(spark, str(tmp_path / "raw"))):
        assert found.count() == 9 and {(r.source_file_id, str(r.snapshot_date), r.snapshot_seq) for r in found.collect()} == expected
    assert {r.flags for r in found.filter("source_row_index < 6").collect()} == {"near_duplicate"}


def test_renamed_column():
    with pytest.raises(sheet.SheetError, match="Nature"):
        sheet.sheet_rows(SHEET.replace(",Nature,", ",Kind,").encode())


def test_gates(spark):
    long = SHEET + "x" * 200
    rows = [("ok", "text/csv; charset=utf-8", long, None), ("html", "text/html", long, None), ("short", "text/csv", "Case Number\n\n\n", None), ("head", "text/csv", "y\n" * 200, None), ("tab", "text/csv", long, 'attachment; filename="Sheet - Other.csv"'), ("lines", "text/csv", "Case Number" + "x" * 300, None), ("empty", "text/csv", "", None)]
    frame = spark.createDataFrame([(a, b, bytearray(c.encode()), d) for a, b, c, d in rows], "id string, content_type string, content binary, content_disposition string")
    assert {r.id: r.rejected for r in sheet.gate_exports(frame, "Crime Log").collect()} == {"ok": None, "html": "content type", "short": "size", "head": "header", "tab": "tab", "lines": "lines", "empty": "size"}


def test_tab_names(spark):
    rows = spark.createDataFrame([("attachment; filename*=UTF-8''June%20-%20Crime%20Log.csv",), ('attachment; filename="June - Crime Log.csv"',), ("",), (None,)], "d string")
    assert [r[0] for r in rows.select(sheet.tab_name(F.col("d"))).collect()] == ["Crime Log", "Crime Log", None, None]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("Crime Log.html", "x")
        z.writestr("resources/sheet.css", "x")
    files = spark.createDataFrame([("f", bytearray(packed.getvalue())), ("g", bytearray(b"no"))], "source_file_id string, content binary")
    assert {r.source_file_id: r.tabs for r in sheet.tab_census(files).collect()} == {"f": ["Crime Log"], "g": None}


def entry(k):
    return f'<div id="entry-id{k}"><div class="flip-entry-title">A &amp; B {k}</div><div class="flip-entry-last-modified"><div>9/{k}/26</div></div></div>'


def test_listing(spark):
    page = spark.createDataFrame([("".join(map(entry, range(1, 4))),)], "p string")
    assert [(e.id, e.name) for e in page.select(pages.listing_entries(F.col("p"))).first()[0]] == [("id1", "A & B 1"), ("id2", "A & B 2"), ("id3", "A & B 3")]
    for wrong in ("", "".join(map(entry, range(50))), entry(1) + '<div id="entry-x">'):
        with pytest.raises(Exception, match="listing"):
            spark.createDataFrame([(wrong,)], "p string").select(pages.listing_entries(F.col("p"))).collect()


LEGACY = "<table><tr>" + "".join(f"<th>{h}</th>" for h in pages.LEGACY_HEADER) + "</tr>{}</table>"
CELLS = "<tr><td>NUPD 21-1<br/>CSA 2</td><td>1/2/21<br>10:00</td><td>Unknown</td><td>• Theft<br />-Bicycle<br>* </td><td><strong>Main</strong><br/>• ha<b>ll</b> &amp;amp; yard&#8211;&#x2013;&eacute;&nbsp;&unknown; x</td><td>• Open<br/><strong>Student?: </strong> Yes<br>Student?: no</td></tr>"


def test_legacy_pages(spark):
    html = LEGACY.replace("<tr>", "<tr>" + "<td>before</td>" * 6 + "</tr><tr>", 1).format(CELLS + "<tr><td>too</td><td>short</td></tr><tr>" + "<td></td>" * 6 + "</tr>")
    page = spark.createDataFrame([("January 2021", html), ("dead", "<p>gone</p>"), ("none", None)], "month string, html string")
    [r] = pages.parse_legacy(page).collect()
    assert (r.case_number_raw, r.date_reported_raw, r.nature_raw, r.campus_raw, r.location_raw, r.disposition_raw, r.student_flag) == ("NUPD 21-1CSA 2", "1/2/21 10:00", "Theft; Bicycle", "Main", "hall &amp; yard––é &unknown; x", "Open; Student?: no", "Yes")
    assert [x[0] for x in page.select(pages.is_dead_page(F.col("html"))).collect()] == [False, True, True]
    with pytest.raises(Exception, match="legacy header"):
        pages.parse_legacy(spark.createDataFrame([("m", html.replace("Nature", "Kind"))], "month string, html string")).collect()


def test_captures(spark):
    index = [["timestamp", "original", "statuscode"], ["20220301", "http://x/log-february-2022", "200"], ["20220201", "http://x/log-february-2022?v=2", "200"], ["20220202", "http://x/february-2022", "404"], ["20220203", "http://x/about", "200"]]
    rows = pages.capture_index(spark.createDataFrame([(json.dumps(index),)], "value string")).orderBy("nth").collect()
    assert [(r.month, r.stamp, r.nth) for r in rows] == [("February 2022", "20220201", 1), ("February 2022", "20220301", 2)]


def test_runs_and_manifest(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"date": "2026-09-01", "alarms": ["x"], "archive_rows": 3}))
    (tmp_path / "b.json").write_text("{broken")
    assert [r.archive_rows for r in landed.read_runs(spark, str(tmp_path)).collect()] == [3]
    manifest = {"archive_started": "2026-09-01", "files": {"f": {"name": "n", "snapshots": [{"date": "2026-09-01", "sha256": "x", "bytes": 1}]}}}
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "manifest.json").write_text(json.dumps(manifest))
    files, snapshots = landed.read_manifest(spark, str(tmp_path / "m"))
    assert files.first().name == "n" and snapshots.first().sha256 == "x"


def test_a_payload_of_any_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(export, "PAYLOAD_BOUND", 100)
    rows = spark.range(1_000).select("id", F.when(F.col("id") > 0, "é").alias("q"))
    with pytest.raises(ValueError):
        export.payload({"rows": rows})
    export.write_payload(str(tmp_path), {"rows": rows, "none": rows.limit(0)})
    lines = [json.loads(line) for p in (tmp_path / "rows").glob("part-*") for line in p.read_text(encoding="utf-8").splitlines()]
    assert sorted(r["id"] for r in lines) == list(range(1_000)) and {"id": 0, "q": None} in lines and {"id": 7, "q": "é"} in lines
    assert not any(p.read_text() for p in (tmp_path / "none").glob("part-*"))


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([('a "b"', "c\td\r\ne"), (None, "x,y")], "p string, q string")
    assert [r[0] for r in export.tsv_lines(rows).collect()] == ['a "b"\tc d e', "\tx,y"]
    assert [r[0] for r in export.csv_lines(rows).collect()] == ['"a ""b""","c\td\r\ne"', ',"x,y"']
    export.write_csv(rows.limit(1).select(F.lit("v").alias("p")), str(tmp_path / "csv"))
    assert next((tmp_path / "csv").glob("part-*")).read_bytes() == b"\xef\xbb\xbfp\r\nv\r\n"
    whole = export.payload({"rows": rows})
    page = export.render_page("<t>{{title}}</t>{{payload}}", {"title": "T"}, whole.replace("x,y", "</x"), ["rows"])
    assert "<\\/x" in page and "<t>T</t>" in page
    for template, keys in (("{{left}}", ["rows"]), ("", ["lacking"])):
        with pytest.raises((KeyError, ValueError)):
            export.render_page(template, {}, whole, keys)
    assert export.write_pages(str(tmp_path / "site"), {"a.html": "1"}) == [] and export.write_pages(str(tmp_path / "site"), {"b.html": "1"}) == ["a.html"]
