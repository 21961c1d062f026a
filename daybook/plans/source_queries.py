"""Queries of the sources, sinks and scalars of presentation, over inputs written from the whole tables, with the SQL they are checked against.

A record becomes a sheet or a page of its own where the source reads whole
documents, so no document grows with the data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import tokens
from daybook.functions.identity import FIELDS
from daybook.plans import archive_sql as q
from daybook.plans import derive
from daybook.plans.archive_queries import archive, derived
from daybook.session import checkpoint_folder, table
from daybook.sinks import archive as archive_sink
from daybook.sinks import export
from daybook.sources import landed, pages, sheet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def of(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return of


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _cell(c: str) -> Column:
    return F.concat(F.lit('"'), F.replace(_text(c), F.lit('"'), F.lit('""')), F.lit('"'))


def sheets(spark: SparkSession, d: str) -> DataFrame:
    """Each record as a sheet with banner, header (columns turned about), a blank line and, for every record, a second row that differs in its date."""
    order = ["disposition_raw", *[f for f in FIELDS if f != "disposition_raw"]]
    banner = F.concat(F.lit('﻿"Town Daily Crime Log, '), F.coalesce("source_month", F.lit("")), F.lit('",,\r\n'))
    header = F.lit(",".join(FIELDS[f] for f in order) + "\r\n,,,,,,,\r\n")
    line = F.concat_ws(",", *[_cell(f) for f in order])
    second = F.concat_ws(",", *[F.lit('"1/1/20"') if f == "date_reported_raw" else _cell(f) for f in order])
    content = F.concat(banner, header, line, F.lit("\r\n"), second, F.lit("\r\n"))
    return table(spark, d, "incidents").select(F.col("row_id").cast("string").alias("source_file_id"), F.to_date(F.lit("2026-11-06")).alias("snapshot_date"), F.lit(1).alias("snapshot_seq"), content.cast("binary").alias("content"))


#: What the sheet reader strips from a cell: all blanks of Unicode and the separators of ASCII.
_STRIP = r"[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({x}, ''), '^{_STRIP}', ''), '{_STRIP}$', '')"


_SHEET = ", ".join(f"{_strip(f)} AS {f}" for f in FIELDS)


@query(f"""WITH s AS (SELECT row_id, regexp_extract(coalesce(source_month, ''), '^[A-Z][a-z]+ \\d{{4}}', 0) AS month, {_SHEET} FROM incidents),
  r AS (SELECT row_id, month, 4 AS n, * EXCLUDE (row_id, month) FROM s UNION ALL SELECT row_id, month, 5, * EXCLUDE (row_id, month) REPLACE ('1/1/20' AS date_reported_raw) FROM s)
  SELECT CAST(row_id AS VARCHAR) AS file, month, n AS row_number, {', '.join(FIELDS)}, {q.uid('case_number_raw', 'date_reported_raw')} AS uid, 'near_duplicate' AS flags FROM r""")
def sheet_records(spark, d):
    """Records of sheets, keyed and with near-duplicates marked (banner, header by content, columns by name)."""
    k = sheet.key_records(sheet.parse_sheets(sheets(spark, d)))
    return k.select(F.col("source_file_id").alias("file"), F.col("source_month").alias("month"), F.col("source_row_index").alias("row_number"), *FIELDS, F.col("incident_uid").alias("uid"), "flags")


def exports(spark: SparkSession, d: str) -> DataFrame:
    """Landed exports of every kind of fault; a record's hash decides on its own."""
    k = F.instr(F.lit("012345"), F.left(F.coalesce("content_hash", F.lit("f")), F.lit(1))) - 1
    body = F.concat(F.when(k == 3, "Number").otherwise("Case Number"), F.when(k == 4, " ").otherwise("\n\n\n\n"), F.repeat(F.lit("x"), F.when(k == 1, 10).otherwise(300).cast("int")))
    return table(spark, d, "incidents").select(
        "row_id", F.when(k == 0, "TEXT/CSV; charset=utf-8").when(k == 5, "text/html").otherwise("text/csv").alias("content_type"), body.cast("binary").alias("content"),
        F.concat(F.lit('attachment; filename="'), F.translate(_text("source_file_name"), '"', ""), F.when(k == 2, " - Other").otherwise(" - Crime Log"), F.lit('.csv"')).alias("content_disposition"),
    )


@query("SELECT row_id, CASE left(content_hash, 1) WHEN '5' THEN 'content type' WHEN '1' THEN 'size' WHEN '2' THEN 'tab' WHEN '3' THEN 'header' WHEN '4' THEN 'lines' END AS rejected, CASE WHEN left(content_hash, 1) = '2' THEN 'Other' ELSE 'Crime Log' END AS tab FROM incidents")
def export_gates(spark, d):
    gated = sheet.gate_exports(exports(spark, d), "Crime Log")
    return gated.select("row_id", "rejected", sheet.tab_name(F.col("content_disposition")).alias("tab"))


def _html(c: str) -> Column:
    """A value as a page would show it: entities, and a line with a list mark for each part of a ``;`` list."""
    escaped = tokens.escape_html(F.regexp_replace(_text(c), r"\s*;\s*", "\u0001"))
    return F.concat(F.lit("• "), F.replace(escaped, F.lit("\u0001"), F.lit("<br/>• ")))


def legacy_pages(spark: SparkSession, d: str) -> DataFrame:
    """Each record as a legacy page; those whose hash begins with 0 or 1 are dead ones."""
    header = "".join(f"<th>{h}</th>" for h in pages.LEGACY_HEADER)
    td = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = F.concat(
        td(F.concat(F.lit("<b>"), tokens.escape_html(_text("case_number_raw")), F.lit("</b>"))), td(F.concat(tokens.escape_html(_text("date_reported_raw")), F.lit("<br>&nbsp;"))), td(tokens.escape_html(_text("date_occurred_raw"))), td(_html("nature_raw")),
        td(F.concat(F.lit("<strong>"), tokens.escape_html(_text("campus_raw")), F.lit("</strong><br />"), _html("location_raw"))), td(F.concat(_html("disposition_raw"), F.lit("<br/><strong>Student?:</strong> "), _text("student_flag"))),
    )
    page = F.concat(F.lit(f"<table><tr>{header}</tr><tr>"), row, F.lit("</tr><tr><td>end</td></tr></table>"))
    return table(spark, d, "incidents").select("row_id", F.col("row_id").cast("string").alias("month"), F.when(F.left("content_hash", F.lit(1)).isin("0", "1"), "<p>gone</p>").otherwise(page).alias("html"))


def _mark(x: str) -> str:
    return f"trim(regexp_replace({x}, '^[•\\-*]\\s*', ''), ' ')"


def _parts(x: str) -> str:
    return f"array_to_string([p for p in [{_mark(q.collapse('p'))} for p in list_transform(string_split_regex(coalesce({x}, ''), '\\s*;\\s*'), lambda y: '• ' || y)] if p <> ''], '; ')"


_LINE = lambda x: f"array_to_string([p for p in [{_mark(q.collapse(x))}] if p <> ''], ' ')"


@query(f"""SELECT CAST(row_id AS VARCHAR) AS page, {q.collapse('case_number_raw')} AS case_number, {_LINE('date_reported_raw')} AS reported, {_LINE('date_occurred_raw')} AS occurred, {_parts('nature_raw')} AS nature, {q.collapse('campus_raw')} AS campus,
  {_parts('location_raw')} AS location, {_parts('disposition_raw')} AS disposition, {q.collapse('student_flag')} AS student FROM incidents WHERE coalesce(left(content_hash, 1), 'f') NOT IN ('0', '1') AND {q.collapse('case_number_raw')} <> ''""")
def legacy_records(spark, d):
    """Records of legacy pages (list marks, entities, bold campus, student flag); dead pages give none."""
    r = pages.parse_legacy(legacy_pages(spark, d))
    names = {"case_number": "case_number_raw", "reported": "date_reported_raw", "occurred": "date_occurred_raw", "nature": "nature_raw", "campus": "campus_raw", "location": "location_raw", "disposition": "disposition_raw", "student": "student_flag"}
    return r.select(F.col("source_month").alias("page"), *[F.col(c).alias(n) for n, c in names.items()])


@query("SELECT row_id, coalesce(left(content_hash, 1), 'f') IN ('0', '1') AS dead FROM incidents")
def dead_pages(spark, d):
    return legacy_pages(spark, d).select("row_id", pages.is_dead_page(F.col("html")).alias("dead"))


@query("SELECT source_file_id AS id, coalesce(source_file_name, '') AS name, coalesce(strftime(last_verified, '%Y-%m-%d'), '') AS modified FROM source_files")
def folder_listing(spark, d):
    """Entries of folder pages, one page a file."""
    name, stamp = tokens.escape_html(_text("source_file_name")), F.coalesce(F.date_format("last_verified", "yyyy-MM-dd"), F.lit(""))
    page = F.concat(F.lit('<div id="entry-'), F.col("source_file_id"), F.lit('"><div class="flip-entry-title">'), name, F.lit('</div><div class="flip-entry-last-modified"><div>'), stamp, F.lit("</div></div></div>"))
    return table(spark, d, "source_files").select(F.inline(pages.listing_entries(page)))


@query("""WITH c AS (SELECT row_id, ['january', 'february', 'march', 'april', 'may', 'june', 'july', 'august', 'september', 'october', 'november', 'december'][1 + row_id % 12] AS m, 2017 + row_id % 9 AS y, strftime(DATE '2021-01-01' + CAST(row_id % 1500 AS INTEGER), '%Y%m%d') || lpad(CAST(row_id % 86400 AS VARCHAR), 6, '0') AS stamp FROM incidents WHERE coalesce(left(content_hash, 1), 'f') <> '0')
  SELECT upper(m[1]) || m[2:] || ' ' || y AS month, stamp, 'http://log.example/' || m || '-' || y || '?' || row_id AS url, CAST(row_number() OVER (PARTITION BY m, y ORDER BY stamp, 'http://log.example/' || m || '-' || y || '?' || row_id) AS INTEGER) AS nth FROM c""")
def capture_indexes(spark, d):
    """Captures of indexes, one index a record; those whose hash begins with 0 didn't answer with 200."""
    months = F.array(*[F.lit(m) for m in "january february march april may june july august september october november december".split()])
    k = F.col("row_id")
    stamp = F.concat(F.date_format(F.date_add(F.lit("2021-01-01").cast("date"), (k % 1500).cast("int")), "yyyyMMdd"), F.lpad((k % 86_400).cast("string"), 6, "0"))
    url = F.concat(F.lit("http://log.example/"), F.element_at(months, (1 + k % 12).cast("int")), F.lit("-"), (2017 + k % 9).cast("string"), F.lit("?"), k.cast("string"))
    head = F.array(*[F.lit(x) for x in ("timestamp", "original", "statuscode")])
    index = F.to_json(F.array(head, F.array(stamp, url, F.when(F.startswith("content_hash", F.lit("0")), "404").otherwise("200"))))
    return pages.capture_index(table(spark, d, "incidents").select(index.alias("value")))


@query(f"WITH {q.ARCHIVE} SELECT incident_uid, status, revision, disposition_raw FROM arch")
def archive_read_back(spark, d):
    """The archive written as a version under a pointer, and read back."""
    root = f"{checkpoint_folder(spark)}/archive-{uuid.uuid4().hex}"
    rows = archive(spark, d).select(*archive_sink.ARCHIVE_COLUMNS)
    rows.sort("incident_uid").write.parquet(f"{root}/versions/2026-11-06.0001")
    archive_sink.point(spark, root, 1, "2026-11-06.0001", 0)
    return landed.read_archive(spark, root).select("incident_uid", "status", "revision", "disposition_raw")


@query("SELECT log_pos - min(log_pos) OVER () + 101 AS expected, log_pos FROM (SELECT row_number() OVER (ORDER BY observed_date, incident_uid, log_pos) AS log_pos FROM changelog)")
def numbered_events(spark, d):
    """The change log numbered on from the end of a log of a hundred events: numbers without gap or repeat."""
    ordered = table(spark, d, "changelog").drop("log_pos").repartitionByRange("observed_date", "incident_uid").sortWithinPartitions("observed_date", "incident_uid")
    folder = f"{checkpoint_folder(spark)}/log-{uuid.uuid4().hex}"
    ordered.write.parquet(folder)
    numbered, _ = archive_sink.number_events(spark.read.parquet(folder), 100)
    return numbered.select(F.col("log_pos").alias("expected"), (F.col("log_pos") - 100).alias("log_pos"))


@query(f"WITH {q.ARCHIVE} SELECT status AS key, count(*) AS n FROM arch GROUP BY 1")
def page_slice(spark, d):
    """What of the payload goes into a page, read back from the page."""
    counts = archive(spark, d).groupBy(F.col("status").alias("key")).agg(F.count("*").alias("n"))
    page = export.render_page("<p>{{title}}</p><script>{{payload}}</script>", {"title": "status"}, export.payload({"counts": counts, "other": counts.limit(0)}), ["counts"])
    found = json.loads(page.split("<script>")[1].split("</script>")[0].replace("<\\/", "</"))["counts"]
    return spark.createDataFrame([(r["key"], r["n"]) for r in found], "key string, n bigint")


@query("""SELECT row_id, replace(replace(replace(replace(replace(coalesce(nature_raw, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS html,
  CASE WHEN length(narrative_raw) > 60 THEN rtrim(narrative_raw[1:59], ' ') || '…' ELSE narrative_raw END AS clipped FROM incidents""")
def page_texts(spark, d):
    return table(spark, d, "incidents").select("row_id", tokens.escape_html(_text("nature_raw")).alias("html"), tokens.clip(F.col("narrative_raw"), 60).alias("clipped"))


@query(f"""WITH {q.DERIVED}, v AS (SELECT uid, occ_precision FROM der WHERE occ_precision IN ('day', 'month', 'year', 'unknown', 'range_start'))
  SELECT 'imprecise_occurred' AS "check", uid, occ_precision AS detail FROM v ORDER BY uid, detail LIMIT 40""")
def quality_head(spark, d):
    """The first forty rows of a check, as its page lists them."""
    return derive.first_of_each_check(derive.quality_audit(derived(spark, d), 2026).filter(F.col("check") == "imprecise_occurred"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
