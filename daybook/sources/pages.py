"""HTML pages: folder listings, legacy tables and capture indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.identity import collapse

# The columns of a legacy table and the most entries a listing can have before it is cut off.
LEGACY_HEADER = ["Case Number", "Date/Time Reported", "Date/Time Occurred", "Nature", "General Location", "Disposition"]
LISTING_LIMIT = 50
_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
_CELL = r"(?is)<(?:td|th)\b[^>]*>(.*?)</(?:td|th)>"


def listing_entries(page: Column, ids: str = r'id="entry-([^"]+)"', names: str = r'<div class="flip-entry-title">([^<]*)</div>', stamps: str = r'<div class="flip-entry-last-modified"><div>([^<]*)</div>') -> Column:
    """The entries of a folder page: array of (id, name, modified), from three lists of equal length.

    A page without entries, with lists of different lengths or with as many
    entries as a page can hold is an error: its markup may have changed.
    """
    a, b, c = (F.regexp_extract_all(page, F.lit(p), 1) for p in (ids, names, stamps))
    wrong = (F.size(a) == 0) | (F.size(a) != F.size(b)) | (F.size(a) != F.size(c)) | (F.size(a) >= LISTING_LIMIT)
    zipped = F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), c.alias("c")), lambda e: F.struct(e["a"].alias("id"), unescape(e["b"]).alias("name"), e["c"].alias("modified")))
    failed = F.raise_error(F.format_string("listing: %d ids, %d names, %d stamps", F.size(a), F.size(b), F.size(c))).cast("array<struct<id:string,name:string,modified:string>>")
    return F.when(wrong, failed).otherwise(zipped)


# Named entities and their code points.
ENTITIES = {
    "lt": 60, "gt": 62, "quot": 34, "apos": 39, "nbsp": 160, "ndash": 8211, "mdash": 8212, "lsquo": 8216, "rsquo": 8217, "ldquo": 8220, "rdquo": 8221, "bull": 8226, "middot": 183,
    "hellip": 8230, "deg": 176, "frac12": 189, "frac14": 188, "eacute": 233, "egrave": 232, "agrave": 224, "aacute": 225, "iacute": 237, "oacute": 243, "uacute": 250, "ntilde": 241, "ccedil": 231, "uuml": 252, "ouml": 246, "auml": 228, "copy": 169, "reg": 174, "trade": 8482,
}


def unescape(text: Column) -> Column:
    """Entities resolved: the named ones above and numeric ones, once each (``&amp;lt;`` becomes ``&lt;``)."""
    names = F.create_map(*[F.lit(x) for n, code in [*ENTITIES.items(), ("amp", 38)] for x in (n, code)])
    # Pieces of text and entities in turn, so that what an entity becomes is not read again.
    pieces = F.split(F.regexp_replace(text, r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});", "\u0002$1\u0003"), "\u0002")

    def code(name: Column) -> Column:
        return F.when(F.startswith(F.lower(name), F.lit("#x")), F.conv(F.substring(name, 3, 6), 16, 10).cast("int")).when(F.startswith(name, F.lit("#")), F.substring(name, 2, 7).try_cast("int")).otherwise(F.try_element_at(names, name))

    def piece(p: Column, i: Column) -> Column:
        name, rest = F.split_part(p, F.lit("\u0003"), F.lit(1)), F.split_part(p, F.lit("\u0003"), F.lit(2))
        # "char" knows code points below 256 only; others are decoded from UTF-16.
        n = code(name)
        sign = F.when(n < 65_536, F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE"))
        return F.when((i == 0) | ~F.contains(p, F.lit("\u0003")), p).otherwise(F.concat(F.coalesce(sign, F.concat(F.lit("&"), name, F.lit(";"))), rest))

    resolved = F.array_join(F.transform(pieces, piece), "")
    return F.when(F.contains(text, F.lit("&")), resolved).otherwise(text)


def plain_text(html: Column) -> Column:
    """Text of a cell: tags out, entities resolved, blanks collapsed."""
    return collapse(unescape(F.regexp_replace(html, r"(?s)<[^>]+>", "")))


def lines_of(html: Column) -> Column:
    """Texts of the lines of a cell without list marks and empty ones."""
    lines = F.split(F.regexp_replace(html, r"(?i)<br\s*/?>", "\u0001"), "\u0001")
    texts = F.transform(lines, lambda x: F.trim(F.regexp_replace(plain_text(x), r"^[•\-*]\s*", "")))
    return F.filter(texts, lambda x: x != "")


def bullets(html: Column) -> Column:
    """Text of a cell whose lines become one ``; `` list."""
    return F.array_join(lines_of(html), "; ")


def table_rows(html: Column) -> Column:
    """Rows of a page's tables as arrays of cell markup."""
    return F.transform(F.regexp_extract_all(html, F.lit(_ROW), 1), lambda r: F.regexp_extract_all(r, F.lit(_CELL), 1))


def is_dead_page(html: Column) -> Column:
    """Whether a page holds no row of the table's width."""
    return ~F.exists(table_rows(F.coalesce(html, F.lit(""))), lambda r: F.size(r) == len(LEGACY_HEADER))


def split_location(cell: Column) -> Column:
    """struct(campus, location) of a "General Location" cell: the first bold part, and the rest as a list."""
    bold = r"(?is)<strong[^>]*>(.*?)</strong>"
    campus = plain_text(F.regexp_extract(cell, bold, 1))
    rest = F.regexp_replace(cell, r"(?is)^(.*?)<strong[^>]*>.*?</strong>", "$1")
    return F.struct(campus.alias("campus"), bullets(rest).alias("location"))


def split_disposition(cell: Column) -> Column:
    """struct(text, student_flag) of a disposition cell; the line with a bold "Student?:" is the flag (the last one where there are several)."""
    label = r"(?is)<strong[^>]*>\s*Student\?:\s*</strong>\s*(.*)$"
    lines = F.split(F.regexp_replace(cell, r"(?i)<br\s*/?>", "\u0001"), "\u0001")
    flag = F.try_element_at(F.filter(lines, lambda p: p.rlike(label)), F.lit(-1))
    kept = F.array_join(F.filter(lines, lambda p: ~p.rlike(label)), "<br>")
    return F.struct(bullets(kept).alias("text"), F.coalesce(plain_text(F.regexp_extract(flag, label, 1)), F.lit("")).alias("student_flag"))


def _header_place(rows: Column) -> Column:
    """Place (from 1) of the row that begins with the first column's name, 0 where there is none."""
    return F.array_position(F.transform(rows, lambda r: plain_text(F.try_element_at(r, F.lit(1))) == LEGACY_HEADER[0]), True)


def legacy_header(html: Column) -> Column:
    """The texts of the header row, an empty array where there is none."""
    rows = table_rows(html)
    return F.coalesce(F.transform(F.try_element_at(rows, F.nullif(_header_place(rows), F.lit(0)).cast("int")), plain_text), F.array().cast("array<string>"))


def wrong_header(html: Column) -> Column:
    """Whether a page with a table of the known width lacks the known header row."""
    return ~is_dead_page(html) & (legacy_header(html) != F.array(*[F.lit(h) for h in LEGACY_HEADER]))


def parse_legacy(pages: DataFrame, html: str = "html", month: str = "month") -> DataFrame:
    """Records of legacy pages: the verbatim fields, student_flag, source_month and source_era.

    The row that begins with the first column's name has to be the six known
    columns; rows before it, of another width or without a case number are passed over.  Dead pages give no rows.
    """
    # The rows are worked out once a page, the check of the header with them.
    pages = pages.withColumn("_rows", table_rows(F.col(html)))
    rows = F.col("_rows")
    place = _header_place(rows)
    header = F.coalesce(F.transform(F.try_element_at(rows, F.nullif(place, F.lit(0)).cast("int")), plain_text), F.array().cast("array<string>"))
    dead = ~F.exists(rows, lambda r: F.size(r) == len(LEGACY_HEADER))
    wrong = ~dead & (header != F.array(*[F.lit(h) for h in LEGACY_HEADER]))
    failed = F.raise_error(F.concat(F.lit("legacy header: "), F.array_join(header, "|"))).cast("array<array<string>>")
    # The header is part of the array that is exploded, so no filter can be moved before its check.
    after = F.filter(F.slice(rows, F.greatest(place + 1, F.lit(1)).cast("int"), F.size(rows)), lambda r: F.size(r) == len(LEGACY_HEADER))
    body = F.when(wrong, failed).when(dead, F.slice(rows, 1, 0)).otherwise(after)
    checked = pages.select(F.col(month).alias("source_month"), F.posexplode(body).alias("place", "cells"))
    c = lambda k: F.col("cells")[k]
    one_line = lambda k: F.array_join(lines_of(c(k)), " ")
    where, outcome = split_location(c(4)), split_disposition(c(5))
    out = checked.select(
        plain_text(c(0)).alias("case_number_raw"), one_line(1).alias("date_reported_raw"), one_line(2).alias("date_occurred_raw"), bullets(c(3)).alias("nature_raw"), F.lit("").alias("narrative_raw"),
        where["campus"].alias("campus_raw"), where["location"].alias("location_raw"), outcome["text"].alias("disposition_raw"), outcome["student_flag"].alias("student_flag"), "source_month",
        F.lit("legacy-page").alias("source_era"), (F.col("place") + 1).alias("source_row_index"),
    )
    return out.filter("case_number_raw <> ''")


def capture_index(lines: DataFrame, column: str = "value") -> DataFrame:
    """Captures of an index (JSON array of arrays, header first): month, stamp, url; only status 200 and readable months.

    The header names the columns; addresses aren't collapsed.
    """
    rows = F.from_json(F.col(column), "array<array<string>>")
    indexed = lines.select(rows.alias("rows")).select(F.try_element_at("rows", F.lit(1)).alias("names"), F.explode(F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))).alias("row"))
    at = lambda name: F.try_element_at(F.map_from_arrays("names", "row"), F.lit(name))
    months = "january|february|march|april|may|june|july|august|september|october|november|december"
    picked = indexed.select(at("timestamp").alias("stamp"), at("original").alias("url"), at("statuscode").alias("status"))
    name = F.regexp_extract(F.lower("url"), rf"({months})[-_]?(20\d{{2}})", 1)
    month = F.concat(F.initcap(name), F.lit(" "), F.regexp_extract(F.lower("url"), rf"({months})[-_]?(20\d{{2}})", 2))
    nth = F.row_number().over(Window.partitionBy("month").orderBy("stamp", "url"))
    return picked.filter((F.col("status") == "200") & (name != "")).select(month.alias("month"), "stamp", "url").withColumn("nth", nth)
