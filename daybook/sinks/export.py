"""Exports: delimited text, JSON payloads and pages."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import bounded_rows

#: Most rows of a payload table that goes into a page.
PAYLOAD_BOUND = 200_000


def tsv_lines(df: DataFrame) -> DataFrame:
    """One column ``line``: the values with tabs between them; tabs and line ends inside become a blank."""
    cells = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\t\r\n]+", " ") for c in df.columns]
    return df.select(F.concat_ws("\t", *cells).alias("line"))


def csv_lines(df: DataFrame) -> DataFrame:
    """One column ``line`` after RFC 4180: quoted where a value holds a quote, a comma or a line end."""

    def cell(c: str):
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.when(text.rlike(r'[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return df.select(F.concat_ws(",", *[cell(c) for c in df.columns]).alias("line"))


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header, a byte order mark and CRLF line ends."""
    header = "﻿" + ",".join(f'"{c}"' if re.search(r'[",]', c) else c for c in df.columns)
    body = csv_lines(df).select(F.concat(F.col("line"), F.lit("\r")).alias("value"))
    first = df.sparkSession.createDataFrame([(header + "\r",)], "value string")
    first.unionByName(body).coalesce(1).write.mode("overwrite").text(path)


def write_payload(folder: str, tables: dict[str, DataFrame]) -> None:
    """The whole payload, of any size: a folder of JSON files a table, one row a line, nulls kept."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{name}")


def payload(tables: dict[str, DataFrame]) -> str:
    """The part that goes into a page: one JSON document with a list of rows a table; sizes are checked, keys sorted."""
    whole = {name: [json.loads(r[0]) for r in bounded_rows(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})), PAYLOAD_BOUND, name)] for name, df in tables.items()}
    return json.dumps(whole, ensure_ascii=False, sort_keys=True)


def render_page(template: str, values: dict[str, str], payload_json: str, keys: list[str]) -> str:
    """A template with its ``{{name}}`` places filled and the payload's ``keys`` under ``{{payload}}``.

    A key the payload lacks and a place left over are errors; ``</`` is escaped.
    """
    whole = json.loads(payload_json)
    lacking = [k for k in keys if k not in whole]
    if lacking:
        raise KeyError(f"the payload lacks {lacking}")
    part = json.dumps({k: whole[k] for k in keys}, ensure_ascii=False).replace("</", "<\\/")
    for name, value in (values | {"payload": part}).items():
        template = template.replace("{{" + name + "}}", value)
    left = re.findall(r"\{\{\w+\}\}", template)
    if left:
        raise ValueError(f"places left over: {left}")
    return template


def write_pages(folder: str, pages: dict[str, str]) -> list[str]:
    """Writes pages and removes those no longer made; returns the removed names."""
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    stale = [p for p in root.glob("*.html") if p.name not in pages]
    for p in stale:
        p.unlink()
    for name, text in pages.items():
        (root / name).write_text(text, encoding="utf-8")
    return sorted(p.name for p in stale)
