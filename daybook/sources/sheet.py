"""Monthly sheets: landed CSV exports behind validation gates.

``gate_exports`` decides which landed files may be read, ``read_sheets`` turns
accepted ones into keyed records, and the ``monthly_sheet`` data source reads a
folder of sheets as a table.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from daybook.functions.identity import FIELDS, content_hash, incident_uid, normalize_case_number

# What an export has to show.
LEAST_BYTES = 200
LEAST_LINES = 3
HEADER_MARK = "Case Number"
HEADER_ROWS = 10
BANNER = r"Daily Crime Log,\s*([A-Z][a-z]+ \d{4})"


class SheetError(ValueError):
    """A file doesn't look like a monthly sheet."""


def tab_name(disposition: Column) -> Column:
    """The tab named in a content-disposition header: the last part of the file name after " - ", else null."""
    extended = F.regexp_extract(disposition, r"(?i)filename\*=UTF-8''([^;]+)", 1)
    quoted = F.regexp_extract(disposition, r'(?i)filename="([^"]+)"', 1)
    name = F.coalesce(F.nullif(F.try_url_decode(extended), F.lit("")), F.nullif(quoted, F.lit("")))
    parts = F.split(F.regexp_replace(name, r"(?i)\.csv$", ""), " - ")
    return F.when(F.size(parts) > 1, F.trim(F.element_at(parts, -1)))


def gate_exports(files: DataFrame, expected_tab: str | None = None) -> DataFrame:
    """``files`` (content BINARY, content_type, content_disposition, ...) with ``rejected``: the reason, or null.

    Gates, in order: content type, size, tab name where one is known, the
    header literal, and the number of lines.
    """
    text = F.make_valid_utf8(F.col("content").cast("string"))
    tab = tab_name(F.col("content_disposition"))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    rejected = (
        F.when(~F.startswith(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("text/csv")), "content type")
        .when(F.coalesce(F.octet_length("content"), F.lit(0)) < LEAST_BYTES, "size")
        .when(tab.isNotNull() & (F.lit(expected_tab).isNotNull()) & (tab != F.lit(expected_tab)), "tab")
        .when(~F.contains(text, F.lit(HEADER_MARK)), "header")
        .when(lines < LEAST_LINES, "lines")
    )
    return files.withColumn("rejected", rejected)


def sheet_rows(data: bytes, name: str = "") -> tuple[str, list[tuple[int, list[str]]]]:
    """(month, [(row number, eight fields)]) of one sheet; the header is found by content, columns by name."""
    text = data.decode("utf-8-sig", "replace")
    table = list(csv.reader(io.StringIO(text, newline="")))
    month = re.search(BANNER, table[0][0]) if table and table[0] else None
    at = next((i for i, row in enumerate(table[:HEADER_ROWS]) if any(c.strip() == HEADER_MARK for c in row)), None)
    if at is None:
        raise SheetError(f"{name}: no header row in the first {HEADER_ROWS}")
    header = [c.strip() for c in table[at]]
    lacking = [c for c in FIELDS.values() if c not in header]
    if lacking:
        raise SheetError(f"{name}: columns are lacking: {lacking}")
    places = [header.index(c) for c in FIELDS.values()]
    out = []
    for number, row in enumerate(table[at + 1 :], start=at + 2):
        values = [row[p].strip() if p < len(row) else "" for p in places]
        if any(values):
            out.append((number, values))
    return month[1] if month else "", out


_RAW = "source_file_id string, snapshot_date date, snapshot_seq int, source_month string, source_row_index int, " + ", ".join(f"{f} string" for f in FIELDS) + ", error string"


def parse_sheets(files: DataFrame) -> DataFrame:
    """Rows of the sheets in ``files`` (source_file_id, content): verbatim fields, month and row number.

    ``snapshot_date`` and ``snapshot_seq`` are carried where ``files`` has them,
    else null.  A sheet that can't be read gives one row with ``error`` set and
    no fields.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["source_file_id", "snapshot_date", "snapshot_seq", "source_month", "source_row_index", *FIELDS, "error"]
        types = [pa.string(), pa.date32(), pa.int32(), pa.string(), pa.int32(), *[pa.string()] * len(FIELDS), pa.string()]
        for batch in batches:
            rows = []
            for *of, content in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                try:
                    month, found = sheet_rows(content or b"", of[0] or "")
                    rows += [(*of, month, number, *values, None) for number, values in found]
                except (SheetError, csv.Error) as e:
                    rows.append((*of, None, None, *[None] * len(FIELDS), str(e)))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    carried = [(F.col(c) if c in files.columns else F.lit(None)).cast(t).alias(c) for c, t in (("snapshot_date", "date"), ("snapshot_seq", "int"))]
    return files.select("source_file_id", *carried, "content").mapInArrow(run, _RAW)


def flag_near_duplicates(records: DataFrame, file: str = "source_file_id") -> DataFrame:
    """``records`` with flags: near_duplicate where another row of the file (and snapshot) has the same case number and differs in dates at most."""
    same = [c for c in FIELDS if c not in ("date_reported_raw", "date_occurred_raw", "case_number_raw")]
    snapshot = [c for c in ("snapshot_date", "snapshot_seq") if c in records.columns]
    group = Window.partitionBy(file, *snapshot, normalize_case_number(F.col("case_number_raw")), F.col("case_number_raw"), *same)
    return records.withColumn("flags", F.when(F.count("*").over(group) > 1, "near_duplicate").otherwise(""))


def key_records(rows: DataFrame) -> DataFrame:
    """Parsed rows with incident_uid, content_hash and flags."""
    keyed = rows.filter("error IS NULL").drop("error")
    keyed = keyed.withColumns({"incident_uid": incident_uid(F.col("case_number_raw"), F.col("date_reported_raw")), "content_hash": content_hash(*[F.col(f) for f in FIELDS])})
    return flag_near_duplicates(keyed)


def snapshot_of(path: Column) -> Column:
    """struct(source_file_id, snapshot_date, snapshot_seq) of a landed file's path.

    Snapshots lie as ``<file id>/<date>.csv``, a second one of a day as
    ``<date>.2.csv``.  A file of another name is a sheet by itself: its name is
    its id, and it has no date.
    """
    dated = r"([^/]+)/(\d{4}-\d{2}-\d{2})(?:\.(\d+))?\.csv$"
    is_dated = path.rlike(dated)
    file_id = F.url_decode(F.replace(F.when(is_dated, F.regexp_extract(path, dated, 1)).otherwise(F.regexp_extract(path, r"([^/]+?)(?:\.csv)?$", 1)), F.lit("+"), F.lit("%2B")))
    number = F.coalesce(F.nullif(F.regexp_extract(path, dated, 3), F.lit("")).cast("int"), F.lit(1))
    return F.struct(file_id.alias("source_file_id"), F.when(is_dated, F.regexp_extract(path, dated, 2)).try_cast("date").alias("snapshot_date"), F.when(is_dated, number).alias("snapshot_seq"))


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """Keyed records of all sheets below ``path``, a folder on any storage of the cluster, with file id and snapshot."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(path)
    return key_records(parse_sheets(files.select(snapshot_of(F.col("path")).alias("s"), "content").select("s.*", "content")))


def tab_names(archive: bytes) -> list[str]:
    """Tabs of a zipped export: its members that end in .html, in order."""
    with zipfile.ZipFile(io.BytesIO(archive)) as z:
        return [Path(n).stem for n in z.namelist() if n.lower().endswith(".html")]


def tab_census(files: DataFrame) -> DataFrame:
    """source_file_id and tabs of zipped exports (content); null where a file is no archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for content in batch.column(1).to_pylist():
                try:
                    out.append(tab_names(content or b""))
                except zipfile.BadZipFile:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["source_file_id", "tabs"])

    return files.select("source_file_id", "content").mapInArrow(run, "source_file_id string, tabs array<string>")


class _SheetPart(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def _storage(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path on it; a plain path is local."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class _SheetReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        storage, root = _storage(self.folder)
        found = storage.get_file_info(pafs.FileSelector(root, recursive=True))
        return [_SheetPart(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and f.path.endswith(".csv")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        storage, _ = _storage(self.folder)
        with storage.open_input_stream(partition.path) as stream:
            data = stream.read()
        *_, folder, name = f"//{partition.path}".split("/")
        dated = re.fullmatch(r"(\d{4}-\d{2}-\d{2})(?:\.(\d+))?\.csv", name)
        of = (folder, dt.date.fromisoformat(dated[1]), int(dated[2] or 1)) if dated else (name.removesuffix(".csv"), None, None)
        month, rows = sheet_rows(data, name)
        for number, values in rows:
            yield (*of, month, number, *values)


class MonthlySheetSource(DataSource):
    """``spark.read.format("monthly_sheet").load(folder)``: verbatim rows of all sheets, a task a file."""

    @classmethod
    def name(cls) -> str:
        return "monthly_sheet"

    def schema(self) -> str:
        return _RAW.rsplit(", error", 1)[0]

    def reader(self, schema) -> DataSourceReader:
        return _SheetReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MonthlySheetSource)
