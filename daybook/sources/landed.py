"""Archive, change log, run records and manifest as they lie in storage."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.merge import ARCHIVE_SCHEMA, LOG_SCHEMA, empty_archive

MANIFEST_SCHEMA = """archive_started date, files map<string, struct<name:string, month:string, first_seen:date, last_verified:date, status:string, missing_since:date,
absent_count:int, last_absent_date:date, month_change_count:int, last_tab_census:date, tabs:array<string>, snapshots:array<struct<date:string,sha256:string,bytes:bigint>>>>"""
RUN_SCHEMA = """date date, folder_id string, files map<string, struct<name:string, month:string, status:string, rows:int, sha256:string, snapshot_written:boolean, error:string>>,
alarms array<string>, warnings array<string>, merge struct<added:int, amended:int, missing:int, withdrawn:int, source_removed:int, reappeared:int, relocated:int,
superseded:int, unchanged:int, quarantined:array<string>, warnings:array<string>, changed:boolean>, summary string, archive_rows int"""


def read_pointers(spark: SparkSession, root: str) -> list[dict]:
    """The pointers below ``root`` in order: number, version, log_end (events up to and with it); one small file a run.

    Versions without any pointer are an error, as an archive that lost its
    pointers must not pass for an empty one.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = path(f"{root}/pointers")
    if not fs.exists(folder) or not fs.listStatus(folder):
        if fs.exists(path(f"{root}/versions")):
            raise FileNotFoundError(f"{root} has versions but no pointer")
        return []
    lines = spark.read.text(f"{root}/pointers/*.json", wholetext=True).collect()  # one a run
    return sorted((json.loads(r[0]) for r in lines), key=lambda p: p["number"])


def read_pointer(spark: SparkSession, root: str) -> str | None:
    """The name of the version in force below ``root``, or null where nothing was written yet."""
    pointers = read_pointers(spark, root)
    return pointers[-1]["version"] if pointers else None


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    version = read_pointer(spark, root)
    return spark.read.schema(ARCHIVE_SCHEMA).parquet(f"{root}/versions/{version}") if version else empty_archive(spark)


def read_changelog(spark: SparkSession, root: str) -> DataFrame:
    """The events of all versions in force (LOG_SCHEMA); those of a run that was lost half way have no pointer and aren't read."""
    paths = [f"{root}/changelog/{p['version']}" for p in read_pointers(spark, root)]
    return spark.read.schema(LOG_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], LOG_SCHEMA)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run records, one a file; unreadable ones are left out."""
    runs = spark.read.schema(RUN_SCHEMA + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True, mode="PERMISSIVE")
    return runs.filter(F.col("date").isNotNull() & F.col("_corrupt").isNull()).drop("_corrupt")


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(files, snapshots) of a manifest: one row a file, and one a file and snapshot with its number on that day."""
    whole = spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=True, mode="FAILFAST")
    files = whole.select(F.explode("files").alias("source_file_id", "f")).select("source_file_id", "f.*")
    snapshots = files.select("source_file_id", F.posexplode("snapshots").alias("nth", "s")).select("source_file_id", "nth", "s.*")
    return files.drop("snapshots"), snapshots
