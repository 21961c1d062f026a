"""Writing the archive and its change log under one version pointer."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.ladders import changed_only, lost_entries
from daybook.operators.merge import ARCHIVE_COLUMNS, MergeResult, check_invariants
from daybook.sources.landed import read_archive, read_pointers


def write_version(spark: SparkSession, root: str, result: MergeResult, version: str, event_source: str | None = None, capture_timestamp: str | None = None) -> str:
    """Writes archive and new events of a merge as ``version`` and points to it; refuses a broken invariant.

    Both become visible together, by one small file written last that is never
    changed, so a job that is lost half way leaves the version before in force.
    The log grows by the new events only; they are numbered on from its end.
    """
    pointers = read_pointers(spark, root)
    check_invariants(read_archive(spark, root), result)
    result.rows.select(*ARCHIVE_COLUMNS).sort("incident_uid").write.mode("overwrite").parquet(f"{root}/versions/{version}")
    given = {"event_source": event_source, "capture_timestamp": capture_timestamp}
    events = result.events.withColumns({k: F.coalesce(F.col(k), F.lit(v).cast("string")) for k, v in given.items()})
    end = pointers[-1]["log_end"] if pointers else 0
    numbered, n = number_events(events, end)
    numbered.write.mode("overwrite").parquet(f"{root}/changelog/{version}")
    point(spark, root, len(pointers) + 1, version, end + n)
    return version


def number_events(events: DataFrame, end: int) -> tuple[DataFrame, int]:
    """``events`` with log_pos, counting on from ``end`` in their order, and how many there are.

    Numbered within their partitions, with the sizes of the partitions before
    added: no event is moved.  ``events`` has to keep its partitions (it comes
    from a checkpoint).
    """
    marked = events.withColumn("_at", F.monotonically_increasing_id()).withColumns({"_part": F.shiftright("_at", 33), "_nth": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = {r["_part"]: r["n"] for r in marked.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # one row a partition
    before, n = {}, 0
    for part in sorted(sizes):
        before[part], n = n, n + sizes[part]
    starts = F.create_map(*[F.lit(x) for p, b in before.items() for x in (p, b)]) if before else F.lit(None).cast("map<bigint,bigint>")
    return marked.select((F.lit(end) + F.try_element_at(starts, F.col("_part")) + F.col("_nth") + 1).cast("bigint").alias("log_pos"), *events.columns), n


def point(spark: SparkSession, root: str, number: int, version: str, log_end: int) -> None:
    """Puts pointer ``number`` in place in one step; fails where it is there already, as another run was faster."""
    jvm = spark.sparkContext._jvm
    target, staged = (jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}/{number:09d}.json") for folder in ("pointers", f"staged/{version}"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(staged, True)
    stream.write(bytearray(json.dumps({"number": number, "version": version, "log_end": log_end}).encode()))
    stream.close()
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(staged, target):
        raise OSError(f"the pointer to {version} couldn't be set")


def write_json(spark: SparkSession, path: str, content: dict) -> str:
    """One JSON document as a file, staged beside its place so that no half of it can be read."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(staged, True)
    stream.write(bytearray((json.dumps(content, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n").encode()))
    stream.close()
    fs.delete(target, False)
    if not fs.rename(staged, target):
        raise OSError(f"{path} couldn't be written")
    return path


def write_run_record(spark: SparkSession, folder: str, record: dict, day: str) -> str:
    """The record of a run (``RUN_SCHEMA``), one file a day; written whether or not anything changed."""
    return write_json(spark, f"{folder}/{day}.json", {"date": day} | record)


def write_manifest(spark: SparkSession, path: str, manifest: dict) -> str:
    """The whole manifest (``MANIFEST_SCHEMA``), written anew each run."""
    return write_json(spark, path, manifest)


def append_snapshots(index: DataFrame, landed: DataFrame) -> DataFrame:
    """Snapshots to be added to ``index``: those of ``landed`` (source_file_id, date, seq, sha256, bytes) whose content differs from the one before."""
    both = index.select("source_file_id", "date", "seq", "sha256", "bytes", F.lit(False).alias("new")).unionByName(landed.select("source_file_id", "date", "seq", "sha256", "bytes", F.lit(True).alias("new")))
    return changed_only(both, ["source_file_id"], ["date", "seq"]).filter("new").drop("new")


def verify_snapshots(before: DataFrame, after: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Evidence that was lost or altered: source_file_id, date, seq, what (lost, altered); must be empty.

    ``files`` (source_file_id, date, seq, content) is hashed again where given.
    """
    keys = ["source_file_id", "date", "seq"]
    lost = lost_entries(before, after, [*keys, "sha256"]).select(*keys, F.lit("lost").alias("what"))
    if files is None:
        return lost
    altered = after.join(files, keys).filter(F.sha2("content", 256) != F.col("sha256")).select(*keys, F.lit("altered").alias("what"))
    return lost.unionByName(altered)
