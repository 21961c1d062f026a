"""Confirmation ladders, run bookkeeping and change logs as set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.merge import CONFIRMATIONS

#: Days after which the tabs of a sheet are counted again.
CENSUS_DAYS = 7


def absence_runs(observations: DataFrame, key: str, day: str, present: str) -> DataFrame:
    """Runs of consecutive absent observations: key, since, until, confirmations, withdrawn.

    ``observations`` has at most one row a key and day that counts (several on
    one day count once, present if any says so).  A presence ends a run.  The
    frame is per key and day; its rows are bounded by the days observed.
    """
    daily = observations.groupBy(key, day).agg(F.max(F.col(present).cast("int")).alias("p"))
    order = Window.partitionBy(key).orderBy(day)
    island = F.sum("p").over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = daily.withColumn("island", island).filter("p = 0").groupBy(key, "island")
    out = runs.agg(F.min(day).alias("since"), F.max(day).alias("until"), F.count("*").alias("confirmations"))
    return out.select(key, "since", "until", "confirmations", (F.col("confirmations") >= CONFIRMATIONS).alias("withdrawn"))


def step_file_ladder(files: DataFrame, rows_by_file: DataFrame, today: str) -> DataFrame:
    """The next state of each file: source_file_id, state, absent_count, last_absent_date, alarm.

    ``files`` has source_file_id, fetched, absent_count, last_absent_date;
    ``rows_by_file`` source_file_id and n (archived rows).  A file that fails
    without archived rows is pending; one failing on three days is removed, and
    raises the alarm on that and every later run.
    """
    day = F.lit(today).cast("date")
    j = files.join(rows_by_file.select("source_file_id", "n"), "source_file_id", "left")
    count = F.coalesce("absent_count", F.lit(0))
    stepped = F.coalesce(F.col("last_absent_date") == day, F.lit(False))
    pending = F.coalesce("n", F.lit(0)) == 0
    after = F.when(F.col("fetched"), 0).when(pending | stepped, count).otherwise(count + 1)
    state = F.when(F.col("fetched"), "active").when(pending, "pending").when(after >= CONFIRMATIONS, "removed").otherwise("unfetched")
    return j.select("source_file_id", state.alias("state"), after.alias("absent_count"), F.when(~F.col("fetched") & ~pending, day).otherwise(F.col("last_absent_date")).alias("last_absent_date"), (state == "removed").alias("alarm"))


def step_month_change(files: DataFrame, stale: DataFrame, least: int = 2) -> DataFrame:
    """Month-change counters: source_file_id, month_change_count, repurposed.

    ``files`` has source_file_id, fetched, month, month_change_count; ``stale``
    the ids of files with rows of another month.  Counts runs, not days; an
    unreadable month leaves the counter.
    """
    j = files.join(stale.select("source_file_id").distinct().withColumn("is_stale", F.lit(True)), "source_file_id", "left")
    count = F.coalesce("month_change_count", F.lit(0))
    readable = F.col("fetched") & (F.coalesce("month", F.lit("")) != "")
    after = F.when(~readable, count).when(F.coalesce("is_stale", F.lit(False)), count + 1).otherwise(0)
    return j.select("source_file_id", after.alias("month_change_count"), (readable & (after >= least)).alias("repurposed"))


def census_due(files: DataFrame, today: str, days: int = CENSUS_DAYS) -> DataFrame:
    """Files whose tabs are to be counted: changed, never counted, or counted ``days`` ago."""
    due = F.col("changed") | F.col("last_tab_census").isNull() | (F.datediff(F.lit(today).cast("date"), F.col("last_tab_census")) >= days)
    return files.select("source_file_id", due.alias("due"))


def target_files(pinned: DataFrame, discovered: DataFrame) -> DataFrame:
    """source_file_id and where it is named: both, only_pinned (missing from the listing), only_discovered (new)."""
    p = pinned.select("source_file_id").distinct().withColumn("p", F.lit(1))
    d = discovered.select("source_file_id").distinct().withColumn("d", F.lit(1))
    kind = F.when(F.col("p").isNull(), "only_discovered").when(F.col("d").isNull(), "only_pinned").otherwise("both")
    return p.join(d, "source_file_id", "full_outer").select("source_file_id", kind.alias("named_in"))


def changed_only(snapshots: DataFrame, key: list[str], order: list[str], hash_column: str = "sha256") -> DataFrame:
    """Snapshots whose hash differs from the one before of the same key."""
    before = F.lag(hash_column).over(Window.partitionBy(*key).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order)) == 1
    return snapshots.withColumn("_before", before).withColumn("_first", first).filter(F.col("_first") | ~F.col(hash_column).eqNullSafe(F.col("_before"))).drop("_before", "_first")


def distinct_events(log: DataFrame, position: str) -> DataFrame:
    """A change log without exact duplicates: of equal events the first is kept.

    Aggregates by a hash of all columns but the position and compares nothing
    else, so a repeated event never gathers its copies in one place.
    """
    others = sorted(c for c in log.columns if c != position)
    digest = F.sha2(F.to_json(F.struct(*others), {"ignoreNullFields": "false"}), 256)
    return log.groupBy(digest.alias("_digest")).agg(F.min(F.struct(F.col(position), *[F.col(c) for c in others])).alias("e")).select("e.*").select(*log.columns)


def rows_by_file(archive: DataFrame) -> DataFrame:
    """source_file_id, n and the months its live rows belong to."""
    live = F.when(F.col("status").isin("active", "missing", "withdrawn") & (F.coalesce("source_month", F.lit("")) != ""), F.col("source_month"))
    return archive.groupBy("source_file_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(live)), ", ").alias("months"))


def lost_entries(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Entries of an index that is only ever added to which are gone; must be empty."""
    return before.join(after, keys, "left_anti")
