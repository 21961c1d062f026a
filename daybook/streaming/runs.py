"""Arriving snapshots merged run by run, and the ladders as keyed state.

The merge needs a whole run at once (buckets, per-file guards), so it runs in
``foreachBatch``; a run is applied once, whatever is delivered again, since a
version is named after it.  The absence ladder alone also comes as keyed state.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daybook.operators.merge import CONFIRMATIONS, merge
from daybook.session import bounded_rows
from daybook.sinks.archive import write_version
from daybook.sources.landed import read_archive, read_pointers
from daybook.sources.pages import is_dead_page, parse_legacy, wrong_header
from daybook.sources.sheet import key_records


def apply_run(spark: SparkSession, root: str, observed: DataFrame, files: DataFrame, run: str, confirm_withdrawals: bool = True, event_source: str | None = None, capture_timestamp: str | None = None) -> bool:
    """Merges one run (a date, or date.seq) into the archive below ``root``; False where it was applied before."""
    versions = [p["version"] for p in read_pointers(spark, root)]
    if versions and versions[-1] >= run:
        return False
    of_day = 1 + sum(v[:10] == run[:10] for v in versions)
    result = merge(read_archive(spark, root), observed, files, run[:10], confirm_withdrawals, of_day)
    write_version(spark, root, result, run, event_source, capture_timestamp)
    return True


def replay(spark: SparkSession, root: str, snapshots: DataFrame, files_of: Callable[[DataFrame], DataFrame], confirm_withdrawals: bool = True) -> list[str]:
    """Rebuilds the archive from all snapshots in the order of (date, seq), from empty; returns the runs applied.

    ``snapshots`` has the columns of an observation and snapshot_date and
    snapshot_seq; ``files_of`` gives the file table of one run's observations.
    """
    listed = snapshots.select("snapshot_date", "snapshot_seq").distinct().orderBy("snapshot_date", "snapshot_seq")
    runs = [(r["snapshot_date"], r["snapshot_seq"]) for r in bounded_rows(listed, CAPTURE_BOUND, "the list of snapshots")]
    applied = []
    for day, seq in runs:
        name = f"{day:%Y-%m-%d}.{seq:04d}"
        one = snapshots.filter((F.col("snapshot_date") == F.lit(day)) & (F.col("snapshot_seq") == seq))
        if apply_run(spark, root, one, files_of(one), name, confirm_withdrawals):
            applied.append(name)
    return applied


#: Most captures of a replay, and most snapshots (their names are listed on the driver, each is a run).
CAPTURE_BOUND = 200_000


def replay_captures(spark: SparkSession, root: str, captures: DataFrame) -> dict[str, int]:
    """Merges captures of legacy pages in the order of time across months; returns how many came to what.

    ``captures`` has month, stamp (yyyyMMddHHmmss) and html, null where the
    fetch failed; a repeated capture counts once.  ``failed`` counts fetches
    and headers that failed, ``dead`` pages without a table, ``empty`` tables
    without a record and ``used`` those merged, now or before.  Each month is a
    file of its own, and absences are flagged, not counted.
    """
    once = captures.groupBy("month", "stamp").agg(F.max("html").alias("html"))
    html = F.col("html")
    outcome = F.when(html.isNull(), "failed").when(is_dead_page(html), "dead").when(wrong_header(html), "failed").otherwise("used")
    came = once.select("month", "stamp", outcome.alias("outcome"))
    counts = {"used": 0, "dead": 0, "failed": 0, "empty": 0}
    for c in bounded_rows(came.orderBy("stamp", "month"), CAPTURE_BOUND, "the list of captures"):
        kind = c["outcome"]
        if kind == "used":
            one = once.filter((F.col("month") == c["month"]) & (F.col("stamp") == c["stamp"]))
            placed = parse_legacy(one).withColumns({"source_file_id": F.concat(F.lit("wayback:"), "source_month"), "file_order": F.lit(0), "error": F.lit(None).cast("string")})
            if placed.isEmpty():
                kind = "empty"
            else:
                files = spark.createDataFrame([(f"wayback:{c['month']}", True, f"legacy {c['month']}", c["month"], False, False)], "source_file_id string, fetched boolean, name string, month string, removed boolean, repurposed boolean")
                stamp = c["stamp"]
                run = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}.{stamp[8:]}.{re.sub(r'[^0-9A-Za-z]+', '_', c['month'])}"
                apply_run(spark, root, key_records(placed), files, run, confirm_withdrawals=False, event_source="wayback", capture_timestamp=stamp)
        counts[kind] += 1
    return counts


def stream_runs(snapshots: DataFrame, root: str, files_of: Callable[[DataFrame], DataFrame], checkpoint: str):
    """A query that merges the snapshots of each micro-batch in their own order; start it with ``.start()``."""

    def each(batch: DataFrame, _: int) -> None:
        replay(batch.sparkSession, root, batch, files_of)

    return snapshots.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)


EPOCH = dt.date(1970, 1, 1)
LADDER = "uid string, day date, status string, confirmations int"


def stream_absences(observations: DataFrame, delay: str = "30 days") -> DataFrame:
    """Status of each uid after each observed day: uid, day, status, confirmations.

    ``observations`` is a stream of uid, day (date) and present.  A day counts
    once, present if any row says so.  Days are held as state until the
    watermark (the newest day less ``delay``) has passed them, and then counted
    in their order; so a day that arrives late counts in its place, and the
    result is that of :func:`daybook.operators.ladders.absence_runs`.  Only
    what comes later than ``delay`` is left out, by the watermark.
    """
    timed = observations.select("uid", F.timestamp_seconds(F.unix_date("day").cast("long") * 86_400).alias("at"), F.unix_date("day").alias("nth"), F.coalesce("present", F.lit(False)).alias("present")).withWatermark("at", delay)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, days, shown = state.get if state.exists else (0, [], [])
        held = dict(zip(days, shown, strict=True))
        for pdf in batches:
            for day, present in zip(pdf["nth"].tolist(), pdf["present"], strict=True):
                held[day] = held.get(day, False) or bool(present)
        passed, out = state.getCurrentWatermarkMs() // 86_400_000, []
        for day in sorted(d for d in held if d < passed):
            count = 0 if held.pop(day) else count + 1
            out.append((key[0], EPOCH + dt.timedelta(days=day), "active" if not count else "withdrawn" if count >= CONFIRMATIONS else "missing", count))
        ordered = sorted(held)
        state.update((count, ordered, [held[d] for d in ordered]))
        if ordered:
            state.setTimeoutTimestamp(max((ordered[0] + 1) * 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["uid", "day", "status", "confirmations"])

    return timed.groupBy("uid").applyInPandasWithState(step, LADDER, "count int, days array<int>, shown array<boolean>", "append", GroupStateTimeout.EventTimeTimeout)
