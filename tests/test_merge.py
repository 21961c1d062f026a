"""The merge as a state machine, the archive on disk, ladders and streaming."""

from __future__ import annotations

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from daybook.functions.identity import FIELDS
from daybook.operators import ladders, legacy, merge
from daybook.operators.change_feed import current_state
from daybook.operators.history import attribute_history
from daybook.operators.ladders import distinct_events
from daybook.plans.derive import activity
from daybook.sinks.archive import append_snapshots, point, verify_snapshots, write_manifest, write_run_record
from daybook.sources import pages
from daybook.sources.landed import read_archive, read_changelog, read_manifest, read_pointer, read_runs
from daybook.sources.sheet import key_records
from daybook.streaming.runs import apply_run, replay, replay_captures, stream_absences

FILES = "source_file_id string, fetched boolean, name string, month string, removed boolean, repurposed boolean"


def row(case, reported="9/1/26 10:00", occurred="9/1/26 9:00", nature="Theft", file="f", disposition="Open", campus="Main", n=1):
    return (file, "September 2026", n, case, reported, occurred, nature, "text", campus, "hall", disposition, None)


def observe(spark, *rows):
    schema = "source_file_id string, source_month string, source_row_index int, " + ", ".join(f"{f} string" for f in FIELDS) + ", error string"
    keyed = key_records(spark.createDataFrame(list(rows), schema))
    return keyed.withColumns({"file_order": F.lit(1), "student_flag": F.lit(""), "source_era": F.lit("sheet-2026")})


def files(spark, **changes):
    base = {"fetched": True, "name": "September", "month": "September 2026", "removed": False, "repurposed": False} | changes
    return spark.createDataFrame([("f", *base.values())], FILES)


def run(spark, existing, rows, day, **changes):
    confirm = changes.pop("confirm", True)
    result = merge.merge(existing, observe(spark, *rows), files(spark, **changes), day, confirm)
    kept = spark.createDataFrame(result.rows.collect(), merge.ARCHIVE_SCHEMA)
    return kept, sorted(e.change_type for e in result.events.collect()), result


MANY = [row(f"NUPD 26-{10000 + k}", reported=f"9/{k + 1}/26 10:00", n=k) for k in range(25)]


@pytest.fixture(scope="module")
def base(spark):
    kept, events, _ = run(spark, merge.empty_archive(spark), MANY, "2026-09-20")
    assert events == ["added"] * 25
    return kept


def status(rows, case):
    return next(r for r in rows.collect() if r.case_number_raw == case)


def test_nothing_new(spark, base):
    kept, events, result = run(spark, base, MANY, "2026-09-21")
    assert events == [] and {r.last_verified for r in kept.collect()} == {dt.date(2026, 9, 21)}
    assert merge.check_invariants(base, result)["lost"] == 0


def test_amended_and_relocated(spark, base):
    changed = [row("NUPD 26-10000", reported="9/1/26 10:00", occurred="9/01/2026 9:00", disposition="Closed", file="g"), *MANY[1:]]
    kept, events, result = run(spark, base, changed, "2026-09-21")
    assert events == ["amended", "amended", "relocated"]
    assert status(kept, "NUPD 26-10000").revision == 2
    assert {e.field_name: e.cosmetic for e in result.events.collect() if e.change_type == "amended"} == {"date_occurred_raw": True, "disposition_raw": False}


def test_the_ladder_steps_once_a_day_and_comes_back(spark, base):
    a, events, _ = run(spark, base, MANY[1:], "2026-09-21")
    assert events == ["missing"]
    same, events, _ = run(spark, a, MANY[1:], "2026-09-21")
    assert events == [] and status(same, "NUPD 26-10000").missing_count == 1
    b, _, _ = run(spark, a, MANY[1:], "2026-09-22")
    c, events, _ = run(spark, b, MANY[1:], "2026-09-23")
    assert events == ["withdrawn"] and status(c, "NUPD 26-10000").status == "withdrawn"
    d, events, _ = run(spark, c, MANY, "2026-09-24")
    assert events == ["reappeared"] and status(d, "NUPD 26-10000").flags == "was_missing" and status(d, "NUPD 26-10000").missing_count == 0


def test_nothing_is_read_into_a_failed_fetch_or_a_quarantined_file(spark, base):
    kept, events, _ = run(spark, base, [], "2026-09-21", fetched=False)
    assert events == [] and status(kept, "NUPD 26-10000").status == "active"
    _, events, result = run(spark, base, [*MANY[10:], row("NUPD 26-99999", reported="9/30/26 1:00")], "2026-09-21")
    assert events == ["added"] and [r[0] for r in result.quarantined.collect()] == ["f"]


def test_an_extended_number_supersedes(spark, base):
    longer = row("NUPD 26-10000/ CSA 88071", reported="9/1/26 10:00", occurred="8/30/26 1:00")
    kept, events, _ = run(spark, base, [longer, *MANY[1:]], "2026-09-21")
    old, new = status(kept, "NUPD 26-10000"), status(kept, "NUPD 26-10000/ CSA 88071")
    assert events == ["added", "superseded_identity"] and (old.status, old.superseded_by, old.flags) == ("superseded", new.incident_uid, "superseded_identity")
    again, events, _ = run(spark, kept, [longer, *MANY], "2026-09-22")
    assert events == [] and status(again, "NUPD 26-10000").flags == "possible_duplicate_identity;superseded_identity"


def test_an_exchanged_number_needs_full_agreement(spark, base):
    _, events, _ = run(spark, base, [row("NUPD 26-77777", reported="9/1/26 10:00"), *MANY[1:]], "2026-09-21")
    assert events == ["added", "superseded_identity"]
    kept, events, _ = run(spark, base, [row("NUPD 26-77777", reported="9/1/26 10:00", occurred="8/1/26 1:00"), *MANY[1:]], "2026-09-21")
    assert events == ["added", "possible_renumbering"] and status(kept, "NUPD 26-10000").status == "active"
    two = [row("NUPD 26-10000, 26-20000", n=90), row("NUPD 26-10000, 26-30000", n=91)]
    kept, events, _ = run(spark, base, [*two, *MANY[1:]], "2026-09-21")
    assert events == ["added", "added", "missing"] and "possible_duplicate_identity" in status(kept, "NUPD 26-10000").flags


def test_removed_and_reused_files(spark, base):
    kept, events, _ = run(spark, base, [], "2026-09-21", fetched=False, removed=True)
    assert events == ["source_removed"] * 25
    october = [row("NUPD 26-50000", reported="10/1/26 10:00")]
    _, events, _ = run(spark, base, october, "2026-10-01", month="October 2026")
    assert events == ["added"]
    _, events, result = run(spark, base, october, "2026-10-02", month="October 2026", repurposed=True)
    assert events == ["added", *["source_removed"] * 25] and {e.removal_mechanism for e in result.events.collect() if e.change_type == "source_removed"} == {"file_repurposed"}
    with pytest.raises(merge.ArchiveIntegrityError, match="active"):
        merge.check_invariants(base, result)


def test_irregular_captures_only_flag(spark, base):
    kept, events, _ = run(spark, base, MANY[1:], "2026-09-21", confirm=False)
    assert events == ["absent_in_later_capture"] and status(kept, "NUPD 26-10000").flags == "absent_in_later_capture"


def test_a_changed_identity_is_refused(spark, base):
    _, _, result = run(spark, base, MANY, "2026-09-21")
    broken = merge.MergeResult(result.rows.withColumn("case_number_norm", F.lit("X")), result.events, result.quarantined, result.decisions)
    with pytest.raises(merge.ArchiveIntegrityError, match="case_number"):
        merge.check_invariants(base, broken)


def test_archive_on_disk(spark, tmp_path):
    root = str(tmp_path / "archive")
    assert apply_run(spark, root, observe(spark, *MANY), files(spark), "2026-09-20.0001")
    assert not apply_run(spark, root, observe(spark, *MANY), files(spark), "2026-09-20.0001")
    both = observe(spark, *MANY[1:]).withColumns({"snapshot_date": F.lit("2026-09-21").cast("date"), "snapshot_seq": F.lit(1)})
    assert replay(spark, root, both, lambda _: files(spark)) == ["2026-09-21.0001"]
    assert read_archive(spark, root).count() == 25 and read_changelog(spark, root).groupBy("change_type").count().filter("change_type = 'missing'").first()[1] == 1


def test_the_log_is_one_the_engine_reads(spark, tmp_path):
    root = str(tmp_path / "archive")
    changed = [row("NUPD 26-10000", reported="9/1/26 10:00", disposition="Closed", file="g"), *MANY[1:-1]]
    for day, rows in (("2026-09-20.0001", MANY), ("2026-09-21.0001", changed), ("2026-09-21.0002", MANY)):
        assert apply_run(spark, root, observe(spark, *rows), files(spark), day)
    log = read_changelog(spark, root)
    assert sorted(r.log_pos for r in log.collect()) == list(range(1, log.count() + 1))
    assert distinct_events(log, "log_pos").count() == log.count()
    uid = status(read_archive(spark, root), "NUPD 26-10000").incident_uid
    rows = {r.incident_uid: (r.status, r.revision, r.source_file_id) for r in current_state(log).collect()}
    assert rows == {r.incident_uid: (r.status, r.revision, r.source_file_id) for r in read_archive(spark, root).collect()} and rows[uid] == ("active", 3, "f")
    assert [tuple(r)[1:] for r in sorted(attribute_history(log).collect(), key=lambda r: r.valid_from)] == [("2026-09-20", "", "Open")] or attribute_history(log).count() == 0
    assert tuple(activity(log, "2026-09-19", "2026-09-21").first()) == (25, 1, 0, 0)


def test_a_lost_pointer_is_an_error_and_a_half_run_is_not_read(spark, tmp_path):
    root = str(tmp_path / "archive")
    apply_run(spark, root, observe(spark, *MANY), files(spark), "2026-09-20.0001")
    read_archive(spark, root).write.parquet(f"{root}/versions/2026-09-21.0001")
    assert read_pointer(spark, root) == "2026-09-20.0001"
    with pytest.raises(OSError):
        point(spark, root, 1, "other", 0)
    shutil.rmtree(f"{root}/pointers")
    with pytest.raises(FileNotFoundError):
        read_archive(spark, root)


def test_the_report_of_a_run(spark, base):
    _, _, result = run(spark, base, MANY[1:], "2026-09-21")
    report = merge.merge_report(result, files(spark)).first()
    assert (report.missing, report.unchanged, report.changed, report.unfetched) == (1, 24, False, []) and report.summary.startswith("+0 added, 0 amended, 1 missing")
    assert [tuple(w) for w in merge.merge_warnings(result, merge.REPORT_WARNINGS).collect()] == [("f", "1 row(s) absent")]


def test_captures_replay_in_time_order_across_months(spark, tmp_path):
    def page(*cases, names=tuple(pages.LEGACY_HEADER)):
        lines = [f"<td>{c}</td><td>1/{c[-1]}/21 10:00</td><td>1/2/21</td><td>Theft</td><td><strong>Main</strong> hall</td><td>{d}</td>" for c, d in cases]
        return "<table>" + "".join(f"<tr>{line}</tr>" for line in ["".join(f"<th>{n}</th>" for n in names), *lines]) + "</table>"

    captures = [
        ("January 2021", "20230501000000", page(("NUPD 21-10001", "Unfounded"), ("NUPD 21-10002", "Open"))),
        ("January 2021", "20210301000000", page(("NUPD 21-10001", "Open"), ("NUPD 21-10002", "Open"))),
        ("January 2021", "20210301000000", page(("NUPD 21-10001", "Open"), ("NUPD 21-10002", "Open"))),
        ("April 2021", "20220101000000", page(("NUPD 21-40001", "Open"))),
        ("April 2021", "20220102000000", None),
        ("April 2021", "20220103000000", page(names=[*pages.LEGACY_HEADER[:5], "Kind"])),
        ("April 2021", "20260101000000", "<p>gone</p>"),
        ("April 2021", "20260102000000", page()),
    ]
    table = spark.createDataFrame(captures, "month string, stamp string, html string")
    assert [(r.month, r.stamp[:4]) for r in legacy.order_captures(table.limit(4).distinct()).collect()] == [("January 2021", "2021"), ("April 2021", "2022"), ("January 2021", "2023")]
    root = str(tmp_path)
    for _ in range(2):
        assert replay_captures(spark, root, table) == {"used": 3, "dead": 1, "failed": 2, "empty": 1}
        kept = read_archive(spark, root)
        assert {r.case_number_raw: r.disposition_raw for r in kept.collect()} == {"NUPD 21-10001": "Unfounded", "NUPD 21-10002": "Open", "NUPD 21-40001": "Open"}
        log = [(str(e.observed_date), e.change_type) for e in read_changelog(spark, root).collect()]
        assert sorted(log) == [("2021-03-01", "added"), ("2021-03-01", "added"), ("2022-01-01", "added"), ("2023-05-01", "amended")]


def test_run_records_and_manifest_are_written(spark, tmp_path):
    for n in (3, 4):
        write_run_record(spark, str(tmp_path / "runs"), {"archive_rows": n, "files": {"f": {"name": "é", "rows": n}}, "alarms": []}, "2026-09-01")
        write_manifest(spark, str(tmp_path / "m" / "manifest.json"), {"archive_started": dt.date(2026, 9, 1), "files": {"f": {"name": "é", "snapshots": [{"date": "2026-09-01", "sha256": "x", "bytes": n}]}}})
    write_run_record(spark, str(tmp_path / "runs"), {"archive_rows": 4}, "2026-09-02")
    assert sorted((str(r.date), r.archive_rows) for r in read_runs(spark, str(tmp_path / "runs")).collect()) == [("2026-09-01", 4), ("2026-09-02", 4)]
    found, snapshots = read_manifest(spark, str(tmp_path / "m"))
    assert found.first().name == "é" and [s.bytes for s in snapshots.collect()] == [4]


def test_ladder_as_stream_agrees_with_the_batch_whatever_comes_late(spark, tmp_path):
    schema = "uid string, day date, present boolean"
    day = lambda n: dt.date(2026, 9, n)
    first = [("a", day(1), True), ("a", day(2), False), ("a", day(4), False), ("a", day(5), False), ("b", day(1), False), ("b", day(5), True), ("c", day(2), False), ("c", day(2), True)]
    late = [("a", day(3), True), ("b", day(2), False), ("b", day(3), False), ("b", day(3), False)]
    last = [("z", dt.date(2026, 10, 20), True)]
    source = str(tmp_path / "in")
    for rows in (first, late, last, last):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = stream_absences(spark.readStream.schema(schema).parquet(source), "10 days")
        query = stream.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    got = {(r.uid, r.day): (r.status, r.confirmations) for r in spark.read.parquet(str(tmp_path / "out")).filter("uid <> 'z'").collect()}
    assert got["a", day(3)] == ("active", 0) and got["a", day(5)] == ("missing", 2) and got["b", day(3)] == ("withdrawn", 3) and got["c", day(2)] == ("active", 0)
    runs = ladders.absence_runs(spark.createDataFrame(first + late, schema), "uid", "day", "present").collect()
    for r in runs:
        assert got[r.uid, r.until][1] == r.confirmations
    assert {k for k, v in got.items() if v[1]} >= {(r.uid, r.until) for r in runs} and len(got) == 10


def test_file_ladders(spark):
    f = spark.createDataFrame([("new", False, 0, None), ("old", False, 2, "2026-09-01"), ("today", False, 2, "2026-09-02"), ("ok", True, 2, None)], "source_file_id string, fetched boolean, absent_count int, d string").withColumn("last_absent_date", F.col("d").cast("date"))
    n = spark.createDataFrame([("old", 5), ("today", 5), ("ok", 5)], "source_file_id string, n int")
    got = {r.source_file_id: (r.state, r.absent_count, r.alarm) for r in ladders.step_file_ladder(f, n, "2026-09-02").collect()}
    assert got == {"new": ("pending", 0, False), "old": ("removed", 3, True), "today": ("unfetched", 2, False), "ok": ("active", 0, False)}
    m = spark.createDataFrame([("a", True, "October 2026", 1), ("b", True, "", 1), ("c", True, "October 2026", 1)], "source_file_id string, fetched boolean, month string, month_change_count int")
    stale = spark.createDataFrame([("a",), ("b",)], "source_file_id string")
    assert {r.source_file_id: (r.month_change_count, r.repurposed) for r in ladders.step_month_change(m, stale).collect()} == {"a": (2, True), "b": (1, False), "c": (0, False)}


def test_snapshot_index(spark):
    schema = "source_file_id string, date string, seq int, sha256 string, bytes long"
    index = spark.createDataFrame([("f", "2026-09-01", 1, "x", 1)], schema)
    landed = spark.createDataFrame([("f", "2026-09-02", 1, "x", 1), ("f", "2026-09-02", 2, "y", 1), ("g", "2026-09-02", 1, "x", 1)], schema)
    assert sorted((r.source_file_id, r.seq) for r in append_snapshots(index, landed).collect()) == [("f", 2), ("g", 1)]
    assert verify_snapshots(index, landed).first().what == "lost" and verify_snapshots(landed, landed).collect() == []


def test_legacy_reconciliation(spark):
    def old(uid, case, reported, nature="Theft"):
        return (uid, case, reported, nature, "hall", "January 2021", "active", "legacy-page")

    archive = spark.createDataFrame([old("g", "21-1234567", "5/2/21"), old("h", "21-123456", "5/2/21"), old("i", "gpd 25-034057", "3/2/21"), old("j", "GPD 25-034057/ CSA 88071", "3/02/21"), *[old(f"x{k}", f"NUPD 20-{k:05d}", "", "") for k in range(300)], old("a", "21-12345", "1/2/21"), old("b", "21-12345/ CSA 1", "1/2/21 10:00"), old("c", "21-99999", "1/2/21"), old("d", "21-99998", "1/2/21"), old("e", "21-99998 ", "1/02/2021", "theft")], "incident_uid string, case_number_raw string, date_reported_raw string, nature_raw string, location_raw string, source_month string, status string, source_era string")
    assert [tuple(r) for r in legacy.reconcile_extended(archive).collect() if r.incident_uid == "a"] == [("a", "b")]
    assert {r.incident_uid: r.with_n for r in legacy.duplicate_candidates(archive).collect()} == {"d": 1, "e": 1, "g": 1, "h": 1, "i": 1, "j": 1}
    more = archive.withColumns({"last_verified": F.lit("2026-09-01").cast("date"), "superseded_by": F.lit(None).cast("string"), "flags": F.lit("absent_in_later_capture;was_missing")})
    rows, events = legacy.apply_reconciliation(more)
    assert [(r.incident_uid, r.superseded_by, r.flags) for r in rows.filter("status = 'superseded'").collect()] == [("a", "b", "superseded_identity;was_missing")]
    assert [(e.incident_uid, e.event_source, e.new_value) for e in events.collect()] == [("a", "reconciliation", "21-12345/ CSA 1")]
    assert legacy.reconcile_extended(archive.withColumn("source_era", F.lit("sheet-2026"))).collect() == []
    assert legacy.flag_duplicate_candidates(more).filter("flags LIKE '%possible_duplicate%'").count() == 6
