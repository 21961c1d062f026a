"""Change feed, history and snapshot differences against step-by-step versions."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from daybook.operators.change_feed import STATUS_OF, append_feed, current_state, read_feed
from daybook.operators.history import attribute_history
from daybook.operators.snapshot_diff import snapshot_changes

LOG = "log_pos long, observed_date date, run_seq int, incident_uid string, change_type string, field_name string, old_value string, new_value string, revision int, source_file_id string, to_file_id string, uid string, seq long"
D = dt.date(2026, 8, 1)


def event(pos, day, run, uid, kind, field=None, old=None, new=None, revision=None, file=None, to=None):
    return (pos, None if day is None else D + dt.timedelta(day), run, uid, kind, field, old, new, revision, file, to, "clash", 1)


def settled(rows):
    newest = {}
    for r in sorted(rows, key=lambda r: r[0]):
        uid = (r[3] or "").strip().lower()
        if uid and r[1] is not None:
            newest[uid, r[1], -1 if r[2] is None else r[2]] = r
    return sorted(newest.items())


def state_by_steps(rows):
    state = {}
    for (uid, _, _), r in settled(rows):
        kind = r[4].strip().lower()
        if kind == "added":
            state[uid] = ["active", r[8], r[9]]
        elif uid in state:
            if kind == "source_removed":
                del state[uid]
            elif kind == "amended":
                state[uid][1] = r[8]
            elif kind == "relocated":
                state[uid][2] = r[10]
            elif kind in STATUS_OF:
                state[uid][0] = STATUS_OF[kind]
    return sorted((u, *s) for u, s in state.items())


def history_by_steps(rows):
    alive, versions, entered = set(), {}, {}
    for (uid, day, _), r in settled(rows):
        kind = r[4].strip().lower()
        if kind == "added":
            alive.add(uid)
            entered.setdefault(uid, day)
        elif kind == "source_removed":
            alive.discard(uid)
        elif kind == "amended" and r[5] == "disposition_raw" and uid in alive:
            versions.setdefault(uid, {"first": r[6], "days": {}})["days"][day] = r[7]
    out = []
    for uid, v in versions.items():
        spans = [(entered[uid], v["first"])]
        for day, value in sorted(v["days"].items()):
            if value != spans[-1][1]:
                spans.append((day, value))
        spans = [s for s, after in zip(spans, [*spans[1:], (None, None)], strict=True) if s[0] != after[0]]
        if len(spans) > 1:
            for (a, value), b in zip(spans, [*[s[0] for s in spans[1:]], None], strict=True):
                out.append((uid, str(a), str(b or ""), value))
    return sorted(out, key=str)


def random_log(seed, n=400):
    rng = random.Random(seed)
    kinds = ["added", "amended", "amended", "amended", "missing", "Withdrawn ", "reappeared", "source_removed", "relocated", "superseded_identity", "other", " ADDED"]
    rows = []
    for pos in range(n):
        uid = "hot" if rng.random() < 0.35 else rng.choice(["a", " B ", "b", "c", "C", "d"])
        rows.append(event(pos, rng.randint(0, 6), rng.choice([None, 1, 2, 3, 4, 5]), uid, rng.choice(kinds), rng.choice(["disposition_raw", "nature_raw"]), rng.choice("xyz"), rng.choice(["x", "y", None]), rng.randint(1, 9), "f", "t"))
    return rows + rows[:20]


@pytest.mark.parametrize("seed", range(3))
def test_state_and_history_by_steps(spark, seed):
    rows = random_log(seed)
    log = spark.createDataFrame(rows, LOG)
    assert sorted(map(tuple, current_state(log).collect())) == state_by_steps(rows)
    assert sorted(map(tuple, attribute_history(log).collect()), key=str) == history_by_steps(rows)


def test_insert_and_delete_files_read_as_the_feed(spark, tmp_path):
    rows = random_log(7)
    for batch in (rows[:150], rows[150:], rows[:30]):
        append_feed(str(tmp_path), spark.createDataFrame(batch, LOG))
    assert sorted(map(tuple, read_feed(spark, str(tmp_path)).collect())) == state_by_steps(rows)


def test_a_version_that_holds_for_no_day_is_none(spark):
    def amend(day, run, old, new, uid="a"):
        return event(day * 10 + run, day, run, uid, "amended", "disposition_raw", old, new, 2)

    rows = [event(0, 0, 1, "a", "added"), amend(0, 2, "open", "closed"), amend(3, 1, "closed", "open"), event(0, 0, 1, "b", "added"), amend(0, 2, "open", "closed", "b")]
    got = sorted(map(tuple, attribute_history(spark.createDataFrame(rows, LOG)).collect()))
    assert got == [("a", "2026-08-01", "2026-08-04", "closed"), ("a", "2026-08-04", "", "open")]


def test_no_log_and_nameless_events(spark):
    assert current_state(spark.createDataFrame([], LOG)).collect() == []
    assert attribute_history(spark.createDataFrame([], LOG)).collect() == []
    rows = [event(1, 0, 1, None, "added"), event(2, 0, 1, " ", "added"), event(3, None, 1, "a", "added"), event(4, 0, 1, "a", None)]
    assert current_state(spark.createDataFrame(rows, LOG)).collect() == []


SNAP = "snapshot_date date, snapshot_seq int, source_row_index int, incident_uid string, content_hash string, status string, uid string, day int, version string"


def snap(day, seq, at, uid, content, status="active"):
    return (D + dt.timedelta(day), seq, at, uid, content, status, "clash", 0, "")


def test_snapshots(spark):
    h = "ab" * 32
    rows = [
        snap(0, 1, 1, "A ", h), snap(0, 1, 2, "b", None), snap(0, 1, 3, "c", "x"), snap(0, 1, 4, "d", h), snap(0, 1, 5, None, h), snap(0, 1, 6, "hot", h),
        snap(1, 1, 1, "a", h.upper() + " "), snap(1, 1, 2, "b", "", "active"), snap(1, 1, 3, "c", "y"), snap(1, 1, 4, "c", "x"), snap(1, 1, 5, "d", h, "Missing"), snap(1, 1, 6, "e", h),
        *[snap(1, 1, 100 + k, "hot", h) for k in range(50)],
        snap(1, 2, 1, "e", h), snap(1, 2, 1, "hot", h),
    ]
    out = snapshot_changes(spark.createDataFrame(rows, SNAP))
    assert sorted((r.snapshot_date, r.snapshot_seq, r.incident_uid, r.change_kind) for r in out.collect()) == [
        ("2026-08-02", 1, "b", "changed"), ("2026-08-02", 1, "d", "changed"), ("2026-08-02", 1, "e", "added"),
        ("2026-08-02", 2, "a", "removed"), ("2026-08-02", 2, "b", "removed"), ("2026-08-02", 2, "c", "removed"), ("2026-08-02", 2, "d", "removed"),
    ]
    assert snapshot_changes(spark.createDataFrame([], SNAP)).collect() == []
    assert snapshot_changes(spark.createDataFrame(rows[:6], SNAP)).collect() == []
