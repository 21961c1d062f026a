"""Merging one run's observations into the archive, as one relational job.

The archive (one row a record) meets the run's observations in a full outer
join by uid; what happens to a row is one ordered CASE, and its events are an
array that is exploded at the end.  Nothing is written here, so that
:func:`check_invariants` can refuse the result first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.identity import FIELDS, amendment_of, canonical_reported, case_references, corroborates, is_cosmetic, is_renumbering, normalize_case_number, strictly_within
from daybook.session import cut_lineage

# Groups of statuses; they differ on purpose.
STILL_PUBLISHED = ("active", "missing")
MONTH_CHECKED = ("active", "missing", "withdrawn")
MATCHABLE = ("active", "missing", "withdrawn")
SETTLED = ("withdrawn", "superseded", "source_removed")
# Limits of the absence ladder, the shrink guard and the corpus brake.
CONFIRMATIONS = 3
MOST_SILENT_DROPS = 2
LEAST_RETENTION = 0.90
MOST_CORPUS_DROP_ROWS = 10
MOST_CORPUS_DROP_SHARE = 0.05

ARCHIVE_SCHEMA = """incident_uid string, case_number_raw string, case_number_norm string, date_reported_raw string, date_occurred_raw string, nature_raw string,
narrative_raw string, campus_raw string, location_raw string, disposition_raw string, source_file_id string, source_file_name string, source_month string,
source_era string, student_flag string, source_row_index int, content_hash string, first_seen_by_archive date, last_verified date, missing_since date,
missing_count int, last_absent date, status string, superseded_by string, revision int, flags string"""
ARCHIVE_COLUMNS = [c.split()[0] for c in ARCHIVE_SCHEMA.replace("\n", " ").split(",")]

EVENT_SCHEMA = """observed_date date, run_seq int, incident_uid string, change_type string, field_name string, old_value string, new_value string, cosmetic boolean, revision int, case_number string,
date_reported string, nature string, source_file_id string, from_file_id string, to_file_id string, missing_since date, was_missing_since date, confirmations int,
previous_status string, last_known_disposition string, superseded_by string, possible_replacement string, source_month string, removal_mechanism string, event_source string,
capture_timestamp string"""
#: The log as it is read: events in the order they were written.
LOG_SCHEMA = "log_pos bigint, " + EVENT_SCHEMA
EVENT_COLUMNS = [tuple(c.split()) for c in EVENT_SCHEMA.replace("\n", " ").split(",")]


class ArchiveIntegrityError(RuntimeError):
    """An invariant that must never fail, failed; nothing may be written."""


@dataclass
class MergeResult:
    """rows (the new archive), events, the guard of each file that was read, and what was decided for each record."""

    rows: DataFrame
    events: DataFrame
    guard: DataFrame
    decisions: DataFrame

    @property
    def quarantined(self) -> DataFrame:
        return self.guard.filter("quarantined").select("source_file_id")


def last_observed(observed: DataFrame, order: tuple[str, ...] = ("file_order", "source_row_index")) -> DataFrame:
    """One observation a uid: the last in file order, then row order."""
    newest = Window.partitionBy("incident_uid").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return observed.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def match_renumbered(existing: DataFrame, observed: DataFrame, fetched: DataFrame) -> DataFrame:
    """Records republished under an edited case number: uid, outcome (fork, near_miss, ambiguous), match.

    ``existing`` and ``observed`` have one row a uid; ``fetched`` has the ids of
    files that were read.  A row that went absent is compared with the rows of
    the same file and reported time that agree in campus, location and nature.
    An extended case number links at once, an exchanged one only as the sole
    exchange in its file and time; of anything more than one it is only known
    that there are several.

    So rows need not be paired to be counted: all rows of a bucket count as
    possible matches of each absent one, less those that share a reference
    number with it in a way that rules them out.  Rows are paired only where
    they share a reference number, where a file and time has one absent row,
    and to name a match that is known to be the only one.
    """
    columns = ["incident_uid", "source_file_id", "case_number_raw", "date_reported_raw", "date_occurred_raw", "nature_raw", "campus_raw", "location_raw"]
    old = existing.filter(F.col("status").isin(*MATCHABLE)).join(fetched.select("source_file_id").distinct(), "source_file_id", "left_semi")
    gone = old.join(observed.select("incident_uid"), "incident_uid", "left_anti").select(*columns, (F.col("status") == "active").cast("int").alias("in_pool"))
    fresh = observed.join(existing.select("incident_uid"), "incident_uid", "left_anti")
    carried = existing.filter("status = 'active'").join(observed.select("incident_uid"), "incident_uid", "left_anti")
    pool = observed.select(*columns).unionByName(carried.select(*columns))

    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    place = [text("source_file_id").alias("k_file"), text("date_reported_raw").alias("k_time")]
    # Few rows go absent in a run, and only rows of their buckets are looked at further; both are used several times.
    gone = cut_lineage(gone.select("*", *place))
    lone = gone.groupBy("k_file", "k_time").count().filter("count = 1").select("k_file", "k_time")
    single = fresh.select(*place).join(lone, ["k_file", "k_time"], "left_semi").groupBy("k_file", "k_time").count().filter("count = 1").select("k_file", "k_time")

    keys = ["k_file", "k_time", "k_campus", "k_location", "k_nature"]

    def keyed(rows: DataFrame, amended: Column) -> DataFrame:
        """A row for the nature as it is and one for the nature it may amend or be amended from; two rows agree under at most one of them."""
        natures = F.array_compact(F.array(F.concat(F.lit("="), text("nature_raw")), F.concat(F.lit("~"), amended)))
        rows = rows.select(*columns, *[c for c in rows.columns if c == "in_pool"], *place, text("campus_raw").alias("k_campus"), text("location_raw").alias("k_location"), F.explode(natures).alias("k_nature"), case_references(F.col("case_number_raw")).alias("refs"))
        return rows.filter("size(refs) > 0")

    a = keyed(gone, F.trim(text("nature_raw")))
    b = cut_lineage(keyed(pool, amendment_of(F.col("nature_raw"))).join(a.select(*keys).distinct(), keys, "left_semi"))
    per_key = b.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = a.join(per_key, keys).groupBy("incident_uid").agg(F.sum("n").alias("n"), F.max("in_pool").alias("itself"))

    match = F.struct(F.col("b.incident_uid").alias("uid"), F.col("b.case_number_raw").alias("case_number"), F.col("b.date_reported_raw").alias("reported"))
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.col("a.incident_uid") != F.col("b.incident_uid")]
    x, y = F.col("a.refs"), F.col("b.refs")
    by_ref = lambda rows: rows.withColumn("ref", F.explode("refs"))
    # Each pair once, at the smallest reference it shares.
    sharing = by_ref(a).alias("a").join(by_ref(b).alias("b"), [F.col("a.ref") == F.col("b.ref"), *on]).filter(F.col("a.ref") == F.array_min(F.array_intersect(x, y)))
    related = sharing.groupBy(F.col("a.incident_uid").alias("incident_uid")).agg(
        F.count_if(strictly_within(x, y)).alias("extended"), F.count_if(strictly_within(y, x)).alias("shortened"), F.min(F.when(strictly_within(x, y), match)).alias("linked")
    )
    several = totals.join(related, "incident_uid", "left").join(gone.join(single, ["k_file", "k_time"], "left_semi").select("incident_uid"), "incident_uid", "left_anti")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    several = several.select(F.col("incident_uid").alias("uid"), n("extended").alias("n_links"), (F.col("n") - F.col("itself") - n("extended") - n("shortened")).alias("n_others"), "linked")
    sole = several.filter("n_links = 0 AND n_others = 1").select(F.col("uid").alias("incident_uid"))
    named = a.join(sole, "incident_uid", "left_semi").alias("a").join(b.alias("b"), on).filter(~strictly_within(y, x)).groupBy(F.col("a.incident_uid").alias("uid")).agg(F.min(match).alias("other"))
    several = several.join(named, "uid", "left")

    alone = a.join(single, ["k_file", "k_time"]).alias("a").join(b.alias("b"), on).filter(is_renumbering(x, y))
    links = strictly_within(x, y) | corroborates("a", "b", ignore_occurred=False)
    alone = alone.select(F.col("a.incident_uid").alias("uid"), links.alias("links"), match.alias("match")).groupBy("uid")
    alone = alone.agg(F.count_if("links").alias("n_links"), F.count_if(~F.col("links")).alias("n_others"), F.min(F.when(F.col("links"), F.col("match"))).alias("linked"), F.min(F.when(~F.col("links"), F.col("match"))).alias("other"))

    tiers = several.unionByName(alone).filter("n_links + n_others > 0")
    outcome = F.when(F.col("n_links") == 1, "fork").when(F.col("n_links") > 1, "ambiguous").when(F.col("n_others") == 1, "near_miss").otherwise("ambiguous")
    return tiers.select("uid", outcome.alias("outcome"), F.when(F.col("n_links") == 1, F.col("linked")).when((F.col("n_links") == 0) & (F.col("n_others") == 1), F.col("other")).alias("match"))


def stale_cohort(row: str, month: Column, fetched: Column) -> Column:
    """Whether a row belongs to a month its file no longer holds."""
    own = F.coalesce(F.col(f"{row}source_month"), F.lit(""))
    return F.coalesce(fetched, F.lit(False)) & (F.coalesce(month, F.lit("")) != "") & (own != "") & F.col(f"{row}status").isin(*MONTH_CHECKED) & (own != month)


def shrink_guard(existing: DataFrame, observed: DataFrame, files: DataFrame, explained: DataFrame) -> DataFrame:
    """Files read, with what their rows lost: source_file_id, accountable, kept, dropped, retention, quarantined, warned.

    ``explained`` has the uids whose absence is accounted for.  Files without
    accountable rows are left out.
    """
    prior = existing.filter(F.col("status").isin(*STILL_PUBLISHED)).select("source_file_id", "incident_uid")
    prior = prior.join(files.filter("fetched").select("source_file_id"), "source_file_id", "left_semi").join(explained.select("incident_uid").distinct(), "incident_uid", "left_anti")
    seen = observed.select("source_file_id", "incident_uid").distinct().withColumn("seen", F.lit(1))
    rows = observed.groupBy("source_file_id").agg(F.count("*").alias("rows"))
    by_file = prior.join(seen, ["source_file_id", "incident_uid"], "left").groupBy("source_file_id").agg(F.count("*").alias("accountable"), F.count("seen").alias("kept"))
    by_file = by_file.join(rows, "source_file_id", "left").withColumn("dropped", F.col("accountable") - F.col("kept")).withColumn("retention", F.col("kept") / F.col("accountable"))
    bad = F.col("rows").isNull() | (F.col("dropped") > MOST_SILENT_DROPS) | (F.col("retention") < LEAST_RETENTION)
    return by_file.select("source_file_id", "accountable", "kept", "dropped", "retention", bad.alias("quarantined"), (~bad & (F.col("dropped") > 0)).alias("warned"))


def _with_flag(flags: Column, *more: Column | str) -> Column:
    """A ``;`` list with further flags, sorted and without repeats."""
    lists = [F.split(F.coalesce(flags, F.lit("")), ";"), *[F.array(F.lit(m)) if isinstance(m, str) else F.split(F.coalesce(m, F.lit("")), ";") for m in more]]
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.concat(*lists), lambda f: f != ""))), ";")


#: Numbers of a day's events that each run has to itself; a record has fewer events in one run.
EVENTS_OF_RUN = 100


def merge(existing: DataFrame, observed: DataFrame, files: DataFrame, today: str, confirm_withdrawals: bool = True, run: int = 1) -> MergeResult:
    """Merges the observations of one run into the archive.

    ``existing`` has the columns of ARCHIVE_SCHEMA; ``observed`` the eight
    verbatim fields, incident_uid, content_hash, source_file_id,
    source_row_index, file_order, flags, student_flag, source_era and
    source_month; ``files`` has source_file_id, fetched, name, month, removed
    and repurposed, one row a file.  Without ``confirm_withdrawals`` absences
    are flagged, not counted (irregular captures).  ``run`` is the number of the
    run on its day; by it and their order a record's events of a day are
    numbered.  Extra columns are ignored; an empty archive takes everything as
    added.
    """
    day = F.lit(today).cast("date")
    existing = existing.select(*ARCHIVE_COLUMNS)
    once = last_observed(observed)
    files = files.select("source_file_id", F.coalesce("fetched", F.lit(False)).alias("fetched"), "name", "month", F.coalesce("removed", F.lit(False)).alias("removed"), F.coalesce("repurposed", F.lit(False)).alias("repurposed"))
    # Matches are few and used in three places; the joined rows make up all results.  Both are worked out once.
    matches = cut_lineage(match_renumbered(existing, once, files.filter("fetched")))

    e = existing.select(*[F.col(c).alias(f"e_{c}") for c in ARCHIVE_COLUMNS])
    o_columns = [*FIELDS, "incident_uid", "content_hash", "source_file_id", "source_row_index", "flags", "student_flag", "source_era", "source_month"]
    o = once.select(*[F.col(c).alias(f"o_{c}") for c in o_columns])
    stale = existing.join(files, "source_file_id").filter(stale_cohort("", F.col("month"), F.col("fetched"))).select("incident_uid")
    explained = matches.filter("outcome <> 'ambiguous'").select(F.col("uid").alias("incident_uid")).unionAll(stale)
    guard = shrink_guard(existing, observed, files, explained)
    state = files.join(guard.select("source_file_id", "quarantined"), "source_file_id", "left")
    state = state.select(*[F.col(c).alias(f"f_{c}") for c in ("source_file_id", "month", "fetched", "removed", "repurposed")], (F.col("fetched") & ~F.coalesce("quarantined", F.lit(False))).alias("f_trusted"))

    j = e.join(o, F.col("e_incident_uid") == F.col("o_incident_uid"), "full_outer")
    j = j.join(state, F.col("e_source_file_id") == F.col("f_source_file_id"), "left")
    j = j.join(files.select(F.col("source_file_id").alias("of_id"), F.col("name").alias("of_name"), F.col("month").alias("of_month")), F.col("o_source_file_id") == F.col("of_id"), "left")
    j = j.join(matches.select(F.col("uid").alias("m_uid"), "outcome", "match"), F.col("e_incident_uid") == F.col("m_uid"), "left")

    trusted = F.coalesce(F.col("f_trusted"), F.lit(False))
    outcome = F.when(trusted, F.col("outcome"))
    known, seen, status = F.col("e_incident_uid").isNotNull(), F.col("o_incident_uid").isNotNull(), F.col("e_status")
    is_stale = stale_cohort("e_", F.col("f_month"), F.col("f_fetched"))
    stepped = F.coalesce((F.col("e_missing_since") == day) | (F.col("e_last_absent") == day), F.lit(False))
    climbs = trusted & ~status.isin(*SETTLED) & ~stepped
    removed = F.coalesce(F.col("f_removed"), F.lit(False))
    absent = F.when(climbs, "absent").otherwise("kept") if confirm_withdrawals else F.when(trusted & (status == "active"), "flagged").otherwise("kept")
    decision = (
        F.when(~known, "added").when(seen & (status == "superseded"), "contradicted").when(seen, "seen")
        .when(outcome == "fork", "superseded")
        .when(removed, F.when(status == "source_removed", "kept").otherwise("removed"))
        .when(is_stale & F.coalesce(F.col("f_repurposed"), F.lit(False)), "retired").when(is_stale, "held")
        .when(outcome == "near_miss", "held").otherwise(absent)
    )
    review = outcome.isin("near_miss", "ambiguous")
    flagged = F.coalesce(F.col("e_flags"), F.lit("")).contains("possible_duplicate_identity")
    j = j.withColumns({"decision": decision, "review": F.coalesce(review, F.lit(False)), "first_review": F.coalesce(review & (outcome == "near_miss") & ~flagged, F.lit(False)), "changed": F.coalesce(~F.col("o_content_hash").eqNullSafe(F.col("e_content_hash")), F.lit(False))})

    d = F.col("decision")
    steps = F.coalesce(F.col("e_missing_count"), F.lit(0)) + 1
    fresh = d.isin("added", "seen")
    text = lambda c: F.coalesce(c, F.lit(""))
    base_flags = F.when(F.col("review") | (d == "contradicted"), _with_flag(F.col("e_flags"), "possible_duplicate_identity")).otherwise(text(F.col("e_flags")))
    rows = {
        **{c: F.when(fresh, F.col(f"o_{c}")).otherwise(F.col(f"e_{c}")) for c in [*FIELDS, "content_hash", "source_file_id", "source_row_index"]},
        "incident_uid": F.coalesce("e_incident_uid", "o_incident_uid"),
        "case_number_norm": F.when(fresh, normalize_case_number(F.col("o_case_number_raw"))).otherwise(F.col("e_case_number_norm")),
        "source_file_name": F.when(fresh, F.coalesce("of_name", "e_source_file_name")).otherwise(F.col("e_source_file_name")),
        "source_month": F.when(fresh, F.coalesce(F.nullif("of_month", F.lit("")), F.nullif("o_source_month", F.lit("")), F.col("e_source_month"))).otherwise(F.col("e_source_month")),
        "source_era": F.when(fresh, F.coalesce("o_source_era", "e_source_era")).otherwise(F.col("e_source_era")),
        "student_flag": F.when(fresh, F.coalesce(F.nullif("o_student_flag", F.lit("")), F.col("e_student_flag"))).otherwise(F.col("e_student_flag")),
        "first_seen_by_archive": F.coalesce(F.col("e_first_seen_by_archive"), F.when(~known, day)),
        "last_verified": F.when(fresh, day).otherwise(F.col("e_last_verified")),
        "missing_since": F.when(d == "seen", None).when(d.isin("absent", "removed", "retired"), F.coalesce(F.col("e_missing_since"), day)).otherwise(F.col("e_missing_since")),
        "missing_count": F.when(fresh, 0).when(d == "absent", steps).otherwise(F.col("e_missing_count")),
        "last_absent": F.when(d == "absent", day).otherwise(F.col("e_last_absent")),
        "status": F.when(fresh, "active").when(d == "superseded", "superseded").when(d.isin("removed", "retired"), "source_removed").when(d == "absent", F.when(steps >= CONFIRMATIONS, "withdrawn").otherwise("missing")).otherwise(status),
        "superseded_by": F.when(d == "superseded", F.col("match.uid")).otherwise(F.col("e_superseded_by")),
        "revision": F.when(~known, 1).when((d == "seen") & F.col("changed"), F.coalesce(F.col("e_revision"), F.lit(0)) + 1).otherwise(F.col("e_revision")),
        "flags": F.when(~known, _with_flag(F.col("o_flags")))
        .when((d == "seen") & status.isin("missing", "withdrawn"), _with_flag(F.col("e_flags"), "was_missing", F.col("o_flags")))
        .when(d == "seen", _with_flag(F.col("e_flags"), F.col("o_flags")))
        .when(d == "superseded", _with_flag(F.col("e_flags"), "superseded_identity"))
        .when(d == "flagged", _with_flag(base_flags, "absent_in_later_capture"))
        .otherwise(base_flags),
    }
    out = j.select(*[rows[c].alias(c) for c in ARCHIVE_COLUMNS], d.alias("decision"), _events(day).alias("events"), F.col("outcome").alias("match_outcome"), "changed")
    out = cut_lineage(out)
    decisions = out.select("incident_uid", "decision", "match_outcome", "changed")
    events = out.select(F.posexplode("events").alias("nth", "e"))
    number = F.lit((run - 1) * EVENTS_OF_RUN) + F.col("nth") + 1
    events = events.select(*[number.cast("int").alias(n) if n == "run_seq" else F.col(f"e.{n}").alias(n) for n, _ in EVENT_COLUMNS])
    return MergeResult(out.select(*ARCHIVE_COLUMNS), events, guard, decisions)


def _events(day: Column) -> Column:
    """The events of one joined row."""
    d, status = F.col("decision"), F.col("e_status")
    lacking = {name: F.lit(None).cast(kind).alias(name) for name, kind in EVENT_COLUMNS}

    def event(kind: str | Column, **values: Column) -> Column:
        given = {"observed_date": day, "incident_uid": F.coalesce("e_incident_uid", "o_incident_uid"), "change_type": F.lit(kind) if isinstance(kind, str) else kind} | values
        return F.struct(*[given[name].cast(kind_).alias(name) if name in given else lacking[name] for name, kind_ in EVENT_COLUMNS])

    old = {"case_number": F.col("e_case_number_raw")}
    full = old | {"date_reported": F.col("e_date_reported_raw"), "nature": F.col("e_nature_raw"), "last_known_disposition": F.col("e_disposition_raw")}
    steps = F.coalesce(F.col("e_missing_count"), F.lit(0)) + 1
    since = F.coalesce(F.col("e_missing_since"), day)
    single = [
        (F.col("first_review"), event("possible_renumbering", possible_replacement=F.col("match.case_number"), source_month=F.col("e_source_month"), **old)),
        (d == "added", event("added", revision=F.lit(1), source_file_id=F.col("o_source_file_id"), case_number=F.col("o_case_number_raw"), date_reported=F.col("o_date_reported_raw"), nature=F.col("o_nature_raw"))),
        ((d == "seen") & status.isin("missing", "withdrawn"), event("reappeared", was_missing_since=F.col("e_missing_since"), previous_status=status)),
        ((d == "seen") & ~F.col("o_source_file_id").eqNullSafe(F.col("e_source_file_id")), event("relocated", from_file_id=F.col("e_source_file_id"), to_file_id=F.col("o_source_file_id"))),
        (d == "superseded", event("superseded_identity", superseded_by=F.col("match.uid"), old_value=F.col("e_case_number_raw"), new_value=F.col("match.case_number"), **old)),
        (d.isin("removed", "retired"), event("source_removed", source_file_id=F.col("e_source_file_id"), source_month=F.col("e_source_month"), previous_status=status, removal_mechanism=F.when(d == "retired", "file_repurposed"), **full)),
        ((d == "absent") & (steps < CONFIRMATIONS), event("missing", missing_since=since, confirmations=steps, **old)),
        ((d == "absent") & (steps >= CONFIRMATIONS), event("withdrawn", missing_since=since, confirmations=steps, **full)),
        (d == "flagged", event("absent_in_later_capture", source_month=F.col("e_source_month"), **old)),
    ]
    plain = F.filter(F.array(*[F.when(F.coalesce(when, F.lit(False)), e) for when, e in single]), lambda x: x.isNotNull())
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    fields = F.array(*[F.struct(F.lit(f).alias("f"), text(f"e_{f}").alias("o"), text(f"o_{f}").alias("n")) for f in FIELDS])
    differing = F.filter(F.when((d == "seen") & F.col("changed"), fields).otherwise(F.slice(fields, 1, 0)), lambda x: x["o"] != x["n"])
    amended = F.transform(differing, lambda x: event("amended", revision=F.coalesce(F.col("e_revision"), F.lit(0)) + 1, field_name=x["f"], old_value=x["o"], new_value=x["n"], cosmetic=is_cosmetic(x["f"], x["o"], x["n"]), case_number=F.col("o_case_number_raw")))
    return F.concat(plain, amended)


def broken_invariants(before: DataFrame, result: MergeResult) -> dict[str, int]:
    """Counts of what must not happen: lost, first_seen, case_number, reported, and active rows before and after."""
    old = before.select(*[F.col(c).alias(f"b_{c}") for c in ("incident_uid", "first_seen_by_archive", "case_number_norm", "date_reported_raw", "status")])
    new = result.rows.join(result.decisions.select(F.col("incident_uid").alias("d_uid"), "decision"), F.col("incident_uid") == F.col("d_uid"))
    j = old.join(new, F.col("b_incident_uid") == F.col("incident_uid"), "full_outer")
    was, now = F.col("b_incident_uid").isNotNull(), F.col("incident_uid").isNotNull()
    exempt = (F.coalesce(F.col("status"), F.lit("")) == "source_removed") & (F.col("decision") != "retired")
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    row = j.agg(
        F.count_if(was & ~now).alias("lost"),
        F.count_if(was & now & ~F.col("b_first_seen_by_archive").eqNullSafe(F.col("first_seen_by_archive"))).alias("first_seen"),
        F.count_if(was & now & has("b_case_number_norm") & ~F.col("b_case_number_norm").eqNullSafe(F.col("case_number_norm"))).alias("case_number"),
        F.count_if(was & now & has("b_date_reported_raw") & (canonical_reported(F.col("b_date_reported_raw")) != canonical_reported(F.col("date_reported_raw")))).alias("reported"),
        F.count_if(was & (F.col("b_status") == "active") & ~exempt).alias("active_before"),
        F.count_if(now & (F.col("status") == "active") & ~exempt).alias("active_after"),
    ).first()
    return row.asDict()


def check_invariants(before: DataFrame, result: MergeResult) -> dict[str, int]:
    """Raises :class:`ArchiveIntegrityError` where the merge may not be written."""
    found = broken_invariants(before, result)
    for what in ("lost", "first_seen", "case_number", "reported"):
        if found[what]:
            raise ArchiveIntegrityError(f"{found[what]} record(s) break the invariant {what}")
    drop = found["active_before"] - found["active_after"]
    if found["active_before"] and drop > MOST_CORPUS_DROP_ROWS and drop / found["active_before"] > MOST_CORPUS_DROP_SHARE:
        raise ArchiveIntegrityError(f"active records would fall from {found['active_before']} to {found['active_after']} in one run")
    return found


def merge_summary(result: MergeResult) -> DataFrame:
    """change_type and n of a merge; amended counts records, not fields."""
    return result.events.groupBy("change_type").agg(F.count_distinct("incident_uid").alias("n"))


#: Most warnings of a report; there are as many as files and contradicted records, all of them in the tables they come from.
REPORT_WARNINGS = 15


def merge_report(result: MergeResult, files: DataFrame) -> DataFrame:
    """The report of a run, one row: counts of records by what happened to them, unchanged, quarantined, unfetched, changed, summary.

    ``unchanged`` counts records that were seen and read as before.  A run
    counts as changed by anything but absences.  Files are few by nature.
    """
    named = {"added": "added", "amended": "amended", "missing": "missing", "withdrawn": "withdrawn", "source_removed": "source_removed", "reappeared": "reappeared", "relocated": "relocated", "superseded": "superseded_identity"}
    pairs = result.events.select("incident_uid", "change_type").distinct()
    counts = pairs.agg(*[F.count_if(F.col("change_type") == k).cast("int").alias(n) for n, k in named.items()])
    same = result.decisions.agg(F.count_if((F.col("decision") == "seen") & ~F.col("changed")).cast("int").alias("unchanged"))
    listed = lambda df, of: df.agg(F.array_sort(F.collect_set("source_file_id")).alias(of))
    one = counts.join(F.broadcast(same)).join(F.broadcast(listed(result.quarantined, "quarantined"))).join(F.broadcast(listed(files.filter(~F.coalesce("fetched", F.lit(False))), "unfetched")))  # one row each
    changed = sum((F.col(n) for n in named if n != "missing"), F.lit(0)) > 0
    summary = F.format_string("+%d added, %d amended, %d missing, %d withdrawn, %d source-removed, %d reappeared, %d superseded", *[F.col(n) for n in named if n != "relocated"])
    return one.withColumns({"changed": changed, "summary": summary})


def merge_warnings(result: MergeResult, most: int | None = None) -> DataFrame:
    """What an editor should look at after a run: subject (a file or a record) and warning; the first ``most`` by subject where given."""
    g = result.guard
    files = g.filter("quarantined OR warned").select(
        F.col("source_file_id").alias("subject"),
        F.when(F.col("kept") == 0, "read, but none of its rows was seen: quarantined")
        .when(F.col("quarantined"), F.format_string("%d of %d rows absent: quarantined", F.col("dropped"), F.col("accountable")))
        .otherwise(F.format_string("%d row(s) absent", F.col("dropped")))
        .alias("warning"),
    )
    records = result.decisions.filter("decision = 'contradicted'").select(F.col("incident_uid").alias("subject"), F.lit("published again beside its replacement").alias("warning"))
    out = files.unionByName(records)
    return out.orderBy("subject", "warning").limit(most) if most else out


def empty_archive(spark) -> DataFrame:
    return spark.createDataFrame([], ARCHIVE_SCHEMA)
