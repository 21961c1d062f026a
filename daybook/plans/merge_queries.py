"""Queries of the merge over a run that takes every branch, with the SQL they are checked against.

The run is made from the whole archive: records are regrouped into sixteen
files, and what a file publishes of each record follows from its status, its
place in the file and the last digit of its uid.  Files differ too: of the
sixteen one is gone, one is reused for another month, one holds another month
without being reused, one couldn't be read and one lost half of its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import identity
from daybook.operators import merge
from daybook.plans import archive_sql as q
from daybook.plans.archive_queries import TODAY, archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Files by the digit of their group: (fetched, month, removed, repurposed); all others are read and name no month.
KINDS = {"a": (False, "", True, False), "b": (True, "November 2026", False, True), "c": (True, "November 2026", False, False), "d": (False, "", False, False)}
FILES = [(f"sheet-{x}", KINDS.get(x, (True, "", False, False))[0], f"Sheet {x}", *KINDS.get(x, (True, "", False, False))[1:]) for x in "0123456789abcdef"] + [("sheet-moved", True, "Moved", "", False, False)]


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def of(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return of


def files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FILES, "source_file_id string, fetched boolean, name string, month string, removed boolean, repurposed boolean")


def existing(spark: SparkSession, d: str) -> DataFrame:
    group = F.concat(F.lit("sheet-"), F.right(F.md5(F.coalesce("source_file_id", F.lit("")).cast("binary")), F.lit(1)))
    e = archive(spark, d).withColumn("source_file_id", group)
    return e.withColumn("missing_count", F.when(F.endswith("source_file_id", F.lit("5")), 2).otherwise(F.col("missing_count")))


# What is published of a record, by its role: numbers of the variants below.
ROLES = {"same": [0], "appended": [1], "exchanged": [2], "moved": [3], "amended": [4], "twice": [0, 5], "doubled": [1, 6], "joined": [0, 7], "relocated": [8], "absent": [], "unread": []}


def published(spark: SparkSession, d: str) -> DataFrame:
    """The observations of the run."""
    e = existing(spark, d)
    uid, group = F.col("incident_uid"), F.right(F.col("source_file_id"), F.lit(1))
    h = F.lower(F.right(F.trim(uid), F.lit(1)))
    has_refs = F.size(identity.case_references(F.col("case_number_raw"))) > 0
    eligible = F.col("status").isin("active", "missing") & has_refs
    # The first two records of a file are told by two aggregations of a row a file.
    firsts = e.filter(eligible).groupBy(F.col("source_file_id").alias("of_file")).agg(F.min("incident_uid").alias("first"))
    seconds = e.filter(eligible).join(F.broadcast(firsts), F.col("source_file_id") == F.col("of_file")).filter("incident_uid > first").groupBy("of_file").agg(F.min("incident_uid").alias("second"))  # sixteen files
    e = e.join(F.broadcast(firsts.join(seconds, "of_file", "left")), F.col("source_file_id") == F.col("of_file"), "left")
    accountable = F.col("status").isin("active", "missing")
    role = (
        F.when(group.isin("a", "d"), "unread").when(group.isin("b", "c") & (h >= "4"), "absent")
        .when(accountable & (uid == F.col("first")), F.when(group.isin("7", "8"), "relocated").otherwise("absent")).when(accountable & (uid == F.col("second")), "doubled")
        .when(accountable & (group == "e") & (h >= "8"), "absent")
        .when(accountable & has_refs & (h == "0"), "appended").when(accountable & has_refs & (h == "1"), "exchanged").when(accountable & has_refs & (h == "3"), "moved")
        .when(accountable & (h == "5"), "amended").when(accountable & (h == "a"), "twice").when(accountable & (h == "9"), "joined").when(accountable, "same")
        .when(F.col("status") == "superseded", F.when(h < "8", "same").otherwise("absent"))
        .when(h < "4", "same").otherwise("absent")
    )
    variants = F.try_element_at(F.create_map(*[x for r, vs in ROLES.items() for x in (F.lit(r), F.array(*map(F.lit, vs)).cast("array<int>"))]), role)
    o = e.withColumns({"h": h, "v": F.explode(variants)})
    v, number, text = F.col("v"), F.lpad((F.col("row_id") % 10_000_000).cast("string"), 7, "0"), lambda c: F.coalesce(F.col(c), F.lit(""))
    o = o.withColumns(
        {
            "case_number_raw": F.when(v == 1, F.concat(text("case_number_raw"), F.lit("/ CSA 90001"))).when(v == 6, F.concat(text("case_number_raw"), F.lit("/ CSA 90002"))).when(v.isin(2, 3), F.concat(F.lit("NUPD 31-"), number)).when(v == 7, F.concat(F.lit("NUPD 77-"), number)).otherwise(F.col("case_number_raw")),
            "date_reported_raw": F.when(v == 7, "7/4/26 12:34").otherwise(F.col("date_reported_raw")),
            "date_occurred_raw": F.when(v == 3, "1/1/20 0:00").otherwise(F.col("date_occurred_raw")),
            "disposition_raw": F.when(v == 4, F.concat(text("disposition_raw"), F.lit("; entry corrected"))).when(v == 5, "second reading").otherwise(F.col("disposition_raw")),
            "source_file_id": F.when(v == 8, "sheet-moved").otherwise(F.col("source_file_id")),
            "source_row_index": F.when(v == 5, F.col("source_row_index") + 100_000).otherwise(F.col("source_row_index")),
            "file_order": F.lit(1),
            "student_flag": F.when(F.col("h").isin("2", "6", "a"), "Yes").otherwise(""),
            "flags": F.when(F.col("h") == "b", "near_duplicate").otherwise(""),
            "source_era": F.lit("sheet-2026"),
            "source_month": F.when(F.col("h") == "c", "").otherwise("October 2026"),
        }
    )
    o = o.withColumns({"incident_uid": F.when(v.isin(0, 4, 5, 8), uid).otherwise(identity.incident_uid(F.col("case_number_raw"), F.col("date_reported_raw"))), "content_hash": identity.content_hash(*[F.col(f) for f in identity.FIELDS])})
    return o.select(*identity.FIELDS, "incident_uid", "content_hash", "source_file_id", "source_row_index", "file_order", "flags", "student_flag", "source_era", "source_month")


def merged(spark: SparkSession, d: str, confirm: bool = True) -> merge.MergeResult:
    return merge.merge(existing(spark, d), published(spark, d), files(spark), TODAY, confirm)


_HASH = "sha256(" + " || chr(31) || ".join(f"coalesce({f}, '')" for f in identity.FIELDS) + ")"
_FILES_SQL = ", ".join(f"('{i}', {str(f).lower()}, '{n}', '{m}', {str(r).lower()}, {str(p).lower()})" for i, f, n, m, r, p in FILES)
_CASES = " ".join(f"WHEN '{r}' THEN {vs}" for r, vs in ROLES.items() if vs)

RUN = f"""{q.ARCHIVE},
files AS (SELECT * FROM (VALUES {_FILES_SQL}) AS t(fid, fetched, fname, fmonth, removed, repurposed)),
ex AS (SELECT * REPLACE ('sheet-' || right(md5(coalesce(source_file_id, '')), 1) AS source_file_id, CASE WHEN right(md5(coalesce(source_file_id, '')), 1) = '5' THEN 2 ELSE missing_count END AS missing_count), lower(right(trim(incident_uid, ' '), 1)) AS h, {q.refs('case_number_raw')} AS refs FROM arch),
placed AS (SELECT *, right(source_file_id, 1) AS g, CASE WHEN status IN ('active', 'missing') AND len(refs) > 0 THEN row_number() OVER (PARTITION BY source_file_id, status IN ('active', 'missing') AND len(refs) > 0 ORDER BY incident_uid) END AS place FROM ex),
roled AS (SELECT *, CASE WHEN g IN ('a', 'd') THEN 'unread' WHEN g IN ('b', 'c') AND h >= '4' THEN 'absent'
    WHEN status IN ('active', 'missing') THEN CASE WHEN place = 1 THEN CASE WHEN g IN ('7', '8') THEN 'relocated' ELSE 'absent' END WHEN place = 2 THEN 'doubled' WHEN g = 'e' AND h >= '8' THEN 'absent'
      WHEN len(refs) > 0 AND h = '0' THEN 'appended' WHEN len(refs) > 0 AND h = '1' THEN 'exchanged' WHEN len(refs) > 0 AND h = '3' THEN 'moved' WHEN h = '5' THEN 'amended' WHEN h = 'a' THEN 'twice' WHEN h = '9' THEN 'joined' ELSE 'same' END
    WHEN status = 'superseded' THEN CASE WHEN h < '8' THEN 'same' ELSE 'absent' END WHEN h < '4' THEN 'same' ELSE 'absent' END AS role FROM placed),
varied AS (SELECT *, unnest(CASE role {_CASES} ELSE [] END) AS v FROM roled),
said AS (SELECT v, h, incident_uid AS known, CASE WHEN v = 1 THEN coalesce(case_number_raw, '') || '/ CSA 90001' WHEN v = 6 THEN coalesce(case_number_raw, '') || '/ CSA 90002' WHEN v IN (2, 3) THEN 'NUPD 31-' || lpad(CAST(row_id % 10000000 AS VARCHAR), 7, '0') WHEN v = 7 THEN 'NUPD 77-' || lpad(CAST(row_id % 10000000 AS VARCHAR), 7, '0') ELSE case_number_raw END AS case_number_raw,
    CASE WHEN v = 7 THEN '7/4/26 12:34' ELSE date_reported_raw END AS date_reported_raw, CASE WHEN v = 3 THEN '1/1/20 0:00' ELSE date_occurred_raw END AS date_occurred_raw, nature_raw, narrative_raw, campus_raw, location_raw,
    CASE WHEN v = 4 THEN coalesce(disposition_raw, '') || '; entry corrected' WHEN v = 5 THEN 'second reading' ELSE disposition_raw END AS disposition_raw,
    CASE WHEN v = 8 THEN 'sheet-moved' ELSE source_file_id END AS source_file_id, CASE WHEN v = 5 THEN source_row_index + 100000 ELSE source_row_index END AS source_row_index,
    CASE WHEN h IN ('2', '6', 'a') THEN 'Yes' ELSE '' END AS student_flag, CASE WHEN h = 'b' THEN 'near_duplicate' ELSE '' END AS flags, CASE WHEN h = 'c' THEN '' ELSE 'October 2026' END AS source_month FROM varied),
seen AS (SELECT *, CASE WHEN v IN (0, 4, 5, 8) THEN known ELSE {q.uid('case_number_raw', 'date_reported_raw')} END AS incident_uid, {_HASH} AS content_hash, {q.refs('case_number_raw')} AS refs FROM said),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY incident_uid ORDER BY source_row_index DESC) AS k FROM seen) WHERE k = 1),
e AS (SELECT ex.*, coalesce(fetched, false) AS fetched, coalesce(removed, false) AS removed, coalesce(repurposed, false) AS repurposed, coalesce(fmonth, '') AS fmonth,
    coalesce(fetched AND fmonth <> '' AND coalesce(source_month, '') <> '' AND status IN ('active', 'missing', 'withdrawn') AND source_month <> fmonth, false) AS stale FROM ex LEFT JOIN files ON source_file_id = fid),
gone AS (SELECT * FROM e WHERE status IN ('active', 'missing', 'withdrawn') AND fetched AND incident_uid NOT IN (SELECT incident_uid FROM o)),
pool AS (SELECT incident_uid, source_file_id, date_reported_raw, case_number_raw, date_occurred_raw, nature_raw, campus_raw, location_raw, refs FROM o
  UNION ALL SELECT incident_uid, source_file_id, date_reported_raw, case_number_raw, date_occurred_raw, nature_raw, campus_raw, location_raw, refs FROM e WHERE status = 'active' AND incident_uid NOT IN (SELECT incident_uid FROM o)),
g1 AS (SELECT source_file_id AS a, coalesce(date_reported_raw, '') AS b, count(*) AS n FROM gone GROUP BY 1, 2),
f1 AS (SELECT source_file_id AS a, coalesce(date_reported_raw, '') AS b, count(*) AS n FROM o WHERE incident_uid NOT IN (SELECT incident_uid FROM e) GROUP BY 1, 2),
lone AS (SELECT a, b FROM g1 JOIN f1 USING (a, b) WHERE g1.n = 1 AND f1.n = 1),
pairs AS (SELECT g.incident_uid AS uid, p.incident_uid AS puid, p.case_number_raw AS pcase, coalesce(g.date_occurred_raw, '') = coalesce(p.date_occurred_raw, '') AS fully, len([x for x in g.refs if NOT list_contains(p.refs, x)]) = 0 AND len(p.refs) > len(g.refs) AS appended, lone.a IS NOT NULL AS single
  FROM gone g JOIN pool p ON g.source_file_id = p.source_file_id AND coalesce(g.date_reported_raw, '') = coalesce(p.date_reported_raw, '') AND g.incident_uid <> p.incident_uid
  LEFT JOIN lone ON lone.a = g.source_file_id AND lone.b = coalesce(g.date_reported_raw, '')
  WHERE len(g.refs) > 0 AND len(p.refs) > 0 AND NOT (len([x for x in p.refs if NOT list_contains(g.refs, x)]) = 0 AND len(g.refs) > len(p.refs))
    AND (coalesce(g.nature_raw, '') = coalesce(p.nature_raw, '') OR {q.inline('g.nature_raw', 'p.nature_raw')}) AND coalesce(g.campus_raw, '') = coalesce(p.campus_raw, '') AND coalesce(g.location_raw, '') = coalesce(p.location_raw, '')),
tier AS (SELECT uid, count(*) FILTER (appended OR (fully AND single)) AS l, count(*) FILTER (NOT (appended OR (fully AND single))) AS r, min((puid, pcase)) FILTER (appended OR (fully AND single)) AS lp, min((puid, pcase)) FILTER (NOT (appended OR (fully AND single))) AS rp FROM pairs GROUP BY 1),
mt AS (SELECT uid, CASE WHEN l = 1 THEN 'fork' WHEN l > 1 THEN 'ambiguous' WHEN r = 1 THEN 'near_miss' ELSE 'ambiguous' END AS outcome, CASE WHEN l = 1 THEN lp[1] WHEN l = 0 AND r = 1 THEN rp[1] END AS match, CASE WHEN l = 1 THEN lp[2] WHEN l = 0 AND r = 1 THEN rp[2] END AS mcase FROM tier),
acc AS (SELECT e.source_file_id AS fid, count(*) AS accountable, count(*) FILTER (EXISTS (SELECT 1 FROM seen WHERE seen.incident_uid = e.incident_uid AND seen.source_file_id = e.source_file_id)) AS kept FROM e
  WHERE status IN ('active', 'missing') AND fetched AND NOT stale AND incident_uid NOT IN (SELECT uid FROM mt WHERE outcome <> 'ambiguous') GROUP BY 1),
guard AS (SELECT fid AS source_file_id, accountable, kept, accountable - kept AS dropped, kept / accountable AS retention, (SELECT count(*) FROM seen WHERE seen.source_file_id = acc.fid) = 0 OR accountable - kept > 2 OR kept / accountable < 0.9 AS quarantined FROM acc),
dec AS (SELECT e.*, o.incident_uid IS NOT NULL AS seen, {', '.join(f'o.{f} AS o_{f}' for f in identity.FIELDS)}, o.content_hash AS o_content_hash, o.source_file_id AS o_source_file_id, o.source_row_index AS o_source_row_index, o.flags AS o_flags, o.student_flag AS o_student_flag, o.source_month AS o_source_month,
    of.fname AS of_name, of.fmonth AS of_month, o.incident_uid AS o_uid, mt.match, mt.mcase, e.fetched AND NOT coalesce(guard.quarantined, false) AS trusted, CASE WHEN e.fetched AND NOT coalesce(guard.quarantined, false) THEN mt.outcome END AS oc
  FROM e FULL JOIN o ON e.incident_uid = o.incident_uid LEFT JOIN files of ON of.fid = o.source_file_id LEFT JOIN mt ON mt.uid = e.incident_uid LEFT JOIN guard ON guard.source_file_id = e.source_file_id),
fin0 AS (SELECT *, status NOT IN ('withdrawn', 'superseded', 'source_removed') AND trusted AND NOT coalesce(missing_since = DATE '{TODAY}' OR last_absent = DATE '{TODAY}', false) AS climbs FROM dec),
fin AS (SELECT *, CASE WHEN incident_uid IS NULL THEN 'added' WHEN seen AND status = 'superseded' THEN 'contradicted' WHEN seen THEN 'seen' WHEN oc = 'fork' THEN 'superseded' WHEN removed THEN CASE WHEN status = 'source_removed' THEN 'kept' ELSE 'removed' END
    WHEN stale AND repurposed THEN 'retired' WHEN stale THEN 'held' WHEN oc = 'near_miss' THEN 'held' WHEN @ABSENT@ END AS decision,
    coalesce(oc IN ('near_miss', 'ambiguous'), false) AS review, coalesce(oc = 'near_miss' AND NOT contains(coalesce(flags, ''), 'possible_duplicate_identity'), false) AS first_review, coalesce(o_content_hash IS DISTINCT FROM content_hash, false) AS changed,
    coalesce(missing_count, 0) + 1 AS steps FROM fin0)"""
MERGE_SQL = "WITH " + RUN.replace("@ABSENT@", "climbs THEN 'absent' ELSE 'kept'")
FLAG_SQL = "WITH " + RUN.replace("@ABSENT@", "trusted AND status = 'active' THEN 'flagged' ELSE 'kept'")


def _flags(*more: str) -> str:
    """A ``;`` list with further flags or lists of flags, sorted and without repeats."""
    parts = " || ';' || ".join(["coalesce(flags, '')", *more])
    return f"array_to_string(list_sort(list_distinct([x for x in string_split({parts}, ';') if x <> ''])), ';')"


_FRESH = "decision IN ('added', 'seen')"
_BASE_FLAGS = f"CASE WHEN review OR decision = 'contradicted' THEN {_flags(repr('possible_duplicate_identity'))} ELSE coalesce(flags, '') END"
ROW_SQL = {
    **{c: f"CASE WHEN {_FRESH} THEN o_{c} ELSE {c} END" for c in [*identity.FIELDS, "content_hash", "source_file_id", "source_row_index"]},
    "incident_uid": "coalesce(incident_uid, o_uid)",
    "case_number_norm": f"CASE WHEN {_FRESH} THEN upper({q.collapse('o_case_number_raw')}) ELSE case_number_norm END",
    "source_file_name": f"CASE WHEN {_FRESH} THEN coalesce(of_name, source_file_name) ELSE source_file_name END",
    "source_month": f"CASE WHEN {_FRESH} THEN coalesce(nullif(of_month, ''), nullif(o_source_month, ''), source_month) ELSE source_month END",
    "source_era": f"CASE WHEN {_FRESH} THEN 'sheet-2026' ELSE source_era END",
    "student_flag": f"CASE WHEN {_FRESH} THEN coalesce(nullif(o_student_flag, ''), student_flag) ELSE student_flag END",
    "first_seen_by_archive": f"CASE WHEN decision = 'added' THEN DATE '{TODAY}' ELSE first_seen_by_archive END",
    "last_verified": f"CASE WHEN {_FRESH} THEN DATE '{TODAY}' ELSE last_verified END",
    "missing_since": f"CASE WHEN decision = 'seen' THEN NULL WHEN decision IN ('absent', 'removed', 'retired') THEN coalesce(missing_since, DATE '{TODAY}') ELSE missing_since END",
    "missing_count": f"CASE WHEN {_FRESH} THEN 0 WHEN decision = 'absent' THEN steps ELSE missing_count END",
    "last_absent": f"CASE WHEN decision = 'absent' THEN DATE '{TODAY}' ELSE last_absent END",
    "status": f"CASE WHEN {_FRESH} THEN 'active' WHEN decision = 'superseded' THEN 'superseded' WHEN decision IN ('removed', 'retired') THEN 'source_removed' WHEN decision = 'absent' THEN CASE WHEN steps >= 3 THEN 'withdrawn' ELSE 'missing' END ELSE status END",
    "superseded_by": "CASE WHEN decision = 'superseded' THEN match ELSE superseded_by END",
    "revision": "CASE WHEN decision = 'added' THEN 1 WHEN decision = 'seen' AND changed THEN coalesce(revision, 0) + 1 ELSE revision END",
    "flags": f"""CASE WHEN decision = 'added' THEN coalesce(o_flags, '') WHEN decision = 'seen' AND status IN ('missing', 'withdrawn') THEN {_flags("'was_missing'", "coalesce(o_flags, '')")} WHEN decision = 'seen' THEN {_flags("coalesce(o_flags, '')")}
      WHEN decision = 'superseded' THEN {_flags(repr('superseded_identity'))} WHEN decision = 'flagged' THEN array_to_string(list_sort(list_distinct([x for x in string_split(({_BASE_FLAGS}) || ';absent_in_later_capture', ';') if x <> ''])), ';') ELSE {_BASE_FLAGS} END""",
}
_ROWS = " SELECT decision, " + ", ".join(f"{ROW_SQL[c]} AS {c}" for c in merge.ARCHIVE_COLUMNS) + " FROM fin"

_TYPES = {"string": "VARCHAR", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN"}


def _event(kind: str, when: str, source: str = "fin", nth: int = 0, **values: str) -> str:
    given = {"observed_date": f"DATE '{TODAY}'", "incident_uid": "coalesce(incident_uid, o_uid)", "change_type": f"'{kind}'"} | values
    return f"SELECT {nth} AS nth, " + ", ".join(f"CAST({given.get(n, 'NULL')} AS {_TYPES[t]}) AS {n}" for n, t in merge.EVENT_COLUMNS) + f" FROM {source} WHERE {when}"


_OLD = {"case_number": "case_number_raw"}
_FULL = _OLD | {"date_reported": "date_reported_raw", "nature": "nature_raw", "last_known_disposition": "disposition_raw"}
_SINCE = {"missing_since": f"coalesce(missing_since, DATE '{TODAY}')", "confirmations": "steps"}
_COSMETIC = {"date_reported_raw": f"{q.reported('date_reported_raw')} = {q.reported('o_date_reported_raw')}", "date_occurred_raw": f"{q.occurred('date_occurred_raw')} = {q.occurred('o_date_occurred_raw')}"}
_EVENTS = [
    _event("possible_renumbering", "first_review", nth=1, possible_replacement="mcase", source_month="source_month", **_OLD),
    _event("added", "decision = 'added'", nth=2, revision="1", source_file_id="o_source_file_id", case_number="o_case_number_raw", date_reported="o_date_reported_raw", nature="o_nature_raw"),
    _event("reappeared", "decision = 'seen' AND status IN ('missing', 'withdrawn')", nth=3, was_missing_since="missing_since", previous_status="status"),
    _event("relocated", "decision = 'seen' AND o_source_file_id IS DISTINCT FROM source_file_id", nth=4, from_file_id="source_file_id", to_file_id="o_source_file_id"),
    _event("superseded_identity", "decision = 'superseded'", nth=5, superseded_by="match", old_value="case_number_raw", new_value="mcase", **_OLD),
    _event("source_removed", "decision IN ('removed', 'retired')", nth=6, source_file_id="source_file_id", source_month="source_month", previous_status="status", removal_mechanism="CASE WHEN decision = 'retired' THEN 'file_repurposed' END", **_FULL),
    _event("missing", "decision = 'absent' AND steps < 3", nth=7, **_SINCE, **_OLD),
    _event("withdrawn", "decision = 'absent' AND steps >= 3", nth=8, **_SINCE, **_FULL),
    *[
        _event("amended", f"decision = 'seen' AND changed AND coalesce({f}, '') <> coalesce(o_{f}, '')", nth=10 + k, revision="coalesce(revision, 0) + 1", field_name=f"'{f}'", old_value=f"coalesce({f}, '')", new_value=f"coalesce(o_{f}, '')", cosmetic=_COSMETIC.get(f, "false"), case_number="o_case_number_raw")
        for k, f in enumerate(identity.FIELDS)
    ],
]
_NUMBERED = "SELECT * EXCLUDE (nth) REPLACE (CAST(row_number() OVER (PARTITION BY incident_uid ORDER BY nth) AS INTEGER) AS run_seq)"


@query(MERGE_SQL + _ROWS)
def merge_full_outer(spark, d):
    result = merged(spark, d)
    return result.rows.join(result.decisions.select("incident_uid", "decision"), "incident_uid")


@query(MERGE_SQL + f" {_NUMBERED} FROM (" + " UNION ALL ".join(_EVENTS) + ")")
def merge_events(spark, d):
    return merged(spark, d).events


@query(FLAG_SQL + _ROWS.replace("SELECT decision", "SELECT decision", 1))
def merge_irregular_captures(spark, d):
    result = merged(spark, d, confirm=False)
    return result.rows.join(result.decisions.select("incident_uid", "decision"), "incident_uid")


@query(MERGE_SQL + """, n AS (SELECT count(*) FILTER (decision = 'added') AS added, count(*) FILTER (decision = 'seen' AND changed AND (""" + " OR ".join(f"coalesce({f}, '') <> coalesce(o_{f}, '')" for f in identity.FIELDS) + """)) AS amended,
  count(*) FILTER (decision = 'absent' AND steps < 3) AS missing, count(*) FILTER (decision = 'absent' AND steps >= 3) AS withdrawn, count(*) FILTER (decision IN ('removed', 'retired')) AS source_removed, count(*) FILTER (decision = 'seen' AND status IN ('missing', 'withdrawn')) AS reappeared,
  count(*) FILTER (decision = 'seen' AND o_source_file_id IS DISTINCT FROM source_file_id) AS relocated, count(*) FILTER (decision = 'superseded') AS superseded, count(*) FILTER (decision = 'seen' AND NOT changed) AS unchanged FROM fin)
  SELECT CAST(added AS INTEGER) AS added, CAST(amended AS INTEGER) AS amended, CAST(missing AS INTEGER) AS missing, CAST(withdrawn AS INTEGER) AS withdrawn, CAST(source_removed AS INTEGER) AS source_removed, CAST(reappeared AS INTEGER) AS reappeared, CAST(relocated AS INTEGER) AS relocated,
    CAST(superseded AS INTEGER) AS superseded, CAST(unchanged AS INTEGER) AS unchanged, coalesce((SELECT array_to_string(list_sort(list(source_file_id)), ',') FROM guard WHERE quarantined), '') AS quarantined, (SELECT array_to_string(list_sort(list(fid)), ',') FROM files WHERE NOT fetched) AS unfetched,
    added + amended + withdrawn + source_removed + reappeared + relocated + superseded > 0 AS changed,
    '+' || added || ' added, ' || amended || ' amended, ' || missing || ' missing, ' || withdrawn || ' withdrawn, ' || source_removed || ' source-removed, ' || reappeared || ' reappeared, ' || superseded || ' superseded' AS summary FROM n""")
def merge_report(spark, d):
    report = merge.merge_report(merged(spark, d), files(spark))
    return report.withColumns({c: F.array_join(c, ",") for c in ("quarantined", "unfetched")})


@query(MERGE_SQL + """ SELECT source_file_id AS subject, CASE WHEN kept = 0 THEN 'read, but none of its rows was seen: quarantined' WHEN quarantined THEN dropped || ' of ' || accountable || ' rows absent: quarantined' ELSE dropped || ' row(s) absent' END AS warning FROM guard WHERE quarantined OR dropped > 0
  UNION ALL SELECT incident_uid, 'published again beside its replacement' FROM fin WHERE decision = 'contradicted'""")
def merge_warnings(spark, d):
    return merge.merge_warnings(merged(spark, d))


@query(MERGE_SQL + " SELECT uid, outcome, match, mcase FROM mt")
def fork_match_tiers(spark, d):
    matched = merge.match_renumbered(existing(spark, d), merge.last_observed(published(spark, d)), files(spark).filter("fetched"))
    return matched.select("uid", "outcome", F.col("match.uid").alias("match"), F.col("match.case_number").alias("mcase"))


@query(MERGE_SQL + " SELECT source_file_id, accountable, kept, dropped, retention, quarantined, NOT quarantined AND dropped > 0 AS warned FROM guard")
def shrink_guard(spark, d):
    return merged(spark, d).guard


@query(MERGE_SQL + " SELECT incident_uid, source_month FROM e WHERE stale")
def stale_cohort(spark, d):
    own = files(spark).select("source_file_id", "month", "fetched")
    return existing(spark, d).join(F.broadcast(own), "source_file_id").filter(merge.stale_cohort("", F.col("month"), F.col("fetched"))).select("incident_uid", "source_month")


@query(MERGE_SQL + f""", after AS ({_ROWS}), j AS (SELECT b.incident_uid AS b, a.incident_uid AS a, b.first_seen_by_archive AS bf, a.first_seen_by_archive AS af, b.case_number_norm AS bc, a.case_number_norm AS ac, b.date_reported_raw AS br, a.date_reported_raw AS ar, b.status AS bs, a.status AS as_, a.decision FROM ex b FULL JOIN after a ON a.incident_uid = b.incident_uid)
  SELECT count(*) FILTER (b IS NOT NULL AND a IS NULL) AS lost, count(*) FILTER (b IS NOT NULL AND a IS NOT NULL AND bf IS DISTINCT FROM af) AS first_seen, count(*) FILTER (b IS NOT NULL AND a IS NOT NULL AND coalesce(bc, '') <> '' AND bc IS DISTINCT FROM ac) AS case_number,
    count(*) FILTER (b IS NOT NULL AND a IS NOT NULL AND coalesce(br, '') <> '' AND {q.reported('br')} <> {q.reported('ar')}) AS reported,
    count(*) FILTER (bs = 'active' AND NOT (coalesce(as_, '') = 'source_removed' AND decision <> 'retired')) AS active_before, count(*) FILTER (as_ = 'active') AS active_after FROM j""")
def corpus_brake(spark, d):
    found = merge.broken_invariants(existing(spark, d), merged(spark, d))
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} bigint" for k in found))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
