"""Queries of the general data problems, with the SQL they are checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.operators.change_feed import append_feed, current_state, read_feed
from daybook.operators.history import attribute_history
from daybook.operators.packed import NUMBERS, PROSE, unpack_fields
from daybook.operators.snapshot_diff import snapshot_changes
from daybook.operators.timestamps import resolve_timestamps
from daybook.session import checkpoint_folder, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The UTC instant of every full point in time, as chosen over the order of each source; values without a conventional reading are no case."""
    found = resolve_timestamps(table(spark, sf_dir, "incidents"), table(spark, sf_dir, "source_files"))
    return found.filter("least_departures = 0").selectExpr("record AS row_id", "field AS field_name", "utc_micros")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of a disposition that changed."""
    return attribute_history(table(spark, sf_dir, "changelog"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of a field that holds two or more."""
    found = unpack_fields(
        table(spark, sf_dir, "incidents"),
        {"case_number_raw": NUMBERS, "disposition_raw": PROSE, "nature_raw": PROSE},
        {"disposition_raw": table(spark, sf_dir, "disposition_map").select("raw_token"), "nature_raw": table(spark, sf_dir, "category_map").select("raw_token")},
    )
    return found.withColumnRenamed("record", "row_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in force after the last event."""
    return current_state(table(spark, sf_dir, "changelog"))


def change_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from insert and delete files that the feed was appended to, read back."""
    folder = f"{checkpoint_folder(spark)}/feed-{uuid.uuid4().hex}"
    append_feed(folder, table(spark, sf_dir, "changelog"))
    return read_feed(spark, folder)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records added, removed and changed between consecutive snapshots."""
    return snapshot_changes(table(spark, sf_dir, "incident_snapshots"))


SETTLED = """
ev AS (SELECT * FROM (
    SELECT *, lower(trim(incident_uid)) AS uid, lower(trim(change_type)) AS kind,
           row_number() OVER (PARTITION BY lower(trim(incident_uid)), observed_date, run_seq ORDER BY log_pos DESC) AS nth
    FROM changelog WHERE incident_uid IS NOT NULL AND observed_date IS NOT NULL) WHERE nth = 1),
live AS (SELECT * FROM (
    SELECT *, coalesce(last_value(CASE WHEN kind IN ('added', 'source_removed') THEN kind END IGNORE NULLS) OVER (
        PARTITION BY uid ORDER BY observed_date, run_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') = 'added' AS alive FROM ev)
    WHERE alive OR kind = 'source_removed')
"""

P4_SQL = f"""
WITH {SETTLED},
am AS (SELECT uid, observed_date AS d, run_seq, old_value, new_value FROM live WHERE alive AND kind = 'amended' AND field_name = 'disposition_raw'),
day AS (SELECT uid, d, arg_max(new_value, run_seq) AS v FROM am GROUP BY uid, d),
start AS (SELECT a.uid, (SELECT min(observed_date) FROM ev WHERE ev.uid = a.uid AND kind = 'added') AS d, a.old_value AS v
    FROM (SELECT uid, arg_min(old_value, (d, run_seq)) AS old_value FROM am GROUP BY uid) a),
units AS (SELECT uid, d, v, 0 AS k FROM start UNION ALL SELECT uid, d, v, 1 FROM day),
opens AS (SELECT * FROM (SELECT *, k = 0 OR v IS DISTINCT FROM lag(v) OVER (PARTITION BY uid ORDER BY k, d) AS o FROM units) WHERE o),
held AS (SELECT * FROM (SELECT uid, k, d, v, lead(d) OVER (PARTITION BY uid ORDER BY k, d) AS until FROM opens) WHERE until IS NULL OR until > d),
spans AS (SELECT *, count(*) OVER (PARTITION BY uid) AS n FROM held)
SELECT uid AS incident_uid, strftime(d, '%Y-%m-%d') AS valid_from, coalesce(strftime(until, '%Y-%m-%d'), '') AS valid_to, v AS disposition_raw
FROM spans WHERE n > 1
"""

P6_SQL = f"""
WITH {SETTLED},
gone AS (SELECT uid, max((observed_date, run_seq)) AS at FROM live WHERE kind = 'source_removed' GROUP BY uid),
kept AS (SELECT live.* FROM live LEFT JOIN gone ON live.uid = gone.uid WHERE alive AND (gone.at IS NULL OR (observed_date, run_seq) > gone.at))
SELECT uid AS incident_uid,
    CASE arg_max(kind, (observed_date, run_seq)) FILTER (kind IN ('added', 'missing', 'withdrawn', 'reappeared', 'superseded_identity'))
        WHEN 'missing' THEN 'missing' WHEN 'withdrawn' THEN 'withdrawn' WHEN 'superseded_identity' THEN 'superseded' ELSE 'active' END AS status,
    arg_max(revision, (observed_date, run_seq)) FILTER (kind IN ('added', 'amended')) AS revision,
    arg_max(CASE kind WHEN 'added' THEN source_file_id ELSE to_file_id END, (observed_date, run_seq)) FILTER (kind IN ('added', 'relocated')) AS source_file_id
FROM kept GROUP BY uid
"""

P7_SQL = """
WITH s AS (SELECT snapshot_date AS d, snapshot_seq AS q, lower(trim(incident_uid)) AS uid, lower(trim(content_hash)) AS h, lower(trim(status)) AS st,
        row_number() OVER (PARTITION BY snapshot_date, snapshot_seq, lower(trim(incident_uid)) ORDER BY source_row_index DESC) AS nth
    FROM incident_snapshots),
one AS (SELECT * FROM s WHERE nth = 1 AND uid IS NOT NULL AND uid <> ''),
n AS (SELECT d, q, row_number() OVER (ORDER BY d, q) AS k FROM (SELECT DISTINCT d, q FROM s)),
a AS (SELECT k, uid, h, st FROM one JOIN n USING (d, q)),
diff AS (SELECT coalesce(x.k, y.k + 1) AS k, coalesce(x.uid, y.uid) AS uid,
        CASE WHEN y.uid IS NULL THEN 'added' WHEN x.uid IS NULL THEN 'removed' WHEN x.h IS DISTINCT FROM y.h OR x.st IS DISTINCT FROM y.st THEN 'changed' END AS change_kind
    FROM a x FULL JOIN a y ON x.uid = y.uid AND x.k = y.k + 1)
SELECT strftime(n.d, '%Y-%m-%d') AS snapshot_date, n.q AS snapshot_seq, diff.uid AS incident_uid, change_kind
FROM diff JOIN n USING (k) WHERE k > 1 AND change_kind IS NOT NULL
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "change_files": change_files, "p7_found": p7_found}


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4_SQL, "p6_found": P6_SQL, "change_files": P6_SQL, "p7_found": P7_SQL}
