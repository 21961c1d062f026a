"""Queries of the archive's own operators, each over its whole tables, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.functions import dates, identity, tokens
from daybook.operators import ladders, legacy
from daybook.plans import archive_sql as q
from daybook.plans import derive
from daybook.session import Written, clean_key, table
from daybook.sinks import archive as archive_sink
from daybook.sinks import export
from daybook.sources import maps, sheet

TODAY = "2026-11-21"
STARTED = "2026-08-03"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def of(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return of


def incidents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "incidents")


def archive(spark: SparkSession, d: str) -> DataFrame:
    return derive.current_rows(incidents(spark, d))


_DERIVED: dict[tuple[str, str], DataFrame] = {}


def derived(spark: SparkSession, d: str) -> DataFrame:
    """The derived view, written once a session and folder; the marts read it."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _DERIVED:
        lookups = [
            maps.lookup_column(table(spark, d, "category_map"), "categories"),
            maps.lookup_column(table(spark, d, "disposition_map"), "flags"),
            maps.lookup_column(table(spark, d, "campus_map"), "campus", key="raw_value"),
        ]
        _DERIVED[at] = Written(spark).write(derive.derive(archive(spark, d), *lookups))
    return _DERIVED[at]


def text(c: str):
    return F.coalesce(F.col(c), F.lit(""))


# ---- identity and hashing ----


@query(f"SELECT row_id, upper({q.collapse('case_number_raw')}) AS case_norm, {q.reported('date_reported_raw')} AS reported, {q.uid('case_number_raw', 'date_reported_raw')} AS uid FROM incidents")
def uid_hash(spark, d):
    i = incidents(spark, d)
    c, r = F.col("case_number_raw"), F.col("date_reported_raw")
    return i.select("row_id", identity.normalize_case_number(c).alias("case_norm"), identity.canonical_reported(r).alias("reported"), identity.incident_uid(c, r).alias("uid"))


@query("SELECT row_id, sha256(" + " || chr(31) || ".join(f"coalesce({f}, '')" for f in identity.FIELDS) + ") AS hash FROM incidents")
def content_hash(spark, d):
    return incidents(spark, d).select("row_id", identity.content_hash(*[F.col(f) for f in identity.FIELDS]).alias("hash"))


@query(f"SELECT row_id, {q.occurred('date_occurred_raw')} AS occurred FROM incidents")
def canonical_occurred(spark, d):
    return incidents(spark, d).select("row_id", identity.canonical_occurred(F.col("date_occurred_raw")).alias("occurred"))


@query(f"SELECT row_id, array_to_string({q.refs('case_number_raw')}, ',') AS refs FROM incidents")
def case_references(spark, d):
    return incidents(spark, d).select("row_id", F.array_join(identity.case_references(F.col("case_number_raw")), ",").alias("refs"))


@query("""SELECT row_id, count(*) OVER (PARTITION BY source_file_id, upper(%s), nature_raw, narrative_raw, campus_raw, location_raw, disposition_raw, case_number_raw) > 1 AS near_duplicate FROM incidents""" % q.collapse("case_number_raw"))
def near_duplicate_flag(spark, d):
    return sheet.flag_near_duplicates(incidents(spark, d)).select("row_id", (F.col("flags") == "near_duplicate").alias("near_duplicate"))


@query(f"""SELECT log_pos, {q.inline('old_value', 'new_value')} AS amends_inline,
  CASE field_name WHEN 'date_reported_raw' THEN {q.reported('old_value')} = {q.reported('new_value')} WHEN 'date_occurred_raw' THEN {q.occurred('old_value')} = {q.occurred('new_value')} ELSE false END AS cosmetic
  FROM changelog WHERE lower(trim(change_type)) = 'amended'""")
def amendment_kind(spark, d):
    log = table(spark, d, "changelog").filter(F.lower(F.trim("change_type")) == "amended")
    old, new = F.col("old_value"), F.col("new_value")
    return log.select("log_pos", identity.amends_inline(old, new).alias("amends_inline"), identity.is_cosmetic(F.col("field_name"), old, new).alias("cosmetic"))


# ---- tokens ----


@query(f"SELECT row_id, array_to_string([{q.fold('t')} for t in {q._tokens('disposition_raw')}], '|') AS tokens FROM incidents")
def token_fold_split(spark, d):
    folded = F.transform(tokens.tokenize(F.col("disposition_raw")), tokens.fold_token)
    return incidents(spark, d).select("row_id", F.array_join(folded, "|").alias("tokens"))


@query(f"WITH {q.DERIVED} SELECT uid, array_to_string(list_sort(list_distinct(cats)), '|') AS categories, array_to_string(list_sort(list_distinct([c for c in supcats if NOT list_contains(cats, c)])), '|') AS reclassified_from, n_sup > 0 AS was_reclassified, array_to_string(objects, '|') AS objects, array_to_string(activity, '|') AS activity, array_to_string(channels, '|') AS channels, array_to_string(unclassified, '|') AS unclassified FROM der")
def categorize(spark, d):
    lookup = maps.lookup_column(table(spark, d, "category_map"), "categories")
    c = archive(spark, d).select(F.col("incident_uid").alias("uid"), tokens.categorize(F.col("nature_raw"), lookup).alias("n"))
    join = lambda x: F.array_join(x, "|")
    return c.select("uid", join(F.array_sort("n.categories")).alias("categories"), join(F.array_sort("n.reclassified_from")).alias("reclassified_from"), "n.was_reclassified", *[join(F.col(f"n.{k}")).alias(k) for k in ("objects", "activity", "channels", "unclassified")])


@query(f"WITH {q.DERIVED} SELECT uid, array_to_string(list_sort(list_distinct(dflags)), '|') AS flags, n_dsup > 0 AS amended, array_to_string([f for f in dsupflags if NOT list_contains(dflags, f)], '|') AS superseded_flags, array_to_string(unclassified_d, '|') AS unclassified FROM der")
def disposition_flags(spark, d):
    lookup = maps.lookup_column(table(spark, d, "disposition_map"), "flags")
    c = archive(spark, d).select(F.col("incident_uid").alias("uid"), tokens.disposition_flags(F.col("disposition_raw"), lookup).alias("n"))
    return c.select("uid", F.array_join(F.array_sort("n.flags"), "|").alias("flags"), F.col("n.disposition_amended").alias("amended"), F.array_join("n.superseded_flags", "|").alias("superseded_flags"), F.array_join("n.unclassified", "|").alias("unclassified"))


@query(f"WITH {q.DERIVED} SELECT uid, array_to_string(agencies, '|') AS agencies, campus FROM der")
def agencies_and_campus(spark, d):
    lookup = maps.lookup_column(table(spark, d, "campus_map"), "campus", key="raw_value")
    return archive(spark, d).select(F.col("incident_uid").alias("uid"), F.array_join(tokens.agencies(F.col("case_number_raw")), "|").alias("agencies"), tokens.campus_name(F.col("campus_raw"), lookup).alias("campus"))


@query(f"WITH {q.ARCHIVE}, t AS (SELECT unnest({q._tokens('nature_raw')}) AS token FROM arch) SELECT token, count(*) AS n FROM t WHERE {q.fold('token')} NOT IN (SELECT {q.fold('raw_token')} FROM category_map) GROUP BY token")
def map_strict_unmapped(spark, d):
    found = archive(spark, d).select(F.explode(tokens.tokenize(F.col("nature_raw"))).alias("token"))
    return maps.unmapped_tokens(found, table(spark, d, "category_map"))


_RESPELLED_MAP = "(SELECT raw_token, token_role, flags FROM disposition_map UNION ALL SELECT upper(raw_token) || '.', token_role, CASE WHEN raw_token < 'm' THEN flags ELSE coalesce(flags, '') || '|other' END FROM disposition_map)"


@query(f"SELECT {q.fold('raw_token')} AS folded, count(DISTINCT (token_role, coalesce(flags, ''))) AS versions FROM {_RESPELLED_MAP} GROUP BY 1 HAVING count(DISTINCT (token_role, coalesce(flags, ''))) > 1")
def map_contradictions(spark, d):
    """Keys whose spellings disagree, in the list with a second spelling of every key, half of which have another flag."""
    m = table(spark, d, "disposition_map").select("raw_token", "token_role", "flags")
    other = F.when(F.col("raw_token") < "m", F.col("flags")).otherwise(F.concat(text("flags"), F.lit("|other")))
    respelled = m.unionByName(m.select(F.concat(F.upper("raw_token"), F.lit(".")).alias("raw_token"), "token_role", other.alias("flags")))
    return maps.contradictions(respelled).select("folded", F.size("spellings").cast("bigint").alias("versions"))


# ---- dates ----


@query(f"WITH {q.DERIVED} SELECT uid, rep_value, rep_precision, occ_value, occ_precision, occ_ongoing, lag, month_key, school_year, occ_key, occ_reason, occ_year FROM der")
def partial_date_ladder(spark, d):
    x = derived(spark, d)
    return x.select("uid", F.col("reported.value").alias("rep_value"), F.col("reported.precision").alias("rep_precision"), F.col("occurred.value").alias("occ_value"), F.col("occurred.precision").alias("occ_precision"), F.col("occurred.ongoing").alias("occ_ongoing"), F.col("reporting_lag_hours").alias("lag"), "month_key", "school_year", F.col("occurred_month_key").alias("occ_key"), F.col("occurred_excluded").alias("occ_reason"), F.col("occurred_school_year").alias("occ_year"))


@query("SELECT log_pos, strftime(try_strptime(substr(capture_timestamp, 1, 8), '%Y%m%d'), '%Y-%m-%d') AS captured FROM changelog WHERE capture_timestamp IS NOT NULL")
def capture_dates(spark, d):
    return table(spark, d, "changelog").filter("capture_timestamp IS NOT NULL").select("log_pos", F.date_format(dates.capture_date(F.col("capture_timestamp")), "yyyy-MM-dd").alias("captured"))


# ---- marts ----


@query(f"""WITH {q.DERIVED}, v AS (
  SELECT 'categories' AS facet, unnest(list_distinct(cats)) AS value FROM counted UNION ALL SELECT 'school_years', school_year FROM counted UNION ALL SELECT 'campuses', campus FROM counted
  UNION ALL SELECT 'months', month FROM counted UNION ALL SELECT 'locations', location FROM counted UNION ALL SELECT 'disposition_flags', unnest(list_distinct(dflags)) FROM counted
  UNION ALL SELECT 'agencies', unnest(agencies) FROM counted UNION ALL SELECT 'statuses', status FROM der)
  SELECT facet, value, count(*) AS n FROM v WHERE value IS NOT NULL AND value <> '' GROUP BY 1, 2""")
def facet_counts(spark, d):
    return derive.facets(derived(spark, d)).select("facet", "value", "n")


_YEARS = "SELECT {y} AS year, count(*) AS incidents, count(DISTINCT {m}) AS months_covered, array_to_string(list_sort(list(DISTINCT {m})), ',') AS months, count(DISTINCT {m}) = 12 AS complete, array_to_string(list_sort(list(DISTINCT era)), ',') AS eras FROM counted WHERE {y} IS NOT NULL GROUP BY 1"


@query(f"WITH {q.DERIVED} {_YEARS.format(y='school_year', m='month_key')}")
def school_year_summary(spark, d):
    return derive.school_years(derived(spark, d))


@query(f"WITH {q.DERIVED} {_YEARS.format(y='occ_year', m='occ_key')}")
def school_year_occurred(spark, d):
    return derive.school_years(derived(spark, d), "occurred_school_year", "occurred_month_key")


@query(f"WITH {q.DERIVED}, l AS (SELECT unnest(agencies) AS agency, lag FROM counted WHERE lag >= 0) SELECT agency, count(*) AS n, round(median(lag) / 24, 1) AS median_days FROM l GROUP BY 1 HAVING count(*) >= 20")
def lag_median_by_agency(spark, d):
    return derive.lag_medians(derived(spark, d))


@query(f"WITH {q.DERIVED} SELECT count(*) AS total, count(*) FILTER (occ_key IS NOT NULL) AS shown, count(*) FILTER (occ_reason = 'no_date') AS excluded_no_date, count(*) FILTER (occ_reason = 'before_window') AS excluded_before_window FROM counted")
def month_bin_conservation(spark, d):
    return derive.binning(derived(spark, d))


@query(f"""WITH {q.ARCHIVE} SELECT count(*) AS total_archived, count(*) FILTER (status IN ('active', 'missing')) AS currently_published, count(*) FILTER (status NOT IN ('active', 'missing', 'superseded')) AS no_longer_published,
  count(*) FILTER (status = 'superseded') AS superseded, count(*) FILTER (status <> 'superseded') AS distinct_incidents, count(*) FILTER (status = 'withdrawn') AS withdrawn, count(*) FILTER (status = 'source_removed') AS source_removed FROM arch""")
def status_counts(spark, d):
    return derive.status_counts(archive(spark, d))


@query(f"WITH {q.ARCHIVE} SELECT source_era AS era, count(*) AS n FROM arch GROUP BY 1")
def era_counts(spark, d):
    return archive(spark, d).groupBy(F.col("source_era").alias("era")).agg(F.count("*").alias("n"))


@query(f"""WITH e AS (SELECT DISTINCT lower(trim(incident_uid)) AS u, lower(trim(change_type)) AS k FROM changelog WHERE coalesce(event_source, '') <> 'reconciliation' AND NOT coalesce(cosmetic, false)
  AND observed_date BETWEEN DATE '{TODAY}' - 7 AND DATE '{TODAY}' AND observed_date > DATE '{STARTED}')
  SELECT count(*) FILTER (k = 'added') AS added, count(*) FILTER (k = 'amended') AS amended, count(*) FILTER (k = 'withdrawn') AS withdrawn, count(*) FILTER (k = 'source_removed') AS aged_out FROM e""")
def activity_window(spark, d):
    return derive.activity(table(spark, d, "changelog"), STARTED, TODAY)


@query(f"""WITH {q.DERIVED}, y AS (SELECT *, coalesce(TRY_CAST(nullif(regexp_extract(month, '(20\\d{{2}})', 1), '') AS INT), 2026) AS expected, TRY_CAST(rep_value[1:4] AS INT) AS year, [c for c, i in supcats if NOT list_contains(cats, c) AND list_position(supcats, c) = i] AS was, [c for c, i in cats if list_position(cats, c) = i] AS once FROM der)
  SELECT 'invalid_dates' AS "check", uid, occ_raw AS detail FROM y WHERE occ_precision = 'invalid'
  UNION ALL SELECT 'imprecise_occurred', uid, occ_precision FROM y WHERE occ_precision IN ('day', 'month', 'year', 'unknown', 'range_start')
  UNION ALL SELECT 'near_duplicates', uid, '' FROM y WHERE list_contains(flags, 'near_duplicate')
  UNION ALL SELECT 'duplicate_candidates', uid, coalesce(month, '') FROM y WHERE list_contains(flags, 'possible_duplicate_identity')
  UNION ALL SELECT 'unclassified_offenses', uid, array_to_string(unclassified, '|') FROM y WHERE len(unclassified) > 0
  UNION ALL SELECT 'unclassified_dispositions', uid, array_to_string(unclassified_d, '|') FROM y WHERE len(unclassified_d) > 0
  UNION ALL SELECT 'reclassified', uid, array_to_string(was, '|') || '>' || array_to_string(once, '|') FROM y WHERE len(was) > 0
  UNION ALL SELECT 'year_warnings', uid, rep_raw || ' reads as ' || year || ', its log is of ' || expected FROM y WHERE rep_precision NOT IN ('unknown', 'invalid') AND abs(year - expected) > 1
  UNION ALL SELECT 'occurred_after_reported', uid, CAST(CAST(lag AS DECIMAL(18, 2)) AS VARCHAR) FROM y WHERE lag < 0""")
def quality_audit(spark, d):
    return derive.quality_audit(derived(spark, d), 2026)


@query(f"WITH {q.DERIVED} SELECT count(*) AS incidents, count(*) FILTER (list_contains(dflags, 'detained')) AS arrests, count(*) FILTER (list_contains(dflags, 'open')) AS open, count(*) FILTER (revision > 1) AS amended, count(*) FILTER (status NOT IN ('active', 'missing', 'superseded')) AS gone FROM counted WHERE month_key IS NOT NULL")
def stat_tiles(spark, d):
    return derive.stat_tiles(derive.in_scope(derived(spark, d), None, occurrence=False))


@query(f"WITH {q.DERIVED}, v AS (SELECT location AS value, count(*) AS n, min(uid) AS first FROM counted WHERE month_key IS NOT NULL AND location <> '' GROUP BY 1) SELECT value, n FROM v ORDER BY n DESC, first, value LIMIT 15")
def top_locations(spark, d):
    scoped = derive.in_scope(derived(spark, d), None, occurrence=False)
    return derive.top_values(derive.count_values(scoped, F.col("location")), 15).select("value", "n")


_TOP = "c AS (SELECT uid, month_key AS month, unnest(list_distinct(cats)) AS cat FROM counted WHERE month_key IS NOT NULL), top AS (SELECT cat FROM (SELECT cat, count(*) AS n, min(uid) AS first FROM c GROUP BY 1) ORDER BY n DESC, first, cat LIMIT {n})"


@query(f"""WITH {q.DERIVED}, {_TOP.format(n=7)}, tops AS (SELECT list(cat) AS t FROM top)
  SELECT month_key AS month, coalesce([x for x in cats if list_contains(t, x)][1], 'Other') AS category, count(*) AS n FROM counted, tops WHERE month_key IS NOT NULL GROUP BY 1, 2""")
def topk_pivot_other(spark, d):
    return derive.month_pivot_long(derive.in_scope(derived(spark, d), None, occurrence=False))


@query(f"WITH {q.DERIVED}, {_TOP.format(n=12)}, m AS (SELECT DISTINCT month_key AS month FROM counted WHERE month_key IS NOT NULL) SELECT m.month, top.cat AS category, count(c.uid) AS n FROM m CROSS JOIN top LEFT JOIN c ON c.month = m.month AND c.cat = top.cat GROUP BY 1, 2")
def category_trend(spark, d):
    return derive.category_trend(derive.in_scope(derived(spark, d), None, occurrence=False))


@query(f"WITH {q.DERIVED} SELECT uid, coalesce(rep_value, '') AS sort_key, status FROM der WHERE contains(lower(coalesce(narrative_raw, '') || ' ' || coalesce(case_number_raw, '') || ' ' || coalesce(location, '') || ' ' || coalesce(nature_raw, '') || ' ' || coalesce(disposition_raw, '')), 'vehicle') AND list_contains(agencies, 'CSA') AND status = 'active'")
def table_search_sort(spark, d):
    return derive.search(derived(spark, d), agency="CSA", status="active", term=" Vehicle").select("uid", "sort_key", "status")


@query("SELECT log_pos, lower(trim(change_type)) AS kind FROM changelog WHERE lower(trim(change_type)) <> 'added' AND NOT coalesce(cosmetic, false) ORDER BY log_pos DESC LIMIT 300")
def change_feed(spark, d):
    return derive.change_feed(table(spark, d, "changelog")).select("log_pos", F.lower(F.trim("change_type")).alias("kind"))


@query(f"WITH {q.ARCHIVE} SELECT log_pos FROM changelog WHERE lower(trim(incident_uid)) IN (SELECT lower(trim(incident_uid)) FROM arch WHERE source_era = 'sheet-2026')")
def shown_events(spark, d):
    shown = archive(spark, d).filter("source_era = 'sheet-2026'")
    return derive.shown_events(table(spark, d, "changelog"), shown, "incident_uid").select("log_pos")


@query(f"WITH {q.ARCHIVE} SELECT incident_uid AS uid, list_contains(string_split(coalesce(flags, ''), ';'), 'possible_duplicate_identity') AS in_question FROM arch WHERE status = 'withdrawn'")
def findings_split(spark, d):
    return derive.findings(archive(spark, d).select(F.col("incident_uid").alias("uid"), "status", F.split(text("flags"), ";").alias("flags")))


@query(f"WITH {q.DERIVED} SELECT DISTINCT school_year AS year FROM counted WHERE school_year IS NOT NULL AND school_year[1:4] || '-08' >= '2020-06'")
def offered_years(spark, d):
    return derive.offered_years(derived(spark, d), "2020-06")


@query(f"""WITH {q.DERIVED}, m AS (SELECT DISTINCT school_year AS year, (CAST(month_key[6:7] AS INT) + 4) % 12 AS p FROM counted WHERE school_year IS NOT NULL), i AS (SELECT *, p - row_number() OVER (PARTITION BY year ORDER BY p) AS island FROM m),
  r AS (SELECT year, min(p) AS a, max(p) AS z FROM i GROUP BY year, island), t AS (SELECT year, a, ['Aug', 'Sep', 'Oct', 'Nov', 'Dec', 'Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul'] AS n, z FROM r)
  SELECT year, CASE WHEN max(z - a) = 11 THEN 'all 12 months' ELSE string_agg(n[a + 1] || CASE WHEN z > a THEN '–' || n[z + 1] ELSE '' END, ', ' ORDER BY a) END AS covered FROM t GROUP BY year""")
def coverage_labels(spark, d):
    return derive.coverage(derived(spark, d))


@query(f"SELECT date_diff('day', max(observed_date), DATE '{TODAY}') AS staleness_days FROM changelog")
def staleness(spark, d):
    return derive.staleness_days(_runs(spark, d), TODAY).select(F.col("staleness_days").cast("bigint").alias("staleness_days"))


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Run records as the change log tells of them: one a day, with an alarm for each kind of removal."""
    kind = F.lower(F.trim("change_type"))
    days = table(spark, d, "changelog").groupBy(F.col("observed_date").alias("date")).agg(F.count("*").cast("int").alias("archive_rows"), F.array_sort(F.collect_set(F.when(kind.isin("withdrawn", "source_removed"), kind))).alias("alarms"))
    return days.filter("date IS NOT NULL").withColumn("summary", F.format_string("%d events", "archive_rows"))


_RUNS = "runs AS (SELECT observed_date AS date, count(*) AS archive_rows, count(DISTINCT CASE WHEN lower(trim(change_type)) IN ('withdrawn', 'source_removed') THEN lower(trim(change_type)) END) AS alarms FROM changelog WHERE observed_date IS NOT NULL GROUP BY 1)"


@query(f"WITH {_RUNS} SELECT date, archive_rows || ' events' AS summary, CAST(alarms AS INTEGER) AS alarms FROM runs")
def run_history(spark, d):
    return derive.run_history(_runs(spark, d))


_ACTIVITY = f"""e AS (SELECT DISTINCT lower(trim(incident_uid)) AS u, lower(trim(change_type)) AS k FROM changelog WHERE coalesce(event_source, '') <> 'reconciliation' AND NOT coalesce(cosmetic, false)
  AND observed_date BETWEEN DATE '{TODAY}' - 7 AND DATE '{TODAY}' AND observed_date > DATE '{STARTED}'), act AS (SELECT count(*) FILTER (k = 'added') AS added, count(*) FILTER (k = 'amended') AS amended, count(*) FILTER (k = 'withdrawn') AS withdrawn, count(*) FILTER (k = 'source_removed') AS aged_out FROM e)"""
_COUNTS = """(SELECT count(*) AS total_archived, count(*) FILTER (status IN ('active', 'missing')) AS currently_published, count(*) FILTER (status NOT IN ('active', 'missing', 'superseded')) AS no_longer_published,
  count(*) FILTER (status = 'superseded') AS superseded, count(*) FILTER (status <> 'superseded') AS distinct_incidents, count(*) FILTER (status = 'withdrawn') AS withdrawn_now, count(*) FILTER (status = 'source_removed') AS source_removed FROM arch)"""


@query(f"""WITH {q.ARCHIVE}, {_ACTIVITY}, {_RUNS} SELECT act.*, 7 AS window_days, strftime(DATE '{TODAY}' - 7, '%Y-%m-%d') AS since, '{TODAY}' AS until, (SELECT count(*) FROM runs WHERE date BETWEEN DATE '{TODAY}' - 7 AND DATE '{TODAY}') AS runs_in_window,
  (SELECT count(*) FROM runs) AS checked_total, (SELECT CAST(date_diff('day', max(date), DATE '{TODAY}') AS INTEGER) FROM runs) AS staleness_days, c.* FROM act, {_COUNTS} c""")
def status_document(spark, d):
    """The status document: activity, runs and counts, one row."""
    doc = derive.status_document(archive(spark, d), table(spark, d, "changelog"), _runs(spark, d), STARTED, TODAY)
    return doc.select("activity.*", *[F.col(f"counts.{c}").alias("withdrawn_now" if c == "withdrawn" else c) for c in doc.schema["counts"].dataType.names])


@query(f"WITH {q.DERIVED} SELECT uid, strftime(try_strptime(month_key || '-01', '%Y-%m-%d'), '%B %Y') AS label FROM der")
def month_labels(spark, d):
    return derived(spark, d).select("uid", dates.month_label(F.col("month_key")).alias("label"))


@query(f"""WITH {q.DERIVED}, m AS (SELECT month_key AS month, count(*) AS n FROM counted WHERE month_key IS NOT NULL GROUP BY 1), s AS (SELECT *, pow(10, floor(log10(n))) AS p FROM m)
  SELECT month, n, list_min([x * p for x in [1.0, 1.2, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0] if n <= x * p]) AS ceiling FROM s""")
def axis_ceilings(spark, d):
    months = derive.counted(derived(spark, d)).filter("month_key IS NOT NULL").groupBy(F.col("month_key").alias("month")).agg(F.count("*").alias("n"))
    return months.withColumn("ceiling", dates.nice_ceiling(F.col("n").cast("double")))


# ---- change data ----


@query("""SELECT k.snapshot_date, k.snapshot_seq, k.uid FROM (SELECT snapshot_date, snapshot_seq, lower(trim(incident_uid)) AS uid, h, lag(h) OVER w AS before, row_number() OVER w AS nth
  FROM (SELECT snapshot_date, snapshot_seq, incident_uid, h FROM (SELECT snapshot_date, snapshot_seq, lower(trim(incident_uid)) AS incident_uid, coalesce(lower(trim(content_hash)), '') AS h, row_number() OVER (PARTITION BY snapshot_date, snapshot_seq, lower(trim(incident_uid)) ORDER BY source_row_index DESC) AS r FROM incident_snapshots) WHERE r = 1)
  WINDOW w AS (PARTITION BY incident_uid ORDER BY snapshot_date, snapshot_seq)) k WHERE nth = 1 OR h <> before""")
def snapshot_change_only(spark, d):
    """Copies of a record whose content differs from the copy before; one row a record and snapshot is kept first."""
    s = table(spark, d, "incident_snapshots").select("snapshot_date", "snapshot_seq", clean_key("incident_uid").alias("uid"), F.struct("source_row_index", F.coalesce(F.lower(F.trim("content_hash")), F.lit("")).alias("h")).alias("v"))
    one = s.filter("uid IS NOT NULL").groupBy("snapshot_date", "snapshot_seq", "uid").agg(F.max("v").alias("v")).select("snapshot_date", "snapshot_seq", "uid", F.col("v.h").alias("h"))
    return ladders.changed_only(one, ["uid"], ["snapshot_date", "snapshot_seq"], "h").select("snapshot_date", "snapshot_seq", "uid")


@query("""SELECT min(log_pos) AS log_pos FROM changelog GROUP BY observed_date, run_seq, incident_uid, change_type, field_name, old_value, new_value, cosmetic, revision, case_number, date_reported, nature, source_file_id, from_file_id, to_file_id,
  missing_since, was_missing_since, confirmations, previous_status, last_known_disposition, superseded_by, possible_replacement, source_month, removal_mechanism, event_source, capture_timestamp""")
def changelog_dedupe(spark, d):
    return ladders.distinct_events(table(spark, d, "changelog"), "log_pos").select("log_pos")


@query("""WITH s AS (SELECT DISTINCT snapshot_date, snapshot_seq FROM incident_snapshots), n AS (SELECT *, row_number() OVER (ORDER BY snapshot_date, snapshot_seq) AS k FROM s),
  p AS (SELECT lower(trim(incident_uid)) AS uid, n.k, max(CASE WHEN lower(trim(status)) IN ('active', 'superseded') THEN 1 ELSE 0 END) AS p FROM incident_snapshots JOIN n USING (snapshot_date, snapshot_seq) WHERE trim(incident_uid) <> '' GROUP BY 1, 2),
  i AS (SELECT *, sum(p) OVER (PARTITION BY uid ORDER BY k) AS island FROM p)
  SELECT uid, min(k) AS since, max(k) AS until, count(*) AS confirmations, count(*) >= 3 AS withdrawn FROM i WHERE p = 0 GROUP BY uid, island""")
def absence_ladder(spark, d):
    s = table(spark, d, "incident_snapshots").select("snapshot_date", "snapshot_seq", clean_key("incident_uid").alias("uid"), F.lower(F.trim("status")).isin("active", "superseded").alias("present")).filter("uid IS NOT NULL")
    number = s.select("snapshot_date", "snapshot_seq").distinct().withColumn("k", F.row_number().over(Window.orderBy("snapshot_date", "snapshot_seq")).cast("bigint"))
    return ladders.absence_runs(s.join(number, ["snapshot_date", "snapshot_seq"]), "uid", "k", "present")


@query(f"WITH {q.ARCHIVE} SELECT source_file_id, count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT source_month) FILTER (status IN ('active', 'missing', 'withdrawn') AND coalesce(source_month, '') <> '')), ', '), '') AS months FROM arch GROUP BY 1")
def rows_by_file(spark, d):
    return ladders.rows_by_file(archive(spark, d))


@query(f"""WITH {q.ARCHIVE}, n AS (SELECT source_file_id, count(*) AS n FROM arch GROUP BY 1), f AS (SELECT s.source_file_id, coalesce(status = 'active', false) AS fetched, coalesce(absent_count, 0) AS c, coalesce(n, 0) AS n FROM source_files s LEFT JOIN n USING (source_file_id)),
  a AS (SELECT *, CASE WHEN fetched THEN 0 WHEN n = 0 THEN c ELSE c + 1 END AS absent_count FROM f)
  SELECT source_file_id, CASE WHEN fetched THEN 'active' WHEN n = 0 THEN 'pending' WHEN absent_count >= 3 THEN 'removed' ELSE 'unfetched' END AS state, absent_count FROM a""")
def file_ladder(spark, d):
    f = table(spark, d, "source_files").select("source_file_id", F.coalesce(F.col("status") == "active", F.lit(False)).alias("fetched"), "absent_count", F.lit(None).cast("date").alias("last_absent_date"))
    return ladders.step_file_ladder(f, ladders.rows_by_file(archive(spark, d)), TODAY).select("source_file_id", "state", "absent_count")


@query(f"SELECT source_file_id, last_verified IS NULL OR date_diff('day', last_verified, DATE '{TODAY}') >= 7 AS due FROM source_files")
def census_due(spark, d):
    f = table(spark, d, "source_files").select("source_file_id", F.lit(False).alias("changed"), F.col("last_verified").alias("last_tab_census"))
    return ladders.census_due(f, TODAY)


@query("""SELECT coalesce(p.i, o.i) AS source_file_id, CASE WHEN p.i IS NULL THEN 'only_discovered' WHEN o.i IS NULL THEN 'only_pinned' ELSE 'both' END AS named_in
  FROM (SELECT DISTINCT source_file_id AS i FROM source_files) p FULL JOIN (SELECT DISTINCT source_file_id AS i FROM incidents) o ON p.i = o.i""")
def target_files(spark, d):
    return ladders.target_files(table(spark, d, "source_files"), incidents(spark, d))


@query("""WITH b AS (SELECT DISTINCT lower(trim(incident_uid)) AS u FROM incident_snapshots WHERE snapshot_date < (SELECT max(snapshot_date) FROM incident_snapshots)), a AS (SELECT DISTINCT lower(trim(incident_uid)) AS u FROM incident_snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM incident_snapshots))
  SELECT u AS uid FROM b WHERE u NOT IN (SELECT u FROM a WHERE u IS NOT NULL) AND u <> ''""")
def lost_entries(spark, d):
    s = table(spark, d, "incident_snapshots").select("snapshot_date", clean_key("incident_uid").alias("uid")).filter("uid IS NOT NULL")
    last = s.agg(F.max("snapshot_date")).first()[0]
    return ladders.lost_entries(s.filter(F.col("snapshot_date") < F.lit(last)).select("uid").distinct(), s.filter(F.col("snapshot_date") == F.lit(last)).select("uid").distinct(), ["uid"])


def respelled(spark: SparkSession, d: str) -> DataFrame:
    """The archive, and every record once more under another spelling of its identity, which its uid decides on."""
    a = archive(spark, d).select("incident_uid", "case_number_raw", "date_reported_raw", "nature_raw", "location_raw", "source_month", "source_era", "status", "flags", "last_verified", "superseded_by")
    h, cn = F.lower(F.right(F.trim("incident_uid"), F.lit(1))), text("case_number_raw")
    case = F.when(h < "4", F.concat(cn, F.lit("/ CSA 90001"))).when(h < "8", F.lower(cn)).when(h < "b", F.regexp_replace(cn, r"(\d)$", "$10")).otherwise(F.concat(F.lit("GEN 77"), F.right(cn, F.lit(3))))
    return a.unionByName(a.withColumns({"incident_uid": F.concat("incident_uid", F.lit("-2")), "case_number_raw": case, "date_reported_raw": F.when(h == "f", F.concat(text("date_reported_raw"), F.lit(" 0:01"))).otherwise(F.col("date_reported_raw"))}))


_RESPELLED = f"""{q.ARCHIVE}, h AS (SELECT *, lower(right(trim(incident_uid, ' '), 1)) AS h, coalesce(case_number_raw, '') AS cn0 FROM arch),
resp AS (SELECT incident_uid, case_number_raw, date_reported_raw, nature_raw, location_raw, source_month, source_era, status, flags, last_verified FROM arch
  UNION ALL SELECT incident_uid || '-2', CASE WHEN h < '4' THEN cn0 || '/ CSA 90001' WHEN h < '8' THEN lower(cn0) WHEN h < 'b' THEN regexp_replace(cn0, '(\\d)$', '\\10') ELSE 'GEN 77' || right(cn0, 3) END,
    CASE WHEN h = 'f' THEN coalesce(date_reported_raw, '') || ' 0:01' ELSE date_reported_raw END, nature_raw, location_raw, source_month, source_era, status, flags, last_verified FROM h)"""
_RECONCILED = f"""{_RESPELLED}, r AS (SELECT incident_uid, case_number_raw, coalesce(case_number_raw, '') AS cn, coalesce(date_reported_raw, '') AS dr, coalesce(source_month, '') AS m, regexp_extract(coalesce(case_number_raw, ''), '\\b(\\d{{2}}-\\d{{5,6}})\\b', 1) AS core,
    coalesce(nullif(regexp_extract(trim(coalesce(date_reported_raw, ''), ' '), '^(\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}})', 1), ''), trim(coalesce(date_reported_raw, ''), ' ')) AS d, flags, last_verified FROM resp WHERE status <> 'superseded' AND source_era = 'legacy-page'),
  w AS (SELECT *, first_value({{'u': incident_uid, 'cn': cn, 'dr': dr}}) OVER (PARTITION BY m, core, d ORDER BY length(cn) DESC, length(dr) DESC, incident_uid DESC) AS h FROM r WHERE core <> ''),
  rec AS (SELECT * FROM w WHERE h.u <> incident_uid AND (starts_with(h.cn, cn) OR starts_with(h.dr, dr)))"""


@query(f"WITH {_RECONCILED} SELECT incident_uid, h.u AS superseded_by FROM rec")
def legacy_reconcile_prefix(spark, d):
    return legacy.reconcile_extended(respelled(spark, d))


@query(f"""WITH {_RECONCILED} SELECT incident_uid, h.u AS superseded_by, array_to_string(list_sort(list_distinct([x for x in string_split(coalesce(flags, '') || ';superseded_identity', ';') if x NOT IN ('', 'absent_in_later_capture')])), ';') AS flags,
  last_verified AS observed_date, case_number_raw AS old_value, h.cn AS new_value FROM rec""")
def legacy_reconciled_rows(spark, d):
    rows, events = legacy.apply_reconciliation(respelled(spark, d))
    told = events.select(F.col("incident_uid").alias("u"), "observed_date", "old_value", F.coalesce("new_value", F.lit("")).alias("new_value"))
    return rows.join(told, F.col("incident_uid") == F.col("u")).select("incident_uid", "superseded_by", "flags", "observed_date", "old_value", "new_value")


@query(f"""WITH {_RESPELLED}, r AS (SELECT incident_uid AS u, coalesce(source_month, '') AS m, {q.reported('date_reported_raw')} AS rep, lower(trim(coalesce(nature_raw, ''), ' ')) AS nat, lower(trim(coalesce(location_raw, ''), ' ')) AS loc, upper(trim(coalesce(case_number_raw, ''), ' ')) AS cn FROM resp WHERE status <> 'superseded'),
  g AS (SELECT *, regexp_replace(cn, '\\D', '', 'g') AS dig FROM r)
  SELECT a.u AS incident_uid, count(*) AS with_n FROM g a JOIN g b ON a.m = b.m AND a.rep = b.rep AND a.nat = b.nat AND a.loc = b.loc AND a.u <> b.u
  WHERE a.cn = b.cn OR contains(a.cn, b.cn) OR contains(b.cn, a.cn) OR ((contains(a.dig, b.dig) OR contains(b.dig, a.dig)) AND abs(length(a.dig) - length(b.dig)) <= 2 AND a.dig <> '' AND b.dig <> '') GROUP BY 1""")
def duplicate_candidates(spark, d):
    return legacy.duplicate_candidates(respelled(spark, d))


@query("""SELECT row_id, array_to_string([regexp_replace(coalesce(x, ''), '[\\t\\r\\n]+', ' ', 'g') for x in [incident_uid, case_number_raw, nature_raw, disposition_raw]], chr(9)) AS tsv,
  array_to_string([CASE WHEN regexp_matches(coalesce(x, ''), '[",\\r\\n]') THEN '"' || replace(x, '"', '""') || '"' ELSE coalesce(x, '') END for x in [incident_uid, case_number_raw, nature_raw, disposition_raw]], ',') AS csv FROM incidents""")
def export_lines(spark, d):
    i = incidents(spark, d)
    columns = ["incident_uid", "case_number_raw", "nature_raw", "disposition_raw"]
    keyed = i.select(F.col("row_id").cast("string").alias("k"), *columns)
    a, b = export.tsv_lines(keyed), export.csv_lines(keyed)
    cut = lambda df, mark, name: df.select(F.split_part("line", F.lit(mark), F.lit(1)).cast("bigint").alias("row_id"), F.expr(f"substring(line, locate('{mark}', line) + 1)").alias(name))
    return cut(a, "\t", "tsv").join(cut(b, ",", "csv"), "row_id")


@query("SELECT snapshot_date, snapshot_seq, count(*) AS n FROM (SELECT DISTINCT snapshot_date, snapshot_seq, lower(trim(incident_uid)) AS u FROM incident_snapshots WHERE trim(incident_uid) <> '') GROUP BY 1, 2")
def snapshot_sizes(spark, d):
    s = table(spark, d, "incident_snapshots").select("snapshot_date", "snapshot_seq", clean_key("incident_uid").alias("u")).filter("u IS NOT NULL").distinct()
    return s.groupBy("snapshot_date", "snapshot_seq").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT source_file_id, snapshot_date AS date, snapshot_seq AS seq, md5(source_row_index || '|' || coalesce(lower(trim(incident_uid)), '')) AS h FROM incident_snapshots WHERE source_file_id IS NOT NULL),
  s AS (SELECT source_file_id, date, seq, sum(CAST(concat('0x', h[1:12]) AS BIGINT)) || '-' || sum(CAST(concat('0x', h[13:24]) AS BIGINT)) || '-' || count(*) AS sha FROM r GROUP BY 1, 2, 3),
  w AS (SELECT *, lag(sha) OVER (PARTITION BY source_file_id ORDER BY date, seq) AS before, row_number() OVER (PARTITION BY source_file_id ORDER BY date, seq) AS nth FROM s)
  SELECT source_file_id, date, seq, sha AS sha256 FROM w WHERE nth = 1 OR sha <> before""")
def snapshot_append(spark, d):
    """Snapshots of each file that the snapshot writer would add to an empty index; content is told by sums of its rows' hashes (decimals, as a bigint holds those of some 65,000 rows), so no file's rows are gathered."""
    h = F.md5(F.concat(F.col("source_row_index").cast("string"), F.lit("|"), F.coalesce(F.lower(F.trim("incident_uid")), F.lit(""))).cast("binary"))
    part = lambda at: F.sum(F.conv(F.substring(h, at, 12), 16, 10).cast("bigint").cast("decimal(20,0)")).cast("string")
    s = table(spark, d, "incident_snapshots").filter("source_file_id IS NOT NULL").groupBy("source_file_id", F.col("snapshot_date").alias("date"), F.col("snapshot_seq").alias("seq"))
    landed = s.agg(F.concat_ws("-", part(1), part(13), F.count("*").cast("string")).alias("sha256"), F.count("*").alias("bytes"))
    empty = spark.createDataFrame([], landed.schema)
    return archive_sink.append_snapshots(empty, landed).select("source_file_id", "date", "seq", "sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
