"""The derived view of the archive and the marts on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import dates, tokens
from daybook.operators.merge import STILL_PUBLISHED

# Least sample of a median, days of the activity window, tops of the overview.
LEAST_SAMPLE = 20
ACTIVITY_DAYS = 7
TOP_PIVOT, TOP_TREND = 7, 12
FEED_ROWS, QUALITY_ROWS = 300, 40


def current_rows(incidents: DataFrame) -> DataFrame:
    """One row a record: of repeated ones the latest revision, then the largest row_id."""
    newest = Window.partitionBy("incident_uid").orderBy(F.col("revision").desc_nulls_last(), F.col("row_id").desc_nulls_last())
    return incidents.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def derive(archive: DataFrame, categories: Column, dispositions: Column, campuses: Column, window_start: str = dates.WINDOW_START) -> DataFrame:
    """The derived incident of each archive row."""
    d = archive.withColumns({"reported": dates.partial_date(F.col("date_reported_raw")), "occurred": dates.partial_date(F.col("date_occurred_raw"))})
    d = d.withColumns({"nature": tokens.categorize(F.col("nature_raw"), categories), "disposition": tokens.disposition_flags(F.col("disposition_raw"), dispositions)})
    key, bin_ = dates.month_key(F.col("source_month")), dates.occurred_bin(F.col("occurred"), window_start)
    d = d.withColumns({"month_key": key, "bin": bin_})
    return d.select(
        F.col("incident_uid").alias("uid"), F.col("case_number_raw").alias("case_number"), tokens.agencies(F.col("case_number_raw")).alias("agencies"), "reported", "occurred",
        dates.lag_hours(F.col("reported"), F.col("occurred")).alias("reporting_lag_hours"), "nature_raw", "nature.categories", "nature.reclassified_from", "nature.was_reclassified", "nature.unclassified",
        F.col("disposition.unclassified").alias("unclassified_disposition"), F.col("narrative_raw").alias("narrative"), tokens.campus_name(F.col("campus_raw"), campuses).alias("campus"), "campus_raw",
        F.col("source_era").alias("era"), F.col("location_raw").alias("location"), "disposition_raw", F.col("disposition.flags").alias("disposition_flags"), "disposition.disposition_amended",
        F.col("source_month").alias("month"), "month_key", dates.school_year(F.col("month_key")).alias("school_year"), dates.month_label(F.col("bin.key")).alias("occurred_month"),
        F.col("bin.key").alias("occurred_month_key"), dates.school_year(F.col("bin.key")).alias("occurred_school_year"), F.col("bin.reason").alias("occurred_excluded"), "status",
        F.coalesce("revision", F.lit(1)).alias("revision"), "first_seen_by_archive", "last_verified", "missing_since", tokens.split_flags(F.translate(F.coalesce("flags", F.lit("")), ";", "|")).alias("flags"),
    )


def published(derived: DataFrame, era: str | None) -> DataFrame:
    return derived.filter(F.col("era") == era) if era else derived


def shown_events(events: DataFrame, shown: DataFrame, uid: str = "uid") -> DataFrame:
    """Events of shown records only."""
    return events.join(shown.select(F.col(uid).alias("_uid")).distinct(), F.lower(F.trim(F.col("incident_uid"))) == F.lower(F.trim(F.col("_uid"))), "left_semi")


def counted(derived: DataFrame) -> DataFrame:
    """Everything that counts as an incident: a superseded row is one with its replacement."""
    return derived.filter("status <> 'superseded'")


def count_values(rows: DataFrame, value: Column, explode: bool = False) -> DataFrame:
    """value, n and first (the smallest uid) of a column or of the entries of an array; nulls and empty values left out."""
    values = rows.select("uid", (F.explode(value) if explode else value).alias("value"))
    return values.filter("value IS NOT NULL AND value <> ''").groupBy("value").agg(F.count("*").alias("n"), F.min("uid").alias("first"))


def top_values(counted_values: DataFrame, n: int) -> DataFrame:
    """The n most frequent values; ties by first appearance."""
    return counted_values.orderBy(F.desc("n"), "first", "value").limit(n)


def _entry_of(facet: str):
    return lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value"))


def facets(derived: DataFrame) -> DataFrame:
    """facet, value, n: the eight filter vocabularies; statuses over all rows, the others over counted ones."""
    c = counted(derived)
    parts = [
        ("categories", c, "categories", True), ("school_years", c, "school_year", False), ("campuses", c, "campus", False), ("months", c, "month", False),
        ("locations", c, "location", False), ("disposition_flags", c, "disposition_flags", True), ("agencies", c, "agencies", True), ("statuses", derived, "status", False),
    ]
    # One pass over the rows: every facet's values become entries of one array.
    is_counted = F.col("status") != "superseded"
    entries = []
    for name, _, column, many in parts:
        values = F.coalesce(F.col(column), F.array().cast("array<string>")) if many else F.array(F.col(column))
        listed = F.transform(values, _entry_of(name))
        entries.append(listed if name == "statuses" else F.when(is_counted, listed).otherwise(F.slice(listed, 1, 0)))
    flat = derived.select("uid", F.inline(F.flatten(F.array(*entries)))).filter("value IS NOT NULL AND value <> ''")
    return flat.groupBy("facet", "value").agg(F.count("*").alias("n"), F.min("uid").alias("first"))


def school_years(derived: DataFrame, year: str = "school_year", month: str = "month_key") -> DataFrame:
    """School years under one binning: year, incidents, months_covered, months, complete, eras."""
    g = counted(derived).filter(F.col(year).isNotNull()).groupBy(F.col(year).alias("year"))
    months = F.array_sort(F.collect_set(month))
    out = g.agg(F.count("*").alias("incidents"), months.alias("m"), F.array_join(F.array_sort(F.collect_set("era")), ",").alias("eras"))
    return out.select("year", "incidents", F.size("m").cast("bigint").alias("months_covered"), F.array_join("m", ",").alias("months"), (F.size("m") == 12).alias("complete"), "eras")


def lag_medians(derived: DataFrame, least: int = LEAST_SAMPLE) -> DataFrame:
    """Median days from occurrence to report by agency, for agencies with ``least`` reports or more."""
    lags = counted(derived).filter("reporting_lag_hours >= 0").select(F.explode("agencies").alias("agency"), "reporting_lag_hours")
    out = lags.groupBy("agency").agg(F.count("*").alias("n"), F.median("reporting_lag_hours").alias("m")).filter(F.col("n") >= least)
    return out.select("agency", "n", F.round(F.col("m") / 24, 1).alias("median_days"))


def binning(derived: DataFrame) -> DataFrame:
    """What binning by occurrence shows and leaves out; total is always the sum of the others."""
    return counted(derived).agg(
        F.count("*").alias("total"), F.count_if(F.col("occurred_month_key").isNotNull()).alias("shown"),
        F.count_if(F.col("occurred_excluded") == "no_date").alias("excluded_no_date"), F.count_if(F.col("occurred_excluded") == "before_window").alias("excluded_before_window"),
    )


def status_counts(derived: DataFrame) -> DataFrame:
    s = F.col("status")
    return derived.agg(
        F.count("*").alias("total_archived"), F.count_if(s.isin(*STILL_PUBLISHED)).alias("currently_published"), F.count_if(~s.isin(*STILL_PUBLISHED, "superseded")).alias("no_longer_published"),
        F.count_if(s == "superseded").alias("superseded"), F.count_if(s != "superseded").alias("distinct_incidents"), F.count_if(s == "withdrawn").alias("withdrawn"), F.count_if(s == "source_removed").alias("source_removed"),
    )


def activity(events: DataFrame, archive_started: str, today: str, days: int = ACTIVITY_DAYS) -> DataFrame:
    """Distinct records by kind of change in the last days (both ends included).

    Reconciliations, cosmetic edits and the opening capture don't count.
    """
    day = F.lit(today).cast("date")
    kind = F.lower(F.trim(F.col("change_type")))
    live = events.filter((F.coalesce("event_source", F.lit("")) != "reconciliation") & ~F.coalesce("cosmetic", F.lit(False)) & F.col("observed_date").between(F.date_sub(day, days), day) & (F.col("observed_date") > F.lit(archive_started).cast("date")))
    uid = F.lower(F.trim(F.col("incident_uid")))
    pairs = live.select(uid.alias("uid"), kind.alias("kind")).filter("uid <> ''").distinct()
    names = {"added": "added", "amended": "amended", "withdrawn": "withdrawn", "source_removed": "aged_out"}
    return pairs.agg(*[F.count_if(F.col("kind") == k).alias(n) for k, n in names.items()])


def status_document(archive: DataFrame, events: DataFrame, runs: DataFrame, archive_started: str, today: str, days: int = ACTIVITY_DAYS) -> DataFrame:
    """The status document, one row of activity (with its window, the runs and the days since the last one) and counts; written by ``write_json``."""
    day = F.lit(today).cast("date")
    seen = runs.agg(F.count_if(F.col("date").between(F.date_sub(day, days), day)).alias("runs_in_window"), F.count("*").alias("checked_total"))
    one = activity(events, archive_started, today, days).withColumns({"window_days": F.lit(days), "since": F.date_format(F.date_sub(day, days), "yyyy-MM-dd"), "until": F.lit(today)})
    both = one.join(F.broadcast(seen)).join(F.broadcast(staleness_days(runs, today)))  # a row each
    counts = status_counts(archive)
    return both.select(F.struct("*").alias("activity")).join(F.broadcast(counts.select(F.struct("*").alias("counts"))))


def staleness_days(runs: DataFrame, today: str) -> DataFrame:
    """Days since the last run that wrote an archive."""
    return runs.agg(F.datediff(F.lit(today).cast("date"), F.max(F.when(F.col("archive_rows").isNotNull(), F.col("date")))).alias("staleness_days"))


def run_history(runs: DataFrame) -> DataFrame:
    return runs.select("date", F.coalesce("summary", F.lit("")).alias("summary"), F.size(F.coalesce("alarms", F.array().cast("array<string>"))).alias("alarms"))


def quality_audit(derived: DataFrame, fallback_year: int) -> DataFrame:
    """check, uid, detail: the nine lists of what an editor should look at, found in one pass."""
    join = lambda c: F.array_join(c, "|")
    occurred = F.col("occurred.precision")
    warning = dates.year_warning(F.col("reported"), F.coalesce(dates.label_year(F.col("month")), F.lit(fallback_year)))
    checks = [
        ("invalid_dates", occurred == "invalid", F.col("occurred.raw")),
        ("imprecise_occurred", occurred.isin("day", "month", "year", "unknown", "range_start"), occurred),
        ("reclassified", F.size("reclassified_from") > 0, F.concat(join(F.col("reclassified_from")), F.lit(">"), join(F.col("categories")))),
        ("near_duplicates", F.array_contains("flags", "near_duplicate"), F.lit("")),
        ("duplicate_candidates", F.array_contains("flags", "possible_duplicate_identity"), F.coalesce("month", F.lit(""))),
        ("unclassified_offenses", F.size("unclassified") > 0, join(F.col("unclassified"))),
        ("unclassified_dispositions", F.size("unclassified_disposition") > 0, join(F.col("unclassified_disposition"))),
        ("year_warnings", warning.isNotNull(), warning),
        ("occurred_after_reported", F.col("reporting_lag_hours") < 0, F.col("reporting_lag_hours").cast("decimal(18,2)").cast("string")),
    ]
    rows = F.filter(F.array(*[F.when(when, F.struct(F.lit(name).alias("check"), detail.alias("detail"))) for name, when, detail in checks]), lambda r: r.isNotNull())
    return derived.select("uid", F.inline(rows))


def first_of_each_check(audit: DataFrame, most: int = QUALITY_ROWS) -> DataFrame:
    """The first ``most`` rows of each check by uid, as a page lists them."""
    nth = F.row_number().over(Window.partitionBy("check").orderBy("uid", "detail"))
    return audit.withColumn("nth", nth).filter(F.col("nth") <= most).drop("nth")


def in_scope(derived: DataFrame, scope: str | None, occurrence: bool) -> DataFrame:
    """Counted rows with a bin, of one school year where ``scope`` names it: adds bin."""
    key, year = ("occurred_month_key", "occurred_school_year") if occurrence else ("month_key", "school_year")
    rows = counted(derived).withColumn("bin", F.col(key)).filter("bin IS NOT NULL")
    return rows.filter(F.col(year) == scope) if scope else rows


def stat_tiles(scoped: DataFrame) -> DataFrame:
    flag = lambda f: F.count_if(F.array_contains("disposition_flags", f))
    return scoped.agg(F.count("*").alias("incidents"), flag("detained").alias("arrests"), flag("open").alias("open"), F.count_if(F.col("revision") > 1).alias("amended"), F.count_if(~F.col("status").isin(*STILL_PUBLISHED, "superseded")).alias("gone"))


def _top_array(scoped: DataFrame, n: int) -> list[str]:
    return [r["value"] for r in top_values(count_values(scoped, F.col("categories"), explode=True), n).collect()]


def month_pivot(scoped: DataFrame, n: int = TOP_PIVOT) -> DataFrame:
    """Month by category: each incident once, under its first category among the top ``n``, else Other; plus total."""
    top = _top_array(scoped, n)
    among = F.array(*[F.lit(t) for t in top]).cast("array<string>")
    primary = F.coalesce(F.try_element_at(F.filter("categories", lambda c: F.array_contains(among, c)), F.lit(1)), F.lit("Other"))
    pivot = scoped.select("bin", primary.alias("primary")).groupBy("bin").pivot("primary", [*top, "Other"]).count().fillna(0)
    names = [*top, "Other"]
    return pivot.withColumn("total", sum((F.col(f"`{c}`") for c in names), F.lit(0)).cast("bigint")).withColumnRenamed("bin", "month")


def month_pivot_long(scoped: DataFrame, n: int = TOP_PIVOT) -> DataFrame:
    """The same as month, category, n: rows of zero are left out."""
    top = F.array(*[F.lit(t) for t in _top_array(scoped, n)]).cast("array<string>")
    primary = F.coalesce(F.try_element_at(F.filter("categories", lambda c: F.array_contains(top, c)), F.lit(1)), F.lit("Other"))
    return scoped.groupBy(F.col("bin").alias("month"), primary.alias("category")).agg(F.count("*").alias("n"))


def category_trend(scoped: DataFrame, n: int = TOP_TREND) -> DataFrame:
    """category, month, n of the top categories, with zeros; an incident counts under each of its categories."""
    top = F.array(*[F.lit(t) for t in _top_array(scoped, n)]).cast("array<string>")
    months = scoped.select(F.col("bin").alias("month")).distinct()
    grid = months.select("month", F.explode(top).alias("category"))
    found = scoped.select("bin", F.explode("categories").alias("category")).groupBy(F.col("bin").alias("month"), "category").agg(F.count("*").alias("n"))
    return grid.join(found, ["month", "category"], "left").fillna(0, ["n"])


def search(derived: DataFrame, month: str | None = None, category: str | None = None, campus: str | None = None, agency: str | None = None, status: str | None = None, term: str | None = None, sort: str = "reported", descending: bool = True, limit: int | None = None) -> DataFrame:
    """The table: rows that meet all filters, sorted by a column as text, ties by uid."""
    rows = derived
    for column, value in (("month", month), ("campus", campus), ("status", status)):
        rows = rows.filter(F.col(column) == value) if value else rows
    for column, value in (("categories", category), ("agencies", agency)):
        rows = rows.filter(F.array_contains(column, value)) if value else rows
    if term and term.strip():
        rows = rows.filter(tokens.text_search(term, *[F.col(c) for c in ("narrative", "case_number", "location", "nature_raw", "disposition_raw")]))
    by = F.coalesce(F.col("reported.value") if sort == "reported" else F.col(sort).cast("string"), F.lit(""))
    rows = rows.withColumn("sort_key", by).orderBy(F.desc("sort_key") if descending else F.asc("sort_key"), "uid")
    return rows.limit(limit) if limit else rows


def change_feed(events: DataFrame, most: int = FEED_ROWS) -> DataFrame:
    """The newest changes that are neither additions nor cosmetic."""
    kind = F.lower(F.trim(F.col("change_type")))
    return events.filter((kind != "added") & ~F.coalesce("cosmetic", F.lit(False))).orderBy(F.desc("log_pos")).limit(most)


def findings(derived: DataFrame) -> DataFrame:
    """Withdrawn records: uid and whether a possible second identity explains it."""
    return derived.filter("status = 'withdrawn'").select("uid", F.array_contains("flags", "possible_duplicate_identity").alias("in_question"))


def offered_years(derived: DataFrame, window_start: str = dates.WINDOW_START) -> DataFrame:
    """School years that began inside the published window."""
    years = counted(derived).select(F.col("school_year").alias("year")).filter("year IS NOT NULL").distinct()
    return years.filter(F.concat(F.substring("year", 1, 4), F.lit("-08")) >= window_start)


def coverage(derived: DataFrame) -> DataFrame:
    """year and the label of the months it covers."""
    g = counted(derived).filter("school_year IS NOT NULL").groupBy(F.col("school_year").alias("year")).agg(F.collect_set("month_key").alias("m"))
    return g.select("year", dates.coverage_label(F.col("m"), chronological=False).alias("covered"))
