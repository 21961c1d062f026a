"""Reconciling records of the older, irregularly captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.identity import canonical_reported
from daybook.operators.merge import EVENT_COLUMNS

# The first reference number by which a record of a month is grouped, the day in a reported time, the era.
CORE = r"\b(\d{2}-\d{5,6})\b"
DAY = r"^(\d{1,2}/\d{1,2}/\d{2,4})"
ERA = "legacy-page"
#: Length of the pieces by which texts that hold one another are brought together.
PIECE = 4


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def reconcile_extended(archive: DataFrame, era: str | None = ERA) -> DataFrame:
    """Records superseded by a longer spelling of themselves: incident_uid, superseded_by.

    Grouped by month, first reference number and reported day.  The longest
    (case number, then reported time; ties: the largest uid) holds; another is
    superseded if the holder's case number or reported time starts with its own.
    Superseded rows and those of another era don't take part (``era`` None: all).
    """
    stamp = F.trim(_text("date_reported_raw"))
    day = F.coalesce(F.nullif(F.regexp_extract(stamp, DAY, 1), F.lit("")), stamp)
    rows = archive.filter("status <> 'superseded'")
    rows = rows.filter(F.col("source_era") == era) if era else rows
    rows = rows.select("incident_uid", _text("case_number_raw").alias("cn"), _text("date_reported_raw").alias("dr"), F.regexp_extract(_text("case_number_raw"), CORE, 1).alias("core"), _text("source_month").alias("month"), day.alias("day")).filter("core <> ''")
    key = ["month", "core", "day"]
    # The holder of a group is an aggregate; its rows are never brought into one order.
    rank = F.struct(F.length("cn").alias("a"), F.length("dr").alias("b"), F.col("incident_uid").alias("uid"), "cn", "dr")
    holders = rows.groupBy(*key).agg(F.max(rank).alias("holder"))
    found = rows.join(holders, key).filter(F.col("holder.uid") != F.col("incident_uid"))
    extends = F.startswith(F.col("holder.cn"), F.col("cn")) | F.startswith(F.col("holder.dr"), F.col("dr"))
    return found.filter(extends).select("incident_uid", F.col("holder.uid").alias("superseded_by"))


def apply_reconciliation(archive: DataFrame, era: str | None = ERA) -> tuple[DataFrame, DataFrame]:
    """The archive with its extended records superseded, and the events of that.

    Status, pointer and flags change; ``absent_in_later_capture`` goes, as the
    absence is explained.  An event is dated by the row's last verification.
    """
    found = reconcile_extended(archive, era).select(F.col("incident_uid").alias("_uid"), F.col("superseded_by").alias("_by"))
    j = archive.join(found, F.col("incident_uid") == F.col("_uid"), "left").withColumn("_is", F.col("_uid").isNotNull())
    kept = F.filter(F.split(_text("flags"), ";"), lambda f: (f != "") & (f != "absent_in_later_capture"))
    flags = F.array_join(F.array_sort(F.array_distinct(F.concat(kept, F.array(F.lit("superseded_identity"))))), ";")
    rows = j.withColumns({"status": F.when(F.col("_is"), "superseded").otherwise(F.col("status")), "superseded_by": F.when(F.col("_is"), F.col("_by")).otherwise(F.col("superseded_by")), "flags": F.when(F.col("_is"), flags).otherwise(F.col("flags"))})
    numbers = archive.select(F.col("incident_uid").alias("_new"), F.col("case_number_raw").alias("_case"))
    e = j.filter("_is").join(numbers, F.col("_by") == F.col("_new"))
    given = {
        "observed_date": F.col("last_verified"), "run_seq": F.lit(0), "incident_uid": F.col("incident_uid"), "change_type": F.lit("superseded_identity"), "superseded_by": F.col("_by"),
        "old_value": F.col("case_number_raw"), "new_value": F.col("_case"), "case_number": F.col("case_number_raw"), "event_source": F.lit("reconciliation"),
    }
    events = e.select(*[given.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in EVENT_COLUMNS])
    return rows.select(*archive.columns), events


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def duplicate_candidates(archive: DataFrame) -> DataFrame:
    """Records that may be one incident written twice: incident_uid and with_n, the number of other records.

    Same month, canonical reported time, nature and location, and case numbers
    of which one holds the other or whose digits are nested and differ in
    length by at most two, letter case apart throughout.  Records with the same
    case number count each other without being paired, so a repeated record
    never makes all pairs of its copies; differing case numbers meet only where
    the end of one is a piece of the other, so records that agree in blank
    fields don't make all pairs either.
    """
    key = ["month", "reported", "nature", "location"]
    rows = archive.filter("status <> 'superseded'").select(
        "incident_uid",
        _text("source_month").alias("month"),
        canonical_reported(F.col("date_reported_raw")).alias("reported"),
        F.lower(F.trim(_text("nature_raw"))).alias("nature"),
        F.lower(F.trim(_text("location_raw"))).alias("location"),
        F.upper(F.trim(_text("case_number_raw"))).alias("cn"),
    )
    spelled = rows.groupBy(*key, "cn").agg(F.count_distinct("incident_uid").alias("n"))
    # A case number held by another, or its digits, is looked for by its last piece among all pieces of the other.
    groups = spelled.groupBy(*key).agg(F.count("*").alias("spellings")).filter("spellings > 1").drop("spellings")
    met = spelled.join(groups, key, "left_semi").withColumn("digits", _digits(F.col("cn")))
    pieces = lambda c, n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n))))
    cn, digits = F.col("cn"), F.col("digits")
    told = lambda tag, c: F.transform(c, lambda x: F.concat(F.lit(tag), x))
    short = [pieces(cn, k) for k in range(1, PIECE + 1)]
    parts = [told("n", F.coalesce(p, F.array().cast("array<string>"))) for p in short]
    nested_digits = [F.coalesce(pieces_of, F.array().cast("array<string>")) for pieces_of in (F.array(digits), *[F.when(F.length(digits) > k, F.transform(F.sequence(F.lit(1), F.lit(k + 1)), lambda i, k=k: F.substring(digits, i, F.length(digits) - k))) for k in (1, 2)])]
    holds = met.select(*key, "cn", "digits", F.explode(F.array_distinct(F.concat(F.array(F.lit("n")), *parts, *[told("d", p) for p in nested_digits]))).alias("tag"))
    ends = F.array(F.concat(F.lit("n"), F.right(cn, F.lit(PIECE))), F.when(digits != "", F.concat(F.lit("d"), digits)))
    held = met.select(*key, "cn", "digits", "n", F.explode(F.array_compact(ends)).alias("tag"))
    x, y = holds.alias("x"), held.alias("y")
    near = (F.col("y.digits") != "") & F.contains(F.col("x.digits"), F.col("y.digits")) & (F.length("x.digits") - F.length("y.digits") <= 2)
    pairs = x.join(y, [F.col(f"x.{k}") == F.col(f"y.{k}") for k in [*key, "tag"]]).filter((F.col("x.cn") != F.col("y.cn")) & (F.contains(F.col("x.cn"), F.col("y.cn")) | near))
    pairs = pairs.select(*[F.col(f"x.{k}").alias(k) for k in key], F.col("x.cn").alias("a"), F.col("y.cn").alias("b")).distinct()
    both = pairs.select(*key, F.inline(F.array(F.struct(F.col("a").alias("cn"), F.col("b").alias("other")), F.struct(F.col("b").alias("cn"), F.col("a").alias("other"))))).distinct()
    counts = spelled.select(*[F.col(k).alias(f"s_{k}") for k in key], F.col("cn").alias("s_cn"), "n")
    others = both.join(counts, [F.col(k) == F.col(f"s_{k}") for k in key] + [F.col("other") == F.col("s_cn")]).groupBy(*key, "cn").agg(F.sum("n").alias("others"))
    counted = rows.join(spelled, [*key, "cn"]).join(others, [*key, "cn"], "left")
    with_n = F.col("n") - 1 + F.coalesce("others", F.lit(0))
    return counted.groupBy("incident_uid").agg(F.max(with_n).alias("with_n")).filter("with_n > 0")


def flag_duplicate_candidates(archive: DataFrame) -> DataFrame:
    """The archive with ``possible_duplicate_identity`` on every duplicate candidate."""
    found = duplicate_candidates(archive).select(F.col("incident_uid").alias("_uid"))
    flags = F.array_join(F.array_sort(F.array_distinct(F.filter(F.concat(F.split(_text("flags"), ";"), F.array(F.lit("possible_duplicate_identity"))), lambda f: f != ""))), ";")
    return archive.join(found, F.col("incident_uid") == F.col("_uid"), "left").withColumn("flags", F.when(F.col("_uid").isNotNull(), flags).otherwise(F.col("flags"))).select(*archive.columns)


def order_captures(captures: DataFrame) -> DataFrame:
    """Captures of all months in one order of time: month, stamp."""
    return captures.select("month", "stamp").orderBy("stamp", "month")
