"""Identity and hashing of records as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.dates import strict_date, strict_minute

#: The eight verbatim fields of a record and their names in a source sheet, in hashing order.
FIELDS = {
    "case_number_raw": "Case Number",
    "date_reported_raw": "Date/Time Reported",
    "date_occurred_raw": "Date/Time Occurred",
    "nature_raw": "Nature",
    "narrative_raw": "Incident Narrative",
    "campus_raw": "Campus",
    "location_raw": "Location",
    "disposition_raw": "Disposition",
}
# Separator of hashed fields, pattern of a reference number and of an inline amendment.
UNIT_SEPARATOR = "\x1f"
REFERENCE = r"\b(?:\d{2}-\d{5,7}|\d{4,6})\b"
AMENDMENT = r"(?is)^(.*?)\b(?:nature|disposition)\s+updated\b"


def collapse(text: Column) -> Column:
    """Runs of blanks (no-break spaces too) as one space, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def normalize_case_number(raw: Column) -> Column:
    """Blanks collapsed and upper case; punctuation and order stay."""
    return F.upper(collapse(raw))


def canonical_reported(raw: Column) -> Column:
    """One spelling for equal reported times: to the minute, else the day, else the collapsed text."""
    text = collapse(raw)
    return F.coalesce(F.date_format(strict_minute(text), "yyyy-MM-dd'T'HH:mm"), F.date_format(strict_date(text), "yyyy-MM-dd"), text)


def canonical_occurred(raw: Column) -> Column:
    """Like :func:`canonical_reported` for both ends of a span; "since" stays, "unknown" at the end goes."""
    text = collapse(raw)
    since = text.rlike(r"(?i)^since\b")
    ends = F.split(F.regexp_replace(text, r"(?i)^since\s+", ""), r"(?i)\s+to\s+")

    def one(part: Column) -> Column:
        bare = F.trim(F.regexp_replace(part, r"(?i)\s*\b(?:unk\.?|unknown)\s*$", ""))
        return canonical_reported(bare)

    return F.concat(F.when(since, "since ").otherwise(""), F.array_join(F.transform(ends, one), " to "))


def incident_uid(case_number: Column, reported: Column) -> Column:
    """The lasting identity: 16 hexadecimal digits over the case number and the canonical reported time."""
    return F.substring(F.sha1(F.concat_ws(UNIT_SEPARATOR, normalize_case_number(case_number), canonical_reported(reported)).cast("binary")), 1, 16)


def content_hash(*fields: Column) -> Column:
    """SHA-256 over the verbatim fields; nulls count as empty."""
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *[F.coalesce(f, F.lit("")) for f in fields]).cast("binary"), 256)


def is_cosmetic(field: Column, old: Column, new: Column) -> Column:
    """Whether a date field was only spelled anew."""
    reported = canonical_reported(old) == canonical_reported(new)
    occurred = canonical_occurred(old) == canonical_occurred(new)
    return F.when(field == "date_reported_raw", reported).when(field == "date_occurred_raw", occurred).otherwise(False)


def case_references(case_number: Column) -> Column:
    """Sorted distinct reference numbers in a case number."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(case_number, F.lit("")), F.lit(REFERENCE), 0)))


def amendment_of(new: Column) -> Column:
    """The value that ``new`` writes an amendment of into the value itself; null where it is no amendment."""
    new = F.coalesce(new, F.lit(""))
    kept = F.trim(F.btrim(F.trim(F.regexp_extract(new, AMENDMENT, 1)), F.lit(",;")))
    return F.when(new.rlike(AMENDMENT), kept)


def amends_inline(old: Column, new: Column) -> Column:
    """Whether ``new`` writes an amendment of ``old`` into the value itself."""
    return F.coalesce(amendment_of(new) == F.trim(F.coalesce(old, F.lit(""))), F.lit(False))


def strictly_within(a: Column, b: Column) -> Column:
    """Whether the set ``a`` is a proper subset of ``b``."""
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) > 0)


def is_renumbering(old: Column, new: Column) -> Column:
    """Whether reference set ``new`` can be ``old`` after an edit: both named, and nothing only dropped."""
    return (F.size(old) > 0) & (F.size(new) > 0) & ~strictly_within(new, old)


def corroborates(old: str, new: str, ignore_occurred: bool) -> Column:
    """Whether the records under the aliases ``old`` and ``new`` agree in the fields that have to."""
    same = lambda f: F.coalesce(F.col(f"{old}.{f}"), F.lit("")) == F.coalesce(F.col(f"{new}.{f}"), F.lit(""))
    nature = same("nature_raw") | amends_inline(F.col(f"{old}.nature_raw"), F.col(f"{new}.nature_raw"))
    agree = nature & same("campus_raw") & same("location_raw")
    return agree if ignore_occurred else agree & same("date_occurred_raw")
