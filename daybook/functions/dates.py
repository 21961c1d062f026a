"""Partial dates, months and years as column expressions.

Nothing here throws on impossible dates, whatever ``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First month shown by occurrence; earlier ones are counted apart.
WINDOW_START = "2026-06"
#: First month of a school year.
SCHOOL_YEAR_START = 8

_DAY = r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$"
_MINUTE = r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2}) (\d{1,2}):(\d{1,2})$"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _date(month: Column, day: Column, year: Column) -> Column:
    """The date of three texts of digits; two-digit years from 69 on are 19xx; null where it doesn't exist."""
    number = year.try_cast("int")
    full = F.when(F.length(year) > 2, number).when(number >= 69, number + 1900).otherwise(number + 2000)
    return F.try_to_date(F.concat_ws("-", F.lpad(full.cast("string"), 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def strict_date(text: Column) -> Column:
    """``M/d/yy`` or ``M/d/yyyy`` as a date, else null."""
    return F.when(text.rlike(_DAY), let(F.split(text, "/"), lambda p: _date(p[0], p[1], p[2])))


def strict_minute(text: Column) -> Column:
    """``M/d/yy H:m`` or ``M/d/yyyy H:m`` as a timestamp without zone, else null."""

    def of(p: Column) -> Column:
        time = F.concat_ws(":", F.lpad(p[3], 2, "0"), F.lpad(p[4], 2, "0"), F.lit("00"))
        valid = p[3].try_cast("int").between(0, 23) & p[4].try_cast("int").between(0, 59)
        return F.when(valid, F.concat_ws(" ", _date(p[0], p[1], p[2]).cast("string"), time).try_cast("timestamp_ntz"))

    return F.when(text.rlike(_MINUTE), let(F.split(text, "[/ :]"), of))


def partial_date(raw: Column) -> Column:
    """A date with the precision it was written in: struct(value, precision, raw, ongoing, range_end).

    precision is minute, day, month, year, range_start, invalid or unknown.
    "since" and a span make it ongoing; only a minute or a day then becomes
    range_start, and the end of a span is kept with a minute only.
    """
    given = F.trim(F.coalesce(raw, F.lit("")))
    text = F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?U)\s+", " "))

    def spans(t: Column) -> Column:
        ends = F.split(F.trim(F.regexp_replace(t, r"(?i)^since\s+", "")), r"(?i)\s+to\s+", 2)
        return let(F.struct(ends.alias("ends"), t.rlike(r"(?i)^since\b").alias("since")), starts)

    def starts(s: Column) -> Column:
        start = F.trim(F.regexp_replace(F.trim(s["ends"][0]), r"(?i)\s*\b(?:unk\.?|unknown)\s*$", ""))
        parts = F.struct(start.alias("start"), strict_minute(start).alias("minute"), strict_date(start).alias("day"), (s["since"] | (F.size(s["ends"]) == 2)).alias("ongoing"), F.try_element_at(s["ends"], F.lit(2)).alias("end"))
        return let(parts, built)

    def built(p: Column) -> Column:
        start, to_day = p["start"], F.when(p["ongoing"], "range_start")
        month, year = start.rlike(r"^\d{1,2}/\d{4}$"), start.rlike(r"^\d{4}$")
        value = F.coalesce(
            F.date_format(p["minute"], "yyyy-MM-dd'T'HH:mm:ss"),
            F.date_format(p["day"], "yyyy-MM-dd"),
            F.when(month, F.concat(F.split_part(start, F.lit("/"), F.lit(2)), F.lit("-"), F.lpad(F.split_part(start, F.lit("/"), F.lit(1)), 2, "0"))),
            F.when(year, start),
        )
        precision = (
            F.when(p["minute"].isNotNull(), F.coalesce(to_day, F.lit("minute")))
            .when(p["day"].isNotNull(), F.coalesce(to_day, F.lit("day")))
            .when(month, "month")
            .when(year, "year")
            .when(start.rlike(r"^\d{1,2}/\d{1,2}/\d{2,4}"), "invalid")
            .otherwise("unknown")
        )
        end = F.when(p["minute"].isNotNull(), F.trim(p["end"]))
        return F.struct(value.alias("value"), precision.alias("precision"), given.alias("raw"), p["ongoing"].alias("ongoing"), end.alias("range_end"))

    return let(text, spans)


def year_warning(date: Column, expected: Column) -> Column:
    """A text where a date's year is more than one off ``expected``, else null."""
    year = F.substring(date["value"], 1, 4).try_cast("int")
    off = date["value"].isNotNull() & ~date["precision"].isin("unknown", "invalid") & (F.abs(year - expected) > 1)
    return F.when(off, F.format_string("%s reads as %d, its log is of %d", date["raw"], year, expected))


def lag_hours(reported: Column, occurred: Column) -> Column:
    """Hours from occurrence to report, both known to the minute; else null."""
    exact = (reported["precision"] == "minute") & (occurred["precision"] == "minute")
    seconds = lambda d: F.unix_micros(F.to_timestamp(F.concat(d["value"], F.lit("Z")))) / 1_000_000
    return F.when(exact, F.round((seconds(reported) - seconds(occurred)) / 3600, 2))


def month_key(label: Column) -> Column:
    """``YYYY-MM`` of itself or of a label like "September 2026"; else null."""
    text = F.trim(label)
    named = F.when(text.rlike(r"^[A-Z][a-z]+ \d{4}$"), F.try_to_timestamp(F.concat(F.lit("1 "), text), F.lit("d MMMM yyyy")))
    return F.when(text.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), text).otherwise(F.date_format(named, "yyyy-MM"))


def month_label(key: Column) -> Column:
    """"September 2026" of ``2026-09``; null for anything but a month."""
    return F.when(key.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.date_format(F.try_to_timestamp(F.concat(key, F.lit("-01")), F.lit("yyyy-MM-dd")), "MMMM yyyy"))


def occurred_bin(date: Column, window_start: str = WINDOW_START) -> Column:
    """struct(key, reason): the month of a partial date, or why it has none (no_date, before_window)."""
    key = F.when(date["value"].rlike(r"^\d{4}-\d{2}"), F.substring(date["value"], 1, 7))
    early = key < window_start
    return F.struct(F.when(~early, key).alias("key"), F.when(key.isNull(), "no_date").when(early, "before_window").alias("reason"))


def school_year(key: Column, start: int = SCHOOL_YEAR_START) -> Column:
    """"2026-27" of a month between August 2026 and July 2027."""
    year = F.substring(key, 1, 4).try_cast("int") - F.when(F.substring(key, 6, 2).try_cast("int") < start, 1).otherwise(0)
    return F.when(key.rlike(r"^\d{4}-\d{2}$"), F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0")))


def label_year(label: Column) -> Column:
    """The year in a month label, null where there is none."""
    return F.nullif(F.regexp_extract(label, r"(20\d{2})", 1), F.lit("")).try_cast("int")


def capture_date(stamp: Column) -> Column:
    """The date of a 14-digit capture stamp."""
    return F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd")


# Readable ends of an axis within a power of ten.
AXIS_STEPS = (1.0, 1.2, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0)


def nice_ceiling(most: Column) -> Column:
    """The end of an axis: the least readable number that is no less than ``most`` (which is above 0)."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(most)))
    steps = F.filter(F.array(*[F.lit(s) for s in AXIS_STEPS]), lambda s: most <= s * power)
    return F.coalesce(F.array_min(steps), F.lit(10.0)) * power


def coverage_label(months: Column, chronological: bool) -> Column:
    """Months (``yyyy-MM`` array) as ranges of month names, in the order of the school year or of the calendar.

    "none" without months, "all 12 months" for a whole school year.
    """
    year, month = (lambda m: F.substring(m, 1, 4).cast("int")), (lambda m: F.substring(m, 6, 2).cast("int"))
    place = (lambda m: year(m) * 12 + month(m)) if chronological else (lambda m: F.pmod(month(m) - SCHOOL_YEAR_START, F.lit(12)))
    names = F.array(*[F.lit(n) for n in "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()])
    ordered = F.array_sort(F.transform(F.array_distinct(months), lambda m: F.struct(place(m).alias("p"), F.element_at(names, month(m)).alias("n"))))
    runs = F.aggregate(
        ordered,
        F.array().cast("array<struct<a:string,z:string,p:int>>"),
        lambda runs, m: F.when(
            F.try_element_at(runs, F.lit(-1))["p"] == m["p"] - 1,
            F.concat(F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(runs, F.lit(-1))["a"].alias("a"), m["n"].alias("z"), m["p"].cast("int").alias("p")))),
        ).otherwise(F.concat(runs, F.array(F.struct(m["n"].alias("a"), m["n"].alias("z"), m["p"].cast("int").alias("p"))))),
    )
    text = F.array_join(F.transform(runs, lambda r: F.when(r["a"] == r["z"], r["a"]).otherwise(F.concat(r["a"], F.lit("–"), r["z"]))), ", ")
    whole = F.lit("all 12 months")
    out = F.when(F.size(ordered) == 0, "none")
    return (out if chronological else out.when(F.size(ordered) == 12, whole)).otherwise(text)
