"""Mixed timestamp formats and time zones (problem 1).

Every text value gets an array of all its valid interpretations (order of day
and month, unit of a bare number, earlier or later instant of a repeated wall
time), built from JVM expressions only.  One interpretation a value is then
chosen by the Viterbi algorithm over the record order of each source: changing
the format and going back in time cost, and so does departing from the stated
conventions (month first, earlier instant of a repeated hour).  A departure
costs less than order can save, so a convention gives way where both
neighbours speak against it.

A source may hold any part of all records.  The raw values are therefore
range-partitioned in (source, order) and read once behind that shuffle; each
task runs the algorithm on its own stretch, and only the cost matrices of
stretches that touch a task's border are put together (min-plus products are
associative), so the result is that of one pass over the whole source.  A value
with a single reading separates what comes before it from what comes after, so
only runs of ambiguous values and their neighbours are looked at one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from zoneinfo import available_timezones

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import bounded_rows, cut_lineage, settings

#: Cost of a change of format, and of a step back in time, between neighbours.
SWITCH_COST = 1.0
BACKWARD_COST = 1.0
#: Cost of departing from a stated convention.  One choice takes part in two transitions and can save
#: their sum, 4; so the order of records outweighs a convention where nearly all of it speaks against it.
CONVENTION_COST = 2.5

# Zone names that state their offset, in minutes, and names that only state the zone.
FIXED_ZONES = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}
NAMED_ZONES = {"ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles"}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Identifiers of the formats.
SLASH_MDY, SLASH_DMY, ISO, BASIC, DAY_MONTH, MONTH_DAY, EPOCH_S, EPOCH_MS, EPOCH_US = range(1, 10)

_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
#: pattern and its rewriting to year|month|day|rest, in order of trial.
_DATES = [
    (SLASH_MDY, rf"(?i)^{_WEEKDAY}(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}})(?:,\s*|\s+|t)(\d.*)$", "$3|$1|$2|$4"),
    (ISO, r"(?i)^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:,\s*|\s+|t)(\d.*)$", "$1|$2|$3|$4"),
    (BASIC, r"(?i)^(\d{4})(\d{2})(\d{2})(?:\s+|t)?(\d{2}):?(\d{2}):?(\d{2})((?:[.,]\d+)?(?:\s*[a-z+\-(\[].*)?)$", "$1|$2|$3|$4:$5:$6$7"),
    (BASIC, r"(?i)^(\d{4})(\d{2})(\d{2})(?:\s+|t)(\d{2}):?(\d{2})((?:\s*[a-z+\-(\[].*)?)$", "$1|$2|$3|$4:$5$6"),
    (DAY_MONTH, rf"(?i)^{_WEEKDAY}(\d{{1,2}})(?:st|nd|rd|th)?[-\s]+{_MONTH}[-,\s]+(\d{{4}}),?\s+(?:at\s+)?(\d.*)$", "$3|$2|$1|$4"),
    (MONTH_DAY, rf"(?i)^{_WEEKDAY}{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}),?\s+(?:at\s+)?(\d.*)$", "$3|$1|$2|$4"),
]
_ZONE = r"\s*\(?([a-z]{1,5}|(?:utc|gmt)?[+\-−]\d{1,2}(?::?\d{2})?)?\)?\s*(?:\[([a-z_]+(?:/[a-z_\-]+)*)\])?$"
#: pattern of the rest and its rewriting to hour|minute|second|fraction|half|zone|region.
_TIMES = [
    (rf"(?i)^(\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?(?:[.,](\d{{1,9}}))?\s*([ap])\.?\s?m\.?{_ZONE}", "$1|$2|$3|$4|$5|$6|$7"),
    (rf"(?i)^(\d{{1,2}})\s*([ap])\.?\s?m\.?{_ZONE}", "$1|00|||$2|$3|$4"),
    (rf"(?i)^(\d{{2}})(\d{{2}})\s*(?:hours|hour|hrs|hr|h)\.?{_ZONE}", "$1|$2||||$3|$4"),
    (rf"(?i)^(\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?(?:[.,](\d{{1,9}}))?(?:\s*(?:hours|hour|hrs|hr|h)\.?)?{_ZONE}", "$1|$2|$3|$4||$5|$6"),
]
_LEAD = r"(?i)^(?:(?:since|about|around|approximately|approx\.?|circa|ca\.?|on or about|on or around|between|from|near|~)\s*(?=[\s\d]|[a-z]{3}))+\s*"


def start_of_span(raw: Column) -> Column:
    """The part of a value that names its start: blanks made plain, words of approximation and the end of a span cut off."""
    text = F.trim(F.regexp_replace(raw, r"[\s   -​  　﻿]+", " "))
    between = text.rlike(r"(?i)^between\s")
    text = F.regexp_replace(text, _LEAD, "")
    text = F.when(between, F.regexp_replace(text, r"(?i)\s+and\s+.*$", "")).otherwise(text)
    return F.trim(F.regexp_replace(text, r"(?i)(?:\s+(?:to|until|till|through|thru)\s+|\s*[–—]\s*|\s+-\s+).*$", ""))


def known_zone(zone: Column) -> Column:
    """The IANA zone of that name, null where there is none."""
    known = ",".join(sorted(z for z in available_timezones() if "/" in z or z == "UTC"))
    return F.when(F.array_contains(F.split(F.lit(known), ","), zone), zone)


def _first(cases: list[tuple[Column, Column]]) -> Column:
    out = F.when(*cases[0])
    for when, then in cases[1:]:
        out = out.when(when, then)
    return out


def with_interpretations(df: DataFrame, raw: str, zone: str, out: str = "readings") -> DataFrame:
    """``df`` with all valid readings of column ``raw``: array of (departures, format, utc_micros).

    ``zone`` is the column with the IANA zone of values without zone; it has to
    be a known one or null (see :func:`known_zone`).
    ``departures`` counts the conventions a reading departs from (day first,
    later instant of a repeated wall time).  A value without a full date and
    clock time that exist, or without zone where ``zone`` is null or unknown,
    has no reading, like null and blank values.  Steps are separate columns so
    that each pattern is applied once a value; the session's zone plays no part.
    """
    i = lambda c: c.try_cast("int")
    text = F.col("_text")
    zones = F.create_map(*[F.lit(x) for k, v in FIXED_ZONES.items() for x in (k, v)])
    names = F.create_map(*[F.lit(x) for k, v in NAMED_ZONES.items() for x in (k, v)])
    number, length = text.try_cast("bigint"), F.length(text)
    unit = F.when(length == 10, EPOCH_S).when(length == 13, EPOCH_MS).when(length == 16, EPOCH_US)
    micros = number * F.when(length == 10, 1_000_000).when(length == 13, 1_000).when(length == 16, 1)
    epoch = F.when(text.rlike(r"^\d+$") & unit.isNotNull(), F.struct(F.lit(0).alias("departures"), unit.alias("format"), micros.alias("utc_micros")))
    parts = F.split(_first([(text.rlike(p), F.concat(F.lit(f"{fmt}|"), F.regexp_replace(text, p, to))) for fmt, p, to in _DATES]), r"\|", 5)
    df = df.withColumn("_text", start_of_span(F.col(raw))).withColumns({"_epoch": epoch, "_parts": parts})
    p = F.col("_parts")
    rest = p[4]
    clock = F.split(_first([(rest.rlike(pat), F.regexp_replace(rest, pat, to)) for pat, to in _TIMES]), r"\|", 7)
    df = df.withColumn("_clock", clock)
    c = F.col("_clock")
    half = F.lower(c[4])
    hour = i(c[0])
    hour = F.when(half == "", hour).when(~hour.between(1, 12), None).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.when(c[2] == "", 0).otherwise(i(c[2]))
    fraction = F.when(c[3] == "", 0).otherwise(i(F.substring(F.rpad(c[3], 6, "0"), 1, 6)))
    year = i(p[1]) + F.when(F.length(p[1]) == 2, 2000).otherwise(0)
    month = F.coalesce(i(p[2]), F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(p[2])).cast("int"))
    named = F.regexp_replace(F.regexp_replace(F.upper(c[5]), "−", "-"), "^(?:UTC|GMT)(?=[+-])", "")
    # One column a step: an expression named twice below would be worked out twice.
    df = df.withColumns({"_format": i(p[0]), "_hour": hour, "_minute": i(c[1]), "_second": second, "_fraction": fraction, "_year": year, "_month": month, "_day": i(p[3]), "_named": named, "_region": c[6]})
    h, m, s = F.col("_hour"), F.col("_minute"), F.col("_second")
    exists = h.between(0, 23) & m.between(0, 59) & s.between(0, 59)
    in_day = F.when(exists, (h.cast("long") * 3600 + m * 60 + s) * 1_000_000 + F.col("_fraction"))
    named = F.col("_named")
    signed = named.rlike(r"^[+-]")
    region = F.when(F.col("_region") != "", known_zone(F.col("_region")))
    wall_zone = F.when(named == "", F.when(F.col("_region") != "", region).otherwise(F.col(zone))).otherwise(F.try_element_at(names, named))
    df = df.withColumns({"_in_day": in_day, "_digits": F.when(signed, F.regexp_replace(named, "[+:-]", "")), "_zone": wall_zone})
    plain = F.when(F.length("_digits") <= 2, F.concat(F.lpad("_digits", 2, "0"), F.lit("00"))).otherwise(F.lpad("_digits", 4, "0"))
    df = df.withColumns({"_digits": plain})
    minutes = (i(F.substring("_digits", 1, 2)) * 60 + i(F.substring("_digits", 3, 2))) * F.when(F.startswith(named, F.lit("-")), -1).otherwise(1)
    df = df.withColumn("_minutes", minutes)
    offset = F.when(F.col("_digits").isNotNull(), F.when(F.abs("_minutes") <= 18 * 60, F.col("_minutes"))).otherwise(F.try_element_at(zones, named))
    df = df.withColumn("_offset", offset)

    def wall(month: Column, day: Column) -> Column:
        valid = F.col("_year").between(1900, 2199) & month.between(1, 12) & day.between(1, 31)
        last = F.when(month == 2, F.when((F.col("_year") % 4 == 0) & ((F.col("_year") % 100 != 0) | (F.col("_year") % 400 == 0)), 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
        return F.when(valid & (day <= last), F.unix_date(F.make_date(F.col("_year"), month, F.when(valid & (day <= last), day).otherwise(1))).cast("long") * 86_400_000_000 + F.col("_in_day"))

    slash = F.col("_format") == SLASH_MDY
    df = df.withColumns({"_wall0": wall(F.when(F.col("_month").between(1, 12), F.col("_month")).otherwise(1), F.when(F.col("_month").between(1, 12), F.col("_day"))),
                         "_wall1": F.when(slash & (F.col("_month") != F.col("_day")), wall(F.when(F.col("_day").between(1, 12), F.col("_day")).otherwise(1), F.when(F.col("_day").between(1, 12), F.col("_month"))))})
    here = F.col("_zone")
    to_utc = lambda w: F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(w), here))
    to_wall = lambda u: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(u), here))
    one = lambda departures, fmt, micros: F.struct(F.lit(departures).alias("departures"), fmt.alias("format"), micros.alias("utc_micros"))
    readings = []
    for k, fmt in ((0, F.col("_format")), (1, F.lit(SLASH_DMY))):
        w = F.col(f"_wall{k}")
        df = df.withColumn(f"_early{k}", to_utc(w))
        early = F.col(f"_early{k}")
        later = early + 3_600_000_000
        known_offset = F.col("_offset").isNotNull() & w.isNotNull()
        local = F.col("_offset").isNull() & here.isNotNull() & (to_wall(early) == w)
        readings += [
            F.when(known_offset, one(k, fmt, w - F.col("_offset").cast("long") * 60_000_000)),
            F.when(local, one(k, fmt, early)),
            F.when(local & (to_wall(later) == w), one(k + 1, fmt, later)),
        ]
    all_of = F.array_sort(F.filter(F.array(F.col("_epoch"), *readings), lambda r: r["utc_micros"].isNotNull()))
    made = [c for c in df.columns if c.startswith("_")]
    return df.withColumn(out, all_of).drop(*made)


Reading = tuple[float, int, int]


class _Chain:
    """Viterbi over a run of records of one source."""

    def __init__(self, switch: float, backward: float):
        self.switch, self.backward = switch, backward
        self.costs: list[float] = []
        self.last: list[Reading] = []
        self.back: list[list[int]] = []

    def add(self, readings: list[Reading], entry: int | None = None) -> None:
        """The next record; of a first one only reading ``entry`` where it is given."""
        if not self.last:
            self.costs = [r[0] if entry in (None, i) else float("inf") for i, r in enumerate(readings)]
            self.back.append([0] * len(readings))
        else:
            costs, back = [], []
            for cost, fmt, micros in readings:
                best, arg = None, 0
                for k, (_, f, m) in enumerate(self.last):
                    c = self.costs[k] + (self.switch if f != fmt else 0.0) + (self.backward if micros < m else 0.0)
                    if best is None or c < best:
                        best, arg = c, k
                costs.append(best + cost)
                back.append(arg)
            self.costs = costs
            self.back.append(back)
        self.last = readings

    def choices(self, end: int | None = None) -> list[int]:
        """The chosen reading of each record, ending in reading ``end`` or in the cheapest."""
        k = min(range(len(self.costs)), key=self.costs.__getitem__) if end is None else end
        out = []
        for back in reversed(self.back):
            out.append(k)
            k = back[k]
        return out[::-1]


class _Rows:
    """Rows of a batch that have readings, as arrays."""

    def __init__(self, batch: pa.RecordBatch, convention: float):
        columns = {name: batch.column(name) for name in batch.schema.names}
        lengths = np.asarray(columns["micros"].value_lengths().fill_null(0))
        if not lengths.all():
            batch = batch.filter(pa.array(lengths > 0))
            columns = {name: batch.column(name) for name in batch.schema.names}
            lengths = lengths[lengths > 0]
        self.n, self.lengths, self.columns = len(lengths), lengths, columns
        self.starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64) if self.n else np.zeros(0, np.int64)
        self.departures, self.formats, self.micros = (np.asarray(columns[c].flatten()) for c in ("departures", "format", "micros"))
        self.convention = convention
        if self.n:
            codes = [np.asarray(columns[c].dictionary_encode().indices) for c in ("source", "field")]
            self.opens = np.concatenate(([True], (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])))

    def series(self, k: int) -> tuple[str, str]:
        return self.columns["source"][k].as_py(), self.columns["field"][k].as_py()

    def readings(self, k: int) -> list[Reading]:
        span = slice(self.starts[k], self.starts[k] + self.lengths[k])
        return [(d * self.convention, f, m) for d, f, m in zip(self.departures[span].tolist(), self.formats[span].tolist(), self.micros[span].tolist(), strict=True)]


def _matrix(rows: list[list[Reading]], switch: float, backward: float) -> list[list[float]]:
    """Cheapest costs from each reading of the first row to each of the last."""
    out = []
    for entry in range(len(rows[0])):
        chain = _Chain(switch, backward)
        for k, readings in enumerate(rows):
            chain.add(readings, entry if k == 0 else None)
        out.append(chain.costs)
    return out


def _border_costs(switch: float, backward: float, convention: float):
    """Task: cost matrices of its first and its last stretch, from each first to each last reading.

    A row with a single reading cuts a stretch in two, so only the rows up to
    the first such row and from the last one on are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, head_open, tail, first_series, series, nth = None, [], True, [], None, None, 0
        for batch in batches:
            rows = _Rows(batch, convention)
            if not rows.n:
                continue
            if part is None:
                part, first_series = rows.columns["part"][0].as_py(), rows.series(0)
            else:
                rows.opens[0] = rows.series(0) != series
            opens = rows.opens.copy()
            if not head:
                opens[0] = False
            nth += int(opens.sum())
            if head_open:
                stops = np.flatnonzero(opens | (rows.lengths == 1))
                end = rows.n if not len(stops) else int(stops[0]) + (0 if opens[stops[0]] else 1)
                head += [rows.readings(k) for k in range(end)]
                head_open = not len(stops)
            resets = np.flatnonzero(rows.opens | (rows.lengths == 1))
            start = int(resets[-1]) if len(resets) else 0
            tail = ([] if len(resets) else tail) + [rows.readings(k) for k in range(start, rows.n)]
            series = rows.series(rows.n - 1)
        if part is None:
            return
        stretches = []
        if nth:
            stretches = [(0, False, first_series, head, _matrix(head, switch, backward)), (nth, True, series, tail, _matrix(tail, switch, backward))]
        elif head_open:
            stretches = [(0, True, first_series, head, _matrix(head, switch, backward))]
        else:
            left, right = _matrix(head, switch, backward), _matrix(tail, switch, backward)[0]
            stretches = [(0, True, first_series, [head[0], tail[-1]], [[row[0] + c for c in right] for row in left])]
        out = []
        for n, is_last, (source, field), span, costs in stretches:
            ends = {"first": span[0], "last": span[-1]}
            grid = {k: [[float(c), float(f)] for c, f, _ in v] for k, v in ends.items()} | {f"{k}_us": [m for _, _, m in v] for k, v in ends.items()}
            out.append({"part": part, "nth": n, "is_last": is_last, "source": source, "field": field, "costs": costs} | grid)
        yield pa.RecordBatch.from_pylist(out, schema=_BORDER_ARROW)

    return run


_BORDER = "part int, nth int, is_last boolean, source string, field string, first array<array<double>>, last array<array<double>>, costs array<array<double>>, first_us array<bigint>, last_us array<bigint>"
_GRID = pa.list_(pa.list_(pa.float64()))
_BORDER_ARROW = pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("is_last", pa.bool_()), ("source", pa.string()), ("field", pa.string()), ("first", _GRID), ("last", _GRID), ("costs", _GRID), ("first_us", pa.list_(pa.int64())), ("last_us", pa.list_(pa.int64()))])


def _border_choices(rows: list, switch: float, backward: float) -> dict[tuple[int, str, str], tuple[int | None, int | None]]:
    """The reading of a task's first and of its last row, where their series continues in another task, by Viterbi over whole stretches."""
    by_series: dict[tuple, list] = {}
    for r in rows:
        by_series.setdefault((r["source"], r["field"]), []).append(r)
    out = {}
    for (source, field), stretches in by_series.items():
        stretches.sort(key=lambda r: r["part"])
        if len(stretches) < 2:
            continue
        # best[j]: cheapest cost of ending the stretch in its last reading j; path: (first reading, last reading of the stretch before).
        best, paths, before = None, [], None
        for r in stretches:
            first, last = [(x[0], int(x[1]), u) for x, u in zip(r["first"], r["first_us"], strict=True)], [(x[0], int(x[1]), u) for x, u in zip(r["last"], r["last_us"], strict=True)]
            entry, come = [0.0] * len(first), [0] * len(first)
            if best is not None:
                for i, (_, f, m) in enumerate(first):
                    costs = [c + (switch if pf != f else 0.0) + (backward if m < pm else 0.0) for c, (_, pf, pm) in zip(best, before, strict=True)]
                    come[i] = min(range(len(costs)), key=costs.__getitem__)
                    entry[i] = costs[come[i]]
            new, path = [], []
            for j in range(len(last)):
                costs = [entry[i] + r["costs"][i][j] for i in range(len(first))]
                i = min(range(len(costs)), key=costs.__getitem__)
                new.append(costs[i])
                path.append((i, come[i]))
            best, before = new, last
            paths.append(path)
        j = min(range(len(best)), key=best.__getitem__)
        for r, path in zip(reversed(stretches), reversed(paths), strict=True):
            i, previous = path[j]
            out[r["part"], source, field] = (i if r["nth"] == 0 else None, j if r["is_last"] else None)
            j = previous
    return out


def _choices(borders: dict, switch: float, backward: float, convention: float):
    """Task: the chosen reading of every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is held back is the last row with a single reading (already put out) and the ambiguous rows after it.
        held: pa.RecordBatch | None = None
        done, begun = 0, False

        def work(batch: pa.RecordBatch, done: int, at_start: bool, at_end: bool) -> tuple[pa.RecordBatch, pa.RecordBatch | None, int]:
            rows = _Rows(batch, convention)
            picked = rows.starts.copy()
            open_end = rows.n
            if not at_end:
                resets = np.flatnonzero(rows.opens | (rows.lengths == 1)) if rows.n else []
                open_end = int(resets[-1]) if len(resets) else 0
                if len(resets) and rows.lengths[open_end] == 1:
                    open_end += 1
            unclear = rows.lengths[:open_end] > 1
            edges = np.flatnonzero(np.diff(np.concatenate(([False], unclear, [False])).astype(np.int8)))
            spans = []
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                cuts = [a, *(a + 1 + np.flatnonzero(rows.opens[a + 1 : b])).tolist(), b]
                spans += list(zip(cuts, cuts[1:], strict=False))
            for a, b in spans:
                chain, from_, entry, exit_ = _Chain(switch, backward), a, None, None
                if a and not rows.opens[a]:
                    from_ = a - 1
                if from_ == 0 and at_start or at_end and b == rows.n:
                    entry, exit_ = borders.get((rows.columns["part"][0].as_py(), *rows.series(a)), (None, None))
                    entry, exit_ = (entry if from_ == 0 and at_start else None), (exit_ if at_end and b == rows.n else None)
                to = b + 1 if b < rows.n and not rows.opens[b] else b
                for k in range(from_, to):
                    chain.add(rows.readings(k), entry if k == from_ else None)
                chosen = chain.choices(exit_)[a - from_ : b - from_]
                picked[a:b] += np.asarray(chosen, np.int64)
            least = np.minimum.reduceat(rows.departures, rows.starts) if rows.n else rows.departures
            take = slice(done, open_end)
            at = picked[take]
            columns = [rows.columns["record"].slice(done, max(open_end - done, 0)), rows.columns["field"].slice(done, max(open_end - done, 0)), rows.formats[at], rows.micros[at], rows.departures[at], least[take]]
            out = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _CHOSEN_ARROW, strict=True)], schema=_CHOSEN_ARROW)
            if at_end:
                return out, None, 0
            # The single row before the open rows stays as their neighbour.
            keep = open_end - 1 if open_end and rows.lengths[open_end - 1] == 1 else open_end
            rest = pa.RecordBatch.from_arrays([rows.columns[n].slice(keep) for n in batch.schema.names], schema=batch.schema)
            return out, rest, open_end - keep

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if held.num_rows + batch.num_rows else batch
            if not _Rows(batch, convention).n:
                continue
            out, held, done_next = work(batch, done, not begun, False)
            # As long as nothing was put out, the task's first row is still at the front.
            begun = begun or out.num_rows > 0
            done = done_next
            yield out
        if held is not None and held.num_rows:
            yield work(held, done, not begun, True)[0]

    return run


_CHOSEN = "record bigint, field string, format int, utc_micros bigint, departures int, least_departures int"
_CHOSEN_ARROW = pa.schema([("record", pa.int64()), ("field", pa.string()), ("format", pa.int32()), ("utc_micros", pa.int64()), ("departures", pa.int32()), ("least_departures", pa.int32())])


def resolve_timestamps(
    records: DataFrame,
    zones: DataFrame,
    fields: tuple[str, ...] = ("date_reported_raw", "date_occurred_raw"),
    record_id: str = "row_id",
    source: str = "source_file_id",
    order: str = "source_row_index",
    zone: str = "time_zone",
    switch_cost: float = SWITCH_COST,
    backward_cost: float = BACKWARD_COST,
    convention_cost: float = CONVENTION_COST,
) -> DataFrame:
    """The UTC instant of every value that names a day and a clock time.

    Returns record, field, format, utc_micros, departures (conventions the
    chosen reading departs from) and least_departures (those of the reading
    that departs least; above 0 the value has no conventional reading).  Values
    without any valid reading (null, blank, partial, impossible, skipped by a
    clock change) give no row.  A null source counts as a source of its own;
    ties of cost go to the reading with fewer departures, then the lower format
    and instant.  ``zones`` is the lookup of zones by source; it is checked to
    be small.
    """
    lookup = zones.select(F.col(source).alias("zone_of"), known_zone(F.col(zone)).alias("zone")).groupBy("zone_of").agg(F.max("zone").alias("zone"))
    small = lookup.limit(100_001).count() <= 100_000
    values = records.select(
        F.col(record_id).cast("bigint").alias("record"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.col(order).alias("place"),
        F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields])),
    )
    by = ["source", "field", "place", "record"]
    # The raw values are brought in order first: sampling them for the ranges costs a scan, and each is read once, behind the shuffle.
    values = values.filter(F.col("raw").rlike(r"\d")).repartitionByRange(*by).sortWithinPartitions(*by)
    values = values.join(F.broadcast(lookup), F.col("source") == F.col("zone_of"), "left") if small else values.join(lookup, F.col("source") == F.col("zone_of"), "left").repartitionByRange(*by).sortWithinPartitions(*by)
    # Values without a reading are passed over by the tasks: a filter here would be pushed below, and inline, every step of the reading.
    read = with_interpretations(values.withColumn("part", F.spark_partition_id()), "raw", "zone")
    of = lambda part, kind: F.transform("readings", lambda r: r[part].cast(kind))
    ordered = read.select("source", "field", "part", "record", of("departures", "int").alias("departures"), of("format", "int").alias("format"), of("utc_micros", "bigint").alias("micros"))
    # The steps of the reading in one generated method are too long for the JVM's compiler; without it they run many times slower.
    with settings(records.sparkSession, {"spark.sql.codegen.hugeMethodLimit": "8000"}):
        ordered = cut_lineage(ordered)
    tasks = ordered.rdd.getNumPartitions()
    costs = (switch_cost, backward_cost, convention_cost)
    borders = bounded_rows(ordered.mapInArrow(_border_costs(*costs), _BORDER), 2 * tasks, "stretches at the borders of tasks")
    return ordered.mapInArrow(_choices(_border_choices(borders, switch_cost, backward_cost), *costs), _CHOSEN)
