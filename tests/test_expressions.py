"""Column expressions by example tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daybook.functions import dates, identity, tokens
from daybook.sources import maps


def one(spark, values, expression):
    """The expression over a column ``v`` of text values."""
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in rows.select("k", expression(F.col("v")).alias("x")).orderBy("k").select("x").collect()]


def test_case_numbers(spark):
    assert one(spark, ["  nupd   26-1/ csa 2 ", None, "a b"], identity.normalize_case_number) == ["NUPD 26-1/ CSA 2", "", "A B"]
    refs = one(spark, ["NUPD 26-034005/ CSA 88071", "NUPD 26-0345653", "12 1234567", None], identity.case_references)
    assert refs == [["26-034005", "88071"], ["26-0345653"], [], []]


def test_canonical_times(spark):
    assert one(spark, ["9/1/26   23:20", "06/06/22", "6/6/22 0:01", "02/13/2022 2:23", "9/31/26 11:30", None, "9/1/99"], identity.canonical_reported) == [
        "2026-09-01T23:20", "2022-06-06", "2022-06-06T00:01", "2022-02-13T02:23", "9/31/26 11:30", "", "1999-09-01",
    ]
    assert one(spark, ["Since 5/13/26 Unk.", "8/31/22 22:00 to 9/1/22 9:31", "2/16/2022 unknown"], identity.canonical_occurred) == ["since 2026-05-13", "2022-08-31T22:00 to 2022-09-01T09:31", "2022-02-16"]


def test_uid_is_independent_of_spelling(spark):
    rows = spark.createDataFrame([("NUPD 22-1", "02/13/22 2:23"), (" nupd  22-1", "2/13/2022 2:23"), ("NUPD 22-1", "2/14/22 2:23")], "c string, d string")
    a, b, c = [r[0] for r in rows.select(identity.incident_uid(F.col("c"), F.col("d"))).collect()]
    assert a == b != c and len(a) == 16


@pytest.mark.parametrize(
    ("old", "new", "expected"),
    [
        ("Simple Assault", "Simple Assault, Nature updated, Burglary", True),
        ("Theft", "Theft; Nature Updated; Robbery", True),
        ("Theft", "Robbery, Nature updated, Theft", False),
        ("Theft", "Robbery", False),
        (None, None, False),
    ],
)
def test_inline_amendment(spark, old, new, expected):
    row = spark.createDataFrame([(old, new)], "a string, b string").select(identity.amends_inline(F.col("a"), F.col("b"))).first()
    assert row[0] is expected


@pytest.mark.parametrize(("old", "new", "expected"), [(["1"], ["1", "2"], True), (["1", "2"], ["1"], False), (["1"], ["2"], True), (["1"], ["1"], True), ([], ["1"], False)])
def test_renumbering(spark, old, new, expected):
    row = spark.createDataFrame([(old, new)], "a array<string>, b array<string>").select(identity.is_renumbering(F.col("a"), F.col("b"))).first()
    assert row[0] is expected


def test_partial_dates(spark):
    values = ["9/1/26 23:20", "6/30/26 Unk.", "10/2025 Unk.", "2021 Unknown", "Unknown", "", "9/31/26 11:30", "Since 5/13/26 Unk.", "8/31/22 22:00 to 9/1/22 9:31", "Since 10/2025", None, "10/31/26- 11/1/26 Unknown"]
    got = one(spark, values, dates.partial_date)
    assert [(g.value, g.precision, g.ongoing) for g in got] == [
        ("2026-09-01T23:20:00", "minute", False), ("2026-06-30", "day", False), ("2025-10", "month", False), ("2021", "year", False), (None, "unknown", False), (None, "unknown", False),
        (None, "invalid", False), ("2026-05-13", "range_start", True), ("2022-08-31T22:00:00", "range_start", True), ("2025-10", "month", True), (None, "unknown", False), (None, "invalid", False),
    ]
    assert got[8].range_end == "9/1/22 9:31" and got[7].range_end is None


def test_months_and_years(spark):
    assert one(spark, ["September 2026", "2026-09", "2026-13", "Sept 2026", None], dates.month_key) == ["2026-09", "2026-09", None, None, None]
    assert one(spark, ["2026-09", "2021", "", None], dates.month_label) == ["September 2026", None, None, None]
    assert one(spark, ["2026-08", "2027-07", "1999-08", None], dates.school_year) == ["2026-27", "2026-27", "1999-00", None]
    bins = one(spark, ["9/24/26 23:47", "Since 7/13/26 Unk.", "2021 Unknown", "5/2/26 0:43"], lambda c: dates.occurred_bin(dates.partial_date(c)))
    assert [tuple(b) for b in bins] == [("2026-09", None), ("2026-07", None), (None, "no_date"), (None, "before_window")]
    assert one(spark, ["20261106101112", "x"], dates.capture_date)[1] is None


def test_lag_and_year_warning(spark):
    rows = spark.createDataFrame([("9/5/26 18:45", "8/28/26 6:00"), ("9/5/26 18:45", "8/28/26"), ("9/5/24 1:00", "9/5/24 2:00")], "r string, o string")
    r, o = dates.partial_date(F.col("r")), dates.partial_date(F.col("o"))
    got = rows.select(dates.lag_hours(r, o), dates.year_warning(r, F.lit(2026))).collect()
    assert [g[0] for g in got] == [204.75, None, -1.0] and [g[1] is not None for g in got] == [False, False, True]


def test_coverage_and_axis(spark):
    rows = spark.createDataFrame([(["2026-08", "2026-09", "2027-01", "2026-11"],), ([],), ([f"2026-{m:02d}" for m in range(8, 13)] + [f"2027-{m:02d}" for m in range(1, 8)],)], "m array<string>")
    assert [r[0] for r in rows.select(dates.coverage_label(F.col("m"), False)).collect()] == ["Aug–Sep, Nov, Jan", "none", "all 12 months"]
    window = spark.createDataFrame([(["2026-09", "2026-06", "2026-07", "2026-08"],)], "m array<string>")
    assert window.select(dates.coverage_label(F.col("m"), True)).first()[0] == "Jun–Sep"
    assert [r[0] for r in spark.createDataFrame([(1.0,), (107.0,), (5.5,)], "v double").select(dates.nice_ceiling(F.col("v"))).collect()] == [1.0, 120.0, 6.0]


LIST = [("Theft", "offense", "Theft", None), ("theft", "offense", "Theft", "same"), ("Vehicle theft", "offense", "Vehicle theft|Theft", None), ("Nature updated", "audit_marker", None, None), ("Dispute", "activity", None, None), ("Bicycle", "object", "", None)]


def test_categories(spark):
    lookup = maps.lookup_column(spark.createDataFrame(LIST, "raw_token string, token_role string, categories string, notes string"), "categories")
    got = one(spark, ["Theft; Nature updated; VEHICLE  theft.", "Nature updated; theft", "Dispute; Bicycle ; x, y", None], lambda c: tokens.categorize(c, lookup))
    assert got[0].categories == ["Vehicle theft", "Theft"] and got[0].reclassified_from == [] and got[0].was_reclassified
    assert got[1].categories == ["Theft"] and not got[1].was_reclassified
    assert (got[2].categories, got[2].activity, got[2].objects, got[2].unclassified) == ([], ["Dispute"], ["Bicycle"], ["x, y"])
    assert got[3].categories == [] and got[3].unclassified == []


def test_disposition_flags_and_agencies(spark):
    entries = spark.createDataFrame([("closed", "outcome", "closed"), ("open", "outcome", "open|new"), ("disposition updated", "audit_marker", "")], "raw_token string, token_role string, flags string")
    lookup = maps.lookup_column(entries, "flags")
    got = one(spark, ["Open; Open; Disposition updated; Closed..", "Open; Closed", "odd . "], lambda c: tokens.disposition_flags(c, lookup))
    assert (got[0].flags, got[0].superseded_flags, got[0].disposition_amended) == (["closed"], ["open", "new", "open", "new"], True)
    assert got[1].flags == ["open", "new", "closed"] and not got[1].disposition_amended
    assert got[2].unclassified == ["odd "]
    assert one(spark, ["nupd 1/ CSA 2", "XCSA", None], tokens.agencies) == [["NUPD", "CSA"], [], []]


def test_maps_are_checked(spark):
    wrong = spark.createDataFrame([("Lewd act", "offense", "A"), ("lewd  Act.", "offense", "B")], "raw_token string, token_role string, categories string")
    with pytest.raises(maps.MappingError):
        maps.lookup_column(wrong, "categories")
    right = spark.createDataFrame(LIST, "raw_token string, token_role string, categories string, notes string")
    with pytest.raises(maps.MappingError, match="'b', 'c'"):
        maps.require_mapped(spark.createDataFrame([("theft",), ("c",), ("b",)], "token string"), right)
    empty = spark.createDataFrame([], "raw_token string, token_role string, categories string")
    assert one(spark, ["x"], lambda c: tokens.categorize(c, maps.lookup_column(empty, "categories")))[0].unclassified == ["x"]


def test_text(spark):
    assert one(spark, ["<a & 'b'>"], tokens.escape_html) == ["&lt;a &amp; &#39;b&#39;&gt;"]
    assert one(spark, ["abcdef", "abc"], lambda c: tokens.clip(c, 4)) == ["abc…", "abc"]
    assert one(spark, ["Hello World", None], lambda c: tokens.text_search(" WORLD ", c, c)) == [True, False]
