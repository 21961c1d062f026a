"""Packed fields: grammars, quoting, list marks and the dictionary's say."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.operators.packed import NUMBERS, PROSE, build_automaton, known_spans, split_packed, unpack_fields

KNOWN = build_automaton(["inquiry open/pending", "area searched, nobody found", "inquiry closed", "break-in, dwelling"])


@pytest.mark.parametrize(
    ("text", "values"),
    [
        (None, []),
        ("  ", []),
        ("Inquiry closed", ["Inquiry closed"]),
        ("Inquiry closed; ; Person detained;", ["Inquiry closed", "Person detained"]),
        ("inquiry open/pending / Case closed", ["inquiry open/pending", "Case closed"]),
        ("a | b|c\r\nd；e", ["a", "b", "c", "d", "e"]),
        ("• One\n• Two, three", ["One", "Two, three"]),
        ("1) One 2) Two of 3 3) Three", ["One", "Two of 3", "Three"]),
        ("(1) One (2) Two (x2)", ["One", "Two (x2)"]),
        ("1. One 2. 2 persons detained", ["One", "2 persons detained"]),
        ('Vehicle towed; "Disposition ""revised"""; x', ["Vehicle towed", 'Disposition "revised"', "x"]),
        ('"Inactive; awaiting new leads" | Closed', ["Inactive; awaiting new leads", "Closed"]),
        ("“break-in; storeroom”; Theft", ["break-in; storeroom", "Theft"]),
        ('["No offence est\\u0430blished", "Inquiry open/pending", ""]', ["No offence estаblished", "Inquiry open/pending"]),
        ("theft • paint · noise", ["theft", "paint", "noise"]),
        ('He said "no" ; left', ['He said "no"', "left"]),
        ('"unbalanced; quote', ['"unbalanced', "quote"]),
    ],
)
def test_prose(text, values):
    assert split_packed(text, PROSE, KNOWN) == values


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("NUPD 24-1, CSA 2/CSA 3", ["NUPD 24-1", "CSA 2", "CSA 3"]),
        ("A 1 AND B 2 and C 3 & D 4 + E 5", ["A 1", "B 2", "C 3", "D 4", "E 5"]),
        ('"HTPD 22-1147046/ copy"', ["HTPD 22-1147046/ copy"]),
        ('X 1//"CSA 45514/ copy"/ GEN 2', ["X 1", "CSA 45514/ copy", "GEN 2"]),
        ("nupd 24- 1838770/CSA 25044", ["nupd 24- 1838770", "CSA 25044"]),
        ('"66889", "82933" and "1; bis"', ["66889", "82933", "1; bis"]),
    ],
)
def test_numbers(text, values):
    assert split_packed(text, NUMBERS) == values


def test_the_dictionary_keeps_a_value_with_a_delimiter_whole():
    known = build_automaton(["lost; found", "towed"])
    assert split_packed("Lost; found; towed", PROSE, known) == ["Lost; found", "towed"]
    assert split_packed("Lost; found; towed", PROSE, known, known_worth=0.5) == ["Lost", "found", "towed"]
    assert known_spans("relost; found", known) == []


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("Break-in, dwelling", ["Break-in, dwelling"]),
        ("break-in, dwelling, Inquiry closed", ["break-in, dwelling", "Inquiry closed"]),
        ("Inquiry closed and break-in, dwelling", ["Inquiry closed", "break-in, dwelling"]),
        ("inquiry open/pending - inquiry closed; x", ["inquiry open/pending", "inquiry closed", "x"]),
        ("Inquiry closed, done", ["Inquiry closed, done"]),
        ("Update: inquiry closed", ["Update: inquiry closed"]),
        ('"inquiry closed, inquiry open/pending"; x', ["inquiry closed, inquiry open/pending", "x"]),
        ("• inquiry closed, inquiry closed", ["inquiry closed", "inquiry closed"]),
    ],
)
def test_the_dictionary_decides_on_soft_delimiters(text, values):
    assert split_packed(text, PROSE, KNOWN) == values


def test_without_the_dictionary_other_values_come_out():
    texts = ["break-in, dwelling, Inquiry closed", "Inquiry closed and break-in, dwelling", "inquiry open/pending - inquiry closed; x"]
    assert all(split_packed(t, PROSE, KNOWN) != split_packed(t, PROSE) for t in texts)


def test_the_fewest_known_values_cover():
    known = build_automaton(["lost", "found", "lost and found", "towed"])
    assert split_packed("lost and found, towed", PROSE, known) == ["lost and found", "towed"]
    assert split_packed("found and lost", PROSE, known) == ["found", "lost"]
    assert len(split_packed(", ".join(["towed"] * 50_000), PROSE, known)) == 50_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abc ,:-/'and", min_size=1, max_size=12).map(str.strip).filter(lambda s: s and s[0] not in "-/" and not s.endswith(" ")), min_size=1, max_size=6))
def test_what_was_joined_is_split_again(values):
    values = [v for v in values if " /" not in v]
    assert split_packed("; ".join(values), PROSE) == values


def test_a_very_long_field():
    assert len(split_packed("; ".join(["inquiry closed"] * 50_000), PROSE, KNOWN)) == 50_000


def test_rows(spark):
    schema = "row_id long, disposition_raw string, pos int, token string, field_name string"
    rows = [(1, "a; b", 9, "x", "y"), (1, "a; b", 9, "x", "y"), (2, "a", 0, "", ""), (3, None, 0, "", ""), (4, "", 0, "", "")]
    lists = {"disposition_raw": spark.createDataFrame([("a",), (None,)], "raw_token string")}
    out = unpack_fields(spark.createDataFrame(rows, schema), {"disposition_raw": PROSE}, lists)
    assert sorted(map(tuple, out.collect())) == [(1, "disposition_raw", 1, "a")] * 2 + [(1, "disposition_raw", 2, "b")] * 2
    assert unpack_fields(spark.createDataFrame([], schema), {"disposition_raw": PROSE}, lists).collect() == []
