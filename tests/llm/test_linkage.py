"""Canonical mapping and groups."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from daybook.llm import canonical, groups
from daybook.operators.packed import PROSE

FOLDER = "/root/testdata/sf0.001"
ENTRIES = ["inquiry closed", "inquiry open/pending", "person detained", "vehicle towed", "goods recovered", "goods returned to owner", "passed to town police", "summons served in person", "summons served by mail", "disposition revised", "disposition revised- closed", "theft from vehicle", "vehicle theft", "attempted vehicle theft", "blackmail", "complainant could not be reached", "camera footage reviewed"]
ALIASES = canonical.read_aliases()
MATCHER = canonical.Matcher(ENTRIES, aliases=ALIASES)


@pytest.mark.parametrize(
    ("value", "entry"),
    [
        ("INQUIRY  CLOSED", "inquiry closed"),
        ("1nquiry cl0sed..", "inquiry closed"),
        ("Case closed", "inquiry closed"),
        ("inquiryclosed - done", "inquiry closed"),
        ("Inquiry Open_Pending (x2)", "inquiry open/pending"),
        ("two persons detained", "person detained"),
        ("Person dеtained per supervisor", "person detained"),
        ("pers. dtnd at 9:20", "person detained"),
        ("Veh. towed away", "vehicle towed"),
        ("property recovered", "goods recovered"),
        ("goods ret'd to owner", "goods returned to owner"),
        ("Referred To Town PD", "passed to town police"),
        ("mail - smmns served by", "summons served by mail"),
        ("Disposition revised- closed", "disposition revised- closed"),
        ("stealing from vehhisle", "theft from vehicle"),
        ("Att. automobile theft", "attempted vehicle theft"),
        ("Update: poss. blackmatl ???", "blackmail"),
        ("Reporting party could not be rchd", "complainant could not be reached"),
        ("ＣＡＭＥＲＡ vidéo rev'd", "camera footage reviewed"),
    ],
)
def test_what_is_meant(value, entry):
    assert MATCHER.match(value) == [entry]


@pytest.mark.parametrize("value", ["", "???", "12", "Camera club concert held", "Vehicle fair picnic cancelled", "Goods lift visit filmed", "police choir outing planned", "goose repainted by volunteers"])
def test_what_means_nothing(value):
    assert MATCHER.match(value) == []


def test_the_longest_embedded_name_wins():
    assert MATCHER.match("attempted vehicle theft") == ["attempted vehicle theft"]
    assert sorted(MATCHER.match("person detained and vehicle towed")) == ["person detained", "vehicle towed"]


ALL_BUT_THE_AUTOMATON = canonical.Matcher(ENTRIES, aliases=ALIASES)
ALL_BUT_THE_AUTOMATON.automaton = canonical.ahocorasick.Automaton()


@pytest.mark.parametrize(
    ("value", "entries", "without"),
    [
        ("Case closed", ["inquiry closed"], []),
        ("Referred To Town PD", ["passed to town police"], []),
        ("automobile stealing", ["vehicle theft"], []),
        ("person detained and vehicle towed", ["person detained", "vehicle towed"], []),
        ("in the evening the complainant rang again, inquiry closed", ["inquiry closed"], []),
    ],
)
def test_the_automaton_decides(value, entries, without):
    assert MATCHER.match(value) == entries
    assert ALL_BUT_THE_AUTOMATON.match(value) == without


def test_aliases_are_a_parameter():
    assert canonical.Matcher(["vehicle towed"]).match("charabanc towed") == []
    assert canonical.Matcher(["vehicle towed"], aliases=[("charabanc", "vehicle"), ("", "towed"), ("x", "")]).match("charabanc towed") == ["vehicle towed"]
    with pytest.raises(ValueError, match="patterns"):
        canonical.PATTERN_BOUND, held = 3, canonical.PATTERN_BOUND
        try:
            canonical.Matcher(["a b c d e f"])
        finally:
            canonical.PATTERN_BOUND = held


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables here")
def test_without_the_automaton_rows_of_the_tables_change(spark):
    texts = [r[0] for r in spark.read.parquet(f"{FOLDER}/incidents.parquet").select("disposition_raw").distinct().collect() if r[0]]
    entries = [r[0] for r in spark.read.parquet(f"{FOLDER}/disposition_map.parquet").collect()]
    whole, bare = canonical.Matcher(entries, aliases=ALIASES), canonical.Matcher(entries, aliases=ALIASES)
    bare.automaton = canonical.ahocorasick.Automaton()
    values = {v for t in texts for v in canonical.split_packed(t, PROSE)}
    changed = [v for v in values if whole.match(v) != bare.match(v)]
    assert len(changed) > 0.01 * len(values)


def test_a_very_long_value_and_an_empty_list():
    assert MATCHER.match(" ".join(f"unheard{k}" for k in range(20_000)) + " case closed") == ["inquiry closed"]
    assert MATCHER.match("nothing known here " * 20_000) == []
    assert canonical.Matcher([]).match("inquiry closed") == []


def test_edits():
    assert canonical.distance("caution", "catuion", 2) == 1 and canonical.distance("abc", "xyz", 1) == 2 and canonical.skeleton("detained") == "dtnd"


def test_rows(spark):
    schema = "row_id long, disposition_raw string, value string, raw_token string, record string"
    rows = [(1, "Case closed; goose sold at auction; inquiry closed", "", "", ""), (1, "Case closed", "", "", ""), (2, None, "", "", ""), (3, " ", "", "", ""), (4, "vehicle towed", "", "", "")]
    lists = {"disposition_raw": spark.createDataFrame([(e,) for e in [*ENTRIES, None]], "raw_token string")}
    mapped = canonical.map_values(spark.createDataFrame(rows, schema), {"disposition_raw": PROSE}, lists)
    found = sorted(map(tuple, canonical.meant_entries(mapped).collect()))
    assert found == [(1, "disposition_raw", "(unmatched)"), (1, "disposition_raw", "inquiry closed"), (4, "disposition_raw", "vehicle towed")]
    assert canonical.map_values(spark.createDataFrame([], schema), {"disposition_raw": PROSE}, lists).collect() == []


@pytest.mark.parametrize(
    ("value", "entries"),
    [
        ("during the night patrol along north lot a grey sedan blocked the gate vehicle towed", ["vehicle towed"]),
        ("vehicle towed after the long night patrol along the north lot gate; inquiry closed", ["vehicle towed", "inquiry closed"]),
        ("vehicle towed in the night, camra footge was reviewd", ["vehicle towed", "camera footage reviewed"]),
        ("complainant could by phone not be reached, vehicle towed", ["complainant could not be reached", "vehicle towed"]),
        ("blackmail letters hung along the long corridor by the north lot gate", ["blackmail"]),
    ],
)
def test_entries_inside_long_values(value, entries):
    assert MATCHER.match(value) == entries


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a != b and a and b:
            ra, rb = sorted((find(a), find(b)))
            parent[rb] = ra
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("hot", [False, True])
def test_groups_by_union_find(spark, monkeypatch, hot):
    rng = random.Random(3)
    name = lambda: f"n{rng.randint(0, 400):03d}"
    edges = [(name(), name()) for _ in range(150)] + [("n500", f"n{k:03d}") for k in range(600, 700)] + [(f"c{k:03d}", f"c{k + 1:03d}") for k in range(60)] + [(None, "x"), ("x", None), ("y", "y")]
    if hot:
        monkeypatch.setattr(groups, "HOT_LEAST", 20)
        monkeypatch.setattr(groups, "HOT_SHARE", 20)
    got = groups.connected_groups(spark.createDataFrame(edges, "left string, right string"))
    assert {r.node: r.label for r in got.collect()} == union_find(edges)


def test_groups_of_a_long_ordered_chain(spark):
    chain = [f"r{k:05d}" for k in range(10_001)]
    got = groups.connected_groups(spark.createDataFrame(list(zip(chain, chain[1:])), "left string, right string"))
    assert {r.node: r.label for r in got.collect()} == dict.fromkeys(chain, chain[0])


def test_superseded(spark):
    schema = "incident_uid string, superseded_by string, left string, node string"
    rows = [("a", " B ", "", ""), ("b", "c", "", ""), ("C", None, "", ""), ("d", "nobody", "", ""), ("e", "", "", ""), ("f", "F", "", ""), ("a", "b", "", "")]
    got = groups.superseded_groups(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, got.collect())) == [("a", "a"), ("b", "a"), ("c", "a")]
    assert groups.superseded_groups(spark.createDataFrame([], schema)).collect() == []
