"""Encoding, mixing and reading level."""

from __future__ import annotations

import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import encode, mixing, reading

PATH = encode.vocabulary_path()
ENCODER = encode.make_encoder(PATH, bound=50)
WHOLE = tiktoken.Encoding("own", pat_str=encode.PATTERN, mergeable_ranks=encode.load_ranks(PATH), special_tokens={})
DOCS = "doc_id long, text string, source string, ids string, n_tokens string"
PIECES = ["a", "b", "'s", "'", " ", "  ", "\n", "\t", "\r\n", "é", "中", "\xa0", " ", "　", "\x85", "\x1c", "1", "23", "!", "?'", "-", "<|endoftext|>", "😀", "ß", "​", "﻿", "."]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join) | st.text(max_size=40))
def test_fragments_give_the_ids_of_the_whole_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER(text) == WHOLE.encode_ordinary(text)


def test_no_token_spans_a_forced_boundary():
    text = "The report was filed. Nobody's seen it, sadly!\n\n  Ende 中文"
    data = text.encode()
    cuts = {0, *encode.forced_boundaries(data, encode.forced_pairs(PATH)), len(data)}
    ends = set(np.cumsum([len(WHOLE.decode_single_token_bytes(t)) for t in WHOLE.encode_ordinary(text)]).tolist())
    assert cuts - {0} <= ends and len(cuts) > 8


def test_documents(spark):
    long = "word " * 200_000
    rows = [(1, "Hello <|endoftext|> there", "s", "x", "y"), (2, "", "s", "", ""), (3, None, "s", "", ""), (4, long, "s", "", ""), (1, "Hello", "s", "", "")]
    got = [(r.doc_id, list(r.ids)) for r in encode.encode_documents(spark.createDataFrame(rows, DOCS)).collect()]
    assert got == [(k, WHOLE.encode_ordinary(t or "")) for k, t, *_ in rows]
    lengths = encode.encode_documents(spark.createDataFrame(rows, DOCS), lengths_only=True, keep=("source",))
    assert [r.n_tokens for r in lengths.collect()] == [len(i) for _, i in got]
    assert encode.encode_documents(spark.createDataFrame([], DOCS)).collect() == []


# ---- mixing ----


@pytest.mark.parametrize("seed", range(4))
def test_rounding_keeps_size_and_whole_numbers(seed):
    rng = random.Random(seed)
    items = sorted(((k, float(rng.choice([1, 5, 20, 400])), 0.37) for k in range(300)), key=lambda x: -x[1])
    for rounded in (mixing.round_pool, mixing.round_fractions):
        settled, left = rounded(items, seed)
        size = {k: s for k, s, _ in items}
        reached = sum(size[k] * x for k, x in settled) + (left[1] * left[2] if left else 0)
        assert reached == pytest.approx(sum(s * p for _, s, p in items), rel=1e-6)
        assert len(settled) + bool(left) == 300 and {x for _, x in settled} <= {0, 1}


def test_without_pairing_the_size_is_missed():
    rng = random.Random(9)
    items = sorted(((k, rng.lognormvariate(5, 1.2), 0.37) for k in range(3000)), key=lambda x: -x[1])
    size = {k: s for k, s, _ in items}
    wanted = 0.37 * sum(size.values())
    off = lambda picked: abs(sum(size[k] for k, x in picked if x) - wanted) / wanted
    paired = max(off(mixing.round_pool(items, seed)[0]) for seed in range(10))
    alone = max(off([(k, random.Random(f"{seed}|{k}").random() < 0.37) for k in size]) for seed in range(10))
    assert paired < 0.002 < alone


def test_expected_fractions_are_kept():
    items = [(k, float(1 + k % 3), 0.3) for k in range(12)]
    hits = np.zeros(12)
    for seed in range(3000):
        settled, left = mixing.round_pool(items, seed)
        for k, x in settled:
            hits[k] += x
        if left:
            hits[left[0]] += left[2]
    assert np.abs(hits / 3000 - 0.3).max() < 0.04


def test_mix_reaches_its_shares(spark):
    rng = random.Random(5)
    names = ["big", "Big ", "BIG", "small-one", "small_one", None, "unwanted"]
    rows = [(k, "word " * rng.randint(1, 60), rng.choice(["big"] * 10 + names), "", "") for k in range(1500)] + [(9000, None, "big", "", ""), (9001, "", "big", "", ""), (1, "word", "big", "", "")]
    targets = spark.createDataFrame([("big", 0.7, 1), ("Small One", 0.2, 3), ("absent", 0.1, 2), ("unwanted", 0.0, 2), ("never", None, None)], "source string, target_share double, max_repeats int")
    mix, report = mixing.mix_documents(spark.createDataFrame(rows, DOCS), targets)
    got = mix.collect()
    assert len(got) == len(rows)
    most = {"big": 1, "small_one": 3}
    assert all(0 <= r.copies <= most.get(r.source, 0) for r in got) and all(r.copies == 0 for r in got if r.n_tokens == 0)
    shares = {r.source: r.reached_share for r in report.collect()}
    assert shares["absent"] == shares["unwanted"] == shares["never"] == 0 and shares["big"] == pytest.approx(7 / 9, abs=0.01) and shares["small_one"] == pytest.approx(2 / 9, abs=0.01)
    again = mixing.mix_documents(spark.createDataFrame(rows, DOCS), targets)[0].collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_empty_mix(spark):
    targets = spark.createDataFrame([("big", 1.0, 1)], "source string, target_share double, max_repeats int")
    mix, report = mixing.mix_documents(spark.createDataFrame([], DOCS), targets)
    assert mix.collect() == [] and report.first().reached == 0
    mix, report = mixing.mix_documents(spark.createDataFrame([(1, "a b", "big", "", "")], DOCS), targets.limit(0))
    assert [r.copies for r in mix.collect()] == [0] and report.collect() == []


def test_source_names(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(" Daily-Digest ",), ("daily digest",), ("DAILY_DIGEST",)], "s string")
    assert {r[0] for r in rows.select(mixing.source_key(F.col("s"))).collect()} == {"daily_digest"}


# ---- reading level ----

EASY, HARD = "the dog ran to the red box and the boy sat".split(), "notwithstanding institutional determinations concerning provisional reclassification constitute administrative representations".split()


def labelled(spark, n=300, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        band = rng.randint(1, 5)
        words = [rng.choice(HARD if rng.random() < (band - 1) / 4 else EASY) for _ in range(80)]
        docs.append((k, " ".join(words), "s", "", ""))
        labels.append((k, "a", max(1, min(5, band + (rng.random() < 0.08)))))
    schema = "doc_id long, rater string, grade_band int"
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame([*labels, (None, "a", 3), (5, "b", 9)], schema), dict((d, b) for d, _, b in labels)


def test_held_out_bands(spark):
    docs, labels, true = labelled(spark)
    models = reading.train_models(docs.filter("doc_id < 150"), labels)
    got = {r.doc_id: r for r in reading.reading_levels(docs, models).collect()}
    held = [k for k in true if k >= 150]
    assert sum(abs(got[k].band - true[k]) <= 1 for k in held) / len(held) > 0.95
    assert sum(got[k].band == true[k] for k in held) / len(held) > 0.6
    assert sum((got[k].band >= 4) == (true[k] >= 4) for k in held) / len(held) > 0.85


def test_the_language_does_not_depend_on_the_number_of_labels(spark):
    hard = "To the extent that retrospective reconciliation of records is required, the custodian shall determine whether supplementary disclosures are warranted by law. "
    mixed = "La conductora encontró una cámara junto al río y el guardia de la biblioteca denunció los daños que vio en el garaje. The guard saw it."
    rows = [(1, hard * 3, "", "", ""), (2, mixed * 3, "", "", ""), (3, "Der Wachmann hat das Rad in der Halle gefunden und im Büro abgegeben. " * 4, "", "", "")]
    docs, labels, _ = labelled(spark)
    for few in (0, 4, 300):
        models = reading.train_models(docs.filter(f"doc_id < {few}"), labels)
        got = {r.doc_id: r.english for r in reading.reading_levels(spark.createDataFrame(rows, DOCS), models).collect()}
        assert got == {1: True, 2: False, 3: False}


def test_very_long_words_count_as_a_whole(spark):
    easy, hard = "a" * 150 + "b", "a" * 150 + "c"
    docs = [(k, " ".join([hard if k % 2 else easy] * 9), "s", "", "") for k in range(8)]
    labels = spark.createDataFrame([(k, "a", 5 if k % 2 else 1) for k in range(8)], "doc_id long, rater string, grade_band int")
    docs = spark.createDataFrame(docs, DOCS)
    models = reading.train_models(docs, labels)
    assert len(models["table"]) == 2
    assert {r.doc_id: r.band for r in reading.reading_levels(docs, models).collect()} == {k: 5 if k % 2 else 1 for k in range(8)}


def test_language_and_odd_texts(spark):
    docs, labels, _ = labelled(spark)
    models = reading.train_models(docs, labels)
    rows = [(1, None, "", "", ""), (2, "", "", "", ""), (3, " \n ", "", "", ""), (4, "la conductora encontró una cámara junto al río", "", "", ""), (5, "the dog ran", "", "", ""), (5, "the dog ran", "", "", ""), (6, "the dog " * 100_000, "", "", "")]
    got = {r.doc_id: r for r in reading.reading_levels(spark.createDataFrame(rows, DOCS), models).collect()}
    assert [got[k].band for k in (1, 2, 3)] == [0, 0, 0] and not got[4].english and got[5].english and got[6].n_words == 200_000
    assert len(models["table"]) == len(set(EASY + HARD))
    none = reading.train_models(docs.limit(0), labels.limit(0))
    assert [r.band for r in reading.reading_levels(spark.createDataFrame(rows, DOCS), none).collect()] == [0] * 7
    assert reading.band_report(reading.reading_levels(docs, models)).count() >= 3
