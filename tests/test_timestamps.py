"""Timestamps: readings, conventions, clock changes and the Viterbi choice."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pyarrow as pa
import pytest

from daybook.operators import timestamps as ts

RECORDS = "row_id long, source_file_id string, source_row_index int, date_reported_raw string, date_occurred_raw string, zone string, readings string, field string"
ZONES = "source_file_id string, time_zone string, place int"


def utc(text: str) -> int:
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.UTC).timestamp() * 1_000_000)


def resolve(spark, values, zone="America/New_York", **options):
    rows = [(k, "s", k, v, None, "clash", "clash", "clash") for k, v in enumerate(values)]
    out = ts.resolve_timestamps(spark.createDataFrame(rows, RECORDS), spark.createDataFrame([("s", zone, 1)], ZONES), **options)
    return {r.record: r for r in out.collect()}


CASES = [
    ("4/9/25 8:19", "2025-04-09T12:19"),
    ("12/05/2020 00:34 MST", "2020-12-05T07:34"),
    (" 2024-03-04 02:15:04", "2024-03-04T07:15:04"),
    ("7/28/2025 7:23PM", "2025-07-28T23:23"),
    ("4/9/25 4:26 AM", "2025-04-09T08:26"),
    ("5/25/26 12:05 a.m. ET", "2026-05-25T04:05"),
    ("2022-07-24T20:20:51.982", "2022-07-25T00:20:51.982"),
    ("1620572711", "2021-05-09T15:05:11"),
    ("1790900141621", "2026-10-02T00:15:41.621"),
    ("8/4/26 0746 hrs", "2026-08-04T11:46"),
    ("5/7/26 2056h", "2026-05-08T00:56"),
    ("2023-01-16T22:46:42+01:00", "2023-01-16T21:46:42"),
    ("12 January 2022, 02:25", "2022-01-12T07:25"),
    ("20240317T193439Z", "2024-03-17T19:34:39"),
    ("Sat, 02 May 2026 22:04:53 -0400", "2026-05-03T02:04:53"),
    ("2-Dec-2024 14:45", "2024-12-02T19:45"),
    ("March 21, 2024 at 05:07", "2024-03-21T09:07"),
    ("May. 10, 2025 7:55pm", "2025-05-10T23:55"),
    ("2026-03-10T18:35:15-07:00[America/Phoenix]", "2026-03-11T01:35:15"),
    ("2020-07-13 17:44 (CDT)", "2020-07-13T22:44"),
    ("since 1/1/22 5:22", "2022-01-01T10:22"),
    ("between 8/22/26 20:31 and 08/25/2026 09:27", "2026-08-23T00:31"),
    ("8/4/21 16:00 TO  08/04/2021 16:44", "2021-08-04T20:00"),
    ("03/03/2024 22:26 – 3/5/24 11:52", "2024-03-04T03:26"),
    ("on or about 8/3/22 12:31", "2022-08-03T16:31"),
    ("11/3/24 1:30", "2024-11-03T05:30"),
]
NO_CASE = [None, "", "  ", "Unknown", "2022 Unknown", "12/12/24 evening", "9/31/26 11:30", "23:48", "5/4/21", "3/10/24 2:30", "4/9/25 24:00", "13:70", "2/29/23 1:00", "4/9/25 8:19 XYZ"]


def test_readings_follow_the_conventions(spark):
    got = resolve(spark, [v for v, _ in CASES])
    assert {k: got[k].utc_micros for k in got if got[k].departures == 0} == {k: utc(w) for k, (_, w) in enumerate(CASES)}


def test_what_is_no_point_in_time_gives_no_row(spark):
    got = resolve(spark, NO_CASE)
    assert [k for k, r in got.items() if r.departures == 0] == []
    assert set(got) <= {9}  # the skipped hour of March exists as the third of October, day first


def test_day_first_only_is_a_departure(spark):
    assert resolve(spark, ["25/12/24 10:00"])[0].departures == 1


def test_zone_unknown_or_missing(spark):
    assert resolve(spark, ["4/9/25 8:19"], zone=None) == {}
    assert resolve(spark, ["4/9/25 8:19"], zone="Not/AZone") == {}
    assert resolve(spark, ["4/9/25 8:19 UTC"], zone=None)[0].utc_micros == utc("2025-04-09T08:19")


def test_session_zone_plays_no_part(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert resolve(spark, ["3/10/24 3:30", "11/3/24 1:30"])[0].utc_micros == utc("2024-03-10T07:30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_without_conventions_the_order_of_records_decides(spark):
    values = ["13/4/25 10:00", "5/6/25 10:00", "20/6/25 10:00", "7/8/25 10:00", "21/8/25 10:00"]
    free = resolve(spark, values, convention_cost=0.0)
    assert [dt.datetime.fromtimestamp(free[k].utc_micros / 1e6, dt.UTC).month for k in range(5)] == [4, 6, 6, 8, 8]
    bound = resolve(spark, values)
    assert [bound[k].departures for k in range(5)] == [1, 0, 1, 0, 1]


def test_the_order_of_records_outweighs_a_convention_that_stands_alone(spark):
    # Month first, the second value would go forward in time only to have the third go back.
    values = ["13/4/25 10:00", "6/5/25 10:00", "20/5/25 10:00"]
    assert [r.departures for _, r in sorted(resolve(spark, values).items())] == [1, 1, 1]
    conventional = resolve(spark, values, convention_cost=5.0)
    assert [r.departures for _, r in sorted(conventional.items())] == [1, 0, 1]
    assert {k: r.least_departures for k, r in conventional.items()} == {0: 1, 1: 0, 2: 1}


def test_empty_tables(spark):
    out = ts.resolve_timestamps(spark.createDataFrame([], RECORDS), spark.createDataFrame([], ZONES))
    assert out.collect() == []


def cost(chain, switch=1.0, backward=1.0):
    total = sum(c for c, _, _ in chain)
    return total + sum(switch * (a[1] != b[1]) + backward * (b[2] < a[2]) for a, b in itertools.pairwise(chain))


@pytest.mark.parametrize("seed", range(5))
def test_stretches_put_together_cost_as_little_as_one_pass(seed):
    rng = random.Random(seed)
    records = [[(float(rng.randint(0, 2)), rng.randint(1, 3), rng.randint(0, 9)) for _ in range(rng.choice([1, 2, 3]))] for _ in range(7)]
    best = min(cost(chain) for chain in itertools.product(*records))
    chain = ts._Chain(1.0, 1.0)
    for readings in records:
        chain.add(readings)
    assert cost([readings[k] for readings, k in zip(records, chain.choices(), strict=True)]) == pytest.approx(best)


SCHEMA = pa.schema([("source", pa.string()), ("field", pa.string()), ("part", pa.int32()), ("record", pa.int64()), ("departures", pa.list_(pa.int32())), ("format", pa.list_(pa.int32())), ("micros", pa.list_(pa.int64()))])


def batches(rows, part, size):
    rows = [(s, "f", part, k, *([r[i] for r in readings] for i in range(3))) for s, k, readings in rows]
    return [pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r, strict=True)) for r in rows[a : a + size]], schema=SCHEMA) for a in range(0, len(rows), size)]


@pytest.mark.parametrize("seed", range(40))
def test_tasks_and_batches_put_together_cost_as_little_as_one_pass(seed):
    rng = random.Random(seed)
    lone = rng.choice([0.0, 0.2, 0.6])
    records = []
    for k in range(rng.randint(1, 12)):
        n = 0 if rng.random() < 0.1 else 1 if rng.random() < lone else rng.choice([2, 3])
        records.append((f"s{k * rng.randint(1, 3) // 12}" if seed % 3 else "s", k, [(rng.randint(0, 2), rng.randint(1, 3), rng.randint(0, 9)) for _ in range(n)]))
    records.sort(key=lambda r: r[:2])
    cuts = sorted(rng.sample(range(len(records) + 1), min(2, len(records))))
    parts = [records[a:b] for a, b in zip([0, *cuts], [*cuts, len(records)], strict=True)]
    costs = (1.0, 1.0, 1.5)
    borders = [r for n, p in enumerate(parts) for out in ts._border_costs(*costs)(iter(batches(p, n, 3))) for r in out.to_pylist()]
    choices = ts._border_choices(borders, *costs[:2])
    got = [r for n, p in enumerate(parts) for out in ts._choices(choices, *costs)(iter(batches(p, n, 3))) for r in out.to_pylist()]
    assert [r["record"] for r in got] == [k for _, k, readings in records if readings]
    chosen = {r["record"]: (1.5 * r["departures"], r["format"], r["utc_micros"]) for r in got}
    for source in {s for s, _, _ in records}:
        of = [(k, [(1.5 * d, f, m) for d, f, m in readings]) for s, k, readings in records if s == source and readings]
        best = min((cost(c) for c in itertools.product(*(r for _, r in of))), default=0.0)
        assert cost([chosen[k] for k, _ in of]) == pytest.approx(best)
        assert all(chosen[k] in r for k, r in of)


def test_a_source_over_many_tasks_gives_the_same_result(spark):
    rng = random.Random(1)
    values = [f"{rng.randint(1, 12)}/{rng.randint(1, 12)}/25 {rng.randint(0, 23)}:00" for _ in range(400)]
    rows = spark.createDataFrame([(k, "s", k, v, None, "", "", "") for k, v in enumerate(values)], RECORDS)
    zones = spark.createDataFrame([("s", "UTC", 1)], ZONES)
    results = []
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = ts.resolve_timestamps(rows, zones, convention_cost=0.5)
        results.append({r.record: (r.utc_micros, r.format) for r in out.collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.enabled", "true")

    def total(chosen):
        return sum(ts.SWITCH_COST * (a[1] != b[1]) + ts.BACKWARD_COST * (b[0] < a[0]) for a, b in itertools.pairwise(chosen[k] for k in range(400))) + sum(0.5 * (chosen[k][1] == ts.SLASH_DMY) for k in range(400))

    assert len(results[0]) == len(results[1]) == 400
    assert total(results[0]) == pytest.approx(total(results[1]))
