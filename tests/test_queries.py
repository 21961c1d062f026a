"""Every query with SQL gives what DuckDB gives on the smallest tables; the entry runs without the optional package."""

from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

from daybook.plans import archive_queries, core_queries, merge_queries

FOLDER = "/root/testdata/sf0.001"
SQL = core_queries.oracle_sql() | archive_queries.oracle_sql() | merge_queries.oracle_sql()
QUERIES = core_queries.queries() | archive_queries.queries() | merge_queries.queries()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for name in os.listdir(FOLDER):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    return c


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", ["p4_found", "p6_found", "p7_found", "uid_hash", "content_hash", "categorize", "disposition_flags", "facet_counts", "quality_audit", "merge_full_outer", "merge_events", "fork_match_tiers", "duplicate_candidates", "snapshot_append"])
def test_query_equals_sql(spark, tables, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    cursor = tables.execute(SQL[name])
    at = [[d[0] for d in cursor.description].index(c) for c in columns]
    expected = Counter(tuple(plain(r[k]) for k in at) for r in cursor.fetchall())
    assert Counter(tuple(map(plain, r)) for r in frame.select(*columns).collect()) == expected


def test_snapshot_append_of_a_file_with_many_rows(spark, tmp_path):
    """80,000 rows a snapshot: the sums of their hashes are beyond a bigint. The second snapshot is as the first, the third isn't."""
    path = str(tmp_path / "incident_snapshots.parquet")
    rows = spark.range(80_000).selectExpr("cast(id as int) as source_row_index", "concat('U', id) as incident_uid", "'f' as source_file_id")
    dated = rows.crossJoin(spark.range(1, 4).selectExpr("date'2026-08-03' as snapshot_date", "cast(id as int) as snapshot_seq"))
    dated.filter("snapshot_seq < 3 or source_row_index > 0").write.parquet(path)
    expected = duckdb.sql(SQL["snapshot_append"].replace("incident_snapshots", f"'{path}/*.parquet'")).fetchall()
    got = QUERIES["snapshot_append"](spark, str(tmp_path)).select("source_file_id", "date", "seq", "sha256").collect()
    assert sorted(map(tuple, got)) == sorted(expected) and sorted(r.seq for r in got) == [1, 3]


def test_names_agree():
    assert set(SQL) <= set(QUERIES)


def test_entry_without_the_optional_package():
    code = "import sys; sys.modules['daybook.llm'] = None; import __spark_entry__ as e; assert 'p6_found' in e.queries() and not any(n.startswith('p8') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
