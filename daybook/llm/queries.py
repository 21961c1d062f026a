"""Queries of the problems of this package, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.canonical import map_values, meant_entries
from daybook.llm.encode import encode_documents
from daybook.llm.groups import superseded_groups
from daybook.llm.mixing import mix_documents
from daybook.llm.reading import LEAST_WORDS, reading_levels, train_models
from daybook.operators.packed import PROSE
from daybook.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map entries meant by the dispositions and natures of each record."""
    lists = {"disposition_raw": table(spark, sf_dir, "disposition_map").select("raw_token"), "nature_raw": table(spark, sf_dir, "category_map").select("raw_token")}
    mapped = map_values(table(spark, sf_dir, "incidents"), {"disposition_raw": PROSE, "nature_raw": PROSE}, lists)
    return meant_entries(mapped).withColumnRenamed("record", "row_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group identifier for all records tied by superseded_by."""
    return superseded_groups(table(spark, sf_dir, "incidents"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_documents(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in the mix of mix_targets."""
    return mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares the mix reaches."""
    return mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading band of every document."""
    documents = table(spark, sf_dir, "documents")
    return reading_levels(documents, train_models(documents, table(spark, sf_dir, "reading_labels")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents of at least forty words whose band is 4 or 5."""
    return p10_levels(spark, sf_dir).filter(f"english AND n_words >= {LEAST_WORDS} AND band >= 4").select("doc_id")


P3_SQL = """
WITH RECURSIVE r AS (SELECT DISTINCT lower(trim(incident_uid)) AS u FROM incidents WHERE trim(incident_uid) <> ''),
l AS (SELECT DISTINCT lower(trim(incident_uid)) AS a, lower(trim(superseded_by)) AS b FROM incidents WHERE lower(trim(superseded_by)) IN (SELECT u FROM r)),
e AS (SELECT a, b FROM l WHERE a <> b UNION SELECT b, a FROM l WHERE a <> b),
reach AS (SELECT a AS n, a AS m FROM e UNION SELECT reach.n, e.b FROM reach JOIN e ON reach.m = e.a)
SELECT n AS incident_uid, min(m) AS group_uid FROM reach GROUP BY n
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p2_found": p2_found, "p3_found": p3_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_levels": p10_levels}


def oracle_sql() -> dict[str, str]:
    return {"p3_found": P3_SQL}
