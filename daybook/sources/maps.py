"""Reference lists: reading, checking and turning them into lookup columns."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.tokens import fold_token
from daybook.session import bounded_rows

#: Most entries of a reference list.
LIST_BOUND = 20_000


class MappingError(ValueError):
    """A reference list contradicts itself, or lacks a token that has to be in it."""


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """A CSV list with ``#`` comment lines; a row of the wrong width is an error."""
    return spark.read.csv(path, header=True, comment="#", quote='"', escape='"', mode="FAILFAST", enforceSchema=False)


def contradictions(entries: DataFrame, key: str = "raw_token") -> DataFrame:
    """Folded keys whose spellings disagree in anything but notes: folded, spellings."""
    told = [c for c in entries.columns if c not in (key, "notes")]
    versions = F.count_distinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in told]))
    grouped = entries.groupBy(fold_token(F.col(key)).alias("folded")).agg(versions.alias("versions"), F.array_sort(F.collect_set(key)).alias("spellings"))
    return grouped.filter("versions > 1").select("folded", "spellings")


def lookup_column(entries: DataFrame, values: str | None, key: str = "raw_token", role: str = "token_role") -> Column:
    """The list as a literal map column: folded key -> struct(role, values), or -> value where ``values`` is given with no role.

    Raises :class:`MappingError` where spellings of one key disagree, and
    ``ValueError`` where the list is not small.
    """
    wrong = contradictions(entries, key).limit(20).collect()
    if wrong:
        raise MappingError(f"spellings disagree: {[r['spellings'] for r in wrong]}")
    has_role = role in entries.columns
    picked = entries.select(fold_token(F.col(key)).alias("k"), (F.col(role) if has_role else F.lit(None)).alias("r"), F.col(values).alias("v")).dropDuplicates(["k"])
    rows = bounded_rows(picked, LIST_BOUND, "the reference list")
    # A text literal, which the optimizer folds into one map: much smaller in the plan than a map built entry by entry.
    if has_role:
        entries_of = {k: {"role": r, "values": [x for x in (v or "").split("|") if x]} for k, r, v in rows}
        kind = "map<string,struct<role:string,values:array<string>>>"
    else:
        entries_of, kind = {k: v for k, _, v in rows}, "map<string,string>"
    return F.from_json(F.lit(json.dumps(entries_of)), kind)


def unmapped_tokens(tokens: DataFrame, entries: DataFrame, key: str = "raw_token") -> DataFrame:
    """Every token the list lacks, with how often it comes: token, n.  ``tokens`` has a column token."""
    known = entries.select(fold_token(F.col(key)).alias("folded")).distinct()
    return tokens.filter("token IS NOT NULL AND token <> ''").join(F.broadcast(known) if known.limit(LIST_BOUND + 1).count() <= LIST_BOUND else known, fold_token(F.col("token")) == F.col("folded"), "left_anti").groupBy("token").agg(F.count("*").alias("n"))


def require_mapped(tokens: DataFrame, entries: DataFrame, key: str = "raw_token") -> None:
    """Raises with all tokens the list lacks (the strict mode), not with the first one only."""
    missing = [r["token"] for r in unmapped_tokens(tokens, entries, key).orderBy("token").limit(200).collect()]
    if missing:
        raise MappingError(f"tokens without an entry: {missing}")
