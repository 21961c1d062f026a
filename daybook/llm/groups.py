"""Consolidating pairwise matches into groups (problem 3).

Minimum labels are propagated across edges and accelerated by pointer jumping:
every round, each label points to its smallest neighbour, pointers jump to
their targets' targets until none changes (a step for each doubling of the
depth), and edges are drawn between the new labels.  Steps are written to the
checkpoint folder; rounds end when no edge joins different labels, that is when
no label can change.  Labels that still have an edge shrink at least by half
every two rounds: one that took in no other label has only neighbours that went
to smaller ones, so it goes to a smaller one itself in the next round.

A label may belong to any part of all rows.  Messages are combined before the
shuffle, and the joins on a label look up the hot ones (of which there can be
only a few, as each holds a fixed share of the rows) in a broadcast table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import Written, clean_key

#: A key with more than one row in this many is hot; so there are fewer hot keys than this.
HOT_SHARE = 500
#: Below so many rows no key is treated as hot.
HOT_LEAST = 50_000


def _hot_keys(rows: DataFrame, key: str, total: int) -> list:
    if total < HOT_LEAST:
        return []
    counted = rows.groupBy(F.col(key).alias("k")).count().filter(F.col("count") > max(HOT_LEAST // 10, total // HOT_SHARE))
    return [r["k"] for r in counted.select("k").collect()]  # fewer than HOT_SHARE


def look_up(rows: DataFrame, key: str, pointers: DataFrame, out: str, total: int) -> DataFrame:
    """``rows`` with the pointer of ``key`` (unique in ``pointers``: node, to) under the name ``out``.

    Keys without a pointer keep themselves.  Rows of hot keys meet a broadcast
    table of at most HOT_SHARE pointers and are not shuffled.
    """
    hot = _hot_keys(rows, key, total)

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
        return left.join(right, F.col(key) == F.col("_node"), "left").withColumn(out, F.coalesce("_to", key)).drop("_node", "_to")

    if not hot:
        return joined(rows, pointers)
    is_hot = F.col(key).isin(hot)
    return joined(rows.filter(~is_hot), pointers).unionByName(joined(rows.filter(is_hot), F.broadcast(pointers.filter(F.col("node").isin(hot)))))


def connected_groups(edges: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """node and label (the smallest node of its group) of every node of an edge.

    Loops and repeated edges, in either direction, count once; rows with a null
    end join nothing; an empty input gives an empty result.
    """
    a, b = F.col(left), F.col(right)
    pairs = edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    edges_of, kept = Written(edges.sparkSession), Written(edges.sparkSession)
    nodes = kept.write(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    rounds: list[tuple[Written, DataFrame, int]] = []
    pairs, seen = edges_of.write_counted(pairs, n=F.count(F.lit(1)))
    while count := seen["n"]:
        both = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).union(pairs.select(F.col("b"), F.col("a")))
        steps = Written(edges.sparkSession)
        pointers = steps.write(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("to")))
        moving = 1
        while moving:
            # There are at most two pointers an edge.
            jumped = look_up(pointers, "to", pointers, "next", 2 * count).select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moves"))
            pointers, jumps = steps.write_counted(jumped, moves=F.count_if("moves"))
            pointers, moving = pointers.select("node", "to"), jumps["moves"]
            steps.drop_before(1)
        rounds.append((steps, pointers, 2 * count))
        moved = look_up(look_up(pairs, "a", pointers, "x", count), "b", pointers, "y", count)
        pairs, seen = edges_of.write_counted(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), n=F.count(F.lit(1)))
        edges_of.drop_before(1)
    # The label of a node: where the pointers of all rounds take it, one after the other.
    labels = nodes.withColumn("label", F.col("node"))
    for _, pointers, most in rounds:
        labels = look_up(labels, "label", pointers, "next", most).select("node", F.col("next").alias("label"))
    labels = kept.write(labels)
    kept.drop_before(1)
    for tables in (edges_of, *(steps for steps, _, _ in rounds)):
        tables.drop_before(0)
    return labels


def superseded_groups(incidents: DataFrame, uid: str = "incident_uid", pointer: str = "superseded_by") -> DataFrame:
    """incident_uid and group_uid of every record tied to another one.

    A pointer links where the named record has a row; letter case and blanks
    don't matter; null, blank and unknown names and self references link
    nothing.  Repeated records are one.
    """
    records = incidents.select(clean_key(uid).alias("uid")).filter("uid IS NOT NULL").distinct()
    links = incidents.select(clean_key(uid).alias("left"), clean_key(pointer).alias("right")).filter("left <> right").distinct()
    named = links.join(records, F.col("right") == F.col("uid"), "left_semi")
    return connected_groups(named).select(F.col("node").alias("incident_uid"), F.col("label").alias("group_uid"))
