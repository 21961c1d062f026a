"""What changed between consecutive full snapshots (problem 7).

EXCEPT ALL in both directions is taken in one pass: rows of a snapshot count
+1, rows of the one before -1, and the signed count of each distinct row is
what EXCEPT ALL leaves of it on either side.  Only these residues meet in the
full join by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import BLANKS, clean_key

#: Most snapshots for which their order is sent to every task.
SNAPSHOT_BOUND = 20_000


def _packed(text: Column, digits: int) -> Column:
    """Hexadecimal text of the usual length in half its bytes; other text as it is, apart by its length."""
    return F.when(text.rlike(f"^[0-9a-f]{{{digits}}}$"), F.unhex(text)).otherwise(F.concat(F.lit(b"\x00"), F.encode(text, "utf-8"), F.lit(b"\x00" * digits)))


def _value(name: str) -> Column:
    """Text compared without letter case and surrounding blanks; null stays a value of its own."""
    return F.lower(F.btrim(F.col(name), F.lit(BLANKS)))


def snapshot_changes(snapshots: DataFrame, key: str = "incident_uid", order: tuple[str, str] = ("snapshot_date", "snapshot_seq"), row: str = "source_row_index", compared: tuple[str, ...] = ("content_hash", "status")) -> DataFrame:
    """Records added, removed and changed against the preceding snapshot.

    Returns snapshot_date, snapshot_seq, incident_uid (clean), change_kind.  Of
    a key's rows in one snapshot the one with the largest ``row`` holds (ties:
    the largest values).  The first snapshot has no changes; rows without a key
    or a snapshot date are no records; a null in ``compared`` is a value of its
    own.  A snapshot without any row does not exist and so removes nothing.
    """
    day, seq = order
    picked = snapshots.select(
        F.col(day).alias("day"),
        F.col(seq).alias("seq"),
        clean_key(key).alias("uid"),
        F.struct(F.col(row).alias("at"), *[(_packed(_value(c), 64) if c == "content_hash" else _value(c)).alias(f"c{i}") for i, c in enumerate(compared)]).alias("version"),
    ).filter("uid IS NOT NULL AND day IS NOT NULL")
    values = [f"c{i}" for i in range(len(compared))]
    states = picked.groupBy("day", "seq", "uid").agg(F.max("version").alias("version")).select("day", "seq", "uid", *[f"version.{c}" for c in values])

    named = snapshots.filter(F.col(day).isNotNull()).select(F.col(day).alias("day"), F.col(seq).alias("seq")).distinct()
    by_time = Window.orderBy("day", "seq")  # one row per snapshot
    named = named.select("day", "seq", F.row_number().over(by_time).alias("number"), F.lead(F.struct("day", "seq")).over(by_time).alias("next"))
    bound = named.limit(SNAPSHOT_BOUND + 1).count()
    named = F.broadcast(named) if bound <= SNAPSHOT_BOUND else named
    states = states.join(named.withColumnsRenamed({"day": "d", "seq": "q"}), (F.col("day") == F.col("d")) & F.col("seq").eqNullSafe(F.col("q")))

    sides = F.array(
        F.when(F.col("number") > 1, F.struct(F.col("day"), F.col("seq"), F.lit(1).alias("sign"))),
        F.when(F.col("next").isNotNull(), F.struct(F.col("next.day").alias("day"), F.col("next.seq").alias("seq"), F.lit(-1).alias("sign"))),
    )
    signed = states.select("uid", *values, F.explode(F.filter(sides, lambda s: s.isNotNull())).alias("side")).select("side.day", "side.seq", "side.sign", "uid", *values)
    residue = signed.groupBy("day", "seq", "uid", *values).agg(F.sum("sign").alias("left_over")).filter("left_over <> 0")

    # Full join of both residues by key: at most one row a side, so presence is all it has to tell.
    joined = residue.groupBy("day", "seq", "uid").agg(F.max(F.col("left_over") > 0).alias("now"), F.max(F.col("left_over") < 0).alias("before"))
    return joined.select(
        F.date_format("day", "yyyy-MM-dd").alias("snapshot_date"),
        F.col("seq").alias("snapshot_seq"),
        F.col("uid").alias("incident_uid"),
        F.when(F.col("now") & F.col("before"), "changed").when(F.col("now"), "added").otherwise("removed").alias("change_kind"),
    )
