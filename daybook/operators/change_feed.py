"""Applying a feed of inserts, updates and deletes (problem 6).

The feed is stored the way equality-delete tables are: an insert file of
versioned cells and a delete file of keys, both carrying a sequence number.  A
reader drops every insert that has a later delete of the same key (an
anti-join) and keeps the newest surviving cell of each column.

No step sorts the events of one key: every step is an aggregation with
map-side combining or an anti-join against one row per key, salted so that a
key with a large part of all events is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import clean_key

#: Event types and the status each sets.
STATUS_OF = {
    "added": "active",
    "missing": "missing",
    "withdrawn": "withdrawn",
    "reappeared": "active",
    "superseded_identity": "superseded",
}
#: Slices of a key in the anti-join; the delete file is repeated as often.
SALT = 8


def sequence_number(day: Column, run: Column) -> Column:
    """One ascending number for (day, run); a null run comes first in its day."""
    low = F.coalesce(run.cast("long") + F.lit(2**31), F.lit(0))
    return F.unix_date(day).cast("long") * F.lit(2**32) + low


def settled_events(changelog: DataFrame, *payload: str) -> DataFrame:
    """One row per (uid, day, run): of repeated deliveries the largest log_pos holds.

    Deliveries without an uid or a day name no event and are left out.  Exact
    repeats collapse; of rows alike even in log_pos the largest payload holds.
    Returns uid, day, run, kind and the payload columns.
    """
    kind = F.lower(F.btrim(F.col("change_type")))
    picked = changelog.select(
        clean_key("incident_uid").alias("uid"),
        F.col("observed_date").alias("day"),
        F.col("run_seq").alias("run"),
        F.struct(F.col("log_pos"), kind.alias("kind"), *[F.col(p) for p in payload]).alias("delivery"),
    ).filter("uid IS NOT NULL AND day IS NOT NULL")
    return picked.groupBy("uid", "day", "run").agg(F.max("delivery").alias("delivery")).select("uid", "day", "run", "delivery.kind", *[f"delivery.{p}" for p in payload])


_PAYLOAD = ("revision", "source_file_id", "to_file_id")


def current_state(changelog: DataFrame, salt: int = SALT) -> DataFrame:
    """Records in force after all events: incident_uid, status, revision, source_file_id.

    An ``added`` event brings a record in and sets all three columns, so of the
    events after a key's last delete the newest of each column is the state; a
    key without a surviving ``added`` is not in force.  An empty feed gives an
    empty result; unknown event types and null columns change nothing but what
    they say (``added`` with a null revision sets null).
    """
    events = settled_events(changelog, *_PAYLOAD)
    events = events.withColumn("seq", sequence_number(F.col("day"), F.col("run")))
    return state_of(*_files(events), salt)


def _files(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The insert file (versioned cells) and the delete file (keys) of settled events."""
    inserts = events.filter(F.col("kind").isin(*STATUS_OF, "amended", "relocated"))
    return inserts.select("uid", "seq", "kind", *_PAYLOAD), events.filter("kind = 'source_removed'").select("uid", "seq")


def state_of(inserts: DataFrame, deletes: DataFrame, salt: int = SALT) -> DataFrame:
    """The state that an insert file and a delete file stand for: inserts with a later delete of their key drop out, the newest cells hold."""
    deletes = deletes.groupBy("uid").agg(F.max("seq").alias("deleted_at"))
    deletes = deletes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    inserts = inserts.withColumn("slice", F.pmod(F.hash("seq"), F.lit(salt)))
    live = inserts.alias("i").join(
        deletes.alias("d"),
        (F.col("i.uid") == F.col("d.uid")) & (F.col("i.slice") == F.col("d.slice")) & (F.col("i.seq") <= F.col("d.deleted_at")),
        "left_anti",
    )
    kind = F.col("kind")
    status = F.create_map(*[F.lit(x) for pair in STATUS_OF.items() for x in pair])
    cell = lambda when, value: F.max(F.when(when, F.struct(F.col("seq"), value.alias("value"))))
    return (
        live.groupBy("uid")
        .agg(
            F.max(kind == "added").alias("in_force"),
            cell(kind.isin(*STATUS_OF), F.try_element_at(status, kind)).alias("s"),
            cell(kind.isin("added", "amended"), F.col("revision")).alias("r"),
            cell(kind.isin("added", "relocated"), F.when(kind == "added", F.col("source_file_id")).otherwise(F.col("to_file_id"))).alias("f"),
        )
        .filter("in_force")
        .select(F.col("uid").alias("incident_uid"), F.col("s.value").alias("status"), F.col("r.value").alias("revision"), F.col("f.value").alias("source_file_id"))
    )


def append_feed(folder: str, changelog: DataFrame) -> None:
    """Appends the deliveries of a feed to the insert files and the delete files below ``folder``.

    Both keep the place of a delivery in the log, as a later one may correct an
    earlier one of another kind; nothing that was written is changed.
    """
    kind = F.lower(F.btrim(F.col("change_type")))
    rows = changelog.select(clean_key("incident_uid").alias("uid"), sequence_number(F.col("observed_date"), F.col("run_seq")).alias("seq"), "log_pos", kind.alias("kind"), *_PAYLOAD).filter("uid IS NOT NULL AND seq IS NOT NULL")
    gone = F.coalesce(F.col("kind") == "source_removed", F.lit(False))
    rows.filter(~gone).write.mode("append").parquet(f"{folder}/inserts")
    rows.filter(gone).select("uid", "seq", "log_pos", "kind").write.mode("append").parquet(f"{folder}/deletes")


def read_feed(spark: SparkSession, folder: str, salt: int = SALT) -> DataFrame:
    """The state that the files below ``folder`` stand for; the same as :func:`current_state` of all that was appended."""
    both = spark.read.parquet(f"{folder}/inserts").unionByName(spark.read.parquet(f"{folder}/deletes"), allowMissingColumns=True)
    delivery = F.struct("log_pos", "kind", *_PAYLOAD)
    settled = both.groupBy("uid", "seq").agg(F.max(delivery).alias("d")).select("uid", "seq", "d.kind", *[f"d.{p}" for p in _PAYLOAD])
    return state_of(*_files(settled), salt)
