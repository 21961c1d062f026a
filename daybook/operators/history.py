"""History of a changing attribute with the period of each version (problem 4).

Updates are laid out as unit intervals (one value an entity and day) and
neighbouring runs are merged pairwise over a logarithmic number of rounds;
where two runs meet on equal values they become one interval.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.change_feed import settled_events

RUN = "array<struct<since:date,value:string>>"


def _join_runs(left: Column, right: Column) -> Column:
    """``left`` followed by ``right``; equal values at the seam make one interval."""
    same = F.try_element_at(left, F.lit(-1))["value"].eqNullSafe(F.try_element_at(right, F.lit(1))["value"])
    meets = (F.size(left) > 0) & (F.size(right) > 0) & same
    return F.concat(left, F.when(meets, F.slice(right, F.lit(2), F.greatest(F.size(right), F.lit(1)))).otherwise(right))


def coalesce_runs(units: DataFrame, most: int) -> DataFrame:
    """Tree reduction of unit intervals into runs of different values.

    ``units`` has uid, place (0, 1, ... within the uid, at most ``most`` of
    them), since (date) and value.  Returns uid and runs, an array of (since,
    value) in order.  Every round joins the runs at places 2k and 2k + 1; with
    the rows hashed by uid beforehand no round moves any data.
    """
    runs = units.select("uid", F.col("place").cast("int").alias("place"), F.array(F.struct("since", "value")).cast(RUN).alias("run"))
    for _ in range(max(1, math.ceil(math.log2(max(2, most))))):
        pair = F.sort_array(F.collect_list(F.struct("place", "run")))
        runs = runs.groupBy("uid", F.shiftright("place", 1).alias("half")).agg(pair.alias("pair"))
        merged = F.aggregate("pair", F.array().cast(RUN), lambda run, x: _join_runs(run, x["run"]))
        runs = runs.select("uid", F.col("half").alias("place"), merged.alias("run"))
    return runs.select("uid", F.col("run").alias("runs"))


def attribute_history(changelog: DataFrame, field: str = "disposition_raw") -> DataFrame:
    """Versions of ``field`` of each record that had at least two.

    Returns incident_uid, valid_from, valid_to (yyyy-MM-dd, empty for the last
    version) and the value under the name ``field``.  The first version holds
    from the day of the record's first ``added`` event and has the old value of
    its first amendment that counts; of several amendments of a day the last holds; equal
    values (nulls are equal) open no version.  Amendments of a record that is
    not in force count as little as in :func:`current_state`.  A version that
    holds for no day (the first one of a record amended on the day it came in)
    is none.  An empty feed gives an empty result.
    """
    events = settled_events(changelog, "field_name", "old_value", "new_value")
    amended = (F.col("kind") == "amended") & (F.lower(F.btrim(F.col("field_name"))) == field)
    events = events.filter(F.col("kind").isin("added", "source_removed") | amended)

    # One row a record and day: what a single day does is settled before anything is ordered over days, so a record
    # with a large part of all events is spread over its days, and no day's events are gathered in one value.
    is_amended = F.col("kind") == "amended"
    within = Window.partitionBy("uid", "day").orderBy(F.col("run").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    events = events.withColumn("mark", F.last(F.when(~is_amended, F.col("kind")), ignorenulls=True).over(within))
    at = lambda when, name, of: F.when(when, F.struct("run", F.col(name).alias("value"))).alias(of)
    fresh = is_amended & (F.col("mark") == "added")
    open_ = is_amended & (F.col("mark").isNull() | (F.col("mark") == "added"))
    sides = events.select("uid", "day", at(~is_amended, "kind", "m"), at(fresh, "old_value", "fresh_old"), at(fresh, "new_value", "fresh_new"), at(open_, "old_value", "open_old"), at(open_, "new_value", "open_new"))
    days = sides.groupBy("uid", "day").agg(
        F.max("m").alias("m"), F.max(F.col("m.value") == "added").alias("enters"),
        F.min("fresh_old").alias("fresh_old"), F.max("fresh_new").alias("fresh_new"), F.min("open_old").alias("open_old"), F.max("open_new").alias("open_new"),
    )
    by_day = Window.partitionBy("uid").orderBy("day")
    alive = F.coalesce(F.last("m.value", ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, -1)) == "added", F.lit(False))
    days = days.withColumns({"alive": alive, "entered": F.min(F.when(F.col("enters"), F.col("day"))).over(Window.partitionBy("uid"))})
    first, last = (F.when(F.col("alive"), F.col(f"open_{x}")).otherwise(F.col(f"fresh_{x}")) for x in ("old", "new"))
    days = days.select("uid", "day", "entered", first.alias("first"), last.alias("last")).filter("last IS NOT NULL")
    days = days.withColumn("nth", F.row_number().over(by_day))
    unit = F.struct(F.col("nth").alias("place"), F.col("day").alias("since"), F.col("last.value").alias("value"))
    opening = F.struct(F.lit(0).alias("place"), F.col("entered").alias("since"), F.col("first.value").alias("value"))
    units = days.select("uid", F.inline(F.when(F.col("nth") == 1, F.array(opening, unit)).otherwise(F.array(unit))))

    span = changelog.agg(F.min("observed_date"), F.max("observed_date")).first()
    most = 2 if span[0] is None else (span[1] - span[0]).days + 2
    runs = coalesce_runs(units, most)
    held = F.filter("runs", lambda r, i: ~r["since"].eqNullSafe(F.try_element_at(F.col("runs"), i + 2)["since"]))
    runs = runs.select("uid", held.alias("runs")).filter(F.size("runs") > 1)
    until = F.transform("runs", lambda r, i: F.struct(r["since"].alias("since"), r["value"].alias("value"), F.try_element_at(F.col("runs"), i + 2)["since"].alias("until")))
    day_text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return runs.select("uid", F.inline(until)).select(
        F.col("uid").alias("incident_uid"),
        day_text("since").alias("valid_from"),
        F.coalesce(day_text("until"), F.lit("")).alias("valid_to"),
        F.col("value").alias(field),
    )
