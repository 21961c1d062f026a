"""Mixing sources to target weights (problem 9).

Each document of a source gets the same expected number of copies; its whole
part is fixed and its fraction is rounded by pivotal dependent rounding: two
fractions meet, and mass (weighted by the documents' sizes) is moved from one
to the other at random until one of them is whole.  Expected copies are kept
exactly and the size of the source but for one last document.

Every task rounds the documents it holds; at most one fraction a source and
task is left.  These residuals are combined in a reduction tree of fixed
fan-in, so neither a hot source nor their number ever meets in one task.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.encode import encode_documents
from daybook.session import BLANKS, bounded_rows, cut_lineage

#: Residuals that meet in one task of the reduction tree.
FAN_IN = 64
#: Most sources of a mix.
SOURCE_BOUND = 100_000
#: Documents sorted by size at a time within a task.
BLOCK = 20_000
#: A document of more than this share of all smaller ones of its block is too large to be paired with a single other.
LARGE_SHARE = 0.002
_EDGE = 1e-9


def source_key(name: Column) -> Column:
    """Source names without regard to letter case, surrounding blanks and the character that joins words."""
    return F.regexp_replace(F.lower(F.btrim(name, F.lit(BLANKS))), r"[\s_\-./]+", "_")


def pivot(a: tuple, b: tuple, seed: int) -> tuple[tuple, tuple]:
    """One pivotal step between (id, size, fraction) ``a`` and ``b``: at least one fraction becomes 0 or 1.

    size_a * fraction_a + size_b * fraction_b stays as it is, and so do both
    expected fractions.  The outcome depends on the seed and the two ids only.
    """
    (i, s, p), (j, t, q) = a, b
    up = min(1 - p, q * t / s)  # p rises by this much, or
    down = min(p, (1 - q) * t / s)  # falls by this much
    draw = random.Random(hashlib.blake2b(f"{seed}|{i}|{j}".encode(), digest_size=8).digest()).random()
    if draw * (up + down) < down:
        p, q = p + up, q - up * s / t
    else:
        p, q = p - down, q + down * s / t
    return (i, s, _snap(p)), (j, t, _snap(q))


def _snap(p: float) -> float:
    return 0.0 if p < _EDGE else 1.0 if p > 1 - _EDGE else p


def round_fractions(items: list[tuple], seed: int) -> tuple[list[tuple], tuple | None]:
    """(id, 0 or 1) of all items but one residual (id, size, fraction), or None where nothing is left over."""
    settled, held = [], None
    for item in items:
        if item[2] in (0.0, 1.0):
            settled.append((item[0], int(item[2])))
            continue
        if held is None:
            held = item
            continue
        pair = pivot(held, item, seed)
        held = None
        for x in pair:
            if x[2] in (0.0, 1.0):
                settled.append((x[0], int(x[2])))
            else:
                held = x
    return settled, held


def round_pool(items: list[tuple], seed: int, large: float = LARGE_SHARE) -> tuple[list[tuple], tuple | None]:
    """Like :func:`round_fractions` for items that all have one fraction, largest first.

    Items are paired one to one, each with the next smaller one.  Only an item
    that outweighs ``large`` of all smaller ones together would then be left
    for the end, as no single other can make up for it; it meets the pool of all
    smaller ones instead, whose common fraction takes up the mass it gives or
    takes.
    """
    settled, q = [], items[0][2] if items else 0.0
    rest = sum(x[1] for x in items)
    for k, (i, s, _) in enumerate(items):
        rest -= s
        if q in (0.0, 1.0):
            return settled + [(x[0], int(q)) for x in items[k:]], None
        if k == len(items) - 1:
            return settled, (i, s, q)
        if s <= large * rest:
            paired, left = round_fractions([(x[0], x[1], q) for x in items[k:]], seed)
            return settled + paired, left
        (_, _, p), (_, _, q) = pivot((i, s, q), (f"{i}+", rest, q), seed)
        if p in (0.0, 1.0):
            settled.append((i, int(p)))
        else:
            settled += [(x[0], int(q)) for x in items[k + 1 :]]
            return settled, (i, s, p)
    return settled, None


def _map_side(seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple]] = {}
        part = TaskContext.get().partitionId()
        for pdf in batches:
            out: list[tuple] = []
            for start in range(0, len(pdf), BLOCK):
                block = pdf.iloc[start : start + BLOCK].sort_values(["size", "record"], ascending=[False, True], kind="stable")
                by_source: dict[str, list] = {}
                for record, source, size, fraction in zip(block["record"], block["source"], block["size"], block["fraction"], strict=True):
                    by_source.setdefault(source, []).append((int(record), float(size), _snap(float(fraction))))
                for source, items in by_source.items():
                    one = len({x[2] for x in items}) == 1
                    settled, left = (round_pool if one else round_fractions)(items, seed)
                    out.extend((r, source, 0.0, float(x), True, part) for r, x in settled)
                    if left:
                        held.setdefault(source, []).append(left)
            yield _frame(out)
        out = []
        for source, items in held.items():
            settled, left = round_fractions(sorted(items, key=lambda x: (-x[1], x[0])), seed)
            out.extend((r, source, 0.0, float(x), True, part) for r, x in settled)
            if left:
                out.append((left[0], source, left[1], left[2], False, part))
        yield _frame(out)

    return run


_STEP = "record bigint, source string, size double, fraction double, settled boolean, part int"
_STEP_COLUMNS = ["record", "source", "size", "fraction", "settled", "part"]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    types = {"record": "int64", "source": "object", "size": "float64", "fraction": "float64", "settled": "bool", "part": "int32"}
    return pd.DataFrame(rows, columns=_STEP_COLUMNS).astype(types)


def _tree_step(seed: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "record"], ascending=[False, True])
        source, part = pdf["source"].iloc[0], int(pdf["part"].min())
        settled, left = round_fractions([(int(r), float(s), float(f)) for r, s, f in zip(pdf["record"], pdf["size"], pdf["fraction"], strict=True)], seed)
        rows = [(r, source, 0.0, float(x), True, part) for r, x in settled]
        if left:
            r, size, fraction = left
            draw = random.Random(hashlib.blake2b(f"{seed}|{r}|last".encode(), digest_size=8).digest()).random()
            rows.append((r, source, 0.0, float(draw < fraction), True, part) if last else (r, source, size, fraction, False, part))
        return _frame(rows)

    return run


def dependent_rounding(fractions: DataFrame, seed: int = 17, fan_in: int = FAN_IN) -> DataFrame:
    """record and extra (0 or 1) of rows (record, source, size, fraction), rounded within each source."""
    step = cut_lineage(fractions.select("record", "source", "size", "fraction").mapInPandas(_map_side(seed), _STEP))
    done = [step.filter("settled")]
    left = step.filter("NOT settled")
    width = max(1, step.rdd.getNumPartitions())
    while True:
        last = width <= fan_in
        left = left.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        width = -(-width // fan_in)
        step = cut_lineage(left.groupBy("source", "part").applyInPandas(_tree_step(seed, last), _STEP))
        done.append(step.filter("settled"))
        if last:
            break
        left = step.filter("NOT settled")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("record", F.col("fraction").cast("int").alias("extra"))


def mix_plan(sized: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """A row a source: source, target_share, max_repeats, available, wanted and copies (expected copies of each document).

    Without ``total`` the mix is as large as the caps allow: the first source
    that would need more than max_repeats copies of its documents sets it.  A
    larger ``total`` is brought down to that size.  A wanted source without any
    token can't be reached at whatever size; it doesn't count for the size, and
    the other sources keep their proportions.  A source with a target or a cap
    of 0 has a row with 0 copies.
    """
    want = targets.select(source_key(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).filter("source IS NOT NULL").fillna(0, ["target_share", "max_repeats"])
    want = want.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = sized.groupBy("source").agg(F.sum("size").alias("available"))
    plan = want.join(have, "source", "left").fillna(0, ["available"])
    wanted = (F.col("available") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    room = F.min(F.when(wanted, F.col("available") * F.col("max_repeats") / F.col("target_share")))
    plan = plan.withColumn("room", room.over(Window.partitionBy()))  # a row a source
    size = F.col("room") if total is None else F.least(F.col("room"), F.lit(float(total)))
    copies = F.when(wanted, F.least(F.col("max_repeats").cast("double"), F.col("target_share") * size / F.col("available"))).otherwise(0.0)
    return plan.select("source", "target_share", "max_repeats", "available", F.coalesce(F.col("target_share") * size, F.lit(0.0)).alias("wanted"), copies.alias("copies"))


def mix_documents(documents: DataFrame, targets: DataFrame, path: str | None = None, total: float | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix and its report.

    The mix has a row a document: doc_id, source (plain), n_tokens and copies
    (0 to max_repeats).  Documents without tokens, of no source or of a source
    without a target are in it with 0 copies.  The report has a row a source:
    target_share, max_repeats, available tokens, reached tokens and
    reached_share.  Empty tables give an empty mix.
    """
    sized = encode_documents(documents.select("doc_id", "text", source_key(F.col("source")).alias("source")), path=path, lengths_only=True, keep=("source",))
    sized = cut_lineage(sized.select("doc_id", "source", F.col("n_tokens").alias("size")))
    plan = cut_lineage(mix_plan(sized, targets, total))
    bounded_rows(plan.select("source"), SOURCE_BOUND, "the plan of the mix")
    with_copies = sized.join(F.broadcast(plan.select("source", "copies")), "source", "left").withColumn("copies", F.when(F.col("size") > 0, F.coalesce("copies", F.lit(0.0))).otherwise(0.0))
    # Numbers of rows, not doc_ids, as a repeated document is rounded by itself.
    with_copies = with_copies.withColumn("record", F.monotonically_increasing_id()).withColumn("whole", F.floor(F.col("copies") + F.lit(_EDGE)))
    fractions = with_copies.select("record", "source", "size", F.greatest(F.lit(0.0), F.col("copies") - F.col("whole")).alias("fraction"))
    extra = dependent_rounding(fractions.filter(F.col("fraction") > _EDGE), seed)
    mix = with_copies.join(extra, "record", "left").select("doc_id", "source", F.col("size").alias("n_tokens"), (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies"))
    mix = cut_lineage(mix)
    reached = mix.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("reached"))
    report = plan.join(reached, "source", "left").withColumn("all", F.sum("reached").over(Window.partitionBy()))  # a row a source
    report = report.select("source", "target_share", "max_repeats", "available", F.coalesce("reached", F.lit(0)).alias("reached"), F.when(F.col("all") > 0, F.coalesce("reached", F.lit(0)) / F.col("all")).otherwise(0.0).alias("reached_share"))
    return mix, report
