"""Mixing sources to target weights: subset-sum budgets over exact document lengths.

1. Every source gets a target: a share of all words by weight, at most ``max_repeats`` times its own
   words; what is above is shared out again by weight (``source_targets``).
2. Whole copies of a source fill its target as far as they fit. The rest of the budget is filled with
   documents counted by exact length: the same fraction of each length first, and the few words that
   are then left by a bounded-knapsack dynamic program over the lengths, in which a document may be taken
   as often as the limit of repeats leaves open (``fill_budget``).
3. Which documents of a length are taken is decided by a seeded hash (``mix``).

Only counts per (source, length) meet in one task, never documents. A source of A words has at most
sqrt(2 A) distinct lengths. Documents are ranked inside (source, length, slice of the hash range), with
about as many slices as the root of the number of rows, so a source or a length that holds a third of
all rows is ranked by many tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.names import own_names
from lodestrata.operators.keys import dense_key
from lodestrata.sources.staging import stage

# A word is a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Words that the dynamic program may place; what is above is first taken greedily, longest first.
DYNAMIC_WORDS = 1 << 16

SIZE, SOURCE_SIZE, TARGET, COPIES, TAKEN = "size", "source_size", "target", "copies", "taken"
ADDED = (SIZE, SOURCE_SIZE, TARGET, COPIES, TAKEN)


def n_words(text: str):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _reachable(lengths: np.ndarray, counts: np.ndarray, budget: int, limit: int):
    """For each sum up to ``limit`` the item that first reached it (-1: none), and the items.

    Counts are split into powers of two, so an item is (place in ``lengths``, copies) and used once.
    Stops as soon as ``budget`` itself is reached.
    """
    by = np.full(limit + 1, -1, dtype=np.int64)
    seen = np.zeros(limit + 1, dtype=bool)
    seen[0] = True
    items: list[tuple[int, int]] = []
    for place, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        left, part = min(count, limit // length), 1
        while left > 0 and not seen[budget]:
            copies = min(part, left)
            step = length * copies
            new = seen[:-step] & ~seen[step:]
            by[step:][new] = len(items)
            seen[step:] |= new
            items.append((place, copies))
            left, part = left - copies, part * 2
        if seen[budget]:
            break
    return seen, by, items


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, repeats: int = 1) -> np.ndarray:
    """How many documents of each length to take, so that their words come nearest to ``budget``.

    ``lengths`` are distinct and positive, ``budget`` at most all their words. Never above ``counts`` times
    ``repeats``.
    """
    order = np.argsort(-lengths, kind="stable")
    lengths, counts = lengths[order], counts[order]
    most = counts * repeats
    total = int((lengths * counts).sum())
    taken = np.zeros_like(counts)
    if total and budget > 0:
        whole = np.array([c * budget // total for c in counts.tolist()], dtype=counts.dtype)
        taken += whole
        left = budget - int((lengths * taken).sum())
        for i, length in enumerate(lengths.tolist()):
            if left <= DYNAMIC_WORDS:
                break
            more = min(int(most[i] - taken[i]), (left - DYNAMIC_WORDS) // length)
            taken[i] += more
            left -= more * length
        free = most - taken
        if left > 0 and free.any():
            # One document more than the budget may be nearer than any sum below it.
            limit = left + int(lengths[free > 0].min())
            usable = np.flatnonzero((free > 0) & (lengths <= limit))
            seen, by, items = _reachable(lengths[usable], free[usable], left, limit)
            sums = np.flatnonzero(seen)
            best = int(sums[np.argmin(np.abs(sums - left))])  # the smaller one of two equally near
            while best:
                place, copies = items[by[best]]
                taken[usable[place]] += copies
                best -= int(lengths[usable[place]]) * copies
    result = np.empty_like(taken)
    result[order] = taken
    return result


def source_targets(sources: DataFrame, weights: int, max_repeats: int) -> DataFrame:
    """``_key, source, source_size`` with ``target``: words each source should give.

    Weights run 1, 2, ... ``weights`` over the sources by code point, the missing source last. Targets
    share all words by weight and stop at ``max_repeats`` times the source's words; the excess is
    shared by weight among the others until no target is above. One small aggregate per round.
    """
    ordered = dense_key(
        sources.withColumn("_last", F.col("source").isNull().cast("int")), ["_last", "source"], "_rank", stored=True
    ).withColumn("_weight", (F.col("_rank") - 1) % weights + 1)
    ordered = stage(ordered)
    most = F.col(SOURCE_SIZE) * max_repeats
    share, closed = 0.0, -1
    while True:
        full = most < F.lit(share) * F.col("_weight")
        row = ordered.agg(
            F.sum(SOURCE_SIZE).alias("words"),
            F.sum(F.when(full, most).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0).otherwise(F.col("_weight"))).alias("weights"),
            F.sum(full.cast("int")).alias("closed"),
        ).first()
        if not row["words"] or not row["weights"] or row["closed"] == closed:
            break
        share, closed = (row["words"] - row["full"]) / row["weights"], row["closed"]
    target = F.least(most.cast("double"), F.lit(share) * F.col("_weight"))
    return ordered.select("_key", SOURCE_SIZE, target.alias(TARGET))


def _fill_source(rows: pd.DataFrame) -> pd.DataFrame:
    words, target = int(rows[SOURCE_SIZE].iloc[0]), float(rows[TARGET].iloc[0])
    goal = math.floor(target + 0.5)
    whole = goal // words
    counts, open_repeats = rows["_rows"].to_numpy(), max(1, int(rows["_most"].iloc[0]) - whole)
    taken = fill_budget(rows[SIZE].to_numpy(), counts, goal - whole * words, open_repeats)
    return rows[["_key", SIZE]].assign(_whole=whole + taken // counts, _extra=taken % counts)


@own_names
def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: int = 3,
    max_repeats: int = 3,
    seed: int = 17,
) -> DataFrame:
    """The rows with ``size`` (words), ``source_size``, ``target``, ``copies`` (times the mix holds the
    row) and ``taken`` (``copies`` times ``size``).

    No row has more than ``max_repeats`` copies. A text that is missing, empty or white space has size 0
    and no copies. A missing source is a source of its own. Rows with the same id, text and source are
    alike, so it does not matter which of them is taken; a missing id is allowed. Columns of the input
    that are named as an added one are replaced. An empty table gives an empty result.

    ``docs`` is read twice: for the counts and for the rows.
    """
    plain = docs.drop(*(c for c in docs.columns if c.lower() in ADDED))
    slices = max(1, math.isqrt(plain.count()))
    chance = F.xxhash64(F.lit(seed), F.col(id), F.col(text))
    sized = (
        plain.withColumn(SIZE, n_words(text))
        .withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")))
        .withColumn("_chance", chance)
        .withColumn("_slice", F.pmod(F.shiftrightunsigned("_chance", 16), F.lit(slices)).cast("int"))
    )
    counts = stage(
        sized.withColumn("source", F.col(source))
        .groupBy("_key", "source", SIZE, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    words = F.sum(F.col(SIZE) * F.col("_rows")).alias(SOURCE_SIZE)
    targets = stage(source_targets(counts.groupBy("_key", "source").agg(words), weights, max_repeats))
    lengths = counts.filter(F.col(SIZE) > 0).groupBy("_key", SIZE).agg(F.sum("_rows").alias("_rows"))
    takes = stage(
        lengths.join(targets, "_key")
        .withColumn("_most", F.lit(max_repeats))
        .groupBy("_key")
        .applyInPandas(_fill_source, "_key string, size long, _whole long, _extra long")
    )
    before = Window.partitionBy("_key", SIZE).orderBy("_slice")
    earlier = F.sum("_rows").over(before) - F.col("_rows")
    of_slice = F.greatest(F.lit(0), F.least(F.col("_rows"), F.coalesce("_extra", F.lit(0)) - earlier))
    plan = (
        counts.select("_key", SIZE, "_slice", "_rows")
        .join(targets, "_key")
        .join(takes, ["_key", SIZE], "left")
        .select(
            "_key", SIZE, "_slice", SOURCE_SIZE, TARGET,
            F.coalesce("_whole", F.lit(0)).alias("_whole"),
            of_slice.alias("_of_slice"),
        )
    )
    place = F.row_number().over(Window.partitionBy("_key", SIZE, "_slice").orderBy("_chance", id))
    copies = (F.col("_whole") + (F.col("_place") <= F.col("_of_slice")).cast("long")).alias(COPIES)
    return (
        sized.withColumn("_place", place)
        .join(plan, ["_key", SIZE, "_slice"])
        .select(*plain.columns, SIZE, SOURCE_SIZE, TARGET, copies)
        .withColumn(TAKEN, F.col(COPIES) * F.col(SIZE))
    )
