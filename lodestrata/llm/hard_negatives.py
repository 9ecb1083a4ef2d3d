"""Hard negatives of anchors, by slots between the upper limits of their positives.

An anchor's positives are its nearest other rows of the same label. Each positive opens a window of scores, a
share of its own score, and asks for the nearest rows of other labels inside it. Windows of one anchor overlap.

* **Slots.** The upper limits of an anchor's windows, in descending order, cut the scores into disjoint slots.
  What a window may return lies in the slot below its own limit and in the slots that follow.
* **Combiners.** Rows meet anchors block by block; a task keeps the best rows of each slot and nothing else, and
  Spark does the same over all tasks. So an anchor sends a few rows per task, however many lie in its windows.
* **Suffix merges.** The best of all slots, put together in descending order, hold every window's answer: the
  first ones from its slot on, down to its lower limit.

Anchors are a stated query set and meet all rows, in blocks: rows are dealt to shards and anchors to blocks of a
bounded size, by hash, so no group follows a label or a key. Scores are exact: products of whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.sources.staging import stage

POSITIVES, NEGATIVES = 5, 3
#: Percent of a positive's score between which its negatives lie.
LOW, HIGH = 50, 95
#: Rows of a shard and anchors of a block at most; rows of a shard from which more tasks are worth it.
SHARD, BLOCK, SMALL_SHARD = 16_384, 8_192, 512
#: Scores that are held at once.
AT_ONCE = 1 << 20

_EMPTY = pa.table({"a": pa.array([], pa.int64()), "mark": pa.array([], pa.int64()), "slot": pa.array([], pa.int32()),
                   "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
_FOUND = "a long, mark long, slot int, id long, score long"


def quantised(vectors: DataFrame, vector: str, scale: int = 256) -> DataFrame:
    """The rows with each component ``x`` of the vector as the whole number ``floor(scale * x)``.

    Vectors that are missing or hold missing or non-finite components become missing.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    plain = F.col(vector).cast("array<double>")
    whole = F.transform(plain, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    return vectors.withColumn(vector, F.when(~F.exists(plain, bad), whole))


def _matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors as rows of ``width`` columns, or of the longest one; missing ends are 0."""
    flat = column.combine_chunks()
    offsets = flat.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = flat.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64)
    longest = int(sizes.max(initial=0))
    width = longest if width is None else width
    if (sizes == longest).all():
        full = values.reshape(len(sizes), longest)
    else:
        full = np.zeros((len(sizes), longest), dtype=np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        full[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return full[:, :width] if longest >= width else np.pad(full, ((0, 0), (0, width - longest)))


def products(a: np.ndarray, x: np.ndarray) -> Callable[[slice], np.ndarray]:
    """Exact inner products of some rows of ``a`` with all of ``x``, by the fastest numbers that hold them."""
    most = lambda m: max(-int(m.min(initial=0)), int(m.max(initial=0)))
    bound = most(a) * most(x) * max(a.shape[1], 1)
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
    left, right = a.astype(kind), x.astype(kind).T

    def part(rows: slice) -> np.ndarray:
        scores = left[rows] @ right
        if kind is object and scores.size and max(-scores.min(), scores.max()) >= 1 << 63:
            raise OverflowError("inner products of these vectors do not fit 64 bits")
        return scores.astype(np.int64)

    return part


def best_of_groups(group: np.ndarray, score: np.ndarray, id: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each group: higher scores first, ties by smaller id."""
    order = np.lexsort((id, -score, group))
    ordered = group[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = ordered[1:] != ordered[:-1]
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else order
    return order[np.arange(len(order)) - start < k]


def _same_label(k: int) -> Callable:
    """A task's best ``k`` other rows of each anchor's label, all in slot 0."""

    def task(_, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _EMPTY
        a, a_ids, a_labels = _matrix(anchors["vec"]), anchors["id"].to_numpy(), anchors["label"].to_numpy()
        x, ids, labels = _matrix(rows["vec"], a.shape[1]), rows["id"].to_numpy(), rows["label"].to_numpy()
        marks, found = anchors["mark"].to_numpy(), []
        for label in np.intersect1d(a_labels, labels):
            asked, own = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
            scores_of = products(a[asked], x[own])
            step = max(1, AT_ONCE // len(own))
            for start in range(0, len(asked), step):
                some = asked[start : start + step]
                scores = scores_of(slice(start, start + step))
                other = a_ids[some][:, None] != ids[own]
                if len(own) > 4 * k:  # only what may be among the best k, ties included
                    ranked = np.where(other, scores, np.iinfo(np.int64).min)
                    other &= ranked >= np.partition(ranked, len(own) - k, axis=1)[:, len(own) - k, None]
                row, column = np.nonzero(other)
                score, id = scores[row, column], ids[own][column]
                best = best_of_groups(row, score, id, k)
                found.append((some[row[best]], id[best], score[best]))
        return _found(found, a_ids, marks)

    return task


def _by_slot(k: int) -> Callable:
    """A task's best ``k`` rows of other labels in each slot of each anchor."""

    def task(_, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _EMPTY
        a, a_ids, a_labels = _matrix(anchors["vec"]), anchors["id"].to_numpy(), anchors["label"].to_numpy()
        x, ids, labels = _matrix(rows["vec"], a.shape[1]), rows["id"].to_numpy(), rows["label"].to_numpy()
        limits = _matrix(anchors["limits"])  # descending; repeats of the last one where there are fewer
        counts = np.diff(anchors["limits"].combine_chunks().offsets.to_numpy())
        limits = np.where(np.arange(limits.shape[1]) < counts[:, None], limits, limits[np.arange(len(a)), counts - 1][:, None])
        lowest, marks, found = anchors["lowest"].to_numpy(), anchors["mark"].to_numpy(), []
        scores_of = products(a, x)
        step = max(1, AT_ONCE // len(ids))
        for start in range(0, len(a), step):
            part = slice(start, start + step)
            scores = scores_of(part)
            row, column = np.nonzero((scores <= limits[part, :1]) & (scores >= lowest[part, None]))
            good = (labels[column] != a_labels[part][row]) & (ids[column] != a_ids[part][row])
            row, column = row[good], column[good]
            score, id = scores[row, column], ids[column]
            # The slot is the last one whose limit reaches the score.
            below = limits[part][row] >= score[:, None]
            distinct = np.ones(below.shape, dtype=bool)
            distinct[:, 1:] = limits[part][row][:, 1:] != limits[part][row][:, :-1]
            slot = (below & distinct).sum(axis=1) - 1
            best = best_of_groups(row * (limits.shape[1] + 1) + slot, score, id, k)
            found.append((start + row[best], id[best], score[best], slot[best]))
        return _found(found, a_ids, marks)

    return task


def _found(found: list[tuple], a_ids: np.ndarray, marks: np.ndarray) -> pa.Table:
    if not found:
        return _EMPTY
    row, id, score, *slot = (np.concatenate(c) for c in zip(*found, strict=True))
    slots = slot[0] if slot else np.zeros(len(row))
    columns = [a_ids[row], marks[row], slots.astype(np.int32), id, score]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _EMPTY.schema, strict=True)], schema=_EMPTY.schema)


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, task: Callable, k: int) -> DataFrame:
    """What ``task`` finds where shards of rows meet blocks of anchors; of each (anchor, slot) the best ``k``."""
    slots = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n_rows // SHARD), min(-(-n_rows // SMALL_SHARD), 2 * slots))
    blocks = max(1, -(-n_anchors // BLOCK))
    dealt = lambda own, n, other, m: (
        F.pmod(F.xxhash64("id", "mark"), F.lit(n)).cast("int").alias(own),
        F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other),
    )
    left = rows.select("id", "label", "vec", *dealt("shard", shards, "block", blocks))
    right = anchors.select("*", *dealt("block", blocks, "shard", shards))
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # columns of their own, as rows hold anchors too
    met = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(task, _FOUND)
    order = Window.partitionBy("a", "mark", "slot").orderBy(F.desc("score"), "id")
    return met.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _percent(score: Column, percent: int, up: bool) -> Column:
    """``percent`` of a score as a whole number, rounded down or up; decimals, so that nothing overflows."""
    share = score.cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
    return (F.ceil(share) if up else F.floor(share)).cast("long")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each of the first
    ``positives`` other rows of an anchor's label, the first ``negatives`` rows of other labels whose score lies
    between ``low`` and ``high`` percent of the positive's, both included.

    Vectors hold whole numbers (``quantised`` makes them); the score is their inner product, the shorter vector
    filled up with 0; one that does not fit 64 bits stops the job. Higher scores come first, ties by smaller id.
    Rows without id, label or vector, or with a missing component, take no part; zero and empty vectors do. Rows
    that repeat in id, label and vector are one row; an id with several labels or vectors is several rows, and none
    of them is another's positive or negative. A positive without such rows has no row. Empty tables give none.
    """
    plain = vectors.select(
        F.col(id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<long>").alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    )
    good = plain.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull())
    )
    rows = stage(good.dropDuplicates(["id", "label", "vec"]).withColumn("mark", F.xxhash64("label", "vec")))
    widest = F.max(F.greatest(F.abs(F.coalesce(F.array_max("vec"), F.lit(0))), F.abs(F.coalesce(F.array_min("vec"), F.lit(0)))))
    facts = rows.agg(F.count("*").alias("rows"), F.count_if("asked").alias("anchors"), widest.alias("most")).first()
    if (facts["most"] or 0) < 1 << 31:  # half the bytes to move; the scores are the same
        rows = rows.withColumn("vec", F.col("vec").cast("array<int>"))
    anchors = rows.filter("asked").select("id", "mark", "label", "vec")
    counts = facts["rows"], facts["anchors"]

    score, limit = F.col("score"), F.col("limit")
    near = _met(rows, anchors, *counts, _same_label(positives), positives)
    windows = stage(
        near.select(
            "a", "mark", F.col("id").alias("positive_id"), F.col("place").alias("nth"), score.alias("positive_score"),
            _percent(score, low, True).alias("least"), _percent(score, high, False).alias("limit"),
        ).filter("least <= limit")
    )
    limits = windows.groupBy("a", "mark").agg(
        F.sort_array(F.collect_set("limit"), asc=False).alias("limits"), F.min("least").alias("lowest")
    )
    asked = anchors.join(limits.withColumnRenamed("a", "id"), ["id", "mark"])
    slots = _met(rows, asked, *counts, _by_slot(negatives), negatives)
    merged = slots.groupBy("a", "mark").agg(
        F.sort_array(F.collect_list(F.struct((-score).alias("below"), "id", "slot"))).alias("best")
    )
    # A window's slot is the place of its limit among the distinct limits.
    own_slot = F.array_position("limits", limit) - 1
    answers = windows.join(limits, ["a", "mark"]).join(merged, ["a", "mark"]).select(
        F.col("a").alias("anchor_id"), "positive_id", "nth", "positive_score", "least",
        F.posexplode(F.slice(F.filter("best", lambda b: b["slot"] >= own_slot), 1, negatives)).alias("nth_negative", "found"),
    )
    found = F.col("found")
    return answers.filter(-found["below"] >= F.col("least")).select(
        "anchor_id", "positive_id", (F.col("nth_negative") + 1).alias("rank"), found["id"].alias("negative_id"),
        "positive_score", (-found["below"]).alias("negative_score"),
    )
