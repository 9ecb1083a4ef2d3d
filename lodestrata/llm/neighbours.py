"""Approximate nearest neighbours by inner product: inverted lists with an adaptive scan of dimensions.

* Largest inner product becomes smallest distance: a vector gets one more component that brings all to the
  largest norm, a query gets 0 there. All are turned by the same random rotation, so that any first
  components are a fair sample of the distance.
* Lists come from k-means on a bounded sample; every vector is put into one list. How many lists a query
  probes is the least number that finds ``RECALL`` of the neighbours in the sample. These are farther than
  the neighbours in the whole table, so the number is on the safe side.
* In a probed list distances grow block of columns by block of columns. After each block a hypothesis test
  (is the distance above the bound, given so many of its dimensions?) abandons candidates. The bound is a
  distance within which the probed lists hold ``k`` rows of a seed of the sample, and ``SPARE`` more.
* What is left is scored exactly, by the inner product of the original vectors, and ranked by Spark.

A list is cut into shards and the queries of a list into blocks of a fixed size, so no group grows with the
table. Equal vectors are one candidate class: only their ``k + 1`` smallest ids can be in a result, so a
vector that a third of all rows hold makes no large list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.sources.staging import stage

#: Vectors that lists are fitted on, those that give a query its first bound, and queries that are tried.
SAMPLE, SEED, TRIED = 20_000, 20_000, 400
#: Largest number of lists, candidates in a shard, queries in a block.
LISTS, SHARD, QUERIES = 4096, 8192, 2048
#: Share of the neighbours in the sample that probing must find.
RECALL = 0.97
#: Columns of a block, and deviations that the test allows.
COLUMNS, DEVIATIONS = 16, 2.1
#: Rows of the seed beyond k that lie within a query's bound, in case the test abandons one wrongly.
SPARE = 10


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` without rows that take no part: a missing id or vector, missing or non-finite
    components, only zeros, fewer or more components than most. Repeated rows are one."""
    plain = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = plain.filter(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.coalesce(F.exists("vector", bad), F.lit(True))
        & F.exists("vector", lambda x: x != 0)
    )
    usual = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.filter(F.size("vector") == (usual["n"] if usual else 0)).dropDuplicates(["vec_id", "vector"])


@dataclass
class Index:
    longest: float  # largest squared norm
    rotation: np.ndarray
    centres: np.ndarray  # rotated
    seed_ids: np.ndarray
    seed: np.ndarray  # rotated
    probes: int

    def rotated(self, x: np.ndarray, candidates: bool) -> np.ndarray:
        last = np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0)) if candidates else np.zeros(len(x))
        return np.column_stack([x, last]) @ self.rotation

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each rotated candidate."""
        return squared(x, self.centres).argmin(axis=1)

    def probed(self, x: np.ndarray, held: np.ndarray, least: int) -> np.ndarray:
        """(query, list): whether it is probed; the nearest ones, at least ``probes`` that hold ``least`` rows."""
        order = np.argsort(squared(x, self.centres), axis=1, kind="stable")
        before = np.cumsum(held[order], axis=1) - held[order]
        out = np.zeros(order.shape, dtype=bool)
        np.put_along_axis(out, order, (np.arange(order.shape[1]) < self.probes) | (before < least), axis=1)
        return out

    def bounds(self, ids: np.ndarray, x: np.ndarray, probed: np.ndarray, k: int) -> np.ndarray:
        """A squared distance within which the probed lists hold ``k`` rows of the seed; infinite without."""
        out = np.full(len(x), np.inf)
        of = self.lists(self.seed) if len(self.seed) >= k else None
        for start in range(0, len(x) if of is not None else 0, 128):
            part = slice(start, start + 128)
            d = squared(x[part], self.seed)
            d[(ids[part, None] == self.seed_ids) | ~probed[part][:, of]] = np.inf
            out[part] = np.partition(d, k - 1, axis=1)[:, k - 1]
        return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def fit(ids: np.ndarray, sample: np.ndarray, total: int, longest: float, k: int, recall: float = RECALL) -> Index:
    rng = np.random.default_rng(5)
    size = sample.shape[1] + 1
    rotation, _ = np.linalg.qr(rng.normal(size=(size, size)))
    index = Index(longest, rotation, np.zeros((0, size)), ids[:SEED], np.zeros((0, size)), 1)
    x = index.rotated(sample, True)
    index.seed = x[:SEED]
    n = int(min(LISTS, max(1, math.isqrt(total) // 4), len(x)))
    centres = x[rng.choice(len(x), n, replace=False)]
    for _ in range(10):
        nearest = squared(x, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=n)
        order = np.argsort(nearest, kind="stable")
        full = counts > 0
        sums = np.add.reduceat(x[order], (np.cumsum(counts) - counts)[full])
        centres[full] = sums / counts[full, None]
    index.centres = centres
    # How many lists must be probed to find the neighbours inside the sample.
    of = squared(x, centres).argmin(axis=1)
    tried = index.rotated(sample[:TRIED], False)
    near = squared(tried, x)
    near[np.arange(len(tried)), np.arange(len(tried))] = np.inf
    top = np.argsort(near, axis=1)[:, : min(k, len(x) - 1)]
    if top.size:
        order = np.argsort(squared(tried, centres), axis=1)
        place = np.argsort(order, axis=1)
        depth = np.take_along_axis(place, of[top], axis=1).ravel()
        index.probes = int(np.quantile(depth, recall, method="higher")) + 1
    return index


def scan(x: np.ndarray, q: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Squared distances (query, candidate); infinite where the candidate was abandoned."""
    size = x.shape[1]
    part = np.zeros((len(q), len(x)))
    alive = None  # all
    for start in range(0, size, COLUMNS):
        end = min(start + COLUMNS, size)
        a, b = q[:, start:end], x[:, start:end]
        if alive is None:
            part += squared(a, b)
        else:
            rows, columns = alive
            part[rows, columns] += ((a[rows] - b[columns]) ** 2).sum(axis=1)
        limit = bound * (end / size) * (1 + (DEVIATIONS / math.sqrt(end) if end < size else 0)) ** 2
        if alive is not None:
            keep = part[rows, columns] <= limit[rows]
            part[rows[~keep], columns[~keep]] = np.inf
            alive = rows[keep], columns[keep]
        else:
            out = part > limit[:, None] * (1 + 1e-9)
            part[out] = np.inf
            if out.mean() > 0.7:
                alive = np.nonzero(~out)
    return part


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _mapped(vectors: DataFrame, schema: str, make) -> DataFrame:
    """Rows made by ``make(ids, vectors)`` from up to a thousand vectors at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, x = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                for start in range(0, len(ids), 1024):
                    yield pa.RecordBatch.from_pydict(make(ids[start : start + 1024], x[start : start + 1024]))

    return vectors.select("vec_id", "vector").mapInArrow(task, schema)


def _arrays(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _listed(candidates: DataFrame, index: Index) -> DataFrame:
    """Every candidate with its list."""

    def make(ids: np.ndarray, x: np.ndarray) -> dict:
        return {"vec_id": ids, "vector": _arrays(x), "list": index.lists(index.rotated(x, True)).astype(np.int32)}

    return _mapped(candidates, "vec_id long, vector array<double>, list int", make)


def _asked(queries: DataFrame, index: Index, held: np.ndarray, k: int) -> DataFrame:
    """Every query in a row for each probed list, with its bound."""

    def make(ids: np.ndarray, x: np.ndarray) -> dict:
        turned = index.rotated(x, False)
        probed = index.probed(turned, held, k + 1)
        bound = index.bounds(ids, turned, probed, k + SPARE)
        row, of = np.nonzero(probed)
        return {"vec_id": ids[row], "vector": _arrays(x[row]), "list": of.astype(np.int32), "bound": bound[row]}

    return _mapped(queries, "vec_id long, vector array<double>, list int, bound double", make)


def _counts(df: DataFrame) -> dict[int, int]:
    """Rows of each list; one number per list, at most ``LISTS``."""
    return {row["list"]: row["count"] for row in df.groupBy("list").count().collect()}


def _parts(counts: dict[int, int], size: int) -> dict[int, int]:
    """Into how many parts of ``size`` rows each list is cut."""
    return {of: -(-count // size) for of, count in counts.items()}


def _dealt(df: DataFrame, own: str, own_parts: dict[int, int], other: str, other_parts: dict[int, int]) -> DataFrame:
    """Each row in one part of its own side, and with all parts of the other side of its list."""
    lookup = lambda parts: F.coalesce(
        F.element_at(F.create_map(*(F.lit(int(x)) for pair in parts.items() for x in pair)), F.col("list")), F.lit(0)
    )
    mine = F.pmod(F.xxhash64("vec_id"), lookup(own_parts)).cast("int")
    others = lookup(other_parts)
    return df.filter(others > 0).select(
        "*", mine.alias(own), F.explode(F.sequence(F.lit(0), others - 1)).alias(other)
    )


def nearest_neighbours(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, recall: float = RECALL
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its ``k`` nearest rows
    by inner product, nearest first, ties to the smaller id; fewer if there are fewer.

    Rows of the query's own id are no candidates. Rows that ``usable`` leaves out take no part. Rows that
    repeat an id with another vector are rows of their own. Empty tables give empty results.
    """
    schema = "query_id long, vec_id long, score double"
    good = usable(vectors, id, vector)
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    facts = good.agg(F.max(norm).alias("longest")).first()
    if facts["longest"] is None:
        empty = good.sparkSession.createDataFrame([], schema)
        return empty.withColumn("rank", F.lit(1)).select("query_id", "rank", "vec_id", "score")
    same = Window.partitionBy("vector").orderBy("vec_id")
    candidates = stage(good.withColumn("_place", F.row_number().over(same)).filter(F.col("_place") <= k + 1))
    different = candidates.filter("_place = 1")
    rows = different.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).toArrow()
    index = fit(rows["vec_id"].to_numpy(), _matrix(rows["vector"]), candidates.count(), facts["longest"], k, recall)

    listed = _listed(candidates, index)
    counts = _counts(listed)
    held = np.array([counts.get(of, 0) for of in range(len(index.centres))])
    asked = _asked(good.filter(F.col("vec_id") % every == 0), index, held, k)
    blocks = _parts(_counts(asked), QUERIES) or {-1: 1}
    left = _dealt(listed, "shard", _parts(counts, SHARD), "block", blocks)
    right = _dealt(asked, "block", blocks, "shard", _parts(counts, SHARD))

    def search(_, own: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if own.num_rows and queries.num_rows:
            ids, x = own["vec_id"].to_numpy(), _matrix(own["vector"])
            asked_ids, asked_x = queries["vec_id"].to_numpy(), _matrix(queries["vector"])
            turned, bound = index.rotated(x, True), queries["bound"].to_numpy()
            step = max(1, 1_000_000 // len(ids))
            for start in range(0, len(asked_ids), step):
                part = slice(start, start + step)
                d = scan(turned, index.rotated(asked_x[part], False), bound[part])
                d[asked_ids[part][:, None] == ids[None, :]] = np.inf
                m = min(2 * k + 2, len(ids))
                top = np.argpartition(d, m - 1, axis=1)[:, :m]
                row, column = np.repeat(np.arange(len(d)), m), top.ravel()
                kept = np.isfinite(d[row, column])
                row, column = row[kept], column[kept]
                score = (asked_x[part][row] * x[column]).sum(axis=1)
                found.append((asked_ids[part][row], ids[column], score))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    keys = ["list", "shard", "block"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
