"""N-gram Jaccard join with set-relation skipping.

A text's set holds its distinct word shingles as 64-bit hashes. Texts with equal sets are one class, so
copies are never paired. Classes are joined exactly at ``percent``:

* All sets are ordered alike, rare shingles first. What is rare comes from a table of counters over all
  shingles of the corpus, of a fixed size; any order gives the same links, a good one gives short lists.
* **Index lists.** Two sets that link share a shingle within the first ``n - ceil(n * percent / 100) + 1`` of
  each. These are sorted into one list per shingle, in blocks of equal set size, by position inside a block.
  A probe skips the blocks whose size cannot link, and in a block all that lies behind the last position
  from which the overlap can still be reached.
* **Shapes.** A set's shape counts its shingles by hash in a few buckets. Two shapes differ at most by as much
  as their sets, so pairs whose shapes differ by more than linked sets may are left out: in the lists by 8
  bytes (whether 64 buckets are odd, or counts of 8 buckets for larger sets) and 64 counts, then by 256 counts.
* **Answers from a similar set.** Sets that link are alike: what one of them links to, the others reach
  through it. So answers are passed on instead of computed, in three steps. First each entry of a list links with
  the nearest one before it that it may link with, and looks no further: a list of alike sets takes as many steps
  as it has entries. Lists are dealt to tasks by ranges of their order, so a long one is worked on by many. The links
  give components. Lists whose sets all have one component are answered; in the others each entry links
  with the first possible partner of every other component. Only what is in different components even
  then is compared pair by pair; blocks of the own component are jumped over. So a large group of near
  copies never makes all its pairs, and no link between different groups is left out.
* Every pair that is left is checked on its whole sets.
* Links give components (``components.py``), and each document its smallest reachable id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.components import components
from lodestrata.llm.names import own_names
from lodestrata.llm.words import mixed, pieces, words_of
from lodestrata.llm.worker import let_go
from lodestrata.sources.staging import stage

WORDS, PERCENT = 3, 90
#: Counters of shingles (a fixed size), and how many tables of the result they are dealt to.
COUNTER_BITS, SEGMENTS = 20, 256
#: Buckets of a shape in the lists and in the table of classes; pairs that a task looks at together.
SMALL, LARGE, AT_ONCE = 8, 256, 1 << 18
#: Buckets of a shape in lists that several classes share.
MIDDLE = 64
#: Sets up to this size have odd buckets as their shape in the lists.
ODD_SIZE = 256
#: Classes a task remembers, to send the index entries of copies once.
REMEMBERED = 200_000


def shingle_sets(texts: pa.Array, words: int, levels: np.ndarray | None = None):
    """(shingles, positions where each text's set starts and ends), each set distinct and in order.

    The order is by level of the shingle's counter, then by hash; without levels by hash.
    """
    w = words_of(texts)
    sizes = np.diff(w.firsts)
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), counts)
    at = w.firsts[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    last = w.firsts[1:][text]
    total = np.zeros(len(at), dtype=np.uint64)
    padded = np.append(w.hashes, np.zeros(words, dtype=np.uint64))
    for k in range(words):  # a text with fewer words is hashed as what it has
        total = mixed(total + np.where(at + k < last, padded[at + k], np.uint64(k + 1)) + np.uint64(k))
    if levels is None:
        group = text
    else:
        group = text * 256 + levels[(total >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    order = np.lexsort((total, group))
    total, text = total[order], text[order]
    new = np.ones(len(total), dtype=bool)
    new[1:] = (total[1:] != total[:-1]) | (text[1:] != text[:-1])
    total, text = total[new], text[new]
    return total, np.searchsorted(text, np.arange(len(sizes) + 1))


def set_hashes(shingles: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """One number per set; equal sets have equal numbers, whatever their order."""
    out = np.zeros(len(firsts) - 1, dtype=np.uint64)
    full = np.diff(firsts) > 0
    if full.any():
        out[full] = np.add.reduceat(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), firsts[:-1][full])
    return mixed(out).view(np.int64)


def _per_text(frame: DataFrame, make: Callable, schema: str, end: Callable | None = None) -> DataFrame:
    """Tasks over (id, text) rows in slices of about a megabyte; ``make(state, ids, texts)`` gives tables."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        let_go()
        for batch in batches:
            for first, texts in pieces(batch.column(1)):
                yield from make(state, batch.column(0).slice(first, len(texts)), texts).to_batches()
        if end is not None:
            yield from end(state).to_batches()

    return frame.mapInArrow(task, schema)


def _counts(shingles: np.ndarray, firsts: np.ndarray, buckets: int) -> np.ndarray:
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    bucket = (shingles >> np.uint64(8)).astype(np.int64) % buckets
    return np.bincount(text * buckets + bucket, minlength=(len(firsts) - 1) * buckets).reshape(-1, buckets)


def large_shapes(shingles: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """(set, bucket) counts up to 255; a cut count is still a bound from below."""
    return np.minimum(_counts(shingles, firsts, LARGE), 255).astype(np.uint8)


def small_shapes(shingles: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Eight bytes per set as one number: 64 odd buckets of a small set, 8 counts of a large one."""
    odd = np.packbits((_counts(shingles, firsts, 64) & 1).astype(np.uint8), axis=1)
    counted = np.minimum(_counts(shingles, firsts, SMALL), 255).astype(np.uint8)
    chosen = np.where((np.diff(firsts) <= ODD_SIZE)[:, None], odd, counted)
    return np.ascontiguousarray(chosen).view("<i8").ravel()


def _small_difference(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How much two sets differ at least, by their small shapes; 0 where those are of different kinds."""
    odd, counted = (n <= ODD_SIZE) & (m <= ODD_SIZE), (n > ODD_SIZE) & (m > ODD_SIZE)
    out = np.where(odd, np.bitwise_count((x ^ y).view(np.uint64)), 0).astype(np.int64)
    a, b = (z[counted].view(np.uint8).reshape(-1, SMALL).astype(np.int16) for z in (x, y))
    out[counted] = np.abs(a - b).sum(axis=1)
    return out


_CLASSES = "id long, n int, class long, shape binary, segment int, counts binary"


def _classes_and_counters(rows: DataFrame, words: int) -> DataFrame:
    """Rows of (id, n, class, shape), and at the end of a task its counters as rows of (segment, counts)."""
    size = 1 << COUNTER_BITS
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    schema = pa.schema([(part.split()[0], kind) for part, kind in zip(_CLASSES.split(", "), kinds, strict=True)])

    def table(size: int, **columns: pa.Array) -> pa.Table:
        return pa.table([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

    def make(state: dict, ids: pa.Array, texts: pa.Array) -> pa.Table:
        shingles, firsts = shingle_sets(texts, words)
        bucket = (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
        state["counts"] = state.get("counts", 0) + np.bincount(bucket, minlength=size).astype(np.int32)
        shapes = large_shapes(shingles, firsts)
        return table(
            len(ids), id=ids, n=pa.array(np.diff(firsts).astype(np.int32)),
            shape=pa.array([x.tobytes() for x in shapes], pa.binary()),
            **{"class": pa.array(set_hashes(shingles, firsts))},
        )

    def end(state: dict) -> pa.Table:
        # A byte is enough for a task: a counter that is cut still stands out.
        counts = np.minimum(state["counts"], 255).astype(np.uint8) if state else np.zeros(0, dtype=np.uint8)
        parts = counts.reshape(SEGMENTS, -1) if state else counts.reshape(0, 1)
        raw = pa.array([part.tobytes() for part in parts], pa.binary())
        return table(len(parts), segment=pa.array(range(len(parts)), pa.int32()), counts=raw)

    return _per_text(rows, make, _CLASSES, end)


def _levels(counted: DataFrame) -> np.ndarray:
    """The level (0 to 255) of each counter: how far it stands out from a counter of rare shingles."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(raw, dtype=np.uint8).astype("<i8")
        arrays = [pa.array(total.keys(), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["segment", "counts"])

    summed = (
        counted.filter(F.col("segment").isNotNull())
        .select("segment", "counts")
        .repartition("segment")
        .mapInArrow(task, "segment int, counts binary")
    )
    counts = np.zeros((SEGMENTS, (1 << COUNTER_BITS) // SEGMENTS))
    for row in summed.collect():  # the counters, of a fixed size
        counts[row["segment"]] += np.frombuffer(row["counts"], dtype="<i8")
    counts = counts.reshape(-1)
    usual = np.median(counts)
    excess = np.maximum(0, counts - usual - 3 * np.sqrt(usual))
    return np.minimum(255, np.round(8 * np.log2(1 + excess))).astype(np.uint8)


_ENTRY = "token long, n int, pos int, class long, shape long"
_LISTED = ["token", "n", "pos", "class", "shape", "middle"]


def _entries(rows: DataFrame, words: int, percent: int, levels: np.ndarray) -> DataFrame:
    """The index entries (token, n, pos, class, shape) of every class, from the first shingles of its set."""

    def make(state: dict, _: pa.Array, texts: pa.Array) -> pa.Table:
        shingles, firsts = shingle_sets(texts, words, levels)
        n = np.diff(firsts)
        classes = set_hashes(shingles, firsts)
        seen = state.setdefault("seen", set())
        if len(seen) > REMEMBERED:
            seen.clear()
        new = np.zeros(len(n), dtype=bool)
        for k, key in enumerate(zip(classes.tolist(), n.tolist(), strict=True)):
            if key[1] and key not in seen:
                seen.add(key)
                new[k] = True
        length = np.where(new, n + (-percent * n) // 100 + 1, 0)  # n - ceil(n * percent / 100) + 1
        text = np.repeat(np.arange(len(n)), length)
        pos = np.arange(len(text)) - np.repeat(np.cumsum(length) - length, length)
        return pa.table(
            {
                "token": shingles[firsts[:-1][text] + pos].view(np.int64),
                "n": n[text].astype(np.int32),
                "pos": pos.astype(np.int32),
                "class": classes[text],
                "shape": small_shapes(shingles, firsts)[text],
            }
        )

    return _per_text(rows, make, _ENTRY)


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The columns of a batch as arrays; a shape is a row of bytes."""
    out = []
    for column in batch.columns:
        if pa.types.is_binary(column.type):
            raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)
            out.append(raw.reshape(len(column), -1) if len(column) else np.zeros((0, MIDDLE), dtype=np.uint8))
        else:
            out.append(column.to_numpy(zero_copy_only=False))
    return out


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by token, cut only between tokens; what is open is put together once."""
    parts: list[list[np.ndarray]] = []
    joined = lambda: [np.concatenate(c) for c in zip(*parts, strict=True)]
    for batch in batches:
        columns = _columns(batch)
        token = columns[0]
        if not len(token):
            continue
        last = parts[-1][0][-1] if parts else None
        cut = int(np.searchsorted(token, token[-1], side="left"))
        if cut or (last is not None and last != token[0]):
            if cut:
                parts.append([c[:cut] for c in columns])
            yield joined()
            parts = []
        parts.append([c[cut:] for c in columns])
    if parts:
        yield joined()


def _shared_lists(entries: DataFrame) -> DataFrame:
    """The entries of lists with at least two classes, each class once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_lists(batches):
            token, n, _, group, _ = columns
            again = np.zeros(len(token), dtype=bool)
            again[1:] = (token[1:] == token[:-1]) & (group[1:] == group[:-1]) & (n[1:] == n[:-1])
            columns = [c[~again] for c in columns]
            token = columns[0]
            same = np.zeros(len(token) + 1, dtype=bool)
            same[1:-1] = token[1:] == token[:-1]
            keep = same[1:] | same[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[keep]) for c in columns], ["token", "n", "pos", "class", "shape"]
            )

    # Equal entries of a class meet: a class has one position in a list.
    return _in_lists(entries).mapInArrow(task, _ENTRY)


def _in_lists(entries: DataFrame) -> DataFrame:
    return entries.repartition("token").sortWithinPartitions("token", "n", "pos", "class")


def _overlap_needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return -((-percent * (n + m)) // (100 + percent))


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that stand for ``counts`` items each: the row and the number inside it of every item."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _possible_pairs(
    token, n, pos, shape, percent: int, component: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(later, earlier) places of entries of one list that may link, in order of the later one.

    Entries are in order of token, size, component if given, and position. Blocks of the entry's own component
    are jumped over.
    """
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    new_list = np.append(True, token[1:] != token[:-1])
    new_block = new_list | np.append(True, n[1:] != n[:-1])
    if component is not None:
        new_block |= np.append(True, component[1:] != component[:-1])
    of_list, of_block = np.cumsum(new_list) - 1, np.cumsum(new_block) - 1
    begin = np.flatnonzero(new_block)
    block_key = (of_list[begin] << 32) | n[begin]
    entry_key = (of_block << 32) | pos
    # Blocks of a list from the smallest size that can link up to the entry's own.
    lowest = np.searchsorted(block_key, (of_list << 32) | -((-percent * n) // 100))
    blocks_to = np.cumsum(of_block - lowest + 1)
    start = 0
    while start < len(n):
        stop = max(start + 1, int(np.searchsorted(blocks_to, (blocks_to[start - 1] if start else 0) + AT_ONCE)))
        row, nth = _spread((of_block - lowest + 1)[start:stop])
        later, block = row + start, lowest[start:stop][row] + nth
        if component is not None:
            other = component[begin[block]] != component[later]
            later, block = later[other], block[other]
        size = n[begin[block]]
        need = _overlap_needed(n[later], size, percent)
        reach = np.searchsorted(entry_key, (block << 32) | np.maximum(size - need, -1), side="right")
        reach = np.where(n[later] - pos[later] >= need, np.minimum(reach, later), 0)
        length = np.maximum(reach - begin[block], 0)
        ends = np.cumsum(length)
        at = 0
        while at < len(length):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE)))
            row, nth = _spread(length[at:to])
            k, j = later[at:to][row], begin[block[at:to][row]] + nth
            differ = _small_difference(n[k], n[j], shape[k], shape[j])
            good = differ <= n[k] + n[j] - 2 * _overlap_needed(n[k], n[j], percent)
            if good.any():
                yield k[good], j[good]
            at = to
        start = stop


def _middle_fits(n: np.ndarray, middle: np.ndarray, k: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the counts of two sets differ by no more than those of linked sets may."""
    differ = np.abs(middle[k].astype(np.int16) - middle[j]).sum(axis=1, dtype=np.int64)
    return differ <= n[k] + n[j] - 2 * _overlap_needed(n[k], n[j], percent)


def _first_before(token, n, pos, shape, middle, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(later, earlier): for each entry the nearest one before it in its list that it may link with."""
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    first = np.maximum.accumulate(np.where(np.append(True, token[1:] != token[:-1]), np.arange(len(token)), 0))
    lowest = -((-percent * n) // 100)
    looking, back = np.arange(len(token)), 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(looking):
        looking = looking[looking - back >= first[looking]]
        looking = looking[n[looking - back] >= lowest[looking]]  # sizes ascend: all before are smaller still
        j = looking - back
        need = _overlap_needed(n[looking], n[j], percent)
        good = np.minimum(n[looking] - pos[looking], n[j] - pos[j]) >= need
        at = np.flatnonzero(good)
        a, b = looking[at], j[at]
        small = _small_difference(n[a], n[b], shape[a], shape[b]) <= n[a] + n[b] - 2 * need[at]
        good[at] = small
        at = at[small]
        good[at] = _middle_fits(n, middle, looking[at], j[at], percent)
        found.append((looking[good], j[good]))
        looking, back = looking[~good], back + 1
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (first[:0], first[:0])


_PAIR = "n int, class long, other_n int, other_class long"


def _pair_batch(n, group, k, j) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (n[k], group[k], n[j], group[j])], [c.split()[0] for c in _PAIR.split(", ")])


def _leaders(lists: DataFrame, percent: int) -> DataFrame:
    """For each entry of a list one pair of classes, with the nearest possible partner before it.

    Ranges of the lists' order are dealt to tasks, however long a list is; at a cut between tasks an entry
    may miss its partner, which the later steps find.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, n, pos, group, shape, middle in _whole_lists(batches):
            k, j = _first_before(token, n, pos, shape, middle, percent)
            yield _pair_batch(n, group, k, j)

    order = ("token", "n", "pos", "class")
    dealt = lists.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(task, _PAIR).distinct()


def _between_components(lists: DataFrame, percent: int, one_of_each: bool) -> DataFrame:
    """Pairs of classes with different components from lists of (token, n, pos, class, shape, middle, component).

    ``one_of_each``: for each entry one possible partner of every other component. Otherwise all pairs.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, n, pos, group, shape, middle, component in _whole_lists(batches):
            for k, j in _possible_pairs(token, n, pos, shape, percent, component):
                good = _middle_fits(n.astype(np.int64), middle, k, j, percent)
                k, j = k[good], j[good]
                if one_of_each and len(k):
                    _, kept = np.unique(np.stack([k, component[j]]), axis=1, return_index=True)
                    k, j = k[kept], j[kept]
                if len(k):
                    yield _pair_batch(n, group, k, j)

    order = ("token", "n", "component", "pos", "class")
    return lists.repartition("token").sortWithinPartitions(*order).mapInArrow(task, _PAIR).distinct()


def _with_middle(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """The lists with the counts of each set in ``MIDDLE`` buckets, folded from those of its class."""
    joined = lists.join(classes.select("n", "class", F.col("shape").alias("middle")), ["n", "class"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=np.uint8).reshape(-1, LARGE // MIDDLE, MIDDLE)
            folded = np.minimum(counts.sum(axis=1, dtype=np.int64), 255).astype(np.uint8)
            middle = pa.array([x.tobytes() for x in folded], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], middle], batch.schema.names)

    return joined.select(*lists.columns, "middle").mapInArrow(task, f"{_ENTRY}, middle binary")


def _mixed(lists: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """The lists that hold sets of several components, with the components; a class without one is its own."""
    labelled = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "n", "class", F.coalesce("component", "id").alias("component")
    )
    entries = lists.join(labelled, ["n", "class"]).select(*_LISTED, "component")
    several = entries.groupBy("token").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return entries.join(several.filter("_low <> _high").select("token"), "token", "left_semi").select(*_LISTED, "component")


def _united(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) after further links: only the components that these touch are worked on."""
    if links.isEmpty():
        return found
    at = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
    between = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(
        F.coalesce("_a", "a").alias("x"), F.coalesce("_b", "b").alias("y")
    )
    merged = stage(components(stage(between.distinct()), "x", "y").select(F.col("node").alias("component"), F.col("component").alias("_to")))
    moved = found.join(merged, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    new = merged.join(found.select(F.col("node").alias("component")), "component", "left_anti")
    return stage(moved.unionByName(new.select(F.col("component").alias("node"), F.col("_to").alias("component"))))


def _near(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shapes do not differ by more than linked sets may."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
            shapes = [
                np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(-1, LARGE).astype(np.int16)
                for k in (4, 5)
            ]
            differ = np.abs(shapes[0] - shapes[1]).sum(axis=1, dtype=np.int64)
            good = pa.array(differ <= n + m - 2 * _overlap_needed(n, m, percent))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(good) for k in (0, 1)], ["a", "b"])

    return pairs.mapInArrow(task, "a long, b long")


def _numbered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes by their ids, the smaller one first, with sizes and shapes."""

    def side(n: str, group: str, mark: str) -> DataFrame:
        return classes.select(
            F.col("n").alias(n), F.col("class").alias(group), F.struct("id", F.col("n").alias("n"), "shape").alias(mark)
        )

    both = pairs.join(side("n", "class", "_x"), ["n", "class"]).join(
        side("other_n", "other_class", "_y"), ["other_n", "other_class"]
    )
    low, high = F.least("_x", "_y"), F.greatest("_x", "_y")
    return both.select(
        low["id"].alias("a"), high["id"].alias("b"), low["n"].alias("n"), high["n"].alias("m"),
        low["shape"].alias("shape_a"), high["shape"].alias("shape_b"),
    ).dropDuplicates(["a", "b"])


def _linked(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, checked on the whole sets."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    frame = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for first, texts_a in pieces(batch.column(2)):
                sets_a, a = shingle_sets(texts_a, words)
                sets_b, b = shingle_sets(batch.column(3).slice(first, len(texts_a)), words)
                for k in range(len(texts_a)):
                    x, y = sets_a[a[k] : a[k + 1]], sets_b[b[k] : b[k + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    good[first + k] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(good)) for k in range(2)], ["a", "b"]
            )

    return frame.mapInArrow(task, "a long, b long").distinct()


def join_classes(rows: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """From (id, text) rows without missing ids: the documents (id, n, class), and (node, component) of the smallest
    id of each class that links. A class is identified by its size and a 64-bit hash of its set."""
    counted = stage(_classes_and_counters(rows, words))
    members = counted.filter(F.col("n").isNotNull()).select("id", "n", "class")
    shapes = counted.filter(F.col("n") > 0).groupBy("n", "class")
    classes = stage(shapes.agg(F.min("id").alias("id"), F.min("shape").alias("shape")))
    shared = _shared_lists(_entries(rows, words, percent, _levels(counted)))
    lists = stage(_with_middle(shared, classes))

    def linked(possible: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """The pairs among ``possible`` that were not checked before, and the links among them."""
        near = _near(_numbered(possible, classes), percent)
        pairs = stage(near if before is None else near.join(before, ["a", "b"], "left_anti"))
        ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        texts = stage(_texts(rows, classes.join(ends, "id", "left_semi"), words))
        return pairs, stage(_linked(pairs, texts, words, percent))

    pairs, links = linked(_leaders(lists, percent), None)
    found = stage(components(links, "a", "b"))
    mixed = stage(_mixed(lists, classes, found))
    more_pairs, more = linked(_between_components(mixed, percent, one_of_each=True), pairs)
    found = _united(found, more)
    rest = _mixed(mixed.select(*_LISTED), classes, found)
    _, more = linked(_between_components(rest, percent, one_of_each=False), pairs.unionByName(more_pairs))
    return members, _united(found, more)


def _texts(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The texts of wanted classes (id, n, class). An id may have several texts; rows that repeat may come again."""
    frame = rows.join(wanted.select("id", "n", "class"), "id").select("id", "text", "n", "class")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            n, classes = (batch.column(k).to_numpy() for k in (2, 3))
            good = np.zeros(batch.num_rows, dtype=bool)
            for first, texts in pieces(batch.column(1)):
                part = slice(first, first + len(texts))
                shingles, firsts = shingle_sets(texts, words)
                good[part] = (np.diff(firsts) == n[part]) & (set_hashes(shingles, firsts) == classes[part])
            for k in np.flatnonzero(good).tolist():
                key = batch.column(0)[k].as_py(), int(n[k]), int(classes[k])
                good[k], last = key != last, key
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good)) for k in (0, 1)], ["id", "text"])

    return frame.mapInArrow(task, "id long, text string")


def jaccard_components(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_shingles`` (size of its set) and ``component_id`` (the smallest id
    that it reaches over links, itself included).

    A text with fewer than ``words`` words has one shingle; an empty or missing one has none and links with
    nothing. A row without id takes part in no link and has no component. Rows that repeat give repeated
    results; an id with several texts has a component for each. Extra columns do not matter.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    members, found = join_classes(rows.filter("id IS NOT NULL"), words, percent)
    classes = members.filter("n > 0").groupBy("n", "class").agg(F.min("id").alias("node"))
    of_class = classes.join(found, "node", "left").select(
        "n", "class", F.coalesce("component", "node").alias("component_id")
    )
    linked = members.filter("n > 0").join(of_class, ["n", "class"])
    result = linked.select("id", "n", "component_id").unionByName(
        members.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    )
    if docs.schema[id].nullable:

        def make(_: dict, ids: pa.Array, texts: pa.Array) -> pa.Table:
            n = np.diff(shingle_sets(texts, words)[1]).astype(np.int32)
            return pa.table({"id": ids, "n": n, "component_id": pa.nulls(len(n), pa.int64())})

        nameless = _per_text(rows.filter("id IS NULL"), make, "id long, n int, component_id long")
        result = result.unionByName(nameless)
    return result.select(F.col("id").alias(id), F.col("n").cast("long").alias("n_shingles"), "component_id")


@own_names
def one_of_each(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row of each group of linked texts: the one with the smallest id; rows that repeat it go too.

    Rows without words link with nothing and stay, and so do rows without id. All columns are kept.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    members, found = join_classes(rows.filter("id IS NOT NULL"), words, percent)
    classes = members.filter("n > 0").groupBy("n", "class").agg(F.min("id").alias("node"))
    chosen = stage(
        classes.join(found, "node", "left")
        .filter(F.coalesce("component", "node") == F.col("node"))
        .select(F.col("node").alias("_id"), F.col("n").alias("_n"), F.col("class").alias("_class"), F.lit(True).alias("_chosen"))
    )
    frame = docs.select("*", F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
    names = [*docs.columns, "_id", "_n", "_class"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes = [], []
            for _, texts in pieces(batch.column(len(names) - 2)):
                shingles, firsts = shingle_sets(texts, words)
                sizes.append(np.diff(firsts).astype(np.int32))
                classes.append(set_hashes(shingles, firsts))
            if sizes:
                added = [pa.array(np.concatenate(x)) for x in (sizes, classes)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names)

    fields = [*frame.schema.fields[:-1], T.StructField("_n", T.IntegerType()), T.StructField("_class", T.LongType())]
    marked = frame.mapInArrow(task, T.StructType(fields)).join(chosen, ["_id", "_n", "_class"], "left")
    place = F.row_number().over(Window.partitionBy("_id", "_n", "_class").orderBy(text))
    alone = F.col("_id").isNull() | (F.col("_n") == 0)
    linked = marked.filter(~alone & F.col("_chosen")).withColumn("_place", place).filter("_place = 1")
    return linked.select(*docs.columns).unionByName(marked.filter(alone).select(*docs.columns))
