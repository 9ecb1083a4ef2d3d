"""Stretches of a text that repeat the same words at a fixed distance, by descending-LCP Kruskal.

A run is a stretch of words with smallest period ``q`` and at least ``max(least, repeats * q)`` words that no
neighbouring word extends. All runs of a text are found, whatever their period:

* **Suffix classes.** Suffixes of the words are put in the order of a suffix tree by doubling. Only those take
  part whose first words stand at another place of the text too: the start of a run and the word one period
  later share at least ``least * (repeats - 1) / repeats`` words, so no other suffix can seed one.
* **Kruskal.** Neighbours in that order are edges, weighted by the length of their common prefix (LCP). Edges
  are taken by decreasing LCP; each unites two classes of a union-find, whose positions are kept in order, the
  smaller class into the larger.
* **Seeds.** Two positions that become neighbours in a united class share exactly LCP words, and no position
  between them shares as many. At distance ``d`` within LCP they seed the stretch of ``d + LCP`` words with
  smallest period ``d``; it is a run if it is long enough and the word before it does not continue it.

A text is worked on alone inside a task, several short ones at a time; no row leaves its task.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.names import own_names
from lodestrata.llm.words import mixed, pieces

#: Fewest words of a run, and how often its period must fit in at least.
LEAST, REPEATS = 24, 3
#: Counters of word groups by hash, as a power of two; bytes of texts that are worked on together.
COUNTER_BITS, AT_ONCE = 20, 1 << 20

Run = tuple[int, int, int]  # first word, words, period
_FIELDS = ("start", "length", "period")
_RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType(), False) for name in _FIELDS]), False)
_ARROW_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in _FIELDS]))


class _Numbers(dict):
    """Words numbered as they come; equal words have equal numbers."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


@dataclass
class _Suffixes:
    """The suffixes that can seed a run, in the order of a suffix tree."""

    positions: np.ndarray
    common: np.ndarray  # words that each one has in common with the one before


def _repeated(ids: np.ndarray, group: int) -> np.ndarray:
    """Positions whose next ``group`` words stand at another place too; ids are unique to their text.

    Groups are told apart by 64-bit hashes, so a chance match may add a position but none is ever lost.
    """
    hashes = mixed(ids.astype(np.uint64) + np.uint64(1))
    width = 1
    while width < group:
        step = min(width, group - width)
        shifted = np.append(hashes[step:], np.zeros(step, dtype=np.uint64))
        hashes = mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + shifted)
        width += step
    hashes = hashes[: max(0, len(ids) - group + 1)]
    bucket = (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
    shared = np.flatnonzero(np.bincount(bucket, minlength=1 << COUNTER_BITS)[bucket] > 1)
    order = np.argsort(hashes[shared], kind="stable")
    ordered = hashes[shared][order]
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    return np.sort(shared[order[same[1:] | same[:-1]]])


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _suffixes(ids: np.ndarray, candidates: np.ndarray, group: int) -> _Suffixes:
    """Order and common prefixes of the candidates, exact.

    Ranks of 1, 2, 4, ... words are kept for the words that candidates start with. Beyond them no words are
    shared, so a rank from there is unique.
    """
    covered = np.zeros(len(ids) + group, dtype=bool)
    for k in range(group):
        covered[candidates + k] = True
    covered = covered[: len(ids)]
    at = np.flatnonzero(covered)
    size = len(at)
    place = np.full(len(ids) + 1, -1, dtype=np.int64)
    place[at] = np.arange(size)

    def ahead(members: np.ndarray, width: int) -> np.ndarray:
        """The member that stands ``width`` words after each one, or -1."""
        return place[np.minimum(at[members] + width, len(ids))]

    everyone = np.arange(size)
    levels = [np.unique(ids[at], return_inverse=True)[1].astype(np.int64)]
    while int(levels[-1].max(initial=-1)) + 1 < size:
        rank = levels[-1]
        after = ahead(everyone, 1 << (len(levels) - 1))
        second = np.where(after >= 0, rank[after], size + everyone)
        finer = _ranks(rank, second)
        levels.append(finer)
        if 1 << (len(levels) - 1) > len(ids):
            break
    members = place[candidates]
    ordered = members[np.argsort(levels[-1][members], kind="stable")]
    left, right = ordered[:-1].copy(), ordered[1:].copy()
    common = np.zeros(len(left), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        same = (left >= 0) & (right >= 0) & (rank[left] == rank[right])
        common[same] += 1 << level
        left[same], right[same] = ahead(left[same], 1 << level), ahead(right[same], 1 << level)
    return _Suffixes(at[ordered], np.append(0, common))


def _seeds(suffixes: _Suffixes, least: int) -> Iterator[tuple[int, int, int]]:
    """(position, later position, LCP) of positions that become neighbours in a class, LCP from ``least`` on."""
    owner = list(range(len(suffixes.positions)))
    held: list[list[int] | None] = [[p] for p in suffixes.positions.tolist()]

    def root(x: int) -> int:
        while owner[x] != x:
            owner[x] = x = owner[owner[x]]
        return x

    edges = np.flatnonzero(suffixes.common >= least)
    for edge in edges[np.argsort(-suffixes.common[edges], kind="stable")].tolist():
        common = int(suffixes.common[edge])
        a, b = root(edge - 1), root(edge)
        large, small = held[a], held[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        owner[b], held[b] = a, None
        own = set(small)
        if 8 * len(small) < len(large):
            for p in small:
                insort(large, p)
            for p in small:
                k = bisect_left(large, p)
                if k and large[k - 1] not in own:
                    yield large[k - 1], p, common
                if k + 1 < len(large) and large[k + 1] not in own:
                    yield p, large[k + 1], common
        else:
            held[a] = united = sorted(large + small)  # two ordered parts: one pass
            for p, q in zip(united, united[1:], strict=False):
                if (p in own) != (q in own):
                    yield p, q, common


def runs_of(ids: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[Run]:
    """All runs of a sequence of numbers, by start and period. Texts may be joined if they share no number."""
    reach = -(-least * (repeats - 1) // repeats)  # fewest words that a start and the word a period later share
    group = 1 << (max(reach, 1).bit_length() - 1)
    if len(ids) < least:
        return []
    candidates = _repeated(ids, group)
    if not len(candidates):
        return []
    runs = set()
    for p, q, common in _seeds(_suffixes(ids, candidates, group), reach):
        period = q - p
        length = period + common
        if period <= common and length >= max(least, repeats * period) and (p == 0 or ids[p - 1] != ids[q - 1]):
            runs.add((p, length, period))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray | None:
    """Which words stay when every run keeps its first period; nothing if all stay."""
    if not runs:
        return None
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length/period, compared exactly; ties: smallest start, then period."""
    best = None
    for run in runs:  # by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def words_and_runs(
    texts: list[str | None],
    least: int = LEAST,
    repeats: int = REPEATS,
    change: Callable[[int, list[bytes]], list[bytes]] | None = None,
) -> list[tuple[list[bytes], list[Run]]]:
    """The words of each text, as ``change(row, words)`` makes them, and its runs."""
    numbers = _Numbers()
    every, parts, firsts, at = [], [], [], 0
    for row, text in enumerate(texts):
        words = (text or "").encode().split()  # exactly at ASCII white space
        if change is not None:
            words = change(row, words)
        every.append(words)
        firsts.append(at)
        parts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
        at += len(words)
    found: list[list[Run]] = [[] for _ in every]
    if at:
        ids = np.concatenate(parts)
        ids += np.repeat(np.arange(len(every)), [len(words) for words in every]) * len(numbers)  # unique to a text
        for start, length, period in runs_of(ids, least, repeats):
            row = int(np.searchsorted(firsts, start, side="right")) - 1
            found[row].append((start - firsts[row], length, period))
    return list(zip(every, found, strict=True))


@own_names
def periodic_runs(
    docs: DataFrame, text: str = "text", output: str = "runs", least: int = LEAST, repeats: int = REPEATS
) -> DataFrame:
    """All rows and columns, with an array of the runs (start, length, period) of each text, by start and period.

    Words end at ASCII white space and are numbered from 0. Missing, empty and short texts have no runs. Equal
    texts have equal runs. A column named as ``output`` is replaced. Very long texts are worked on alone.
    """

    def listed(_text: str | None, _words: list[bytes], runs: list[Run]) -> list[dict]:
        return [dict(zip(_FIELDS, run, strict=True)) for run in runs]

    return _with_column(docs, text, output, _RUNS, _ARROW_RUNS, listed, least, repeats)


@own_names
def collapse_runs(
    docs: DataFrame, text: str = "text", output: str | None = None, least: int = LEAST, repeats: int = REPEATS
) -> DataFrame:
    """All rows and columns, the text without the words of a run after its first period.

    Words that any run drops go, the rest is joined by single spaces. A text without runs stays as it is,
    white space included, and so does a missing one. ``output`` names a column for the new text.
    """

    def collapsed(original: str | None, words: list[bytes], runs: list[Run]) -> str | None:
        return _joined(words, kept_words(len(words), runs)).decode() if runs else original

    return _with_column(docs, text, output or text, T.StringType(), pa.string(), collapsed, least, repeats)


def _joined(words: list[bytes], kept: np.ndarray | None) -> bytes:
    return b" ".join(words if kept is None else [words[k] for k in np.flatnonzero(kept).tolist()])


def _with_column(
    docs: DataFrame, text: str, output: str, kind: T.DataType, arrow: pa.DataType, make: Callable, least: int, repeats: int
) -> DataFrame:
    """``docs`` with a last column that is made from each text, its words and its runs."""
    others = [c for c in docs.columns if c != output]
    frame = docs.select(*others, F.col(text).cast("string").alias(output))
    schema = T.StructType([*frame.schema.fields[:-1], T.StructField(output, kind)])
    names = frame.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values: list = []
            for _, part in pieces(batch.column(len(names) - 1), AT_ONCE):
                texts = part.to_pylist()
                found = words_and_runs(texts, least, repeats)
                values += [make(text, words, runs) for text, (words, runs) in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, arrow)], names)

    return frame.mapInArrow(task, schema).select(*(docs.columns if output in docs.columns else names))


# The digest of the query.

_DIGEST = (
    "n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def planted(id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, repeated with a fixed period from some word on in the texts that the id's checksum chooses.

    With ``h`` the CRC-32 of the decimal id and ``g = h // 10``: if ``h % 10 = 0``, each word from ``a = g % n`` on
    becomes the word ``(i - a) % p`` places after ``a``, where ``p = 1 + (n - a) // (3 + g % 8)``. A missing id has no
    checksum and leaves its words.
    """
    if id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(id).encode()), 10)
    if rest:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def digest(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, repeats: int = REPEATS
) -> DataFrame:
    """Per row of ``docs``: the number of runs of its ``planted`` words, the strongest run, digests of all runs and
    of the words that stay.

    Without a run the four numbers of the strongest are missing. Missing and empty texts have no words: digests
    of nothing. Repeated rows give repeated results. Other columns do not matter.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    names = [part.split()[0] for part in _DIGEST.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2

    def row_of(words: list[bytes], runs: list[Run]) -> tuple:
        listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        best = strongest(runs)
        four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        joined = _joined(words, kept_words(len(words), runs))
        return len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(joined).hexdigest()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in pieces(batch.column(1), AT_ONCE):
                ids = batch.column(0).slice(first, len(part))
                of = ids.to_pylist()
                found = words_and_runs(part.to_pylist(), least, repeats, lambda k, words, of=of: planted(of[k], words))
                columns = zip(*(row_of(words, runs) for words, runs in found), strict=True)
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *arrays], ["id", *names])

    return rows.mapInArrow(task, f"id long, {_DIGEST}").withColumnRenamed("id", id)
