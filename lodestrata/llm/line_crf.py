"""Quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's features are shares of kinds of characters and words, what
repeats in it, and the same of the lines before and after it; the chain adds how likely a label follows
another. Forward-backward gives each line's probability of being good; a text's quality is their mean,
weighted by length, brought to a probability of the label.

Training (numpy, inside one task) uses a bounded sample of labelled rows, ``sample`` of each label by hash;
lines take the label of their text. Features and marginals are array operations over the lines of about a
megabyte of text at a time, inside Spark tasks; the chain runs along the lines of all texts of a slice at
once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.labelled import labelled_sample, logistic, trained_in_task
from lodestrata.llm.names import own_names
from lodestrata.llm.words import NO_SPACE, mixed, pieces, text_bytes, words_of

#: Labelled rows of each label that are used for training.
SAMPLE = 1500
THRESHOLD = 0.5

# Common words of four languages.
COMMON = (
    "the a an is was that of to and are be as at by for from has have he in it not on or she they this with you "
    "der die das ein eine ist und zu auf aus bei dem den des er im mit nicht sich sie von wie "
    "le la les un une est de et au avec ce dans des du elle en il ne pas pour qui se son sur "
    "el los las una es que con por al como del lo no para su y"
).split()
_COMMON_HASHES = np.unique(words_of(pa.array([" ".join(COMMON)])).hashes)


def _kind(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=np.float32)
    table[[ord(c) for c in characters]] = 1
    return table


_UPPER = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER + _kind("abcdefghijklmnopqrstuvwxyz") + (np.arange(256) >= 0x80)
_DIGIT, _MARKS = _kind("0123456789"), _kind(".,;:!?'\"()-")
_BLANK = _kind(" \t\r\x0b\x0c\n")
_SYMBOL = 1 - np.minimum(1, _LETTER + _DIGIT + _MARKS + _BLANK)
_END = _kind(".!?:\"")

OWN = (
    "length", "letters", "upper", "digits", "blanks", "marks", "symbols", "word_length", "same_as_before",
    "distinct", "common", "ends", "upper_first", "odd_last", "again_in_text",
)
#: Own features that the lines before and after give as well.
NEAR = tuple(OWN.index(name) for name in ("upper", "symbols", "same_as_before", "distinct", "common", "odd_last"))
FEATURES = len(OWN) + 2 * len(NEAR) + 3


@dataclass
class Lines:
    features: np.ndarray
    weight: np.ndarray  # bytes with the line end
    firsts: np.ndarray  # first line of each text, and at the end the number of lines


def lines_of(texts: pa.Array) -> Lines:
    """The lines of each text; an empty text has one empty line."""
    data, offsets = text_bytes(texts)
    breaks = np.flatnonzero(data == 10)
    count = len(offsets) - 1
    text_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    text = np.concatenate([np.arange(count), text_of_break])
    start = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    firsts = np.searchsorted(text, np.arange(count + 1))
    last = np.append(text[1:] != text[:-1], True)
    end = np.where(last, offsets[1:][text], np.append(start[1:], 0) - 1)
    size = end - start

    def total(table: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(table[data], dtype=np.float64))
        return sums[end] - sums[start]

    w = words_of(texts, NO_SPACE)
    line = np.searchsorted(start, w.starts, side="right") - 1
    words = np.bincount(line, minlength=len(start))
    per_word = lambda x: np.bincount(line, x, len(start)) / np.maximum(words, 1)
    repeats = np.zeros(len(line))
    if len(line):
        repeats[1:] = (w.hashes[1:] == w.hashes[:-1]) & (line[1:] == line[:-1])
    pair = np.unique(mixed(w.hashes ^ mixed(line.astype(np.uint64))), return_index=True)[1]
    distinct = np.bincount(line[pair], minlength=len(start)) / np.maximum(words, 1)
    raw_first, raw_last = data[w.starts], data[w.ends - 1] if len(line) else data[:0]
    line_hash = np.zeros(len(start), dtype=np.uint64)
    np.add.at(line_hash, line, mixed(w.hashes + np.arange(len(line), dtype=np.uint64) - np.searchsorted(line, line).astype(np.uint64)))
    key = mixed(line_hash ^ mixed(text.astype(np.uint64)))
    _, inverse, copies = np.unique(key, return_inverse=True, return_counts=True)
    share = 1 / np.maximum(size, 1)
    ends = np.where(size > 0, _END[data[np.maximum(end - 1, 0)]] if len(data) else 0, 0)
    own = np.column_stack(
        [
            np.log1p(size), total(_LETTER) * share, total(_UPPER) * share, total(_DIGIT) * share,
            total(_BLANK) * share, total(_MARKS) * share, total(_SYMBOL) * share,
            np.log1p(per_word(w.ends - w.starts)), per_word(repeats), np.where(words > 0, distinct, 1),
            per_word(np.isin(w.hashes, _COMMON_HASHES)), ends, per_word(_UPPER[raw_first]),
            per_word(_SYMBOL[raw_last] + (raw_last == ord("!"))), (copies[inverse] > 1) & (words > 0),
        ]
    )
    first = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, dtype=bool)
    before, after = np.roll(own[:, NEAR], 1, axis=0), np.roll(own[:, NEAR], -1, axis=0)
    before[first], after[last[: len(text)]] = 0, 0
    place = np.column_stack([first, last[: len(text)], np.ones(len(text))])
    return Lines(np.hstack([own, before, after, place]).astype(np.float64), size + 1, firsts)


@dataclass
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray  # (label before, label)
    slope: float = 1.0
    offset: float = 0.0

    def potentials(self, features: np.ndarray) -> np.ndarray:
        """Log weight of good against bad for each line."""
        return ((features - self.mean) / self.scale) @ self.weights

    def messages(self, good: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log messages (line, label), along all texts at once."""
        unary = np.column_stack([np.zeros(len(good)), good])
        forward, backward = unary.copy(), np.zeros_like(unary)
        sizes = np.diff(firsts)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = firsts[:-1][order], sizes[order]
        ends = starts + sizes - 1
        alive = len(sizes)
        for t in range(1, int(sizes[0]) if len(sizes) else 0):
            alive = int(np.searchsorted(-sizes[:alive], -t, side="left"))  # texts with more than t lines
            f = starts[:alive] + t
            forward[f] += _passed(forward[f - 1], self.moves)
            b = ends[:alive] - t
            backward[b] = _passed(backward[b + 1] + unary[b + 1], self.moves.T)
        return forward, backward

    def marginals(self, lines: Lines) -> np.ndarray:
        forward, backward = self.messages(self.potentials(lines.features), lines.firsts)
        both = forward + backward
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))

    def quality(self, lines: Lines) -> np.ndarray:
        """Mean marginal of each text, weighted by length."""
        p = self.marginals(lines)
        if not len(p):
            return np.zeros(0)
        return np.add.reduceat(p * lines.weight, lines.firsts[:-1]) / np.add.reduceat(lines.weight, lines.firsts[:-1])

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for first, part in pieces(texts):
            x = _logit(self.quality(lines_of(part)))
            out[first : first + len(part)] = 1 / (1 + np.exp(-(self.slope * x + self.offset)))
        return out


def _passed(message: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Log-sum over the label a message comes from."""
    return np.logaddexp(message[:, :1] + moves[0], message[:, 1:] + moves[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _all_lines(texts: list[str]) -> Lines:
    """``lines_of`` all texts, about a megabyte at a time."""
    parts = [lines_of(part) for _, part in pieces(pa.array(texts, pa.string()))]
    if not parts:
        return lines_of(pa.array([], pa.string()))
    before = np.cumsum([0, *(len(p.weight) for p in parts)])
    firsts = [p.firsts[:-1] + at for p, at in zip(parts, before, strict=False)]
    return Lines(
        np.concatenate([p.features for p in parts]),
        np.concatenate([p.weight for p in parts]),
        np.append(np.concatenate(firsts), before[-1]),
    )


def train(texts: list[str], labels: list[int], good_share: float, steps: int = 120, seed: int = 3) -> Field:
    """A field from labelled texts. Without both labels its score is the share of good rows."""
    y = np.array(labels, dtype=bool)
    share = min(max(good_share, 1e-3), 1 - 1e-3)
    field = Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)))
    field.offset = float(np.log(share / (1 - share)))
    if not y.any() or y.all():
        return field
    kept_out = np.random.default_rng(seed).random(len(texts)) < 0.2
    parts = [
        (_all_lines([t for t, k in zip(texts, kept_out, strict=True) if k == out]), y[kept_out == out])
        for out in (False, True)
    ]
    lines, truth = parts[0]
    field.mean, field.scale = lines.features.mean(axis=0), lines.features.std(axis=0) + 1e-3
    field.mean[-1], field.scale[-1] = 0, 1  # the constant
    x = (lines.features - field.mean) / field.scale
    sizes = np.diff(lines.firsts)
    label = np.repeat(truth, sizes).astype(float)
    # Every text counts alike and both labels count alike, whatever the number of their lines.
    of_text = np.where(truth, 0.5 / max(1, truth.sum()), 0.5 / max(1, (~truth).sum())) / np.maximum(sizes, 1)
    importance = np.repeat(of_text, sizes)
    inner = np.ones(len(label), dtype=bool)
    inner[lines.firsts[:-1][sizes > 0]] = False
    inner = np.flatnonzero(inner)
    m, v = 0.0, 0.0
    for step in range(1, steps + 1):
        good = x @ field.weights
        forward, backward = field.messages(good, lines.firsts)
        both = forward + backward
        z = np.logaddexp(both[:, 0], both[:, 1])
        p = np.exp(both[:, 1] - z)
        grad = x.T @ (importance * (p - label)) + 1e-4 * field.weights
        unary = np.column_stack([np.zeros(len(good)), good])
        pairs = np.exp(
            forward[inner - 1][:, :, None] + field.moves + (unary + backward)[inner][:, None, :] - z[inner][:, None, None]
        )
        seen = np.zeros((len(inner), 2, 2))
        seen[np.arange(len(inner)), label[inner - 1].astype(int), label[inner].astype(int)] = 1
        moved = (importance[inner][:, None, None] * (pairs - seen)).sum(axis=0) + 1e-2 * field.moves
        g = np.append(grad, moved.ravel())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        change = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        field.weights = field.weights - change[:FEATURES]
        field.moves = field.moves - change[FEATURES:].reshape(2, 2)
    lines, truth = parts[1]
    if truth.any() and not truth.all():
        weight = np.where(truth, share / truth.mean(), (1 - share) / (1 - truth.mean()))
        field.slope, field.offset = logistic(_logit(field.quality(lines)), truth.astype(float), weight)
    return field


def held_out(id: str):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> Field:
    """A field from labelled rows that are not held out: at most ``sample`` rows of each label, by hash of the id.

    Training sees whole texts. ``labels`` may name an id more than once; the highest label counts. Missing labels
    and ids are left out.
    """
    rows, share = labelled_sample(docs, labels, id, text, label, sample, held_out, whole=True)
    return trained_in_task(rows, lambda texts, truth: train(texts, truth, share))


@own_names
def score(docs: DataFrame, field: Field, text: str = "text", output: str = "score") -> DataFrame:
    """The rows with the probability that the whole text is good; a missing text counts as empty."""
    plain = docs.drop(output)
    frame = plain.select("*", F.col(text).alias("_text"))
    names = [*plain.columns, output]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = field.probabilities(batch.column(len(names) - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names)

    return frame.mapInArrow(task, T.StructType([*plain.schema.fields, T.StructField(output, T.DoubleType())]))


@own_names
def classify(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """The rows with ``held_out``, ``score`` and ``predicted``. Labels and other columns are no inputs of a score.

    Missing and empty texts get the score of one empty line. Repeated rows get equal scores. Without labels
    the score is a constant. Columns of these names are replaced.
    """
    field = fit(docs, labels, id, text, sample=sample)
    return (
        score(docs.drop("held_out", "predicted"), field, text)
        .withColumn("held_out", held_out(id))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
