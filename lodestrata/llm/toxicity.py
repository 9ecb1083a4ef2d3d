"""Toxicity: a bidirectional gated recurrent network with attention pooling, over all overlapping windows.

A text is a sequence of words (letters, digits, all that is not ASCII). Each word enters the network by a
word input (a learned vector by hash of the word, and how much more often the word stands in toxic training
texts) and a character input (the mean of learned vectors of its character 3- and 5-grams, and the strongest
of their shares). Windows of ``LENGTH`` words start every ``STRIDE`` words over the whole text. The network
scores every window, and the highest window gives the score of the text.

Training (numpy, inside one task) uses a bounded sample of labelled rows, ``sample`` of each label by hash of
the text, so what it needs does not grow with the corpus. Only texts are labelled, not windows: a toxic text
gives its most suspicious windows, a clean text its most suspicious one and random ones; after half of the
epochs the network itself chooses again. Logits become probabilities by a fit on texts that were kept out.
Scoring runs inside Spark tasks on slices of about a megabyte of text; parameters have a fixed size.
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
from lodestrata.llm.words import LETTERS, Words, mixed, pieces, words_of
from lodestrata.llm.worker import let_go

LENGTH, STRIDE = 16, 8
STATE, ATTENTION, VECTOR = 6, 6, 6
TABLE_BITS, SHARE_BITS = 14, 17
GRAMS = (3, 5)
#: Labelled rows of each label that are used for training.
SAMPLE = 1500
#: Distinct words whose inputs are gathered at once, and texts whose n-grams are counted at once.
WORDS_AT_ONCE, TEXTS_AT_ONCE = 1 << 15, 100
THRESHOLD = 0.3
PRIOR_COUNT = 4.0
#: Steps of training at least, however few texts there are.
STEPS = 200
#: The logit of a text without words: there is nothing to find in it.
WORDLESS = -8.0


def _buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Inputs:
    """The distinct words of some texts as inputs of the network."""

    word: np.ndarray  # hash of each distinct word
    gram: np.ndarray  # hashes of the character n-grams of all distinct words
    first: np.ndarray  # the first n-gram of each distinct word

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.word)), np.diff(np.append(self.first, len(self.gram))))


def distinct_words(words: Words) -> tuple[Inputs, np.ndarray]:
    """The distinct words, and for every word its place among them."""
    hashes, at, place = np.unique(words.hashes, return_index=True, return_inverse=True)
    lengths = (words.ends - words.starts)[at]
    framed = lengths + 2  # one mark before and one after the word
    ends = np.cumsum(framed)
    begins = ends - framed
    text = np.ones(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    text[ends - 1] = 2
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    text[np.repeat(begins + 1, lengths) + inner] = words.data[np.repeat(words.starts[at], lengths) + inner]
    grams, owners = [], []
    for n in GRAMS:
        value = np.full(max(0, len(text) - n + 1), n, dtype=np.uint64)
        for k in range(n):
            value = value * np.uint64(257) + text[k : len(text) - n + 1 + k]
        counts = np.maximum(framed - n + 1, 0)
        inner = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        grams.append(mixed(value[np.repeat(begins, counts) + inner]))
        owners.append(np.repeat(np.arange(len(hashes)), counts))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(hashes)))
    return Inputs(hashes, np.concatenate(grams)[order], first), place


def windows(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows: first word and end of each, and the text it belongs to. A text without words has one."""
    sizes = np.diff(firsts)
    counts = 1 + np.maximum(0, -(-(sizes - LENGTH) // STRIDE))
    of = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = firsts[:-1][of] + nth * STRIDE
    return start, np.minimum(start + LENGTH, firsts[1:][of]), of


class Network:
    """Parameters by name; gate columns are update, reset and new state."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        inputs = 2 * (VECTOR + 1)

        def drawn(*shape: int, scale: float = 0.3) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": drawn(1 << TABLE_BITS, VECTOR, scale=0.05),
            "gram": drawn(1 << TABLE_BITS, VECTOR, scale=0.05),
            "score": drawn(2 * STATE),
            "score0": np.zeros(1, dtype=np.float32),
            "look": drawn(2 * STATE, ATTENTION),
            "look0": np.zeros(ATTENTION, dtype=np.float32),
            "pick": drawn(ATTENTION),
        }
        for side in "fb":
            self.p |= {
                f"in{side}": drawn(inputs, 3 * STATE),
                f"in0{side}": np.zeros(3 * STATE, dtype=np.float32),
                f"rec{side}": drawn(STATE, 3 * STATE),
            }
        self.word_share = np.zeros(1 << SHARE_BITS, dtype=np.float32)
        self.gram_share = np.zeros(1 << SHARE_BITS, dtype=np.float32)
        self.slope, self.offset = 1.0, 0.0

    # --- inputs ---------------------------------------------------------------------------------

    def features(self, x: Inputs) -> np.ndarray:
        """One row per distinct word: word vector, word share, mean n-gram vector, highest n-gram share."""
        if not len(x.word):
            return np.zeros((0, 2 * (VECTOR + 1)), dtype=np.float32)
        bounds = np.append(x.first, len(x.gram))
        out = np.empty((len(x.word), 2 * (VECTOR + 1)), dtype=np.float32)
        for k in range(0, len(x.word), WORDS_AT_ONCE):
            words = x.word[k : k + WORDS_AT_ONCE]
            begin = bounds[k : k + len(words)]
            gram = x.gram[begin[0] : bounds[k + len(words)]]
            counts = np.diff(bounds[k : k + len(words) + 1])[:, None]
            rows = out[k : k + len(words)]
            rows[:, :VECTOR] = self.p["word"][_buckets(words, TABLE_BITS)]
            rows[:, VECTOR] = self.word_share[_buckets(words, SHARE_BITS)]
            rows[:, VECTOR + 1 : -1] = np.add.reduceat(self.p["gram"][_buckets(gram, TABLE_BITS)], begin - begin[0]) / counts
            rows[:, -1] = np.maximum.reduceat(self.gram_share[_buckets(gram, SHARE_BITS)], begin - begin[0])
        return out

    def suspicion(self, x: Inputs) -> np.ndarray:
        f = self.features(x)
        return np.maximum(f[:, VECTOR], f[:, -1])

    # --- forward and backward -------------------------------------------------------------------

    def _run(self, side: str, gates: np.ndarray, present: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction, (step, window, unit). ``gates``: inputs of (step, window, 3 units)."""
        steps, n, _ = gates.shape
        rec = self.p[f"rec{side}"]
        state = np.zeros((n, STATE), dtype=np.float32)
        out = np.empty((steps, n, STATE), dtype=np.float32)
        for t in range(steps) if side == "f" else reversed(range(steps)):
            hidden = state @ rec
            both = 0.5 + 0.5 * np.tanh(0.5 * (gates[t, :, : 2 * STATE] + hidden[:, : 2 * STATE]))
            z, r = both[:, :STATE], both[:, STATE:]
            new = np.tanh(gates[t, :, 2 * STATE :] + r * hidden[:, 2 * STATE :])
            here = present[t]
            if keep is not None:
                keep.append((t, state, hidden[:, 2 * STATE :], z, r, new, here))
            state = state + here * (1 - z) * (new - state)
            out[t] = state
        return out

    def forward(self, f: np.ndarray, index: np.ndarray, present: np.ndarray, keep: dict | None = None):
        """Logit of each window. ``f``: rows of features, ``index``: (step, window) rows, ``present``: 0 or 1."""
        present = present[:, :, None].astype(np.float32)
        states = []
        for side in "fb":
            trail: list | None = [] if keep is not None else None
            projected = f @ self.p[f"in{side}"] + self.p[f"in0{side}"]
            states.append(self._run(side, projected[index], present, trail))
            if keep is not None:
                keep[side] = trail
        both = np.concatenate(states, axis=2)
        seen = np.tanh(both @ self.p["look"] + self.p["look0"])
        weight = np.exp(seen @ self.p["pick"])[:, :, None] * present
        weight /= weight.sum(axis=0) + 1e-9
        pooled = (weight * both).sum(axis=0)
        if keep is not None:
            keep |= {"both": both, "seen": seen, "weight": weight, "pooled": pooled}
        return pooled @ self.p["score"] + self.p["score0"][0]

    def gradients(self, f: np.ndarray, index: np.ndarray, present: np.ndarray, labels: np.ndarray, importance):
        """Gradients of the weighted cross entropy, and of the features."""
        keep: dict = {}
        logit = self.forward(f, index, present, keep)
        error = ((1 / (1 + np.exp(-logit)) - labels) * importance / len(labels)).astype(np.float32)
        p, g = self.p, {}
        g["score"], g["score0"] = keep["pooled"].T @ error, error.sum()[None]
        d_pooled = error[:, None] * p["score"]
        weight, both, seen = keep["weight"], keep["both"], keep["seen"]
        d_weight = (d_pooled * both).sum(axis=2, keepdims=True)
        d_sharp = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["pick"] = np.einsum("tna,tn->a", seen, d_sharp[:, :, 0])
        d_look = d_sharp * p["pick"] * (1 - seen**2)
        g["look"], g["look0"] = np.einsum("tnh,tna->ha", both, d_look), d_look.sum(axis=(0, 1))
        d_both = weight * d_pooled + d_look @ p["look"].T
        d_f = np.zeros_like(f)
        for k, side in enumerate("fb"):
            rec = p[f"rec{side}"]
            d_rec = np.zeros_like(rec)
            d_gates = np.zeros((*index.shape, 3 * STATE), dtype=np.float32)
            d_state = np.zeros_like(both[0, :, :STATE])
            for t, before, inner, z, r, new, here in reversed(keep[side]):
                d_state = d_state + d_both[t, :, k * STATE : (k + 1) * STATE]
                d = d_state * here
                d_new = d * (1 - z) * (1 - new**2)
                d_hidden = np.hstack([d * (before - new) * z * (1 - z), d_new * inner * r * (1 - r), d_new * r])
                d_gates[t] = np.hstack([d_hidden[:, : 2 * STATE], d_new])
                d_rec += before.T @ d_hidden
                d_state = d_state * (1 - here) + d * z + d_hidden @ rec.T
            flat = d_gates.reshape(-1, 3 * STATE)
            rows = index.reshape(-1)
            summed = np.stack([np.bincount(rows, flat[:, c], len(f)) for c in range(3 * STATE)], axis=1)
            summed = summed.astype(np.float32)
            g[f"rec{side}"], g[f"in{side}"], g[f"in0{side}"] = d_rec, f.T @ summed, summed.sum(axis=0)
            d_f += summed @ p[f"in{side}"].T
        return g, d_f

    # --- scoring --------------------------------------------------------------------------------

    def window_logits(self, f: np.ndarray, place: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 8192):
        out = np.empty(len(start), dtype=np.float32)
        place = np.append(place, 0)
        f = f if len(f) else np.zeros((1, f.shape[1]), dtype=np.float32)
        for k in range(0, len(start), most):
            index, present = _window_rows(place, start[k : k + most], end[k : k + most])
            out[k : k + most] = self.forward(f, index, present)
        return out

    def text_logits(self, texts: pa.Array) -> np.ndarray:
        """The logit of the highest window of each whole text."""
        out = np.empty(len(texts), dtype=np.float32)
        for first, part in pieces(texts):
            words = words_of(part, LETTERS)
            inputs, place = distinct_words(words)
            start, end, of = windows(words.firsts)
            logits = self.window_logits(self.features(inputs), place, start, end)
            highest = np.maximum.reduceat(logits, np.searchsorted(of, np.arange(len(part))))
            out[first : first + len(part)] = np.where(np.diff(words.firsts) > 0, highest, WORDLESS)
        return out

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        logits = self.text_logits(texts).astype(np.float64)
        return 1 / (1 + np.exp(-(self.slope * logits + self.offset)))


def _window_rows(place: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = start + np.arange(LENGTH)[:, None]
    present = at < end
    return place[np.where(present, at, len(place) - 1)], present


class _Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.n, self.m, self.v = rate, 0, {}, {}

    def step(self, p: dict, g: dict) -> None:
        self.n += 1
        for name, grad in g.items():
            m = self.m[name] = 0.9 * self.m.get(name, 0) + 0.1 * grad
            v = self.v[name] = 0.99 * self.v.get(name, 0) + 0.01 * grad**2
            p[name] -= self.rate * (m / (1 - 0.9**self.n)) / (np.sqrt(v / (1 - 0.99**self.n)) + 1e-6)


def _counts(bucket: np.ndarray, text: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """By label and bucket: texts with it."""
    pairs = np.unique(bucket * len(labels) + text)
    bucket, toxic = pairs // len(labels), labels[pairs % len(labels)]
    return np.stack([np.bincount(bucket[toxic == y], minlength=1 << SHARE_BITS) for y in (False, True)])


def _shares(counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """By bucket: log of how much larger the share of toxic texts with it is than that of clean ones, drawn to 0
    where few texts have it."""
    b, a = counts
    ratio = np.log((a + 0.5) / max(1, labels.sum())) - np.log((b + 0.5) / max(1, (~labels).sum()))
    return (ratio * (a + b) / (a + b + PRIOR_COUNT)).astype(np.float32)


def _all_words(texts: list[str]) -> Words:
    """``words_of`` all texts, a slice at a time."""
    parts = [words_of(part, LETTERS) for _, part in pieces(pa.array(texts, pa.string()))]
    data = np.cumsum([0, *(len(p.data) for p in parts)])
    words = np.cumsum([0, *(len(p.starts) for p in parts)])
    return Words(
        np.concatenate([p.data for p in parts]),
        np.concatenate([p.starts + at for p, at in zip(parts, data, strict=False)]),
        np.concatenate([p.ends + at for p, at in zip(parts, data, strict=False)]),
        np.concatenate([p.hashes for p in parts]),
        np.append(np.concatenate([p.firsts[:-1] + at for p, at in zip(parts, words, strict=False)]), words[-1]),
    )


def train(texts: list[str], labels: list[int], toxic_share: float, epochs: int = 6, seed: int = 7) -> Network:
    """A network from labelled texts; ``toxic_share`` is the share of toxic rows among all labelled ones.

    Without both labels it is the untrained network with the share as its constant score.
    """
    net = Network(seed)
    y = np.array(labels, dtype=bool)
    share = min(max(toxic_share, 1e-3), 1 - 1e-3)
    net.offset = float(np.log(share / (1 - share)))
    if not y.any() or y.all():
        net.slope = 0.0
        return net
    rng = np.random.default_rng(seed)
    words = _all_words(texts)
    inputs, place = distinct_words(words)
    text_of_word = np.repeat(np.arange(len(texts)), np.diff(words.firsts))
    kept_out = rng.random(len(texts)) < 0.2
    used = ~kept_out[text_of_word]
    # Shares of words and of n-grams, by the texts they stand in; the kept-out texts take no part.
    counts = np.diff(np.append(inputs.first, len(inputs.gram)))
    word_bucket, gram_bucket = _buckets(inputs.word, SHARE_BITS), _buckets(inputs.gram, SHARE_BITS)
    of_words, of_grams = 0, 0
    for k in range(0, len(texts), TEXTS_AT_ONCE):
        part = slice(words.firsts[k], words.firsts[min(k + TEXTS_AT_ONCE, len(texts))])
        pair = np.unique(place[part][used[part]] * len(texts) + text_of_word[part][used[part]])
        word, text = pair // len(texts), pair % len(texts)
        of_words = of_words + _counts(word_bucket[word], text, y)
        at = np.repeat(inputs.first[word], counts[word]) + (
            np.arange(int(counts[word].sum())) - np.repeat(np.cumsum(counts[word]) - counts[word], counts[word])
        )
        of_grams = of_grams + _counts(gram_bucket[at], np.repeat(text, counts[word]), y)
    net.word_share, net.gram_share = _shares(of_words, y), _shares(of_grams, y)

    start, end, of = windows(words.firsts)
    firsts = np.searchsorted(of, np.arange(len(texts)))
    adam, vectors = _Adam(0.01), _Adam(0.01)
    rank = np.full(len(start), -np.inf, dtype=np.float32)
    value = np.append(net.suspicion(inputs), -9)[np.append(place, len(inputs.word))]
    for k in range(0, len(start), 8192):
        at = start[k : k + 8192] + np.arange(LENGTH)[:, None]
        rank[k : k + 8192] = value[np.where(at < end[k : k + 8192], at, len(value) - 1)].max(axis=0)
    gram_owner, gram_bucket = inputs.owners(), _buckets(inputs.gram, TABLE_BITS)
    gram_share = (1 / counts)[gram_owner]
    word_bucket = _buckets(inputs.word, TABLE_BITS)
    batch = min(256, max(32, len(texts) // 16))
    epochs = max(epochs, -(-STEPS * batch // (2 * len(texts))))
    for epoch in range(epochs):
        if epoch == epochs // 2:
            rank = net.window_logits(net.features(inputs), place, start, end)
        order = np.lexsort((-rank, of))
        chosen = [order[firsts[~kept_out]]]
        second = firsts + 1
        more = ~kept_out & (second < np.append(firsts[1:], len(of)))
        chosen.append(order[second[more]])
        drawn = firsts + (rng.random(len(texts)) * (np.append(firsts[1:], len(of)) - firsts)).astype(int)
        chosen.append(drawn[~kept_out & ~y])
        # The second window of a toxic text may well be clean: it counts little.
        importance = np.concatenate([np.ones(len(chosen[0])), np.where(y[more], 0.2, 1), np.ones(len(chosen[2]))])
        chosen = np.concatenate(chosen)
        for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // batch)):
            w = chosen[part]
            index, present = _window_rows(np.append(place, 0), start[w], end[w])
            rows, local = np.unique(index, return_inverse=True)
            g, d_f = net.gradients(
                net.features(_subset(inputs, rows, counts)), local.reshape(index.shape), present,
                y[of[w]].astype(np.float32), importance[part].astype(np.float32),
            )
            adam.step(net.p, g)
            at = np.isin(gram_owner, rows)
            spread = d_f[np.searchsorted(rows, gram_owner[at]), VECTOR + 1 : 2 * VECTOR + 1] * gram_share[at, None]
            n = 1 << TABLE_BITS
            vectors.step(
                net.p,
                {
                    "word": _summed(word_bucket[rows], d_f[:, :VECTOR], n),
                    "gram": _summed(gram_bucket[at], spread, n),
                },
            )
    logits = np.maximum.reduceat(net.window_logits(net.features(inputs), place, start, end), firsts)
    x, t = logits[kept_out].astype(float), y[kept_out]
    if t.any() and not t.all():
        weight = np.where(t, share / t.mean(), (1 - share) / (1 - t.mean()))
        net.slope, net.offset = logistic(x, t.astype(float), weight)
    return net


def _summed(bucket: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(bucket, rows[:, c], n) for c in range(rows.shape[1])], axis=1).astype(np.float32)


def _subset(x: Inputs, rows: np.ndarray, counts: np.ndarray) -> Inputs:
    n = counts[rows]
    first = np.cumsum(n) - n
    at = np.repeat(x.first[rows], n) + np.arange(int(n.sum())) - np.repeat(first, n)
    return Inputs(x.word[rows], x.gram[at], first)


def held_out(id: str):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Network:
    """A network from labelled rows that are not held out: at most ``sample`` rows of each label.

    Training sees whole texts. ``labels`` may name an id more than once; the highest label counts. Missing labels
    and ids are left out.
    """
    rows, share = labelled_sample(docs, labels, id, text, label, sample, held_out, whole=True)
    return trained_in_task(rows, lambda texts, truth: train(texts, truth, share))


@own_names
def score(docs: DataFrame, network: Network, text: str = "text", output: str = "score") -> DataFrame:
    """The rows with the network's probability that the whole text is toxic; a missing text counts as empty."""
    plain = docs.drop(output)
    frame = plain.select("*", F.col(text).alias("_text"))
    names = [*plain.columns, output]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            scores = network.probabilities(batch.column(len(names) - 1))
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

    Missing and empty texts get the score of a text without words. Repeated rows get equal scores. Without
    labels the score is a constant. Columns of these names are replaced.
    """
    network = fit(docs, labels, id, text, sample=sample)
    return (
        score(docs.drop("held_out", "predicted"), network, text)
        .withColumn("held_out", held_out(id))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
