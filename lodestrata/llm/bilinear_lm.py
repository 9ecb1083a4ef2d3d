"""Log-probabilities of texts by a log-bilinear model over counts of the whole corpus.

Tokens are lower-cased words and one end per text. Every word of the corpus is counted, and the probability of a
token has two factors:

* **Group, by the network.** The most frequent words and the end are groups of their own; all other words are
  dealt to groups by their last two bytes, which tell languages and punctuation apart. The words before a token
  predict its group: the sum of their vectors, each weighted by its place, times the vectors of the groups.
  Training is noise-contrastive: true groups are told from groups drawn by frequency, so no step sums over all
  groups. Scoring does: one matrix product for some thousand tokens, then log-softmax over every group.
* **Word in its group, by counts.** ``(c + 0.1) / (C + 0.1 * (W + 1))`` with the group's tokens ``C`` and words ``W``.

So the probabilities of all words, and of one unknown word for each group of many, add up to 1.

Counts grow with the corpus. The most frequent words, at most ``KNOWN``, go to all tasks; all other counts come
back by a join on the word, so a frequent word is never shuffled with the texts and a rare one is never left out.
The network learns from every token of the corpus. A bounded sample of texts, inside one task, gives it a start. From
there each task takes steps over all texts it reads, in slices, and the moves of all tasks are averaged, weighted by
their tokens: sums of whole numbers, so they do not depend on their order. Parameters have a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.words import Words, mixed, pieces, words_of
from lodestrata.sources.staging import stage

#: Words of context, length of a vector.
ORDER, SIZE = 5, 16
#: Words that are groups of their own, groups of the others, words with a vector of their own as context.
SINGLE, TAILS, INPUTS = 191, 64, 4096
GROUPS = 1 + SINGLE + TAILS
#: Words whose counts every task holds, at most.
KNOWN = 1 << 20
#: The start: texts that are drawn and tokens of each at most, noise groups of a step, tokens of a step, rounds.
SAMPLE, SAMPLE_TOKENS, NOISE, STEP, ROUNDS = 2000, 1000, 64, 1024, 2
#: The pass over all texts: tokens of a step at most, rate of a step, numbers of a step, parts and fraction bits of the
#: moves.
WHOLE_STEP, WHOLE_RATE, WHOLE_TYPE, PARTS, MOVE_BITS = 1024, 0.002, np.float32, 16, 20
#: The parameters of a network, in the order in which tasks pass them on.
NAMES = ("inputs", "places", "outputs", "bias")
#: Added to every count.
ADDED = 0.1
#: Different words that a counting task holds, tokens that are looked up together, and that are scored together.
HELD, AT_ONCE, IN_CACHE = 1 << 20, 8192, 1024
#: Bits of a row's number inside its task.
_ROW_BITS = 40


def tails(words: Words) -> np.ndarray:
    """The group of each word among the groups of many: by its last two bytes."""
    last = words.data[words.ends - 1].astype(np.uint64)
    before = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0).astype(np.uint64)
    return (mixed(last << np.uint64(8) | before) % np.uint64(TAILS)).astype(np.int64)


# Counts of the whole corpus.


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, tail, n`` over all texts of a one-column frame; a word is its 64-bit hash."""

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        words, tail, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        unique, first, place = np.unique(words, return_index=True, return_inverse=True)
        return unique, tail[first], np.bincount(place, weights=n, minlength=len(unique)).astype(np.int64)

    def batch_of(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        words, tail, n = part
        return pa.RecordBatch.from_pydict(
            {"word": words.view(np.int64), "tail": pa.array(tail, pa.int32()), "n": pa.array(n, pa.int64())}
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for _, texts in pieces(batch.column(0)):
                words = words_of(texts)
                unique, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                parts.append((unique, tails(words)[first], n))
                size += len(unique)
                if size > 2 * HELD:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > HELD:
                        yield batch_of(parts.pop())
                        size = 0
        if parts:
            yield batch_of(merged(parts))

    counted = texts.mapInArrow(task, "word long, tail int, n long")
    return counted.groupBy("word").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What tasks know of the corpus: the most frequent words, and totals."""

    words: np.ndarray  # hashes of known words, ascending
    n: np.ndarray
    group: np.ndarray
    input: np.ndarray
    tokens: int  # of all training texts, ends included
    distinct: int
    texts: int
    group_n: np.ndarray  # tokens of each group
    group_words: np.ndarray  # different words of each group

    def looked_up(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count or -1 if not known, group, input) of each word."""
        unique, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        tail = tails(words)[first]
        at = np.minimum(np.searchsorted(self.words, unique), max(len(self.words) - 1, 0))
        known = self.words[at] == unique if len(self.words) else np.zeros(len(unique), dtype=bool)
        pick = lambda own, other: np.where(known, own[at], other) if len(self.words) else other
        n = pick(self.n, np.full(len(unique), -1))
        return n[place], pick(self.group, 1 + SINGLE + tail)[place], pick(self.input, 1 + INPUTS + tail)[place]


def lexicon(counts: DataFrame, texts: int) -> tuple[Lexicon, Column]:
    """The lexicon of counted words, and the condition that a counted word is in it."""
    level = F.floor(F.log2("n") * 8)
    levels = {r["level"]: r["words"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()}
    least, held = max(levels, default=0) + 1, 0
    for value in sorted(levels, reverse=True):  # a level for each eighth of a power of two
        held += levels[value]
        if held > KNOWN:
            break
        least = value
    rows = counts.filter(level >= least).select("word", "tail", "n").toArrow()
    words, tail, n = (rows[c].to_numpy() for c in ("word", "tail", "n"))
    totals = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()

    words = words.view(np.uint64)
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.lexsort((words, -n))] = np.arange(len(words))
    group = np.where(rank < SINGLE, 1 + rank, 1 + SINGLE + tail)
    group_n, group_words = np.zeros(GROUPS, dtype=np.int64), np.zeros(GROUPS, dtype=np.int64)
    for r in totals:
        group_n[1 + SINGLE + r["tail"]], group_words[1 + SINGLE + r["tail"]] = r["n"], r["words"]
    alone = rank < SINGLE
    np.subtract.at(group_n, 1 + SINGLE + tail[alone], n[alone])
    np.subtract.at(group_words, 1 + SINGLE + tail[alone], 1)
    group_n[group[alone]], group_words[group[alone]] = n[alone], 1
    group_n[0], group_words[0] = texts, int(texts > 0)
    order = np.argsort(words)
    return Lexicon(
        words[order], n[order], group[order], np.where(rank < INPUTS, 1 + rank, 1 + INPUTS + tail)[order],
        int(group_n.sum()), int(group_words.sum()), texts, group_n, group_words,
    ), level >= least


# The network.


@dataclass
class Network:
    inputs: np.ndarray  # vectors of context words; 0 is the place before a text
    places: np.ndarray  # weights of each place before the token
    outputs: np.ndarray  # vectors of groups
    bias: np.ndarray

    @classmethod
    def untrained(cls, shares: np.ndarray) -> Network:
        """Predicts groups by their share of all tokens, whatever stands before."""
        rng = np.random.default_rng(7)
        inputs = rng.normal(0, 0.1, (1 + INPUTS + TAILS, SIZE))
        return cls(inputs, np.full((ORDER, SIZE), 0.5), np.zeros((GROUPS, SIZE)), np.log(shares))

    def copy(self, kind: type = np.float64) -> Network:
        return Network(*(getattr(self, name).astype(kind) for name in NAMES))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in NAMES])

    @classmethod
    def of_flat(cls, values: np.ndarray) -> Network:
        at = np.cumsum([(1 + INPUTS + TAILS) * SIZE, ORDER * SIZE, GROUPS * SIZE])
        inputs, places, outputs, bias = np.split(values, at)
        return cls(inputs.reshape(-1, SIZE), places.reshape(ORDER, SIZE), outputs.reshape(GROUPS, SIZE), bias)

    def tables(self) -> list[np.ndarray]:
        """The weighted vector of each context word, for each place."""
        return [(self.inputs * place).astype(np.float32) for place in self.places]

    def log_probabilities(self, contexts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Natural logarithm of each group's probability after its context, normalised over all groups."""
        out = np.empty(len(groups))
        tables, outputs, bias = self.tables(), self.outputs.T.astype(np.float32), self.bias.astype(np.float32)
        for start in range(0, len(groups), AT_ONCE):
            part = slice(start, start + AT_ONCE)
            predicted = sum(table.take(contexts[part, j], axis=0) for j, table in enumerate(tables))
            for first in range(start, start + len(predicted), IN_CACHE):
                rows = slice(first, min(first + IN_CACHE, start + len(predicted)))
                scores = predicted[first - start : rows.stop - start] @ outputs
                scores += bias
                scores -= scores.max(axis=1, keepdims=True)
                own = scores[np.arange(len(scores)), groups[rows]]
                np.exp(scores, out=scores)
                out[rows] = own - np.log(scores.sum(axis=1, dtype=np.float64))
        return out


def shares_of(group_n: np.ndarray) -> np.ndarray:
    """Share of each group among all tokens; groups without tokens get a little."""
    n = group_n + ADDED
    return n / n.sum()


def _at_rows(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows that go to each of ``n`` places."""
    width = rows.shape[1]
    cells = (index[:, None] * width + np.arange(width)).ravel()
    return np.bincount(cells, rows.ravel(), n * width).reshape(n, width)


def gradients(
    network: Network, contexts: np.ndarray, groups: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, losses: bool = True
) -> tuple[float, dict[str, np.ndarray]]:
    """Loss of a step, if asked for, and its gradients: each token's group told from all noise groups of the step.

    ``log_noise`` is the logarithm of the expected number of each group among the noise.
    """
    vectors = network.inputs.take(contexts.T, axis=0)
    predicted = (vectors * network.places[:, None]).sum(axis=0)
    true = (predicted * network.outputs[groups]).sum(axis=1) + network.bias[groups] - log_noise[groups]
    false = predicted @ network.outputs[noise].T
    false += network.bias[noise]
    false -= log_noise[noise]
    loss = np.logaddexp(0, -true).sum() + np.logaddexp(0, false).sum() if losses else 0.0
    limit = 700 if false.dtype == np.float64 else 80  # its exponential is still a number
    d_true, d_false = -1 / (1 + np.exp(np.minimum(true, limit))), np.negative(false, out=false)
    np.exp(np.minimum(d_false, limit, out=d_false), out=d_false)
    d_false += 1
    np.divide(1, d_false, out=d_false)
    d_outputs = _at_rows(groups, d_true[:, None] * predicted, GROUPS)
    d_bias = np.bincount(groups, d_true, GROUPS)
    np.add.at(d_outputs, noise, d_false.T @ predicted)
    np.add.at(d_bias, noise, d_false.sum(axis=0))
    d_predicted = d_true[:, None] * network.outputs[groups] + d_false @ network.outputs[noise]
    by_place = d_predicted * network.places[:, None]
    d_inputs = _at_rows(contexts.T.ravel(), by_place.reshape(-1, SIZE), len(network.inputs))
    d_places = np.stack([np.einsum("ij,ij->j", vector, d_predicted) for vector in vectors])
    return loss, {"inputs": d_inputs, "places": d_places, "outputs": d_outputs, "bias": d_bias}


class Steps:
    """Noise-contrastive steps of a network, which they change."""

    def __init__(self, network: Network, shares: np.ndarray, rng: np.random.Generator) -> None:
        self.network, self.shares, self.rng = network, shares, rng
        self._log_noise, self._taken = np.log(NOISE * shares).astype(network.bias.dtype), 0
        self._first, self._second, self._room = ({name: np.zeros_like(getattr(network, name)) for name in NAMES} for _ in range(3))

    def take(self, contexts: np.ndarray, groups: np.ndarray, rate: float) -> None:
        noise = self.rng.choice(GROUPS, NOISE, p=self.shares)
        _, slopes = gradients(self.network, contexts, groups, noise, self._log_noise, losses=False)
        self._taken += 1
        for name, slope in slopes.items():
            # a += 0.1 * (slope - a); b += 0.01 * (slope^2 - b); all in place, as a step is short
            a, b, room = self._first[name], self._second[name], self._room[name]
            slope = slope.astype(a.dtype, copy=False)  # sums are made in double precision
            slope /= len(groups)
            np.subtract(slope, a, out=room)
            room *= 0.1
            a += room
            np.multiply(slope, slope, out=room)
            room -= b
            room *= 0.01
            b += room
            np.sqrt(np.divide(b, 1 - 0.99**self._taken, out=room), out=room)
            room += 1e-8
            moved = np.divide(a, 1 - 0.9**self._taken, out=slope)
            moved *= rate
            moved /= room
            values = getattr(self.network, name)
            values -= moved


def train(contexts: np.ndarray, groups: np.ndarray, group_n: np.ndarray, rounds: int = ROUNDS) -> Network:
    """Noise-contrastive training. A tenth of the tokens, the last ones, chooses the round that is kept; the untrained
    network is among the choices, so a sample too small to learn from does no harm."""
    shares = shares_of(group_n)
    network = Network.untrained(shares)
    kept = len(groups) - len(groups) // 10
    if kept < STEP:
        return network
    rng = np.random.default_rng(11)
    network.outputs += rng.normal(0, 0.05, network.outputs.shape)
    quality = lambda net: float(net.log_probabilities(contexts[kept:], groups[kept:]).sum())
    best = Network.untrained(shares)
    best_quality = quality(best)
    steps = Steps(network, shares, rng)
    for round in range(rounds):
        order = rng.permutation(kept)
        for start in range(0, kept - STEP + 1, STEP):
            part = order[start : start + STEP]
            steps.take(contexts[part], groups[part], 0.01 * 0.5**round)
        reached = quality(network)
        if reached > best_quality:
            best_quality = reached
            best = network.copy()
    return best


# Tokens of a slice of texts.


@dataclass
class Tokens:
    firsts: np.ndarray  # the first token of each text, and at the end the number of tokens
    n: np.ndarray  # count of each token, -1 if not known
    group: np.ndarray
    contexts: np.ndarray
    is_word: np.ndarray
    words: Words


def tokens_of(texts: pa.Array, lexicon: Lexicon) -> Tokens:
    words = words_of(texts)
    sizes = np.diff(words.firsts) + 1
    firsts = np.append(0, np.cumsum(sizes))
    is_word = np.ones(firsts[-1], dtype=bool)
    is_word[firsts[1:] - 1] = False
    n, group, inputs = np.full(firsts[-1], lexicon.texts), np.zeros(firsts[-1], np.int64), np.zeros(firsts[-1], np.int64)
    n[is_word], group[is_word], inputs[is_word] = lexicon.looked_up(words)
    place = np.arange(firsts[-1]) - np.repeat(firsts[:-1], sizes)
    contexts = np.zeros((firsts[-1], ORDER), dtype=np.uint16)
    for j in range(min(ORDER, firsts[-1])):
        contexts[j + 1 :, j] = np.where(place[j + 1 :] > j, inputs[: firsts[-1] - j - 1], 0)
    return Tokens(firsts, n, group, contexts, is_word, words)


def _sampled(texts: DataFrame, lexicon: Broadcast, share: float) -> DataFrame:
    """``mark, contexts, groups`` of a share of the different (id, text) rows, chosen by hash; some tokens of each."""
    mark = F.xxhash64(F.lit(12), "id", "text")
    chosen = texts.select(mark.alias("mark"), "text").filter(F.pmod("mark", F.lit(1 << 31)) < int(share * (1 << 31)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy()
            for start, part in pieces(batch.column(1)):
                tokens = tokens_of(part, lexicon.value)
                rows = []
                for k in range(len(part)):
                    a, b = int(tokens.firsts[k]), int(tokens.firsts[k + 1])
                    if b - a > SAMPLE_TOKENS:
                        a += int(marks[start + k] % (b - a - SAMPLE_TOKENS + 1))
                        b = a + SAMPLE_TOKENS
                    rows.append((tokens.contexts[a:b].tobytes(), tokens.group[a:b].astype(np.uint16).tobytes()))
                contexts, groups = (pa.array(c, pa.binary()) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part)), contexts, groups], ["mark", "contexts", "groups"]
                )

    emitted = chosen.mapInArrow(task, "mark long, contexts binary, groups binary")
    return emitted.groupBy("mark").agg(F.min("contexts").alias("contexts"), F.min("groups").alias("groups"))


def _start(texts: DataFrame, lexicon: Broadcast, sample: int) -> Network:
    """A network trained in one task on about ``sample`` texts (id, text) and ``SAMPLE_TOKENS`` tokens of each."""
    share = min(1.0, sample / max(lexicon.value.texts, 1))
    group_n = lexicon.value.group_n

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        contexts = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint16).reshape(-1, ORDER)
        groups = np.frombuffer(b"".join(r[2] for r in rows), dtype=np.uint16).astype(np.int64)
        network = train(contexts.astype(np.int64), groups, group_n)
        yield pa.RecordBatch.from_pydict({"values": [network.flat().tobytes()]})

    trained = _sampled(texts, lexicon, share).repartition(1).mapInArrow(task, "values binary").collect()
    if not trained:
        return Network.untrained(shares_of(group_n))
    return Network.of_flat(np.frombuffer(trained[0]["values"], dtype=np.float64))


def _moves(texts: DataFrame, lexicon: Broadcast, start: Broadcast) -> DataFrame:
    """``part, tokens, moved``: how far all tokens of a one-column frame move a network, times their number.

    Each task learns from all it reads. The moves are whole numbers and cut in ``PARTS``; each part is summed by one
    task, which holds a single sum.
    """
    shares = shares_of(lexicon.value.group_n)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, tokens = Steps(start.value.copy(WHOLE_TYPE), shares, np.random.default_rng(13)), 0
        for batch in batches:
            for _, part in pieces(batch.column(0)):
                found = tokens_of(part, lexicon.value)
                order = steps.rng.permutation(len(found.group))
                for at in range(0, len(order), WHOLE_STEP):
                    chosen = order[at : at + WHOLE_STEP]
                    steps.take(found.contexts[chosen].astype(np.int64), found.group[chosen], WHOLE_RATE)
                tokens += len(order)
        if tokens:
            moved = steps.network.flat().astype(np.float64) - start.value.copy(WHOLE_TYPE).flat()
            moved = np.rint(moved * (1 << MOVE_BITS)).astype(np.int64) * tokens
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(range(PARTS), pa.int32()),
                    "tokens": pa.array([tokens] * PARTS, pa.int64()),
                    "moved": [m.tobytes() for m in np.array_split(moved, PARTS)],
                }
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for part, tokens, moved in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, total = sums.get(part, (0, 0))
                sums[part] = n + tokens, total + np.frombuffer(moved, dtype=np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(sums, pa.int32()),
                    "tokens": pa.array([n for n, _ in sums.values()], pa.int64()),
                    "moved": [m.tobytes() for _, m in sums.values()],
                }
            )

    schema = "part int, tokens long, moved binary"
    return texts.mapInArrow(learn, schema).repartition(PARTS, "part").mapInArrow(add, schema)


def fit(texts: DataFrame, lexicon: Broadcast, sample: int = SAMPLE) -> Network:
    """A network that has learned from every token of all texts (id, text), starting from one of ``sample`` texts."""
    start = _start(texts, lexicon, sample)
    shared = texts.sparkSession.sparkContext.broadcast(start)
    moves = sorted(_moves(texts.select("text"), lexicon, shared).collect(), key=lambda r: r["part"])
    if not moves:
        return start
    moved = np.concatenate([np.frombuffer(r["moved"], dtype=np.int64) for r in moves])
    return Network.of_flat(start.flat() + moved / (moves[0]["tokens"] * float(1 << MOVE_BITS)))


# Scores.

_SCORED = (
    "row long, id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<struct<word:long,times:long>>"
)


def _scored(texts: DataFrame, lexicon: Broadcast, network: Broadcast) -> DataFrame:
    """Per text all that its known words give, and its other words with how often they stand in it."""
    rare_type = pa.struct([("word", pa.int64()), ("times", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, net = lexicon.value, network.value
        row = TaskContext.get().partitionId() << _ROW_BITS
        total = np.log10(lex.tokens + ADDED * (lex.distinct + 1))
        group_total = np.log10(lex.group_n + ADDED * (lex.group_words + 1))
        for batch in batches:
            for start, part in pieces(batch.column(2)):
                t = tokens_of(part, lex)
                known = t.n >= 0
                logarithm = np.where(known, np.log10(np.maximum(t.n, 0) + ADDED), 0)
                by_group = net.log_probabilities(t.contexts, t.group) / np.log(10)
                inside = np.where(t.group > SINGLE, logarithm - group_total[t.group], 0)
                summed = lambda values, t=t: np.add.reduceat(values, t.firsts[:-1])
                text = np.repeat(np.arange(len(part)), np.diff(t.firsts))
                other = ~known[t.is_word]
                pairs = np.stack([text[t.is_word][other], t.words.hashes[other].view(np.int64)], axis=1)
                rare, times = np.unique(pairs, axis=0, return_counts=True) if len(pairs) else (pairs, np.zeros(0, int))
                offsets = np.searchsorted(rare[:, 0], np.arange(len(part) + 1))
                structs = pa.StructArray.from_arrays([pa.array(rare[:, 1]), pa.array(times, pa.int64())], fields=list(rare_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(part))),
                        *(batch.column(k).slice(start, len(part)) for k in (0, 1)),
                        pa.array(np.diff(t.firsts), pa.int64()),
                        pa.array(summed((t.n > 0).astype(np.int64)), pa.int64()),
                        pa.array(summed(logarithm - total)),
                        pa.array(summed(by_group + inside)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                    ],
                    [field.split()[0] for field in _SCORED.split(", ")],
                )
                row += len(part)

    return texts.select("id", "held_out", "text").mapInArrow(task, _SCORED)


def score_texts(
    docs: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """Per row of ``docs``: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    All texts that are not ``held_out`` are counted. ``base_score`` is the text's log10 probability by single words,
    ``sum(log10((c + 0.1) / (N + 0.1 * (V + 1))))``, ``score`` the one of the network. Missing and empty texts are an
    end alone. A row that ``held_out`` leaves undecided is held out. Repeated rows are counted as often as they
    come and get equal scores. The network learns from every token of all texts that are not ``held_out``; ``sample``
    texts of them give its start. With nothing to learn from, the network gives each group the same share. Other
    columns do not matter.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id).cast("long").alias("id"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    learned = texts.filter(~F.col("held_out"))
    counts = stage(word_counts(learned.select("text")))
    found, in_lexicon = lexicon(counts, learned.count())
    shared = spark.sparkContext.broadcast(found)  # at most KNOWN words
    network = spark.sparkContext.broadcast(fit(learned.select("id", "text"), shared, sample))

    scored = stage(_scored(texts, shared, network))
    rare = scored.select("row", F.inline("rare")).join(counts.filter(~in_lexicon).select("word", "n"), "word", "left")
    added = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADDED))).alias("logarithms"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("counted"),
    )
    more = F.coalesce("logarithms", F.lit(0.0))
    return scored.join(added, "row", "left").select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("counted", F.lit(0))).alias("n_known"),
        F.lit(found.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
