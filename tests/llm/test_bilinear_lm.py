import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import bilinear_lm as lm
from lodestrata.llm.words import words_of


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 10 == 0


def tokens_in(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [None]


def brute_base(rows):
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t, *_ in rows if not held(i) for w in tokens_in(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t, *_ in rows:
        words = tokens_in(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((i, held(i), len(words), sum(c[w] > 0 for w in words), n, base))
    return out


def languages(n, seed=3):
    """Texts of one of two vocabularies whose words follow one another by rule."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start, words = 1000 * rng.randrange(2) + rng.randrange(40), []
        for _ in range(rng.randrange(5, 120)):
            words.append(f"W{start}" if rng.random() < 0.2 else f"w{start}")
            start = start // 1000 * 1000 + (start + rng.choice([1, 1, 1, 7])) % 40
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words) + f" own{i}", "s"))
    return rows


def compare(frame, rows):
    found = sorted(frame.collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"]))
    wanted = sorted(brute_base(rows), key=lambda r: (str(r[0]), r[2]))
    assert len(found) == len(wanted)
    for r, (i, held, n, known, total, base) in zip(found, wanted, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert math.isfinite(r["score"])
    return found


@pytest.mark.parametrize("known", [0, 30, lm.KNOWN])
def test_counts_and_base_scores_equal_brute_force(documents, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    monkeypatch.setattr(lm, "HELD", 50)
    rows = languages(120) + [(500, None), (501, ""), (502, " \n"), (None, "w1 w2 never"), (20, "again"), (20, "again")]
    rows += [(600, "İé W1 \x1c w2\x0bw3 " + "x " * 5000), (30, "never seen before"), (30, "NEVER w1")]
    docs = documents(rows).selectExpr("*", "1 AS base", "2 AS word", "'x' AS held_out", "3 AS row")
    compare(lm.score_texts(docs, held_out()), rows)


def test_empty_tables_and_nothing_to_learn_from(documents):
    assert lm.score_texts(documents([]), held_out()).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(held, "a b"), (None, "c")]
    found = compare(lm.score_texts(documents(rows), held_out()), rows)
    assert found[0]["base_score"] == 0 and found[0]["n_known"] == 0


def test_scores_do_not_depend_on_the_size_of_the_lexicon(documents, monkeypatch):
    rows = languages(150)
    first = {r["doc_id"]: r["score"] for r in lm.score_texts(documents(rows), held_out()).collect()}
    again = {r["doc_id"]: r["score"] for r in lm.score_texts(documents(rows), held_out()).collect()}
    assert first == pytest.approx(again, rel=1e-12)


def test_held_out_texts_are_likelier_than_by_single_words(documents):
    rows = languages(900)
    found = [r for r in compare(lm.score_texts(documents(rows), held_out()), rows) if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in found)
    assert sum(r["score"] - r["base_score"] for r in found) / tokens > 0.4  # decimal digits for each token


def test_the_network_learns_from_every_token(documents, spark, monkeypatch):
    """Whatever the sample is, each word of each text moves the network, and words of no text do not."""
    start = random_network(6)
    monkeypatch.setattr(lm, "_start", lambda *_: start)
    rows = languages(40)
    frame = documents(rows).select("doc_id", "text").toDF("id", "text").repartition(3)
    lexicon, _ = lm.lexicon(lm.word_counts(frame.select("text")), len(rows))
    shared = spark.sparkContext.broadcast(lexicon)
    moves = lm._moves(frame.select("text"), shared, spark.sparkContext.broadcast(start)).collect()
    tokens = sum(len(tokens_in(t)) for _, t, _ in rows)
    assert sorted(r["part"] for r in moves) == list(range(lm.PARTS)) and {r["tokens"] for r in moves} == {tokens}
    network = lm.fit(frame, shared, 1)
    texts = lm.tokens_of(pa.array([t for _, t, _ in rows]), lexicon)
    seen = np.unique(texts.contexts)
    moved = np.abs(network.inputs - start.inputs).sum(axis=1) > 0
    assert moved[seen].all() and moved.sum() == len(seen)
    better, before = (n.log_probabilities(texts.contexts, texts.group).sum() for n in (network, start))
    assert better > before


def random_network(seed):
    rng = np.random.default_rng(seed)
    network = lm.Network.untrained(lm.shares_of(rng.integers(0, 50, lm.GROUPS)))
    network.outputs = rng.normal(0, 0.5, network.outputs.shape)
    network.inputs = rng.normal(0, 0.5, network.inputs.shape)
    return network


def test_gradients_equal_differences():
    rng, network = np.random.default_rng(1), random_network(2)
    contexts = rng.integers(0, 30, (20, lm.ORDER))
    groups, noise = rng.integers(0, lm.GROUPS, 20), rng.integers(0, lm.GROUPS, 16)
    log_noise = rng.normal(size=lm.GROUPS)
    _, slopes = lm.gradients(network, contexts, groups, noise, log_noise)
    for name, slope in slopes.items():
        values = getattr(network, name)
        for place in np.argsort(-np.abs(slope.ravel()))[[0, 3, 9]]:
            at = np.unravel_index(place, values.shape)
            losses = []
            for move in (1e-5, -1e-5):
                values[at] += move
                losses.append(lm.gradients(network, contexts, groups, noise, log_noise)[0])
                values[at] -= move
            assert slope[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-4, abs=1e-6)


def test_probabilities_of_all_tokens_add_up_to_one(spark, documents):
    rows = languages(60)
    counts = lm.word_counts(documents(rows).select("text"))
    lexicon, _ = lm.lexicon(counts, 60)
    network = random_network(4)
    context = np.arange(1, 1 + lm.ORDER)[None]
    by_group = np.exp(network.log_probabilities(np.repeat(context, lm.GROUPS, axis=0), np.arange(lm.GROUPS)))
    assert by_group.sum() == pytest.approx(1, rel=1e-5)
    inside = np.zeros(lm.GROUPS)
    for n, group in zip(lexicon.n, lexicon.group, strict=True):
        inside[group] += (n + 0.1) / (lexicon.group_n[group] + 0.1 * (lexicon.group_words[group] + 1))
    many = slice(1 + lm.SINGLE, None)
    unknown = 0.1 / (lexicon.group_n[many] + 0.1 * (lexicon.group_words[many] + 1))
    assert inside[many] + unknown == pytest.approx(np.ones(lm.TAILS))


def test_a_score_is_the_sum_over_its_tokens(documents, monkeypatch):
    rows = languages(80)
    network = random_network(5)
    monkeypatch.setattr(lm, "fit", lambda *_: network)
    found = {r["doc_id"]: r for r in lm.score_texts(documents(rows), held_out()).collect()}
    train = documents(rows).filter(~held_out())
    lexicon, _ = lm.lexicon(lm.word_counts(train.select("text")), train.count())
    of = {int(h): (int(n), int(g), int(x)) for h, n, g, x in zip(lexicon.words, lexicon.n, lexicon.group, lexicon.input, strict=True)}
    for i, text, _ in rows[:20]:
        total, before = 0.0, [0] * lm.ORDER
        for word in tokens_in(text):
            n, group, own = lexicon.texts, 0, 0
            if word is not None:
                words = words_of(pa.array([word]))
                tail = int(lm.tails(words)[0])
                n, group, own = of.get(int(words.hashes[0]), (0, 1 + lm.SINGLE + tail, 1 + lm.INPUTS + tail))
            vector = sum(network.inputs[before[j]] * network.places[j] for j in range(lm.ORDER))
            scores = network.outputs @ vector + network.bias
            total += (scores[group] - np.log(np.exp(scores).sum())) / np.log(10)
            if group > lm.SINGLE:
                total += math.log10((n + 0.1) / (lexicon.group_n[group] + 0.1 * (lexicon.group_words[group] + 1)))
            before = [own, *before[:-1]]
        assert found[i]["score"] == pytest.approx(total, rel=1e-4)


def test_query_on_the_given_documents(spark, sf_dir):
    from lodestrata.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = compare(QUERIES["op12_bilinear_lm"](spark, sf_dir), rows)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_do_not_depend_on_how_many_rows_stay_in_the_cache(monkeypatch):
    rng = np.random.default_rng(5)
    network = lm.Network.untrained(lm.shares_of(rng.integers(1, 50, lm.GROUPS)))
    network.outputs += rng.normal(0, 0.3, network.outputs.shape)
    contexts = rng.integers(0, len(network.inputs), (3000, lm.ORDER)).astype(np.uint16)
    groups = rng.integers(0, lm.GROUPS, 3000)
    whole = network.log_probabilities(contexts, groups)
    for rows in (7, lm.AT_ONCE):
        monkeypatch.setattr(lm, "IN_CACHE", rows)
        assert np.allclose(network.log_probabilities(contexts, groups), whole, rtol=0, atol=1e-5)
    monkeypatch.setattr(lm, "AT_ONCE", 1000)
    assert np.allclose(network.log_probabilities(contexts, groups), whole, rtol=0, atol=1e-5)


def test_a_step_moves_every_parameter_by_the_written_out_rule():
    rng = np.random.default_rng(6)
    shares = lm.shares_of(rng.integers(1, 50, lm.GROUPS))
    network = lm.Network.untrained(shares)
    network.outputs += rng.normal(0, 0.3, network.outputs.shape)
    plain, steps = network.copy(), lm.Steps(network, shares, np.random.default_rng(13))
    noise_of, a, b = np.random.default_rng(13), dict.fromkeys(lm.NAMES, 0.0), dict.fromkeys(lm.NAMES, 0.0)
    for taken in (1, 2, 3):
        contexts = rng.integers(0, len(network.inputs), (200, lm.ORDER))
        groups = rng.integers(0, lm.GROUPS, 200)
        steps.take(contexts, groups, 0.01)
        noise = noise_of.choice(lm.GROUPS, lm.NOISE, p=shares)
        _, slopes = lm.gradients(plain, contexts, groups, noise, np.log(lm.NOISE * shares))
        for name in lm.NAMES:
            slope = slopes[name] / 200
            a[name] = a[name] + 0.1 * (slope - a[name])
            b[name] = b[name] + 0.01 * (slope * slope - b[name])
            getattr(plain, name)[...] -= 0.01 * (a[name] / (1 - 0.9**taken)) / (np.sqrt(b[name] / (1 - 0.99**taken)) + 1e-8)
    for name in lm.NAMES:
        assert np.array_equal(getattr(network, name), getattr(plain, name))
